"""Landing of archives and remote files, on files built in a temporary folder."""

from __future__ import annotations

import io
import json
import os
import random
import urllib.error
import zipfile

import pytest

from rollbook.sources import landing
from rollbook.sources.formats import open_source, read_source

REGISTER = {"delimiter": ";", "encoding": "latin1", "has_header": False, "columns": ["a", "b", "c"]}


def make_zip(path, members, encoding="latin1"):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            if name.endswith("/"):
                archive.mkdir(name)
            else:
                archive.writestr(name, content.encode(encoding))
    return str(path)


def read(spark, uri, options=REGISTER, limit=None):
    return [tuple(r) for r in read_source(spark, "zip_csv", uri, options, limit).collect()]


def test_limit_and_header(spark, tmp_path):
    uri = make_zip(tmp_path / "a.zip", {"sample.csv": "code;description\n001;First\n002;Second\n"})
    options = {"delimiter": ";"}
    frame = read_source(spark, "http_zip_csv", uri, options, 1)
    assert frame.columns == ["code", "description"]
    assert [tuple(r) for r in frame.collect()] == [("001", "First")]


def test_rows_get_the_declared_width(spark, tmp_path):
    uri = make_zip(tmp_path / "a.zip", {"DATA.CSV": "1;2;3;4\n1\n\n;;\n"})
    expected = [("1", "2", "3"), ("1", None, None), (None, None, None), ("", "", "")]
    assert read(spark, uri) == expected
    opened = open_source(spark, "zip_csv", uri, REGISTER)
    assert [tuple(r) for r in opened.landing.odd_rows().collect()] == [
        (uri, 1, ["1", "2", "3", "4"]), (uri, 2, ["1"]), (uri, 3, []),
    ]


def test_records_of_a_wrong_width_can_be_kept_apart(spark, tmp_path):
    uri = make_zip(tmp_path / "a.zip", {"x.csv": "1;2;3;4\n1\n\n;;\n5;6;7\n"})
    opened = open_source(spark, "zip_csv", uri, {**REGISTER, "quarantine": True})
    assert [tuple(r) for r in opened.rows.collect()] == [("", "", ""), ("5", "6", "7")]
    assert opened.malformed() == 3
    assert [json.loads(r.record) for r in opened.rejected.collect()] == [["1", "2", "3", "4"], ["1"], []]


def test_quotes_and_accents(spark, tmp_path):
    text = '"a""b";"back\\";"two\nlines"\r\nção;x"y;' + chr(0xA0) + "\r\n"
    uri = make_zip(tmp_path / "a.zip", {"x.csv": text})
    assert read(spark, uri) == [('a"b', "back\\", "two\nlines"), ("ção", 'x"y', chr(0xA0))]


def test_fields_may_hold_the_separators(spark, tmp_path):
    odd = ["\x1b", "\x1e", "\x1f", "\x1b0", "\x1b1\x1e", "\x1f\x1b2\x1b\x1b", "\x1b3", ""]
    random.seed(3)
    rows = [tuple("".join(random.choices(["\x1b", "\x1e", "\x1f", "0", "1", "2", "3"], k=5)) for _ in "abc") for _ in range(50)]
    rows += [(x, y, "z") for x in odd for y in odd]
    uri = make_zip(tmp_path / "a.zip", {"x.csv": "".join(";".join(f'"{v}"' for v in r) + "\n" for r in rows)})
    assert read(spark, uri) == rows
    uri = make_zip(tmp_path / "b.zip", {"x.csv": "\x1b3\n\n\x1f;\x1e\n"})
    assert read(spark, uri) == [("\x1b3", None, None), (None, None, None), ("\x1f", "\x1e", None)]


@pytest.mark.parametrize(
    ("members", "expected"),
    [
        ({"dir/": "", "K3241.EMPRECSV": "1;2;3\n"}, "1"),
        ({"readme.txt": "no;no;no\n", "second.csv": "2;2;3\n"}, "2"),
        ({"first.txt": "1;2;3\n", "other.txt": "2;2;3\n"}, "1"),
    ],
    ids=["no suffix", "csv wins", "first file"],
)
def test_member_choice(spark, tmp_path, members, expected):
    assert read(spark, make_zip(tmp_path / "a.zip", members))[0][0] == expected


def test_empty_archive_is_an_error_and_leaves_nothing(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    with pytest.raises(Exception, match="No file inside"):
        read(spark, make_zip(tmp_path / "a.zip", {"dir/": ""}))
    assert set(os.listdir(shared)) == before


def test_empty_member_gives_no_rows(spark, tmp_path):
    uri = make_zip(tmp_path / "a.zip", {"x.csv": ""})
    assert read(spark, uri) == []


def test_headers_name_the_columns_of_their_own_archive(spark, tmp_path):
    one = make_zip(tmp_path / "1.zip", {"x.csv": "a,b,c\n1,2,3\n"})
    two = make_zip(tmp_path / "2.zip", {"x.csv": "c,a\n30,10\n31\n"})
    three = make_zip(tmp_path / "3.zip", {"x.csv": "d,b,a\n400,200,100,9\n"})
    frame = read_source(spark, "zip_csv", [one, two, three], {})
    assert frame.columns == ["a", "b", "c", "d"]
    assert {tuple(r) for r in frame.collect()} == {
        ("1", "2", "3", None), ("10", None, "30", None), (None, None, "31", None), ("100", "200", None, "400"),
    }


@pytest.mark.parametrize(("text", "message"), [("a,b,a\n1,2,3\n", "twice"), ("", "no header"), ("\n1,2\n", "no header")])
def test_headers_are_checked(spark, tmp_path, text, message):
    with pytest.raises(Exception, match=message):
        read(spark, make_zip(tmp_path / "a.zip", {"x.csv": text}), {})


def test_glob_takes_all_archives_in_parallel_and_a_limit_counts_them_together(spark, tmp_path):
    for i in range(3):
        make_zip(tmp_path / f"Part{i}.zip", {"x.csv": f"{i};x;y\n" * 5})
    make_zip(tmp_path / "Other.zip", {"x.csv": "9;x;y\n"})
    opened = open_source(spark, "zip_csv", f"{tmp_path}/Part*.zip", REGISTER)
    assert len(opened.landing.archives) == 3
    assert sorted(r.a for r in opened.rows.collect()) == ["0"] * 5 + ["1"] * 5 + ["2"] * 5
    # The first rows in the order of the archives.
    assert [r[0] for r in read(spark, f"{tmp_path}/Part*.zip", limit=2)] == ["0"] * 2
    assert sorted(r[0] for r in read(spark, f"{tmp_path}/Part*.zip", limit=7)) == ["0"] * 5 + ["1"] * 2
    assert len(read(spark, f"{tmp_path}/Part*.zip", limit=99)) == 15


def test_addresses(tmp_path):
    for name in ("P1.zip", "P2.zip", "Q.zip"):
        make_zip(tmp_path / name, {"x.csv": ""})
    expected = ["Q.zip", "P1.zip", "P2.zip"]
    for address in (f"{tmp_path}/Q.zip, {tmp_path}/P*.zip", [f"{tmp_path}/Q.zip", f"{tmp_path}/P*.zip"]):
        assert [f.removeprefix(f"{tmp_path}/") for f in landing.matching_files(address)] == expected
    assert landing.matching_files(f"file://{tmp_path}/P*.zip")[0] == f"file://{tmp_path}/P1.zip"
    several = ["https://example.org/a.zip?token=1", "https://example.org/b.zip"]
    assert landing.matching_files(several) == several


def test_no_match_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="No file matches"):
        read(spark, f"{tmp_path}/None*.zip")


def test_a_large_archive_is_decoded_once_and_read_by_many_tasks(spark, tmp_path):
    random.seed(5)
    rows = [(str(i), f"{random.random()}\n{i}" if i % 7 == 0 else "x", "") for i in range(60_000)]
    uri = make_zip(tmp_path / "a.zip", {"x.csv": "".join(f'{a};"{b}";{c}\n' for a, b, c in rows)})
    opened = open_source(spark, "zip_csv", uri, {**REGISTER, "part_bytes": 100_000})
    (archive,) = opened.landing.archives
    assert archive.records == len(rows) and archive.parts > 5
    # Its directory is read on top, but no byte of the table twice.
    assert archive.bytes_read < os.path.getsize(uri) + 100_000
    assert opened.rows.rdd.getNumPartitions() > 1
    assert sorted((int(r.a), r.b, r.c) for r in opened.rows.collect()) == [(int(a), b, c) for a, b, c in rows]
    opened.close()
    assert not os.path.exists(opened.landing.folder)


def test_parts_are_split_where_spark_likes(spark, tmp_path):
    rows = [(str(i), "y" * (i % 50), "é\n") for i in range(5_000)]
    uri = make_zip(tmp_path / "a.zip", {"x.csv": "".join(f'{a};{b};"{c}"\n' for a, b, c in rows)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        frame = read_source(spark, "zip_csv", uri, REGISTER)
        assert frame.rdd.getNumPartitions() > 20
        assert sorted(tuple(r) for r in frame.collect()) == sorted(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_declarations_are_checked(spark, tmp_path):
    uri = make_zip(tmp_path / "a.zip", {"x.csv": "1;2;3\n"})
    with pytest.raises(ValueError, match="columns"):
        read(spark, uri, {"has_header": False})
    with pytest.raises(ValueError, match="positive"):
        read(spark, uri, limit=0)
    with pytest.raises(ValueError, match="Unsupported source format"):
        read_source(spark, "ftp", uri, REGISTER)
    with pytest.raises(ValueError, match="page"):
        read_source(spark, "json_pages", uri, {"columns": ["a"], "last_page": 2})


class Response(io.BytesIO):
    def __init__(self, body, length=None):
        super().__init__(body)
        self.headers = {} if length is None else {"Content-Length": str(length)}


def test_fetch_streams_and_tries_again(tmp_path):
    body, asked, waits = os.urandom(20_000_000), [], []
    answers = [OSError("reset"), Response(body[:99], len(body)), urllib.error.HTTPError("u", 503, "busy", {}, None), Response(body)]

    def opener(uri, timeout):
        asked.append(uri)
        answer = answers[len(asked) - 1]
        if isinstance(answer, Exception):
            raise answer
        return answer

    target = f"{tmp_path}/sub/a.bin"
    assert landing.fetch("https://example.org/a", target, opener, pause=waits.append) == len(body)
    assert open(target, "rb").read() == body
    assert len(asked) == 4 and waits == [1.0, 2.0, 4.0]


def test_fetch_gives_up(tmp_path):
    asked = []

    def gone(uri, timeout):
        asked.append(uri)
        raise urllib.error.HTTPError(uri, 404, "gone", {}, None)

    with pytest.raises(urllib.error.HTTPError):
        landing.fetch("https://example.org/a", f"{tmp_path}/a", gone, pause=lambda s: None)
    assert len(asked) == 1

    def short(uri, timeout):
        return Response(b"ab", 3)

    with pytest.raises(OSError, match="2 of 3 bytes"):
        landing.fetch("https://example.org/a", f"{tmp_path}/a", short, attempts=2, pause=lambda s: None)


def test_an_archive_over_http_is_fetched_once(tmp_path, monkeypatch):
    path = make_zip(tmp_path / "a.zip", {"x.csv": "1;2;3\n" * 1000})
    body, asked = open(path, "rb").read(), []

    def fetch(uri, target):
        asked.append(uri)
        os.makedirs(os.path.dirname(target))
        with open(target, "wb") as out:
            out.write(body)
        return len(body)

    monkeypatch.setattr(landing, "fetch", fetch)
    text = landing.TextFormat(";", "latin1", False)
    done = landing.land_archive(0, "https://example.org/a.zip", f"{tmp_path}/landed", text, 3, None, 1 << 20)
    assert asked == ["https://example.org/a.zip"]
    assert (done.records, done.odd_records, done.bytes_read) == (1000, 0, len(body))
    assert os.listdir(f"{tmp_path}/landed/fetched") == []


def test_plain_csv_and_json(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('1;"x ""y""";ção\n2;b\n'.encode("latin1"))
    rows = read_source(spark, "csv", str(tmp_path / "a.csv"), REGISTER).collect()
    assert [tuple(r) for r in rows] == [("1", 'x "y"', "ção"), ("2", "b", None)]
    (tmp_path / "b.csv").write_text("x,y\n1,2\n3,4\n")
    frame = read_source(spark, "csv", str(tmp_path / "b.csv"), {}, 1)
    assert frame.columns == ["x", "y"] and frame.count() == 1
    (tmp_path / "a.json").write_text('{"data": [{"a": "1", "b": 2}, {"a": "3"}]}')
    options = {"columns": ["a", "b"], "records_path": "data", "multi_line": True}
    rows = read_source(spark, "json", str(tmp_path / "a.json"), options).collect()
    assert [tuple(r) for r in rows] == [("1", "2"), ("3", None)]


def test_malformed_json_is_kept_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": "1", "b": 2}\n{"a": \n\nnonsense\n{"b": "3"}\n')
    opened = open_source(spark, "json", str(tmp_path / "a.json"), {"columns": ["a", "b"]})
    assert opened.rows.count() == 2
    assert opened.malformed() == 2
    assert [tuple(r) for r in opened.rows.collect()] == [("1", "2"), (None, "3")]
    bad = opened.rejected.collect()
    assert [r.record.strip() for r in bad] == ['{"a":', "nonsense"] and all(r.source_file.endswith("a.json") for r in bad)


def test_pages_of_an_api(spark, tmp_path):
    for page in (1, 2, 3, 4):
        records = [{"a": f"{page}-{i}", "b": i} for i in range(page)]
        (tmp_path / f"page-{page}.json").write_text(json.dumps({"total": 10, "items": records}))
    options = {"columns": ["a", "b"], "records_path": "items", "first_page": 2, "last_page": 4}
    rows = read_source(spark, "json_pages", f"{tmp_path}/page-{{page}}.json", options)
    assert sorted(tuple(r) for r in rows.collect()) == [(f"{p}-{i}", str(i)) for p in (2, 3, 4) for i in range(p)]
