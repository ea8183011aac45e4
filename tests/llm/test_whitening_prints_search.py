"""Whitening, I-Match fingerprints and ranked search against brute force and on edge cases."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import SMALL

from checks.compare import difference, duckdb_over
from rollbook.llm import imatch
from rollbook.llm.imatch import imatch_fingerprints, likeness
from rollbook.llm.max_sketch import ranked_search
from rollbook.llm.queries import ORACLE, QUERIES
from rollbook.llm.whitening import Spectrum, rank_one, whiten

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


# Whitening.


@pytest.mark.parametrize(("n", "d"), [(60, 6), (9, 16), (40, 1), (300, 32)])
@pytest.mark.parametrize("block", [1, 7, 1000])
def test_spectra_equal_the_scatter(n, d, block):
    random = np.random.default_rng(n + d)
    x = np.floor(random.normal(size=(n, d)) * 300) + 100_000
    x[n // 2 :, 0] = x[0, 0]
    if d > 4:
        x[:, 3], x[:, 4] = x[:, 2], 5
    spectra = []
    for part in (x[: n // 3], x[n // 3 :]):
        spectra.append(Spectrum(d))
        for at in range(0, len(part), block):
            spectra[-1].add(part[at : at + block])
    spectra[0].merge(spectra[1])
    one = spectra[0]
    centred = x - x.mean(axis=0)
    expected = centred.T @ centred
    assert np.allclose(one.vectors @ np.diag(one.values) @ one.vectors.T, expected, atol=1e-11 * np.abs(expected).max())
    assert np.allclose(one.vectors.T @ one.vectors, np.eye(d), atol=1e-12)
    assert np.allclose(one.mean, x.mean(axis=0)) and one.n == n and (np.diff(one.values) >= 0).all()


def test_updates_with_close_equal_and_untouched_values():
    random = np.random.default_rng(4)
    basis = np.linalg.qr(random.normal(size=(8, 8)))[0]
    for values in ([1, 1, 1, 2, 2, 3, 4, 5], [0] * 8, [1, 1 + 1e-15, 1 + 1e-13, 1 + 1e-9, 2, 1e9, 1e9 + 1e-3, 1e12]):
        for weights in (random.normal(size=8), np.eye(8)[2], [1e-9, 1, 0, 0, 1e-30, 1, 1, 1e-6], np.zeros(8)):
            before, v = np.array(values, dtype=float), basis @ np.array(weights, dtype=float)
            after, vectors = rank_one(before, basis, v)
            expected = np.linalg.eigvalsh(basis @ np.diag(before) @ basis.T + np.outer(v, v))
            assert np.allclose(after, expected, atol=1e-13 * max(1, expected[-1]))
            assert np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-12)


def brute_whitening(vectors, keep=8):
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    covariance = (apart / n).T @ (apart / n) / n
    values, components = np.linalg.eigh(covariance)
    values, components = values[::-1], components[:, ::-1]
    whitened = (apart / n) @ components[:, :keep] / np.sqrt(values[:keep])
    return (apart.astype(object) ** 2).sum(axis=1), whitened, values[:keep] / values.sum()


@pytest.mark.parametrize("block", [1, 64])
def test_whitening_equals_brute_force(spark, block):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    given = {r.vec_id: r.embedding for r in rows.collect()}
    ids = sorted(given)
    deviation, whitened, explained = brute_whitening([given[i] for i in ids])
    if block == 1:
        rows = rows.where("vec_id < 60")
        ids = [i for i in ids if i < 60]
        deviation, whitened, explained = brute_whitening([given[i] for i in ids])
    out = whiten(rows.repartition(5), block=block, fan=2).toPandas()
    assert len(out) == 8 * len(ids) and (out.n == len(ids)).all()
    for c, part in out.sort_values("vec_id").groupby("component"):
        assert part.vec_id.tolist() == ids and part.deviation.tolist() == list(deviation)
        sign = np.sign(part.whitened.to_numpy() @ whitened[:, c - 1])
        assert np.allclose(part.whitened, sign * whitened[:, c - 1], atol=1e-9)
        assert np.allclose(part.explained, explained[c - 1], rtol=1e-10)
    assert out.identity_error.nunique() == 1 and out.identity_error[0] < 1e-9


def test_the_registered_whitening_takes_the_whole_table(spark):
    out = QUERIES["op11_embedding_whitening"](spark, SMALL)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 8 * spark.read.parquet(f"{SMALL}/embeddings.parquet").count()


VECTORS = "vec_id long, embedding array<double>, x int, component string, n string"


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [1.0, None, 2.0], [nan, 1.0, 1.0], [1.0, inf, 0.0], [-inf, 0.0, 0.0], [1.0, 2.0], []]
    good = [[0.0, 0.0, 0.0], [0.5, 0.25, 7.0], [0.5, 0.25, 7.0], [-1.0, 3.0, 7.0], [2.0, 2.0, 7.0]]
    rows = [(i, v, 1, "a", None) for i, v in enumerate(odd)]
    rows += [(i if i != 102 else None, v, None, None, "b") for i, v in enumerate(good, 100)]
    rows[-1] = (100, *rows[-1][1:])
    out = whiten(spark.createDataFrame(rows, VECTORS)).toPandas()
    assert len(out) == 5 * 3 and set(out.n) == {5} and out.vec_id.isna().sum() == 3
    deviation, _, explained = brute_whitening(good, 3)
    assert sorted(out[out.component == 1].deviation) == sorted(deviation)
    assert np.allclose(sorted(out.explained.unique(), reverse=True), explained, atol=1e-12)
    # Only equal vectors: no component has spread.
    same = whiten(spark.createDataFrame([(i, [1.0, 2.0], 1, "", "") for i in range(4)], VECTORS)).toPandas()
    assert len(same) == 8 and same.whitened.isna().all() and (same.deviation == 0).all() and (same.explained == 0).all()
    assert whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whiten(spark.createDataFrame([(1, None, 1, "", "")], VECTORS)).count() == 0
    huge = whiten(spark.createDataFrame([(1, [1e300, 0.0], 1, "", ""), (2, [-1e300, 1.0], 1, "", "")], VECTORS)).toPandas()
    assert len(huge) == 4 and huge.deviation.isna().all()


# Fingerprints.


def brute_prints(texts, least=2, most=0.02, subsets=16):
    """Fingerprints by their definition, term by term."""
    distinct = [{xxhash.xxh64_intdigest(t.encode()) for t in terms(x)} for x in texts]
    held = Counter(h for d in distinct for h in d)
    highest = max(least, int(most * len(texts)))
    seeds = [xxhash.xxh64_intdigest(b"subset", seed=k) | 1 for k in range(subsets)]

    def one(text):
        hashes = {xxhash.xxh64_intdigest(t.encode()) for t in terms(text)}
        inside = {h for h in hashes if held[h] <= highest}
        if 4 * len(inside) < len(hashes):
            inside = hashes
        level = max(0, len(inside).bit_length() - 1)
        parts, some = [], False
        for each in range(level, level + imatch.LEVELS):
            made = []
            for seed in seeds:
                kept = sorted(h for h in inside if held[h] >= least and (h * seed) % 2**64 >> (64 - each) == 0)
                some |= bool(kept)
                made.append(xxhash.xxh32_hexdigest(np.array(kept, dtype=np.uint64).tobytes()) if kept else "-")
            parts.append(f"{each}:{','.join(made)}")
        whole = xxhash.xxh64_hexdigest(np.array(sorted(hashes), dtype=np.uint64).tobytes())
        return ";".join(parts) if some else f"all:{whole}"

    return one


def check_prints(out, docs):
    """``docs`` are (doc_id, text) in order."""
    texts = [t or "" for _, t in docs]
    one = brute_prints(texts)
    found = {r.doc_id: r for r in out.collect()}
    assert len(found) == len(docs)
    for at, (doc_id, _) in enumerate(docs):
        text, after, row = texts[at], texts[(at + 1) % len(docs)], found[doc_id]
        quarter = len(text) // 4
        edit = text[: len(text) - quarter] + after[:quarter]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (one(text), one(edit))
        assert row.near_edited == likeness(one(text), one(edit)) and row.near_next == likeness(one(text), one(after))


def test_prints_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    given = sorted(tuple(r) for r in docs.collect())
    out = imatch_fingerprints(docs.repartition(3)).persist()
    check_prints(out, given)
    # Edits are known again, other documents are not.
    means = out.selectExpr("avg(near_edited) AS e", "avg(near_next) AS n", "avg(int(near_edited > near_next)) AS more").first()
    assert means.e > 0.4 and means.n < 0.05 and means.more > 0.9
    assert QUERIES["op12_imatch_fingerprints"](spark, SMALL).count() == len(given)


DOCS = "doc_id long, text string, part string, place long, term string, fingerprint string, own int"


def test_prints_of_odd_rows(spark):
    texts = [None, "", " \n\t", "Long " * 30_000, "x", "漢字 😀 é ÉÀ A-b", "same words here", "same words here", "A1 b2 c3 d4", "a1 B2 c3 d4!"]
    rows = [(i * 3 - 4, t, "p", i, "t", None, 1) for i, t in enumerate(texts)]
    rows += [(100 + i, f"one hot text that many rows hold own{i % 3}", None, None, "u", "f", None) for i in range(30)]
    docs = spark.createDataFrame(rows, DOCS)
    out = imatch_fingerprints(docs)
    check_prints(out, [(r[0], r[1]) for r in sorted(rows)])
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[-4].fingerprint == by_id[-1].fingerprint == by_id[2].fingerprint
    assert by_id[14].fingerprint == by_id[17].fingerprint and by_id[14].near_next == 1.0
    assert by_id[20].fingerprint == by_id[23].fingerprint
    repeated = spark.createDataFrame([(None, "a b", *[None] * 5), (7, "c d e f", *[None] * 5), (7, "c d e f", *[None] * 5)], DOCS)
    assert sorted((r.doc_id is None, r.n_chars) for r in imatch_fingerprints(repeated).collect()) == [(False, 7), (False, 7), (True, 3)]
    (alone,) = imatch_fingerprints(spark.createDataFrame([(1, "a b c d", *[None] * 5)], DOCS)).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"a b c a").hexdigest() and alone.near_next == 1.0
    assert imatch_fingerprints(spark.createDataFrame([], DOCS)).count() == 0


# Ranked search.


def brute_search(docs, items, top=50):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    held = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text))
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort()
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(scored[:top], 1)]
    return sorted(out, key=repr)


def test_search_equals_its_sql(spark):
    result = QUERIES["op13_ranked_search"](spark, SMALL)
    assert difference(result, duckdb_over(SMALL), ORACLE["op13_ranked_search"]) == ""


TEXTS = "doc_id long, text string, score string, rank string, width int"
ITEMS = "item_id long, text string, item string"


@pytest.mark.parametrize("sizes", [{}, {"batch": 2, "spread": 1, "at_once": 3}, {"most": 1, "spread": 2, "top": 4}])
def test_search_of_odd_rows(spark, sizes):
    random = np.random.default_rng(8)
    words = [f"w{int(w)}" for w in random.zipf(1.4, size=6000) if w < 3000]
    docs = [(i, " ".join(words[i * 20 : i * 20 + 3 + i % 40])) for i in range(150)]
    docs += [(i, "copy of one text") for i in (907, 903, 905)] + [(11, "w1 w2"), (None, "w1 w1 w77"), (None, None)]
    docs += [(700, None), (701, ""), (702, "!? \n"), (703, "Ünï w1 W2 \x7fw3"), (704, "w5 " * 40_000), (705, "w9 " * 255 + "w8 " * 256)]
    items = [(1, "w1 w2 W2 w3!"), (2, "copy text"), (2, "copy text w9"), (None, "w5 w8 w9"), (3, None), (4, "?"), (5, "nowhere"), (6, "ünï ÜNÏ")]
    frame = spark.createDataFrame([(i, t, "s", None, 1) for i, t in docs], TEXTS).repartition(3)
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    out = sorted((tuple(r) for r in ranked_search(frame, asked, **sizes).collect()), key=repr)
    expected = brute_search(docs, items, sizes.get("top", 50))
    assert out == expected and len({r[1] for r in out}) == max(r[1] for r in out)


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], TEXTS), spark.createDataFrame([(1, "a", "")], ITEMS)
    assert ranked_search(docs, items).count() == 0
    some = spark.createDataFrame([(1, "a b", "", "", 1)], TEXTS)
    assert ranked_search(some, items.limit(0)).count() == 0
    assert ranked_search(spark.createDataFrame([(1, "-", "", "", 1)], TEXTS), items).count() == 0
