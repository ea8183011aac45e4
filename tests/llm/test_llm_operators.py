"""The training-data operators against brute force, on whole small tables and on edge cases."""

from __future__ import annotations

import hashlib
import math
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from checks.compare import difference, duckdb_over
from rollbook.llm import ann, kneser_ney, packing, pieces, pitman_yor, shards, simhash, tokens, toxicity
from rollbook.llm.common import small_batches
from rollbook.llm.kneser_ney import quality_classifier
from rollbook.llm.line_dedup import line_dedup
from rollbook.llm.quality_rules import quality_rules
from rollbook.llm.queries import ORACLE, QUERIES
from rollbook.llm.token_files import map_shard, narrowest, read_token_files, write_token_files

SPACES = " \t\n\x0b\f\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, _hashes string, n_lines int"
EDGES = [
    (1, None, "en", "a", None, "x", None, 1),
    (2, "", None, None, 0, None, "y", 2),
    (3, "same words here", "en", "a", 5, None, None, None),
    (3, "same words here", "en", "a", 5, None, None, None),
    (None, "no id at all", "de", "b", 5, None, None, None),
    (4, " \n\t ", "en", "a", 5, None, None, None),
    (5, "long " * 30_000, "en", "a", 5, None, None, None),
    (6, "a  b\n\n漢字 😀 é<|endoftext|>\x1c\xa0x", "en", "a", 5, None, None, None),
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r[0]: r[1] or "" for r in rows}


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


def words_of(text):
    return text.encode().lower().split()


def test_line_dedup_equals_its_sql(spark):
    result = QUERIES["op3_line_dedup"](spark, SMALL)
    assert difference(result, duckdb_over(SMALL), ORACLE["op3_line_dedup"]) == ""


def test_line_dedup_brute_force_with_many_batches(spark):
    made = [(i, f"own {i}\n Shared X \n" + ("rare\n" if i < 3 else "") + "\n".join(f"k{j}" for j in range(100))) for i in range(12)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    out = {r.doc_id: r for r in line_dedup(docs, min_docs=10, batches=7, fanout=2).collect()}
    for i, text in made:
        kept = [x for x in text.split("\n") if x.startswith(("own", "rare"))]
        assert out[i].text == "\n".join(kept)
        assert out[i].n_dropped == len(text.split("\n")) - len(kept)


def base(text):
    found = [w for w in text.translate({ord(c): 32 for c in SPACES}).split(" ") if w]
    windows = defaultdict(list)
    for i in range(len(found) - 7):
        windows[tuple(found[i : i + 8])].append(i)
    covered = {p + k for at in windows.values() if len(at) > 1 for p in at for k in range(8)}
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_rules_measures(spark, texts):
    made = dict(texts) | {-1: "a b c d e f g h " * 5 + "x\nx\nx"}
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in made.items()], "doc_id long, text string, lang string, source string")
    for row in quality_rules(docs).collect():
        n, chars, symbols, dups, repeats = base(made[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (n, chars, symbols, dups, repeats)
        assert row.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert not (row.base_failed and row.kept)


def test_quality_rules_keep_good_and_drop_junk(spark):
    found = QUERIES["op10_quality_rules"](spark, SMALL).where("NOT base_failed")
    labelled = found.join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id")
    rates = {r.quality: r.k for r in labelled.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rates[1] == 1.0 and rates.get(0, 0) < 0.2


def test_quality_rules_fences_follow_their_group(spark):
    """Each value is common in one source and far out in the other, and below any old constant."""

    def made(i, length, numbers):
        words = [chr(97 + (i * 7 + k * 3) % 26) * (length + (i + k) % 3) for k in range(60 - numbers)]
        return " ".join([*words, *[str(100 + i + k) for k in range(numbers)]])

    rows = [(i, made(i, 3, 0), "en", "short") for i in range(300)]
    rows += [(1000 + i, made(i, 11, 12 + i % 5), "en", "long") for i in range(300)]
    rows += [(2000, made(5, 11, 0), "en", "short"), (2001, made(5, 3, 15), "en", "short")]
    rows += [(2002, made(5, 11, 15), "en", "long"), (2003, made(5, 3, 0) + " $ $ $ $ $", "en", "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules(docs).collect()}
    assert [out.pop(i) for i in range(2000, 2004)] == [(False, False), (False, False), (False, True), (False, False)]
    assert all(kept for failed, kept in out.values() if not failed) and not any(failed for failed, _ in out.values())


def slow_print(text):
    words = words_of(text)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, distance):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(spark, texts):
    prints = {i: slow_print(t) for i, t in texts.items()}
    roots = slow_components(prints, 3)
    for row in QUERIES["op9_simhash_near_dedup"](spark, SMALL).collect():
        assert row.fingerprint == f"{prints[row.doc_id]:016x}"
        assert row.component_id == roots[row.doc_id]


@pytest.mark.parametrize("distance", [1, 3, 5])
@pytest.mark.parametrize("block", [4, 2048])
def test_simhash_links_lose_nothing(spark, monkeypatch, distance, block):
    random = np.random.default_rng(distance)
    centres = [int(x) for x in random.integers(0, 1 << 63, 6)]
    prints = {}
    for i in range(150):
        x = centres[i % 6]
        for b in random.choice(64, random.integers(0, 7), replace=False):
            x ^= 1 << int(b)
        prints[i] = x
    masks = simhash.key_masks(distance)
    for a in prints.values():
        for b in prints.values():
            if (a ^ b).bit_count() <= distance:
                assert any(a & m == b & m for m in masks)
                assert simhash.chained(np.array([a ^ b], dtype=np.uint64), distance)[0]
    for mask in masks[:2]:
        run = np.unique(np.array([x & ~mask & (1 << 64) - 1 for x in prints.values()], dtype=np.uint64))
        monkeypatch.setattr(simhash, "BLOCK", block)
        links = {(int(a), int(b)) for x, y in simhash._links(run, mask, distance) for a, b in zip(x, y, strict=True)}
        near = {(i, j) for i in range(len(run)) for j in range(i + 1, len(run)) if int(run[i] ^ run[j]).bit_count() <= distance}
        assert {tuple(sorted(p)) for p in links} == near


def test_encoders_equal_the_whole_text(texts):
    odd = ["", " ", "\n", "  a  b", "a\n\nb", "a \n b", "\ta b", "a\xa0b \xa0c", "it's. a...b 12,3!", "x<|endoftext|> b", "İ ΑΣ ﬁ", "$$$ a%%%.", "I'LL", ".. a", "\x1ca b", "naïve Straße, œuvre", "Привет мир! мир", "漢字 かな", "cafe\u0301 e\u0301", "ªº ǅ ʰ x²"]
    for name, kind in (("byte_bpe_50k.json", tokens.BYTE_LEVEL), ("word_bpe_49k.json", tokens.SPACE_DROPPED)):
        path = public_tokenizers.path(name)
        whole = Tokenizer.from_file(path)
        many = [*odd, *list(texts.values())[:60]]
        for limit in (5, 10_000):
            for text, ids in zip(many, tokens.Encoder(path, kind, limit).encode(many, at_once=7), strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text[:50]


def test_token_files_round_trip(spark, texts, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    files = write_token_files(docs, path, end_id=2, shard_ids=20_000, width=2, folder=f"file://{tmp_path}")
    whole, start = Tokenizer.from_file(path), 0
    expected = {}
    for i in sorted(texts):
        ids = [*whole.encode(texts[i], add_special_tokens=False).ids, 2]
        expected[i] = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: tuple(r)[1:] for r in read_token_files(files, 2).collect()} == expected
    total = 0
    for row in sorted(files.collect(), key=lambda r: r.base):
        offsets, ids, nulls, numbers = map_shard(row.folder, row.name, 2)
        assert row.folder == str(tmp_path) and (offsets[0], offsets[-1]) == (total, total + row.n_ids) and not nulls.any()
        total += len(numbers)
        for k, i in enumerate(ids.tolist()):
            part = numbers[offsets[k] - offsets[0] : offsets[k + 1] - offsets[0]]
            assert (offsets[k], zlib.crc32(part.astype("<u4").tobytes())) == (expected[i][0], expected[i][2])
    assert total == start
    assert narrowest(path) == 2
    with pytest.raises(ValueError, match="mounted"):
        write_token_files(docs, path, end_id=2, folder="s3a://bucket/files")


def test_packing_is_whole_gapless_and_near_the_bound(spark, texts):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = QUERIES["op2_best_fit_packing"](spark, SMALL).toPandas()
    ids = {i: [*whole.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    for r in rows.itertuples():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.start == r.piece * 2048
        assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r.ids_crc32
    assert rows.groupby("doc_id").length.sum().to_dict() == {i: len(x) for i, x in ids.items()}
    placed = rows.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id").length.cumsum() - placed.length == placed.offset).all()
    assert rows.groupby("sequence_id").length.sum().max() <= 2048
    bound = packing.lower_bound(rows.length.to_numpy(), 2048)
    assert rows.sequence_id.nunique() <= 1.03 * bound


def test_packing_exchange_and_bounds(spark):
    random = np.random.default_rng(3)
    for _ in range(40):
        lengths = random.integers(1, 13, 7)
        best = min_bins(sorted(lengths.tolist(), reverse=True), 12)
        assert packing.lower_bound(lengths, 12) <= best <= packing.best_fit_decreasing(lengths, 12).max() + 1
    docs = spark.createDataFrame([(i, "word " * int(n)) for i, n in enumerate(random.integers(1, 40, 400))], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    split = packing.best_fit_packing(docs, path, capacity=64, partition_rows=40).toPandas()
    alone = packing.best_fit_packing(docs, path, capacity=64, partition_rows=40, rounds=0).toPandas()
    assert len(split) == len(alone) and split.sequence_id.nunique() <= alone.sequence_id.nunique()
    assert split.groupby("sequence_id").length.sum().max() <= 64


def test_packing_holds_few_texts_and_parts(spark, monkeypatch):
    """A task encodes few texts at a time, from small batches, and keeps a bounded table of parts."""

    class Watched:
        def __init__(self, limit):
            self.limit = limit

        def encode(self, texts):
            if len(texts) > 500 or self.limit > 400_000:
                raise ValueError(f"{len(texts)} texts at once, {self.limit} parts")
            return [np.array([len(t)], dtype="<u4").tobytes() for t in texts]

    monkeypatch.setattr(packing, "encoder", lambda path, kind, limit=700_000: Watched(limit))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text")).coalesce(1)
    assert packing.pieces(docs, "none", 2048).where("length = 2").count() == 3000

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"id": [batch.num_rows]})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with small_batches(spark, packing.BATCH_ROWS):
        seen = [r.id for r in spark.range(0, 3000, 1, 1).mapInArrow(sizes, "id long").collect()]
    assert sum(seen) == 3000 and max(seen) <= packing.BATCH_ROWS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_capital_letters_beyond_ascii_share_the_ids_of_small_ones():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, quick = Tokenizer.from_file(path), tokens.Encoder(path, tokens.SPACE_DROPPED)
    letters = [chr(c) for c in range(0x80, 0x250)]
    words = [w for x in letters for w in (x, f"a{x}b", f"{x}X5{x}", f"{x}{x}.")]
    for word, ids in zip(words, quick.encode(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(word, add_special_tokens=False).ids, word


def min_bins(lengths, capacity):
    best = len(lengths)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i, b in enumerate(bins):
            if b + lengths[k] <= capacity:
                place(k + 1, [*bins[:i], b + lengths[k], *bins[i + 1 :]])
        place(k + 1, [*bins, lengths[k]])

    place(0, [])
    return best


def test_nearest_neighbours_recall(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r[0] for r in rows])
    matrix = np.array([r[1] for r in rows], dtype=np.float64)
    found = defaultdict(list)
    for r in QUERIES["op4_nearest_neighbours"](spark, SMALL).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((matrix - matrix[ids == q][0]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        truth = ids[np.lexsort((ids, far))[:10]]
        hits += len(set(truth) & {v for v, _ in found[q]})
        total += len(truth)
        for v, s in found[q]:
            assert s == far[ids == v][0]
    assert hits >= 0.9 * total


def test_nearest_neighbours_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (100, None), (200, [0.0, 0.0]), (300, [nan, 1.0]), (400, [None, 1.0]), (5, [3.0]), (None, [1.0, 1.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = ann.nearest(docs, F.col("vec_id") % 100 == 0, k=10).orderBy("rank").collect()
    assert [tuple(r) for r in out] == [(0, 1, 1, 0.0), (0, 2, 2, 0.0)]
    assert ann.nearest(docs.where("false"), F.lit(True)).collect() == []
    again = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 3.0]), (1, [1.0, 1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    found = sorted(tuple(r)[1:] for r in ann.nearest(again, F.col("vec_id") == 0, k=10, leaf_rows=1).collect())
    # Both rows of id 0 ask, and each has the other among its candidates.
    assert found == [(1, 1, 1.0), (1, 2, 1.0), (2, 1, 2.0), (2, 2, 2.0), (3, 0, 3.0), (3, 0, 3.0)]


def test_pieces_equal_brute_force_and_come_back(spark, texts):
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    table = {p: model.scores[i] for i, (p, _) in enumerate(model.pieces) if p and not model.bytes_from <= i < model.bytes_from + 256}
    coder = pieces.Codec(model)
    some = ["", "a", "  two  spaces ", "漢字 😀\n\ttab", "naïve Straße", *[t[:300] for t in list(texts.values())[:25]]]
    for text, ids in zip(some, coder.encode([t.encode() for t in some]), strict=True):
        assert coder.decode(ids).decode() == text
        marked = "▁" + text.replace(" ", "▁") if text else ""
        best = [0.0] + [-math.inf] * len(marked)
        for end in range(1, len(marked) + 1):
            for start in range(max(0, end - 20), end):
                score = table.get(marked[start:end].encode())
                if score is None and end - start == 1:
                    score = model.penalty
                if score is not None:
                    best[end] = max(best[end], best[start] + score)
        numbers = np.frombuffer(ids, "<u4").astype(int)
        byte = (numbers >= model.bytes_from) & (numbers < model.bytes_from + 256)
        leads = byte & ((numbers - model.bytes_from) & 0xC0 != 0x80)
        assert math.isclose(model.scores[numbers[~byte]].sum() + model.penalty * leads.sum(), best[-1])
    assert QUERIES["op6_sentence_pieces"](spark, SMALL).where("NOT round_trip").count() == 0


def test_pitman_yor_base_counts_and_gain(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op7_pitman_yor"](spark, SMALL).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    tokens_of = {i: [*words_of(t), 0] for i, t in texts.items()}
    counts = Counter(w for i, t in tokens_of.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    gain = 0.0
    for i, t in tokens_of.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(counts[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t))
        assert r.score < 0
        gain += (r.score - r.base_score) * held[i]
    assert gain > 0


def test_pitman_yor_is_a_probability_and_equals_plain_formulas(spark, texts):
    """From the tables the blocks drew: masses of 1 in every context and sample, and the scores."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(150).repartition(3)
    with shards.Kept(spark) as kept:
        state, model = pitman_yor.trained(docs, kept, 7, 2, 2, 3, 2, 4000, 3000, 11)
        rows = state.collect()
    assert len(rows) > 3 and len(model["tables"]) == 3
    pairs, words = {}, {}
    for row in rows:
        block = shards.block_of(row, "pairs", "words", "drawn")
        p = pitman_yor.Pairs(block)
        counts, hashes = pitman_yor.unpack_uint(block.carried["pairs"]), p.hashes.tolist()
        context, opened, got, seated = pitman_yor._by_sample(pitman_yor._word_parts(block.carried["words"])[1:])
        for i, h in enumerate(hashes):
            own = (context[i], *[c[i] for c in (*opened, *got, *seated)])
            assert words.setdefault(h, own) == own  # the same in every block
        tables = pitman_yor.drawn_tables(p, counts, block.carried["drawn"], model["draw"])
        for u, w, c, *t in zip(p.first, p.second, counts, *tables, strict=True):
            own = (c, *t)
            assert pairs.setdefault((hashes[u], hashes[w]), own) == own
            assert all(min(c, 1) <= x <= c for x in t)
    vocabulary = [h for h, own in words.items() if own[4] > 0]
    assert len(vocabulary) == model["vocabulary"]
    by_context = defaultdict(list)
    for (u, w), own in pairs.items():
        if own[0]:
            by_context[u].append((w, own))
    chance = []
    for k in range(3):
        got, seated = ({h: own[4 + 3 * m + k] for h, own in words.items()} for m in (0, 1))
        assert sum(got.values()) == model["tables"][k] and sum(seated.values()) == model["top_seated"][k]
        assert all(min(got[h], 1) <= seated[h] <= got[h] for h in got)
        d, strength, total = model["top_discount"][k], model["top_strength"], model["tables"][k]
        fresh = (strength + d * sum(seated.values())) / (strength + total)

        def below(h, got=got, seated=seated, d=d, strength=strength, total=total, fresh=fresh):
            own = (got[h] - d * seated[h]) / (strength + total) if h in got else 0.0
            return own + fresh / (len(vocabulary) + 1)

        assert math.isclose(sum(below(h) for h in vocabulary) + below(None), 1, abs_tol=1e-9)

        def over(u, w, k=k, below=below):
            customers = words[u][0]
            if not customers:
                return below(w)
            c, *t = pairs.get((u, w), (0, 0, 0, 0))
            strength = model["strength"][min(int(math.log2(customers)), pitman_yor.CLASSES - 1)]
            rest = (strength + model["discount"] * words[u][1 + k]) * below(w)
            return (c - model["discount"] * t[k] + rest) / (strength + customers)

        backed = sum(below(h) for h in vocabulary) + below(None)
        for u, seen in by_context.items():
            others = backed - sum(below(w) for w, _ in seen)
            # Words not seen after u have its share of the parent, whatever they are.
            share = over(u, None) / below(None)
            assert math.isclose(sum(over(u, w) for w, _ in seen) + share * others, 1, abs_tol=1e-9)
        chance.append(over)
    found = {r.doc_id: r.score for r in pitman_yor.pitman_yor_scores(docs, block_words=4000, shard_words=3000).collect()}
    assert len(found) == 150
    for i, score in found.items():
        hashes = [0, *[xxhash.xxh64_intdigest(w) for w in words_of(texts[i])], 1]
        plain = sum(math.log10(sum(c(u, w) for c in chance) / 3) for u, w in zip(hashes, hashes[1:], strict=False))
        assert math.isclose(score, plain, rel_tol=1e-9)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(("pitman_yor", "ngram_blocks", "quality_blocks"))]


def test_pitman_yor_seating_follows_the_restaurant():
    """The sampled tables of one pair have the distribution of exhaustive seating."""
    discount, weight, customers = 0.6, 0.7, 6
    exact = defaultdict(float)

    def seat(sizes, chance):
        if sum(sizes) == customers:
            exact[len(sizes)] += chance
            return
        for k, s in enumerate(sizes):
            seat([*sizes[:k], s + 1, *sizes[k + 1 :]], chance * (s - discount))
        seat([*sizes, 1], chance * weight)

    seat([1], 1.0)
    total = sum(exact.values())
    many = 20_000
    keys = np.arange(1, many + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    now = None
    for k in range(12):
        now = pitman_yor.sweep(keys, np.full(many, customers), np.full(many, weight), discount, 50 + k, now)
    for t, p in exact.items():
        assert abs((now[0] == t).mean() - p / total) < 0.015


def test_pitman_yor_draws_pairs_where_they_are_needed(monkeypatch):
    """Pairs of others are not drawn, frequent ones not again for the next block, and nothing changes."""
    rng = np.random.default_rng(8)
    places = np.minimum(rng.zipf(1.4, 30_000) - 1, 400)
    block = shards.Block(0, b"", np.zeros(3, dtype=np.uint8), np.full(3, 10_000), places, rng.integers(2, 1 << 62, 401).astype(np.uint64))
    p = pitman_yor.Pairs(block)
    codes = p.first * 1000 + p.second
    assert (np.diff(codes) > 0).all() and (codes[p.pair_at] % 1000 == p.word_at).all() and len(p.keys) == len(codes)
    counts = p.training
    assert counts.sum() == 30_003 and (counts > 32).sum() > 50
    n = len(p.hashes)
    opened = np.bincount(p.first, minlength=n)
    model = {"discount": 0.6, "strength": np.full(pitman_yor.CLASSES, 3.0)}
    args = p, counts, np.bincount(p.first, weights=counts, minlength=n).astype(int), opened, np.full(n, 1 / n), model, 7, 3, 2
    drawn = []
    sweep = pitman_yor.sweep
    monkeypatch.setattr(pitman_yor, "sweep", lambda keys, *rest: drawn.append(len(keys)) or sweep(keys, *rest))
    whole = pitman_yor._samples(*args)
    assert set(drawn) == {(counts > 1).sum()}
    drawn.clear()
    mine = np.arange(len(counts)) % 5 == 0
    assert (pitman_yor._samples(*args, mine)[:, mine] == whole[:, mine]).all()
    assert set(drawn) == {(counts[mine] > 1).sum()}
    known = pitman_yor.Remembered(limit=40)
    for again in (0, 40, 40):
        drawn.clear()
        assert (pitman_yor._samples(*args, known=known) == whole).all()
        assert set(drawn) == {(counts > 1).sum() - again} and len(known.keys) == 40


def test_pitman_yor_gaps_keep_the_normalizers():
    """Seating by gaps gives tables and normalizers of its plain form, pair by pair."""
    keys = np.arange(1, 41, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    customers, weight, discount = np.geomspace(40_000, 33, 40).astype(int), np.linspace(0.01, 30, 40), 0.7
    tables, norms = pitman_yor.seat(keys, customers, weight, discount, 5)
    for i in range(40):
        step, t, norm, a = 5 << 32, 1.0, 0.0, weight[i]
        for seated in range(1, 32):
            total = a + seated - discount * t
            norm += math.log(total)
            t += pitman_yor._uniform(keys[i : i + 1], step + seated)[0] * total < a
        seated = 32.0
        while seated < customers[i]:
            step += 64
            x = seated - discount * t
            far = math.expm1(min(700.0, -math.log(pitman_yor._uniform(keys[i : i + 1], step)[0]) / a))
            gap = math.floor(max(x + (a - 1) / 2, 0.5) * far)
            moved = min(gap + 1, customers[i] - seated)
            norm += math.lgamma(a + x + moved) - math.lgamma(a + x)
            t += gap < customers[i] - seated
            seated += moved
        assert t == tables[i] and math.isclose(norm, norms[i], rel_tol=1e-8)


def test_exchanged_keys_come_back_and_take_less_room():
    keys = np.sort(np.random.default_rng(2).integers(0, 1 << 64, 200_000, dtype=np.uint64))
    cuts, sizes = shards._cut(keys, 50), []
    for shard in range(50):
        mine = keys[cuts[shard] : cuts[shard + 1]]
        data, width = shards._keys_out(mine, 50, shard, False)
        assert width == 8 and (shards._keys_in(data) == mine).all()
        data, width = shards._keys_out(mine, 50, shard, True)
        first = -(-(shard << 64) // 50)
        shift = (-(-(1 << 64) // 50)).bit_length() - 48
        assert width == 6 and shards._keys_in(data).tolist() == [(k - first) >> shift for k in mine.tolist()]
        sizes.append(len(data))
    assert sum(sizes) < 5.2 * len(keys)


def test_pieces_of_single_parts_and_of_long_ones():
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(5)
    letters = list("abcdeénst▁.7") + ["中", "文", "字", "\U0001f600", "ß", "\x01"]
    parts = [("▁" + "".join(rng.choice(letters, rng.integers(0, 14)))).encode() for _ in range(600)]
    for length in {len(p) for p in parts}:
        same = [p for p in parts if len(p) == length]
        assert model._paths(same, length) == [model.path(p) for p in same]
    codec = pieces.Codec(model)
    text = "".join(rng.choice(list("中文字的一是不了人我在有他这"), 340_000)).encode()  # 1 MB without a space
    began = time.process_time()
    ids = codec.encode([text, b"a b"])
    assert time.process_time() - began < 20
    assert codec.decode(ids[0]) == text
    assert all(len(p) <= codec.LONGEST for p in codec.known) and b"a" in codec.known
    assert model.segment([text[:3000]]) == model._paths([text[:3000]], 3000)


def test_decoding_restores_obfuscated_words():
    plain = [b"you are an idiot and a loser", b"such a stupid moron", b"the idiot is a loser"] * 30
    model = toxicity.character_model(toxicity.trigram_counts(plain))
    for written, meant in (("1d10t", "idiot"), ("l0s3r", "loser"), ("idiooot", "idiot"), ("i.d.i.o.t", "idiot"), ("$tup1d", "stupid"), ("m-o-r-0-n!", "moron")):
        assert toxicity.decode(written, model) == meant
    reader = toxicity.Reader(model)
    assert {"idiot", "you"} <= reader.words(b"you i d 1 o t here")
    assert reader.words(b"plain words, stay. 12 45.2") >= {"plain", "words", "stay"}


def test_reader_reads_what_the_ends_and_doubled_letters_hide():
    plain = [b"you are an idiot and a loser", b"such a stupid moron", b"what an ass, a clown", b"shit, a total loss"] * 30
    reader = toxicity.Reader(toxicity.character_model(toxicity.trigram_counts(plain)))
    forms = {
        "a$$": "ass", "lo$$": "loss", "a$$!": "ass", "!diot": "idiot", "(lown": "clown", "(lown)": "clown", "$#!7": "shit", "455": "ass",
        "iddiot": "idiot", "stuupid": "stupid", "assss": "ass", "idiot###": "idiot", "idiot!!": "idiot", "moron&&&": "moron",
        "(loser)": "loser", "1diot***": "idiot", "!diot!!": "idiot", "loss.": "loss",
    }
    for written, meant in forms.items():
        assert meant in reader.words(f"you {written} there".encode()), written
    assert {"45", "..", "%%%"} & reader.words(b"45 .. %%% $$$ | -") == {"45", "%%%"}


def test_reader_finds_the_ends_of_spaced_words():
    plain = [b"you are a loser and an idiot", b"i am a stupid moron", b"the idiot is a loser", b"to be or not to be"] * 30
    reader = toxicity.Reader(toxicity.character_model(toxicity.trigram_counts(plain)))
    forms = {
        "you are a l o s e r": {"loser"}, "s t u p i d m o r o n": {"stupid", "moron"}, "l  o\ts\n e r": {"loser"},
        "an id iot": {"idiot"}, "mo ron": {"moron"}, "you i d 1 0 t here": {"idiot"}, "i d i o t, you": {"idiot"},
    }
    for written, meant in forms.items():
        assert meant <= reader.words(written.encode()), written
    assert reader.words(b"to be or not to be") == {"to", "be", "or", "not"}


def readings_by_brute_force(core, model):
    """The best score of every reading of ``core``, over all paths."""
    paths = [("", 0.0)]
    for c in core:
        letters, nothing = toxicity._written(c)
        after = []
        for text, score in paths:
            a, b = [0, 0, *[toxicity._PLACE[x] for x in text]][-2:]
            for letter, place, cost in letters:
                after.append((text + letter, score - cost + model[a, b, place]))
                if text and letter == text[-1] != " ":
                    after.append((text, score - toxicity.COST_REPEAT))
            if nothing is not None:
                after.append((text, score - nothing))
        paths = after
    best = {}
    for text, score in paths:
        a, b = [0, 0, *[toxicity._PLACE[x] for x in text]][-2:]
        best[text] = max(best.get(text, -np.inf), score + model[a, b, 0])
    return best


def test_the_lattice_has_no_better_path():
    plain = [b"you are an idiot and a loser", b"such a stupid moron", b"the idiot is a loser"] * 30
    model = toxicity.character_model(toxicity.trigram_counts(plain))
    for core in ("1d10t", "l00s3r", "i.d.i.0t", "$tuup1d", "m o r 0 n", "!!d1*t", "a $ s", "1|1+", "55"):
        best = readings_by_brute_force(core, model)
        found = toxicity.viterbi(core, model.ravel().tolist())
        assert best[found] >= max(best.values()) - 1e-9, core


def test_long_lattices_settle_and_take_time_by_length(monkeypatch):
    plain = [b"you are an idiot and a loser", b"such a stupid moron", b"the idiot is a loser"] * 30
    model = toxicity.character_model(toxicity.trigram_counts(plain))
    text = "i d 1 0 t 7 3 " * 60
    whole = toxicity.viterbi(text, model.ravel().tolist())
    for size in (1, 2, 7, 100):
        monkeypatch.setattr(toxicity, "SETTLE", size)
        assert toxicity.viterbi(text, model.ravel().tolist()) == whole
    monkeypatch.undo()
    times = []
    for n in (10_000, 80_000):
        digits = " ".join("1234567890"[i * 7 % 10] for i in range(n)).encode()
        reader, began = toxicity.Reader(model), time.process_time()
        reader.words(digits)
        times.append(time.process_time() - began)
        assert all(len(k) <= reader.LONGEST for kept in (reader.known, reader.windows, reader.stretches, reader.tails) for k in kept)
    assert times[1] < 24 * times[0]  # eight times the text; quadratic would be 64


def test_a_filtered_reader_gives_the_wanted_words_alone():
    plain = [b"you are an idiot and a loser", b"such a stupid moron", b"the idiot is a loser"] * 30
    model = toxicity.character_model(toxicity.trigram_counts(plain))
    lexicon = {"idiot", "stup~", "loser~", "moron"}
    texts = ["you 1d10t and $tup1d", "a m o r o n here", "loserly l0sers", "nothing", "", "stup stupi"]
    matches = toxicity._matcher(lexicon)
    for text in texts:
        everything = toxicity.Reader(model).words(text.encode())
        wanted = {w for w in everything if any(f in lexicon for f in toxicity.features(w))}
        assert toxicity.Reader(model, wanted=matches).words(text.encode()) == wanted


def test_toxicity_on_held_out(spark):
    folder = SMALL.replace("0.001", "0.01")
    found = QUERIES["op1_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.94
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_quality_classifier_keeps_trusted_text(spark):
    folder = SMALL.replace("0.001", "0.01")
    found = QUERIES["op5_quality_classifier"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rates = {r.quality: r.k for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rates[1] > 0.985 and rates[0] < 0.15


def kneser_ney_by_brute_force(trained):
    """The probability of a 4-gram under an interpolated modified Kneser-Ney model, with plain dicts."""
    levels = {4: Counter(g for text in trained for g in grams_of(text))}
    for order in (3, 2, 1):
        levels[order] = Counter(g[1:] for g in levels[order + 1])
    cuts, totals, left = {}, {}, {}
    for order, counts in levels.items():
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        cut = [(k + 1) - (k + 2) * y * n[k + 2] / n[k + 1] if n[k + 1] and n[k + 2] else (k + 1) / 2 for k in range(3)]
        cuts[order] = [min(max(d, 0.05), k + 0.95) for k, d in enumerate(cut)]
        totals[order], left[order] = Counter(), Counter()
        for gram, c in counts.items():
            totals[order][gram[:-1]] += c
            left[order][gram[:-1]] += cuts[order][min(c, 3) - 1]

    def chance(gram):
        p = 1 / (len(levels[1]) + 1)
        for order in (1, 2, 3, 4):
            g = gram[4 - order :]
            if totals[order][g[:-1]]:
                c = levels[order][g]
                own = c - cuts[order][min(c, 3) - 1] if c else 0.0
                p = (own + left[order][g[:-1]] * p) / totals[order][g[:-1]]
        return p

    return chance


def grams_of(text):
    chars = [kneser_ney.START] * 3 + [ord(c) for c in text] + [kneser_ney.END]
    return [tuple(chars[i : i + 4]) for i in range(len(chars) - 3)]


def test_quality_scores_and_thresholds_by_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    upper, prior, least = 0.8, 50, 5
    found = quality_classifier(docs, labels, prior=prior, upper=upper, least=least, block_chars=20_000).collect()
    trusted = {r.doc_id for r in labels.where("quality = 1").collect()}
    rows = docs.withColumn("fifth", F.expr("pmod(xxhash64(doc_id), 5)")).collect()
    chance = kneser_ney_by_brute_force([r.text or "" for r in rows if r.doc_id in trusted and r.fifth != 4])
    known = {}
    totals = {}
    for r in rows:
        grams = grams_of(r.text or "")
        totals[r.doc_id] = (len(grams), -sum(known.get(g) or known.setdefault(g, math.log10(chance(g))) for g in grams))
    calibrating = [r for r in rows if r.doc_id in trusted and r.fifth == 4]
    by_lang = defaultdict(list)
    for r in calibrating:
        by_lang[r.lang].append(r.doc_id)

    def mean(ids):
        return sum(totals[i][1] for i in ids) / sum(totals[i][0] for i in ids)

    everyone = [r.doc_id for r in calibrating]
    assert any(len(ids) >= least for ids in by_lang.values())
    values = {}
    for r in rows:
        middle = mean(by_lang[r.lang] if len(by_lang[r.lang]) >= least else everyone)
        values[r.doc_id] = (totals[r.doc_id][1] + prior * middle) / (totals[r.doc_id][0] + prior)
    assert len(found) == len(rows)
    for r in found:
        ids = by_lang[r.lang] if len(by_lang[r.lang]) >= least else everyone
        threshold = sorted(values[i] for i in ids)[math.ceil(upper * len(ids)) - 1]
        assert r.n_grams == totals[r.doc_id][0]
        assert abs(r.log_perplexity - values[r.doc_id]) < 1e-5
        assert abs(r.threshold - threshold) < 1e-5
        assert r.kept == (r.log_perplexity <= r.threshold)
        assert r.kept == (values[r.doc_id] <= threshold) or abs(values[r.doc_id] - threshold) < 1e-5


def test_quality_classifier_learns_from_every_trusted_row(spark):
    # More trusted rows than the 20,000 that were once taken.
    texts = [chr(97 + i % 26) + chr(97 + i // 26 % (1 + i % 7)) for i in range(22_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    found = {r.doc_id: r for r in quality_classifier(docs, labels, prior=0, upper=1.0, least=1).collect()}
    fifth = {r.doc_id: r.f for r in docs.select("doc_id", F.expr("pmod(xxhash64(doc_id), 5)").alias("f")).collect()}
    chance = kneser_ney_by_brute_force([t for i, t in enumerate(texts) if fifth[i] != 4])
    assert len(found) == len(texts) and all(r.kept for i, r in found.items() if fifth[i] == 4)
    for i in range(0, len(texts), 37):
        grams = grams_of(texts[i])
        assert abs(found[i].log_perplexity + sum(math.log10(chance(g)) for g in grams) / len(grams)) < 1e-5


@pytest.mark.parametrize("empty", [False, True])
def test_edge_cases(spark, edges, labels, empty):
    docs = edges.where("false") if empty else edges
    n = 0 if empty else len(EDGES)
    byte, word = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    piece = public_tokenizers.path("piece_bpe_32k.model")
    results = {
        "toxicity": toxicity.toxicity(docs, labels),
        "lines": line_dedup(docs, min_docs=2),
        "classifier": quality_classifier(docs, labels),
        "pieces": pieces.piece_digests(docs, piece),
        "pitman_yor": pitman_yor.pitman_yor_scores(docs, block_words=1000),
        "files": read_token_files(write_token_files(docs, byte, end_id=2)),
        "simhash": simhash.simhash_near_dedup(docs),
        "rules": quality_rules(docs),
    }
    for name, df in results.items():
        assert len(df.collect()) == n, name
    packed = packing.best_fit_packing(docs, word).collect()
    assert len({(r.doc_id, r.piece) for r in packed}) == (0 if empty else len({(e[0], 0) for e in EDGES}) + 14)
    kept = simhash.keep_one(docs).collect()
    assert len(kept) == (0 if empty else 5)
    if not empty:
        prints = {r.doc_id: r for r in results["simhash"].collect()}
        assert prints[1].component_id == prints[2].component_id == prints[4].component_id == 1
        assert prints[1].fingerprint == "0" * 16
        lines = {r.doc_id: r for r in results["lines"].collect()}
        assert (lines[1].n_lines, lines[1].text, lines[1].n_dropped) == (1, "", 0)
        assert set(results["lines"].columns) == set(docs.columns) | {"n_lines", "n_dropped"}


def test_sha_of_kept_text(spark, texts):
    rows = QUERIES["op3_line_dedup"](spark, SMALL).where("n_dropped = 0").collect()
    for r in rows:
        assert r.kept_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
