"""Scoring texts with a hierarchical Pitman-Yor bigram model, seated by Gibbs sampling.

Every word that precedes others has a restaurant: its customers are the words that follow it. All
these context restaurants share one parent, whose customers are the tables of theirs, and the
parent's own base is uniform over the V distinct training words and one unseen word. A text's
words and its end are predicted in turn, the first from the start of text.

Counts come from all training documents through ``shards.exchange``: blocks of documents ask
shards of hashed word pairs for the corpus counts. A pair seen once has one table, so only pairs
seen twice or more are sampled. A Gibbs sweep takes one pair's customers out and seats them again,
one after another, each at an old table by its size less the discount or at a new one by the
strength, the restaurant's tables and the parent's probability of the word, all others held. The
parent's customers are seated alike, in the word's shard, where all of them meet. That
proposal's weights depend on the seating, so it is accepted by Metropolis-Hastings. The random
numbers are a hash of the pair and the step: any block that holds a pair samples the same tables
for it, and one block, the pair's owner, reports them. Between rounds the blocks exchange, per word,
the tables it opened as a context and those it got as a word; within a round these are held, as in
approximate distributed Gibbs sampling. The strengths are drawn by griddy Gibbs steps, one for each
size class of contexts, the discounts are set from the counts of counts.

The score averages the predictive probabilities of the kept samples of the last round, each with the
seatings that made its table counts and its own parent, so that those of a context add up to 1.

Defined cases: a null or empty text is its end alone; a null ``doc_id`` is training text; rows with
equal ids are scored each; other columns are not read; without training text every word has the
uniform base; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import held_out, pack, pack_uint, unpack, unpack_uint
from rollbook.llm.shards import BLOCK, END, START, Block, Kept, block_of, exchange, ids_in, mixed, sums, write_blocks
from rollbook.session import written

#: Strengths to choose from, and size classes of contexts (by the power of two of their customers).
STRENGTHS = np.array([0.1, 0.3, 1, 3, 10, 30, 100, 300, 1000, 3000], dtype=float)
CLASSES = 24


def word_list(text: bytes) -> list[bytes]:
    return text.lower().split()


class Pairs:
    """A block's words and word pairs: ``keys`` of distinct pairs with the words they join."""

    def __init__(self, block: Block):
        self.block = block
        n = len(block.hashes)
        ends = np.cumsum(block.lengths)
        starts = ends - block.lengths
        # Words are numbered from 2; 0 stands before each document, 1 ends it.
        size = len(block.places) + len(block.lengths)
        second = np.empty(size, dtype=np.int32)
        first = np.empty(size, dtype=np.int32)
        shift = np.arange(len(block.lengths), dtype=np.int32)
        at_end = ends + shift
        inside = np.ones(size, dtype=bool)
        inside[at_end] = False
        second[inside] = block.places + 2
        second[at_end] = 1
        first[1:] = second[:-1]
        first[starts + shift] = 0
        self.document = np.repeat(shift, block.lengths + 1)
        self.hashes = np.concatenate([[START, END], block.hashes])
        self.trains = (block.flags == 0)[self.document]
        distinct, self._places = _distinct(first.astype(np.int64) * (n + 2) + second, (n + 2) ** 2)
        self.first, self.second = distinct // (n + 2), distinct % (n + 2)
        self.word_at = second

    @cached_property
    def pair_at(self) -> np.ndarray:
        """The pair of each token."""
        return self._places()

    @cached_property
    def training(self) -> np.ndarray:
        """How often each pair is in training text."""
        return np.bincount(self.pair_at, weights=self.trains, minlength=len(self.first)).astype(np.int64)

    @cached_property
    def words(self) -> np.ndarray:
        """How often each word is in training text."""
        return np.bincount(self.word_at, weights=self.trains, minlength=len(self.hashes)).astype(np.int64)

    @cached_property
    def _mixed(self) -> np.ndarray:
        return mixed(self.hashes[self.first], self.hashes[self.second])

    @cached_property
    def order(self) -> np.ndarray:
        return np.argsort(self._mixed)

    @property
    def keys(self) -> np.ndarray:
        return self._mixed[self.order]

    def by_key(self, values: np.ndarray) -> np.ndarray:
        return values[self.order]

    def by_pair(self, answered: np.ndarray) -> np.ndarray:
        out = np.empty(len(answered), dtype=answered.dtype)
        out[self.order] = answered
        return out

    def word_keys(self) -> tuple[np.ndarray, np.ndarray]:
        return word_keys(self.hashes)


def word_keys(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Well mixed word hashes in order, and the order."""
    keys = mixed(hashes, hashes)
    order = np.argsort(keys)
    return keys[order], order


def word_order(block: Block) -> np.ndarray:
    """The order of ``word_keys`` for all words of a block."""
    return word_keys(np.concatenate([[START, END], block.hashes]))[1]


def _distinct(codes: np.ndarray, above: int) -> tuple[np.ndarray, Callable[[], np.ndarray]]:
    """The distinct codes in order, and a function that gives the place of each code among them.

    Code and position share one number where they fit: numbers are sorted several times faster than
    positions by number."""
    bits = max(1, len(codes).bit_length())
    if not len(codes) or above >> (64 - bits):
        distinct, places = np.unique(codes, return_inverse=True)
        return distinct, lambda: places
    both = codes.astype(np.uint64)
    both <<= np.uint64(bits)
    both |= np.arange(len(codes), dtype=np.uint64)
    both.sort()
    at = (both & np.uint64((1 << bits) - 1)).astype(np.int32)
    both >>= np.uint64(bits)
    ordered = both.view(np.int64)
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])

    def places() -> np.ndarray:
        out = np.empty(len(at), dtype=np.int32)
        out[at] = np.cumsum(fresh, dtype=np.int32) - 1
        return out

    return ordered[fresh], places


def _uniform(keys: np.ndarray, step: int | np.ndarray) -> np.ndarray:
    value = mixed(keys, np.asarray(step, dtype=np.uint64))
    value >>= np.uint64(11)
    out = value.astype(float)
    out /= 1 << 53
    out += 1e-17
    return out


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series; used from 16 on."""
    part = 1 / x
    return (x - 0.5) * np.log(x) - x + part * (1 / 12 - part * part / 360)


#: Pairs whose customers are seated singly side by side: their arrays stay in the processor's cache.
CHUNK = 8192
#: Pairs whose tables are drawn side by side. Few pairs have many tables, so here more are better.
WIDE = 1 << 17
#: Draws made at once, for all pairs together, where that many pairs are not left.
DRAWS = 16384


def seat(keys: np.ndarray, customers: np.ndarray, weight: np.ndarray, discount: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables of each pair after seating its customers in turn, and the log of the proposal's
    normalizers, by which it is accepted. Pairs come with falling ``customers``, so that those still
    being seated are the first ones.

    The first 32 customers are seated one by one. Beyond, the number of customers until the next
    new table is drawn at once: none of the next k opens one with probability
    ``((x + h) / (x + k + h)) ** weight``, x = seated less discounts and h = (weight - 1) / 2, which
    is the ratio of gamma functions up to terms of 1 / x**2. So a pair costs its tables, not its
    customers.
    """
    tables = np.ones(len(customers))
    log_norm = np.zeros(len(customers))
    step = seed << 32
    columns = keys, customers, weight, tables, log_norm
    for at in range(0, len(customers), CHUNK):
        _seat_singly(*(c[at : at + CHUNK] for c in columns), discount, step)
    many = int(np.searchsorted(-customers, -32))
    for at in range(0, many, WIDE):
        _seat_by_gaps(*(c[at : min(at + WIDE, many)] for c in columns), discount, step)
    return tables, log_norm


def _seat_singly(keys, customers, weight, tables, log_norm, discount: float, step: int) -> None:  # noqa: ANN001
    """The customers up to the 32nd; ``tables`` and ``log_norm`` are written."""
    seats = np.arange(1, min(32, int(customers[0])))
    norms = np.ones(len(customers))
    for seated, live in zip(seats.tolist(), np.searchsorted(-customers, -seats).tolist(), strict=True):
        now = tables[:live]
        norm = weight[:live] + seated
        norm -= discount * now
        norms[:live] *= norm
        norm *= _uniform(keys[:live], step + seated)
        now += norm < weight[:live]
        if seated % 8 == 0:
            # Before the products grow too large.
            log_norm[:live] += np.log(norms[:live])
            norms[:live] = 1
    log_norm += np.log(norms)


def _seat_by_gaps(keys, customers, weight, tables, log_norm, discount: float, step: int) -> None:  # noqa: ANN001
    """The customers from the 33rd on. The fewer pairs are left, the more draws are made at once: a
    pair that has all its customers seated lets the rest of its draws pass.

    The normalizers of a gap are a ratio of gamma functions. Where one gap ends above w and the next
    begins at w less the discount, both make d * log(s), s = w - (1 + d) / 2, and a term of 1 / s**2
    and one of 1 / s**4; so the sum is over the tables, between the first and the last gamma function.
    """
    e = discount / 2
    second, fourth = (e / 4 - e**3) / 3, -(e**5 - 5 * e**3 / 6 + 7 * e / 48) / 10
    log_norm -= _log_gamma(weight + (32.0 - discount * tables))
    live, seated = np.arange(len(customers)), np.full(len(customers), 32.0)
    while len(live):
        key, a, all_seats, now = keys[live], weight[live], customers[live], tables[live]
        h, base, power = (a - 1) / 2, a - (1 + discount) / 2, -np.maximum(a, 1e-12)
        left, gap, ended = np.empty_like(a), np.empty_like(a), np.zeros(len(a), dtype=bool)
        logs = np.zeros_like(a)
        draws = max(1, min(64, DRAWS // len(live)))
        # Those that have ended are let go once there are some of them.
        while np.count_nonzero(ended) * 8 <= len(live):
            steps = np.arange(1, draws + 1, dtype=np.uint64) * np.uint64(64) + np.uint64(step)
            step += 64 * draws
            s, opened = np.empty((draws, len(a))), np.empty((draws, len(a)), dtype=bool)
            with np.errstate(over="ignore"):
                jump = np.log(_uniform(key, steps[:, None]))
                jump /= power
                np.expm1(jump, out=jump)
                for x, opens, far in zip(s, opened, jump, strict=True):
                    np.multiply(now, discount, out=x)
                    np.subtract(seated, x, out=x)
                    np.add(x, h, out=gap)
                    np.maximum(gap, 0.5, out=gap)
                    np.multiply(gap, far, out=gap)
                    np.floor(gap, out=gap)
                    np.add(gap, 1, out=gap)
                    np.subtract(all_seats, seated, out=left)
                    np.less_equal(gap, left, out=opens)
                    np.minimum(gap, left, out=gap)
                    np.add(now, opens, out=now)
                    np.add(seated, gap, out=seated)
                    np.add(x, gap, out=x)
            s += base
            part = np.log(s)
            part *= discount
            s *= s
            np.divide(1, s, out=s)
            part += s * (second + fourth * s)
            part *= opened
            logs += part.sum(axis=0)
            np.greater_equal(seated, all_seats, out=ended)
        log_norm[live] += logs
        tables[live] = now
        keep = ~ended
        live, seated = live[keep], seated[keep]
    log_norm += _log_gamma(weight + (customers - discount * tables))


def sweep(
    keys: np.ndarray, customers: np.ndarray, weight: np.ndarray, discount: float, seed: int,
    now: tuple[np.ndarray, np.ndarray] | None,
) -> tuple[np.ndarray, np.ndarray]:
    """One Gibbs sweep over pairs: a new seating each, kept or refused."""
    tables, norm = seat(keys, customers, weight, discount, 2 * seed)
    if now is None:
        return tables, norm
    take = np.log(_uniform(keys, (2 * seed + 1) << 32)) < norm - now[1]
    return np.where(take, tables, now[0]), np.where(take, norm, now[1])


def _samples(
    pairs: Pairs, counts: np.ndarray, context: np.ndarray, opened: np.ndarray, parent: np.ndarray,
    model: dict, seed: int, samples: int, burn_in: int, mine: np.ndarray | None = None, known: Remembered | None = None,
) -> np.ndarray:
    """Tables of every pair in each kept sample; of pairs outside ``mine``, where given, one each."""
    where = _seated(counts, counts > 1 if mine is None else (counts > 1) & (mine > 0))
    out = np.repeat(np.minimum(counts, 1)[None, :], samples, axis=0).astype(np.int64)
    hot = 0
    if known is not None:
        hot = int(np.searchsorted(-counts[where], -32))
        keys = mixed(pairs.hashes[pairs.first[where[:hot]]], pairs.hashes[pairs.second[where[:hot]]])
        there, tables = known.find(keys)
        out[:, where[:hot][there]] = tables
        where, hot = np.concatenate([where[:hot][~there], where[hot:]]), int(hot - there.sum())
    keys = mixed(pairs.hashes[pairs.first[where]], pairs.hashes[pairs.second[where]])
    first, second = pairs.first[where], pairs.second[where]
    strength = model["strength"][_class(context[first])]
    now = None
    for k in range(burn_in + samples):
        tables = now[0] if now else np.ones(len(where))
        others = np.maximum(opened[first] - tables, 0)
        weight = (strength + model["discount"] * others) * parent[second]
        now = sweep(keys, counts[where], weight, model["discount"], seed + k, now)
        if k >= burn_in:
            out[k - burn_in, where] = now[0]
    if hot:
        known.add(keys[:hot], out[:, where[:hot]])
    return out


class Remembered:
    """Tables drawn for pairs of many customers, which most blocks hold, by the hash of the pair: a
    worker process need not draw them again for the next block. ``limit`` pairs are kept at most."""

    def __init__(self, limit: int = 400_000):
        self.limit, self.keys, self.tables = limit, np.zeros(0, dtype=np.uint64), None

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are known, and the tables of those."""
        if self.tables is None:
            return np.zeros(len(keys), dtype=bool), np.zeros((1, 0), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        there = self.keys[at] == keys
        return there, self.tables[:, at[there]]

    def add(self, keys: np.ndarray, tables: np.ndarray) -> None:
        """Keys that are not known yet; those that come first are kept where room is short."""
        room = self.limit - len(self.keys)
        if room <= 0 or not len(keys):
            return
        keys, tables = np.concatenate([self.keys, keys[:room]]), tables[:, :room].astype(np.int32)
        tables = tables if self.tables is None else np.concatenate([self.tables, tables], axis=1)
        order = np.argsort(keys)
        self.keys, self.tables = keys[order], tables[:, order]


@lru_cache(maxsize=1)
def remembered(run: str) -> Remembered:
    """What this worker process has drawn for the last round of the run of that name."""
    return Remembered()


def _seated(customers: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Where ``which`` holds, most customers first."""
    where = np.flatnonzero(which)
    return where[np.argsort(-customers[where], kind="stable")]


def _class(customers: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(customers, 1)).astype(np.int64), CLASSES - 1)


def seat_parent(keys: np.ndarray, got: np.ndarray, model: dict, seed: int, sweeps: int) -> np.ndarray:
    """Tables of each word in the parent, whose customers are the tables ``got`` in the contexts."""
    tables = np.minimum(got, 1)
    where = _seated(got, got > 1)
    others = max(model["top_seated"][0] - 1, 0)
    fresh = (model["top_strength"] + model["top_discount"][0] * others) / (model["vocabulary"] + 1)
    now = None
    for k in range(sweeps):
        now = sweep(keys[where], got[where], np.full(len(where), fresh), model["top_discount"][0], seed + k, now)
    tables[where] = now[0]
    return tables


def parent(got: np.ndarray, seated: np.ndarray, model: dict, sample: int) -> np.ndarray:
    """The parent's probability of words with ``got`` customers at ``seated`` tables there."""
    d, strength = model["top_discount"][sample], model["top_strength"]
    total, tables, types = model["tables"][sample], model["top_seated"][sample], model["vocabulary"]
    fresh = (strength + d * tables) / (strength + total)
    return (got - d * seated) / (strength + total) + fresh / (types + 1)


def predictive(
    counts: np.ndarray, tables: np.ndarray, opened: np.ndarray, customers: np.ndarray, below: np.ndarray, model: dict
) -> np.ndarray:
    """Probabilities of words in contexts with ``customers`` at ``opened`` tables, ``counts`` and
    ``tables`` of them the word's, which the parent gives ``below``."""
    strength, d = model["strength"][_class(customers)], model["discount"]
    rest = (strength + d * opened) * below
    return np.where(customers > 0, (counts - d * tables + rest) / (strength + customers), below)


def _log_ratio(strength: np.ndarray, step: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log of strength * (strength + step) * ... of n factors, over whole arrays."""
    scaled = strength / step
    big = 16.0

    def log_gamma(x: np.ndarray) -> np.ndarray:
        shift = np.zeros_like(x)
        y = x.copy()
        small = np.flatnonzero(y < big)
        while len(small):
            shift[small] -= np.log(np.maximum(y[small], 1e-300))
            y[small] += 1
            small = small[y[small] < big]
        return shift + _log_gamma(y)

    return n * np.log(step) + log_gamma(scaled + n) - log_gamma(scaled)


def _likelihoods(context: np.ndarray, opened: np.ndarray, discount: float) -> np.ndarray:
    """For each class of contexts the log likelihood of their tables under each strength."""
    out = np.zeros((CLASSES, len(STRENGTHS)))
    # Few contexts differ in both numbers.
    wide = int(opened.max(initial=0)) + 1
    both, many = np.unique(context.astype(np.int64) * wide + opened, return_counts=True)
    context, opened = both // wide, both % wide
    sizes = _class(context)
    for k, s in enumerate(STRENGTHS):
        top = _log_ratio(np.full(len(context), s), np.full(len(context), discount), opened.astype(float))
        low = _log_ratio(np.full(len(context), s), np.ones(len(context)), context.astype(float))
        out[:, k] = np.bincount(sizes, weights=many * (top - low), minlength=CLASSES)[:CLASSES]
    return out


_STATE = f"{BLOCK}, pairs binary, owned binary, words binary, drawn binary, stats array<double>"


def pitman_yor_scores(
    docs: DataFrame,
    modulus: int = 7,
    remainder: int = 2,
    rounds: int = 2,
    samples: int = 3,
    burn_in: int = 2,
    block_words: int = 800_000,
    shard_words: int = 500_000,
    seed: int = 11,
) -> DataFrame:
    """Scores of all documents by a model of those whose id's crc32 does not leave ``remainder``."""
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    with Kept(docs.sparkSession) as kept:
        state, model = trained(docs, kept, modulus, remainder, rounds, samples, burn_in, block_words, shard_words, seed)

        def score(batches):  # noqa: ANN001, ANN202
            for batch in batches:
                for row in batch.itertuples():
                    yield _scored(row, model)

        return written(state.drop("stats", "owned").mapInArrow(_frames(score), schema), "pitman-yor-scores")


def trained(
    docs: DataFrame, kept: Kept, modulus: int, remainder: int, rounds: int, samples: int, burn_in: int,
    block_words: int, shard_words: int, seed: int,
) -> tuple[DataFrame, dict]:
    """The blocks with the counts and tables of their words, and the model over them."""
    flag = F.when(held_out(modulus, remainder), 1).otherwise(0)
    blocks = write_blocks(docs, word_list, flag, block_words, kept)

    def words_in(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            yield pd.DataFrame({"n": [int(unpack_uint(x).sum()) for x in batch["lengths"]]})

    total = blocks.select("lengths").mapInPandas(words_in, "n long").agg(F.sum("n")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_words))

    # Round one: the corpus counts of words and of pairs, and which block owns a pair.
    def ask_counts(block: Block) -> list:
        p = Pairs(block)
        keys, order = p.word_keys()
        return [(keys, [p.words[order]]), (p.keys, [p.by_key(p.training)])]

    def add_up(kind: int, keys: np.ndarray, group: np.ndarray, columns: list[np.ndarray]) -> list[np.ndarray]:
        total = sums(group, columns[0])
        first = np.concatenate([[True], group[1:] != group[:-1]]).astype(np.int64)
        return [total, first]

    def take_counts(block: Block, answers: list) -> pd.DataFrame:
        p = Pairs(block)
        _, order = p.word_keys()
        count = np.empty(len(order), dtype=np.int64)
        count[order] = answers[0][0]
        owner = np.empty(len(order), dtype=np.int64)
        owner[order] = answers[0][1]
        pairs, owned = p.by_pair(answers[1][0]), p.by_pair(answers[1][1])
        mine = pairs[owned > 0]
        stats = [float(p.words.sum()), float(((count > 0) & (owner > 0)).sum())]
        stats += [float((mine == k).sum()) for k in (1, 2)] + [float((mine > 0).sum())]
        return _state(block, pairs, owned, count, stats)

    state = exchange(
        blocks, ask_counts, [max(1, shards // 4), shards], [2, 2], add_up, take_counts, _STATE, narrow=(1,)
    )
    state = kept.keep(state, "pitman_yor_counts")
    kept.drop_oldest()
    numbers = [F.sum(F.col("stats")[k]).alias(f"s{k}") for k in range(5)]
    words, types, once, twice, distinct = (x or 0.0 for x in state.agg(*numbers).first())
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    model = {
        "words": words, "vocabulary": types, "discount": discount, "strength": np.full(CLASSES, 10.0),
        "run": uuid.uuid4().hex, "tables": [distinct], "top_seated": [types], "top_discount": [0.5], "top_strength": 1.0,
    }

    # Later rounds: tables per context and per word, first one for each pair, then as sampled.
    for turn in range(rounds):
        sampled = samples if turn else 1
        # What a block needs to draw this round's tables, and to draw the same ones again.
        draw = {"model": model, "seed": seed + 100 * turn, "samples": sampled, "burn_in": burn_in, "turn": turn}

        def ask_tables(block: Block, draw: dict = draw) -> list:
            p = Pairs(block)
            counts, owned = unpack_uint(block.carried["pairs"]), unpack_uint(block.carried["owned"])
            # Others report the tables of the pairs they own.
            tables = drawn_tables(p, counts, block.carried["words"], draw, owned)
            n = len(p.hashes)
            keys, order = p.word_keys()
            columns = []
            for t in tables * owned:
                columns.append(np.bincount(p.first, weights=t, minlength=n).astype(np.int64)[order])
                columns.append(np.bincount(p.second, weights=t, minlength=n).astype(np.int64)[order])
            # Customers of a word as a context: those that follow it.
            columns.append(np.bincount(p.first, weights=counts * owned, minlength=n).astype(np.int64)[order])
            return [(keys, columns)]

        def add_tables(
            kind: int, keys: np.ndarray, group: np.ndarray, columns: list[np.ndarray], draw: dict = draw
        ) -> list[np.ndarray]:
            first = np.concatenate([[True], group[1:] != group[:-1]])
            out = [sums(group, c) for c in columns]
            for k in range(draw["samples"]):
                # All customers of a word meet here, so its tables in the parent are drawn here.
                got = out[2 * k + 1][first]
                seated = seat_parent(keys[first], got, draw["model"], draw["seed"] + 1000 * (k + 1), draw["burn_in"] + 1)
                out.append(seated[group])
            return [*out, first.astype(np.int64)]

        def take_tables(block: Block, answers: list, draw: dict = draw) -> pd.DataFrame:
            order = word_order(block)
            columns = []
            for column in answers[0]:
                values = np.empty(len(order), dtype=np.int64)
                values[order] = column
                columns.append(values)
            owner = columns.pop() > 0
            context, opened, got, seated = _by_sample(columns)
            mine = owner & (context > 0)
            stats = []
            for g, s in zip(got, seated, strict=True):
                stats += [float((owner & (g == 1)).sum()), float((owner & (g == 2)).sum())]
                stats += [float(g[owner].sum()), float(s[owner].sum())]
            stats += _likelihoods(context[mine], opened[0][mine], draw["model"]["discount"]).ravel().tolist()
            return _state(
                block, unpack_uint(block.carried["pairs"]), unpack_uint(block.carried["owned"]),
                _word_parts(block.carried["words"])[0], stats, columns, block.carried["words"] if draw["turn"] else b"",
            )

        state = exchange(
            state, ask_tables, [max(1, shards // 4)], [3 * sampled + 2], add_tables, take_tables, _STATE,
            carried=("pairs", "owned", "words"), narrow=(0,),
        )
        state = kept.keep(state, f"pitman_yor_{turn}")
        kept.drop_oldest()
        size = 4 * sampled + CLASSES * len(STRENGTHS)
        added = state.agg(*[F.sum(F.col("stats")[k]).alias(f"s{k}") for k in range(size)]).first()
        added = np.array([x or 0.0 for x in added])
        once, twice, tables, seated = added[: 4 * sampled].reshape(sampled, 4).T
        rng = np.random.default_rng(seed + turn)
        model = dict(model)
        model["tables"], model["top_seated"] = tables.tolist(), seated.tolist()
        model["top_discount"] = [min(0.95, max(0.05, a / (a + 2 * b))) if a else 0.5 for a, b in zip(once, twice, strict=True)]
        model["strength"] = _drawn(added[4 * sampled :].reshape(CLASSES, len(STRENGTHS)), rng)
        if seated[0]:
            top = [_log_ratio(STRENGTHS, np.full(len(STRENGTHS), step), n) for step, n in ((model["top_discount"][0], seated[0]), (1.0, tables[0]))]
            model["top_strength"] = float(_drawn((top[0] - top[1])[None, :], rng)[0])
        model["draw"] = draw
    return state, model


def _drawn(likely: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A strength for each row of log likelihoods."""
    chance = np.exp(likely - likely.max(axis=1, keepdims=True))
    chance /= chance.sum(axis=1, keepdims=True)
    picked = (np.cumsum(chance, axis=1) < rng.random(len(likely))[:, None]).sum(axis=1)
    return STRENGTHS[picked.clip(max=len(STRENGTHS) - 1)]


def drawn_tables(
    p: Pairs, counts: np.ndarray, words: bytes, draw: dict, mine: np.ndarray | None = None,
    known: Remembered | None = None,
) -> np.ndarray:
    """Tables of every pair in each sample of a round; the same wherever they are drawn. ``words``
    are the state of the words before that round. Where ``mine`` is given only its pairs are drawn."""
    if not draw["turn"]:
        return np.minimum(counts, 1)[None, :]
    context, opened, got, seated = _by_sample(_word_parts(words)[1:])
    below = parent(got[0], seated[0], draw["model"], 0)
    return _samples(p, counts, context, opened[0], below, draw["model"], draw["seed"], draw["samples"], draw["burn_in"], mine, known)


def _frames(run):  # noqa: ANN001, ANN202
    """Pandas rows in, Arrow batches out, so that null ids stay exact."""

    def over(batches):  # noqa: ANN001, ANN202
        yield from run(b.to_pandas() for b in batches)

    return over


def _state(block: Block, pairs, owned, count, stats, tables=(), drawn: bytes = b"") -> pd.DataFrame:  # noqa: ANN001
    parts = [pack_uint(count), *[pack_uint(t) for t in tables]]
    words = b"".join(len(x).to_bytes(4, "little") + x for x in parts)
    return pd.DataFrame([{
        "block": block.number, "doc_ids": block.doc_ids, "flags": pack(block.flags),
        "lengths": pack_uint(block.lengths), "places": pack_uint(block.places), "hashes": pack(block.hashes),
        "pairs": pack_uint(pairs), "owned": pack_uint(owned), "words": words, "drawn": drawn,
        "stats": [float(x) for x in stats],
    }])


def _word_parts(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        out.append(unpack_uint(data[at + 4 : at + 4 + n]))
        at += 4 + n
    return out


def _by_sample(columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Customers of each word as a context; for each sample the tables it opened as a context, those
    it got as a word, and its own in the parent."""
    n = len(columns) // 3
    return columns[2 * n], columns[0 : 2 * n : 2], columns[1 : 2 * n : 2], columns[2 * n + 1 :]


def _scored(row, model: dict):  # noqa: ANN001, ANN202
    """Scores with the very seatings whose tables were added up."""
    block = block_of(row, "pairs", "words", "drawn")
    p = Pairs(block)
    counts = unpack_uint(block.carried["pairs"])
    word_counts, *columns = _word_parts(block.carried["words"])
    chance = np.zeros(len(counts))
    if model["words"]:
        context, opened, got, seated = _by_sample(columns)
        tables = drawn_tables(p, counts, block.carried["drawn"], model["draw"], known=remembered(model["run"]))
        for k, t in enumerate(tables):
            below = parent(got[k], seated[k], model, k)[p.second]
            chance += predictive(counts, t, opened[k][p.first], context[p.first], below, model) / len(tables)
    else:
        chance += 1.0 / (model["vocabulary"] + 1)
    documents = len(block.lengths)
    score = np.bincount(p.document, weights=np.log10(chance)[p.pair_at], minlength=documents)
    n, v = model["words"], model["vocabulary"]
    base = np.log10((word_counts + 1) / (n + (v + 1)))
    base_score = np.bincount(p.document, weights=base[p.word_at], minlength=documents)
    known = np.bincount(p.document, weights=(word_counts > 0)[p.word_at], minlength=documents).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            ids_in(block.doc_ids), pa.array(block.flags == 1), pa.array(block.lengths + 1), pa.array(known),
            pa.array(np.full(documents, int(n), dtype=np.int64)), pa.array(base_score), pa.array(score),
        ],
        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )
