"""Toxicity scores of texts restored from obfuscation by a noisy channel.

A word may have been written through a channel that replaces letters by look-alikes, repeats them,
puts separators between them, or spaces them out. Each suspicious word spans a lattice: every
written character may stand for itself, for the letters it resembles, for nothing (a separator),
or for the letter before it once more. Viterbi finds the most probable reading under a character
trigram model of all documents and the channel's costs.

Where the channel leaves it open what was meant, each meaning is a reading: symbols at a word's ends
that resemble letters (``a$$``, ``!diot``, ``idiot###``) are read and are dropped, a run of equal
letters in a word of letters stands for one or for two, and a word without any letter stays beside
what it may spell. A word of other letters has one path and is its own reading.

Blanks are part of the lattice too: short words that follow one another, whatever white space lies
between, span one of their own, in which a blank stands for a word's end or for nothing. The words
of its best reading are added to those written.

The character model's counts cover all texts; its alphabet is fixed, so the table has
``len(ALPHABET) ** 3`` numbers at any input size. The scores come from a bounded sample of labelled
documents (``labelled`` rows, by the order of a hash of the id, never held-out ones, copies counted
once): words and word beginnings of restored texts that stand out in toxic documents, weighted by
the log ratio of their smoothed rates, and a logistic regression on the largest weights in a
document. While it is fitted a document's own words are weighted as if it were left out.

Defined cases: a null or empty text is scored like one without a weighted word; a null ``doc_id``
is not held out and has no label; rows with equal ids are scored each; other columns are not read;
without labels every score is the smoothed base rate; an empty table gives an empty result. Texts are
read whole, in time that grows with their length, also where all of it is one lattice.
"""

from __future__ import annotations

import functools
import math
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import held_out, utf8
from rollbook.session import written

# The letters of the character model, and what written characters may stand for.
ALPHABET = " abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
LOOK_ALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "2": "z",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h",
}
SEPARATORS = ".-_*'~,/\\:·|+#"

N = len(ALPHABET)
_PLACE = {c: i for i, c in enumerate(ALPHABET)}
_TABLE = np.zeros(0x180, dtype=np.int64)
for _c, _i in _PLACE.items():
    _TABLE[ord(_c)] = _i
    _TABLE[ord(_c.upper()) if len(_c.upper()) == 1 and ord(_c.upper()) < 0x180 else ord(_c)] = _i

_EDGE = ".,;:!?\"'()[]{}«»“”„¿¡"
#: What can only be dropped at a word's ends, and all that may be.
_CLEAR = "".join(c for c in dict.fromkeys(_EDGE + SEPARATORS) if c not in LOOK_ALIKES)
_DIM = _CLEAR + "".join(c for c in LOOK_ALIKES if not c.isalnum()) + "%&<>"
_RUN = re.compile(r"(.)\1+")
_RUNS = re.compile(r"(.)\1*")
#: Two or more short words with any white space between.
SHORT = 4
_SHORTS = re.compile(rf"(?<!\S)\S{{1,{SHORT}}}(?:\s+\S{{1,{SHORT}}})+(?!\S)")

#: The letters of a path, each with the path before it.
Path = tuple["Path", str] | None
#: After so many characters a lattice lets go of what all its paths agree on.
SETTLE = 512

COST_LOOK, COST_DROP, COST_REPEAT, COST_KEEP, COST_GAP = 0.5, 0.4, 0.3, 1.5, 0.6


def trigram_counts(texts: list[bytes]) -> np.ndarray:
    out = np.zeros(N**3, dtype=np.int64)
    for text in texts:
        points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), dtype="<u4")
        places = np.where(points < 0x180, _TABLE[np.minimum(points, 0x17F)], 0)
        places = np.concatenate([[0, 0], places, [0]])
        out += np.bincount((places[:-2] * N + places[1:-1]) * N + places[2:], minlength=N**3)
    return out


def character_model(counts: np.ndarray) -> np.ndarray:
    """log10 P(third | first, second), interpolated with the bigram and unigram."""
    c3 = counts.reshape(N, N, N).astype(float)
    c2, c1 = c3.sum(axis=0), c3.sum(axis=(0, 1))
    p1 = (c1 + 0.5) / (c1.sum() + 0.5 * N)
    p2 = (c2 + 5 * p1) / (c2.sum(axis=1, keepdims=True) + 5)
    p3 = (c3 + 5 * p2[None]) / (c3.sum(axis=2, keepdims=True) + 5)
    return np.log10(p3)


def spellings(word: str) -> tuple[str, ...]:
    """A word of letters, each run of equal ones as one letter and as two; beyond four runs alike."""
    if not _RUN.search(word):
        return (word,)
    runs = list(_RUN.finditer(word))
    if len(runs) > 4:
        return (_RUN.sub(r"\1\1", word), _RUN.sub(r"\1", word))
    parts, end = [], 0
    for run in runs:
        parts += [(word[end : run.start()],), (run[1], run[1] * 2)]
        end = run.end()
    return tuple("".join(x) for x in product(*parts, (word[end:],)))


def _path(letters: str) -> Path:
    path = None
    for letter in letters:
        path = (path, letter)
    return path


def _letters(path: Path) -> str:
    out = []
    while path:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out))


def _settle(
    states: dict[int, tuple[float, Path]], settled: list[str]
) -> dict[int, tuple[float, Path]]:
    """Moves the letters that all paths begin with to ``settled``; each path keeps its last ones."""
    texts = {state: _letters(path) for state, (_, path) in states.items()}
    shared = os.path.commonprefix(list(texts.values()))
    cut = min(len(shared), max(0, min(map(len, texts.values())) - 1))
    settled.append(shared[:cut])
    return {state: (score, _path(texts[state][cut:])) for state, (score, _) in states.items()}


def decode(word: str, model: np.ndarray) -> str:
    """The most probable letters behind ``word`` without the marks around it."""
    word = word.lower()
    return viterbi(word.rstrip(_EDGE).lstrip("\"'([{«“„¿¡") or word, model.ravel().tolist())


@functools.lru_cache(maxsize=1 << 12)
def _written(c: str) -> tuple[tuple[tuple[str, int, float], ...], float | None]:
    """What a character may stand for, with its place and cost, and the cost of nothing."""
    letters = [(c, 0.0)] if c in _PLACE else [] if c in LOOK_ALIKES or c in SEPARATORS else [(c, COST_KEEP)]
    letters += [(x, COST_LOOK) for x in LOOK_ALIKES.get(c, "")]
    nothing = COST_GAP if c == " " else COST_DROP if c in SEPARATORS or not letters else None
    return tuple((x, _PLACE.get(x, 0), cost) for x, cost in letters), nothing


def viterbi(core: str, model: list[float], start: str = "", repeats: bool = True) -> str:
    """The most probable letters behind all of ``core`` after the letters ``start``, and those.

    A state is the places of the last two letters, as one number; ``model`` is flat.
    """
    settled: list[str] = []
    # A path is its score and its letters, the last one first.
    first = (0, *[_PLACE.get(c, 0) for c in start])[-2:] if start else (0, 0)
    states: dict[int, tuple[float, Path]] = {first[0] * N + first[1]: (0.0, _path(start))}
    for number, c in enumerate(core, 1):
        after: dict[int, tuple[float, Path]] = {}
        letters, nothing = _written(c)
        for state, (score, path) in states.items():
            row, then = state * N, state % N * N
            for letter, place, cost in letters:
                value = score - cost + model[row + place]
                old = after.get(then + place)
                if old is None or value > old[0]:
                    after[then + place] = (value, (path, letter))
                if repeats and path and letter == path[1] != " ":
                    value = score - COST_REPEAT
                    old = after.get(state)
                    if old is None or value > old[0]:
                        after[state] = (value, path)
            if nothing is not None:
                value = score - nothing
                old = after.get(state)
                if old is None or value > old[0]:
                    after[state] = (value, path)
        states = after
        if number % SETTLE == 0:
            states = _settle(states, settled)
    end = {state: score + model[state * N] for state, (score, _) in states.items()}
    return "".join(settled) + _letters(states[max(end, key=end.get)][1])


def _nearest(symbols: str, most: int = 4) -> list[str]:
    """The first run of equal symbols, the first two and so on, as far as all resemble letters."""
    out, end = [], 0
    for run in _RUNS.finditer(symbols):
        if run[1] not in LOOK_ALIKES or len(out) == most:
            break
        end = run.end()
        out.append(symbols[:end])
    return out


class Reader:
    """Restored words of texts, of those ``wanted`` holds for.

    Readings of up to ``limit`` words and windows are kept, of at most ``LONGEST`` characters each, so
    what is kept is bounded in bytes too; longer ones are read whenever they come.
    """

    LONGEST = 48

    def __init__(self, model: np.ndarray, limit: int = 300_000, wanted: Callable[[str], bool] | None = None):
        self.model, self.limit, self.wanted = model.ravel().tolist(), limit, wanted
        self.known, self.tails, self.gaps, self.windows, self.stretches = {}, {}, {}, {}, {}

    def _keep(self, cache: dict, key: str, found: tuple[str, ...]) -> tuple[str, ...]:
        if len(key) <= self.LONGEST:
            if len(cache) >= self.limit:
                cache.clear()
            cache[key] = found
        return found

    def _wanted(self, words: Iterable[str]) -> tuple[str, ...]:
        return tuple(filter(self.wanted, words)) if self.wanted else tuple(words)

    def _spelled(self, core: str, start: str = "") -> tuple[str, ...]:
        """The best reading, and the best with every letter written out, its runs short and long."""
        whole = viterbi(core, self.model, start, repeats=False)
        return tuple(dict.fromkeys([viterbi(core, self.model, start), *spellings(whole)]))

    def _tail(self, word: str, symbols: str) -> list[str]:
        """``word`` with the look-alikes after it read; they depend on its last two letters only."""
        key = word[-2:] + symbols
        found = self.tails.get(key)
        if found is None:
            found = self._keep(self.tails, key, self._spelled(symbols, word[-2:]))
        return [word[:-2] + x for x in found]

    def _read(self, word: str) -> tuple[str, ...]:
        if word.isalpha():
            return spellings(word)
        core = word.strip(_CLEAR)
        if core.isalpha():
            return spellings(core)
        inner = core.strip(_DIM)
        at = core.index(inner) if inner else len(core)
        out = list(spellings(inner) if inner.isalpha() else self._spelled(inner) if inner else [])
        # Of the symbols before and after, the runs nearest to the word are read, the others dropped.
        for head in _nearest(core[:at][::-1]):
            out += self._spelled(head[::-1] + inner)
        ends = _nearest(core[at + len(inner) :])
        out += [y for x in out for tail in ends for y in self._tail(x, tail)]
        if not any(c.isalpha() for c in core):
            out.append(core)
        return tuple(dict.fromkeys(out))

    def _joined(self, left: str, right: str) -> bool:
        """Whether two words of letters are more probable as one; their nearest letters decide."""
        key = (left[-2:], right[:2])
        found = self.gaps.get(key)
        if found is None:
            a, b, c, d = (_PLACE.get(x, 0) for x in (*key[0], *key[1]))
            m = self.model

            def chance(x: int, y: int, z: int) -> float:
                return m[(x * N + y) * N + z]

            apart = chance(a, b, 0) + chance(b, 0, c) + chance(0, c, d)
            if len(self.gaps) >= self.limit:
                self.gaps.clear()
            found = self.gaps[key] = chance(a, b, c) + chance(b, c, d) - COST_GAP > apart
        return found

    def _spaced(self, words: list[str]) -> list[str]:
        """The words of the best reading of neighbours, where that takes blanks away.

        Between words of two letters and more a gap depends on no other gap, so the window is cut
        there; single characters and words with symbols are decided together. Three or more single
        characters in a row are read by themselves too.
        """
        out, held, before, single = [], [], "", []
        gaps = self.gaps
        for word in words:
            word = word.strip(_CLEAR) or word
            plain = False
            if len(word) == 1:
                single.append(word)
            else:
                if single:
                    out += self._stretch(single) if len(single) > 2 else ()
                    single = []
                plain = word.isalpha()
                if plain and before:
                    joined = gaps.get((before[-2:], word[:2]))
                    if joined is None:
                        joined = self._joined(before, word)
                    if not joined:
                        out += self._stretch(held) if len(held) > 1 else ()
                        held, before = [word], word
                        continue
            held.append(word)
            before = word if plain else ""
        if len(held) > len(single) > 2:
            out += self._stretch(single)
        return [*out, *self._stretch(held)]

    def _stretch(self, held: list[str]) -> tuple[str, ...]:
        if len(held) < 2:
            return ()
        key = " ".join(held)
        found = self.stretches.get(key)
        if found is None:
            written_out = set(held)
            read = dict.fromkeys(viterbi(key, self.model).split(" "))
            found = self._keep(self.stretches, key, tuple(w for w in read if w not in written_out and w.isalpha()))
        return found

    def readings(self, word: str) -> tuple[str, ...]:
        found = self.known.get(word)
        if found is None:
            if word.isalpha() and not _RUN.search(word):
                found = (word,) if self.wanted is None or self.wanted(word) else ()
            else:
                found = self._wanted(self._read(word))
            self._keep(self.known, word, found)
        return found

    def _window(self, window: str) -> tuple[str, ...]:
        return self._keep(self.windows, window, self._wanted(self._spaced(window.split())))

    def words(self, text: bytes) -> set[str]:
        whole = text.decode("utf-8", "replace").lower()
        out: set[str] = set()
        known, windows = self.known, self.windows
        for word in set(whole.split()):
            found = known.get(word)
            if found is None:
                found = self.readings(word)
            if found:
                out.update(found)
        for window in set(_SHORTS.findall(whole)):
            found = windows.get(window)
            if found is None:
                found = self._window(window)
            if found:
                out.update(found)
        out.discard("")
        return out


def features(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word, *[word[:k] + "~" for k in (4, 5, 6) if len(word) > k]]


def _matcher(lexicon: Iterable[str]) -> Callable[[str], bool]:
    """Whether a word has a feature in ``lexicon``."""
    whole = frozenset(lexicon)
    heads = frozenset(f[:-1] for f in whole if f.endswith("~"))

    def matches(word: str) -> bool:
        if word in whole:
            return True
        size = len(word)
        return size > 4 and (word[:4] in heads or (size > 5 and word[:5] in heads) or (size > 6 and word[:6] in heads))

    return matches


def _weights(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    return np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        r = np.diag([1e-6, *[ridge] * (len(w) - 1)])
        w = w - np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + r, x.T @ (p - y) + r @ w)
    return w


def _top(weights: list[float]) -> tuple[float, float]:
    """The largest weight and the sum of the largest three, of those above zero."""
    best = sorted((w for w in weights if w > 0), reverse=True)[:3]
    return (best[0], sum(best)) if best else (0.0, 0.0)


def toxicity(
    docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0,
    labelled: int = 20_000, least_toxic: int = 6, least_weight: float = 2.5,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N**3, dtype=np.int64)
        for batch in batches:
            total += trigram_counts(batch.column("text").to_pylist())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["place", "n"])

    found = texts.select("text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    counts = np.zeros(N**3, dtype=np.int64)
    for row in found.collect():  # as many rows as the alphabet has triples
        counts[row["place"]] = row["n"]
    model = character_model(counts)

    # Labels that may be learned from: a bounded number of ids, 9 bytes each.
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out(modulus, remainder, "_id")).groupBy("_id").agg(F.max("toxic").alias("toxic"))
    known = written(known.orderBy(F.xxhash64("_id"), "_id").limit(labelled), "toxicity-labels")
    sample = texts.join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    # Of copies one counts.
    sample = sample.groupBy(F.xxhash64("text").alias("copy")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            words = [sorted({f for w in reader.words(t.as_py()) for f in features(w)}) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("copy"), batch.column("toxic"), pa.array(words, pa.list_(pa.string()))],
                ["copy", "toxic", "words"],
            )

    read_sample = written(sample.mapInArrow(read, "copy long, toxic int, words array<string>"), "toxicity-sample")
    sizes = read_sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    n_toxic, n_clean = int(sizes[0]), int(sizes[1] - sizes[0])
    rates = read_sample.select("toxic", F.explode("words").alias("word")).groupBy("word")
    rates = rates.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).where(F.col("t") >= least_toxic)
    weight = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("c") + 0.5) / (n_clean + 1))
    # Words that stand out; from a bounded sample, so bounded.
    table = rates.where(weight >= least_weight).toPandas()
    t, c = table["t"].to_numpy(dtype=float), table["c"].to_numpy(dtype=float)
    lexicon = dict(zip(table["word"], _weights(t, c, n_toxic, n_clean).tolist(), strict=True))
    without = {
        1: dict(zip(table["word"], _weights(t - 1, c, n_toxic - 1, n_clean).tolist(), strict=True)),
        0: lexicon,
    }

    def own_tops(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (*_top([without[y][w] for w in words if w in lexicon]), y)
                for words, y in zip(batch["words"], batch["toxic"], strict=True)
            ]
            yield pd.DataFrame(rows, columns=["best", "three", "y"])

    fitted = read_sample.select("words", "toxic").mapInPandas(own_tops, "best double, three double, y int").toPandas()
    if n_toxic and n_clean:
        w = _logistic(fitted[["best", "three"]].to_numpy(dtype=float), fitted["y"].to_numpy(dtype=float))
    else:
        w = np.array([math.log((n_toxic + 0.5) / (n_clean + 0.5)), 0.0, 0.0])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def heaviest(word: str) -> float:
            return max([lexicon[f] for f in features(word) if f in lexicon], default=0.0)

        # A word without a weight changes no score.
        reader = Reader(model, wanted=_matcher(lexicon))

        for batch in batches:
            rows = [_top([heaviest(x) for x in reader.words(t.as_py())]) for t in batch.column("text")]
            z = np.array(rows, dtype=float).reshape(-1, 2) @ w[1:] + w[0]
            value = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(value)], ["doc_id", "score"])

    out = texts.mapInArrow(score, "doc_id long, score double")
    return out.select(
        "doc_id", held_out(modulus, remainder).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
