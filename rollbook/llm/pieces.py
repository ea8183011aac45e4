"""SentencePiece encoding by unigram Viterbi over a double-array trie, and decoding.

Pieces with log scores come from a public model file. Their UTF-8 bytes make a trie in a double
array: the child of state s by byte b is ``base[s] + b``, if ``check`` there is s. A text's
segmentation is the path of the greatest sum of scores; a character that no piece covers alone may
be crossed by its byte pieces, at ``unknown`` below the lowest score. Spaces become markers and one
marker stands before the text, as the format has it.

Where no piece has a marker inside (checked when a model is read), a best path always breaks before
a marker that follows another character, so the parts between are segmented alone, each distinct
part once per batch, all parts of one length together: the trie and the path's scores are walked
for whole arrays of parts. Lengths that few parts have, such as texts without spaces, are walked part by
part, with the same sums and ties, in time that grows with the length.

Ties go to the longer last piece. Defined cases: a null or empty text has no pieces; a marker
character in a text is decoded as a space, which ``round_trip`` reports; rows with equal or null
ids are encoded each; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from rollbook.llm.common import utf8

MARK = "▁"


class Trie:
    """A double array over byte strings; ``value`` is the number of a string or -1."""

    def __init__(self, strings: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for string, value in strings.items():
            node = 0
            for byte in string:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    values.append(-1)
                node = children[node][byte]
            values[node] = value
        size = 3 * len(children) + 4096
        self.base = np.zeros(size, dtype=np.int64)
        self.check = np.full(size, -1, dtype=np.int64)
        self.value = np.full(size, -1, dtype=np.int64)
        self.check[0] = 0
        first_free = search_from = 1
        todo = [(0, 0)]
        while todo:
            node, state = todo.pop()
            self.value[state] = values[node]
            if not children[node]:
                # No child can match: its base points behind all states.
                self.base[state] = size - 256
                continue
            own = sorted(children[node])
            while self.check[first_free] >= 0:
                first_free += 1
            # Branching nodes leave crowded stretches behind; single children fill their holes.
            if len(own) == 1 and first_free > own[0]:
                base = first_free - own[0]
            else:
                at = max(search_from, first_free)
                base = self._room(np.array(own), at)
                if base + own[0] > at + 256:
                    search_from = base + own[0] - 256
            if base + own[-1] >= size - 256:
                raise ValueError("the trie's array is too short")
            self.base[state] = base
            for byte, child in children[node].items():
                self.check[base + byte] = state
                todo.append((child, base + byte))

    def _room(self, own: np.ndarray, at: int) -> int:
        """A base that puts all of a node's children on free slots, the first one from ``at`` on."""
        width = 64
        while True:
            bases = at + np.flatnonzero(self.check[at : at + width] < 0) - own[0]
            bases = bases[bases > 0]
            fits = (self.check[np.minimum(bases[:, None] + own, len(self.check) - 1)] < 0).all(axis=1)
            if fits.any():
                return int(bases[fits.argmax()])
            at, width = at + width, 2 * width

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The next states; -1 where there is none."""
        to = self.base[states] + symbols
        return np.where(self.check[to] == states, to, -1)


class Model:
    #: Fewer parts of one length than that are walked one by one.
    FEW = 32

    def __init__(self, pieces: list[tuple[bytes, float]], bytes_from: int, unknown: float = 10.0):
        """``pieces`` by id; byte b has the id ``bytes_from + b``."""
        self.pieces, self.bytes_from = pieces, bytes_from
        usable = {p: i for i, (p, _) in enumerate(pieces) if p and not bytes_from <= i < bytes_from + 256}
        self.trie = Trie(usable)
        self.scores = np.array([s for _, s in pieces])
        # Scores of -1e9 mark pieces that are never to be chosen.
        self.penalty = min(s for p, s in pieces if usable.get(p) is not None and s > -1e8) - unknown
        self.longest = max(map(len, usable))
        mark = MARK.encode()
        self.parts_apart = not any(mark in p.lstrip(mark) for p in usable if p.strip(mark))

    def segment(self, parts: list[bytes]) -> list[bytes]:
        """The best path of each part, as little-endian unsigned 32-bit ids."""
        out = [b""] * len(parts)
        by_length: dict[int, list[int]] = {}
        for i, part in enumerate(parts):
            by_length.setdefault(len(part), []).append(i)
        for length, places in by_length.items():
            if len(places) < self.FEW:
                for i in places:
                    out[i] = self.path(parts[i])
                continue
            step = max(1, (1 << 22) // max(1, length))
            for at in range(0, len(places), step):
                some = places[at : at + step]
                for i, ids in zip(some, self._paths([parts[i] for i in some], length), strict=True):
                    out[i] = ids
        return out

    def path(self, part: bytes) -> bytes:
        """The best path of one part; what ``_paths`` does for many."""
        base, check, value, scores = map(memoryview, (self.trie.base, self.trie.check, self.trie.value, self.scores))
        length, longest, penalty = len(part), self.longest, self.penalty
        best = array("d", [-math.inf]) * (length + 1)
        best[0] = 0.0
        last = array("q", [-1]) * (length + 1)
        came = array("q", [0]) * (length + 1)
        for start, byte in enumerate(part):
            here = best[start]
            if here == -math.inf or 0x80 <= byte < 0xC0:
                continue
            own = 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
            alone, state = False, 0
            for end, symbol in enumerate(part[start : start + longest], start + 1):
                to = base[state] + symbol
                if check[to] != state:
                    break
                state = to
                piece = value[state]
                if piece >= 0:
                    if end - start == own:
                        alone = True
                    score = here + scores[piece]
                    if score > best[end]:
                        best[end], last[end], came[end] = score, piece, start
            if not alone:
                end = min(start + own, length)
                if here + penalty > best[end]:
                    best[end], last[end], came[end] = here + penalty, -2, start
        ids = array("I")
        end = length
        while end:
            start = came[end]
            if last[end] >= 0:
                ids.append(last[end])
            else:
                ids.extend(self.bytes_from + x for x in reversed(part[start:end]))
            end = start
        return np.array(ids, dtype="<u4")[::-1].tobytes()

    def _paths(self, parts: list[bytes], length: int) -> list[bytes]:
        n = len(parts)
        text = np.frombuffer(b"".join(parts), dtype=np.uint8).reshape(n, length).astype(np.int64)
        # Bytes of a character: how many follow the one at each place; 0 inside a character.
        width = np.select([text < 0x80, text < 0xC0, text < 0xE0, text < 0xF0], [1, 0, 2, 3], 4)
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0.0
        last = np.full((n, length + 1), -1, dtype=np.int64)  # the piece that ends here; -2: bytes
        came = np.zeros((n, length + 1), dtype=np.int64)
        for start in range(length):
            rows = np.flatnonzero((width[:, start] > 0) & (best[:, start] > -np.inf))
            if not len(rows):
                continue
            here = best[rows, start]
            own = width[rows, start]
            alone = np.zeros(len(rows), dtype=bool)
            live = np.arange(len(rows))
            states = np.zeros(len(rows), dtype=np.int64)
            for k in range(min(self.longest, length - start)):
                states = self.trie.step(states, text[rows[live], start + k])
                go = states >= 0
                live, states = live[go], states[go]
                if not len(live):
                    break
                piece = self.trie.value[states]
                hit = piece >= 0
                which, found = live[hit], piece[hit]
                alone[which] |= own[which] == k + 1
                value = here[which] + self.scores[found]
                end = start + k + 1
                better = value > best[rows[which], end]
                target = rows[which[better]]
                best[target, end], last[target, end], came[target, end] = value[better], found[better], start
            fallback = np.flatnonzero(~alone)
            end = np.minimum(start + own[fallback], length)
            value = here[fallback] + self.penalty
            better = value > best[rows[fallback], end]
            target, end = rows[fallback[better]], end[better]
            best[target, end], last[target, end], came[target, end] = value[better], -2, start
        return self._backwards(parts, last, came)

    def _backwards(self, parts: list[bytes], last: np.ndarray, came: np.ndarray) -> list[bytes]:
        """The ids on the paths, walked from the ends for all parts together."""
        n, length = len(parts), last.shape[1] - 1
        # A path has at most one id a byte; it is filled from the right.
        ids = np.zeros((n, length), dtype="<u4")
        begins = np.full(n, length)
        ends = np.full(n, length)
        live = np.arange(n)
        while len(live):
            end = ends[live]
            piece, start = last[live, end], came[live, end]
            one = piece >= 0
            rows = live[one]
            begins[rows] -= 1
            ids[rows, begins[rows]] = piece[one]
            for row, a, b in zip(live[~one].tolist(), start[~one].tolist(), end[~one].tolist(), strict=True):
                begins[row] -= b - a
                ids[row, begins[row] : begins[row] + b - a] = [self.bytes_from + x for x in parts[row][a:b]]
            ends[live] = start
            live = live[start > 0]
        data, width = ids.tobytes(), 4 * length
        return [data[r * width + 4 * b : (r + 1) * width] for r, b in enumerate(begins.tolist())]


class Codec:
    """``encode`` and ``decode``; the segmentations of up to ``limit`` parts of at most ``LONGEST`` bytes
    are kept from one call to the next."""

    LONGEST = 64

    def __init__(self, model: Model, limit: int = 500_000):
        self.model, self.limit = model, limit
        #: Ids by part; a part without a marker stands for a word with one before it.
        self.known: dict[bytes, bytes] = {}
        mark, first = MARK.encode(), model.bytes_from
        self.spelled = [
            bytes([i - first]) if first <= i < first + 256 else piece.replace(mark, b" ")
            for i, (piece, _) in enumerate(model.pieces)
        ]

    def parts(self, text: bytes) -> list[bytes]:
        if not text:
            return []
        mark = MARK.encode()
        words = text.split(b" ")
        if self.model.parts_apart and all(words) and mark not in text:
            return words
        marked = mark + text.replace(b" ", mark)
        if not self.model.parts_apart:
            return [marked]
        out = []
        held = b""
        for piece in marked.split(mark)[1:]:
            # A run of markers stays with what follows.
            held += mark + piece
            if piece:
                out.append(held)
                held = b""
        return [*out, held] if held else out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        cut = [self.parts(t) for t in texts]
        if len(self.known) >= self.limit:
            self.known = {}
        known, mark = self.known, MARK.encode()
        new = [p for p in set().union(*cut) if p not in known]
        known.update(zip(new, self.model.segment([p if mark in p else mark + p for p in new]), strict=True))
        out = [b"".join(map(known.__getitem__, parts)) for parts in cut]
        for part in new:
            if len(part) > self.LONGEST:
                del known[part]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.spelled.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))[1:]


@functools.lru_cache(maxsize=2)
def read_model(path: str) -> Model:
    """The trie of a file is built once per process."""
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(len(file)):
        control = file.is_control(i) or file.is_unknown(i) or file.is_unused(i)
        pieces.append((b"" if control else file.id_to_piece(i).encode(), file.get_score(i)))
    return Model(pieces, file.piece_to_id("<0x00>"))


_codecs: dict[int, Codec] = {}


def _codec(shared: Broadcast) -> Codec:
    """One per worker process and broadcast model."""
    if id(shared.value) not in _codecs:
        _codecs.clear()
        _codecs[id(shared.value)] = Codec(shared.value)
    return _codecs[id(shared.value)]


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` with the ids as bytes of unsigned 32-bit numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(path))  # as large as the model file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = [x for at in range(0, len(texts), 500) for x in _codec(shared).encode(texts[at : at + 500])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", utf8().alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary")


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row the number of pieces and byte pieces, crc32 of the ids, the best path's score, and
    whether decoding gives the text back."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(path))  # as large as the model file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "score", "round_trip"]
        for batch in batches:
            own = _codec(shared)
            first, scores = own.model.bytes_from, own.model.scores
            texts = batch.column("text").to_pylist()
            columns: list[list] = [[], [], [], [], []]
            for at in range(0, len(texts), 500):
                some = texts[at : at + 500]
                for text, ids in zip(some, own.encode(some), strict=True):
                    numbers = np.frombuffer(ids, dtype="<u4").astype(np.int64)
                    byte = (numbers >= first) & (numbers < first + 256)
                    lead = byte & ((numbers - first) & 0xC0 != 0x80)
                    score = float(scores[numbers[~byte]].sum() + own.model.penalty * lead.sum())
                    for column, value in zip(columns, (len(numbers), int(byte.sum()), zlib.crc32(ids), score, own.decode(ids) == text), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.float64(), pa.bool_()], strict=True)]],
                names,
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", utf8().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_pieces long, n_bytes long, ids_crc32 long, score double, round_trip boolean"
    )
