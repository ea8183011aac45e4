"""Encoding whole texts with a public tokenizer, unit by unit.

The tokenizers here split a text into units before they look anything up, so a text may be cut
where a unit is sure to begin and its parts encoded alone. Words repeat, so each part's ids are
kept in a table of two generations: when the younger holds ``limit`` entries it becomes the older
and the older goes, so memory is bounded, frequent parts stay, and every text is encoded whole.
``tests/llm`` compares the ids with those of the whole text.
"""

from __future__ import annotations

import array
import functools
import json
import os

from tokenizers import Tokenizer

#: A space before something that is not white space begins a unit of a byte-level tokenizer, and a
#: line break between two such characters is a unit.
BYTE_LEVEL = "byte"
#: Where white space is dropped, spaces and line breaks may be cut away.
SPACE_DROPPED = "dropped"
#: A run of these after a letter is a unit.
STOPS = ".,;:!?"
#: Letters below this one are letters to every version of the tables of characters.
SETTLED = "\u0530"
#: Longer parts, such as whole texts without spaces, are encoded anew.
KEPT = 64
#: Letters below this one are composed.
COMPOSED = "\u0250"
#: The one letter below that which ends in a mark in lower case.
DOTTED = "\u0130"


def byte_letters() -> str:
    """The character a byte-level tokenizer writes for each byte: its own where that can be seen,
    the others by number from U+0100 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return "".join([chr(b if b in seen else next(others)) for b in range(256)])


def units_are_plain(tokenizer: Tokenizer) -> bool:
    """Letters, with or without a space before them, reach the model as one unit of byte letters."""
    return (
        tokenizer.normalizer is None
        and tokenizer.post_processor is None
        and type(tokenizer.pre_tokenizer).__name__ == "ByteLevel"
        and not tokenizer.pre_tokenizer.add_prefix_space
        and tokenizer.pre_tokenizer.use_regex
        and not any(t.content.strip().isalpha() for t in tokenizer.get_added_tokens_decoder().values())
    )


def words_are_plain(tokenizer: Tokenizer) -> bool:
    """Lower-case letters reach the model as one unit where white space is dropped."""
    rules = json.loads(tokenizer.to_str())
    folds, cuts = rules["normalizer"] or {}, rules["pre_tokenizer"] or {}
    if [n["type"] for n in folds.get("normalizers", [])] != ["NFC", "Replace", "Lowercase"] or rules["post_processor"]:
        return False
    kinds = cuts.get("pretokenizers", [])
    if folds["normalizers"][1]["pattern"] != {"Regex": r"\s+"} or [k["type"] for k in kinds] != ["Split", "ByteLevel"]:
        return False
    # Letters are matched by the first alternative that does not begin with an apostrophe.
    units = [u for u in kinds[0]["pattern"].get("Regex", "").split("|") if not u.startswith("'")]
    by_letters = units[:1] == [r"[\p{L}]+"] and kinds[0]["invert"] and not kinds[1]["use_regex"]
    names = [t.content.strip() for t in tokenizer.get_added_tokens_decoder().values()]
    return by_letters and not kinds[1]["add_prefix_space"] and not any(n.isalpha() for n in names)


class _Parts(dict):
    """The ids of parts as bytes of little-endian unsigned 32-bit numbers."""

    def __init__(self, tokenizer: Tokenizer, prefix: str, limit: int, folds: bool, stops: _Parts | None, plain: bool):
        super().__init__()
        self.tokenizer, self.prefix, self.limit, self.folds = tokenizer, prefix, limit, folds
        self.plain, self.model, self.letters = plain, tokenizer.model, byte_letters()
        self.stops = self if stops is None else stops
        self.old: dict[str, bytes] = {}

    def _word(self, part: str) -> str:
        """The part whose ids this one's begin with: itself, or without stops, or in lower case."""
        word = part.rstrip(STOPS)
        if not word or not word[-1].isalpha() or word[-1] == DOTTED:
            word = part
        if self.folds and (word.isascii() or max(word) < COMPOSED):
            return word.lower()
        return word

    def turn(self) -> None:
        """Begin a new generation when the younger one is full."""
        if len(self) >= self.limit:
            # The older goes first, so that there are never three.
            self.old = {}
            self.old = dict(self)
            self.clear()

    def _by_tokenizer(self, words: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast([self.prefix + w for w in words], add_special_tokens=False)
        return [array.array("I", code.ids).tobytes() for code in coded]

    def _by_model(self, word: str) -> bytes:
        """A word of letters is a unit, so only the tokenizer's model is left to apply."""
        if word.isascii():
            unit = self.letters[ord(self.prefix)] + word if self.prefix else word
        else:
            unit = (self.prefix + word).encode().decode("latin-1").translate(self.letters)
        return array.array("I", [t.id for t in self.model.tokenize(unit)]).tobytes()

    def _is_unit(self, word: str) -> bool:
        if self.folds:
            # Letters that composing and lower-casing leave as they are.
            return word.isalpha() and max(word) < COMPOSED and word == word.lower()
        return word.isalpha() and max(word) < SETTLED

    def __missing__(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            word = self._word(part)
            if word != part:
                rest = part[len(word) :]
                ids = self[word] + self.stops[rest] if rest else self[word]
            elif self.plain and self._is_unit(word):
                ids = self._by_model(word)
            else:
                ids = self._by_tokenizer([word])[0]
        if len(part) <= KEPT:
            self[part] = ids
        return ids


class Encoder:
    """``encode(texts)`` gives each text's ids as bytes of little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, kind: str, limit: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        tokenizer = Tokenizer.from_file(path)
        self.dropped = kind == SPACE_DROPPED
        plain = words_are_plain(tokenizer) if self.dropped else units_are_plain(tokenizer)
        self.bare = _Parts(tokenizer, "", limit, self.dropped, None, plain)
        self.spaced = _Parts(tokenizer, " ", limit, False, self.bare, plain)

    def encode(self, texts: list[str], at_once: int = 200) -> list[bytes]:
        out = []
        for at in range(0, len(texts), at_once):
            self.bare.turn()
            self.spaced.turn()
            out += map(self._dropped if self.dropped else self._regular, texts[at : at + at_once])
        return out

    def _dropped(self, text: str) -> bytes:
        known = self.bare
        return b"".join([known[p] for p in text.replace("\n", " ").split(" ") if p])

    def _regular(self, text: str) -> bytes:
        """For single spaces and breaks only; other white space is left to the tokenizer."""
        out = []
        bare, spaced = self.bare, self.spaced
        if not text.isascii() and _odd(text) or not text.replace("\n", " ").isprintable():
            return self._irregular(text)
        for line in text.split("\n"):
            parts = line.split(" ")
            if not all(parts):
                return self._irregular(text)
            if out:
                out.append(bare["\n"])
            out.append(bare[parts[0]])
            if len(parts) > 1:
                out += map(spaced.__getitem__, parts[1:])
        return b"".join(out)

    def _irregular(self, text: str) -> bytes:
        """Cut only before a space that something other than white space follows."""
        parts = text.split(" ")
        held = parts[0]
        out = []
        first = True
        for part in parts[1:]:
            if not part or part[0].isspace():
                held += " " + part
            else:
                out.append((self.bare if first else self.spaced)[held])
                held, first = part, False
        out.append((self.bare if first else self.spaced)[held])
        return b"".join(out) if text else b""


def _odd(text: str) -> bool:
    """White space other than spaces and line breaks."""
    return len(text.split()) != len(text.replace("\n", " ").split(" "))


@functools.lru_cache(maxsize=4)
def encoder(path: str, kind: str, limit: int = 700_000) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path, kind, limit)
