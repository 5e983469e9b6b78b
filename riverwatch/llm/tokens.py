"""Token ids and offsets of whole texts, encoded chunk by chunk with a cache.

The byte-level pre-tokenizer never joins a space before a non-space character
to what comes before it. A text can therefore be cut before each such space,
and the ids of the parts, one after the other, are the ids of the whole text.
Strings of added tokens get their own ids wherever they stand in a text, as in
a plain call of the tokenizer, so a text is cut around them first.
Words repeat, so most parts come from a cache instead of the tokenizer. The
cache only saves time; it is bounded.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

TOKENIZER = "byte_bpe_50k.json"
ROOM = 600_000  # cached parts in a worker, as many again kept aside

_SPACE_BEFORE_WHITE = re.compile(r" \s").search
_CUT = re.compile(r" (?=\S)").split


def default_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def parts_of(text: str) -> list[str]:
    """The text cut at every space that a non-space character follows; that space is dropped."""
    return _CUT(text) if _SPACE_BEFORE_WHITE(text) else text.split(" ")


#: A word, marks, and perhaps a line end with a word and marks after it. Their bounds are
#: bounds of the pre-tokenizer too, and each of them is one of its parts.
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
_MARKS = "[!-/:-@\\[-`{-~]*"
_PLAIN = re.compile(f"({_LETTERS})({_MARKS})(?:(\n)({_LETTERS})({_MARKS}))?").fullmatch


class _Cache(dict):
    """Values by part, made when missing. Once full it is kept aside and refilled from there."""

    def __init__(self, make, room: int):
        super().__init__()
        self.make, self.room, self.aside = make, room, {}

    def store(self, part: str, value):
        if len(self) >= self.room:
            self.aside = dict(self)
            self.clear()
        self[part] = value
        return value

    def __missing__(self, part: str):
        value = self.aside.get(part)
        return self.store(part, self.make(part) if value is None else value)


class _Parts(_Cache):
    """Values of a space and the part, which can be put together from those of its pieces.

    What a line end divides is put together each time and not kept."""

    def __init__(self, encode, single, room: int):
        super().__init__(encode, room)
        self.single, self.bare = single, _Cache(single, room // 4)

    def __missing__(self, part: str) -> bytes:
        value = self.aside.get(part)
        if value is None:
            if not (plain := _PLAIN(part)):
                value = self.make(" " + part)
            else:
                word, marks, line, after, more = plain.groups()
                if not marks and not line:
                    value = self.single(" " + word)
                else:
                    value = self[word] + self.bare[marks] if marks else self[word]
                    if line:
                        value += self.bare[line] + self.bare[after]
                        return value + self.bare[more] if more else value
        return self.store(part, value)


class Encoder:
    """Encodes texts with the byte-level tokenizer file at ``path``."""

    def __init__(self, path: str, room: int = ROOM):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self._added = {c: array("I", [i]).tobytes() for c, i in added.items()}
        self._cut = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or "(?!)")
        # byte-level spelling of the characters of plain parts, for the model itself
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self._spelling = {c: spell(chr(c))[0][0] for c in range(0x250)}
        self._model = self.tokenizer.model
        self._ids = _Parts(self._encode_ids, self._encode_single, room)
        self._spans = _Parts(self._encode_steps, self._single_steps, room)

    def _encode_ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _encode_single(self, text: str) -> bytes:
        """Ids of a text that is one part of the pre-tokenizer, of characters below U+0250."""
        found = self._model.tokenize(text.translate(self._spelling))
        return array("I", [t.id for t in found]).tobytes()

    def _encode_steps(self, text: str) -> bytes:
        """(step to the next token's start, length) of each token, in characters of the text."""
        spans = np.array(self.tokenizer.encode(text, add_special_tokens=False).offsets,
                         dtype="<i4").reshape(-1, 2)
        steps = np.diff(spans[:, 0], append=np.int32(len(text)))
        return np.stack([steps, spans[:, 1] - spans[:, 0]], axis=1).astype("<i4").tobytes()

    def _single_steps(self, text: str) -> bytes:
        """The same for one part of the pre-tokenizer; in ASCII a token is as long as its spelling."""
        if not text.isascii():
            return self._encode_steps(text)
        found = self._model.tokenize(text.translate(self._spelling))
        return array("i", [n for t in found for n in (len(t.value),) * 2]).tobytes()

    def segments(self, text: str) -> list[tuple[str, bool]]:
        """The text cut around added tokens: (string, whether it is one)."""
        out, at = [], 0
        for m in self._cut.finditer(text):
            out += [(text[at:m.start()], False), (m[0], True)]
            at = m.end()
        return out + [(text[at:], False)]

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        return b"".join(self._added[s] if added else self._plain_ids(s)
                        for s, added in self.segments(text))

    def _plain_ids(self, text: str) -> bytes:
        parts = parts_of(text)
        first = parts.pop(0)
        if plain := _PLAIN(first):  # no space before it, so its pieces stand for themselves
            return b"".join(map(self._ids.bare.__getitem__, filter(None, plain.groups()))) + b"".join(
                map(self._ids.__getitem__, parts))
        return self._encode_ids(first) + b"".join(map(self._ids.__getitem__, parts))

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each token in code points of the text."""
        pairs = np.frombuffer(b"".join(
            array("i", [len(s)] * 2).tobytes() if added else self._plain_steps(s)
            for s, added in self.segments(text)), dtype="<i4")
        ends = np.cumsum(pairs[::2], dtype=np.int64)
        starts = ends - pairs[::2]
        return starts, starts + pairs[1::2]

    def _plain_steps(self, text: str) -> bytes:
        parts = parts_of(text)
        first = self._encode_steps(parts.pop(0))
        return first + b"".join(map(self._spans.__getitem__, parts))


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and tokenizer file."""
    return Encoder(path)
