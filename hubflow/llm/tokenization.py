"""Whole texts to token ids with a byte-level BPE of the ``tokenizers`` library.

The BPE never merges across its pre-tokens, so a text's ids are the ids of its pre-tokens in a row, and a worker asks
the library once for each distinct one that it keeps.  Texts of the characters of ``PLAIN`` are cut into pre-tokens by
the pattern below.  Others are cut before the spaces that start a word, which no pre-token crosses; their pieces
with rarer characters, and texts with separator controls, go through the library's whole pipeline.
"""

from __future__ import annotations

import itertools
import re

import numpy as np

from hubflow.llm.common import slices

#: The letter and number classes of the pre-tokenizer within Latin and Latin Extended A/B,
#: its contractions, and the characters for which these classes are complete.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
PRETOKENS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+")
PLAIN = re.compile("[\x00-\x1b -ɏ‐-‧‰-⁞€]*")
RUNS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
SEPARATORS = re.compile("[\x1c-\x1f]")
#: Pieces longer than this are not kept.  A worker keeps this many pieces (some 130 bytes each), the first ones it
#: meets, frequent ones among them; it starts anew after MISSES times as many that it could not keep.
KEPT_CHARS, KEPT_PIECES, MISSES = 40, 600_000, 8
#: Characters beyond which a text is cut into pieces little by little, and pieces taken at a time then.
LONG_TEXT, AT_ONCE = 1 << 18, 1 << 16


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Encoder:
    """ids(text) -> the text's ids; ``dtype`` is the narrowest that holds the vocabulary."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # a special token's string within a text is ordinary text
        self.size = max(self.library.get_vocab().values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.width = self.dtype.itemsize
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.space = self.alphabet[32]
        self.merge = self.library.model.tokenize
        self.id_bytes = [i.to_bytes(self.width, "little") for i in range(self.size)]
        self.known: dict[str, bytes] = {}
        self.missed = 0

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _pretoken(self, part: str) -> bytes:
        """A pre-token goes straight to the library's merges."""
        if part.isascii() and part.isprintable():
            shown = part.replace(" ", self.space)
        else:
            shown = part.encode().decode("latin-1").translate(self.alphabet)
        id_bytes = self.id_bytes
        return b"".join([id_bytes[t.id] for t in self.merge(shown)])

    def _piece(self, text: str) -> bytes:
        if len(text) > KEPT_CHARS or not PLAIN.fullmatch(text):
            return self._whole(text)
        return b"".join(map(self._pretoken, PRETOKENS.findall(text)))

    def _keep(self, key: str, ids: bytes) -> None:
        if len(self.known) < KEPT_PIECES:
            self.known[key] = ids
        else:
            self.missed += 1
            if self.missed > MISSES * KEPT_PIECES:
                self.known, self.missed = {}, 0

    def _joined(self, keys: list[str], ids_of) -> bytes:
        known = self.known
        found, at = list(map(known.get, keys)), -1
        fresh: dict[str, bytes] = {}
        try:
            while True:
                at = found.index(None, at + 1)
                key = keys[at]
                if (ids := fresh.get(key)) is None:
                    ids = fresh[key] = ids_of(key)
                    if len(key) <= KEPT_CHARS:
                        self._keep(key, ids)
                found[at] = ids
        except ValueError:  # none is missing any more
            pass
        return b"".join(found)

    def ids(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if SEPARATORS.search(text):
            return np.frombuffer(self._whole(text), self.dtype)
        cut, ids_of = (PRETOKENS, self._pretoken) if PLAIN.fullmatch(text) else (RUNS, self._piece)
        if len(text) <= LONG_TEXT:
            return np.frombuffer(self._joined(cut.findall(text), ids_of), self.dtype)
        pieces = (m.group() for m in cut.finditer(text))
        return np.frombuffer(b"".join(iter(lambda: self._joined(list(itertools.islice(pieces, AT_ONCE)), ids_of), b"")), self.dtype)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(path: str, texts, end_id: int | None):
    """(position, ids) of each text of an Arrow column, null as empty; ``end_id`` is appended."""
    coder = encoder(path)
    tail = np.array([] if end_id is None else [end_id], coder.dtype)
    for first, some in slices(texts):
        for i, text in enumerate(some):
            yield first + i, np.concatenate([coder.ids(text or ""), tail])


def vocabulary_size(path: str) -> int:
    return encoder(path).size
