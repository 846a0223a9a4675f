"""Token ids of whole texts, with a memory for words.

The word vocabulary drops white space and never merges across it, so the ids of a text are the
ids of its white-space separated words one after another. Words repeat far more often than
texts: each worker encodes a word once with the tokenizers library and then joins packed ids.
Only ASCII white space separates here; a word with any other unusual character goes through the
library whole, so the ids equal the library's for the whole text.
"""

from __future__ import annotations

import re
import sys
from array import array
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1
VOCABULARY = "word_bpe_49k.json"
#: Words and pieces of words that a worker remembers; beyond that it forgets all of them.
WORDS, PIECES = 300_000, 800_000

# The split pattern of the vocabulary file and the characters for which Python's
# lower-casing and letter classes agree with the library's.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|[^\sa-zß-öø-ÿ0-9]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_MARKS = b"!\"#$%&'()*+,-./:;=>?@[\\]^_`{|}~"


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for letters from
    U+0100 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, more = {}, 0
    for b in range(256):
        out[b] = chr(b if b in shown else 256 + more)
        more += b not in shown
    return out


class WordEncoder:
    """``encode(utf8) -> bytes``: the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {}
        self.memory = self._Memory(self)

    class _Memory(dict):
        def __init__(self, owner: WordEncoder):
            self.owner = owner

        def __missing__(self, word: bytes) -> bytes:
            if len(self) >= WORDS:
                self.clear()
            ids = self.owner._word(word)
            if len(word) <= 64:
                self[word] = ids
            return ids

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            ids = packed([t.id for t in self.model.tokenize(mapped)])
            if len(piece) <= 64:
                if len(self.pieces) >= PIECES:
                    self.pieces.clear()
                self.pieces[piece] = ids
        return ids

    def _word(self, word: bytes) -> bytes:
        core = word.rstrip(_MARKS)
        if core.isalpha() and len(word) <= 1000:  # ASCII letters, then marks: two pieces at most
            ids = self._piece(core.decode().lower())
            return ids + self._piece(word[len(core) :].decode()) if len(core) < len(word) else ids
        text = word.decode("utf-8", "replace")
        if len(text) <= 1000 and "<|" not in text and _PLAIN.fullmatch(text):
            return b"".join(map(self._piece, _PIECES.findall(text.lower())))
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.memory.__getitem__, text.split()))

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of a binary column of UTF-8 texts: all ids in a row, and the n + 1 places where the
        texts begin and end. Each distinct word of the column is looked up once."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        words = pc.ascii_split_whitespace(texts.fill_null(b"").view(pa.string()))
        bounds = words.offsets.to_numpy()
        coded = words.values.slice(bounds[0], bounds[-1] - bounds[0]).view(pa.binary()).dictionary_encode()
        found = [self.memory[w] for w in coded.dictionary.to_pylist()]
        table = np.frombuffer(b"".join(found), dtype="<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        firsts = np.cumsum(sizes) - sizes
        index = coded.indices.to_numpy()
        lengths = sizes[index]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
        at = np.repeat(firsts[index] - ends[:-1], lengths) + np.arange(ends[-1])
        return table[at], ends[bounds - bounds[0]]


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    return np.insert(ids, bounds[1:], end_id).astype("<u4", copy=False), bounds + np.arange(len(bounds))


@cache
def encoder(path: str) -> WordEncoder:
    """One encoder a worker process and vocabulary."""
    return WordEncoder(path)
