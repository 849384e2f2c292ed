"""Public vocabularies, and encoding by unique pieces.

The tokenizers split a text before they merge within the pieces, so a piece
gives the same ids wherever it stands. Most pieces of a corpus are common
words; they are encoded once per worker and looked up from then on.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np

#: The longest piece that a worker remembers, in characters or bytes.
LONGEST = 48
#: How many words or pieces it remembers: about 0.3 KB each.
WORDS, PIECES = 100_000, 1_000_000


def path(name: str, folder: str | None = None) -> str:
    """The place of a vocabulary file: in ``folder``, or where the installed
    package of public vocabularies has it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


class Remembered:
    """Ids of lists of pieces as little-endian 32-bit numbers, by a memory of pieces.

    ``encode`` takes distinct pieces and the memory, and gives the bytes of the
    ids of each, and of other pieces if it likes. With more than ``most`` pieces
    the memory starts anew.
    """

    def __init__(self, encode: Callable[[list, dict], dict], most: int):
        self._encode, self._known, self._most = encode, {}, most

    def __call__(self, lists: list[list], end: bytes = b"") -> list[np.ndarray]:
        """The ids of each list, with those of ``end`` after them."""
        if len(self._known) > self._most:
            self._known = {}
        known = self._known
        found = [list(map(known.get, pieces)) for pieces in lists]
        gaps = [[i for i, ids in enumerate(ids_of) if ids is None] if None in ids_of else () for ids_of in found]
        new = list({pieces[i] for pieces, gap in zip(lists, gaps) for i in gap})
        if new:
            fresh = self._encode(new, known)
            for pieces, ids_of, gap in zip(lists, found, gaps):
                for i in gap:
                    ids_of[i] = fresh[pieces[i]]
            if max(map(len, fresh)) > LONGEST:
                fresh = {p: ids for p, ids in fresh.items() if len(p) <= LONGEST}
            known.update(fresh)
        return [np.frombuffer(b"".join(ids_of) + end, "<u4") for ids_of in found]


def id_bytes(ids: Sequence[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def piece_model(file: str) -> tuple[Remembered, np.ndarray]:
    """Encoder of words (UTF-8 bytes) by a sentencepiece model, and which ids are bytes."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=file)
    is_byte = np.array([model.is_byte(i) for i in range(model.vocab_size())])

    def encode(words: list[bytes], known: dict) -> dict[bytes, bytes]:
        return dict(zip(words, map(id_bytes, model.encode([w.decode() for w in words], num_threads=1))))

    return Remembered(encode, WORDS), is_byte


# ---- byte-level BPE --------------------------------------------------------------------

_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \n])")
#: Runs of white space, and white space other than spaces and line feeds.
_RUNS = ("  ", " \n", "\n ", "\n\n")
_ASCII_SPACES = tuple("\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x00")
_SPACES = tuple(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_HEADS, _MARKS = frozenset(" \n"), frozenset(".,;:!?")
_TAIL = "".join(sorted(_MARKS))
_JOINED = 128


def cut(text: str) -> list[str]:
    """A text cut before each space or line feed that follows other than white
    space: the tokenizer's pattern cuts there too, whatever stands around."""
    if (any(r in text for r in _RUNS) or any(c in text for c in _ASCII_SPACES)
            or not text.isascii() and any(c in text for c in _SPACES)):
        return _CUT.split(text)
    return text.replace("\n", "\0\n").replace(" ", "\0 ").split("\0")


class ByteLevel:
    """Ids of whole texts by a byte-level BPE file of the tokenizers library."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # tasks share the machine's cores already
        from tokenizers import Tokenizer
        self._model = Tokenizer.from_file(file)
        self._bytes = np.zeros(self._model.get_vocab_size(with_added_tokens=True), np.int64)
        for token, i in self._model.get_vocab(with_added_tokens=True).items():
            self._bytes[i] = len(token)      # a character of the vocabulary is a byte of the text
        self._pieces = Remembered(self._encode_new, PIECES)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [id_bytes(e.ids) for e in self._model.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_new(self, pieces: list[str], known: dict[str, bytes]) -> dict[str, bytes]:
        """Marks after a letter are pieces of their own to the tokenizer's pattern,
        so a word is encoded once, whatever marks follow it."""
        parts, new, words = {}, [], set()
        for p in pieces:
            if p[-1:] in _MARKS and (word := p.rstrip(_TAIL))[-1:].isalpha() and word[-1].isascii():
                parts[p] = word, p[len(word):]
                words.update(parts[p])
            else:
                new.append(p)
        out = self._encode(new + [w for w in words.difference(new) if w not in known])
        get = lambda p: out[p] if p in out else known[p]
        out.update([(p, get(word) + get(marks)) for p, (word, marks) in parts.items()])
        return out

    def _encode(self, pieces: list[str]) -> dict[str, bytes]:
        """Pieces that begin with white space and don't end with it are encoded many
        at a time, as one text; the bytes that ids stand for tell where each ends."""
        out: dict[str, bytes] = {}
        plain, others = [], []
        for p in pieces:
            (plain if p[:1] in _HEADS and not p[-1].isspace() else others).append(p)
        for lo in range(0, len(plain), _JOINED):
            part = plain[lo:lo + _JOINED]
            ids = self._ids(["".join(part)])[0]
            ends = np.cumsum(list(map(len, map(str.encode, part))))
            at = (4 * np.searchsorted(np.cumsum(self._bytes[np.frombuffer(ids, "<u4")]), ends, "right")).tolist()
            out.update(zip(part, map(ids.__getitem__, map(slice, [0, *at[:-1]], at))))
        if others:
            out.update(zip(others, self._ids(others)))
        return out

    def __call__(self, texts: list[str], end: int | None = None) -> list[np.ndarray]:
        """The ids of each text, with the id ``end`` after them."""
        return self._pieces(list(map(cut, texts)), b"" if end is None else id_bytes([end]))


@lru_cache(maxsize=2)
def byte_level(file: str) -> ByteLevel:
    return ByteLevel(file)
