"""Token ids of whole texts by the tokenizers library, with a bounded memory of the pieces a text is cut into.

Both public vocabularies cut a text into pieces before any merge, so ids of a piece do not depend on its neighbours:
the library gives the ids of each distinct piece once and a text's ids are joined from them. The cut is only used for
characters for which it is exact (below); any other text goes through the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np

from chronolith.llm.text import Memo

#: Bytes of pieces, and of words inside them, that a worker remembers before it starts afresh.
PIECE_BYTES, WORD_BYTES = 64 << 20, 48 << 20
#: Characters for which letters, digits, white space and case are the same in every Unicode version in use.
_UNSURE = re.compile("[^\t-\r -~¡-įı-ɏ]")
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
_BYTE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
_SURE = bytes([*range(9, 14), *range(32, 127), *range(161, 256)])  # of the characters up to U+00FF
#: White space that a byte-level text may not hold if it is to be cut at every space and line end.
_ODD_SPACE = ("\t", "\v", "\f", "\r", "  ", "\n\n", " \n", "\n ")


def sure(text: str) -> bool:
    """True if the cut below is exact for every character of ``text``."""
    try:
        return not text.encode("latin-1").translate(None, _SURE)
    except UnicodeEncodeError:
        return not _UNSURE.search(text)


#: A place where a byte-level text can always be parted: before one space between two characters that are not white space.
_SAFE = re.compile(r"(?<=\S)(?= \S)")
LONG = 1 << 16
#: Characters that one call of the library encodes.
BATCH_CHARS = 1 << 18


def byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _lowers(library) -> bool:
    """Whether a vocabulary lower-cases words that white space parts, or takes bytes as they are; other layouts are an error."""
    if library.normalizer is None:
        return False
    steps = json.loads(library.normalizer.__getstate__())
    kinds = [x["type"] for x in steps.get("normalizers", [steps])]
    if kinds != ["NFC", "Replace", "Lowercase"]:
        raise ValueError(f"no encoder for a vocabulary with the normalizers {kinds}")
    return True


class Encoder:
    """ids(text) as little-endian uint16 bytes and count(text), without added special tokens; special strings inside texts as the library takes them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        if self.library.get_vocab_size() > 1 << 16 or sys.byteorder != "little":
            raise ValueError("ids of more than 16 bits, or a big-endian machine")
        self.lower = _lowers(self.library)
        self.alphabet = byte_alphabet()
        tokens = self.library.get_added_tokens_decoder()
        self.special = {t.content: np.array([i], "<u2").tobytes() for i, t in tokens.items()}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words, self.made = Memo(self._of_word, WORD_BYTES), Memo(self._of_piece, PIECE_BYTES)
        self.model, self.cut = self.library.model, (_WORD if self.lower else _BYTE).findall

    def _of_word(self, word: str) -> bytes:
        if not (word.isascii() and word.isalnum()):
            word = word.encode().decode("latin-1").translate(self.alphabet)
        return array("H", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _of_piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():
            return self._of_word(piece)
        return b"".join(map(self.words.__getitem__, self.cut(piece)))

    def _plain(self, text: str) -> list[str] | None:
        """Pieces of a text without special strings; None if the library has to cut it."""
        if not sure(text):
            return None
        if self.lower:
            return text.lower().split()
        if text[0] in " \n" or text[-1] in " \n" or any(x in text for x in _ODD_SPACE):
            return _BYTE.findall(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def _parts(self, text: str) -> list[str]:
        """A long byte-level text at safe boundaries in parts of about ``LONG`` characters; another text as it is."""
        if self.lower or len(text) <= LONG:
            return [text]
        out, at = [], 0
        while len(text) - at > LONG and (m := _SAFE.search(text, at + LONG)):
            out.append(text[at : m.start()])
            at = m.start()
        return [*out, text[at:]]

    def _whole(self, text: str) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.library.encode_batch_fast(self._parts(text), add_special_tokens=False)]

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" in text and self.cut_special and self.cut_special.search(text):
            return b"".join(self.special[p] if p in self.special else self.ids(p) for p in self.cut_special.split(text))
        pieces = self._plain(text)
        return b"".join(self._whole(text) if pieces is None else map(self.made.__getitem__, pieces))

    def counts(self, texts: list[str | None]) -> list[int]:
        """Numbers of ids of ``texts``: their parts go to the library as batches of about ``BATCH_CHARS`` characters."""
        out, batch, owners, room = [0] * len(texts), [], [], BATCH_CHARS

        def done() -> None:
            for i, e in zip(owners, self.library.encode_batch_fast(batch, add_special_tokens=False), strict=True):
                out[i] += len(e)
            batch.clear(), owners.clear()

        for i, text in enumerate(texts):
            for part in self._split(text or ""):
                batch.append(part), owners.append(i)
                room -= len(part)
                if room <= 0:
                    done()
                    room = BATCH_CHARS
        done()
        return out

    def _split(self, text: str) -> Iterator[str]:
        """``text``, or a long one's parts at safe boundaries; special strings are never parted."""
        if len(text) <= LONG or "<|" not in text or not self.cut_special or not self.cut_special.search(text):
            yield from self._parts(text)
        else:
            for p in self.cut_special.split(text):
                yield from [p] if p in self.special else self._parts(p)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    return _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
