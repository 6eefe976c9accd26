"""Exact tokenisation with a word memo, for use inside tasks."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np

# Both neighbours of a space are white space (or the text ends): words cannot be taken apart there.
_RUN = re.compile(r"\s (?=\s|\Z)")
_CUT = re.compile(r"(?<=\w) (?=\w)")
# Letters that no normalisation changes but to lower case, marks, and perhaps letters on the next line.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-^`{-~]*)(?:(\n)([A-Za-zÀ-ÖØ-öø-ÿ]+))?")
# How byte vocabularies write the bytes of longer characters: fixed values.
_BYTE_SIGNS = {ord(" "): " "} | {b: 256 + 33 + b - 127 for b in range(127, 161)} | {173: 256 + 67}


class _Memo(dict):
    """Ids by word; what is missing is taken from an older memo, where words used lately are, or else made."""

    def __init__(self, make: Callable[[str], bytes], older: dict[str, bytes]):
        super().__init__()
        self.make, self.older = make, older

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.older.get(word) or self.make(word)
        return ids


class WordEncoder:
    """Token ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    Pre-tokenisation never joins characters across a single space, so ids of
    space-separated words are looked up in a memo. A new word made of letters only
    goes to the vocabulary's model directly, any other one through the whole
    tokenizer. Texts with runs of white space or special tokens are encoded whole.
    Ids are little-endian unsigned integers of 16 bits if the vocabulary fits, else 32.

    ``limit`` bounds either half of the memo, ``slice_chars`` the text
    that is split at once.
    """

    def __init__(self, path: str, limit: int = 400_000, slice_chars: int = 1 << 16):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit, self.slice_chars = limit, slice_chars
        # Codes of the array module and of numpy alike.
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._memo = _Memo(self._word, {})
        self._known_marks: dict[str, bytes] = {}
        self._special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A word vocabulary gives the same ids with and without the space before, a byte one does not.
        self._space = "Ġ" if self._whole(" a") != self._whole("a") else ""
        self._lower = self._whole("A") == self._whole("a")

    def _whole(self, text: str) -> bytes:
        return array(self.dtype.char, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, text: str) -> bytes:
        """Ids of letters, with a space before them or not, that pre-tokenisation keeps together."""
        if self._lower:
            text = text.lower()
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(_BYTE_SIGNS)
        return array(self.dtype.char, [t.id for t in self.tokenizer.model.tokenize(text.replace(" ", self._space))]).tobytes()

    def _marks(self, text: str) -> bytes:
        if text not in self._known_marks:
            if len(self._known_marks) > 10_000:
                self._known_marks.clear()
            self._known_marks[text] = self._whole(text)
        return self._known_marks[text]

    def _word(self, word: str) -> bytes:
        """Ids of a word with the space before it."""
        if word.isascii() and word.isalpha():
            return self._letters(" " + word)
        m = _PLAIN.fullmatch(word)
        if not m:
            return self._whole(" " + word)
        head, marks, line, next_ = m.groups()
        out = self._letters(" " + head)
        if marks:
            out += self._marks(marks)
        if line:
            out += self._marks("\n") + self._letters(next_)
        return out

    def _slice(self, text: str) -> bytes:
        if _RUN.search(text) or any(s in text for s in self._special):
            return self._whole(text)
        head, *words = text.split(" ")
        if len(self._memo) > self.limit:
            self._memo.older = {}
            self._memo = _Memo(self._word, self._memo)
        body = b"".join(map(self._memo.__getitem__, words))
        return (self._whole(head) if head else b"") + body

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text; none for a null."""
        if not text:
            return b""
        parts, at = [], 0
        while len(text) - at > self.slice_chars:
            cut = _CUT.search(text, at + self.slice_chars)
            if not cut:
                break
            parts.append(self._slice(text[at : cut.start()]))
            at = cut.start()
        parts.append(self._slice(text[at:] if at else text))
        return b"".join(parts)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and vocabulary."""
    return WordEncoder(path)


def crc32_of_ids(ids: np.ndarray) -> int:
    """CRC of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
