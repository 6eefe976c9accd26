"""Words of texts and what models make of each distinct word, within tasks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa


class Words:
    """Runs of letters in lower case; if ``longest`` is given, longer runs come in pieces of so many letters."""

    def __init__(self, longest: int | None):
        self.pattern = re.compile(r"[^\W\d_]{1,%d}" % longest if longest else r"[^\W\d_]+")

    def of(self, text: str | None) -> list[str]:
        return self.pattern.findall((text or "").lower())

    def slices(self, text: str | None, n: int, overlap: int = 0) -> Iterator[list[str]]:
        """All words in slices of ``n``, each with the last ``overlap`` words of the one before."""
        if len(text or "") <= n:
            yield self.of(text)
            return
        found = (m.group() for m in self.pattern.finditer(text.lower()))
        part = list(islice(found, n))
        yield part
        while more := list(islice(found, n - overlap)):
            part = part[len(part) - overlap :] + more
            yield part


class WordRows:
    """Rows of numbers by word, worked out once per distinct word and kept up to ``limit`` words, of 100 letters each."""

    def __init__(self, compute: Callable[[list[str]], np.ndarray], limit: int):
        self.compute, self.limit = compute, limit
        self.index: dict[str, int] = {}
        self.letters = 0
        self.rows = np.empty((0, 0), np.float32)

    def lookup(self, words: list[str]) -> np.ndarray:
        """Row numbers of the words; they hold until the next call."""
        new = {w for w in words if w not in self.index}
        if new:
            self.letters += sum(map(len, new))
            if len(self.index) + len(new) > self.limit or self.letters > 100 * self.limit:
                self.index.clear()
                new = set(words)
                self.letters = sum(map(len, new))
            made, n = self.compute(list(new)), len(self.index)
            self.index.update(zip(new, range(n, n + len(new))))
            if n + len(new) > len(self.rows) or not n:
                # Room for all at once: memory is taken as rows are filled, and nothing is copied as they grow.
                grown = np.empty((max(self.limit, n + len(new)), made.shape[1]), made.dtype)
                grown[:n] = self.rows[:n] if n else 0
                self.rows = grown
            self.rows[n : n + len(new)] = made
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))


def gathered(
    words: Words, batches: Iterator[pa.RecordBatch], text_at: int, n: int, overlap: int = 0
) -> Iterator[tuple[pa.RecordBatch, Iterator[tuple[np.ndarray, list[str]]]]]:
    """Each batch with its words in lots of about ``n``: (documents' numbers of words as (row, count), words).

    Lots are made as they are taken, so that only one is in memory.
    """

    def lots(texts: pa.Array) -> Iterator[tuple[np.ndarray, list[str]]]:
        rows, held = [], []
        for i, text in enumerate(texts):
            for part in words.slices(text.as_py(), n, overlap):
                rows.append((i, len(part)))
                held += part
                if len(held) >= n:
                    yield np.array(rows), held
                    rows, held = [], []
        if rows:
            yield np.array(rows), held

    for batch in batches:
        yield batch, lots(batch.column(text_at))
