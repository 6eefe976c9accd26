"""Quality scores by histogram gradient-boosted trees over statistics of documents.

A document is described by numbers only: shares of kinds of characters, lengths of words,
how often words and lines repeat. Trees are grown on binned statistics, level by level, from
histograms of gradients, and are kept as flat arrays that whole blocks of documents walk at
once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import bounded_batches
from scrubline.llm.hashing import mixed, piece_hashes, prefix_hashes
from scrubline.llm.language_id import fold_of

STATISTICS = (
    "log_bytes", "log_words", "word_mean", "word_deviation", "blank", "upper", "digit", "mark", "symbol", "beyond_ascii",
    "line_end", "words_per_line", "ends_in_symbol", "capitalised", "no_letter", "short_words", "long_words", "vowels",
    "words_per_sentence", "repeated_next", "distinct_words", "top_word", "distinct_pairs", "distinct_lines", "entropy",
    "top_symbol", "top_byte",
)
SEGMENT_BYTES, GROUP_BYTES = 1 << 20, 2 << 20
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
OTHER, BLANK, UPPER, LOWER, DIGIT, MARK, SYMBOL, BEYOND = range(8)


def _kinds() -> np.ndarray:
    kind = np.full(256, OTHER, np.uint8)
    kind[33:127] = SYMBOL
    kind[list(b" \t\n\v\f\r")] = BLANK
    kind[65:91], kind[97:123], kind[48:58] = UPPER, LOWER, DIGIT
    kind[list(b".,;:!?'\"()-")] = MARK
    kind[128:] = BEYOND
    return kind


KIND = _kinds()
IS_SYMBOL, IS_LETTER = KIND == SYMBOL, np.isin(KIND, (UPPER, LOWER, BEYOND))
FOLD = np.where(KIND == UPPER, np.arange(256) + 32, np.arange(256)).astype(np.uint8)
VOWELS = np.array(list(b"aeiouAEIOU"))
# What adds up over the segments of a document.
SUMS = ("words", "length", "squares", "symbol_ends", "capitals", "bare", "short", "long", "again")


def _segments(text: bytes) -> Iterator[bytes]:
    """A text in segments that end before a blank (or anywhere, in words of a megabyte)."""
    at = 0
    while len(text) - at > SEGMENT_BYTES:
        cut = text.find(b" ", at + SEGMENT_BYTES, at + 2 * SEGMENT_BYTES)
        cut = cut if cut > 0 else min(at + 2 * SEGMENT_BYTES, len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def _measure(data: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Per document the counts of its bytes and its sums; (document, key, key of two) of its words."""
    counts = np.bincount(owner * 256 + data, minlength=n * 256).reshape(n, 256)
    kind = KIND[data]
    inside = np.concatenate([[False], kind != BLANK, [False]])
    # Documents are a blank apart.
    start = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    end = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    doc, length = owner[start], (end - start).astype(np.float64)
    letters = np.concatenate([[0], np.cumsum(IS_LETTER[data])])
    word = mixed(piece_hashes(prefix_hashes(FOLD[data]), start, end))
    follows = np.zeros(len(start), bool)
    follows[:-1] = doc[1:] == doc[:-1]
    following = np.append(word[1:], word[:1])
    flags = (
        np.ones(len(start)), length, length * length, IS_SYMBOL[data[end - 1]] if len(end) else length,
        KIND[data[start]] == UPPER, letters[end] == letters[start], length <= 2, length > 15, follows & (following == word),
    )
    sums = np.stack([np.bincount(doc, f, n) for f in flags], axis=1)
    pair = np.where(follows, mixed(word * np.uint64(0x9E3779B97F4A7C15) + following), np.uint64(0))
    return counts, sums, (doc, word, pair)


def _distinct(doc: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document how many different keys it has, and how often the most usual one comes."""
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])) if len(doc) else order
    times, most = np.diff(np.append(new, len(doc))), np.zeros(n)
    np.maximum.at(most, doc[new], times)
    return np.bincount(doc[new], minlength=n), most


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``STATISTICS`` per text; a text without words has zeros but for its characters."""
    n = len(texts)
    counts, sums = np.zeros((n, 256)), np.zeros((n, len(SUMS)))
    words: list[tuple] = []
    lot: list[tuple[int, bytes]] = []

    def settle() -> None:
        rows, parts = zip(*lot)
        data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
        at, local = np.unique(rows, return_inverse=True)
        owner = np.repeat(local, [len(p) + 1 for p in parts])
        c, s, (doc, word, pair) = _measure(data, owner, len(at))
        counts[at] += c
        counts[at, 32] -= np.bincount(local, minlength=len(at))  # the blanks put between
        sums[at] += s
        words.append((at[doc], word, pair))
        lot.clear()

    size = 0
    for i, text in enumerate(texts):
        for segment in _segments(text):
            lot.append((i, segment))
            size += len(segment)
            if size >= SEGMENT_BYTES:
                settle()
                size = 0
    if lot:
        settle()
    doc, word, pair = (np.concatenate(c) for c in zip(*words)) if words else (np.empty(0, np.int64),) * 3
    distinct, most = _distinct(doc, word, n)
    pairs, _ = _distinct(doc[pair != 0], pair[pair != 0], n)
    total = counts.sum(1)
    kinds = np.stack([counts[:, KIND == k].sum(1) for k in range(8)], axis=1)
    ends = counts[:, list(b".!?")].sum(1)
    n_lines = counts[:, 10] + 1
    n_distinct_lines = np.array([len(set(t.split(b"\n"))) for t in texts], np.float64)
    n_words, length, squares, symbol_ends, capitals, bare, short, long, again = sums.T

    def share(x: np.ndarray, of: np.ndarray) -> np.ndarray:
        return x / np.maximum(of, 1)

    mean, p = share(length, n_words), share(counts, total[:, None])
    table = (
        np.log1p(total), np.log1p(n_words), mean, np.sqrt(np.maximum(share(squares, n_words) - mean * mean, 0)),
        share(kinds[:, BLANK], total), share(kinds[:, UPPER], total), share(kinds[:, DIGIT], total), share(kinds[:, MARK], total),
        share(kinds[:, SYMBOL], total), share(kinds[:, BEYOND], total), share(counts[:, 10], total), share(n_words, n_lines),
        share(symbol_ends, n_words), share(capitals, n_words), share(bare, n_words), share(short, n_words), share(long, n_words),
        share(counts[:, VOWELS].sum(1), kinds[:, UPPER] + kinds[:, LOWER]), share(n_words, ends + 1), share(again, n_words),
        share(distinct, n_words), share(most, n_words), share(pairs, n_words - 1), share(n_distinct_lines, n_lines),
        -(p * np.log(np.where(p > 0, p, 1))).sum(1), share(counts[:, IS_SYMBOL].max(1), total), p.max(1),
    )
    return np.stack(table, axis=1)


# -- trees ---------------------------------------------------------------------


@dataclass
class Trees:
    """Complete trees in flat arrays: row t holds tree t, a node's children are 2 i + 1 and 2 i + 2."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 by row; rows and trees walk down together."""
        inner, trees = self.feature.shape[1], np.arange(len(self.feature))
        rows, out = np.arange(len(x))[:, None], np.zeros(len(x), np.int64)[:, None] + np.zeros(len(trees), np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            right = x[rows, self.feature[trees, out]] > self.threshold[trees, out]
            out = 2 * out + 1 + right
        logit = self.base + self.value[trees, out - inner].sum(1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, least: float = 5.0, ridge: float = 1.0
) -> Trees:
    """Boosted trees of logistic loss. Each row counts alike; without both labels the score is constant."""
    inner = 2**depth - 1
    ones = float(y.sum())
    base = float(np.log((ones + 0.5) / (len(y) - ones + 0.5)))
    flat = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    if not 0 < ones < len(y):
        return flat
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    place = binned + np.arange(width) * bins
    logit = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-logit))
        slope, bend = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            m = 2**level
            at = ((node - (m - 1)) * (width * bins))[:, None] + place
            g, h, c = (
                np.bincount(at.ravel(), w, m * width * bins).reshape(m, width, bins).cumsum(2)
                for w in (np.repeat(slope, width), np.repeat(bend, width), None)
            )
            all_g, all_h, all_c = g[:, :1, -1:], h[:, :1, -1:], c[:, :1, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(c < least) | (all_c - c < least)] = -1
            best = gain.reshape(m, -1).argmax(1)
            good = gain.reshape(m, -1)[np.arange(m), best] > 1e-9
            f, cut = best // bins, best % bins
            nodes = m - 1 + np.arange(m)
            flat.feature[t, nodes] = np.where(good, f, 0)
            flat.threshold[t, nodes] = [edges[f[i]][cut[i]] if good[i] else np.inf for i in range(m)]
            mine = node - (m - 1)
            right = good[mine] & (binned[np.arange(n), f[mine]] > cut[mine])
            node = 2 * node + 1 + right
        leaf = node - inner
        flat.value[t] = -rate * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, bend, inner + 1) + ridge)
        logit = logit + flat.value[t][leaf]
    return flat


# -- over documents ------------------------------------------------------------


def training_sample(
    docs: DataFrame, labels: DataFrame, per_class: int = 3000, label: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of up to ``per_class`` documents of each label, by hash, outside fold 1 of 3.

    Only these bounded rows of numbers come to the driver. An id with several labels counts
    by the highest, one with several texts by the least.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & (fold_of(id_col, 3) != 1))
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.max(label).alias("__label"))
    first, second = (known.filter(F.col("__label") == v).orderBy(F.xxhash64("__id"), "__id").limit(per_class) for v in (0, 1))
    sample = first.unionByName(second)
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    texts = texts.join(F.broadcast(sample), "__id").groupBy("__id", "__label").agg(F.min("__text").alias("__text"))
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in described(batches, 2):
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), values], ["id", "label", "x"])

    kind = f"id {dict(docs.dtypes)[id_col]}, label {dict(labels.dtypes)[label]}, x array<double>"
    rows = texts.mapInArrow(run, kind).orderBy("id").toArrow()
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(-1, len(STATISTICS))
    return x, np.array(rows.column("label").to_pylist(), np.float64)


def described(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches of about ``GROUP_BYTES`` of text, with their statistics."""
    for batch in batches:
        column = batch.column(text_at).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1])
        at, group = 0, np.cumsum(sizes) // GROUP_BYTES if len(sizes) else sizes
        for cut in [*(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]:
            if cut > at:
                yield batch.slice(at, cut - at), statistics([t or b"" for t in column.slice(at, cut - at).to_pylist()])
            at = cut


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score of every whole text: doc_id, held_out, score, predicted.

    Null texts are empty, and empty texts are scored by their statistics like others. Rows
    with equal ids are each scored; other columns play no part.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in described(batches, 2):
            value = shared.value.scores(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value), pa.array((value >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    held_out = (fold_of(id_col, 3) == 1).alias("held_out")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out, F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
