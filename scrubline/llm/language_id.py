"""Language identification with unigrams that are marginalised over segmentations.

Each language has a probability per piece of a fixed public vocabulary. The probability
of a word is the sum over all ways to cut it into pieces, by the forward algorithm; a
text's is the product over its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.common import bounded_batches
from scrubline.llm.words import WordRows, Words, gathered

# Runs of letters: whole ones are scored, while those that teach are cut at 24 letters.
WORDS, TAUGHT = Words(None), Words(24)
# Longer runs are scored one by one.
LONGEST_TOGETHER = 24
FLOOR = 1e-6
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


@lru_cache(maxsize=1)
def pieces(vocabulary: str) -> dict[str, int]:
    """Numbers (from 1) of the vocabulary's pieces of letters, in lower case."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    found = (model.id_to_piece(i).lstrip("▁").lower() for i in range(model.get_piece_size()))
    return {p: i for i, p in enumerate(sorted({p for p in found if p.isalpha()}), 1)}


@lru_cache(maxsize=1)
def longest_piece(vocabulary: str) -> int:
    return max(map(len, pieces(vocabulary)), default=1)


@dataclass
class Model:
    vocabulary: str
    languages: list[str]
    # By piece and language; row 0 is a single letter outside the vocabulary.
    probability: np.ndarray


def _lattice(words: list[str], ids: dict[str, int], longest: int) -> np.ndarray:
    """Pieces by word, start and length; -1 where there is none. The words are equally long."""
    n = len(words[0])
    width = min(n, longest)
    flat = [
        ids.get(w[i : i + k], 0 if k == 1 else -1) if i + k <= n else -1
        for w in words
        for i in range(n)
        for k in range(1, width + 1)
    ]
    return np.array(flat, np.int32).reshape(len(words), n, width)


def _forward(lattice: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Probability of each prefix, by word, position and language; ``p`` ends with a row of zeros."""
    m, n, width = lattice.shape
    alpha = np.zeros((m, n + 1, p.shape[1]))
    alpha[:, 0] = 1
    for end in range(1, n + 1):
        for k in range(1, min(end, width) + 1):
            alpha[:, end] += alpha[:, end - k] * p[lattice[:, end - k, k - 1]]
    return alpha


def _long_score(word: str, ids: dict[str, int], p: np.ndarray, longest: int) -> np.ndarray:
    """Log probability of a run of any length, by language: the forward values of its last letters go along."""
    last, total = np.ones((1, p.shape[1])), np.zeros(p.shape[1])
    for end in range(1, len(word) + 1):
        found = [ids.get(word[end - k : end], 0 if k == 1 else -1) for k in range(min(end, longest), 0, -1)]
        new = (last[-len(found) :] * p[found]).sum(0)
        last = np.vstack([last[-longest:], new])
        if end % 16 == 0:
            # Kept near 1, so that nothing becomes 0.
            scale = last.max(0)
            total += np.log(scale)
            last = last / scale
    return total + np.log(last[-1])


def word_scores(words: list[str], model: Model) -> np.ndarray:
    """Log probability by word and language."""
    ids, longest = pieces(model.vocabulary), longest_piece(model.vocabulary)
    p = np.vstack([model.probability, np.zeros(len(model.languages))])
    out = np.empty((len(words), len(model.languages)), np.float32)
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        if n > LONGEST_TOGETHER:
            for i in at:
                out[i] = _long_score(words[i], ids, p, longest)
            continue
        for a in range(0, len(at), 20_000):
            part = at[a : a + 20_000]
            out[part] = np.log(_forward(_lattice([words[i] for i in part], ids, longest), p)[:, -1])
    return out


def fit(samples: dict[str, list[str]], vocabulary: str, rounds: int = 3) -> Model:
    """Piece probabilities by expectation maximisation over each language's texts."""
    ids, longest, languages = pieces(vocabulary), longest_piece(vocabulary), sorted(samples)
    columns = []
    for language in languages:
        counts = Counter(w for text in samples[language] for w in TAUGHT.of(text))
        p = np.full((len(ids) + 1, 1), 1 / (len(ids) + 1))
        by_length: dict[int, list[str]] = {}
        for w in counts:
            by_length.setdefault(len(w), []).append(w)
        lattices = [(np.array([counts[w] for w in ws]), _lattice(ws, ids, longest)) for ws in by_length.values()]
        for _ in range(rounds):
            q, expected = np.vstack([p, [[0]]]), np.zeros(len(ids) + 2)
            for weight, lattice in lattices:
                n = lattice.shape[1]
                alpha = _forward(lattice, q)[:, :, 0]
                beta = np.zeros_like(alpha)
                beta[:, n] = 1
                for start in range(n - 1, -1, -1):
                    for k in range(1, min(n - start, lattice.shape[2]) + 1):
                        beta[:, start] += beta[:, start + k] * q[lattice[:, start, k - 1], 0]
                for start in range(n):
                    for k in range(1, min(n - start, lattice.shape[2]) + 1):
                        piece = lattice[:, start, k - 1]
                        share = alpha[:, start] * q[piece, 0] * beta[:, start + k] / alpha[:, n]
                        piece = np.where(piece < 0, len(ids) + 1, piece)
                        expected += np.bincount(piece, share * weight, len(ids) + 2)
            p = expected[:-1, None]
            p = np.maximum(p / max(p.sum(), 1e-300), FLOOR)
            p /= p.sum()
        columns.append(p[:, 0])
    return Model(vocabulary, languages, np.array(columns).T if columns else np.zeros((len(ids) + 1, 0)))


def fold_of(id_col: str, folds: int) -> Column:
    """Remainder of the CRC of the id as text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def training_sample(
    docs: DataFrame, per_language: int, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> dict[str, list[str]]:
    """Texts of ``per_language`` documents per language, chosen by hash, outside fold 1 of 3."""
    named = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold_of(id_col, 3) != 1))
    order = Window.partitionBy(lang_col).orderBy(F.xxhash64(id_col), id_col)
    ranked = named.select(id_col, lang_col).withColumn("__rank", F.row_number().over(order))
    ids = [r[0] for r in ranked.filter(F.col("__rank") <= per_language).select(id_col).collect()]
    samples: dict[str, list[str]] = {}
    for row in named.filter(F.col(id_col).isin(ids)).select(lang_col, text_col).orderBy(id_col, text_col).collect():
        samples.setdefault(row[0], []).append(row[1])
    return samples


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Predicted language of every whole text: doc_id, held_out, lang_pred, score.

    ``score`` is the language's share of the probability under equal priors. Texts
    without a letter, nulls too, are ``und`` with score 0, and so is every text if
    the model knows no language. Rows with equal ids are each judged.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        table = WordRows(lambda words: word_scores(words, m), limit=400_000)
        for batch, lots in gathered(WORDS, batches, 2, 200_000):
            total = np.zeros((batch.num_rows, len(m.languages)))
            n_words = np.zeros(batch.num_rows, np.int64)
            for rows, words in lots:
                n_words += np.bincount(rows[:, 0], rows[:, 1], batch.num_rows).astype(np.int64)
                full = rows[rows[:, 1] > 0]
                if m.languages and len(full):
                    at = table.lookup(words)
                    scores = table.rows[at]
                    starts = np.concatenate([[0], np.cumsum(full[:-1, 1])])
                    np.add.at(total, full[:, 0], np.add.reduceat(scores, starts, axis=0, dtype=np.float64))
            known = (n_words > 0) & bool(m.languages)
            pred, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            if m.languages:
                best = total.argmax(1)
                share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                pred = [m.languages[b] if k else "und" for b, k in zip(best, known)]
                score = np.where(known, share, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    held_out = (fold_of(id_col, 3) == 1).alias("held_out")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out, F.col(text_col).alias("text")).mapInArrow(
        run, SCHEMA
    )
