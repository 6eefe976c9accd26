"""Toxicity scores by a bidirectional gated recurrent network, trained in numpy.

A text is a row of words. Each word enters by a vector of its own (if it is in the
training vocabulary) and by one made from its characters (embeddings, a convolution and
a maximum). All overlapping windows of words run through gated recurrent units in both
directions; attention pools the states, and the text's score is that of its worst window.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import bounded_batches
from scrubline.llm.language_id import fold_of
from scrubline.llm.words import WordRows, Words, gathered

LETTERS, WINDOW, STEP = 16, 32, 16
WORDS = Words(LETTERS)
HIDDEN, WORD_DIM, CHAR_DIM, CHAR_OUT, CHARS = 8, 8, 6, 8, 320
PAD, UNKNOWN = 0, 1
# Words taken in at once; a long text's slices of so many start where windows do.
LOT = 32_000
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


@dataclass
class Network:
    vocabulary: dict[str, int]
    weights: dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def char_codes(words: list[str]) -> np.ndarray:
    """Character numbers of words, 0 for none, with an empty place at either end."""
    codes = np.zeros((len(words), LETTERS + 2), np.int64)
    if words:
        points = np.array(words, f"<U{LETTERS}").view(np.uint32).reshape(len(words), LETTERS)
        codes[:, 1:-1] = np.where(points < 256, points, 256 + points % 64)
    return codes


def word_inputs(net: Network, ids: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, tuple]:
    """What words bring into the gates of both directions, and what the gradient needs."""
    w = net.weights
    e = w["char"][codes]
    triples = np.concatenate([e[:, :-2], e[:, 1:-1], e[:, 2:]], axis=2)
    conv = triples @ w["conv"] + w["conv_bias"]
    best = conv.argmax(1)
    pooled = np.maximum(np.take_along_axis(conv, best[:, None], 1)[:, 0], 0)
    x = np.concatenate([w["word"][ids], pooled], axis=1)
    return x @ w["in"] + w["in_bias"], (triples, best, pooled, x)


def states(net: Network, gates: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """States by direction, window, place and unit, from gate inputs by window and place."""
    u, m, n = net.weights["rec"], gates.shape[0], gates.shape[1]
    h, k = np.zeros((2, m, HIDDEN), np.float32), 3 * HIDDEN
    out, tape = np.empty((2, m, n, HIDDEN), np.float32), []
    for t in range(n):
        x = np.stack([gates[:, t, :k], gates[:, n - 1 - t, k:]])
        g = h @ u
        zr = _sigmoid(x[:, :, : 2 * HIDDEN] + g[:, :, : 2 * HIDDEN])
        z, r, cand = zr[:, :, :HIDDEN], zr[:, :, HIDDEN:], g[:, :, 2 * HIDDEN :]
        new = np.tanh(x[:, :, 2 * HIDDEN :] + r * cand)
        if keep:
            tape.append((h, z, r, cand, new))
        h = h + z * (new - h)
        out[0, :, t], out[1, :, n - 1 - t] = h[0], h[1]
    return out, tape


def attend(net: Network, hidden: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Logit of each window; places that are not ``real`` get no attention."""
    w = net.weights
    both = np.concatenate([hidden[0], hidden[1]], axis=2)
    e = np.where(real, both @ w["attention"], -1e9)
    a = np.exp(e - e.max(1, keepdims=True))
    a /= a.sum(1, keepdims=True)
    pooled = (a[:, None, :] @ both)[:, 0]
    return pooled @ w["out"] + w["out_bias"][0], (both, a, pooled)


def window_starts(n: int) -> np.ndarray:
    """Starts of the windows that cover ``n`` words, each half over the next."""
    return np.arange(0, max(1, n - STEP), STEP)


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts that stand one after another: word numbers by window (-1: none), and each window's text."""
    starts = [window_starts(n) for n in lengths]
    counts = np.array([len(s) for s in starts])
    owner = np.repeat(np.arange(len(lengths)), counts)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    at = np.concatenate(starts)[:, None] + np.arange(WINDOW)
    return np.where(at < lengths[owner, None], at + first[owner, None], -1), owner


def _add_rows(to: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    for column in range(to.shape[1]):
        to[:, column] += np.bincount(rows, values[:, column], len(to)).astype(to.dtype)


def _gradients(net: Network, ids: np.ndarray, codes: np.ndarray, at: np.ndarray, target: np.ndarray) -> dict:
    """Gradient of the mean logistic loss over windows ``at`` of distinct words."""
    w, k, m = net.weights, 3 * HIDDEN, len(at)
    gate_rows, (triples, best, pooled_chars, x) = word_inputs(net, ids, codes)
    gates, real = gate_rows[at], ids[at] != PAD
    hidden, tape = states(net, gates, keep=True)
    logit, (both, a, pooled) = attend(net, hidden, real)
    g = {name: np.zeros_like(v) for name, v in w.items()}
    d_logit = ((_sigmoid(logit) - target) / m).astype(np.float32)
    g["out"], g["out_bias"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
    d_pooled = d_logit[:, None] * w["out"]
    d_a = (both @ d_pooled[:, :, None])[:, :, 0]
    d_e = a * (d_a - (a * d_a).sum(1, keepdims=True))
    g["attention"] = d_e.ravel() @ both.reshape(-1, 2 * HIDDEN)
    d_both = a[:, :, None] * d_pooled[:, None] + d_e[:, :, None] * w["attention"]
    d_out = np.stack([d_both[:, :, :HIDDEN], d_both[:, :, HIDDEN:]])
    d_gates, d_h = np.zeros_like(gates), np.zeros_like(tape[0][0])
    for t in range(WINDOW - 1, -1, -1):
        h, z, r, cand, new = tape[t]
        back = WINDOW - 1 - t
        d_h = d_h + np.stack([d_out[0, :, t], d_out[1, :, back]])
        d_new = d_h * z * (1 - new * new)
        d_z = d_h * (new - h) * z * (1 - z)
        d_r = d_new * cand * r * (1 - r)
        d_rec = np.concatenate([d_z, d_r, d_new * r], axis=2)
        g["rec"] += h.transpose(0, 2, 1) @ d_rec
        d_h = d_h * (1 - z) + d_rec @ w["rec"].transpose(0, 2, 1)
        d_in = np.concatenate([d_z, d_r, d_new], axis=2)
        d_gates[:, t, :k], d_gates[:, back, k:] = d_in[0], d_in[1]
    # Every distinct word is in some window: sums over runs of equal words.
    order = np.argsort(at.ravel(), kind="stable")
    runs = np.searchsorted(at.ravel()[order], np.arange(len(ids)))
    d_rows = np.add.reduceat(d_gates.reshape(-1, 2 * k)[order], runs, axis=0)
    g["in"], g["in_bias"] = x.T @ d_rows, d_rows.sum(0)
    d_x = d_rows @ w["in"].T
    _add_rows(g["word"], ids, d_x[:, :WORD_DIM])
    d_conv = d_x[:, WORD_DIM:] * (pooled_chars > 0)
    chosen = np.take_along_axis(triples[:, :, None, :], best[:, None, :, None], 1)[:, 0]
    g["conv"], g["conv_bias"] = (chosen * d_conv[:, :, None]).sum(0).T, d_conv.sum(0)
    d_chosen = d_conv[:, :, None] * w["conv"].T
    for place in range(3):
        code = np.take_along_axis(codes, best + place, 1)
        _add_rows(g["char"], code.ravel(), d_chosen[:, :, place * CHAR_DIM : (place + 1) * CHAR_DIM].reshape(-1, CHAR_DIM))
    return g


def fit(texts: list[str], toxic: list[int], epochs: int = 8, seed: int = 7, top_words: int = 20_000) -> Network:
    """Train on labelled texts: on all windows at first, then on each toxic text's worst window.

    Clean texts teach by their worst window and a random one.
    """
    rng = np.random.default_rng(seed)
    tokens = [WORDS.of(t) for t in texts]
    keep = [i for i, t in enumerate(tokens) if t]
    tokens, label = [tokens[i] for i in keep], np.array([toxic[i] for i in keep], np.float32)
    seen = Counter(w for t in tokens for w in set(t))
    known = sorted((w for w, n in seen.items() if n >= 3), key=lambda w: (-seen[w], w))[:top_words]
    vocabulary = {w: i for i, w in enumerate(known, 2)}

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    weights = {
        "word": normal(len(vocabulary) + 2, WORD_DIM, scale=0.1),
        "char": normal(CHARS, CHAR_DIM, scale=0.3),
        "conv": normal(3 * CHAR_DIM, CHAR_OUT, scale=0.25),
        "conv_bias": np.zeros(CHAR_OUT, np.float32),
        "in": normal(WORD_DIM + CHAR_OUT, 6 * HIDDEN, scale=0.3),
        "in_bias": np.zeros(6 * HIDDEN, np.float32),
        "rec": normal(2, HIDDEN, 3 * HIDDEN, scale=0.3),
        "attention": normal(2 * HIDDEN, scale=0.3),
        "out": normal(2 * HIDDEN, scale=0.3),
        "out_bias": np.zeros(1, np.float32),
    }
    net = Network(vocabulary, weights)
    if not len(label) or label.min() == label.max():
        net.weights["out"][:] = 0
        net.weights["out_bias"][:] = 4.0 if len(label) and label[0] else -4.0
        return net

    # Distinct words, the first of which fills empty places.
    distinct = ["", *sorted(set().union(*tokens))]
    number = {w: i for i, w in enumerate(distinct)}
    ids = np.array([PAD] + [vocabulary.get(w, UNKNOWN) for w in distinct[1:]])
    codes = char_codes(distinct)
    flat = np.array([number[w] for t in tokens for w in t])
    at, owner = windows(np.array([len(t) for t in tokens]))
    at = np.where(at < 0, 0, flat[at])
    first, second = ({n: np.zeros_like(v) for n, v in weights.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        if epoch < 2:
            chosen = rng.permutation(len(at))[: 8 * len(label)]
        else:
            parts = [word_inputs(net, ids[a : a + 8192], codes[a : a + 8192])[0] for a in range(0, len(ids), 8192)]
            logit = _logits(net, np.concatenate(parts), at)
            order = np.lexsort((-logit, owner))
            worst = order[np.unique(owner[order], return_index=True)[1]]
            drawn = rng.permutation(len(at))
            drawn = drawn[label[owner[drawn]] == 0][: len(label)]
            chosen = rng.permutation(np.concatenate([worst, worst, drawn]))
        for a in range(0, len(chosen), 64):
            part = chosen[a : a + 64]
            used, inverse = np.unique(at[part], return_inverse=True)
            g = _gradients(net, ids[used], codes[used], inverse.reshape(len(part), WINDOW), label[owner[part]])
            step += 1
            rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * (0.4 if epoch >= epochs - 2 else 1)
            for n, v in g.items():
                first[n] = 0.9 * first[n] + 0.1 * v
                second[n] = 0.999 * second[n] + 0.001 * v * v
                weights[n] -= (rate * first[n] / (np.sqrt(second[n]) + 1e-8)).astype(np.float32)
    return net


def _logits(net: Network, gate_rows: np.ndarray, at: np.ndarray, real: np.ndarray | None = None) -> np.ndarray:
    """Logits of windows of row numbers, a bounded lot at a time."""
    out = np.empty(len(at), np.float32)
    for a in range(0, len(at), 2048):
        part = at[a : a + 2048]
        mask = part != 0 if real is None else real[a : a + 2048]
        out[a : a + 2048] = attend(net, states(net, gate_rows[part])[0], mask)[0]
    return out


def training_sample(
    docs: DataFrame, labels: DataFrame, per_class: int = 600, longest: int = 20_000, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[list[str], list[int]]:
    """Texts and labels of up to ``per_class`` toxic and twice as many clean documents, by hash, outside fold 0 of 5.

    Only documents of up to ``longest`` characters teach; all are scored. An id with several
    labels counts by the highest, one with several texts by the least.
    """
    short = docs.filter(F.length(text_col) <= longest).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & (fold_of(id_col, 5) != 0))
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.max("toxic").alias("__toxic"))
    known = known.join(short.select("__id"), "__id", "left_semi")
    # The first ones by hash: every task sends no more than that many on.
    first = [
        known.filter(F.col("__toxic") == label).orderBy(F.xxhash64("__id"), "__id").limit(n)
        for label, n in ((0, 2 * per_class), (1, per_class))
    ]
    chosen = F.broadcast(first[0].unionByName(first[1]))
    texts = short.join(chosen, "__id").groupBy("__id", "__toxic").agg(F.min("__text").alias("__text"))
    rows = texts.orderBy("__id").collect()
    return [r["__text"] for r in rows], [r["__toxic"] for r in rows]


class _Scorer:
    """Scores texts in a task; keeps what each distinct word brings."""

    def __init__(self, net: Network):
        self.net = net
        self.empty = word_inputs(net, np.array([PAD]), char_codes([""]))[0]
        self.table = WordRows(self._compute, limit=150_000)

    def _compute(self, words: list[str]) -> np.ndarray:
        parts = []
        for a in range(0, len(words), 4096):
            some = words[a : a + 4096]
            ids = np.array([self.net.vocabulary.get(w, UNKNOWN) for w in some], np.int64)
            parts.append(word_inputs(self.net, ids, char_codes(some))[0])
        return np.concatenate(parts)

    def scores(self, n_rows: int, lots: Iterable[tuple[np.ndarray, list[str]]]) -> np.ndarray:
        worst = np.full(n_rows, -np.inf)
        for rows, words in lots:
            full = rows[rows[:, 1] > 0]
            if not len(full):
                continue
            at, owner = windows(full[:, 1])
            number = self.table.lookup(words)
            real = at >= 0
            number = number[np.maximum(at, 0)]
            logits = np.empty(len(at), np.float32)
            for a in range(0, len(at), 1024):
                gates = self.table.rows[number[a : a + 1024]]
                gates[~real[a : a + 1024]] = self.empty
                logits[a : a + 1024] = attend(self.net, states(self.net, gates)[0], real[a : a + 1024])[0]
            np.maximum.at(worst, full[owner, 0], logits)
        return np.where(np.isneginf(worst), 0.0, _sigmoid(np.where(np.isneginf(worst), 0, worst)))


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score of every whole text: doc_id, held_out, score, predicted.

    The score is that of the worst of all overlapping windows. Texts without a word,
    nulls too, have score 0. Rows with equal ids are each scored.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch, lots in gathered(WORDS, batches, 2, LOT, STEP):
            value = scorer.scores(batch.num_rows, lots)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value), pa.array((value >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    held_out = (fold_of(id_col, 5) == 0).alias("held_out")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out, F.col(text_col).alias("text")).mapInArrow(
        run, SCHEMA
    )


def reject_toxic(docs: DataFrame, net: Network, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores under the threshold."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch, lots in gathered(WORDS, batches, text_at, LOT, STEP):
            yield batch.filter(pa.array(scorer.scores(batch.num_rows, lots) < threshold))

    return docs.mapInArrow(run, docs.schema)
