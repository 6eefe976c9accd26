"""Quality trees: statistics against plain code, splits and walks against brute force, held-out labels."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from scrubline.llm import quality, queries


def plain_statistics(text):
    """The statistics of a text of ASCII letters and signs, one by one."""
    words = re.findall(r"[^ \t\n\v\f\r]+", text)
    n, w = len(text), len(words)
    kinds = Counter(
        "blank" if c in " \t\n\v\f\r" else "upper" if c.isupper() else "lower" if c.islower() else "digit" if c.isdigit()
        else "mark" if c in ".,;:!?'\"()-" else "symbol" for c in text
    )
    sizes, bytes_, low = [len(x) for x in words], Counter(text), [x.lower() for x in words]
    mean = sum(sizes) / max(w, 1)
    lines = text.split("\n")
    sentences = sum(text.count(c) for c in ".!?") + 1
    symbols = [v for c, v in bytes_.items() if not c.isalnum() and c not in " \t\n\v\f\r.,;:!?'\"()-"]

    def share(x, of):
        return x / max(of, 1)

    return [
        math.log1p(n), math.log1p(w), mean, math.sqrt(max(share(sum(s * s for s in sizes), w) - mean**2, 0)),
        *(share(kinds[k], n) for k in ("blank", "upper", "digit", "mark", "symbol")), 0.0, share(text.count("\n"), n),
        w / len(lines), share(sum(x[-1] in "#|%&*$" for x in words), w), share(sum(x[0].isupper() for x in words), w),
        share(sum(not any(c.isalpha() for c in x) for x in words), w), share(sum(s <= 2 for s in sizes), w),
        share(sum(s > 15 for s in sizes), w), share(sum(c in "aeiouAEIOU" for c in text), kinds["upper"] + kinds["lower"]),
        w / sentences, share(sum(a == b for a, b in zip(low, low[1:])), w), share(len(set(low)), w),
        share(max(Counter(low).values(), default=0), w), share(len(set(zip(low, low[1:]))), w - 1), len(set(lines)) / len(lines),
        -sum(v / n * math.log(v / n) for v in bytes_.values()) if n else 0.0, share(max(symbols, default=0), n),
        share(max(bytes_.values(), default=0), n),
    ]


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(8)
    signs = list("aeibcDE  \n\t.,!#|%7") + [" word", " Word ", "\n"]
    made = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 300, 60)]
    return made + ["", "a", " ", "Same line\n" * 50, "x" * 3000 + " " + "long text, again. " * 5000]


@pytest.mark.parametrize("segment", [1 << 20, 40])
def test_statistics(texts, segment, monkeypatch):
    monkeypatch.setattr(quality, "SEGMENT_BYTES", segment)
    if segment < 100:  # words longer than two segments are cut
        texts = [t for t in texts if max(map(len, t.split()), default=0) <= segment]
    found = quality.statistics([t.encode() for t in texts])
    expected = np.array([plain_statistics(t) for t in texts])
    names = np.array(quality.STATISTICS)
    if segment < 100:
        # A pair of words across a cut is not seen.
        kept = ~np.isin(names, ["repeated_next", "distinct_pairs"])
        found, expected, names = found[:, kept], expected[:, kept], names[kept]
    wrong = np.abs(found - expected).max(0) > 1e-9
    assert not wrong.any(), names[wrong]


def test_first_split_is_the_best_of_all():
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 20, (300, 4)).astype(float), (rng.random(300) < 0.4).astype(float)
    y[x[:, 2] > 13] = 1
    one = quality.fit(x, y, trees=1, depth=1, least=1)
    slope, bend = y.mean() - y, np.full(300, y.mean() * (1 - y.mean()))
    # The fitted base is of counts with half a row added.
    p = 1 / (1 + np.exp(-one.base))
    slope, bend = p - y, np.full(300, p * (1 - p))

    def gain(f, cut):
        left = x[:, f] <= cut
        return sum(slope[m].sum() ** 2 / (bend[m].sum() + 1) for m in (left, ~left))

    best = max((gain(f, c), f, c) for f in range(4) for c in range(19))
    assert (one.feature[0, 0], one.threshold[0, 0]) == best[1:]
    left = x[:, best[1]] <= best[2]
    assert np.allclose(one.value[0], [-0.15 * slope[m].sum() / (bend[m].sum() + 1) for m in (left, ~left)])


def test_scores_equal_a_walk_by_nodes():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality.fit(x, y, trees=40, depth=3)

    def walk(t, row):
        i = 0
        while i < trees.feature.shape[1]:
            i = 2 * i + 1 + int(row[trees.feature[t, i]] > trees.threshold[t, i])
        return trees.value[t, i - trees.feature.shape[1]]

    slow = [1 / (1 + math.exp(-trees.base - sum(walk(t, row) for t in range(40)))) for row in x]
    assert np.allclose(slow, trees.scores(x))
    assert np.mean((trees.scores(x) >= 0.5) == y) > 0.97


def test_held_out_accuracy(spark, sf_dir):
    sf_dir = os.path.dirname(sf_dir) + "/sf0.1"
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").collect()}
    rows = queries.op12_quality(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    for label in (0, 1):
        assert np.mean([p == label for q, p in held if q == label]) > 0.97


def test_sample_is_bounded_and_keeps_to_its_fold(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('word ', CAST(id % 7 + 1 AS INT)) AS text", "1 AS label", "2 AS x")
    docs = docs.unionByName(docs.filter("doc_id = 2").withColumn("doc_id", docs.doc_id)).unionByName(docs.filter("doc_id < 50"))
    labels = spark.range(3000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality").unionByName(
        spark.createDataFrame([(None, 1), (5, None), (6, 7)], "doc_id long, quality int")
    )
    x, y = quality.training_sample(docs, labels, per_class=100)
    assert x.shape == (200, len(quality.STATISTICS)) and y.sum() == 100
    taught = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 3 != 1]
    x, y = quality.training_sample(docs, labels, per_class=10_000)
    assert len(x) == len(taught)


def test_odd_inputs(spark):
    schema = "doc_id long, text string, score string, held_out int"
    rows = [(1, None, "s", 1), (1, "", "s", 1), (None, "a b", None, None), (2, "long " * 600_000, "s", 1), (2, "퟿é", "s", 1)]
    x = np.array([quality.statistics([t])[0] for t in (b"Fine words here.", b"### $$$ %%%")] * 20)
    trees = quality.fit(x, np.array([1.0, 0.0] * 20))
    scored = quality.score(spark.createDataFrame(rows, schema), trees).collect()
    assert len(scored) == 5 and all(0 <= r.score <= 1 for r in scored)
    assert scored[0].score == scored[1].score
    empty = spark.createDataFrame([], schema)
    assert quality.score(empty, trees).count() == 0
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    x, y = quality.training_sample(empty, no_labels)
    assert quality.fit(x, y).scores(np.zeros((1, x.shape[1]))).tolist() == [0.5]
    assert (quality.fit(np.zeros((9, 3)), np.ones(9)).scores(np.zeros((2, 3))) > 0.9).all()
