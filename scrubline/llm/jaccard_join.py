"""Join of texts by the Jaccard similarity of their word n-grams.

Texts with equal sets of n-grams form one class. Classes that share a band of MinHash
values become candidates; a pair's values are compared step by step, and it is dropped
when the probability that it reaches the threshold, given the matches so far, falls
below a tolerance (Bayesian pruning). What is left is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.blocks import deal_blocks, groups, pairs, smallest_linked
from scrubline.llm.common import bounded_batches, written
from scrubline.llm.components import components
from scrubline.llm.hashing import mixed, piece_hashes, prefix_hashes

WORDS, BAND_ROWS, BANDS, STEP = 5, 4, 24, 16
VALUES = BAND_ROWS * BANDS
TOLERANCE = 1e-6
BLOCK = 1024
# Letters and digits of ASCII and every byte of a longer character.
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Per text the sorted hashes of its different word n-grams.

    Words are runs of letters and digits in lower case. A text of fewer words has one
    n-gram of all of them, one without a word has none.
    """
    encoded = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([*encoded, b""]) or b" ", np.uint8)
    inside = np.concatenate([[False], _WORD_BYTE[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    words = mixed(piece_hashes(prefix_hashes(data), start, end))
    # Where each text's words begin among all words.
    begin = np.searchsorted(start, np.cumsum([0] + [len(e) + 1 for e in encoded]))
    grams = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        grams = mixed(grams ^ words[k : k + len(grams)], k)
    out = []
    for a, b in zip(begin[:-1], begin[1:]):
        if b - a >= WORDS:
            out.append(np.unique(grams[a : b - WORDS + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for k in range(a, b):
                whole = mixed(np.array([whole ^ words[k]]), WORDS)[0]
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    x = mixed(np.arange(2 * VALUES, dtype=np.uint64), 99)
    return (x[:VALUES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (x[VALUES:] >> np.uint64(32)).astype(np.uint32)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values by set; the sets are not empty."""
    a, b = _coefficients()
    out = np.empty((len(sets), VALUES), np.uint32)
    for first in range(0, len(sets), 512):
        part = sets[first : first + 512]
        flat = (np.concatenate(part) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0] + [len(s) for s in part[:-1]])
        buffer = np.empty(len(flat), np.uint32)
        for k in range(VALUES):
            np.multiply(flat, a[k], out=buffer)
            buffer += b[k]
            out[first : first + len(part), k] = np.minimum.reduceat(buffer, starts)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key by set and band."""
    rows = values.reshape(len(values), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2])
    for k in range(BAND_ROWS):
        key = mixed(key ^ rows[:, :, k], k)
    return key.view(np.int64)


def least_matches(threshold: float, tolerance: float = TOLERANCE) -> list[int]:
    """After each step, the matches from which on a pair stays a candidate.

    With m of n values equal and an even prior, the similarity is below t with the
    probability that more than m of n + 1 trials with chance t succeed.
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def prune(values: np.ndarray, i: np.ndarray, j: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that are left after comparing their MinHash values step by step."""
    matches = np.zeros(len(i), np.int32)
    for k, m in enumerate(least):
        part = slice(k * STEP, (k + 1) * STEP)
        matches += (values[i, part] == values[j, part]).sum(1, dtype=np.int32)
        keep = matches >= m
        i, j, matches = i[keep], j[keep], matches[keep]
    return i, j


def intersections(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of many pairs of sorted sets."""
    out = np.zeros(len(i), np.int64)
    if not len(i):
        return out
    used = np.unique(np.concatenate([i, j]))
    if len(i) <= 4 * len(used):
        for k, (a, b) in enumerate(zip(i, j)):
            x, y = (sets[a], sets[b]) if len(sets[a]) < len(sets[b]) else (sets[b], sets[a])
            at = np.searchsorted(y, x)
            out[k] = (y[np.minimum(at, len(y) - 1)] == x).sum()
        return out
    # Many pairs of few sets: products of incidence matrices over what several sets hold.
    flat = np.concatenate([sets[u] for u in used])
    owner = np.repeat(np.arange(len(used)), [len(sets[u]) for u in used])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    several = count > 1
    number = np.cumsum(several) - 1
    kept = several[column]
    owner, column = owner[kept], number[column[kept]]
    common = np.zeros((len(used), len(used)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 2048
    for a in range(0, int(several.sum()), width):
        lo, hi = np.searchsorted(column, [a, a + width])
        m = np.zeros((len(used), width), np.float32)
        m[owner[lo:hi], column[lo:hi] - a] = 1
        common += m @ m.T
    return common[np.searchsorted(used, i), np.searchsorted(used, j)].astype(np.int64)


def link_texts(
    docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Links by Jaccard similarity of at least ``threshold``: doc_id, class_id, n_links, kept; a row per document.

    ``n_links`` counts the documents linked directly, ``class_id`` is the smallest id
    that links lead to. Texts without a word, nulls too, and rows without an id link with
    nothing. Rows with equal ids are one document; it links with what any of their texts
    links with.

    A linked pair is missed only if no band of values is equal (at 0.8: 3 in a million) or
    by the pruning's tolerance. Pairs never leave a task: candidates are joined to
    groups, each group's sets are sent once and compared in blocks, which give sums of
    links and stars of what is linked. Copies count by their number and are not compared.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    least = least_matches(threshold)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist())
            full = [k for k, s in enumerate(sets) if len(s)]
            values = minhashes([sets[k] for k in full])
            # The sets' hashes: two sums that do not depend on order.
            h = [np.array([mixed(sets[k], salt).sum() for k in full], np.uint64).view(np.int64) for salt in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(full, pa.int64())), pa.array(h[0]), pa.array(h[1]),
                 pa.array([v.tobytes() for v in values], pa.binary())],
                ["id", "h1", "h2", "signature"],
            )

    signed = source.filter("id IS NOT NULL").mapInArrow(sign, "id long, h1 long, h2 long, signature binary")
    signed = written(signed, "signatures")
    classes = signed.select("id", "h1", "h2").distinct().groupBy("h1", "h2")
    classes = classes.agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    one = signed.groupBy("h1", "h2").agg(F.first("signature").alias("signature"))
    classes = written(classes.join(one, ["h1", "h2"]), "classes")

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint32).reshape(-1, VALUES)
            rows = pa.array(np.repeat(np.arange(len(values)), BANDS))
            rest = [batch.column(c).take(rows) for c in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(band_keys(values).ravel()), *rest], ["key", "h1", "h2"])

    # Only keys that several classes have go on, with the classes' values.
    keys = classes.select("signature", "h1", "h2").mapInArrow(banded, "key long, h1 long, h2 long").repartition("key")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    met = written(keys.join(shared, "key"), "bands").join(classes.select("h1", "h2", "signature"), ["h1", "h2"])
    met = met.withColumn("id", F.xxhash64("h1", "h2"))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = ["key", "lo", "hi"]
        for lots in groups(batches, by, at_least=4096):
            values = np.frombuffer(b"".join(lots.column("signature").to_pylist()), np.uint32).reshape(-1, VALUES)
            ids = lots.column("id").to_numpy()
            kept = [prune(values, i, j, least) for i, j in pairs(lots, by)]
            i, j = (np.concatenate(x) for x in zip(*kept)) if kept else (np.empty(0, int),) * 2
            root = smallest_linked(len(ids), i, j)
            hit = np.flatnonzero(ids[root] != ids)
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(ids[root[hit]])], ["a", "b"])

    edges = written(deal_blocks(met, BLOCK).mapInArrow(candidates, "a long, b long"), "candidates")
    parts = components(edges)
    parts = parts.unionByName(parts.select(F.col("component").alias("id"), "component").distinct())
    reps = classes.withColumn("id", F.xxhash64("h1", "h2")).join(parts, "id")
    reps = written(reps.select("rep", "weight", "signature", "component", "h1", "h2"), "candidate-classes")

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist())
            h = [np.array([mixed(s, salt).sum() if len(s) else 0 for s in sets], np.uint64).view(np.int64) for salt in (1, 2)]
            same = (h[0] == batch.column("h1").to_numpy()) & (h[1] == batch.column("h2").to_numpy())
            keep = pa.array(np.flatnonzero(same))
            held = pa.array([s.tobytes() for s in sets], pa.binary()).take(keep)
            rest = [batch.column(c).take(keep) for c in ("component", "rep", "weight", "signature", "h1", "h2")]
            yield pa.RecordBatch.from_arrays([*rest, held], ["key", "rep", "weight", "signature", "h1", "h2", "grams"])

    kind = "key long, rep long, weight long, signature binary, h1 long, h2 long, grams binary"
    sets = source.join(reps, F.col("id") == F.col("rep")).drop("id").mapInArrow(with_sets, kind)
    sets = sets.withColumn("id", F.xxhash64("h1", "h2"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = ["key", "lo", "hi"]
        for lots in groups(batches, by, at_least=512):
            values = np.frombuffer(b"".join(lots.column("signature").to_pylist()), np.uint32).reshape(-1, VALUES)
            grams = [np.frombuffer(g, np.uint64) for g in lots.column("grams").to_pylist()]
            size, weight = np.array([len(g) for g in grams]), lots.column("weight").to_numpy()
            ids = lots.column("id").to_numpy()
            # A class whose document has several equal rows is compared once.
            links, ends = np.zeros(len(ids), np.int64), []
            for i, j in pairs(lots, by):
                differ = ids[i] != ids[j]
                i, j = prune(values, i[differ], j[differ], least)
                common = intersections(grams, i, j)
                # In whole numbers: the threshold itself is a link.
                close = common >= np.ceil(threshold * (size[i] + size[j] - common) - 1e-9)
                i, j = i[close], j[close]
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                ends.append((i, j))
            i, j = (np.concatenate(x) for x in zip(*ends)) if ends else (np.empty(0, int),) * 2
            root = smallest_linked(len(ids), i, j)
            hit = np.unique(np.concatenate([i, j]))
            yield pa.RecordBatch.from_arrays(
                [lots.column("h1").combine_chunks().take(pa.array(hit)), lots.column("h2").combine_chunks().take(pa.array(hit)),
                 lots.column("rep").combine_chunks().take(pa.array(hit)), lots.column("rep").combine_chunks().take(pa.array(root[hit])),
                 pa.array(links[hit])],
                ["h1", "h2", "rep", "root", "links"],
            )

    sets = sets.dropDuplicates(["h1", "h2"])
    found = deal_blocks(sets, BLOCK).mapInArrow(verify, "h1 long, h2 long, rep long, root long, links long")
    found = written(found, "links")
    per_class = found.groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    # A document with several texts ties their classes together.
    inside = signed.join(classes.select("h1", "h2", "rep"), ["h1", "h2"]).filter("id != rep")
    several = signed.select("id", "h1", "h2").distinct().groupBy("id").count().filter("count > 1").select("id")
    ties = inside.join(several, "id").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    merged = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(ties))
    told = classes.join(per_class, ["h1", "h2"], "left").join(merged, F.col("rep") == F.col("id"), "left")
    told = told.select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("class_id")
    )
    by_doc = signed.select("id", "h1", "h2").distinct().join(told, ["h1", "h2"])
    by_doc = by_doc.groupBy("id").agg(F.min("class_id").alias("class_id"), F.sum("n_links").alias("n_links"))
    everyone = source.select("id").distinct().join(by_doc, "id", "left")
    class_id = F.coalesce("class_id", "id")
    return everyone.select(
        F.col("id").alias("doc_id"),
        class_id.alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        class_id.eqNullSafe(F.col("id")).alias("kept"),
    )


def keep_one(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, one row of each group: that of the smallest id, and of its rows the least text.

    Rows of equal ids are one document. Rows without an id come last and are told apart by
    a hash of their text, as if their ids were above 2^62.
    """
    unnamed = F.lit(1 << 62) + F.xxhash64(text_col).bitwiseAND((1 << 62) - 1)
    keyed = docs.withColumn("__key", F.coalesce(F.col(id_col).cast("long"), unnamed))
    linked = link_texts(keyed.select(F.col("__key").alias("id"), F.col(text_col).alias("text")), threshold, "id", "text")
    gone = linked.filter("NOT kept").select(F.col("doc_id").alias("__key"))
    # One row of a key goes on from each task, so that copies do not meet in one.
    order = Window.partitionBy("__key").orderBy(F.col(text_col).asc_nulls_last())
    left = keyed.join(gone, "__key", "left_anti").withColumn("__rank", F.row_number().over(order))
    return left.filter(F.col("__rank") == 1).select(*docs.columns)
