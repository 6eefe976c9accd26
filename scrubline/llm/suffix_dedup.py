"""Removal of passages that an earlier document holds too, by sorted suffixes.

A passage is a string of ``span`` bytes. Each has an anchor: the n-gram of smallest
hash in it, so equal passages have the same anchor at the same place. Anchors that
several documents hold are brought together with the bytes around them. There, suffixes
are merge-sorted, but for those whose hash no other has; two are compared by their common
extension, which prefix polynomial hashes and binary search find in logarithmic time.
Neighbours that share a passage are verified byte by byte, and every document but the
earliest loses it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.llm.blocks import groups
from scrubline.llm.common import bounded_batches
from scrubline.llm.hashing import mixed, piece_hashes, powers, prefix_hashes

REACH = 32
LOT = 1 << 17
HELD = 1 << 20
BUCKET_ROWS = 1_000_000
SAMPLE_DOCS = 20_000
CHUNK = 16_384
KEYS = 1 << 20
MASKS = "id long, identity long, first long, mask long"


def _lots(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``LOT`` bytes together."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= LOT:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _smallest(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of windows of REACH hashes with the same smallest, leftmost one: first window, place of the hash."""
    value, width = hashes, 1
    while width < REACH:
        value = np.minimum(value[:-width], value[width:])
        width *= 2
    # Another place: the smallest changes, or leaves the window.
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (hashes[: len(value) - 1] == value[:-1])
    first = np.flatnonzero(new)
    end = np.append(first[1:], len(value))
    least = value[first]
    place = end - 1
    left = np.append(hashes[end[:-1] - 1] == least[:-1], False)
    came = np.append(False, least[1:] < least[:-1])
    place[came] = first[came] + REACH - 1
    sought = np.flatnonzero(~left & ~came)
    place[sought] = first[sought] + (hashes[first[sought, None] + np.arange(REACH)] == least[sought, None]).argmax(1)
    return first, place


def anchors(texts: list[bytes], span: int) -> tuple[np.ndarray, ...]:
    """Of each text's passages the anchors: text, hash, place, first and last passage that it stands for, hash of these."""
    gram = span - REACH + 1
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data) - span + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 6
    prefix = prefix_hashes(data)
    hashes = mixed((prefix[gram:] - prefix[:-gram]) * powers(len(prefix))[1][: len(prefix) - gram])
    runs, places = _smallest(hashes)
    ends = np.cumsum(sizes)
    # Texts begin anew; passages over the end of a text are none.
    start = np.sort(np.concatenate([runs, (ends - sizes)[(ends - sizes < n) & (sizes >= span)]]), kind="stable")
    owner = np.searchsorted(ends, start, "right")
    last = np.minimum(np.append(start[1:], n) - 1, ends[owner] - span)
    held = last >= start
    start, last, owner = start[held], last[held], owner[held]
    place = places[np.searchsorted(runs, start, "right") - 1]
    begin = (ends - sizes)[owner]
    spans = mixed(piece_hashes(prefix, start, last + span), 3)
    return owner, hashes[place].view(np.int64), place - begin, start - begin, last - begin, spans


def common_extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Length of the common start of the suffixes at a and b, up to ``room``, by hashes and binary search."""
    high = room.astype(np.int64)
    # Most are alike all along.
    low = np.where(piece_hashes(prefix, a, a + high) == piece_hashes(prefix, b, b + high), high, 0)
    high = np.where(low < high, high - 1, high)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_] + 1) // 2
        x, y = a[open_], b[open_]
        same = piece_hashes(prefix, x, x + middle) == piece_hashes(prefix, y, y + middle)
        low[open_] = np.where(same, middle, low[open_])
        high[open_] = np.where(same, high[open_], middle - 1)
    return low


def sort_suffixes(data: np.ndarray, prefix: np.ndarray, start: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """Order of suffixes by their first ``depth`` bytes within each group, by merge sort.

    Groups stand together. All merges of a level are done at once: the place of an
    element is its number in its own run plus the number of elements before it in the
    run beside, which binary search finds.
    """
    n = len(start)
    order = np.arange(n)
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(first, n))
    width = 1
    while sizes.size and width < sizes.max():
        larger = sizes > width
        base = np.repeat(first[larger], sizes[larger])
        size = np.repeat(sizes[larger], sizes[larger])
        number = np.arange(len(base)) - np.repeat(np.cumsum(sizes[larger]) - sizes[larger], sizes[larger])
        run = number // width
        beside = run ^ 1
        left = run % 2 == 0
        low = np.minimum(beside * width, size)
        high = np.minimum(low + width, size)
        from_, element = low.copy(), order[base + number]
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            other = order[base[open_] + middle]
            x, y = start[element[open_]], start[other]
            common = common_extension(prefix, x, y, np.full(len(x), depth))
            full = common >= depth
            stop = np.minimum(common, depth - 1)
            less = ~full & (data[y + stop] < data[x + stop])
            # On equal suffixes those of the left run come first.
            goes = less | (full & ~left[open_])
            low[open_] = np.where(goes, middle + 1, low[open_])
            high[open_] = np.where(goes, high[open_], middle)
        place = base + np.minimum(run, beside) * width + number % width + (low - from_)
        order[place] = element
        width *= 2
    return order


def _matches(
    windows: np.ndarray, doc: np.ndarray, group: np.ndarray, before: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Which passages an earlier document holds, and which are the earliest of equal ones; by sorted suffixes."""
    span = windows.shape[1]
    data = windows.ravel()
    prefix = prefix_hashes(data)
    by = np.lexsort((doc, before, group))
    lot = np.cumsum(np.append(True, (group[by][1:] != group[by][:-1]) | (before[by][1:] != before[by][:-1])))
    order = sort_suffixes(data, prefix, by * span, lot, span)
    by, lot = by[order], lot[order]
    common = common_extension(prefix, by[1:] * span, by[:-1] * span, np.full(len(by) - 1, span))
    same = (common >= span) & (lot[1:] == lot[:-1])
    near = np.flatnonzero(same)
    # Hashes may collide: bytes decide.
    same[near] = (windows[by[near + 1]] == windows[by[near]]).all(1)
    run = np.cumsum(np.append(True, ~same)) - 1
    first = np.flatnonzero(np.append(True, ~same))
    least = np.minimum.reduceat(doc[by], first)
    later, earliest = np.empty(len(by), bool), np.zeros(len(by), bool)
    later[by] = doc[by] > least[run]
    # One of each run is enough for what comes later.
    start = np.flatnonzero(~later[by])
    earliest[by[start[np.unique(run[start], return_index=True)[1]]]] = True
    return later, earliest


def repeated(doc: np.ndarray, group: np.ndarray, lead: np.ndarray, pieces: pa.BinaryArray, span: int) -> np.ndarray:
    """Which passages of each row an earlier document holds: a bit per passage.

    Groups are whole. A row's bytes hold its passages, the first of which begins
    ``lead`` bytes before the anchor. Equal passages of a group have equal keys: those
    whose key no other document has need no sort. The others are sorted in lots of
    ``CHUNK`` by key, so the work grows with the passages, however large a group is.
    """
    n = len(doc)
    ends = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + n + 1].astype(np.int64)
    data = np.frombuffer(pieces.buffers()[2], np.uint8)
    at = ends[:-1]
    count = np.maximum(np.diff(ends) - span + 1, 0)
    mask = np.zeros(n, np.int64)
    begin = np.cumsum(count) - count
    rows = np.repeat(np.arange(n, dtype=np.int32), count)
    keys = np.empty(len(rows), np.uint64)
    salt = mixed(group.view(np.uint64), 1)
    for a in range(0, n, CHUNK):
        b = min(a + CHUNK, n)
        own = slice(begin[a], begin[b] if b < n else len(rows))
        row = rows[own]
        number = np.arange(own.start, own.stop) - begin[row]
        start = at[row] - at[a] + number
        whole = piece_hashes(prefix_hashes(data[at[a] : ends[b]]), start, start + span)
        keys[own] = mixed(whole + salt[row] + (lead[row] - number).astype(np.uint64), 2)
    n_parts = -(-len(keys) // KEYS)
    for part in range(n_parts):
        held = np.flatnonzero(((keys >> np.uint64(44)) * np.uint64(n_parts)) >> np.uint64(20) == part)
        held = held[np.argsort(keys[held], kind="stable")]
        if not len(held):
            continue
        key = keys[held]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        docs = doc[rows[held]]
        shared = np.minimum.reduceat(docs, first) < np.maximum.reduceat(docs, first)
        held = held[np.repeat(shared, np.diff(np.append(first, len(held))))]
        carried = held[:0]
        for a in range(0, len(held), CHUNK):
            lot = np.concatenate([carried, held[a : a + CHUNK]])
            row = rows[lot]
            number = lot - begin[row]
            windows = data[(at[row] + number)[:, None] + np.arange(span)]
            later, earliest = _matches(windows, doc[row], group[row], lead[row] - number)
            np.bitwise_or.at(mask, row[later], np.int64(1) << number[later])
            # Later passages of the last key may match these.
            carried = lot[earliest & (keys[lot] == keys[lot[-1]])]
    return mask


def judged(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Passages of pieces, sorted by hash, that an earlier document holds: a mask for each piece that has any."""
    for rows in groups(batches, ["hash"], CHUNK):
        rows = rows.combine_chunks()
        columns = (rows.column(c).to_numpy() for c in ("id", "hash", "lead"))
        mask = repeated(*columns, rows.column("bytes").chunk(0), span)
        hit = np.flatnonzero(mask)
        if len(hit):
            seen = rows.select(["id", "identity", "first"]).take(pa.array(hit)).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays([*seen.columns, pa.array(mask[hit])], ["id", "identity", "first", "mask"])


def _identity(text: bytes) -> int:
    """Tells texts of one id apart."""
    return zlib.crc32(text) & 0xFFFF


def _bytes(column: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers as differences, lowest bytes of all first: number of bytes, and these."""
    step = np.diff(values, prepend=0)
    step = ((step << 1) ^ (step >> 63)).view(np.uint64)
    width = (int(step.max()).bit_length() + 7) // 8
    return bytes([width]) + step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _whole(data: bytes, at: int, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    return out.view("<u8").ravel()


def _unplaned(data: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    """The numbers of ``_planes``, and where they end."""
    width = data[at]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 1).reshape(width, n).T
    step = out.view("<u8").ravel()
    step = (step >> np.uint64(1)).view(np.int64) ^ -(step & np.uint64(1)).view(np.int64)
    return np.cumsum(step), at + 1 + n * width


def _unpack_rows(blob: bytes) -> tuple[np.ndarray, ...]:
    """Anchor hash, passages' bytes' hash, id and place."""
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    rest = zlib.decompress(blob[4 + 11 * n :])
    ids, at = _unplaned(rest, 0, n)
    return _whole(blob, 4, n, 6), _whole(blob, 4 + 6 * n, n, 5), ids, _unplaned(rest, at, n)[0]


def _pack_buckets(parts: list[tuple[np.ndarray, ...]], n_buckets: int) -> pa.RecordBatch:
    """Anchors of each bucket, packed: 6 bytes of hash, 5 of the passages' bytes' hash, the rest as differences."""
    hashes, spans, ids, packed = (np.concatenate(x) for x in zip(*parts))
    bucket = (mixed(hashes.view(np.uint64), 7) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket.astype(np.uint16) if n_buckets <= 1 << 16 else bucket, kind="stable")
    bucket, ids, packed = bucket[order], ids[order], packed[order]
    hashes = np.ascontiguousarray(hashes[order].view(np.uint8).reshape(-1, 8)[:, :6])
    spans = np.ascontiguousarray(spans[order].view(np.uint8).reshape(-1, 8)[:, :5])
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.empty(0, np.int64)
    blobs = []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(bucket)]):
        rest = zlib.compress(_planes(ids[a:b]) + _planes(packed[a:b]), 1)
        blobs.append(b"".join([np.array([b - a], "<u4").tobytes(), hashes[a:b].tobytes(), spans[a:b].tobytes(), rest]))
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(blobs, pa.binary())], ["bucket", "rows"])


def bucketed(
    batches: Iterator[pa.RecordBatch], span: int, n_buckets: int, hot: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Anchors of texts in rows of a bucket each, of about ``HELD`` anchors together, so that rows are not many."""
    parts, held = [], 0
    for batch in batches:
        all_texts, all_ids = _bytes(batch.column(1)), batch.column(0).to_numpy()
        for a, b in _lots(all_texts):
            texts = all_texts[a:b]
            owner, hashes, place, first, last, spans = anchors(texts, span)
            if not len(owner):
                continue
            if len(hot):
                keep = ~np.isin(hashes, hot)
                owner, hashes, place, first, last, spans = (x[keep] for x in (owner, hashes, place, first, last, spans))
            identity = np.array([_identity(t) for t in texts], np.int64)[owner]
            packed = (place << 26) | (identity << 10) | ((place - first) << 5) | (place - last)
            parts.append((hashes, spans, all_ids[a:b][owner], packed))
            held += len(hashes)
            if held >= HELD:
                yield _pack_buckets(parts, n_buckets)
                parts, held = [], 0
    if held:
        yield _pack_buckets(parts, n_buckets)


def remove_repeats(
    docs: DataFrame, span: int = 50, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Documents without the bytes that a passage of an earlier document covers.

    All strings of ``span`` bytes that also start in a document with a smaller id count;
    they may overlap, and are judged on the input. Returns the input's columns with the
    text that is left (characters cut apart go), and ``n_bytes``, ``n_removed``,
    ``n_spans``, ``kept_sha256`` of the bytes left. A null or empty text has no bytes, a
    null text stays null. Rows without an id keep their text and take it from nobody;
    rows of equal ids are judged each, and take nothing from each other. Clashing input
    columns are replaced.

    Anchors travel in buckets of about ``bucket_rows``, packed. Where rows are alike in
    all bytes around an anchor (by two hashes of 88 bits together), all but the earliest
    document's are settled there; others send these bytes and are sorted. An anchor that
    would by a sample fill a bucket alone goes by its passages instead, which Spark
    counts with partial aggregation.
    """
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    docs = docs.drop(*added)
    spark = docs.sparkSession
    bounded_batches(spark)
    rest = [c for c in docs.columns if c != text_col]
    source = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.struct(F.lit(0).alias("_"), *rest).alias("rest")
    )
    named = source.filter("id IS NOT NULL").select("id", "text")
    n_docs, n_bytes = named.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(shuffle, round((n_bytes or 0) * 2 / (REACH + 1) / bucket_rows))
    hot = spark.sparkContext.broadcast(_hot_anchors(named, n_docs, span, bucket_rows))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return bucketed(batches, span, n_buckets, hot.value)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["bucket"]):
            parts = [_unpack_rows(blob) for blob in group.column("rows").to_pylist()]
            hashes, spans, ids, packed = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(hashes)
            h = hashes[order]
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            low, high = np.minimum.reduceat(ids[order], first), np.maximum.reduceat(ids[order], first)
            order = order[np.repeat(low < high, np.diff(np.append(first, len(h))))]
            order = order[np.lexsort((ids[order], spans[order], hashes[order]))]
            h, s, ids, packed = hashes[order], spans[order], ids[order], packed[order]
            new_h = np.append(True, h[1:] != h[:-1])[: len(h)]
            new = new_h | np.append(True, s[1:] != s[:-1])[: len(h)]
            least = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
            full = ids > least
            classes = np.bincount(np.cumsum(new_h) - 1, new) if len(h) else np.empty(0)
            tell = full | (classes[np.cumsum(new_h) - 1] > 1)
            h = np.where(full, 0, h.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids[tell]), pa.array(h[tell]), pa.array(packed[tell])], ["id", "hash", "packed"])

    found = named.mapInArrow(find, "bucket long, rows binary").repartition(n_buckets, "bucket")
    found = found.sortWithinPartitions("bucket").mapInArrow(match, "id long, hash long, packed long")
    # What is told of a document, once for the bytes around and once for the cut; hash 0: settled.
    per_doc = found.groupBy("id").agg(F.collect_list(F.struct("hash", "packed")).alias("found"))
    told = source.repartition("id").join(per_doc.hint("shuffle_hash"), "id", "left")

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc, text, found_ in zip(batch.column("id").to_pylist(), batch.column("text"), batch.column("found")):
                if not found_.is_valid:
                    continue
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                hashes, packed = (found_.values.field(k).to_numpy() for k in (0, 1))
                identity = _identity(data)
                mine = (hashes != 0) & ((packed >> 10) & 0xFFFF == identity)
                hashes, packed = hashes[mine], packed[mine]
                place = packed >> 26
                first, last = place - ((packed >> 5) & 31), place - (packed & 31)
                for column, values in zip(
                    out,
                    (hashes.tolist(), [doc] * len(hashes), [identity] * len(hashes), first.tolist(), (place - first).tolist(),
                     [data[x : y + span] for x, y in zip(first.tolist(), last.tolist())]),
                ):
                    column += values
            kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, kinds)], ["hash", "id", "identity", "first", "lead", "bytes"]
            )

    kind = "hash long, id long, identity long, first long, lead int, bytes binary"
    pieces = told.mapInArrow(around, kind).repartition("hash").sortWithinPartitions("hash", "id")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return judged(batches, span)

    masks = pieces.mapInArrow(judge, MASKS)
    if len(hot.value):
        masks = masks.unionByName(_hot_masks(named, hot, span))
    masks = masks.groupBy("id").agg(F.collect_list(F.struct("identity", "first", "mask")).alias("masks"))
    schema = T.StructType([
        source.schema["text"], source.schema["rest"],
        *(T.StructField(c, T.LongType()) for c in added[:3]), T.StructField(added[3], T.StringType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out = _bytes(batch.column("text")), []
            columns_ = (batch.column("text").is_null().to_pylist(), batch.column("found"), batch.column("masks"))
            for text, null, found_, masks_ in zip(texts, *columns_):
                first, last, left = [], [], text
                if found_.is_valid:
                    hashes, packed = (found_.values.field(k).to_numpy() for k in (0, 1))
                    packed = packed[(hashes == 0) & ((packed >> 10) & 0xFFFF == _identity(text))]
                    first.append((packed >> 26) - ((packed >> 5) & 31))
                    last.append((packed >> 26) - (packed & 31))
                if masks_.is_valid:
                    mine = masks_.values.field("identity").to_numpy() == _identity(text)
                    row, number = np.nonzero((masks_.values.field("mask").to_numpy()[mine][:, None] >> np.arange(REACH)) & 1)
                    first.append(masks_.values.field("first").to_numpy()[mine][row] + number)
                    last.append(first[-1])
                removed = spans = 0
                if first and sum(map(len, first)):
                    marks = np.zeros(len(text) + span + 1, np.int32)
                    np.add.at(marks, np.concatenate(first), 1)
                    np.add.at(marks, np.concatenate(last) + span, -1)
                    gone = np.cumsum(marks)[: len(text)] > 0
                    removed, spans = int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum())
                    left = np.frombuffer(text, np.uint8)[~gone].tobytes()
                shown = None if null else left.decode("utf-8", "ignore") if removed else text.decode("utf-8", "surrogatepass")
                out.append((shown, len(text), removed, spans, hashlib.sha256(left).hexdigest()))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([arrays[0], batch.column("rest"), *arrays[1:]], ["text", "rest", *added])

    done = told.join(masks.hint("shuffle_hash"), "id", "left").select("text", "rest", "found", "masks").mapInArrow(cut, schema)
    columns = [F.col("text").alias(text_col) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns]
    return done.select(*columns, *added)


def _hot_anchors(named: DataFrame, n_docs: int, span: int, rows: int) -> np.ndarray:
    """Hashes of anchors that would by a sample of documents have more than ``rows`` rows.

    As a document has few rows of an anchor, there are none if there are fewer documents.
    At most some hundred times the number of documents over ``rows`` hashes qualify.
    """
    if n_docs <= rows:
        return np.empty(0, np.int64)
    rate = min(1.0, SAMPLE_DOCS / n_docs)
    sample = named.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(rate * (1 << 20)) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bytes(batch.column(1))
            for a, b in _lots(texts):
                yield pa.RecordBatch.from_arrays([pa.array(anchors(texts[a:b], span)[1])], ["hash"])

    counts = sample.mapInArrow(run, "hash long").groupBy("hash").count()
    return np.array([r[0] for r in counts.filter(F.col("count") > max(1, rate * rows)).select("hash").collect()], np.int64)


def _hot_masks(named: DataFrame, hot: Broadcast, span: int) -> DataFrame:
    """Passages of hot anchors that an earlier document holds, each passage by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_texts = _bytes(batch.column(1))
            for a, b in _lots(all_texts):
                texts = all_texts[a:b]
                owner, hashes, _, first, last, _ = anchors(texts, span)
                keep = np.isin(hashes, hot.value)
                owner, first, last = owner[keep], first[keep], last[keep]
                each = last - first + 1
                row = np.repeat(np.arange(len(each)), each)
                at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
                owner = owner[row]
                begin = np.cumsum([0] + [len(t) for t in texts[:-1]])[owner]
                data = np.frombuffer(b"".join(texts), np.uint8)
                whole = piece_hashes(prefix_hashes(data), begin + at, begin + at + span)
                half = piece_hashes(prefix_hashes(data[::-1]), len(data) - begin - at - span, len(data) - begin - at)
                identity = np.array([_identity(t) for t in texts], np.int64)[owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mixed(whole, 3).view(np.int64)), pa.array(mixed(half, 4).view(np.int64)),
                     batch.column(0).slice(a, b - a).take(pa.array(owner)), pa.array(identity), pa.array(at)],
                    ["w1", "w2", "id", "identity", "first"],
                )

    rows = named.mapInArrow(run, "w1 long, w2 long, id long, identity long, first long")
    least = rows.groupBy("w1", "w2").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most")
    later = rows.join(least, ["w1", "w2"]).filter("id > least")
    return later.select("id", "identity", "first", F.lit(1).cast("long").alias("mask"))
