"""Operators of the optional subpackage against brute force, SQL, held-out labels and odd inputs."""

import hashlib
import itertools
import os
import re
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
public_tokenizers = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from scrubline.llm import ann, chat, embedding_dedup, jaccard_join, language_id, mixing, packing  # noqa: E402
from scrubline.llm import queries as llm  # noqa: E402
from scrubline.llm import suffix_dedup, token_files, toxicity  # noqa: E402
from scrubline.llm.encoding import WordEncoder  # noqa: E402
from scrubline.llm.words import WordRows, Words, gathered  # noqa: E402

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
SENTENCE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
# Nulls, empty and long texts, repeated rows, and columns with clashing names.
ODD = [
    (1, SENTENCE, "s1", "x"),
    (1, SENTENCE, "s1", "x"),
    (2, SENTENCE + " more", None, "x"),
    (3, None, "s2", None),
    (4, "", "s2", "x"),
    (None, SENTENCE, "s2", "x"),
    (5, "été à la plage! " * 4000, "s2", "x"),
    (6, "a", "s2", "x"),
]
ODD_SCHEMA = "doc_id long, text string, source string, copy string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r[0], r[1]) for r in rows)


def whole(tokenizer, text):
    return Tokenizer.from_file(tokenizer).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_the_tokenizer(path, documents):
    rng = np.random.default_rng(3)
    signs = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", ".", ",", "'s", "1", "²", "<|endoftext|>", "😀", "é", "İ", "don't"]
    texts = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 30, 2000)] + [t for _, t in documents[:40]]
    encoder, tokenizer = WordEncoder(path, limit=500, slice_chars=700), Tokenizer.from_file(path)
    for text in texts:
        ids = np.frombuffer(encoder.encode(text), encoder.dtype).tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_sql_twins(spark, sf_dir):
    connection = duckdb.connect()
    for name in ("documents", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    for name, sql in llm.oracle_sql().items():
        ours, theirs = llm.queries()[name](spark, sf_dir), connection.execute(sql)
        columns = [c[0] for c in theirs.description]
        assert sorted(map(repr, map(tuple, ours.select(*columns).collect()))) == sorted(map(repr, theirs.fetchall())), name


def test_op1_held_out(spark, sf_dir):
    sf_dir = os.path.dirname(sf_dir) + "/sf0.1"
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").collect()}
    rows = llm.op1_toxicity(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) > 0.95


def slow_logit(net, words):
    """The network's logit of up to a window of words, unit by unit, as its description has it."""
    w = {name: v.astype(float) for name, v in net.weights.items()}
    h = toxicity.HIDDEN

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def gates(word):
        points = [ord(c) if ord(c) < 256 else 256 + ord(c) % 64 for c in word[: toxicity.LETTERS]]
        codes = [0] + points + [0] * (toxicity.LETTERS + 1 - len(points))
        best = np.full(toxicity.CHAR_OUT, -np.inf)
        for i in range(len(codes) - 2):
            best = np.maximum(best, np.concatenate([w["char"][c] for c in codes[i : i + 3]]) @ w["conv"] + w["conv_bias"])
        row = toxicity.PAD if not word else net.vocabulary.get(word, toxicity.UNKNOWN)
        return np.concatenate([w["word"][row], np.maximum(best, 0)]) @ w["in"] + w["in_bias"]

    padded = words + [""] * (toxicity.WINDOW - len(words))
    inputs, both = [gates(x) for x in padded], [[], []]
    for side in (0, 1):
        state = np.zeros(h)
        for x in inputs if side == 0 else inputs[::-1]:
            x = x[3 * h * side : 3 * h * (side + 1)]
            g = state @ w["rec"][side]
            z, r = sigmoid(x[:h] + g[:h]), sigmoid(x[h : 2 * h] + g[h : 2 * h])
            state = (1 - z) * state + z * np.tanh(x[2 * h :] + r * g[2 * h :])
            both[side].append(state)
    hidden = [np.concatenate([a, b]) for a, b in zip(both[0], both[1][::-1])][: len(words)]
    weight = np.exp([v @ w["attention"] for v in hidden])
    return (weight / weight.sum()) @ np.array(hidden) @ w["out"] + w["out_bias"][0]


def test_op1_equals_a_slow_network(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["vile", "day", "été", "goodness", "x", "Ωmega", "unfathomablylongwordings"]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in rng.integers(1, 90, 30)]
    net = toxicity.fit(texts, [int("vile" in t[:30]) for t in texts], epochs=3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in toxicity.score(df, net).collect():
        words = toxicity.WORDS.of(texts[row.doc_id])
        starts = range(0, max(1, len(words) - toxicity.STEP), toxicity.STEP)
        worst = max(slow_logit(net, words[s : s + toxicity.WINDOW]) for s in starts)
        assert abs(row.score - 1 / (1 + np.exp(-worst))) < 1e-4


def test_op1_gradients():
    """Gradients of all weights against differences of the loss."""
    rng = np.random.default_rng(3)
    net = toxicity.fit(["a vile day", "one good day"] * 6, [1, 0] * 6, epochs=1)
    for name, v in net.weights.items():
        net.weights[name] = rng.standard_normal(v.shape) * 0.3
    words = ["", "vile", "day", "good", "other"]
    ids = np.array([0] + [net.vocabulary.get(w, toxicity.UNKNOWN) for w in words[1:]])
    codes, target = toxicity.char_codes(words), np.array([1.0, 0.0, 1.0])
    at = rng.integers(0, 5, (3, toxicity.WINDOW))
    at[:, 0], at[0, 1:6] = [1, 2, 3], [0, 1, 2, 3, 4]

    def loss():
        logit = toxicity.attend(net, toxicity.states(net, toxicity.word_inputs(net, ids, codes)[0][at])[0], ids[at] != 0)[0]
        return np.mean(np.logaddexp(0, logit) - target * logit)

    found = toxicity._gradients(net, ids, codes, at, target)
    for name, v in net.weights.items():
        flat = v.reshape(-1)
        for i in rng.choice(np.flatnonzero(np.abs(found[name].reshape(-1)) > 1e-3), 4):
            before, step = flat[i], 1e-3
            flat[i] = before + step
            above = loss()
            flat[i] = before - step
            slope = (above - loss()) / (2 * step)
            flat[i] = before
            assert abs(slope - found[name].reshape(-1)[i]) < 0.05 * abs(slope) + 2e-3, name


def test_op1_sample_needs_no_window(spark):
    docs = spark.range(4_000).selectExpr("id AS doc_id", "repeat('a ', CAST(id AS INT)) AS text").unionByName(
        spark.createDataFrame([(1, "a")] * 50, "doc_id long, text string")
    )
    labels = spark.range(4_000).selectExpr("id AS doc_id", "CAST(id % 3 = 0 AS INT) AS toxic")
    texts, toxic = toxicity.training_sample(docs, labels, per_class=100, longest=4_000)
    assert (len(texts), sum(toxic)) == (300, 100) and max(map(len, texts)) <= 4_000


def test_op1_odd(odd, empty):
    net = toxicity.fit(["good day to you"] * 4 + ["vile vile day"] * 4, [0] * 4 + [1] * 4, epochs=2)
    rows = toxicity.score(odd, net).collect()
    assert len(rows) == len(ODD) and [r.score for r in rows if r.doc_id in (3, 4)] == [0, 0]
    assert toxicity.reject_toxic(odd, net, threshold=2).count() == len(ODD)
    assert toxicity.score(empty, toxicity.fit([], [])).count() == 0


def brute_repeats(rows, span=50):
    seen, out = set(), {}
    for doc, text in rows:
        data = (text or "").encode()
        gone, own = np.zeros(len(data), bool), []
        for s in range(len(data) - span + 1):
            own.append(data[s : s + span])
            if own[-1] in seen:
                gone[s : s + span] = True
        seen.update(own)
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(data) else 0
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[doc] = (len(data), int(gone.sum()), runs, kept)
    return out


@pytest.mark.parametrize("bucket_rows", [1_000_000, 20])
def test_op2_brute_force(spark, documents, bucket_rows):
    few = documents[:80] + [(900, "x" * 300), (901, "y" + "x" * 200), (902, documents[3][1][5:])]
    df = spark.createDataFrame(few, "doc_id long, text string")
    rows = suffix_dedup.remove_repeats(df, bucket_rows=bucket_rows).collect()
    expected = {doc: (*found, hashlib.sha256(kept).hexdigest()) for doc, (*found, kept) in brute_repeats(few).items()}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == expected


def test_op2_odd(odd, empty):
    rows = suffix_dedup.remove_repeats(odd).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(r[0]) for r in ODD)
    by = {(r.doc_id, r.copy): r for r in rows}
    assert by[2, "x"].n_removed > 50 and by[1, "x"].n_removed == 0 and by[3, None].text is None
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_op2_short_texts(spark):
    df = spark.createDataFrame([(i, "too short for a passage") for i in range(5)], "doc_id long, text string").coalesce(1)
    rows = suffix_dedup.remove_repeats(df).collect()
    assert [(r.n_bytes, r.n_removed, r.text) for r in rows] == [(23, 0, "too short for a passage")] * 5


def test_op2_sorts_in_proportion_to_the_rows_of_an_anchor(monkeypatch):
    rng = np.random.default_rng(3)
    line, n = bytes(rng.integers(97, 123, 40).astype(np.uint8)), 3_000
    texts = [bytes(rng.integers(97, 123, 20).astype(np.uint8)) + line + bytes(rng.integers(97, 123, 8).astype(np.uint8)) for _ in range(n)]
    texts[5::7] = [a[:57] + b[57:] for a, b in zip(texts[4::7], texts[5::7])]
    texts[1] = texts[0][:10] + texts[1][10:]
    columns = {"hash": [7] * n, "id": range(n), "identity": [0] * n, "first": [3] * n}
    pieces = pa.table({c: pa.array(v, pa.int64()) for c, v in columns.items()} | {"lead": pa.array([16] * n, pa.int32()), "bytes": texts})
    sort, sorted_ = suffix_dedup.sort_suffixes, []
    monkeypatch.setattr(suffix_dedup, "sort_suffixes", lambda *a: sorted_.append(len(a[2])) or sort(*a))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 100)
    monkeypatch.setattr(suffix_dedup, "KEYS", 7_000)
    got = {}
    for batch in suffix_dedup.judged(iter(pieces.to_batches(max_chunksize=90)), 50):
        got |= dict(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()))
    seen, expected = set(), {}
    for i, text in enumerate(texts):
        own = [(k, text[k : k + 50]) for k in range(19)]
        if mask := sum(1 << k for k, _ in (x for x in own if x in seen)):
            expected[i] = mask
        seen.update(own)
    assert got == expected and len(got) > n // 8
    # Carried on from lot to lot: one passage of each kind at most.
    assert sum(sorted_) < 1.1 * 19 * n / 2 and max(sorted_) <= 101


def test_op2_packed_anchors_do_not_come_by_lot(documents):
    texts = [t or "" for _, t in documents]
    batches = [pa.RecordBatch.from_pydict({"id": [i], "text": [t]}) for i, t in enumerate(texts)]
    rows = list(suffix_dedup.bucketed(iter(batches), 50, 3, np.empty(0, np.int64)))
    assert [b.column("bucket").to_pylist() for b in rows] == [[0, 1, 2]]
    found = [suffix_dedup._unpack_rows(blob) for blob in rows[0].column("rows").to_pylist()]
    hashes, spans, ids, packed = (np.concatenate(x) for x in zip(*found))
    expected = Counter()
    for i, t in enumerate(texts):
        for _, h, place, first, last, s in zip(*suffix_dedup.anchors([t.encode()], 50)):
            expected[i, h & ((1 << 48) - 1), int(s) & ((1 << 40) - 1), place, first, last] += 1
    place = packed >> 26
    got = zip(ids, hashes, spans, place, place - ((packed >> 5) & 31), place - (packed & 31))
    assert Counter(tuple(map(int, x)) for x in got) == Counter({tuple(map(int, k)): v for k, v in expected.items()})


def brute_links(documents):
    """Per document its links and the smallest id they lead to."""

    def grams(text):
        w = re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").lower().encode())
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets = {d: grams(t) for d, t in documents}
    links, smallest = dict.fromkeys(sets, 0), {d: d for d in sets}

    def root(d):
        return d if smallest[d] == d else root(smallest[d])

    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
            links[a], links[b] = links[a] + 1, links[b] + 1
            x, y = sorted((root(a), root(b)))
            smallest[y] = x
    return {d: (links[d], root(d)) for d in sets}


def test_op3_brute_force(spark, sf_dir, documents):
    rows = llm.op3_jaccard_join(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_links, r.class_id) for r in rows} == brute_links(documents)


def test_op3_blocks_give_the_same(spark, documents, monkeypatch):
    words = documents[0][1].split()[:120]
    near = [(i, " ".join(words[:k] + [f"new{i}"] + words[k + 1 :])) for i, k in enumerate(range(1, 110, 2))]
    df = spark.createDataFrame(near, "doc_id long, text string")
    one = sorted(map(tuple, jaccard_join.link_texts(df).collect()))
    monkeypatch.setattr(jaccard_join, "BLOCK", 10)
    assert sorted(map(tuple, jaccard_join.link_texts(df).collect())) == one
    assert sum(r[2] for r in one) > 1000


def test_op3_odd(odd, empty):
    rows = {r.doc_id: r for r in jaccard_join.link_texts(odd).collect()}
    assert len(rows) == 7 and rows[2].class_id == 1 and rows[2].n_links == 1 and rows[3].kept
    left = jaccard_join.keep_one(odd)
    assert left.columns == odd.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 4, 5, 6]
    copies = odd.filter("doc_id IS NULL").unionByName(odd.filter("doc_id IS NULL")).unionByName(odd.filter("doc_id = 2"))
    assert [r.doc_id for r in jaccard_join.keep_one(copies).collect()] == [2]
    assert jaccard_join.keep_one(empty).count() == 0
    assert jaccard_join.link_texts(empty).count() == 0


def test_op4_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 32))
    x = np.concatenate([base, np.repeat(base[:6], 25, 0) + 0.06 * rng.standard_normal((150, 32)), base[:3] * 2])
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    odd_rows = [(900, None), (901, [0.0] * 32), (902, [float("nan")] + [1.0] * 31), (903, [1.0]), (904, [None] * 32), rows[0]]
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    root = np.arange(len(u))
    for _ in range(len(u)):
        root = np.minimum(root, np.where(near, root[None], len(u)).min(1))
    df = spark.createDataFrame(rows + odd_rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in embedding_dedup.link_vectors(df).collect()}
    assert len(got) == len(rows) + 5 and all(got[i].n_links == 0 and got[i].kept for i in range(900, 905))
    assert [got[i].n_links for i in range(len(u))] == near.sum(1).tolist()
    assert [got[i].component_id for i in range(len(u))] == root.tolist()
    assert embedding_dedup.link_vectors(df.limit(0)).count() == 0


def linked_vectors(n, cluster, seed):
    """Random vectors, a tenth of them with a partner of cosine about 0.92, and a cluster with cosines around 0.93."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 64))
    x[:cluster] = 8 * x[0] / np.linalg.norm(x[0]) + 0.27 * x[:cluster]
    pairs = (n - cluster) // 20
    x[n - pairs :] = x[n - 2 * pairs : n - pairs] + 0.42 * x[n - pairs :]
    x = x.astype(np.float32)
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = np.concatenate([(u[a : a + 2000] @ u.T >= 0.9).sum(1) - 1 for a in range(0, n, 2000)])
    return [(i, v.tolist()) for i, v in enumerate(x)], links


@pytest.mark.parametrize("n, cluster", [(2_000, 0), (6_000, 2_000), (20_000, 0)])
def test_op4_recall_and_work(spark, n, cluster):
    rows, expected = linked_vectors(n, cluster, n)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.link_vectors(df).collect()}
    found = np.array([got[i] for i in range(n)])
    assert (found <= expected).all() and found.sum() >= 0.98 * expected.sum() > 0
    compared = embedding_dedup.compared_pairs(df)
    if cluster:
        assert compared <= 2 * expected.sum() / 2
    elif n >= 20_000:
        assert compared <= 0.05 * n * (n - 1) / 2


def test_op4_is_exact_with_one_pivot(spark):
    rows, expected = linked_vectors(1_500, 500, 3)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.link_vectors(df, pivots=1).collect()}
    assert [got[i] for i in range(1_500)] == expected.tolist()
    assert embedding_dedup.compared_pairs(df, pivots=1) == 1_500 * 1_499 // 2


def test_op4_pairs_share_enough_pivots_and_meet_once():
    rng = np.random.default_rng(9)
    numbers = np.sort(np.array([rng.permutation(130)[:9] for _ in range(120)]), axis=1)
    masks, shared = embedding_dedup.bits(numbers, 130), {}
    for i, j in itertools.combinations(range(120), 2):
        both = set(numbers[i]) & set(numbers[j])
        if len(both) >= 2:
            shared[i, j] = min(both)
    met = []
    for here in range(130):
        # Lists hold a vector by its rarest pivots only.
        at = np.flatnonzero((numbers[:, : 9 - 2 + 1] == here).any(1))
        i, j = embedding_dedup.sharing(masks[at], masks[at], 2, here)
        met += [(at[a], at[b], here) for a, b in zip(i, j) if at[a] < at[b]]
    assert sorted(met) == sorted((i, j, p) for (i, j), p in shared.items())


def test_op4_pivots_of_one_neighbourhood():
    rng = np.random.default_rng(2)
    x = 3 * rng.standard_normal(64) + 0.8 * rng.standard_normal((900, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert len(embedding_dedup.spread(x, 40)) == 40


def test_op5_brute_force(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in llm.op5_token_files(spark, sf_dir).collect()}
    tokenizer, start = Tokenizer.from_file(BYTE), 0
    for doc, text in documents:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (rows[doc].start, rows[doc].n_tokens, rows[doc].ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_op5_reads_back_in_a_task_per_shard(spark, tmp_path):
    docs = spark.range(5_000).selectExpr("id AS doc_id", "repeat('word ', CAST(id % 40 AS INT)) AS text")
    # Small ranges would be merged, and make one shard.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    shards = token_files.write_token_files(docs, str(tmp_path / "ids"), BYTE, 2)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = token_files.read_token_files(spark, str(tmp_path / "ids"), shards)
    n = shards.filter("n_docs > 0").count()
    assert n > 1 and read.select(F.spark_partition_id()).distinct().count() == n and read.count() == 5_000


def test_op5_lots():
    offsets = np.concatenate([[7], 7 + np.cumsum([0, 5, 9_000_000, 1, 1] + [2_000_000] * 5)])
    lots = list(token_files.lots(offsets))
    assert [a for a, _ in lots] == [0] + [b for _, b in lots[:-1]] and lots[-1][1] == len(offsets) - 1
    assert all(offsets[b] - offsets[a] <= token_files.LOT_IDS or b == a + 1 for a, b in lots)


def test_op5_odd(spark, odd, empty, tmp_path):
    shards = token_files.write_token_files(odd, str(tmp_path / "odd"), BYTE, 2)
    rows = token_files.read_token_files(spark, str(tmp_path / "odd"), shards).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1, 2, 3, 4, 5, 6]
    assert [r.n_tokens for r in rows if r.doc_id in (3, 4)] == [1, 1]
    shards = token_files.write_token_files(empty, str(tmp_path / "empty"), BYTE, 2)
    assert token_files.read_token_files(spark, str(tmp_path / "empty"), shards).count() == 0


def test_op6_weights_and_odd(spark, odd, empty):
    docs = spark.range(4000).selectExpr("id AS doc_id", "IF(id % 4 = 0, 'a', 'b') AS source", "'t' AS text")
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 9.0)], "source string, weight double")
    n = {r[0]: r[1] for r in mixing.mix(docs, weights, total=40_000).groupBy("source").count().collect()}
    assert abs(n["a"] / 30_000 - 1) < 0.05 and abs(n["b"] / 10_000 - 1) < 0.05
    mixed = mixing.mix(odd, 0.5, total=400)
    assert mixed.columns == ["doc_id", "text", "source", "copy", "mix_key"] and {r[0] for r in mixed.select("source").collect()} == {"s1", "s2", None}
    assert mixing.mix(empty, 0.5).count() == 0


def test_op7_template():
    with pytest.raises(chat.TemplateError):
        chat.compile_template("{{ messages.__class__() }}")
    folded = chat.fold_body(chat.parse("{% if 1 == 2 %}a{% else %}b{{ 'c' ~ 'd' }}{% endif %}e"))
    assert folded == [("out", ("const", "bcd")), ("out", ("const", "e"))] or folded == [("out", ("const", "bcde"))]
    render = chat.compile_template("{% for m in messages %}{% generation %}{{ m.x }}{% endgeneration %};{% endfor %}")
    assert render([{"x": "ab"}, {"x": None}, {}]) == ("ab;;;", [(0, 2), (3, 3), (4, 4)])
    text = "\\### Assistant: </turn> ok"
    assert chat.unescape(chat.escape(text)) == text


def test_op7_odd(spark):
    rows = [(1, 0, None, None), (1, None, "a:b", "x\n</turn>"), (None, 0, "assistant", "y"), (2, 0, "assistant", ""), (2, 0, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(df)).collect()}
    assert got[1].n_turns == 2 and got[None].loss_chars == 1 and got[2].n_turns == 2
    assert got[1].turns_sha256 == hashlib.sha256("a:b\nx\n</turn>\n\n\n".encode()).hexdigest()
    assert chat.digest(chat.format_conversations(df.limit(0))).count() == 0


def test_op7_parts(spark):
    turns = [(7, t, ("user", "assistant")[t % 2], f"turn {t} # :" * 40) for t in range(400)] + [(c, 0, "user", "hi") for c in range(6)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    template = "<s>{% for m in messages %}{{ m.role }}: {% generation %}{{ m.text }}{% endgeneration %};{% endfor %}</s>"
    whole = chat.compile_template(template)
    for part_chars in (1, 3000, 1 << 20):
        parts = chat.format_conversations(df, template, part_chars).orderBy("conv_id", "part").collect()
        for conv in (0, 7):
            text, spans, at = "", [], 0
            for p in (p for p in parts if p.conv_id == conv):
                spans += [(at + s.start, at + s.end) for s in p.loss]
                text, at = text + p.formatted, at + len(p.formatted)
            assert (text, spans) == whole([{"role": r, "text": x} for c, _, r, x in sorted(turns) if c == conv])
    one, many = (sorted(map(tuple, chat.digest(chat.format_conversations(df, part_chars=n)).collect())) for n in (1, 1 << 20))
    assert one == many and len(one) == 7
    for wrong in ("no loop", "{{ messages }}{% for m in messages %}{% endfor %}", "{% for m in messages %}{{ messages }}{% endfor %}"):
        with pytest.raises(chat.TemplateError):
            chat.format_conversations(df, wrong)


def test_op8_held_out(spark, sf_dir):
    sf_dir = os.path.dirname(sf_dir) + "/sf0.01"
    lang = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in llm.op8_language_id(spark, sf_dir).collect() if r.held_out]
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in held]) > 0.97


def test_op8_marginalises_and_odd(odd, empty):
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    model = language_id.fit({"x": ["abba abab"], "y": ["été"]}, vocabulary)
    ids = language_id.pieces(vocabulary)

    longest = language_id.longest_piece(vocabulary)
    assert longest == max(map(len, ids)) > 6

    def total(word, k):
        """Sum over all segmentations, from the end."""
        ahead = [1.0]
        for i in range(len(word) - 1, -1, -1):
            found = ((ids.get(word[i : i + n], 0 if n == 1 else None), n) for n in range(1, len(word) - i + 1))
            ahead.insert(0, sum(model.probability[p, k] * ahead[n - 1] for p, n in found if p is not None))
        return ahead[0]

    long = max((p for p in ids if len(p) == longest), key=str)
    for word in ("abbab", long, "x" + long + "abba", "abbaété" * 5, ("abba" + long) * 2):
        expected = np.log([total(word, k) for k in (0, 1)])
        assert np.allclose(language_id.word_scores([word], model)[0], expected, rtol=1e-4), word
    # A very long run does not underflow, and is as likely as its letters one by one, or likelier.
    endless = language_id.word_scores(["abbaabab" * 2_000], model)[0]
    assert np.isfinite(endless).all() and endless[0] > endless[1]
    rows = language_id.identify(odd, model).collect()
    assert [r.lang_pred for r in rows if r.doc_id in (3, 4)] == ["und", "und"] and len(rows) == len(ODD)
    assert language_id.identify(empty, model).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd, language_id.fit({}, vocabulary)).collect()} == {"und"}


def test_op9_recall_and_odd(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = {}
    for r in llm.op9_nearest(spark, sf_dir).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = []
    for q in ids[ids % 20 == 0]:
        s = (x * x[ids == q]).sum(1)
        s[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        hits.append(len({v for v, _ in found[q]} & set(best.tolist())) / 20)
        assert len(found[q]) == 20 and all(abs(s[ids == v][0] - score) < 1e-12 for v, score in found[q])
    assert np.mean(hits) >= 0.9
    odd = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (20, None), (40, [0.0, 0.0]), (3, [float("inf"), 1.0]), (0, [1.0, 0.0])]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in ann.nearest(df, df.vec_id % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0)]
    assert ann.nearest(df.limit(0), df.vec_id % 20 == 0).count() == 0


def test_op10_brute_force(spark, sf_dir, documents):
    rows = llm.op10_best_fit_packing(spark, sf_dir).collect()
    tokenizer, expected = Tokenizer.from_file(WORD), set()
    for doc, text in documents:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a : a + 4096]
            expected.add((doc, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {tuple(r)[:5] for r in rows} == expected and len(rows) == len(expected)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= -(-sum(r.length for r in rows) // 4096) + 1


def fewest(sizes, capacity):
    """Sequences that the best of all packings needs."""
    best = [len(sizes)]

    def place(rest, rooms):
        if len(rooms) >= best[0]:
            return
        if not rest:
            best[0] = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= rest[0] and rooms[i] not in rooms[:i]:
                place(rest[1:], [*rooms[:i], rooms[i] - rest[0], *rooms[i + 1 :]])
        place(rest[1:], [*rooms, capacity - rest[0]])

    place(sorted(sizes, reverse=True), [])
    return best[0]


def test_op10_reduction_keeps_the_optimum():
    assert packing.plan({9: 3, 8: 2}, 10)["n"] == 5 and packing.plan({}, 10)["n"] == 0
    rng = np.random.default_rng(1)
    reduced = 0
    for _ in range(150):
        sizes = rng.integers(1, 13, 9).tolist()
        hist = packing.Histogram({k: sizes.count(k) for k in sizes})
        fixed = packing.reduce_dominated(hist, 12)
        rest = [k for k, n in hist.counts.items() for _ in range(n)]
        taken = [k for contents, n in fixed for k, each in contents for _ in range(each * n)]
        assert sorted(rest + taken) == sorted(sizes)
        assert sum(n for _, n in fixed) + fewest(rest, 12) == fewest(sizes, 12)
        reduced += bool(fixed)
    assert reduced > 100


def test_op10_odd(odd, empty):
    rows = packing.pack(odd, WORD).collect()
    assert sorted(str(r.doc_id) for r in rows if r.piece == 0) == sorted(str(r[0]) for r in ODD)
    assert packing.pack(empty, WORD).count() == 0


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = []
    for name, stage in pipeline.STAGES[1:4]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        names.append(name)
    assert len(pipeline.STAGES) == 5 and pipeline.run(spark, sf_dir).count() > 0


def test_pipeline_equals_brute_force(spark, sf_dir):
    """Every stage done by plain code, document by document."""
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = toxicity.fit(*toxicity.training_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    left = []
    for row in sorted(docs.collect(), key=lambda r: r.doc_id):
        words = toxicity.WORDS.of(row.text)
        starts = range(0, max(1, len(words) - toxicity.STEP), toxicity.STEP)
        if not words or max(slow_logit(net, words[a : a + toxicity.WINDOW]) for a in starts) < 0:
            left.append(row)
    roots = brute_links([(r.doc_id, r.text) for r in left])
    left = [r for r in left if roots[r.doc_id][1] == r.doc_id]
    cut = brute_repeats([(r.doc_id, r.text) for r in left])
    texts = {doc: kept.decode("utf-8", "ignore") for doc, (_, _, _, kept) in cut.items()}

    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", [(r.doc_id, r.source) for r in left])
    copies = [r[0] for r in connection.execute(llm.oracle_sql()["op6_mix_sources"]).fetchall()]
    tokenizer, expected = Tokenizer.from_file(WORD), Counter()
    for doc in copies:
        ids = tokenizer.encode(texts[doc], add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a : a + 4096]
            expected[doc, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    rows = pipeline.run(spark, sf_dir).collect()
    assert Counter(tuple(r)[:5] for r in rows) == expected
    assert 20 < len(left) < docs.count() and len(copies) != len(left)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        ends = np.cumsum([length for _, length in sorted(parts)])
        assert [offset for offset, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 4096


def test_pipeline_cuts_nothing_from_short_texts(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = spark.createDataFrame([(i, "too short for a passage", "en", "s", 23) for i in range(5)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = pipeline.drop_repeated_passages(spark, docs.coalesce(1), sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, docs.collect()))


def test_lots_of_words_are_made_one_at_a_time():
    class Counting(Words):
        texts = 0

        def slices(self, *args):
            self.texts += 1
            return super().slices(*args)

    words = Counting(None)
    batch = pa.RecordBatch.from_arrays([pa.array(["a b c d"] * 1_000)], ["text"])
    for _, lots in gathered(words, iter([batch]), 0, 40):
        rows, held = next(iter(lots))
        assert words.texts == len(rows) == 10 and held == list("abcd") * 10
        assert sum(len(more) for more, _ in lots) == 990


def test_rows_of_words_are_not_copied_as_they_become_more():
    table = WordRows(lambda words: np.array([[len(w)] for w in words], np.float32), limit=10_000)
    table.lookup(["a"])
    first, many = table.rows, ["x" * (i % 50) + str(i) for i in range(9_000)]
    at = table.lookup(many)
    assert table.rows is first and table.rows[at, 0].tolist() == [len(w) for w in many]
    more = [f"more{i}" for i in range(12_000)]
    at = table.lookup(more)
    assert table.rows[at, 0].tolist() == [len(w) for w in more]


def test_a_new_word_is_made_once_and_found_in_the_older_memo():
    encoder, made = WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), limit=3), []
    make = encoder._memo.make
    encoder._memo.make = lambda word: made.append(word) or make(word)
    texts = ["a known known word, Größe", "a known word, new"]
    got = [encoder.encode(t) for t in texts]
    assert made == ["known", "word,", "Größe", "new"]
    assert got == [encoder._whole(t) for t in texts]
    # The memo is full: what it has becomes the older one, which makes nothing anew.
    encoder._word = made.append
    assert encoder.encode("a new known word,") == encoder._whole("a new known word,") and len(made) == 4
    assert set(encoder._memo) == {"new", "known", "word,"} and len(encoder._memo.older) == 4
