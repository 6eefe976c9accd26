"""Conversation repair against every sequence of edits, step by step, and odd inputs."""

import hashlib
import re
from array import array

import numpy as np
import pytest

from scrubline.llm import queries, repair

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
KEEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def brute_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        if not marks:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if marks[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """Cost, audit and repaired rows: the least (cost, audit) of all paths, kept per state."""
    def insert(paths):
        for _ in range(3):
            for q in list(paths):
                cost, audit, done = paths[q]
                role = {"u": "user", "a": "assistant"}[NEXT[q]]
                offer(paths, NEXT[q], (cost + 3, audit + "I", done + [f"{role}:"]))

    def offer(paths, q, path):
        if q not in paths or path[:2] < paths[q][:2]:
            paths[q] = path

    paths = {"": (0, "", [])}
    insert(paths)
    for (_, role, text), fault in zip(rows, brute_faults(rows)):
        new = {}
        for q, (cost, audit, done) in paths.items():
            offer(new, q, (cost + 4, audit + "D", done))
            if fault in ("blank", "duplicate"):
                continue
            cost += 3 * (fault == "truncated")
            if (q, role[:1]) in KEEP:
                offer(new, KEEP[q, role[:1]], (cost, audit + "K", done + [f"{role}:{text}"]))
            made = {"u": "user", "a": "assistant"}[NEXT[q]]
            offer(new, NEXT[q], (cost + 3, audit + "R", done + [f"{made}:{text}"]))
        insert(new)
        paths = new
    return min(paths[q] for q in ("", "a") if q in paths)


def brute_digest(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    turns = [r[0] for r in rows if r[0] is not None]
    faults = brute_faults(rows)
    cost, audit, done = brute_repair(rows)
    letters = [r[1][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(done).encode()).hexdigest(),
    )


@pytest.fixture(scope="module")
def messy():
    rng = np.random.default_rng(11)
    roles, texts = ["user", "assistant", "system", "tool", "", "sage"], ["Fine.", "cut", " \t\n", "", "What?", "no. \v", "é!"]
    rows = []
    for conv in range(300):
        turn = int(rng.integers(-3, 3))
        for _ in range(int(rng.integers(0, 9))):
            turn += int(rng.choice([0, 1, 1, 1, 1, 2, 5]))
            row = (conv, None if rng.random() < 0.05 else turn, str(rng.choice(roles)), str(rng.choice(texts)))
            rows += [row] * int(rng.choice([1, 1, 1, 1, 2, 3]))
    return rows


def test_digests_equal_brute_force(spark, messy):
    df = spark.createDataFrame(messy, "conv_id long, turn long, role string, text string").repartition(5)
    found = {r[0]: tuple(r[1:]) for r in repair.digest(repair.repair(df)).collect()}
    by_conv = {}
    for conv, *row in messy:
        by_conv.setdefault(conv, []).append(row)
    assert found == {conv: brute_digest(rows) for conv, rows in by_conv.items()}


def test_edits_are_the_repaired_conversation(spark, messy):
    df = spark.createDataFrame(messy, "conv_id long, turn long, role string, text string")
    edits = repair.repair(df).collect()
    assert sum(e.times for e in edits if e.edit != "I") == len(messy)
    by_conv = {}
    for e in sorted(edits, key=lambda e: (e.conv_id, e.place)):
        by_conv.setdefault(e.conv_id, []).append(e)
    for found in by_conv.values():
        assert [e.place for e in found] == list(range(len(found)))
        roles = "".join(e.role[0] for e in found if e.edit != "D")
        assert re.fullmatch("(s?(ua)+)?", roles), roles
        assert all(e.edit == "D" for e in found if e.fault in ("blank", "duplicate"))
        assert all((e.role is None) == (e.edit == "D") for e in found)


def test_prices_converge_to_the_cost_of_the_rest():
    """Whatever the price of the layer ahead, the auction ends with the fixed point of cost plus price."""
    rng = np.random.default_rng(5)
    for _ in range(2000):
        ahead = tuple(int(x) for x in rng.integers(0, 12, 4))
        out = tuple(repair.arcs(q, int(rng.integers(0, 4)), int(rng.integers(0, 4)), int(rng.integers(1, 4))) for q in range(4))
        price = repair.auction(out, ahead)
        assert price == [min(c + (ahead[v] if uses else price[v]) for _, c, uses, v in out[q]) for q in range(4)]


def test_long_conversations_take_linear_work():
    n = 200_000
    cost, walk = repair.cheapest(bytes([2, 2, 3, 1] * (n // 4)), bytes([0, 3, 0, 1] * (n // 4)), array("q", [1]) * n)
    audit = "".join(walk)
    assert len(audit) >= n and cost == 3 * audit.count("I") + 3 * audit.count("R") + 4 * audit.count("D") + 3 * (
        n // 4 - [c for c in audit if c != "I"][1::4].count("D")
    )
    assert repair.layer.cache_info().currsize < 2000


def test_copies_and_odd_inputs(spark):
    schema = "conv_id long, turn long, role string, text string, kind string, copies int, place int"
    rows = [(1, 0, "user", "x" * 200_000 + ".", "k", 1, 2)] * 5000 + [(1, 1, "assistant", "Yes.", None, None, None)]
    rows += [(2, None, None, None, "k", 1, 2), (None, 3, "user", "Hm.", "k", 1, 2)]
    edits = {}
    # All copies as one partition's rows would be large: they are made in Spark.
    many = spark.createDataFrame(rows[-3:], schema).unionByName(
        spark.range(5000).selectExpr("1L AS conv_id", "0L AS turn", "'user' AS role", "concat(repeat('x', 2000), '.') AS text",
                                     "'k' AS kind", "1 AS copies", "2 AS place")
    )
    for e in repair.repair(many).collect():
        edits.setdefault(e.conv_id, []).append((e.edit, e.times, e.role))
    assert edits[1] == [("K", 1, "user"), ("D", 4999, None), ("K", 1, "assistant")]
    assert edits[2] == [("D", 1, None)]
    assert edits[None] == [("K", 1, "user"), ("I", 1, "assistant")]
    told = {r.conv_id: r for r in repair.digest(repair.repair(many)).collect()}
    assert told[1].audit == "K" + "D" * 4999 + "K" and told[1].duplicate == 4999 and told[1].illegal == 4999
    empty = spark.createDataFrame([], schema)
    assert repair.repair(empty).count() == 0 and repair.digest(repair.repair(empty)).count() == 0


def test_op11_names_every_conversation(spark, sf_dir):
    rows = queries.op11_conversation_repair(spark, sf_dir).collect()
    ids = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct().count()
    assert len(rows) == ids and all(v is not None for r in rows for v in r[1:])
