"""Repair of conversations by an auction algorithm for shortest paths.

A conversation and its edits form a lattice: a layer of nodes before each row and after the
last, one node per state of the role grammar ``(s?(ua)+)?``, and an arc per edit. Prices of
nodes never exceed the cost of an arc plus the price of its end. From an origin a path is
extended over its cheapest arc while that holds with equality; else the price of its last
node is raised to it and the path contracted by that node. Every node is an origin in turn,
the last layer first; a path is done where it meets a node whose price has converged. Prices
are then costs to the end, the arcs that hold with equality (tight ones) make up all cheapest
repairs, and the walk over the least letters of tight arcs is the least audit.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import bounded_batches, written

BEGUN, SYSTEM, USER, ASSISTANT = range(4)
# The role that comes next where one is made or changed, by state.
FOLLOWS = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
# Letters of roles: 0 for all others.
LETTERS = ("s", "u", "a")
KEEPS = {(BEGUN, 1): SYSTEM, (BEGUN, 2): USER, (SYSTEM, 2): USER, (ASSISTANT, 2): USER, (USER, 3): ASSISTANT}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
FAULTS = (None, "blank", "duplicate", "truncated")
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 4, 3, 3, 3
ENDS = (BEGUN, ASSISTANT)
BLANKS = " \t\n\v\f\r"
EDIT_SCHEMA = "conv_id long, place long, edit string, times long, turn long, role_was string, role string, text string, fault string"
DIGEST_SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


@lru_cache(maxsize=1 << 16)
def arcs(state: int, letter: int, fault: int, times: int) -> tuple[tuple[str, int, bool, int], ...]:
    """Edits at a row, in order of their letters: (letter, cost, whether the row is used up, next state)."""
    found = [("D", DELETE_COST * times, True, state), ("I", INSERT_COST, False, FOLLOWS[state])]
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        if (state, letter) in KEEPS:
            found.append(("K", extra, True, KEEPS[state, letter]))
        found.append(("R", REROLE_COST + extra, True, FOLLOWS[state]))
    return tuple(found)


END_ARCS = tuple((*([("", 0, True, 0)] if q in ENDS else []), ("I", INSERT_COST, False, FOLLOWS[q])) for q in range(4))


def auction(out: tuple[tuple, ...], ahead: tuple[int, ...]) -> list[int]:
    """Prices of a layer's nodes, from their arcs and the converged prices of the layer ahead."""
    # Feasible to begin with: all cost at least as much as the cheapest node ahead.
    price, done = [min(ahead)] * len(out), [False] * len(out)
    for origin in range(len(out)):
        path = [origin]
        while not done[path[-1]]:
            last = path[-1]
            least, uses, to = min(((cost + (ahead[v] if uses else price[v])), uses, v) for _, cost, uses, v in out[last])
            if price[last] < least:
                price[last] = least
                if len(path) > 1:
                    path.pop()
            elif uses:
                break
            else:
                path.append(to)
        for node in path:
            done[node] = True
    return price


@lru_cache(maxsize=1 << 16)
def layer(row: tuple[int, int, int] | None, ahead: tuple[int, ...]) -> tuple[int, tuple[int, ...], str]:
    """A layer's lowest price, its prices above that, and the least letter of a tight arc per node.

    Prices ``ahead`` are above the lowest there; so few of them occur that layers repeat.
    """
    out = END_ARCS if row is None else tuple(arcs(q, *row) for q in range(4))
    price = auction(out, ahead)
    tight = "".join(
        next(e or "." for e, cost, uses, v in out[q] if price[q] == cost + (ahead[v] if uses else price[v])) for q in range(4)
    )
    low = min(price)
    return low, tuple(p - low for p in price), tight


def cheapest(letters: bytes, faults: bytes, times: array) -> tuple[int, Iterator[str]]:
    """Cost of the cheapest repair of some rows, and the letters of its least audit.

    A row that stands for several deletes has one letter for all of them.
    """
    total, ahead = 0, (0, 0, 0, 0)
    chosen = bytearray(4 * (len(letters) + 1))
    for i in range(len(letters), -1, -1):
        row = None if i == len(letters) else (letters[i], faults[i], times[i])
        low, ahead, tight = layer(row, ahead)
        total += low
        chosen[4 * i : 4 * i + 4] = tight.encode()

    def walk() -> Iterator[str]:
        i, state = 0, BEGUN
        while True:
            edit = chr(chosen[4 * i + state])
            if edit == ".":
                return
            yield edit
            if edit == "K":
                state = KEEPS[state, letters[i]]
            elif edit != "D":
                state = FOLLOWS[state]
            i += edit != "I"

    return total + ahead[BEGUN], walk()


def _coded(rows: DataFrame) -> DataFrame:
    """Rows once each, with how many there are of them, the letter of their role, and faults that rows show alone."""
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    letter = F.lit(0)
    for i, initial in enumerate(LETTERS, 1):
        letter = F.when(F.substring("role", 1, 1) == initial, i).otherwise(letter)
    fault = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    return once.withColumns({"digest": F.unhex(F.sha2("text", 256)), "letter": letter, "fault": fault})


def repair(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Cheapest edits that make roles alternate, in order: one row per edit of a conversation.

    conv_id, place (from 0), edit, times, turn, role_was, role, text, fault. Keep (K) costs 0,
    Rerole (R) to user or assistant 3, Delete (D) 4, Insert (I) of an empty turn 3, a kept or
    reroled row that is truncated 3 more. Roles are then, by their first letters,
    ``(s?(ua)+)?``. Blank rows (nothing but blanks) and duplicates (role and text came before)
    must be deleted; a row is truncated if its last character that is no blank is none of
    ``.!?``. A row's first fault counts. Among the cheapest the least audit (letters in order)
    is taken. ``role`` is that after the edit, null for deleted rows; ``times`` counts equal
    rows deleted by one edit, and is 1 otherwise.

    Rows go by turn, nulls first, ties by role and SHA-256 of the text. Null roles and texts
    are one space; a role without letters cannot be kept. Rows with a null id form a
    conversation of their own. Other columns are ignored.

    Copies of a row are counted before anything is shuffled, and duplicates are found by
    conversation, role and text. One task walks over a conversation: it holds some bytes a
    row for the lattice and passes texts on one by one. Rows of a conversation come out
    together and in order.
    """
    bounded_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    )
    coded = written(_coded(rows), "repair-rows")
    keys = ["conv_id", "turn", "role", "digest"]
    # Nulls first: a struct of whether there is a turn, and the turn.
    earliest = F.min(F.struct(F.col("turn").isNotNull(), "turn"))
    first = coded.groupBy("conv_id", "role", "digest").agg(earliest["turn"].alias("turn")).withColumn("first", F.lit(True))
    narrow, first = coded.select(*keys, "copies", "letter", "fault").alias("n"), first.alias("f")
    met = [F.col(f"n.{c}").eqNullSafe(F.col(f"f.{c}")) for c in keys]
    narrow = narrow.join(first, met, "left").select("n.*", "f.first")
    repeated = F.when((F.col("fault") != BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    plan = narrow.withColumns({"fault": repeated, "kind": F.lit(0)}).drop("first")
    both = plan.unionByName(coded.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    order = ["conv_id", "kind", "turn", "role", "digest"]
    dealt = both.repartition("conv_id").sortWithinPartitions(*order).drop("digest")
    return dealt.mapInArrow(_edit, EDIT_SCHEMA)


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of conversations whose rows come in order, all of them without text first."""
    names = [f.split()[0] for f in EDIT_SCHEMA.split(", ")]
    kinds = [pa.string() if "string" in f else pa.int64() for f in EDIT_SCHEMA.split(", ")]
    out: list[tuple] = []
    conv, place, state, at = object(), 0, BEGUN, 0
    letters, faults, times, walk = bytearray(), bytearray(), array("q"), None

    def tell(edit: str, n: int, turn: int | None, was: str | None, text: str, fault: int) -> None:
        nonlocal place, state
        role = None if edit == "D" else was
        if edit in "RI":
            state = FOLLOWS[state]
            role = ROLE[state]
        elif edit == "K":
            state = KEEPS[state, letters[at]]
        out.append((conv, place, edit, n, turn, was, role, text, FAULTS[fault]))
        place += 1

    def inserted() -> str | None:
        """Tells inserts, up to the next edit of a row."""
        for edit in walk:
            if edit != "I":
                return edit
            tell("I", 1, None, None, "", SOUND)

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text", "copies", "letter", "fault"))
        for id_, kind, turn, role, text, copies, letter, fault in zip(*columns):
            if id_ != conv or (kind == 0 and walk is not None):
                if walk is not None:
                    inserted()
                conv, place, state, at = id_, 0, BEGUN, 0
                letters, faults, times, walk = bytearray(), bytearray(), array("q"), None
            if kind == 0:
                letters.append(letter), faults.append(fault), times.append(copies if fault in (BLANK, DUPLICATE) else 1)
                if copies > times[-1]:
                    letters.append(letter), faults.append(DUPLICATE), times.append(copies - 1)
                continue
            if walk is None:
                walk = cheapest(bytes(letters), bytes(faults), times)[1]
            while copies:
                n, edit = times[at], inserted()
                tell(edit, n, turn, role, text, faults[at])
                at += 1
                copies -= n
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
            out.clear()
    if walk is not None:
        inserted()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def digest(edits: DataFrame) -> DataFrame:
    """One row per conversation about edits that come as ``repair`` gives them, read one after another.

    conv_id, gaps in turns, rows by fault, ``illegal`` neighbours before the repair, cost,
    audit, and a hash of the repaired ``role:text``, a line each.
    """
    names = [f.split()[0] for f in DIGEST_SCHEMA.split(", ")]
    kinds = [pa.string() if "string" in f else pa.int64() for f in DIGEST_SCHEMA.split(", ")]
    price = {"K": 0, "R": REROLE_COST, "D": DELETE_COST, "I": INSERT_COST}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        seen: dict | None = None

        def told() -> tuple:
            gaps = 0 if seen["last"] is None else seen["last"] - seen["low"] + 1 - seen["turns"]
            counts = (seen[f] for f in ("blank", "duplicate", "truncated", "illegal", "cost"))
            return seen["conv"], gaps, *counts, "".join(seen["audit"]), seen["hash"].hexdigest()

        for batch in batches:
            for id_, place, edit, n, turn, was, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if place == 0:
                    if seen is not None:
                        done.append(told())
                    seen = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
                    seen |= {"conv": id_, "low": None, "last": None, "before": None, "audit": [], "hash": hashlib.sha256(), "any": False}
                seen["audit"].append(edit * n)
                seen["cost"] += price[edit] * n + (TRUNCATED_COST if fault == "truncated" and edit != "D" else 0)
                if fault:
                    seen[fault] += n
                if edit != "I":
                    if turn is not None and turn != seen["last"]:
                        seen["turns"] += 1
                        seen["low"] = turn if seen["low"] is None else seen["low"]
                        seen["last"] = turn
                    if seen["before"] is not None:
                        seen["illegal"] += seen["before"] + was[:1] not in ("su", "ua", "au")
                    seen["illegal"] += n - 1
                    seen["before"] = was[:1]
                if role is not None:
                    line = f"{role}:{text}" if not seen["any"] else f"\n{role}:{text}"
                    seen["hash"].update(line.encode("utf-8", "surrogatepass"))
                    seen["any"] = True
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
                done = []
        if seen is not None:
            done.append(told())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    return edits.mapInArrow(run, DIGEST_SCHEMA)
