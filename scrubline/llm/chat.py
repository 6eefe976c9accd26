"""Chat formatting with compiled templates.

A template is text with ``{{ expression }}``, ``{% for x in y %}``, ``{% if %}`` /
``{% elif %}`` / ``{% else %}`` and ``{% generation %}``, whose output is what a model
shall learn. Expressions know literals, names, ``a.b`` / ``a['b']`` (keys of mappings
only), ``==``, ``!=``, ``and``, ``or``, ``not``, ``~`` (join) and ``| filter``. There is
no way to call anything or to reach an attribute of a Python object.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import bounded_batches

DEFAULT_TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'assistant' %}### Assistant: {% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% elif m.role == 'user' %}### User: {{ m.text | escape }}"
    "{% elif m.role == 'system' %}### System: {{ m.text | escape }}"
    "{% else %}### ={{ m.role | escape }}: {{ m.text | escape }}{% endif %}"
    " </turn>\n"
    "{% endfor %}"
)
# A turn of the default template, read back.
_TURN = re.compile(r"### (?:(Assistant|User|System)|=((?:\\.|[^\\:])*)): ((?:\\.|[^\\<])*) </turn>\n", re.S)
_ROLES = {"Assistant": "assistant", "User": "user", "System": "system"}
_TOKEN = re.compile(r"\s*(?:('(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\")|(\d+)|(\w+)|(==|!=|[.\[\]()|~]))")

FORMATTED_SCHEMA = "conv_id long, formatted string, loss array<struct<start:int,end:int>>"
DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escape(text: str) -> str:
    r"""Put ``\`` before every character that a control string needs."""
    return re.sub(r"([\\#<:])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    """A template that does not follow the language."""


# Syntax trees are tuples: ("const", value), ("name", n), ("get", tree, key), ("eq"/"ne"/"and"/"or"/"join", a, b),
# ("not", a), ("filter", name, a); statements: ("out", tree), ("if", [(test, body)], otherwise), ("for", name, tree,
# body), ("generation", body).


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastindex, m[m.lastindex]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, token = self.tokens[self.at] if self.at < len(self.tokens) else (0, None)
        return token if kind in (3, 4) else None

    def next(self) -> tuple[int, str]:
        if self.at == len(self.tokens):
            raise TemplateError("expression ends early")
        self.at += 1
        return self.tokens[self.at - 1]

    def need(self, token: str) -> None:
        if self.next()[1] != token:
            raise TemplateError(f"{token!r} expected")

    def binary(self, level: int = 0) -> tuple:
        levels = [{"or": "or"}, {"and": "and"}, {"==": "eq", "!=": "ne"}, {"~": "join"}]
        if level == len(levels):
            return self.unary()
        left = self.binary(level + 1)
        while self.peek() in levels[level]:
            left = (levels[level][self.next()[1]], left, self.binary(level + 1))
        return left

    def unary(self) -> tuple:
        if self.peek() == "not":
            self.next()
            return ("not", self.unary())
        kind, token = self.next()
        if kind == 1:
            tree: tuple = ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), token[1:-1]))
        elif kind == 2:
            tree = ("const", int(token))
        elif token == "(":
            tree = self.binary()
            self.need(")")
        elif kind == 3:
            tree = ("const", {"true": True, "false": False, "none": None}[token]) if token in ("true", "false", "none") else ("name", token)
        else:
            raise TemplateError(f"unexpected {token!r}")
        while self.peek() in (".", "[", "|"):
            mark = self.next()[1]
            kind, token = self.next()
            if mark == "|":
                if token not in FILTERS:
                    raise TemplateError(f"no filter {token!r}")
                tree = ("filter", token, tree)
            elif mark == "." and kind == 3:
                tree = ("get", tree, token)
            elif mark == "[" and kind == 1:
                tree = ("get", tree, token[1:-1])
                self.need("]")
            else:
                raise TemplateError("only keys of mappings can be read")
        return tree

    def whole(self) -> tuple:
        tree = self.binary()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree


def parse(template: str) -> list[tuple]:
    """Syntax tree of a template."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", template, flags=re.S)
    at = 0

    def block(ends: tuple[str, ...]) -> tuple[list[tuple], str]:
        nonlocal at
        body: list[tuple] = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                body.append(("out", _Expression(part[2:-2]).whole()))
            elif part.startswith("{%"):
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    return body, f"{word} {rest}".strip()
                body.append(statement(word, rest))
            elif part:
                body.append(("out", ("const", part)))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return body, ""

    def statement(word: str, rest: str) -> tuple:
        if word == "generation":
            return ("generation", block(("endgeneration",))[0])
        if word == "for":
            m = re.fullmatch(r"(\w+)\s+in\s+(.+)", rest.strip(), re.S)
            if not m:
                raise TemplateError("for NAME in EXPRESSION expected")
            return ("for", m[1], _Expression(m[2]).whole(), block(("endfor",))[0])
        if word == "if":
            arms, test, otherwise = [], _Expression(rest).whole(), []
            while True:
                body, end = block(("elif", "else", "endif"))
                arms.append((test, body))
                if end.startswith("elif"):
                    test = _Expression(end[4:]).whole()
                    continue
                if end == "else":
                    otherwise = block(("endif",))[0]
                return ("if", arms, otherwise)
        raise TemplateError(f"unknown statement {word!r}")

    return block(())[0]


def _text(value: object) -> str:
    return "" if value is None else str(value)


_BINARY: dict[str, Callable] = {
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "join": lambda a, b: _text(a) + _text(b),
}


def fold(tree: tuple) -> tuple:
    """The expression with everything worked out that holds no name."""
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    parts = [fold(x) if isinstance(x, tuple) else x for x in tree[1:]]
    trees = [x for x in parts if isinstance(x, tuple)]
    if kind != "get" and all(x[0] == "const" for x in trees):
        values = [x[1] for x in trees]
        if kind == "not":
            return ("const", not values[0])
        if kind == "filter":
            return ("const", FILTERS[parts[0]](_text(values[0])))
        return ("const", _BINARY[kind](*values))
    return (kind, *parts)


def fold_body(body: list[tuple]) -> list[tuple]:
    """Statements with folded expressions; decided branches and neighbouring texts become one."""
    out: list[tuple] = []
    for s in body:
        if s[0] == "out":
            s = ("out", fold(s[1]))
            if s[1][0] == "const":
                text = _text(s[1][1])
                if out and out[-1][0] == "out" and out[-1][1][0] == "const":
                    text = out.pop()[1][1] + text
                s = ("out", ("const", text))
            out.append(s)
        elif s[0] == "if":
            arms, otherwise = [], fold_body(s[2])
            for test, inner in ((fold(t), fold_body(b)) for t, b in s[1]):
                if test[0] != "const":
                    arms.append((test, inner))
                elif test[1]:
                    otherwise = inner
                    break
            out += [("if", arms, otherwise)] if arms else otherwise
        elif s[0] == "for":
            out.append(("for", s[1], fold(s[2]), fold_body(s[3])))
        else:
            out.append(("generation", fold_body(s[1])))
    return out


def _value(tree: tuple) -> Callable[[dict], object]:
    """A closure that works an expression out from the names."""
    kind = tree[0]
    if kind == "const":
        return lambda names: tree[1]
    if kind == "name":
        return lambda names: names.get(tree[1])
    if kind == "get":
        of, key = _value(tree[1]), tree[2]

        def get(names: dict) -> object:
            value = of(names)
            return value.get(key) if isinstance(value, dict) else None

        return get
    if kind == "not":
        inner = _value(tree[1])
        return lambda names: not inner(names)
    if kind == "filter":
        use, inner = FILTERS[tree[1]], _value(tree[2])
        return lambda names: use(_text(inner(names)))
    a, b = _value(tree[1]), _value(tree[2])
    if kind == "and":
        return lambda names: a(names) and b(names)
    if kind == "or":
        return lambda names: a(names) or b(names)
    use = _BINARY[kind]
    return lambda names: use(a(names), b(names))


Piece = tuple[str, bool]


def _render(body: list[tuple], learn: bool) -> Callable[[dict, list[Piece]], None]:
    """A closure that appends (text, is generation) pieces."""
    steps = []
    for s in body:
        if s[0] == "out":
            value = _value(s[1])
            steps.append(lambda names, out, value=value: out.append((_text(value(names)), learn)))
        elif s[0] == "generation":
            steps.append(_render(s[1], True))
        elif s[0] == "for":
            items, inner = _value(s[2]), _render(s[3], learn)

            def loop(names: dict, out: list, name=s[1], items=items, inner=inner) -> None:
                for item in items(names) or ():
                    inner({**names, name: item}, out)

            steps.append(loop)
        else:
            arms = [(_value(t), _render(b, learn)) for t, b in s[1]]
            otherwise = _render(s[2], learn)

            def choose(names: dict, out: list, arms=arms, otherwise=otherwise) -> None:
                next((body for test, body in arms if test(names)), otherwise)(names, out)

            steps.append(choose)

    def run(names: dict, out: list[Piece]) -> None:
        for step in steps:
            step(names, out)

    return run


def _compiled(body: list[tuple]) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    run = _render(body, False)

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out: list[Piece] = []
        run({"messages": messages}, out)
        spans, at = [], 0
        for text, learn in out:
            if learn:
                spans.append((at, at + len(text)))
            at += len(text)
        return "".join(text for text, _ in out), spans

    return render


@lru_cache(maxsize=16)
def compile_template(template: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages to the formatted text and the spans to learn."""
    return _compiled(fold_body(parse(template)))


def split_loop(body: list[tuple]) -> tuple[list[tuple], list[tuple], list[tuple]]:
    """What stands before a template's loop over ``messages``, the loop, and what stands after it.

    Turns are rendered one by one, so nothing but that loop may speak of ``messages``.
    """

    def speaks(tree: object) -> bool:
        return tree == ("name", "messages") or isinstance(tree, (tuple, list)) and any(map(speaks, tree))

    at = [i for i, s in enumerate(body) if s[0] == "for" and s[2] == ("name", "messages")]
    if len(at) != 1:
        raise TemplateError("one loop over messages expected")
    parts = body[: at[0]], [body[at[0]]], body[at[0] + 1 :]
    if any(map(speaks, (parts[0], body[at[0]][3], parts[2]))):
        raise TemplateError("messages can be used in one loop only")
    return parts


@lru_cache(maxsize=16)
def compile_parts(template: str) -> tuple[Callable[[list[dict]], tuple[str, list[tuple[int, int]]]] | None, ...]:
    """As ``compile_template``, for what stands before the loop, a turn, and after it; None where there is nothing."""
    return tuple(_compiled(part) if part else None for part in split_loop(fold_body(parse(template))))


def format_conversations(rows: DataFrame, template: str = DEFAULT_TEMPLATE, part_chars: int = 1 << 20) -> DataFrame:
    """Formatted conversations in parts: conv_id, part, formatted, loss (spans of code points to learn).

    Input columns: conv_id, turn, role, text; others are ignored. Rows go by turn,
    ties by role and text, nulls first. Null roles and texts are empty. Rows with a
    null conv_id form a conversation of their own.

    A conversation is its parts one after another by ``part``, whose numbers rise and
    have gaps; spans count from the start of their part. A part holds whole turns and
    ends at ``part_chars`` or where a task ends: rows are dealt by range of conversation
    and turn, so that a conversation of any length is spread over tasks and none holds
    it whole. The template is one loop over ``messages``, with text before and after.
    """
    bounded_batches(rows.sparkSession)
    before, _, after = compile_parts(template)  # errors in the template show here
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.lit(1).alias("kind"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ends = [kind for kind, there in ((0, before), (2, after)) if there]
    if ends:
        kinds = F.explode(F.array(*map(F.lit, ends))).alias("kind")
        marks = turns.select("conv_id").distinct().select("conv_id", kinds)
        turns = turns.unionByName(marks, allowMissingColumns=True)
    # Where a range ends is told by the texts' first letters, in the order of the whole texts.
    ranges = ("conv_id", "kind", "turn", "role", F.substring("text", 1, 64))
    dealt = turns.repartitionByRange(*ranges).sortWithinPartitions("conv_id", "kind", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render, conv, texts, spans, at = compile_parts(template), None, [], [], 0
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

        def part() -> pa.RecordBatch:
            loss = [{"start": a, "end": b} for a, b in spans]
            columns = [pa.array([conv], pa.int64()), pa.array(["".join(texts)], pa.string()), pa.array([loss], kind)]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "formatted", "loss"])

        done: list[pa.RecordBatch] = []
        for batch in batches:
            for row in batch.to_pylist():
                if texts and (row["conv_id"] != conv or at >= part_chars):
                    done.append(part())
                    texts, spans, at = [], [], 0
                conv = row["conv_id"]
                text, learn = render[row["kind"]]([row] if row["kind"] == 1 else [])
                texts.append(text)
                spans += [(at + a, at + b) for a, b in learn]
                at += len(text)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                done = []
        if texts:
            yield part()

    return dealt.mapInArrow(run, FORMATTED_SCHEMA).select("conv_id", F.monotonically_increasing_id().alias("part"), "formatted", "loss")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of the default template's output."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        turns.append((_ROLES[m[1]] if m[1] else unescape(m[2]), unescape(m[3])))
        at = m.end()
    return turns


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them, part by part.

    A hash is of a whole conversation, so one task reads its parts, one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in DIGEST_SCHEMA.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        rows: list[tuple] = []
        open_: list | None = None

        def told() -> tuple:
            conv, n_turns, turns, n_loss, loss, n_chars = open_
            return conv, n_turns, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for conv, text, spans in zip(*(batch.column(c) for c in ("conv_id", "formatted", "loss"))):
                conv, text = conv.as_py(), text.as_py()
                if open_ is None or open_[0] != conv:
                    if open_ is not None:
                        rows.append(told())
                    open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_turns(text):
                    open_[1] += 1
                    open_[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for span in spans.as_py():
                    said = unescape(text[span["start"] : span["end"]])
                    open_[3] += len(said)
                    open_[4].update(said.encode("utf-8", "surrogatepass"))
                open_[5] += len(text)
            if rows:
                yield table()
                rows = []
        if open_ is not None:
            rows.append(told())
            yield table()

    parts = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return parts.mapInArrow(run, DIGEST_SCHEMA)
