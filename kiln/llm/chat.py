"""Chat formatting by a small template compiler.

The template language has text, ``{{ expression }}``, ``{% for x in expression %}``,
``{% if %}/{% elif %}/{% else %}`` and ``{% generation %}`` blocks. Expressions have
literals, names, fields (``turn.role``, ``turn['role']``), ``loop.first/last/index``,
``==  !=  in  not  and  or  +``, and filters (``x | escape``). There are no calls, no
attribute access on Python objects and no other names than the values passed in, so a
template cannot reach anything outside them.

A template is parsed into a syntax tree, constant parts are folded (literals joined,
branches with a constant test chosen, neighbouring text merged), and the tree becomes
nested Python closures. Rendering gives the text and the character spans that came out of
generation blocks: the loss mask.

``escape`` makes turn markers inside texts harmless and can be undone: a backslash is put
behind the first character of a marker, after those already there.

Defined results: null roles and texts are empty texts; turns are ordered by turn (null
first), then role, then text; a conversation's turns are rendered in one go, since they
make one training example; rows with a null conversation id form one conversation.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Strings that chat formats use to mark turns.
MARKERS = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
           "<<SYS>>", "<</SYS>>"]
_MARKED = re.compile("|".join(
    re.escape(m[0]) + r"(\\*)" + re.escape(m[1:]) for m in sorted(MARKERS, key=len, reverse=True)))

TEMPLATE = ("{% for turn in turns %}<|im_start|>{{ turn.role | line }}\n"
            "{% if turn.role == 'assistant' %}"
            "{% generation %}{{ turn.text | escape }}{% endgeneration %}"
            "{% else %}{{ turn.text | escape }}{% endif %}"
            "<|im_end|>\n{% endfor %}")


def escape(text: str) -> str:
    return _MARKED.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _MARKED.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


def one_line(text: str) -> str:
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def from_line(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "line": one_line, "trim": lambda s: s.strip(" \t\r\n"),
    "upper": str.upper, "lower": str.lower}


# --- syntax tree -------------------------------------------------------------------------

@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: object
    key: str


@dataclass(frozen=True)
class Op:
    kind: str
    args: tuple


@dataclass(frozen=True)
class Emit:
    expr: object


@dataclass(frozen=True)
class Loop:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Choice:
    branches: tuple  # (test, body) pairs; the last test is Const(True) for else


@dataclass(frozen=True)
class Generation:
    body: tuple


class TemplateError(ValueError):
    pass


_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<num>\d+)"
                    r"|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[|+.\[\]()]))")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over one expression's tokens."""

    def __init__(self, text: str):
        self.tokens, at, text = [], 0, text.strip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return (self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name")
                and self.tokens[self.at][1] in values)

    def take(self, kind: str | None = None, value: str | None = None) -> str:
        if self.at >= len(self.tokens):
            raise TemplateError("unexpected end of expression")
        k, v = self.tokens[self.at]
        if (kind and k != kind) or (value and v != value):
            raise TemplateError(f"unexpected {v!r}")
        self.at += 1
        return v

    def whole(self):
        out = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def either(self):
        out = self.both()
        while self.peek("or"):
            self.take()
            out = Op("or", (out, self.both()))
        return out

    def both(self):
        out = self.negation()
        while self.peek("and"):
            self.take()
            out = Op("and", (out, self.negation()))
        return out

    def negation(self):
        if self.peek("not"):
            self.take()
            return Op("not", (self.negation(),))
        out = self.sum()
        if self.peek("==", "!=", "in"):
            out = Op(self.take(), (out, self.sum()))
        return out

    def sum(self):
        out = self.filtered()
        while self.peek("+"):
            self.take()
            out = Op("+", (out, self.filtered()))
        return out

    def filtered(self):
        out = self.single()
        while self.peek("|"):
            self.take()
            name = self.take("name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            out = Op("|", (out, Const(name)))
        return out

    def single(self):
        if self.peek("("):
            self.take()
            out = self.either()
            self.take("op", ")")
        else:
            kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, "")
            self.take()
            if kind == "str":
                out = Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1]))
            elif kind == "num":
                out = Const(int(value))
            elif kind == "name":
                out = {"true": Const(True), "false": Const(False)}.get(value, Name(value))
            else:
                raise TemplateError(f"unexpected {value!r}")
        while self.peek(".", "["):
            if self.take() == ".":
                out = Field(out, self.take("name"))
            else:
                key = self.take("str")
                out = Field(out, key[1:-1])
                self.take("op", "]")
        return out


def parse(template: str) -> tuple:
    """The syntax tree of a template."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", template, flags=re.S)
    at = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        body: list = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                body.append(Emit(_Expression(part[2:-2]).whole()))
            elif part.startswith("{%"):
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    return tuple(body), f"{word} {rest}".strip()
                body.append(statement(word, rest.strip()))
            elif part:
                body.append(Emit(Const(part)))
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(body), ""

    def statement(word: str, rest: str):
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, flags=re.S)
            if not m:
                raise TemplateError(f"cannot read for {rest!r}")
            return Loop(m[1], _Expression(m[2]).whole(), block("endfor")[0])
        if word == "generation":
            return Generation(block("endgeneration")[0])
        if word == "if":
            branches, test = [], _Expression(rest).whole()
            while True:
                body, end = block("elif", "else", "endif")
                branches.append((test, body))
                if end == "endif":
                    return Choice(tuple(branches))
                test = Const(True) if end == "else" else _Expression(end[5:]).whole()
        raise TemplateError(f"no statement {word!r}")

    return block()[0]


# --- constant folding --------------------------------------------------------------------

def _apply(kind: str, values: list):
    if kind == "+":
        return values[0] + values[1] if all(isinstance(v, int) for v in values) \
            else _text(values[0]) + _text(values[1])
    if kind == "|":
        return FILTERS[values[1]](_text(values[0]))
    return {"==": lambda a, b: a == b, "!=": lambda a, b: a != b,
            "in": lambda a, b: _text(a) in (b if isinstance(b, (list, tuple)) else _text(b)),
            "and": lambda a, b: a and b, "or": lambda a, b: a or b,
            "not": lambda a: not a}[kind](*values)


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _fold_expr(e):
    if isinstance(e, Op):
        args = tuple(_fold_expr(a) for a in e.args)
        if all(isinstance(a, Const) for a in args):
            return Const(_apply(e.kind, [a.value for a in args]))
        return Op(e.kind, args)
    return Field(_fold_expr(e.of), e.key) if isinstance(e, Field) else e


def fold(body: tuple) -> tuple:
    """The tree without what is known beforehand."""
    out: list = []

    def put(node) -> None:
        if (isinstance(node, Emit) and isinstance(node.expr, Const)):
            text = _text(node.expr.value)
            if out and isinstance(out[-1], Emit) and isinstance(out[-1].expr, Const):
                out[-1] = Emit(Const(out[-1].expr.value + text))
            elif text:
                out.append(Emit(Const(text)))
        else:
            out.append(node)

    for node in body:
        if isinstance(node, Emit):
            put(Emit(_fold_expr(node.expr)))
        elif isinstance(node, Loop):
            put(Loop(node.name, _fold_expr(node.over), fold(node.body)))
        elif isinstance(node, Generation):
            put(Generation(fold(node.body)))
        else:
            branches = []
            for test, inner in node.branches:
                test = _fold_expr(test)
                if isinstance(test, Const) and not test.value:
                    continue
                branches.append((test, fold(inner)))
                if isinstance(test, Const):
                    break
            if branches and isinstance(branches[0][0], Const):
                for inner in branches[0][1]:
                    put(inner)
            elif branches:
                put(Choice(tuple(branches)))
    return tuple(out)


# --- closures ----------------------------------------------------------------------------

class _Output:
    def __init__(self):
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _value(e) -> Callable[[dict], object]:
    if isinstance(e, Const):
        value = e.value
        return lambda env: value
    if isinstance(e, Name):
        name = e.name

        def look_up(env):
            if name not in env:
                raise TemplateError(f"no value {name!r}")
            return env[name]
        return look_up
    if isinstance(e, Field):
        of, key = _value(e.of), e.key

        def field(env):
            value = of(env)
            if not isinstance(value, dict):  # mappings only: the sandbox
                raise TemplateError(f"no field {key!r}")
            return value.get(key)
        return field
    kind, args = e.kind, [_value(a) for a in e.args]
    if kind == "and":
        return lambda env: args[0](env) and args[1](env)
    if kind == "or":
        return lambda env: args[0](env) or args[1](env)
    if kind == "|":
        one, of = FILTERS[e.args[1].value], args[0]
        return lambda env: one(_text(of(env)))
    return lambda env: _apply(kind, [a(env) for a in args])


def _closure(body: tuple) -> Callable[[dict, _Output], None]:
    steps = [_step(node) for node in body]

    def run(env: dict, out: _Output) -> None:
        for step in steps:
            step(env, out)
    return run


def _step(node) -> Callable[[dict, _Output], None]:
    if isinstance(node, Emit):
        if isinstance(node.expr, Const):
            text = node.expr.value
            return lambda env, out: out.write(text)
        value = _value(node.expr)
        return lambda env, out: out.write(_text(value(env)))
    if isinstance(node, Generation):
        inner = _closure(node.body)

        def generation(env, out):
            start = out.length
            inner(env, out)
            out.spans.append((start, out.length))
        return generation
    if isinstance(node, Loop):
        over, inner, name = _value(node.over), _closure(node.body), node.name

        def loop(env, out):
            items = over(env) or []
            for i, item in enumerate(items):
                inner({**env, name: item, "loop": {"index": i + 1, "index0": i, "first": i == 0,
                                                   "last": i == len(items) - 1}}, out)
        return loop
    branches = [(_value(test), _closure(inner)) for test, inner in node.branches]

    def choice(env, out):
        for test, inner in branches:
            if test(env):
                return inner(env, out)
    return choice


def compile_template(template: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from values to (text, generation spans)."""
    run = _closure(fold(parse(template)))

    def render(values: dict) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        run(values, out)
        return "".join(out.parts), out.spans
    return render


def read_back(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a text that the standard template made."""
    start, end, turns, at = "<|im_start|>", "<|im_end|>\n", [], 0
    while at < len(text):
        if not text.startswith(start, at):
            raise ValueError(f"no turn starts at {at}")
        line = text.index("\n", at)
        stop = text.index(end, line)
        turns.append((from_line(text[at + len(start):line]), unescape(text[line + 1:stop])))
        at = stop + len(end)
    return turns


def format_conversations(turns: DataFrame, template: str = TEMPLATE, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """``conv_id, formatted, spans`` for every conversation; spans hold (start, end)."""
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    grouped = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def render_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        for batch in batches:
            texts, spans = [], []
            for items in batch.column("turns"):
                text, marked = render({"turns": items.as_py()})
                texts.append(text)
                spans.append([{"start": a, "end": b} for a, b in marked])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(texts, pa.string()), pa.array(spans, kind)],
                ["conv_id", "formatted", "spans"])

    return grouped.mapInArrow(
        render_all, "conv_id long, formatted string, spans array<struct<start: long, end: long>>")
