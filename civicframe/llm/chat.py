"""Chat formatting by a small template language, compiled to closures.

Templates have text, ``{{ expression }}``, ``{% for x in items %}``, ``{% if %}``/``{% elif %}``/``{% else %}`` and
``{% generation %}`` blocks, whose output is what a model is trained on. Expressions have names, fields (``m.role``),
string and number literals, ``+``, ``==``, ``!=``, ``and``, ``or``, ``not``, brackets and the filters ``escape``,
``escape_line``, ``trim``, ``upper`` and ``lower``; inside a loop, ``loop.first`` and ``loop.index0``. There are no calls, imports,
subscripts or attributes of Python objects: a field is a key of a mapping, and nothing else can be reached.

A template becomes a syntax tree, whose constant parts are folded, and then closures that yield pieces of text, each
with a mark whether it was generated. Pieces come as the items come, so a conversation need not be held whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for m in messages %}{{ '<|im_start|>' + (m.role | escape_line) + '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "{{ '<|im_end|>' + '\\n' }}{% endfor %}"
)


def escape(text: str) -> str:
    """Make control strings in ``text`` plain text: no ``<|`` is left, and :func:`unescape` restores all."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    """The text that :func:`escape` was given."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def escape_line(text: str) -> str:
    """Like :func:`escape`, for a text that must stay on one line."""
    return escape(text).replace("\n", "\\n")


def unescape_line(text: str) -> str:
    """The text that :func:`escape_line` was given."""
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "escape_line": escape_line, "trim": str.strip, "upper": str.upper, "lower": str.lower}

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|[+|().]))")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    """A template that is not of the language."""


def tokens(source: str) -> list[tuple[str, str]]:
    """Kind and text of each token of an expression."""
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if m is None:
            raise TemplateError(f"unexpected {source[at:].strip()[:20]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class Expression:
    """Parses one expression into a tree of tuples."""

    LEVELS = (("or",), ("and",), ("==", "!="), ("+",))

    def __init__(self, source: str) -> None:
        self.rest = tokens(source)
        self.tree = self.level(0)
        if self.rest:
            raise TemplateError(f"unexpected {self.rest[0][1]!r}")

    def take(self, *texts: str) -> str | None:
        if self.rest and self.rest[0][1] in texts and self.rest[0][0] != "text":
            return self.rest.pop(0)[1]
        return None

    def level(self, k: int) -> tuple:
        if k == len(self.LEVELS):
            return self.unary()
        left = self.level(k + 1)
        while (sign := self.take(*self.LEVELS[k])) is not None:
            left = (sign, left, self.level(k + 1))
        return left

    def unary(self) -> tuple:
        if self.take("not"):
            return ("not", self.unary())
        value = self.primary()
        while (sign := self.take(".", "|")) is not None:
            if not self.rest or self.rest[0][0] != "name":
                raise TemplateError(f"a name must follow {sign!r}")
            name = self.rest.pop(0)[1]
            if sign == "|" and name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = ("filter" if sign == "|" else "field", value, name)
        return value

    def primary(self) -> tuple:
        if not self.rest:
            raise TemplateError("an expression ends early")
        kind, text = self.rest.pop(0)
        if kind == "text":
            return ("constant", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "number":
            return ("constant", int(text))
        if kind == "name":
            return ("name", text)
        if text == "(":
            value = self.level(0)
            if not self.take(")"):
                raise TemplateError("a bracket is not closed")
            return value
        raise TemplateError(f"unexpected {text!r}")


def parse(template: str) -> list[tuple]:
    """The syntax tree of a template: a list of statements."""
    pieces: list[tuple[str, str]] = []
    at = 0
    for m in _TAG.finditer(template):
        if m.start() > at:
            pieces.append(("text", template[at : m.start()]))
        pieces.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(template):
        pieces.append(("text", template[at:]))

    def body(*ends: str) -> tuple[list[tuple], str]:
        out: list[tuple] = []
        while pieces:
            kind, text = pieces.pop(0)
            word, _, rest = text.partition(" ") if kind == "tag" else ("", "", "")
            if kind == "text":
                out.append(("put", ("constant", text)))
            elif kind == "out":
                out.append(("put", Expression(text).tree))
            elif word in ends:
                return out, text
            elif word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                if not m:
                    raise TemplateError(f"not a loop: {text!r}")
                inner, _ = body("endfor")
                out.append(("for", m[1], Expression(m[2]).tree, inner))
            elif word == "if":
                branches, end = [], text
                while end.partition(" ")[0] in ("if", "elif"):
                    inner, nxt = body("elif", "else", "endif")
                    branches.append((Expression(end.partition(" ")[2]).tree, inner))
                    end = nxt
                other, _ = body("endif") if end == "else" else ([], "")
                out.append(("if", branches, other))
            elif word == "generation":
                inner, _ = body("endgeneration")
                out.append(("generation", inner))
            else:
                raise TemplateError(f"unexpected tag {text!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return out, ""

    return body()[0]


def _value(tree: tuple) -> object:
    kind, *rest = tree
    if kind == "+":
        a, b = rest
        return a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b)
    if kind in ("==", "!="):
        return (rest[0] == rest[1]) == (kind == "==")
    if kind == "filter":
        return FILTERS[rest[1]](_text(rest[0]))
    return not rest[0]


def _text(value: object) -> str:
    return "" if value is None else str(value)


def folded(tree: tuple) -> tuple:
    """An expression with its constant parts computed; ``(x + 'a') + 'b'`` becomes ``x + 'ab'``."""
    kind, *rest = tree
    if kind in ("constant", "name"):
        return tree
    if kind == "filter":
        inner = folded(rest[0])
        return ("constant", _value(("filter", inner[1], rest[1]))) if inner[0] == "constant" else ("filter", inner, rest[1])
    if kind == "field":
        return ("field", folded(rest[0]), rest[1])
    parts = [folded(x) for x in rest]
    if kind in ("and", "or"):
        if parts[0][0] == "constant":
            return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
        return (kind, *parts)
    if all(p[0] == "constant" for p in parts):
        return ("constant", _value((kind, *(p[1] for p in parts))))
    if kind == "+" and parts[1][0] == "constant" and parts[0][0] == "+" and parts[0][2][0] == "constant" and isinstance(parts[1][1], str) and isinstance(parts[0][2][1], str):
        return ("+", parts[0][1], ("constant", parts[0][2][1] + parts[1][1]))
    return (kind, *parts)


def fold(statements: list[tuple]) -> list[tuple]:
    """Statements with constants folded: dead branches go and neighbouring constant texts become one."""
    out: list[tuple] = []

    def put(tree: tuple) -> None:
        if tree[0] == "constant" and out and out[-1][0] == "put" and out[-1][1][0] == "constant":
            out[-1] = ("put", ("constant", _text(out[-1][1][1]) + _text(tree[1])))
        elif tree != ("constant", ""):
            out.append(("put", tree))

    for kind, *rest in statements:
        if kind == "put":
            put(folded(rest[0]))
        elif kind == "for":
            out.append(("for", rest[0], folded(rest[1]), fold(rest[2])))
        elif kind == "generation":
            out.append(("generation", fold(rest[0])))
        else:
            branches, other = [], fold(rest[1])
            for test, inner in rest[0]:
                test = folded(test)
                if test[0] == "constant":
                    if test[1]:
                        other = fold(inner)
                        break
                    continue
                branches.append((test, fold(inner)))
            if branches:
                out.append(("if", branches, other))
            else:
                for x in other:
                    put(x[1]) if x[0] == "put" else out.append(x)
    return out


Names = Mapping[str, object]


def compiled_expression(tree: tuple) -> Callable[[Names], object]:
    """A closure that computes an expression."""
    kind, *rest = tree
    if kind == "constant":
        return lambda names, value=rest[0]: value
    if kind == "name":
        return lambda names, name=rest[0]: names.get(name)
    inner = compiled_expression(rest[0])
    if kind == "field":

        def field(names: Names, name: str = rest[1]) -> object:
            value = inner(names)
            return value.get(name) if isinstance(value, Mapping) else None

        return field
    if kind == "filter":
        return lambda names, f=FILTERS[rest[1]]: f(_text(inner(names)))
    if kind == "not":
        return lambda names: not inner(names)
    other = compiled_expression(rest[1])
    if kind == "and":
        return lambda names: inner(names) and other(names)
    if kind == "or":
        return lambda names: inner(names) or other(names)
    return lambda names: _value((kind, inner(names), other(names)))


def compiled(statements: list[tuple]) -> Callable[[Names, bool], Iterator[tuple[str, bool]]]:
    """A closure that yields the pieces of text of statements, with their marks."""
    steps = [_step(x) for x in statements]

    def run(names: Names, mark: bool) -> Iterator[tuple[str, bool]]:
        for step in steps:
            yield from step(names, mark)

    return run


def _step(statement: tuple) -> Callable[[Names, bool], Iterator[tuple[str, bool]]]:
    kind, *rest = statement
    if kind == "put":
        value = compiled_expression(rest[0])
        return lambda names, mark: ((_text(value(names)), mark),)
    if kind == "generation":
        inner = compiled(rest[0])
        return lambda names, mark: inner(names, True)
    if kind == "if":
        branches = [(compiled_expression(test), compiled(inner)) for test, inner in rest[0]]
        other = compiled(rest[1])

        def choose(names: Names, mark: bool) -> Iterator[tuple[str, bool]]:
            return next((inner for test, inner in branches if test(names)), other)(names, mark)

        return choose
    name, items, inner = rest[0], compiled_expression(rest[1]), compiled(rest[2])

    def loop(names: Names, mark: bool) -> Iterator[tuple[str, bool]]:
        for i, item in enumerate(items(names) or ()):
            yield from inner({**names, name: item, "loop": {"index0": i, "first": i == 0}}, mark)

    return loop


def compile_template(template: str) -> Callable[[Iterable[Mapping]], Iterator[tuple[str, bool]]]:
    """A function from messages to pieces of text, each with whether it is generated."""
    run = compiled(fold(parse(template)))
    return lambda messages: run({"messages": messages}, False)


OUTPUT = "conv_id long, part long, last boolean, text string, spans array<struct<start: long, end: long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_conversations(turns: DataFrame, *, template: str = TEMPLATE, part_chars: int = 1 << 22) -> DataFrame:
    """Format each conversation (rows conv_id, turn, role, text, in the order of turn) by ``template``.

    Returns the texts in parts of about ``part_chars`` code points, cut between pieces, with the spans (in code points of the
    part) that the loss covers; rows of a conversation follow one another in their task. A conversation is one text,
    so one task writes it, but it streams: memory is bounded by the part, not by the conversation. Null roles and
    texts are empty, null turns come first, turns with equal numbers are ordered by role and text, and rows with a
    null conv_id are one conversation. Other columns are ignored; an empty table gives no rows.
    """
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fill = compile_template(template)
        stream = (r for b in batches for i in range(0, b.num_rows, 256) for r in zip(*(c.to_pylist() for c in (b.slice(i, 256).column(k) for k in (0, 2, 3))), strict=True))
        ahead = next(stream, None)
        done: list[tuple] = []
        held = 0
        while ahead is not None:
            conv = ahead[0]

            def messages() -> Iterator[dict]:
                nonlocal ahead
                while ahead is not None and ahead[0] == conv:
                    yield {"role": ahead[1], "text": ahead[2]}
                    ahead = next(stream, None)

            part, pieces, size, spans = 0, [], 0, []
            for text, mark in fill(messages()):
                if mark and text:
                    if spans and spans[-1]["end"] == size:
                        spans[-1]["end"] = size + len(text)
                    else:
                        spans.append({"start": size, "end": size + len(text)})
                pieces.append(text)
                size += len(text)
                if size >= part_chars:
                    yield _batch([(conv, part, False, "".join(pieces), spans)])
                    part, pieces, size, spans = part + 1, [], 0, []
            for _ in messages():  # what a template leaves of its messages
                pass
            done.append((conv, part, True, "".join(pieces), spans))
            held += size
            if held >= part_chars or len(done) >= 1024 or part:
                yield _batch(done)
                done, held = [], 0
        if done:
            yield _batch(done)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(render, OUTPUT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.string(), _SPANS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["conv_id", "part", "last", "text", "spans"])



class Reader:
    """Reads turns back from formatted text that comes in parts, and keeps digests only."""

    def __init__(self) -> None:
        self.turns, self.chars, self.loss_chars, self.rest = 0, 0, 0, ""
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, spans: list[dict]) -> None:
        """Take a part; its spans cover whole pieces, so they can be unescaped one by one."""
        self.chars += len(text)
        for s in spans:
            plain = unescape(text[s["start"] : s["end"]])
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        self.rest += text
        at = 0
        while (end := self.rest.find(END + "\n", at)) >= 0:
            head, _, body = self.rest[at + len(START) : end].partition("\n")
            if not self.rest.startswith(START, at):
                raise ValueError("a turn does not begin with its mark")
            self.turns += 1
            self.all.update(f"{unescape_line(head)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
            at = end + len(END) + 1
        self.rest = self.rest[at:]


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, read from the output of the default template.

    The parts of a conversation are put in order by their numbers, so ``formatted`` may have been written and read
    again in any way. Texts that are not whole turns are refused. An empty table gives no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                reader.feed(row["text"], row["spans"])
                if row["last"]:
                    if reader.rest:
                        raise ValueError(f"conversation {row['conv_id']} does not end with a whole turn")
                    out.append((row["conv_id"], reader.turns, reader.all.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars))
                    reader = Reader()
            if out:
                names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    parts = formatted.select("conv_id", "part", "last", "text", "spans").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return parts.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
