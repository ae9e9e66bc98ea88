"""Chat formatting by compiled templates.

A template is parsed into a syntax tree, constants are folded, and the tree becomes Python closures. The language is a
sandbox: text, ``{{ value }}``, ``{% for m in messages %}``, ``{% if %} / {% else %}``, and ``{% generation %}`` around
what a model is trained to produce; values are string constants, ``m.role``, ``m.text``, ``+``, ``==`` and ``!=``.
There are no calls, indexes or other names. Values are escaped on output: a backslash more goes into each control string,
so that a text never holds one and unescaping gives it back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronolith.llm.text import keep, map_in_arrow

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
#: Control strings of this template and of common others; none may appear inside a text.
CONTROL = (TURN, SAYS, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|eot_id|>")
TEMPLATE = (
    "{% for m in messages %}" + TURN + "{{ m.role }}" + SAYS + "{% if m.role == 'assistant' %}{% generation %}{{ m.text }}{% endgeneration %}{% else %}{{ m.text }}{% endif %}" + END + "\n{% endfor %}"
)
#: Characters of formatted text after which a conversation goes on in a further row of the output.
PIECE = 1 << 20

_MARK = re.compile(r"([<\[])(\\*)(?=" + "|".join(sorted({re.escape(c[1:]) for c in CONTROL})) + ")")
_MARKED = re.compile(r"([<\[])\\(\\*)(?=" + "|".join(sorted({re.escape(c[1:]) for c in CONTROL})) + ")")
_TURNS = re.compile(re.escape(TURN) + "(.*?)" + re.escape(SAYS) + "(.*?)" + re.escape(END) + "\n", re.S)
_TOKEN = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_WORD = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*(?:\.[A-Za-z_]\w*)?)|(==|!=|\+))")

Emit = Callable[[str, bool], None]
Value = Callable[[dict], str]


def escape(text: str) -> str:
    return _MARK.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"\1\2", text)


def _value(source: str, scope: frozenset[str]) -> tuple:
    """Tree of ``a``, ``a + b``, ``a == b`` or ``a != b``; constants are folded."""
    words, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _WORD.match(source, at)
        if not m:
            raise ValueError(f"not allowed in a template: {source[at:].strip()!r}")
        words.append(m)
        at = m.end()
    if len(words) % 2 == 0:
        raise ValueError(f"a value is missing: {source!r}")

    def leaf(m: re.Match[str]) -> tuple:
        if m[1]:
            return "const", re.sub(r"\\(.)", r"\1", m[1][1:-1])
        name, _, field = (m[2] or "").partition(".")
        if name not in scope or field not in ("role", "text"):
            raise ValueError(f"not allowed in a template: {m[0].strip()!r}")
        return "field", field

    terms, operators = [leaf(words[0])], []
    for op, word in zip(words[1::2], words[2::2], strict=True):
        if not op[3]:
            raise ValueError(f"an operator is missing: {source!r}")
        if op[3] == "+":
            last, new = terms[-1], leaf(word)
            terms[-1] = ("const", last[1] + new[1]) if last[0] == new[0] == "const" else ("add", last, new)
        else:
            operators.append(op[3])
            terms.append(leaf(word))
    if len(terms) > 2:
        raise ValueError(f"more than one comparison: {source!r}")
    if len(terms) == 1:
        return terms[0]
    if terms[0][0] == terms[1][0] == "const":
        return "const", (terms[0][1] == terms[1][1]) == (operators[0] == "==")
    return "same" if operators[0] == "==" else "differ", terms[0], terms[1]


def parse(template: str) -> list[tuple]:
    """Syntax tree of a template. ValueError if it steps outside the language."""
    tokens: list[tuple[str, str]] = []
    at = 0
    for m in _TOKEN.finditer(template):
        tokens += [("text", template[at : m.start()])] * (m.start() > at)
        tokens.append(("value", m[1]) if m[1] is not None else ("tag", " ".join(m[2].split())))
        at = m.end()
    tokens += [("text", template[at:])] * (at < len(template))
    tokens.reverse()

    def block(ends: tuple[str, ...], scope: frozenset[str], deep: int) -> tuple[list[tuple], str]:
        if deep > 50:
            raise ValueError("too deeply nested")
        out: list[tuple] = []
        while tokens:
            kind, body = tokens.pop()
            if kind == "text":
                out.append(("text", body))
            elif kind == "value":
                tree = _value(body, scope)
                out.append(("text", escape(tree[1])) if tree[0] == "const" and isinstance(tree[1], str) else ("out", tree))
            elif body in ends:
                return out, body
            elif m := re.fullmatch(r"for ([A-Za-z_]\w*) in messages", body):
                if scope:
                    raise ValueError("only one loop at a time")
                out.append(("for", block(("endfor",), frozenset({m[1]}), deep + 1)[0]))
            elif body.startswith("if "):
                test = _value(body[3:], scope)
                yes, end = block(("else", "endif"), scope, deep + 1)
                no = block(("endif",), scope, deep + 1)[0] if end == "else" else []
                out += (yes if test[1] else no) if test[0] == "const" else [("if", test, yes, no)]
            elif body == "generation":
                out.append(("generation", block(("endgeneration",), scope, deep + 1)[0]))
            else:
                raise ValueError(f"not allowed in a template: {body!r}")
        if ends:
            raise ValueError(f"{ends[-1]} is missing")
        return out, ""

    return _joined(block((), frozenset(), 0)[0])


def _joined(nodes: list[tuple]) -> list[tuple]:
    """Neighbouring texts become one."""
    out: list[tuple] = []
    for node in nodes:
        node = tuple(_joined(x) if isinstance(x, list) else x for x in node)
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        else:
            out.append(node)
    return out


def _compiled_value(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        return lambda m, v=tree[1]: v
    if kind == "field":
        return lambda m, f=tree[1]: m[f]
    a, b = _compiled_value(tree[1]), _compiled_value(tree[2])
    return {"add": lambda m: a(m) + b(m), "same": lambda m: a(m) == b(m), "differ": lambda m: a(m) != b(m)}[kind]


def compiled(template: str) -> Callable[[Iterable[dict], Emit], Iterator[None]]:
    """Closure that renders messages to ``emit(text, masked)`` and yields after each turn of the loop, so that conversations stream."""

    def block(nodes: list[tuple], masked: bool) -> Callable[[dict, Emit], None]:
        steps = [one(n, masked) for n in nodes]

        def run(m: dict, emit: Emit) -> None:
            for s in steps:
                s(m, emit)

        return steps[0] if len(steps) == 1 else run

    def one(node: tuple, masked: bool) -> Callable[[dict, Emit], None]:
        if node[0] == "text":
            return lambda m, emit, t=node[1]: emit(t, masked)
        if node[0] == "out":
            value = _compiled_value(node[1])
            return lambda m, emit: emit(escape(str(value(m))), masked)
        if node[0] == "generation":
            return block(node[1], True)
        test, yes, no = _compiled_value(node[1]), block(node[2], masked), block(node[3], masked)
        return lambda m, emit: (yes if test(m) else no)(m, emit)

    top = [("for", block(n[1], False)) if n[0] == "for" else ("once", one(n, False)) for n in parse(template)]

    def render(messages: Iterable[dict], emit: Emit) -> Iterator[None]:
        for kind, run in top:
            for m in messages if kind == "for" else ({},):
                run(m, emit)
                yield

    return render


def _groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, Iterator[dict]]]:
    """Rows of each key, as they stream in; rows are sorted by key."""
    rows = (r for batch in batches for i in range(0, batch.num_rows, 256) for r in batch.slice(i, 256).to_pylist())
    row = next(rows, None)

    def own(k: object) -> Iterator[dict]:
        nonlocal row
        while row is not None and row[key] == k:
            yield row
            row = next(rows, None)

    while row is not None:
        group = own(k := row[key])
        yield k, group
        for _ in group:
            pass


def formatted(conversations: DataFrame, template: str = TEMPLATE, piece: int = PIECE) -> DataFrame:
    """conv_id, piece, formatted, loss_starts, loss_ends (code points in the piece) for ``conversations`` (conv_id, turn, role, text).

    A conversation's rows are sorted by turn (null first), then role and text, and streamed: it is never held as a
    whole, and goes on in a further piece after ``piece`` characters. Null role or text: empty. Rows without conv_id form one
    conversation. Repeated rows are turns of their own. Further columns are not read; an empty table gives no rows.
    """
    parse(template)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template)
        types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["conv_id", "piece", "formatted", "loss_starts", "loss_ends"])

        done: list[tuple] = []
        held = 0
        for conv_id, rows in _groups(batches, "conv_id"):
            texts: list[str] = []
            starts: list[int] = []
            ends: list[int] = []
            size = number = 0

            def emit(text: str, masked: bool) -> None:
                nonlocal size
                if masked:
                    starts.append(size)
                    ends.append(size + len(text))
                texts.append(text)
                size += len(text)

            messages = ({"role": r["role"] or "", "text": r["text"] or ""} for r in rows)
            for _ in render(messages, emit):
                if size >= piece:
                    yield batch([(conv_id, number, "".join(texts), starts, ends)])
                    texts, starts, ends, size, number = [], [], [], 0, number + 1
            if texts or not number:
                done.append((conv_id, number, "".join(texts), starts, ends))
                held += size
            if held >= piece:
                yield batch(done)
                done, held = [], 0
        if done:
            yield batch(done)

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return map_in_arrow(ordered, run, "conv_id long, piece long, formatted string, loss_starts array<long>, loss_ends array<long>")


def read_back(output: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from rows that ``formatted`` made with ``TEMPLATE``."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conv_id, rows in _groups(batches, "conv_id"):
            turns, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for r in rows:
                text = r["formatted"]
                size += len(text)
                for m in _TURNS.finditer(text):
                    turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                    n += 1
                for a, b in zip(r["loss_starts"], r["loss_ends"], strict=True):
                    part = unescape(text[a:b])
                    loss.update(part.encode())
                    chars += len(part)
            out.append((conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), size))
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    ordered = output.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return map_in_arrow(ordered, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def written(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``formatted`` rows as written to the shared folder."""
    return keep(formatted(conversations, template), "chat")
