"""A small sandboxed template language for conversations, compiled to closures.

    text                      copied
    {{ expression }}          its value
    {% for x in messages %} ... {% endfor %}
    {% if expression %} ... {% elif expression %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}     marks what a model is to learn

Expressions: string and integer literals, names, ``name.field``, ``|filter``,
``+ == != and or not in`` and parentheses.  Names are the loop variable and
``loop`` (index, first, last); fields are dictionary keys and filters come from
a fixed table, so a template can reach nothing of Python.

A template is parsed into a syntax tree, constant parts are folded (literal
arithmetic and comparisons, branches that are never taken, neighbouring
texts), and each node becomes a Python closure.  A ``for`` over the messages
hands on its output after each message, so conversations of any length are
rendered in bounded memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

#: Strings with a meaning in formatted conversations (fixed values); in texts they are escaped.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """Backslashes doubled, and one put behind the first character of every control string: none is left."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""
    return _ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    """The template can't be compiled."""


# --- syntax tree ---------------------------------------------------------------


@dataclass(frozen=True)
class Literal:
    value: object


@dataclass(frozen=True)
class Name:
    name: str
    key: str | None = None


@dataclass(frozen=True)
class Filtered:
    of: object
    name: str


@dataclass(frozen=True)
class Operation:
    sign: str
    of: tuple


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Output:
    of: object


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body); a condition is an expression


@dataclass(frozen=True)
class For:
    name: str
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- parsing -------------------------------------------------------------------

_PARTS = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}", re.DOTALL)
_TOKENS = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[+|().]))""")
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}


def _tokens(source: str) -> list[tuple[str, object]]:
    out, at = [], 0
    while source[at:].strip():
        m = _TOKENS.match(source, at)
        if not m:
            raise TemplateError(f"unexpected {source[at:].strip()[:20]!r}")
        if m[1] is not None:
            out.append(("literal", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[0]), m[1][1:-1], flags=re.DOTALL)))
        elif m[2] is not None:
            out.append(("literal", int(m[2])))
        else:
            out.append(("name", m[3]) if m[3] is not None else ("sign", m[4]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, tokens: list[tuple[str, object]]):
        self.tokens, self.at = tokens, 0

    def parse(self) -> object:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "literal" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def either(self) -> object:
        node = self.both()
        while self.take("or"):
            node = Operation("or", (node, self.both()))
        return node

    def both(self) -> object:
        node = self.negated()
        while self.take("and"):
            node = Operation("and", (node, self.negated()))
        return node

    def negated(self) -> object:
        return Operation("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> object:
        node = self.added()
        if sign := self.take("==", "!=", "in"):
            node = Operation(sign, (node, self.added()))
        return node

    def added(self) -> object:
        node = self.filtered()
        while self.take("+"):
            node = Operation("+", (node, self.filtered()))
        return node

    def filtered(self) -> object:
        node = self.atom()
        while self.take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = Filtered(node, name)
        return node

    def atom(self) -> object:
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket isn't closed")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "literal":
            return Literal(value)
        if kind == "name":
            if value in ("true", "false"):
                return Literal(value == "true")
            if self.take("."):
                kind, key = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
                if kind != "name":
                    raise TemplateError("a field's name is missing")
                self.at += 1
                return Name(value, key)
            return Name(value)
        raise TemplateError(f"unexpected {value!r}")


@dataclass
class _Block:
    kind: str
    head: object = None
    body: list = field(default_factory=list)
    branches: list = field(default_factory=list)


def parse(source: str) -> tuple:
    """The template's syntax tree."""
    stack, at, strip = [_Block("template")], 0, False

    def text(value: str, before_tag: str) -> None:
        value = value.lstrip() if strip else value
        value = value.rstrip() if before_tag else value
        if value:
            stack[-1].body.append(Text(value))

    for m in _PARTS.finditer(source):
        text(source[at : m.start()], m[1] or m[4] or "")
        at, strip = m.end(), bool(m[3] or m[6])
        if m[2] is not None:
            stack[-1].body.append(Output(_Expression(_tokens(m[2])).parse()))
            continue
        word, _, rest = m[5].strip().partition(" ")
        top = stack[-1]
        if word == "for":
            parts = rest.split()
            if len(parts) != 3 or parts[1:] != ["in", "messages"] or not parts[0].isidentifier():
                raise TemplateError("only 'for <name> in messages' is known")
            if len(stack) > 1:
                raise TemplateError("the loop over messages stands at the top only")
            stack.append(_Block("for", parts[0]))
        elif word == "if":
            stack.append(_Block("if", _Expression(_tokens(rest)).parse()))
        elif word in ("elif", "else") and top.kind == "if":
            top.branches.append((top.head, tuple(top.body)))
            top.head, top.body = (Literal(True) if word == "else" else _Expression(_tokens(rest)).parse()), []
        elif word == "generation":
            if any(b.kind == "generation" for b in stack):
                raise TemplateError("generation marks don't nest")
            stack.append(_Block("generation"))
        elif word.startswith("end") and len(stack) > 1 and word[3:] == top.kind:
            stack.pop()
            if top.kind == "if":
                node: object = If((*top.branches, (top.head, tuple(top.body))))
            else:
                node = For(top.head, tuple(top.body)) if top.kind == "for" else Generation(tuple(top.body))
            stack[-1].body.append(node)
        else:
            raise TemplateError(f"unexpected {word!r}")
    text(source[at:], "")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1].kind!r} isn't closed")
    tree = tuple(stack[0].body)
    if sum(isinstance(n, For) for n in tree) > 1:
        raise TemplateError("one loop over messages at most")
    return tree


# --- folding -------------------------------------------------------------------


def _shown(value: object) -> str:
    return "" if value is None else ("true" if value else "false") if isinstance(value, bool) else str(value)


def _operate(sign: str, a: object, b: object) -> object:
    if sign == "+":
        return a + b if isinstance(a, int) and isinstance(b, int) else _shown(a) + _shown(b)
    if sign == "in":
        return _shown(a) in _shown(b)
    return (a == b) == (sign == "==")


def fold_expression(node: object) -> object:
    """The expression with its constant parts computed."""
    if isinstance(node, Filtered):
        of = fold_expression(node.of)
        return Literal(FILTERS[node.name](_shown(of.value))) if isinstance(of, Literal) else Filtered(of, node.name)
    if not isinstance(node, Operation):
        return node
    of = tuple(map(fold_expression, node.of))
    if node.sign == "not":
        return Literal(not of[0].value) if isinstance(of[0], Literal) else Operation("not", of)
    if node.sign in ("and", "or"):
        if isinstance(of[0], Literal):
            return of[1] if bool(of[0].value) == (node.sign == "and") else of[0]
        return Operation(node.sign, of)
    if all(isinstance(x, Literal) for x in of):
        return Literal(_operate(node.sign, of[0].value, of[1].value))
    return Operation(node.sign, of)


def fold(body: Iterable[object]) -> tuple:
    """The nodes with constants folded, untaken branches gone and neighbouring texts joined."""
    out: list = []

    def add(node: object) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].value + node.value)
        elif not (isinstance(node, Text) and not node.value):
            out.append(node)

    for node in body:
        if isinstance(node, Output):
            of = fold_expression(node.of)
            add(Text(_shown(of.value)) if isinstance(of, Literal) else Output(of))
        elif isinstance(node, If):
            branches = []
            for condition, inner in node.branches:
                condition = fold_expression(condition)
                if isinstance(condition, Literal) and not condition.value:
                    continue
                branches.append((condition, fold(inner)))
                if isinstance(condition, Literal):
                    break
            if branches and isinstance(branches[0][0], Literal):
                for inner in branches[0][1]:
                    add(inner)
            elif branches:
                add(If(tuple(branches)))
        elif isinstance(node, For):
            add(For(node.name, fold(node.body)))
        elif isinstance(node, Generation):
            inner = fold(node.body)
            if inner:
                add(Generation(inner))
        else:
            add(node)
    return tuple(out)


# --- closures ------------------------------------------------------------------


class Segment:
    """A stretch of output with the spans to learn in it."""

    def __init__(self) -> None:
        self._parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self._parts.append(text)
        self.length += len(text)

    @property
    def text(self) -> str:
        return "".join(self._parts)


def _value(node: object) -> Callable[[dict], object]:
    if isinstance(node, Literal):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name, key = node.name, node.key
        if key is None:
            return lambda scope: scope.get(name)
        return lambda scope: (scope.get(name) or {}).get(key)
    if isinstance(node, Filtered):
        of, how = _value(node.of), FILTERS[node.name]
        return lambda scope: how(_shown(of(scope)))
    sign, of = node.sign, tuple(map(_value, node.of))
    if sign == "not":
        return lambda scope: not of[0](scope)
    if sign == "and":
        return lambda scope: of[0](scope) and of[1](scope)
    if sign == "or":
        return lambda scope: of[0](scope) or of[1](scope)
    return lambda scope: _operate(sign, of[0](scope), of[1](scope))


Renderer = Callable[[dict, Segment], None]


def _renderer(body: tuple) -> Renderer:
    steps = tuple(map(_step, body))

    def run(scope: dict, out: Segment) -> None:
        for step in steps:
            step(scope, out)

    return steps[0] if len(steps) == 1 else run


def _step(node: object) -> Renderer:
    if isinstance(node, Text):
        text = node.value
        return lambda scope, out: out.write(text)
    if isinstance(node, Output):
        value = _value(node.of)
        return lambda scope, out: out.write(_shown(value(scope)))
    if isinstance(node, If):
        branches = tuple((_value(c), _renderer(b)) for c, b in node.branches)

        def choose(scope: dict, out: Segment) -> None:
            for condition, render in branches:
                if condition(scope):
                    render(scope, out)
                    return

        return choose
    if isinstance(node, Generation):
        inner = _renderer(node.body)

        def mark(scope: dict, out: Segment) -> None:
            start = out.length
            inner(scope, out)
            out.spans.append((start, out.length))

        return mark
    raise TemplateError("the loop over messages stands at the top only")


class Template:
    """A compiled template."""

    def __init__(self, source: str):
        tree = fold(parse(source))
        at = next((k for k, n in enumerate(tree) if isinstance(n, For)), len(tree))
        self._before = _renderer(tree[:at])
        self._loop = (tree[at].name, _renderer(tree[at].body)) if at < len(tree) else None
        self._after = _renderer(tree[at + 1 :])

    def stream(self, messages: Iterable[dict]) -> Iterator[Segment]:
        """The output as segments, one a message; what stands before and after the loop goes with the first and last."""
        out = Segment()
        self._before({}, out)
        rest = iter(messages)
        message = next(rest, None)
        index = 0
        while message is not None:
            following = next(rest, None)
            if self._loop:
                name, render = self._loop
                render({name: message, "loop": {"index": index + 1, "first": index == 0, "last": following is None}}, out)
                if following is not None:
                    yield out
                    out = Segment()
            message, index = following, index + 1
        self._after({}, out)
        yield out
