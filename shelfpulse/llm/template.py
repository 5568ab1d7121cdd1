"""A sandboxed template language, compiled to Python closures.

A template is text with ``{{ expression }}`` and ``{% statement %}``; a dash beside a
delimiter strips the white space next to it. Statements are ``if``/``elif``/``else``,
``for name in expression``, ``set name = expression`` and ``generation``, whose body is what
a model is trained on. Expressions have strings, integers, true, false, none, names,
``a.b`` and ``a['b']`` (keys of mappings, never attributes of Python objects), comparisons,
``in``, ``and``, ``or``, ``not``, ``+``, ``~``, ``a if c else b`` and filters. There are no calls
and no way to reach anything but the values given, so a template cannot do harm and, with no
loops but over given lists, always ends.

Compilation parses to a syntax tree, folds what is constant, joins neighbouring constant
text, and turns the tree into closures. A rendering hands pieces of text with their mark to a
sink as they arise, and loops take any iterable, so a long conversation is never held whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

Sink = Callable[[str, bool], None]
Filters = Mapping[str, Callable[[Any], Any]]


class TemplateError(ValueError):
    """The template is not well formed, or uses what it may not."""


# --- Syntax tree -----------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Get:
    of: Any
    key: Any


@dataclass(frozen=True)
class Op:
    kind: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    of: Any


@dataclass(frozen=True)
class Emit:
    value: Any


@dataclass(frozen=True)
class If:
    arms: tuple  # of condition and body; the last may have the condition Const(True)


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- Parser ----------------------------------------------------------------------------

_TAG = re.compile(r"(\{\{-?|\{%-?)(.*?)(-?\}\}|-?%\})", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)"""
    r"""|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-<>+~|.()\[\]=]))""",
    re.S,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"and", "or", "not", "in", "if", "else"}
_CONSTS = {"true": True, "false": False, "none": None}


def _tokens(source: str) -> list[tuple[str, Any]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        found = _TOKEN.match(source, at)
        if not found:
            raise TemplateError(f"cannot read {source[at:]!r}")
        kind, text = found.lastgroup, found[found.lastgroup]
        at = found.end()
        if kind == "string":
            text = re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S)
        elif kind == "int":
            text = int(text)
        elif kind == "name" and text.lower() in _CONSTS:
            kind, text = "const", _CONSTS[text.lower()]
        elif kind == "name" and text in _WORDS:
            kind = "op"
        out.append((kind, text))
    return out


class _Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str):
        self.left = _tokens(source)

    def take(self, *texts: str) -> str | None:
        if self.left and self.left[0][0] == "op" and self.left[0][1] in texts:
            return self.left.pop(0)[1]
        return None

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} is missing")

    def name(self) -> str:
        if not self.left or self.left[0][0] != "name":
            raise TemplateError("a name is missing")
        return self.left.pop(0)[1]

    def end(self, value):
        if self.left:
            raise TemplateError(f"unexpected {self.left[0][1]!r}")
        return value

    def whole(self):
        return self.end(self.choice())

    def choice(self):
        value = self.either()
        if self.take("if"):
            condition = self.either()
            other = self.choice() if self.take("else") else Const("")
            return Op("if", (condition, value, other))
        return value

    def either(self):
        value = self.both()
        while self.take("or"):
            value = Op("or", (value, self.both()))
        return value

    def both(self):
        value = self.negation()
        while self.take("and"):
            value = Op("and", (value, self.negation()))
        return value

    def negation(self):
        return Op("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self):
        value = self.sum()
        while True:
            if kind := self.take("==", "!=", "<=", ">=", "<", ">", "in"):
                value = Op(kind, (value, self.sum()))
            elif self.left[:2] == [("op", "not"), ("op", "in")]:
                del self.left[:2]
                value = Op("not", (Op("in", (value, self.sum())),))
            else:
                return value

    def sum(self):
        value = self.filtered()
        while kind := self.take("+", "~", "-"):
            value = Op(kind, (value, self.filtered()))
        return value

    def filtered(self):
        value = self.atom()
        while self.take("|"):
            value = Filter(self.name(), value)
        return value

    def atom(self):
        if self.take("("):
            value = self.choice()
            self.need(")")
        elif self.left and self.left[0][0] in ("string", "int", "const"):
            value = Const(self.left.pop(0)[1])
        else:
            value = Name(self.name())
        while kind := self.take(".", "["):
            if kind == ".":
                value = Get(value, Const(self.name()))
            else:
                value = Get(value, self.choice())
                self.need("]")
        return value


def parse(template: str) -> tuple:
    """The statements of a template."""
    items: list[tuple[str, str]] = []
    at, strip = 0, False
    for tag in _TAG.finditer(template):
        text = template[at : tag.start()]
        text = text.lstrip() if strip else text
        items.append(("text", text.rstrip() if tag[1].endswith("-") else text))
        if (tag[1][:2] == "{{") != tag[3].endswith("}}"):
            raise TemplateError(f"mixed delimiters in {tag[0]!r}")
        items.append(("value" if tag[1][:2] == "{{" else "tag", tag[2].strip()))
        at, strip = tag.end(), tag[3].startswith("-")
    items.append(("text", template[at:].lstrip() if strip else template[at:]))
    items.reverse()
    body, last = _body(items, ())
    return body


def _body(items: list, until: tuple[str, ...]) -> tuple[tuple, str]:
    """Statements up to a tag that begins with one of ``until``, and that tag."""
    out: list = []
    while items:
        kind, text = items.pop()
        if kind == "text":
            if "{%" in text or "{{" in text:
                raise TemplateError(f"a tag is not closed in {text!r}")
            if text:
                out.append(Emit(Const(text)))
            continue
        if kind == "value":
            out.append(Emit(_Expression(text).whole()))
            continue
        word, _, rest = text.partition(" ")
        if word in until:
            return tuple(out), text
        if word == "if":
            arms, condition = [], _Expression(rest).whole()
            while True:
                body, tag = _body(items, ("elif", "else", "endif"))
                arms.append((condition, body))
                if tag == "endif":
                    break
                word, _, rest = tag.partition(" ")
                condition = Const(True) if word == "else" else _Expression(rest).whole()
            out.append(If(tuple(arms)))
        elif word == "for":
            read = _Expression(rest)
            name = read.name()
            read.need("in")
            over = read.whole()
            out.append(For(name, over, _body(items, ("endfor",))[0]))
        elif word == "set":
            read = _Expression(rest)
            name = read.name()
            read.need("=")
            out.append(Assign(name, read.whole()))
        elif word == "generation":
            out.append(Generation(_body(items, ("endgeneration",))[0]))
        else:
            raise TemplateError(f"unknown statement {text!r}")
    if until:
        raise TemplateError(f"{until[-1]!r} is missing")
    return tuple(out), ""


# --- Constant folding ------------------------------------------------------------------

_BINARY: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "~": lambda a, b: shown(a) + shown(b),
}


def shown(value: Any) -> str:
    """A value as text; none is empty."""
    if value is None:
        return ""
    if isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    raise TemplateError("only text and numbers can be shown")


def fold(node: Any, filters: Filters) -> Any:
    """The same tree with constant parts worked out."""
    again = lambda x: fold(x, filters)
    if isinstance(node, Op):
        args = tuple(map(again, node.args))
        if node.kind == "if" and isinstance(args[0], Const):
            return args[1] if args[0].value else args[2]
        if node.kind in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.kind == "and") else args[0]
        if all(isinstance(x, Const) for x in args) and node.kind != "if":
            values = [x.value for x in args]
            if node.kind == "not":
                return Const(not values[0])
            if node.kind in _BINARY:
                try:
                    return Const(_BINARY[node.kind](*values))
                except TypeError as wrong:
                    raise TemplateError(str(wrong)) from wrong
        return Op(node.kind, args)
    if isinstance(node, Filter):
        if node.name not in filters:
            raise TemplateError(f"unknown filter {node.name!r}")
        of = again(node.of)
        return Const(filters[node.name](of.value)) if isinstance(of, Const) else Filter(node.name, of)
    if isinstance(node, Get):
        return Get(again(node.of), again(node.key))
    if isinstance(node, Emit):
        return Emit(again(node.value))
    if isinstance(node, Assign):
        return Assign(node.name, again(node.value))
    if isinstance(node, For):
        return For(node.name, again(node.over), again(node.body))
    if isinstance(node, Generation):
        return Generation(again(node.body))
    if isinstance(node, If):
        return _fold_if(node, again)
    if isinstance(node, tuple):
        return _fold_body(node, again)
    return node


def _fold_if(node: If, again: Callable) -> Any:
    arms = []
    for condition, body in node.arms:
        condition = again(condition)
        if isinstance(condition, Const) and not condition.value:
            continue
        arms.append((condition, again(body)))
        if isinstance(condition, Const):
            break
    if arms and isinstance(arms[0][0], Const):
        return arms[0][1]
    return If(tuple(arms)) if arms else ()


def _fold_body(body: tuple, again: Callable) -> tuple:
    out: list = []
    for part in map(again, body):
        for item in part if isinstance(part, tuple) else (part,):
            if isinstance(item, Emit) and isinstance(item.value, Const):
                item = Emit(Const(shown(item.value.value)))
                if out and isinstance(out[-1], Emit) and isinstance(out[-1].value, Const):
                    item = Emit(Const(out.pop().value.value + item.value.value))
            out.append(item)
    return tuple(out)


# --- Closures --------------------------------------------------------------------------


def _value(node: Any, filters: Filters) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        constant = node.value
        return lambda env: constant
    if isinstance(node, Name):
        name = node.name
        return lambda env: env.get(name)
    if isinstance(node, Get):
        of, key = _value(node.of, filters), _value(node.key, filters)

        def get(env: dict) -> Any:
            held = of(env)
            return held.get(key(env)) if isinstance(held, dict) else None

        return get
    if isinstance(node, Filter):
        of, apply = _value(node.of, filters), filters[node.name]
        return lambda env: apply(of(env))
    args = [_value(x, filters) for x in node.args]
    if node.kind == "not":
        return lambda env: not args[0](env)
    if node.kind == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.kind == "or":
        return lambda env: args[0](env) or args[1](env)
    if node.kind == "if":
        return lambda env: args[1](env) if args[0](env) else args[2](env)
    a, b, do = args[0], args[1], _BINARY[node.kind]
    return lambda env: do(a(env), b(env))


def _statement(node: Any, filters: Filters) -> Callable[[dict, Sink, bool], None]:
    if isinstance(node, tuple):
        steps = [_statement(x, filters) for x in node]

        def body(env: dict, sink: Sink, marked: bool) -> None:
            for step in steps:
                step(env, sink, marked)

        return body
    if isinstance(node, Emit):
        if isinstance(node.value, Const):
            text = node.value.value
            return lambda env, sink, marked: sink(text, marked)
        value = _value(node.value, filters)
        return lambda env, sink, marked: sink(shown(value(env)), marked)
    if isinstance(node, Assign):
        name, value = node.name, _value(node.value, filters)

        def assign(env: dict, sink: Sink, marked: bool) -> None:
            env[name] = value(env)

        return assign
    if isinstance(node, Generation):
        inner = _statement(node.body, filters)
        return lambda env, sink, marked: inner(env, sink, True)
    if isinstance(node, If):
        arms = [(_value(c, filters), _statement(b, filters)) for c, b in node.arms]

        def choose(env: dict, sink: Sink, marked: bool) -> None:
            for condition, then in arms:
                if condition(env):
                    return then(env, sink, marked)

        return choose
    name, over, inner = node.name, _value(node.over, filters), _statement(node.body, filters)

    def loop(env: dict, sink: Sink, marked: bool) -> None:
        items = over(env)
        if items is None:
            return
        if isinstance(items, str | dict) or not isinstance(items, Iterable):
            raise TemplateError(f"cannot loop over the value of {name!r}")
        index, items = 0, iter(items)
        item = next(items, _END)
        while item is not _END:
            after = next(items, _END)
            state = {"index0": index, "index": index + 1, "first": index == 0, "last": after is _END}
            # A loop has its own names, so what it sets does not outlive an item.
            inner({**env, name: item, "loop": state}, sink, marked)
            item, index = after, index + 1

    return loop


_END = object()

FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda x: shown(x).strip(),
    "upper": lambda x: shown(x).upper(),
    "lower": lambda x: shown(x).lower(),
    "length": lambda x: len(x) if isinstance(x, str | list | dict) else 0,
    "tojson": lambda x: json.dumps(x, ensure_ascii=False),
    "string": shown,
}


@dataclass(frozen=True)
class Template:
    """A compiled template."""

    source: str
    filters: Filters = field(default_factory=lambda: FILTERS)

    def __post_init__(self) -> None:
        tree = fold(parse(self.source), self.filters)
        object.__setattr__(self, "tree", tree)
        object.__setattr__(self, "run", _statement(tree, self.filters))

    def stream(self, values: Mapping[str, Any], sink: Sink) -> None:
        """Hand the rendering to ``sink``, piece by piece, each with its mark."""
        self.run(dict(values), lambda text, marked: sink(text, marked) if text else None, False)

    def render(self, values: Mapping[str, Any]) -> tuple[str, list[tuple[int, int]]]:
        """The text and the spans of code points that are marked."""
        parts: list[str] = []
        spans: list[tuple[int, int]] = []
        at = 0

        def sink(text: str, marked: bool) -> None:
            nonlocal at
            parts.append(text)
            if marked:
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + len(text))
                else:
                    spans.append((at, at + len(text)))
            at += len(text)

        self.stream(values, sink)
        return "".join(parts), spans
