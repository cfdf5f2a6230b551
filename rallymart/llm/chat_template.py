"""A small template language for conversations: parsed to a tree, folded, compiled to closures.

    text   {{ expression }}   {# comment #}
    {% if e %} {% elif e %} {% else %} {% endif %}
    {% for name in e %} {% endfor %}      with loop.index, index0, first and last
    {% set name = e %}
    {% generation %} {% endgeneration %}  marks what a model is trained to write

A hyphen inside a tag (`{%-`, `-}}`) strips white space beside it. Expressions know strings,
whole numbers, true, false, none, lists, names, `x.key`, `x[e]`, `+ - ~ %`, comparisons, `in`,
`not`, `and`, `or`, `a if b else c` and filters `x | name(args)`.

It is a sandbox: a name is what the caller gave or the template set, a key is looked up in
mappings and lists and never as an attribute, only the given filters can be called, and the only
loops are those over given values, so rendering takes time in proportion to them.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field

#: A stretch of output and whether it lies inside a generation block.
Piece = tuple[str, bool]


class TemplateError(ValueError):
    """The template can't be read, or asks for what it may not have."""


# --- syntax tree ------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: object
    key: object


@dataclass(frozen=True)
class Call:
    """An operation or filter on operands; `name` is a key of `OPERATIONS` or a filter."""

    name: str
    args: tuple
    is_filter: bool = False


@dataclass(frozen=True)
class Choice:
    """`and`, `or` and the conditional expression, which leave an operand unevaluated."""

    kind: str
    args: tuple


@dataclass(frozen=True)
class Items:
    items: tuple


@dataclass
class Put:
    value: object


@dataclass
class If:
    cases: list  # of (condition, block); the last condition may be Const(True)


@dataclass
class For:
    name: str
    over: object
    block: list


@dataclass
class Set:
    name: str
    value: object


@dataclass
class Marked:
    block: list


# --- parsing ----------------------------------------------------------------------------

_TAG = re.compile(r"\{\{-?|\{%-?|\{#")
_WORD = re.compile(
    r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"""
    r"""|(?P<sign>==|!=|<=|>=|[<>+\-~%|.,()\[\]=]))""",
    re.S,
)
_ESCAPED = {"n": "\n", "t": "\t", "r": "\r"}
_RESERVED = {"and", "or", "not", "in", "if", "else", "true", "false", "none"}


@dataclass
class _Words:
    """The words of one tag, read one by one."""

    tag: str
    words: list = field(default_factory=list)
    at: int = 0

    def __post_init__(self) -> None:
        end = 0
        while self.tag[end:].strip():
            found = _WORD.match(self.tag, end)
            if not found:
                raise TemplateError(f"unreadable: {self.tag[end:]!r}")
            self.words.append((found.lastgroup, found[found.lastgroup]))
            end = found.end()

    def peek(self) -> str | None:
        if self.at < len(self.words) and self.words[self.at][0] != "string":
            return self.words[self.at][1]
        return None

    def take(self) -> tuple[str, str]:
        if self.at == len(self.words):
            raise TemplateError(f"ends too early: {self.tag!r}")
        self.at += 1
        return self.words[self.at - 1]

    def accept(self, *signs: str) -> str | None:
        if self.peek() in signs:
            return self.take()[1]
        return None

    def expect(self, sign: str) -> None:
        if not self.accept(sign):
            raise TemplateError(f"{sign!r} is missing in {self.tag!r}")

    def name(self) -> str:
        kind, word = self.take()
        if kind != "name" or word in _RESERVED:
            raise TemplateError(f"not a name: {word!r}")
        return word

    def done(self) -> None:
        if self.at < len(self.words):
            raise TemplateError(f"too much in {self.tag!r}")

    # Expressions, from the loosest to the tightest.

    def expression(self):
        value = self._or()
        if self.accept("if"):
            condition = self._or()
            other = self.expression() if self.accept("else") else Const("")
            return Choice("if", (condition, value, other))
        return value

    def _or(self):
        value = self._and()
        while self.accept("or"):
            value = Choice("or", (value, self._and()))
        return value

    def _and(self):
        value = self._not()
        while self.accept("and"):
            value = Choice("and", (value, self._not()))
        return value

    def _not(self):
        if self.accept("not"):
            return Call("not", (self._not(),))
        value = self._joined()
        while sign := self.accept("==", "!=", "<", "<=", ">", ">=", "in", "not"):
            if sign == "not":
                self.expect("in")
                value = Call("not", (Call("in", (value, self._joined())),))
            else:
                value = Call(sign, (value, self._joined()))
        return value

    def _joined(self):
        value = self._sum()
        while self.accept("~"):
            value = Call("~", (value, self._sum()))
        return value

    def _sum(self):
        value = self._remainder()
        while sign := self.accept("+", "-"):
            value = Call(sign, (value, self._remainder()))
        return value

    def _remainder(self):
        value = self._filtered()
        while self.accept("%"):
            value = Call("%", (value, self._filtered()))
        return value

    def _filtered(self):
        value = self._postfix()
        while self.accept("|"):
            name, args = self.name(), ()
            if self.accept("("):
                args = self._list(")")
            value = Call(name, (value, *args), True)
        return value

    def _postfix(self):
        value = self._atom()
        while sign := self.accept(".", "["):
            if sign == ".":
                value = Key(value, Const(self.name()))
            else:
                value = Key(value, self.expression())
                self.expect("]")
        return value

    def _list(self, end: str) -> tuple:
        items = []
        while not self.accept(end):
            items.append(self.expression())
            if not self.accept(","):
                self.expect(end)
                break
        return tuple(items)

    def _atom(self):
        kind, word = self.take()
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPED.get(m[1], m[1]), word[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(word))
        if word == "(":
            value = self.expression()
            self.expect(")")
            return value
        if word == "[":
            return Items(self._list("]"))
        if word == "-":
            return Call("-", (Const(0), self._postfix()))
        if word in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[word])
        if kind == "name" and word not in _RESERVED:
            return Name(word)
        raise TemplateError(f"unexpected {word!r} in {self.tag!r}")


def _tags(source: str) -> Iterator[tuple[str, str]]:
    """The template as (`text` | `put` | `do`, content)."""
    at, strip = 0, False
    while True:
        found = _TAG.search(source, at)
        text = source[at : found.start() if found else len(source)]
        if strip:
            text = text.lstrip()
        if found and found[0].endswith("-"):
            text = text.rstrip()
        if text:
            yield "text", text
        if not found:
            return
        opening = found[0][:2]
        # A closing sign inside a string belongs to the string.
        inside = r".*?" if opening == "{#" else r"""(?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|.)*?"""
        closing = {"{{": r"-?\}\}", "{%": r"-?%\}", "{#": r"#\}"}[opening]
        content = re.compile(f"({inside})({closing})", re.S).match(source, found.end())
        if not content:
            raise TemplateError(f"{opening} is not closed")
        at, strip = content.end(), content[2].startswith("-")
        if opening != "{#":
            yield ("put" if opening == "{{" else "do"), content[1]


def parse(source: str) -> list:
    """The syntax tree: a list of text (`Put` of a constant) and other nodes."""
    tags = list(_tags(source))
    at = 0

    def block(*ends: str) -> tuple[list, _Words | None]:
        nonlocal at
        nodes: list = []
        while at < len(tags):
            kind, content = tags[at]
            at += 1
            if kind == "text":
                nodes.append(Put(Const(content)))
                continue
            words = _Words(content)
            if kind == "put":
                nodes.append(Put(words.expression()))
                words.done()
                continue
            if words.accept(*ends):
                return nodes, words
            nodes.append(statement(words))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return nodes, None

    def ended(words: _Words, *ends: str) -> tuple[list, _Words]:
        words.done()
        return block(*ends)

    def statement(words: _Words):
        what = words.name() if words.peek() not in ("if",) else words.take()[1]
        if what == "set":
            name = words.name()
            words.expect("=")
            made = Set(name, words.expression())
            words.done()
            return made
        if what == "generation":
            inner, end = ended(words, "endgeneration")
            end.done()
            return Marked(inner)
        if what == "for":
            name = words.name()
            words.expect("in")
            over = words.expression()
            inner, end = ended(words, "endfor")
            end.done()
            return For(name, over, inner)
        if what == "if":
            cases, condition = [], words.expression()
            while True:
                inner, end = ended(words, "elif", "else", "endif")
                cases.append((condition, inner))
                closed_by = end.words[end.at - 1][1]
                if closed_by == "endif":
                    end.done()
                    return If(cases)
                condition, words = (Const(True), end) if closed_by == "else" else (end.expression(), end)
        raise TemplateError(f"unknown tag {what!r}")

    return block()[0]


# --- folding ----------------------------------------------------------------------------


def _text(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str | int):
        return str(value)
    raise TemplateError(f"can't be written: {type(value).__name__}")


def _remainder(a: object, b: object) -> int:
    if not isinstance(a, int) or not isinstance(b, int):
        raise TemplateError("% takes whole numbers")
    return a % b


def _joined(a: object, b: object) -> object:
    if type(a) is not type(b) or not isinstance(a, str | int | tuple):
        raise TemplateError("+ takes two numbers, texts or lists")
    return a + b


OPERATIONS: dict[str, Callable] = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "+": _joined,
    "-": operator.sub,
    "%": _remainder,
    "~": lambda a, b: _text(a) + _text(b),
    "in": lambda a, b: a in b,
    "not": operator.not_,
}

FILTERS: dict[str, Callable] = {
    "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(),
    "length": len,
    "string": _text,
    "default": lambda x, other="": other if x is None else x,
    "replace": lambda x, old, new: _text(x).replace(old, new),
    "join": lambda x, between="": between.join(map(_text, x)),
}


def fold(node, filters: Mapping[str, Callable]):
    """The expression with all parts evaluated that depend on constants alone."""
    match node:
        case Call(name, args, is_filter):
            known = filters if is_filter else OPERATIONS
            if name not in known:
                raise TemplateError(f"unknown filter {name!r}")
            args = tuple(fold(a, filters) for a in args)
            if all(isinstance(a, Const) for a in args):
                return Const(_apply(known[name], [a.value for a in args], name))
            return Call(name, args, is_filter)
        case Choice("if", (condition, yes, no)):
            condition, yes, no = (fold(a, filters) for a in (condition, yes, no))
            if isinstance(condition, Const):
                return yes if condition.value else no
            return Choice("if", (condition, yes, no))
        case Choice(kind, (a, b)):
            a, b = fold(a, filters), fold(b, filters)
            if isinstance(a, Const):
                return b if bool(a.value) == (kind == "and") else a
            return Choice(kind, (a, b))
        case Key(of, key):
            of, key = fold(of, filters), fold(key, filters)
            if isinstance(of, Const) and isinstance(key, Const):
                return Const(_look_up(of.value, key.value))
            return Key(of, key)
        case Items(items):
            items = tuple(fold(i, filters) for i in items)
            if all(isinstance(i, Const) for i in items):
                return Const(tuple(i.value for i in items))
            return Items(items)
    return node


def fold_block(nodes: list, filters: Mapping[str, Callable]) -> list:
    """The block with constant parts evaluated, dead branches gone and neighbouring texts joined."""
    made: list = []
    for node in nodes:
        match node:
            case Put(value):
                value = fold(value, filters)
                if not isinstance(value, Const):
                    made.append(Put(value))
                elif text := _text(value.value):
                    if made and isinstance(made[-1], Put) and isinstance(made[-1].value, Const):
                        text = made.pop().value.value + text
                    made.append(Put(Const(text)))
            case If(cases):
                kept = []
                for condition, block in cases:
                    condition = fold(condition, filters)
                    if isinstance(condition, Const) and not condition.value:
                        continue
                    kept.append((condition, fold_block(block, filters)))
                    if isinstance(condition, Const):
                        break
                if kept and isinstance(kept[0][0], Const):
                    made = fold_block(made + kept[0][1], filters)
                elif kept:
                    made.append(If(kept))
            case For(name, over, block):
                made.append(For(name, fold(over, filters), fold_block(block, filters)))
            case Set(name, value):
                made.append(Set(name, fold(value, filters)))
            case Marked(block):
                made.append(Marked(fold_block(block, filters)))
    return made


# --- closures ---------------------------------------------------------------------------


def _apply(operation: Callable, args: list, name: str):
    try:
        return operation(*args)
    except TemplateError:
        raise
    except (TypeError, AttributeError, ZeroDivisionError) as wrong:
        raise TemplateError(f"{name!r} does not take these values") from wrong


def _look_up(of: object, key: object):
    if isinstance(of, Mapping):
        return of.get(key)
    if isinstance(of, list | tuple) and isinstance(key, int):
        return of[key] if -len(of) <= key < len(of) else None
    return None


Value = Callable[[dict], object]
Block = Callable[[dict], Iterator[Piece]]


def _value(node, filters: Mapping[str, Callable]) -> Value:
    match node:
        case Const(value):
            return lambda scope: value
        case Name(name):

            def named(scope):
                if name not in scope:
                    raise TemplateError(f"unknown name {name!r}")
                return scope[name]

            return named
        case Key(of, Const(key)):
            found = _value(of, filters)
            return lambda scope: _look_up(found(scope), key)
        case Key(of, key):
            found, wanted = _value(of, filters), _value(key, filters)
            return lambda scope: _look_up(found(scope), wanted(scope))
        case Items(items):
            parts = [_value(i, filters) for i in items]
            return lambda scope: tuple(p(scope) for p in parts)
        case Choice("if", (condition, yes, no)):
            asked, one, other = (_value(a, filters) for a in (condition, yes, no))
            return lambda scope: one(scope) if asked(scope) else other(scope)
        case Choice("and", (a, b)):
            one, other = _value(a, filters), _value(b, filters)
            return lambda scope: one(scope) and other(scope)
        case Choice("or", (a, b)):
            one, other = _value(a, filters), _value(b, filters)
            return lambda scope: one(scope) or other(scope)
        case Call(name, args, is_filter):
            operation = (filters if is_filter else OPERATIONS)[name]
            parts = [_value(a, filters) for a in args]
            return lambda scope: _apply(operation, [p(scope) for p in parts], name)
    raise TemplateError(f"no expression: {node!r}")


def _looped(values: Iterable) -> Iterator[tuple[object, dict]]:
    """The values one by one, each with what `loop` holds; one value is read ahead."""
    if isinstance(values, str | Mapping) or not isinstance(values, Iterable):
        raise TemplateError("for needs a list")
    waiting, index = iter(values), 0
    none = object()
    value = next(waiting, none)
    while value is not none:
        after = next(waiting, none)
        yield value, {"index0": index, "index": index + 1, "first": not index, "last": after is none}
        value, index = after, index + 1


def _block(nodes: list, filters: Mapping[str, Callable], marked: bool) -> Block:
    parts = [_statement(n, filters, marked) for n in nodes]
    if len(parts) == 1:
        return parts[0]

    def run(scope):
        for part in parts:
            yield from part(scope)

    return run


def _statement(node, filters: Mapping[str, Callable], marked: bool) -> Block:
    match node:
        case Put(Const(text)):
            piece = ((text, marked),)
            return lambda scope: iter(piece)
        case Put(value):
            made = _value(value, filters)

            def put(scope):
                if text := _text(made(scope)):
                    yield text, marked

            return put
        case Set(name, value):
            made = _value(value, filters)

            def put_name(scope):
                scope[name] = made(scope)
                return iter(())

            return put_name
        case Marked(block):
            if marked:
                raise TemplateError("a generation block inside another")
            return _block(block, filters, True)
        case If(cases):
            branches = [(_value(c, filters), _block(b, filters, marked)) for c, b in cases]

            def choose(scope):
                for condition, block in branches:
                    if condition(scope):
                        return block(scope)
                return iter(())

            return choose
        case For(name, over, block):
            values, inner = _value(over, filters), _block(block, filters, marked)

            def loop(scope):
                local = dict(scope)
                for local[name], local["loop"] in _looped(values(scope)):
                    yield from inner(local)

            return loop
    raise TemplateError(f"no statement: {node!r}")


class Template:
    """A compiled template. `render` yields pieces of output as it goes.

    A list can be given as an iterator, which is read once and one value ahead, so a conversation
    of any length is rendered without holding it.
    """

    def __init__(self, source: str, filters: Mapping[str, Callable] | None = None) -> None:
        known = {**FILTERS, **(filters or {})}
        self.tree = fold_block(parse(source), known)
        self._run = _block(self.tree, known, False)

    def render(self, **names) -> Iterator[Piece]:
        return self._run(dict(names))
