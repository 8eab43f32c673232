"""Chat-template programs as Column expressions.

A tokenizer's chat template is a small program over a list of messages.  ``ProgramTemplate``
reads the part of that language that such templates use: text, ``{{ … }}``, ``for`` over messages
(with a filter, and with ``loop``), ``if``, ``set``, comments and white-space marks; strings, numbers, comparisons,
``and``/``or``/``not``/``in``, ``a if c else b``, slices, filters, tests and string methods.  What depends
on no row is settled once on the driver; the rest becomes one expression per conversation, evaluated by Spark.
Anything else is refused: unknown words when the template is read, operations on wrong kinds when it is first used.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from weir.functions.text import WS, strip


class TemplateError(ValueError):
    """The template has something that cannot be expressed."""


# ---- values: Python's own where they are known, columns otherwise ----


@dataclass(frozen=True)
class Col:
    """A value that depends on the row; kind is str, int, bool, strs, messages or message."""

    kind: str
    column: Column


@dataclass(frozen=True)
class Choice:
    """``a`` in rows that meet ``cond`` and ``b`` in others, where the two are of different kinds."""

    cond: Column
    a: Any
    b: Any


class _Undefined:
    def __repr__(self) -> str:
        return "undefined"


UNDEFINED = _Undefined()


class _Loop(dict):
    """What a loop says of itself."""


def _kind(v: Any) -> str:
    if isinstance(v, Col):
        return v.kind
    return {str: "str", int: "int", bool: "bool", list: "list", type(None): "none", _Loop: "loop"}.get(type(v), "undefined")


def _column(v: Any) -> Column:
    return v.column if isinstance(v, Col) else F.lit(v)


def choose(cond: bool | Column, a: Any, b: Any) -> Any:
    if isinstance(cond, bool):
        return a if cond else b
    if not isinstance(a, Col | Choice) and not isinstance(b, Col | Choice) and type(a) is type(b) and a == b:
        return a
    if _kind(a) == _kind(b) and _kind(a) in ("str", "int", "bool", "strs", "messages", "message"):
        return Col(_kind(a), F.when(cond, _column(a)).otherwise(_column(b)))
    return Choice(cond, a, b)


def _each(f: Callable, *args: Any) -> Any:
    """``f`` of the arguments, in each case of those that are choices; a case of wrong kinds is an error of the rows that come to it."""
    for i, v in enumerate(args):
        if isinstance(v, Choice):
            done, wrong = [], []
            for x in (v.a, v.b):
                try:
                    done.append(_each(f, *args[:i], x, *args[i + 1 :]))
                except TemplateError as e:
                    wrong.append(e)
                    done.append(Col("str", F.raise_error(F.lit(str(e))).cast("string")))
            if len(wrong) == 2:
                raise wrong[0]
            return choose(v.cond, *done)
    return f(*args)


def truth(v: Any) -> bool | Column:
    """Python's truth of a value; what is missing is false."""
    if isinstance(v, Choice):
        a, b = truth(v.a), truth(v.b)
        return a if a is b else F.when(v.cond, a).otherwise(b)
    if not isinstance(v, Col):
        return v is not UNDEFINED and bool(v)
    c = v.column
    test = {"str": lambda: c != "", "int": lambda: c != 0, "bool": lambda: c, "strs": lambda: F.size(c) > 0, "messages": lambda: F.size(c) > 0, "message": lambda: c.isNotNull()}[v.kind]()
    return F.coalesce(test, F.lit(False))


def _bool(c: bool | Column) -> Column:
    return F.lit(c) if isinstance(c, bool) else c


def _truth_value(c: bool | Column) -> Any:
    return c if isinstance(c, bool) else Col("bool", c)


def text(v: Any) -> Any:
    """What a value prints as; a missing one, or content that is null, prints nothing."""

    def one(v: Any) -> Any:
        if not isinstance(v, Col):
            return "" if v is UNDEFINED else str(v)
        if v.kind == "str":
            return Col("str", F.coalesce(v.column, F.lit("")))
        if v.kind == "int":
            return Col("str", F.coalesce(v.column.cast("string"), F.lit("")))
        if v.kind == "bool":
            return Col("str", F.when(v.column, "True").otherwise("False"))
        raise TemplateError(f"a value of kind {v.kind} cannot be printed")

    return _each(one, v)


def joined(parts: list[Any]) -> Any:
    """Texts end to end."""
    parts = [p for p in parts if not (isinstance(p, str) and p == "")]
    if all(isinstance(p, str) for p in parts):
        return "".join(parts)
    return parts[0] if len(parts) == 1 else Col("str", F.concat(*[_column(p) for p in parts]))


# ---- operators ----


def _equal(a: Any, b: Any) -> Any:
    if not isinstance(a, Col) and not isinstance(b, Col):
        return (a is UNDEFINED) == (b is UNDEFINED) and a == b
    if {_kind(a), _kind(b)} & {"none", "undefined"}:
        return Col("bool", (a if isinstance(a, Col) else b).column.isNull())
    return Col("bool", _column(a).eqNullSafe(_column(b))) if _kind(a) == _kind(b) else False


def _not(v: Any) -> Any:
    t = truth(v)
    return not t if isinstance(t, bool) else Col("bool", ~t)


def _contains(a: Any, b: Any) -> Any:
    if isinstance(b, list):
        hits = [_equal(a, x) for x in b]
        return True if any(h is True for h in hits) else _truth_value(reduce(lambda x, y: x | y, [h.column for h in hits if isinstance(h, Col)], F.lit(False)))
    if _kind(b) == "message":
        return a in FIELDS
    if _kind(a) == _kind(b) == "str":
        return a in b if isinstance(a, str) and isinstance(b, str) else Col("bool", F.coalesce(F.contains(_column(b), _column(a)), F.lit(False)))
    if _kind(b) == "strs":
        return Col("bool", F.array_contains(b.column, _column(a)))
    return False


def _arithmetic(op: str) -> Callable:
    whole = {"+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b, "%": lambda a, b: a % b, "//": lambda a, b: a // b}[op]

    def run(a: Any, b: Any) -> Any:
        if _kind(a) == _kind(b) == "int":
            if not isinstance(a, Col) and not isinstance(b, Col):
                return whole(a, b)
            x, y = _column(a), _column(b)
            column = {"%": lambda: F.pmod(x, y), "//": lambda: F.floor(x / y).cast("int")}.get(op, lambda: whole(x, y))()
            return Col("int", column)
        if op == "+" and _kind(a) == _kind(b) == "str":
            return joined([text(a), text(b)])
        if op == "+" and _kind(a) == _kind(b) == "messages":
            return Col("messages", F.concat(a.column, b.column))
        raise TemplateError(f"{op} of {_kind(a)} and {_kind(b)}")

    return run


def _ordered(op: str) -> Callable:
    test = {"<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b}[op]

    def run(a: Any, b: Any) -> Any:
        if _kind(a) != _kind(b) or _kind(a) not in ("int", "str"):
            raise TemplateError(f"{op} of {_kind(a)} and {_kind(b)}")
        return test(a, b) if not isinstance(a, Col) and not isinstance(b, Col) else Col("bool", test(_column(a), _column(b)))

    return run


OPERATORS: dict[str, Callable] = {
    "==": _equal,
    "!=": lambda a, b: _not(_equal(a, b)),
    "in": _contains,
    "not in": lambda a, b: _not(_contains(a, b)),
    "~": lambda a, b: joined([text(a), text(b)]),
    **{op: _arithmetic(op) for op in ("+", "-", "*", "%", "//")},
    **{op: _ordered(op) for op in ("<", ">", "<=", ">=")},
}

FIELDS = ("role", "content")


def _item(v: Any, key: Any) -> Any:
    """A message's field, or an element of a list counted from either end."""
    kind = _kind(v)
    if kind == "message":
        return Col("str", v.column[key]) if key in FIELDS else UNDEFINED
    if kind == "loop":
        return v.get(key, UNDEFINED)
    if isinstance(v, list) and isinstance(key, int):
        return v[key] if -len(v) <= key < len(v) else UNDEFINED
    if kind in ("messages", "strs") and _kind(key) == "int":
        at = _column(key) if isinstance(key, Col) or key >= 0 else F.size(v.column) + key
        return Col("message" if kind == "messages" else "str", F.when(at >= 0, F.get(v.column, at)))
    if kind == "undefined":
        return UNDEFINED
    raise TemplateError(f"{kind} has no element {key!r}")


def _slice(v: Any, low: int | None, high: int | None) -> Any:
    if isinstance(v, str | list):
        return v[low:high]
    if _kind(v) not in ("messages", "strs", "str"):
        raise TemplateError(f"a slice of {_kind(v)}")
    n = F.length(v.column) if v.kind == "str" else F.size(v.column)
    place = lambda x, default: default if x is None else F.least(n, F.lit(x)) if x >= 0 else F.greatest(F.lit(0), n + x)
    a, b = place(low, F.lit(0)), place(high, n)
    part = F.substring if v.kind == "str" else F.slice
    return Col(v.kind, part(v.column, a + 1, F.greatest(F.lit(0), b - a)))


def _on_text(known: Callable[[str], Any], column: Callable[[Column], Column], kind: str = "str") -> Callable:
    def run(v: Any) -> Any:
        if isinstance(v, str):
            return known(v)
        if _kind(v) != "str":
            raise TemplateError(f"a string is needed, not {_kind(v)}")
        return Col(kind, column(v.column))

    return run


def _split(sep: Any) -> Callable:
    if not isinstance(sep, str):
        raise TemplateError("split needs a string that is known")
    return _on_text(lambda s: s.split(sep), lambda c: F.split(c, re.escape(sep), -1), "strs")


def _words_capital(c: Column, every: bool) -> Column:
    first = F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))
    return F.initcap(F.lower(c)) if every else first


def _length(v: Any) -> Any:
    if isinstance(v, str | list):
        return len(v)
    if _kind(v) in ("messages", "strs"):
        return Col("int", F.size(v.column))
    return Col("int", F.length(v.column)) if _kind(v) == "str" else 0


def _default(v: Any, other: Any = "", empty: Any = False) -> Any:
    if v is UNDEFINED:
        return other
    missing = truth(v) if empty is True else F.coalesce(v.column.isNotNull(), F.lit(False)) if isinstance(v, Col) else True
    return choose(missing, v, other)


def _replace(v: Any, old: Any, new: Any) -> Any:
    if all(isinstance(x, str) for x in (v, old, new)):
        return v.replace(old, new)
    return Col("str", F.replace(_column(v), _column(old), _column(new)))


def _prefix(known: Callable, column: Callable) -> Callable:
    return lambda v, x: known(v, x) if isinstance(v, str) and isinstance(x, str) else Col("bool", F.coalesce(column(_column(v), _column(x)), F.lit(False)))


TEXT_CALLS: dict[str, Callable] = {
    "strip": _on_text(str.strip, strip),
    "lstrip": _on_text(str.lstrip, lambda c: F.regexp_replace(c, f"^{WS}+", "")),
    "rstrip": _on_text(str.rstrip, lambda c: F.regexp_replace(c, f"{WS}+$", "")),
    "upper": _on_text(str.upper, F.upper),
    "lower": _on_text(str.lower, F.lower),
    "title": _on_text(str.title, lambda c: _words_capital(c, True)),
    "capitalize": _on_text(str.capitalize, lambda c: _words_capital(c, False)),
    "split": lambda v, sep: _split(sep)(v),
    "replace": _replace,
    "startswith": _prefix(str.startswith, F.startswith),
    "endswith": _prefix(str.endswith, F.endswith),
}
FILTERS: dict[str, Callable] = {
    "trim": TEXT_CALLS["strip"],
    **{k: TEXT_CALLS[k] for k in ("upper", "lower", "title", "capitalize", "replace")},
    "length": _length,
    "count": _length,
    "string": text,
    "safe": lambda v: v,
    "list": lambda v: v,
    "first": lambda v: _item(v, 0),
    "last": lambda v: _item(v, -1),
    "default": _default,
    "d": _default,
}


def _defined(v: Any) -> Any:
    return Col("bool", v.column.isNotNull()) if isinstance(v, Col) and v.kind == "message" else v is not UNDEFINED


def _is_none(v: Any) -> Any:
    return Col("bool", v.column.isNull()) if isinstance(v, Col) else v is None


TESTS: dict[str, Callable] = {
    "defined": _defined,
    "undefined": lambda v: _not(_defined(v)),
    "none": _is_none,
    "string": lambda v: _kind(v) == "str",
    "number": lambda v: _kind(v) == "int",
    "iterable": lambda v: _kind(v) in ("str", "list", "messages", "strs"),
    "mapping": lambda v: _kind(v) == "message",
    "true": lambda v: _equal(v, True),
    "false": lambda v: _equal(v, False),
}


# ---- reading ----

_TAG = re.compile(
    r"""\{\#(?P<c0>[-+]?).*?(?P<c1>[-+]?)\#\}
    |\{%(?P<s0>[-+]?)(?P<do>(?:'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|[^'"])*?)(?P<s1>[-+]?)%\}
    |\{\{(?P<p0>[-+]?)(?P<print>(?:'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|[^'"])*?)(?P<p1>[-+]?)\}\}""",
    re.S | re.X,
)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>//|==|!=|<=|>=|[-+*%~<>()\[\].,:|=]))""", re.S)


def pieces(source: str) -> list[tuple[str, str]]:
    """(text | print | do, content): tags with the text between them.

    Marks cut all white space beside them; otherwise a statement or comment takes the blanks before it that begin its line, and one line end after it.
    """
    source = source.replace("\r\n", "\n").removesuffix("\n")
    out, at, cut_all, cut_line = [], 0, False, False
    for m in _TAG.finditer(source):
        kind = next(k for k in "csp" if m[f"{k}0"] is not None)
        before, after = m[f"{kind}0"], m[f"{kind}1"]
        between = _trimmed(source[at : m.start()], cut_all, cut_line)
        line = source.rfind("\n", 0, m.start()) + 1
        if before == "-":
            between = between.rstrip()
        elif kind != "p" and before != "+" and line >= at and not source[line : m.start()].strip(" \t"):
            between = between.rstrip(" \t")
        out.append(("text", between))
        if kind != "c":
            name = "do" if kind == "s" else "print"
            out.append((name, m[name].strip()))
        at, cut_all, cut_line = m.end(), after == "-", kind != "p" and after != "+"
    out.append(("text", _trimmed(source[at:], cut_all, cut_line)))
    return [p for p in out if p != ("text", "")]


def _trimmed(s: str, cut_all: bool, cut_line: bool) -> str:
    return s.lstrip() if cut_all else s.removeprefix("\n") if cut_line else s


class _Reader:
    """Tokens of one tag, and the expressions that they make; ``e`` is what they are evaluated in."""

    def __init__(self, body: str):
        self.tokens, at = [], 0
        while body[at:].strip():
            m = _TOKEN.match(body, at)
            if not m:
                raise TemplateError(f"cannot read {body[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, k: int = 0) -> str | None:
        t = self.tokens[self.at + k] if self.at + k < len(self.tokens) else (None, None)
        return t[1] if t[0] in ("op", "name") else None

    def take(self, *wanted: str) -> bool:
        if self.peek() in wanted:
            self.at += 1
            return True
        return False

    def need(self, what: str) -> None:
        if not self.take(what):
            raise TemplateError(f"{what} is missing before {self.tokens[self.at :]}")

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError(f"a name is missing before {self.tokens[self.at :]}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at :]} is not understood")

    # each gives a function of the names that are known

    def expression(self) -> Callable:
        value = self.either()
        while self.take("if"):
            test = self.either()
            other = self.expression() if self.take("else") else lambda e: UNDEFINED
            value = lambda e, v=value, t=test, o=other: choose(truth(t(e)), v(e), o(e))
        return value

    def either(self) -> Callable:
        a = self.both()
        while self.take("or"):
            b = self.both()
            a = lambda e, a=a, b=b: (lambda x: choose(truth(x), x, b(e)))(a(e))
        return a

    def both(self) -> Callable:
        a = self.negated()
        while self.take("and"):
            b = self.negated()
            a = lambda e, a=a, b=b: (lambda x: choose(truth(x), b(e), x))(a(e))
        return a

    def negated(self) -> Callable:
        if self.take("not"):
            v = self.negated()
            return lambda e: _not(v(e))
        return self.compared()

    def compared(self) -> Callable:
        a = self.binary(0)
        while True:
            if self.peek() == "not" and self.peek(1) == "in":
                self.at += 2
                op = "not in"
            elif self.peek() in ("==", "!=", "<", ">", "<=", ">=", "in"):
                op = self.peek()
                self.at += 1
            else:
                return a
            b = self.binary(0)
            a = lambda e, a=a, b=b, f=OPERATORS[op]: _each(f, a(e), b(e))

    def binary(self, level: int) -> Callable:
        ops = (("+", "-"), ("~",), ("*", "//", "%"))
        if level == len(ops):
            return self.unary()
        a = self.binary(level + 1)
        while self.peek() in ops[level]:
            op = self.peek()
            self.at += 1
            b = self.binary(level + 1)
            a = lambda e, a=a, b=b, f=OPERATORS[op]: _each(f, a(e), b(e))
        return a

    def unary(self) -> Callable:
        if self.take("-"):
            v = self.unary()
            return lambda e: _each(OPERATORS["-"], 0, v(e))
        return self.postfix(self.primary())

    def primary(self) -> Callable:
        if self.take("("):
            v = self.expression()
            self.need(")")
            return v
        if self.take("["):
            items = self.arguments("]")
            return lambda e: [i(e) for i in items]
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, token = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            known = token[1:-1].encode("ascii", "backslashreplace").decode("unicode-escape")  # line ends may stand in it as they are
        elif kind == "int":
            known = int(token)
        elif kind == "name" and token.lower() in ("true", "false", "none"):
            known = {"true": True, "false": False, "none": None}[token.lower()]
        elif kind == "name":
            return lambda e: e.get(token, UNDEFINED)
        else:
            raise TemplateError(f"{token} is not understood")
        return lambda e: known

    def arguments(self, close: str) -> list[Callable]:
        out = []
        while not self.take(close):
            out.append(self.expression())
            if not self.take(",") and self.peek() != close:
                raise TemplateError(f"{close} is missing")
        return out

    def postfix(self, v: Callable) -> Callable:
        while True:
            if self.take("."):
                key = self.name()
                if self.take("("):
                    args = self.arguments(")")
                    if key not in TEXT_CALLS:
                        raise TemplateError(f"the method {key} is not known")
                    v = lambda e, v=v, f=TEXT_CALLS[key], args=args: _each(f, v(e), *[a(e) for a in args])
                else:
                    v = lambda e, v=v, key=key: _each(lambda x: _item(x, key), v(e))
            elif self.take("["):
                v = self.subscript(v)
            elif self.take("("):
                args = self.arguments(")")
                v = lambda e, v=v, args=args: v(e)(*[a(e) for a in args]) if callable(v(e)) else _no_call()
            elif self.take("|"):
                f, args = FILTERS.get(name := self.name()), self.arguments(")") if self.take("(") else []
                if f is None:
                    raise TemplateError(f"the filter {name} is not known")
                v = lambda e, v=v, f=f, args=args: _each(f, v(e), *[a(e) for a in args])
            elif self.take("is"):
                positive = not self.take("not")
                f = TESTS.get(name := self.name())
                if f is None:
                    raise TemplateError(f"the test {name} is not known")
                v = lambda e, v=v, f=f, p=positive: (lambda x: x if p else _not(x))(_each(f, v(e)))
            else:
                return v

    def subscript(self, v: Callable) -> Callable:
        none = lambda e: None
        low = none if self.peek() == ":" else self.expression()
        if not self.take(":"):
            self.need("]")
            return lambda e: _each(_item, v(e), low(e))
        high = none if self.peek() == "]" else self.expression()
        self.need("]")
        return lambda e: _each(lambda x: _slice(x, low(e), high(e)), v(e))


def _no_call() -> Any:
    raise TemplateError("only raise_exception and string methods can be called")


# ---- statements ----


@dataclass
class _For:
    name: str
    over: Callable
    only: Callable | None
    body: list
    otherwise: list


class _Program:
    """Statements of a template as nested lists: str, ("print", f), ("set", name, f), ("if", [(f, body), …]) and _For."""

    def __init__(self, source: str):
        self.pieces, self.at = pieces(source), 0
        self.body = self.block()
        if self.at < len(self.pieces):
            raise TemplateError(f"{self.pieces[self.at][1]!r} closes nothing")

    def block(self, *ends: str) -> list:
        out = []
        while self.at < len(self.pieces):
            kind, body = self.pieces[self.at]
            word = body.split(None, 1)[0] if kind == "do" and body else ""
            if word in ("endfor", "endif", "elif", "else"):
                if word in ends or not ends:
                    return out
                raise TemplateError(f"{word} is not expected")
            self.at += 1
            if kind == "text":
                out.append(body)
            elif kind == "print":
                out.append(("print", self.whole(body)))
            elif word == "set":
                out.append(self.assigned(body[3:]))
            elif word == "if":
                out.append(self.conditional(body[2:]))
            elif word == "for":
                out.append(self.loop(body[3:]))
            elif word not in ("generation", "endgeneration"):  # marks for training, without text
                raise TemplateError(f"the statement {word!r} is not known")
        if ends:
            raise TemplateError(f"{ends[0]} is missing")
        return out

    @staticmethod
    def whole(body: str) -> Callable:
        r = _Reader(body)
        v = r.expression()
        r.end()
        return v

    def assigned(self, body: str) -> tuple:
        r = _Reader(body)
        name = r.name()
        if not r.take("="):
            raise TemplateError("only plain names can be set")
        v = r.expression()
        r.end()
        return "set", name, v

    def conditional(self, test: str) -> tuple:
        cases = []
        while True:
            cases.append((self.whole(test), self.block("elif", "else", "endif")))
            word, _, test = self.pieces[self.at][1].partition(" ")
            self.at += 1
            if word == "else":
                cases.append((lambda e: True, self.block("endif")))
                self.at += 1
            if word != "elif":
                return "if", cases

    def loop(self, body: str) -> _For:
        r = _Reader(body)
        name = r.name()
        r.need("in")
        over = r.either()
        only = r.expression() if r.take("if") else None
        r.end()
        inner = self.block("else", "endfor")
        otherwise = []
        if self.pieces[self.at][1] == "else":
            self.at += 1
            otherwise = self.block("endfor")
        self.at += 1
        return _For(name, over, only, inner, otherwise)


def _run(body: list, e: dict) -> Any:
    """The text of some statements; ``e`` gets what they set."""
    out: list[Any] = []
    for s in body:
        if isinstance(s, str):
            out.append(s)
        elif isinstance(s, _For):
            out.append(_looped(s, e))
        elif s[0] == "print":
            out.append(_merged(text(s[1](e))))
        elif s[0] == "set":
            e[s[1]] = s[2](e)
        else:
            out.append(_conditional(s[1], e))
    return joined(out)


def _merged(v: Any) -> Any:
    """One column of a choice between texts."""
    return Col("str", F.when(v.cond, _column(_merged(v.a))).otherwise(_column(_merged(v.b)))) if isinstance(v, Choice) else v


def _conditional(cases: list, e: dict) -> Any:
    if not cases:
        return ""
    cond = truth(cases[0][0](e))
    if isinstance(cond, bool):
        return _run(cases[0][1], e) if cond else _conditional(cases[1:], e)
    yes, no = dict(e), dict(e)
    a, b = _run(cases[0][1], yes), _conditional(cases[1:], no)
    for k in yes.keys() | no.keys():
        x, y = yes.get(k, UNDEFINED), no.get(k, UNDEFINED)
        if x is not e.get(k, UNDEFINED) or y is not e.get(k, UNDEFINED):
            e[k] = choose(cond, x, y)
    return a if isinstance(a, str) and a == b else Col("str", F.when(cond, _column(a)).otherwise(_column(b)))


def _looped(s: _For, e: dict) -> Any:
    """A loop over messages is a transform of the array; what its body sets ends with each turn."""
    over = s.over(e)
    if isinstance(over, list):  # known beforehand
        items = [x for x in over if s.only is None or truth(s.only({**e, s.name: x})) is True]
        parts = []
        for i, x in enumerate(items):
            about = {"index0": i, "index": i + 1, "first": i == 0, "last": i == len(items) - 1, "length": len(items)}
            parts.append(_run(s.body, {**e, s.name: x, "loop": _Loop(about)}))
        return joined(parts) if items else _run(s.otherwise, dict(e))
    if _kind(over) not in ("messages", "strs"):
        raise TemplateError(f"a loop over {_kind(over)}")
    kind = "message" if over.kind == "messages" else "str"
    items = over.column
    if s.only is not None:
        items = F.filter(items, lambda x: _bool(truth(s.only({**e, s.name: Col(kind, x)}))))
    n = F.size(items)

    def turn(x: Column, i: Column) -> Column:
        about = {"index0": Col("int", i), "index": Col("int", i + 1), "revindex": Col("int", n - i), "revindex0": Col("int", n - i - 1)}
        about |= {"first": Col("bool", i == 0), "last": Col("bool", i == n - 1), "length": Col("int", n)}
        about |= {"previtem": Col(kind, F.when(i > 0, F.get(items, i - 1))), "nextitem": Col(kind, F.get(items, i + 1))}
        return _column(_run(s.body, {**e, s.name: Col(kind, x), "loop": _Loop(about)}))

    done = F.array_join(F.transform(items, turn), "")
    if s.otherwise:
        done = F.when(n > 0, done).otherwise(_column(_run(s.otherwise, dict(e))))
    return Col("str", done)


def _raise(message: Any) -> Any:
    return Col("str", F.raise_error(_column(text(message))).cast("string"))


class ProgramTemplate:
    """A chat template that is a program; used wherever a ``ChatTemplate`` is.

    ``names`` are what the template may use besides messages and add_generation_prompt, such as tokens.  A message has a role and
    content; null content prints nothing.  A conversation that the template refuses with raise_exception fails the query.
    """

    def __init__(self, source: str, eos: str = "</s>", bos: str = "<s>", **names: Any):
        self.source, self.program = source, _Program(source)
        self.names = {"eos_token": eos, "bos_token": bos, "unk_token": "<unk>", "pad_token": eos, "raise_exception": _raise, **names}

    def render(self, m: Column, generation: bool = False) -> Column:
        return _column(_run(self.program.body, {**self.names, "messages": Col("messages", m), "add_generation_prompt": generation}))
