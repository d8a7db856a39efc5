"""Row filters written as text, compiled to a Column.

Grammar, loosest first: ``a | b``, ``a & b``, ``!a``, parentheses, comparisons (== = != ~= > >= < <=), missing(x), inrange(x, a, b),
inlist(x, a, ...), real(x), string(x), numbers, quoted strings, names, and ``.`` for missing. Comparisons with null
remove the row, under ``!`` too. With ``extensions`` the functions mod, ceil, floor and round are accepted as well.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import UnsupportedExpression

_TOKEN = re.compile(r"""\s*(?:(?P<string>"[^"]*"|'[^']*')|(?P<number>(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|~=|>=|<=|[=<>&|!(),.+*/-]))""")
_COMPARE = {
    "==": lambda a, b: a == b,
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "~=": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}
_MISSING = object()


class _Parser:
    def __init__(self, text: str, columns: list[str] | None, extensions: bool):
        self.text, self.columns, self.extensions = text, columns, extensions
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while at < len(text.rstrip()):
            m = _TOKEN.match(text, at)
            if not m:
                raise UnsupportedExpression(text)
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def fail(self):
        raise UnsupportedExpression(self.text)

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] == "op" else None

    def take(self, op: str) -> bool:
        if self.peek() == op:
            self.at += 1
            return True
        return False

    def expect(self, op: str) -> None:
        if not self.take(op):
            self.fail()

    def whole(self) -> Column:
        found = self.either()
        if self.at != len(self.tokens):
            self.fail()
        return found

    def either(self) -> Column:
        found = self.both()
        while self.take("|"):
            found = found | self.both()
        return found

    def both(self) -> Column:
        found = self.inverted()
        while self.take("&"):
            found = found & self.inverted()
        return found

    def inverted(self) -> Column:
        if self.take("!"):
            return ~self.inverted()
        if self.peek() == "(":
            back = self.at
            self.take("(")
            try:  # a parenthesis may hold a condition or an operand
                found = self.either()
                self.expect(")")
                if self.peek() not in _COMPARE:
                    return found
            except UnsupportedExpression:
                pass
            self.at = back
        return self.atom()

    def atom(self) -> Column:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        if kind == "name" and text in ("missing", "inrange", "inlist") and self.tokens[self.at + 1 : self.at + 2] == [("op", "(")]:
            self.at += 2
            args = [self.operand()]
            while self.take(","):
                args.append(self.operand())
            self.expect(")")
            if any(a is _MISSING for a in args):
                self.fail()
            if text == "missing" and len(args) == 1:
                return args[0].isNull()
            if text == "inrange" and len(args) == 3:
                return args[0].between(args[1], args[2])
            if text == "inlist" and len(args) >= 2:
                return args[0].isin(*args[1:])
            self.fail()
        left = self.operand()
        op = self.peek()
        if op not in _COMPARE:
            self.fail()
        self.at += 1
        right = self.operand()
        if left is _MISSING or right is _MISSING:
            other = right if left is _MISSING else left
            if other is _MISSING or op not in ("==", "=", "!=", "~="):
                self.fail()
            return other.isNull() if op in ("==", "=") else other.isNotNull()
        return _COMPARE[op](left, right)

    def operand(self):
        if self.at >= len(self.tokens):
            self.fail()
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return F.lit(text[1:-1])
        if kind == "number":
            return F.lit(int(text) if text.isdigit() else float(text))
        if text == "-":
            return -self.operand()
        if text == ".":
            return _MISSING
        if text == "(":
            found = self.operand()
            self.expect(")")
            return found
        if kind != "name":
            self.fail()
        if not self.take("("):
            if self.columns is not None and text not in self.columns:
                self.fail()
            return F.col(text)
        args = [self.operand()]
        while self.take(","):
            args.append(self.operand())
        self.expect(")")
        return self.call(text, args)

    def call(self, name: str, args: list) -> Column:
        if any(a is _MISSING for a in args):
            self.fail()
        if name == "real" and len(args) == 1:
            return args[0].try_cast("double")
        if name == "string" and len(args) == 1:
            return args[0].cast("string")
        if self.extensions:
            if name == "mod" and len(args) == 2:
                return F.pmod(*args)
            if name in ("ceil", "floor") and len(args) == 1:
                return getattr(F, name)(args[0])
            if name == "round" and len(args) == 1:
                return F.round(args[0])
        return self.fail()


def compile_filter(text: str, columns: list[str] | None = None, *, extensions: bool = False) -> Column:
    """Column of a row filter; UnsupportedExpression for anything else. ``columns``: the names it may use."""
    if not text.strip():
        raise UnsupportedExpression(text)
    return _Parser(text, columns, extensions).whole()


def filter_rows(df, text: str | Column | None, *, extensions: bool = False):
    """Rows of ``df`` for which the filter, as text or as a Column, is true."""
    if text is None:
        return df
    return df.filter(compile_filter(text, df.columns, extensions=extensions) if isinstance(text, str) else text)
