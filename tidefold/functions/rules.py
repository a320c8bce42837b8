"""The record filter language, compiled to expressions over a record's document.

Grammar: ``or || and && not ! == != < <= > >= in contains startsWith endsWith matches + - * / % ?? ?:``,
literals (numbers, strings, true, false, nil, lists), ``#name`` and member access, ``len(x)``.
Every node yields three columns: its value, whether evaluation failed, and its type.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .records import text_of

_TOKEN = re.compile(
    r"""\s*(?:(?P<number>\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)|(?P<string>"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*'|`[^`]*`)
    |(?P<name>\#?[A-Za-z_$][\w$]*)|(?P<op>\|\||&&|==|!=|<=|>=|\?\?|\?\.|[-+*/%<>!()\[\],.?:]))""",
    re.X,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"and": "&&", "or": "||", "not": "!"}


class RuleError(ValueError):
    """A rule that doesn't compile."""


@dataclass
class Node:
    """``kind`` is bool, number, string, list, nil, or any: a document's value, a JSON text, null if it is missing."""

    kind: str
    value: Column
    failed: Column
    items: tuple = ()


def tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(source.rstrip()):
        m = _TOKEN.match(source, at)
        if not m:
            raise RuleError(f"unexpected character at {at} in {source!r}")
        kind = m.lastgroup or ""
        text = m[kind]
        out.append(("op", _WORDS[text]) if kind == "name" and text in _WORDS else (kind, text))
        at = m.end()
    return [*out, ("end", "")]


class Compiler:
    LEVELS = (("||",), ("&&",), ("==", "!=", "<", "<=", ">", ">=", "in", "contains", "startsWith", "endsWith", "matches"), ("??",), ("+", "-"), ("*", "/", "%"))

    def __init__(self, source: str, doc: Column) -> None:
        self.source, self.doc, self.tokens, self.at = source, doc, tokens(source), 0

    def compile(self) -> Node:
        node = self.ternary()
        if self.tokens[self.at][0] != "end":
            raise RuleError(f"unexpected {self.tokens[self.at][1]!r} in {self.source!r}")
        if node.kind not in ("bool", "any"):
            raise RuleError(f"{self.source!r} must be bool, it is {node.kind}")
        return node

    def take(self, *texts: str) -> str | None:
        kind, text = self.tokens[self.at]
        if kind in ("op", "name") and text in texts:
            self.at += 1
            return text
        return None

    def need(self, text: str) -> None:
        if not self.take(text):
            raise RuleError(f"expected {text!r} in {self.source!r}")

    def ternary(self) -> Node:
        test = self.binary(0)
        if not self.take("?"):
            return test
        yes = self.ternary()
        self.need(":")
        no = self.ternary()
        ok, failed = _truth(test)
        if yes.kind != no.kind:
            yes, no = _json(yes), _json(no)
        return Node(yes.kind, F.when(ok, yes.value).otherwise(no.value), failed | F.when(ok, yes.failed).otherwise(no.failed))

    def binary(self, level: int) -> Node:
        if level == len(self.LEVELS):
            return self.unary()
        left = self.binary(level + 1)
        while True:
            negated = False
            if level == 2 and self.tokens[self.at] == ("op", "!") and self.tokens[self.at + 1][1] in ("in", "contains", "startsWith", "endsWith", "matches"):
                self.at += 1
                negated = True
            op = self.take(*self.LEVELS[level])
            if not op:
                return left
            left = combine(op, left, self.binary(level + 1), self.source)
            if negated:
                left = Node("bool", ~left.value, left.failed)

    def unary(self) -> Node:
        if self.take("!"):
            ok, failed = _truth(self.unary())
            return Node("bool", ~ok, failed)
        if self.take("-"):
            n = _number(self.unary())
            return Node("number", -n.value, n.failed)
        return self.postfix()

    def postfix(self) -> Node:
        kind, text = self.tokens[self.at]
        self.at += 1
        none = F.lit(False)
        if kind == "number":
            return Node("number", F.lit(float(text)), none)
        if kind == "string":
            body = text[1:-1] if text[0] == "`" else re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1])
            return Node("string", F.lit(body), none)
        if text == "(":
            node = self.ternary()
            self.need(")")
            return node
        if text == "[":
            items = []
            while not self.take("]"):
                items.append(self.ternary())
                if not self.take(","):
                    self.need("]")
                    break
            return Node("list", F.lit(None), none, tuple(items))
        if kind != "name":
            raise RuleError(f"unexpected {text or 'end'!r} in {self.source!r}")
        if text in ("true", "false"):
            return Node("bool", F.lit(text == "true"), none)
        if text in ("nil", "null"):
            return Node("nil", F.lit(None).cast("string"), none)
        if text == "len" and self.take("("):
            arg = self.ternary()
            self.need(")")
            s = arg.value if arg.kind == "string" else text_of(arg.value)
            size = F.coalesce(F.length(s), F.json_array_length(arg.value) if arg.kind == "any" else F.lit(None))
            return Node("number", size.cast("double"), arg.failed | size.isNull())
        value = F.try_element_at(self.doc, F.lit(text))
        if text == "properties":  # properties are promoted to the root
            value = None
        while self.take(".", "?."):
            kind, name = self.tokens[self.at]
            if kind != "name":
                raise RuleError(f"expected a name after '.' in {self.source!r}")
            self.at += 1
            value = F.try_element_at(self.doc, F.lit(name)) if value is None else _member(value, name)
        if value is None:
            value = F.try_element_at(self.doc, F.lit(text))
        return Node("any", value, none)


def _member(value: Column, name: str) -> Column:
    return F.try_element_at(F.from_json(value, "map<string,string>"), F.lit(name))


def _truth(n: Node) -> tuple[Column, Column]:
    if n.kind == "bool":
        return n.value, n.failed
    if n.kind != "any":
        raise RuleError(f"{n.kind} used as bool")
    is_bool = F.coalesce(n.value.isin("true", "false"), F.lit(False))
    return F.coalesce(n.value == "true", F.lit(False)), n.failed | ~is_bool


def _number(n: Node) -> Node:
    if n.kind == "number":
        return n
    if n.kind != "any":
        raise RuleError(f"{n.kind} used as number")
    value = F.when(n.value.rlike(r"^-?\d"), n.value.try_cast("double"))
    return Node("number", value, n.failed | value.isNull())


def _string(n: Node) -> Node:
    if n.kind == "string":
        return n
    if n.kind != "any":
        raise RuleError(f"{n.kind} used as string")
    value = text_of(n.value)
    return Node("string", value, n.failed | value.isNull())


def _json(n: Node) -> Node:
    from .records import json_of

    value = {"string": lambda: json_of(n.value), "number": lambda: n.value.cast("string"), "bool": lambda: n.value.cast("string")}
    return n if n.kind == "any" else Node("any", value.get(n.kind, lambda: n.value)(), n.failed)


def _equal(a: Node, b: Node) -> Column:
    """Equality that is false, not null, where a side is missing."""
    if "nil" in (a.kind, b.kind):
        other = b if a.kind == "nil" else a
        return F.lit(True) if other.kind == "nil" else F.coalesce(other.value == "null", F.lit(True)) if other.kind == "any" else F.lit(False)
    kinds = {a.kind, b.kind} - {"any"}
    if not kinds:
        return (_number(a).value.eqNullSafe(_number(b).value) & _number(a).value.isNotNull()) | a.value.eqNullSafe(b.value)
    if len(kinds) > 1:
        return F.lit(False)
    kind = kinds.pop()
    if kind == "number":
        return F.coalesce(_number(a).value == _number(b).value, F.lit(False))
    if kind == "string":
        return F.coalesce(_string(a).value == _string(b).value, F.lit(False))
    if kind == "bool":
        sides = [n.value if n.kind == "bool" else F.when(n.value.isin("true", "false"), n.value == "true") for n in (a, b)]
        return F.coalesce(sides[0] == sides[1], F.lit(False))
    raise RuleError("lists can't be compared")


def combine(op: str, a: Node, b: Node, source: str) -> Node:
    failed = a.failed | b.failed
    if op in ("&&", "||"):
        (x, fx), (y, fy) = _truth(a), _truth(b)
        if op == "&&":  # the right side isn't evaluated if the left is false
            return Node("bool", x & y, fx | (x & fy))
        return Node("bool", x | y, fx | (~x & fy))
    if op in ("==", "!="):
        same = _equal(a, b)
        return Node("bool", same if op == "==" else ~same, failed)
    if op == "in":
        if b.kind == "list":
            hit = F.lit(False)
            for item in b.items:
                hit = hit | _equal(a, item)
            return Node("bool", hit, a.failed)
        hit = F.array_contains(F.from_json(b.value, "array<string>"), F.coalesce(text_of(a.value) if a.kind == "any" else a.value.cast("string"), F.lit("")))
        return Node("bool", F.coalesce(hit, F.lit(False)), failed | hit.isNull())
    if op in ("<", "<=", ">", ">="):
        if "string" in (a.kind, b.kind):
            x, y = _string(a), _string(b)
        else:
            x, y = _number(a), _number(b)
        test = {"<": x.value < y.value, "<=": x.value <= y.value, ">": x.value > y.value, ">=": x.value >= y.value}[op]
        return Node("bool", F.coalesce(test, F.lit(False)), x.failed | y.failed)
    if op in ("contains", "startsWith", "endsWith", "matches"):
        x, y = _string(a), _string(b)
        test = {"contains": x.value.contains, "startsWith": x.value.startswith, "endsWith": x.value.endswith, "matches": lambda p: F.regexp(x.value, p)}[op](y.value)
        return Node("bool", F.coalesce(test, F.lit(False)), x.failed | y.failed)
    if op == "??":
        if a.kind != b.kind:
            a, b = _json(a), _json(b)
        return Node(a.kind, F.coalesce(F.when(a.value != "null", a.value) if a.kind == "any" else a.value, b.value), failed)
    if op == "+" and "string" in (a.kind, b.kind):
        x, y = _string(a), _string(b)
        return Node("string", F.concat(x.value, y.value), x.failed | y.failed)
    x, y = _number(a), _number(b)
    value = {"+": x.value + y.value, "-": x.value - y.value, "*": x.value * y.value, "/": F.try_divide(x.value, y.value), "%": F.try_mod(x.value, y.value)}[op]
    return Node("number", value, x.failed | y.failed | value.isNull())


def compile_rule(source: str, doc: Column) -> tuple[Column, Column]:
    """(matched, failed): a failed evaluation isn't a match."""
    ok, failed = _truth(Compiler(source, doc).compile())
    failed = F.coalesce(failed, F.lit(True))
    return ~failed & F.coalesce(ok, F.lit(False)), failed


def compile_rules(rules: list[str], side: str, doc: Column) -> list[tuple[Column, Column]]:
    out = []
    for i, rule in enumerate(rules):
        try:
            out.append(compile_rule(rule, doc))
        except RuleError as e:
            raise RuleError(f"{side}[{i}] {rule!r}: {e}") from e
    return out


def keep_record(include: list[str], exclude: list[str], doc: Column) -> tuple[Column, Column]:
    """(kept, failed): any include matches, or there is none; then no exclude does.

    ``failed`` tells whether a rule that was reached failed: rules after the first match aren't.
    """
    kept, failed, open_ = F.lit(not include), F.lit(False), F.lit(True)
    for matched, bad in compile_rules(include, "include", doc):
        failed, kept, open_ = failed | (open_ & bad), kept | matched, open_ & ~matched
    open_ = kept
    for matched, bad in compile_rules(exclude, "exclude", doc):
        failed, kept, open_ = failed | (open_ & bad), kept & ~matched, open_ & ~matched
    return kept, failed
