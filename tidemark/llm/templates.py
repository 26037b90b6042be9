"""A small template language, compiled to Python closures.

Text, ``{{ expression }}``, ``{# remark #}`` and the statements ``for x in e``,
``if e`` / ``elif e`` / ``else``, ``set x = e`` and ``generation``, each with its
``end...``. A minus inside a delimiter strips white space on that side. Expressions
know literals, names, ``.name`` and ``[e]`` on mappings and lists, comparisons,
``in``, ``and or not``, ``+ - * ~``, ``a if c else b`` and filters ``x | name``.

Nothing else can be reached: names come from the variables given, ``.name`` looks up
keys of mappings only, filters come from a fixed table, and no Python code is evaluated.

A template is parsed to a tree, constants are folded, and every node becomes a closure.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator
from typing import Any

DELIMITER = re.compile(r"(\{\{-?|\{%-?|\{#)")
TOKEN = re.compile(r"""\s*(?:(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<sign>==|!=|<=|>=|[-+*~<>|.,()\[\]=]))""")
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
SIGNS = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "+": operator.add, "-": operator.sub, "*": operator.mul, "~": lambda a, b: shown(a) + shown(b),
    "in": lambda a, b: a in b, "not in": lambda a, b: a not in b,
}
FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda x: shown(x).strip(),
    "upper": lambda x: shown(x).upper(),
    "lower": lambda x: shown(x).lower(),
    "length": len,
    "string": lambda x: shown(x),
}


class TemplateError(ValueError):
    """A template that can't be parsed, or one that reaches for what it may not."""


class Missing:
    """What an unknown name or key stands for: empty and false."""

    def __str__(self) -> str:
        return ""

    def __bool__(self) -> bool:
        return False


MISSING = Missing()


def shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def lookup(base: Any, key: Any) -> Any:
    if isinstance(base, dict):
        return base.get(key, MISSING)
    if isinstance(base, (list, tuple, str)) and isinstance(key, int):
        return base[key] if -len(base) <= key < len(base) else MISSING
    return MISSING


class Expression:
    """Recursive descent over one expression; the tree is made of tuples led by their kind."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.strip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((found.lastgroup or "", found[found.lastgroup or 0]))
            at = found.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *values: str) -> str | None:
        kind, value = self.peek()
        if kind in ("sign", "name") and value in values:
            self.at += 1
            return value
        return None

    def need(self, *values: str) -> str:
        found = self.take(*values)
        if found is None:
            raise TemplateError(f"{' or '.join(values)} wanted, {self.peek()[1]!r} found")
        return found

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "name":
            raise TemplateError(f"a name wanted, {value!r} found")
        self.at += 1
        return value

    def whole(self) -> tuple:
        tree = self.choice()
        if self.peek()[0] != "end":
            raise TemplateError(f"{self.peek()[1]!r} left over")
        return tree

    def choice(self) -> tuple:
        tree = self.either()
        if self.take("if"):
            condition = self.either()
            self.need("else")
            return ("choice", condition, tree, self.choice())
        return tree

    def either(self) -> tuple:
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.added()
        while True:
            if sign := self.take("==", "!=", "<", "<=", ">", ">=", "in"):
                tree = ("sign", sign, tree, self.added())
            elif self.peek() == ("name", "not") and self.at + 1 < len(self.tokens) and self.tokens[self.at + 1] == ("name", "in"):
                self.at += 2
                tree = ("sign", "not in", tree, self.added())
            else:
                return tree

    def added(self) -> tuple:
        tree = self.multiplied()
        while sign := self.take("+", "-", "~"):
            tree = ("sign", sign, tree, self.multiplied())
        return tree

    def multiplied(self) -> tuple:
        tree = self.filtered()
        while self.take("*"):
            tree = ("sign", "*", tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.reached()
        while self.take("|"):
            tree = ("filter", self.name(), tree)
        return tree

    def reached(self) -> tuple:
        tree = self.atom()
        while sign := self.take(".", "["):
            if sign == ".":
                tree = ("get", tree, ("constant", self.name()))
            else:
                tree = ("get", tree, self.choice())
                self.need("]")
        return tree

    def atom(self) -> tuple:
        if self.take("("):
            tree = self.choice()
            self.need(")")
            return tree
        if self.take("-"):
            return ("sign", "-", ("constant", 0), self.atom())
        kind, value = self.peek()
        self.at += 1
        if kind == "number":
            return ("constant", int(value))
        if kind == "string":
            return ("constant", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "name":
            constants = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
            return ("constant", constants[value]) if value in constants else ("name", value)
        raise TemplateError(f"an expression wanted, {value!r} found")


def parts(source: str) -> Iterator[tuple[str, str]]:
    """Text, expressions and statements of a template, in order, white space stripped as told."""
    closers = {"{{": "}}", "{%": "%}", "{#": "#}"}
    at, strip = 0, False
    while at <= len(source):
        found = DELIMITER.search(source, at)
        text = source[at : found.start() if found else len(source)]
        text = text.lstrip() if strip else text
        if found is None:
            yield "text", text
            return
        yield "text", text.rstrip() if found[0].endswith("-") else text
        closer = closers[found[0][:2]]
        end = source.find(closer, found.end())
        if end < 0:
            raise TemplateError(f"{found[0]} is not closed")
        body = source[found.end() : end]
        strip = body.endswith("-")
        if found[0] != "{#":
            yield ("show" if found[0].startswith("{{") else "statement"), body[:-1] if strip else body
        at = end + 2


def parse(source: str) -> list[tuple]:
    """The template's tree: a list of nodes."""
    stream = parts(source)

    def block(*stops: str) -> tuple[list[tuple], str, str]:
        nodes: list[tuple] = []
        for kind, body in stream:
            if kind == "text":
                nodes.append(("text", body))
                continue
            if kind == "show":
                nodes.append(("show", Expression(body).whole()))
                continue
            word, _, rest = body.strip().partition(" ")
            if word in stops:
                return nodes, word, rest
            if word == "for":
                target, _, over = rest.partition(" in ")
                if not re.fullmatch(r"[A-Za-z_]\w*", target.strip()):
                    raise TemplateError(f"can't loop with {target!r}")
                inner, _, _ = block("endfor")
                nodes.append(("for", target.strip(), Expression(over).whole(), inner))
            elif word == "if":
                branches = []
                condition = rest
                while True:
                    inner, stop, rest = block("elif", "else", "endif")
                    branches.append((Expression(condition).whole(), inner))
                    condition = rest
                    if stop != "elif":
                        break
                last = block("endif")[0] if stop == "else" else []
                nodes.append(("if", branches, last))
            elif word == "set":
                target, _, value = rest.partition("=")
                nodes.append(("set", target.strip(), Expression(value).whole()))
            elif word == "generation":
                nodes.append(("generation", block("endgeneration")[0]))
            else:
                raise TemplateError(f"unknown statement {word!r}")
        if stops:
            raise TemplateError(f"{' or '.join(stops)} is missing")
        return nodes, "", ""

    return block()[0]


def fold(tree: tuple) -> tuple:
    """The expression with constant parts worked out."""
    kind, rest = tree[0], tree[1:]
    if kind in ("constant", "name"):
        return tree
    made = (kind, *[fold(x) if isinstance(x, tuple) else x for x in rest])
    known = all(x[0] == "constant" for x in made[1:] if isinstance(x, tuple))
    if kind == "choice" and made[1][0] == "constant":
        return made[2] if made[1][1] else made[3]
    if kind in ("and", "or") and made[1][0] == "constant":
        return made[2] if bool(made[1][1]) == (kind == "and") else made[1]
    if known and kind in ("sign", "not"):
        try:
            return ("constant", evaluator(made, {})({}))
        except TypeError as error:
            raise TemplateError(str(error)) from None
    return made


def fold_block(nodes: list[tuple]) -> list[tuple]:
    """The block with constants worked out, dead branches gone and texts joined."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in nodes:
        if node[0] == "show":
            tree = fold(node[1])
            add(("text", shown(tree[1])) if tree[0] == "constant" else ("show", tree))
        elif node[0] == "set":
            add(("set", node[1], fold(node[2])))
        elif node[0] == "for":
            add(("for", node[1], fold(node[2]), fold_block(node[3])))
        elif node[0] == "generation":
            add(("generation", fold_block(node[1])))
        elif node[0] == "if":
            branches, last = [], fold_block(node[2])
            for condition, inner in node[1]:
                tree = fold(condition)
                if tree[0] == "constant" and not tree[1]:
                    continue
                if tree[0] == "constant":
                    last = fold_block(inner)
                    break
                branches.append((tree, fold_block(inner)))
            if branches:
                add(("if", branches, last))
            else:
                for inside in last:
                    add(inside)
        else:
            add(node)
    return out


def evaluator(tree: tuple, filters: dict[str, Callable]) -> Callable[[dict], Any]:
    kind = tree[0]
    if kind == "constant":
        return lambda scope, value=tree[1]: value
    if kind == "name":
        return lambda scope, name=tree[1]: scope.get(name, MISSING)
    inner = [evaluator(x, filters) for x in tree[1:] if isinstance(x, tuple)]
    if kind == "get":
        return lambda scope: lookup(inner[0](scope), inner[1](scope))
    if kind == "not":
        return lambda scope: not inner[0](scope)
    if kind == "and":
        return lambda scope: inner[0](scope) and inner[1](scope)
    if kind == "or":
        return lambda scope: inner[0](scope) or inner[1](scope)
    if kind == "choice":
        return lambda scope: inner[1](scope) if inner[0](scope) else inner[2](scope)
    if kind == "filter":
        if tree[1] not in filters:
            raise TemplateError(f"unknown filter {tree[1]!r}")
        return lambda scope, apply=filters[tree[1]]: apply(inner[0](scope))
    return lambda scope, apply=SIGNS[tree[1]]: apply(inner[0](scope), inner[1](scope))


Writer = Callable[[str, bool], None]


def writer(nodes: list[tuple], filters: dict[str, Callable], marked: bool) -> Callable[[dict, Writer], None]:
    """One closure for a block; ``marked`` inside a generation."""
    steps = [_step(node, filters, marked) for node in nodes]

    def run(scope: dict, write: Writer) -> None:
        for step in steps:
            step(scope, write)

    return steps[0] if len(steps) == 1 else run


def _step(node: tuple, filters: dict[str, Callable], marked: bool) -> Callable[[dict, Writer], None]:
    kind = node[0]
    if kind == "text":
        return lambda scope, write, text=node[1]: write(text, marked)
    if kind == "generation":
        return writer(node[1], filters, True)
    if kind == "show":
        value = evaluator(node[1], filters)
        return lambda scope, write: write(shown(value(scope)), marked)
    if kind == "set":
        value = evaluator(node[2], filters)

        def assign(scope: dict, write: Writer) -> None:
            scope[node[1]] = value(scope)

        return assign
    if kind == "if":
        branches = [(evaluator(c, filters), writer(inner, filters, marked)) for c, inner in node[1]]
        last = writer(node[2], filters, marked)

        def choose(scope: dict, write: Writer) -> None:
            for condition, inner in branches:
                if condition(scope):
                    return inner(scope, write)
            return last(scope, write)

        return choose
    over, inner = evaluator(node[2], filters), writer(node[3], filters, marked)

    def loop(scope: dict, write: Writer) -> None:
        items = over(scope)
        if not isinstance(items, (list, tuple)):
            items = []
        for i, item in enumerate(items):
            state = {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(items) - 1, "length": len(items)}
            inner({**scope, node[1]: item, "loop": state}, write)

    return loop


class Template:
    """A compiled template; ``render`` gives the text and the spans its generations wrote."""

    def __init__(self, source: str, filters: dict[str, Callable[[Any], Any]] | None = None):
        self.tree = fold_block(parse(source))
        self._write = writer(self.tree, {**FILTERS, **(filters or {})}, False)

    def render(self, **variables: Any) -> tuple[str, list[tuple[int, int]]]:
        """The text, and ``[start, end)`` in code points of what is marked, touching spans apart."""
        out: list[str] = []
        spans: list[tuple[int, int]] = []
        at = 0

        def write(text: str, marked: bool) -> None:
            nonlocal at
            if text:
                out.append(text)
                if marked:
                    spans.append((at, at + len(text)))
                at += len(text)

        self._write(dict(variables), write)
        return "".join(out), spans
