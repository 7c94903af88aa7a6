"""Chat templates written as text, turned into Column expressions.

The subset that chat templates use: ``{{ expression }}``, ``for`` over messages
(with an ``if`` filter), ``if/elif/else``, ``set``, comments and white-space control
(``-`` marks; a block tag on a line of its own leaves nothing, as chat templates
expect). Expressions: text, whole numbers, ``message['content']`` or
``message.content``, indexes and slices of ``messages``, ``loop.first``, ``last``,
``index``, ``index0`` and ``length``, comparisons, ``in``, ``and``, ``or``, ``not``,
``+``, ``-``, ``%``, ``a if c else b``, ``is defined``, ``is none``, the filters (or
methods) ``trim``, ``strip``, ``upper``, ``lower``, ``length``, ``default``,
``startswith``, ``endswith``, and ``raise_exception``. Anything else is refused with
a ``TemplateError``. Rendering is row-local and stays in the JVM.

A null chat renders as null. A null content, a message that is not there
(``messages[5]``) and a name that is not set render as empty text and count as false.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property, reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import col_, strip


class TemplateError(ValueError):
    """The template is not well formed or uses something outside the subset."""


class Value(NamedTuple):
    col: Column
    kind: str                # text, int, bool, message, messages or unset


_STRING = r"\"(?:\\.|[^\"\\])*\"|'(?:\\.|[^'\\])*'"
_TAG = re.compile(rf"(\{{%(?:{_STRING}|.)*?%\}}|\{{\{{(?:{_STRING}|.)*?\}}\}}|\{{#.*?#\}})", re.S)
_FILTER = re.compile(rf"({_STRING})|\s*\|\s*(\w+)(\s*\()?", re.S)
_LOOP = re.compile(r"(\w+)\s+in\s+(.+?)(?:\s+if\s+(.+))?$", re.S)
_CONSTANTS = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}


# ---------------------------------------------------------------- template text -> nodes
def _expression(text: str) -> ast.expr:
    """Filters become method calls, which bind as tightly; the rest reads as Python."""
    def call(m):
        return m[1] if m[1] else f".{m[2]}(" if m[3] else f".{m[2]}()"
    try:
        return ast.parse("(" + _FILTER.sub(call, text.strip()) + ")", mode="eval").body
    except SyntaxError as e:
        raise TemplateError(f"not an expression: {text.strip()!r}") from e


def _pieces(source: str) -> list[tuple[str, str]]:
    """``(kind, text)`` with kind text, out or block; white space around tags settled."""
    parts = _TAG.split(source.removesuffix("\n"))
    out = []
    for k, part in enumerate(parts):
        if k % 2:
            body = part[2:-2].removeprefix("-").removesuffix("-").strip()
            if part[1] != "#":
                out.append(("out" if part[1] == "{" else "block", body))
            continue
        if k > 0:
            before = parts[k - 1]
            if before[-3] == "-":
                part = part.lstrip()
            elif before[1] != "{":
                part = part.removeprefix("\n")
        if k + 1 < len(parts):
            after = parts[k + 1]
            if after[2] == "-":
                part = part.rstrip()
            elif after[1] != "{":                       # blanks between a line's start and a block tag
                line = part.rpartition("\n")[2]
                starts = "\n" in part or k == 0 or parts[k][:1] == "\n"
                if starts and not line.strip():
                    part = part[:len(part) - len(line)]
        if part:
            out.append(("text", part))
    return out


def _nodes(pieces: list, ends: tuple = ()) -> tuple[list, str]:
    """Nodes up to a block tag whose word is in ``ends``, and that tag. Eats ``pieces``."""
    out = []
    while pieces:
        kind, text = pieces.pop(0)
        if kind == "text":
            out.append(("text", text))
            continue
        if kind == "out":
            out.append(("out", _expression(text)))
            continue
        word, _, rest = text.partition(" ")
        if word in ends:
            return out, text
        if word == "for":
            m = _LOOP.match(rest.strip())
            if not m:
                raise TemplateError(f"for: {text!r}")
            body, _ = _nodes(pieces, ("endfor",))
            out.append(("for", m[1], _expression(m[2]), _expression(m[3]) if m[3] else None, body))
        elif word == "if":
            branches, condition, otherwise = [], _expression(rest), []
            while True:
                body, end = _nodes(pieces, ("elif", "else", "endif"))
                branches.append((condition, body))
                if end.startswith("elif"):
                    condition = _expression(end[4:])
                    continue
                if end == "else":
                    otherwise, _ = _nodes(pieces, ("endif",))
                break
            out.append(("if", branches, otherwise))
        elif word == "set" and re.match(r"\w+\s*=", rest.strip()):
            name, _, value = rest.partition("=")
            out.append(("set", name.strip(), _expression(value)))
        else:
            raise TemplateError(f"block tag {text!r}")
    if ends:
        raise TemplateError(f"no {ends[-1]}")
    return out, ""


# ---------------------------------------------------------------- expressions -> Columns
def _constant(v) -> Value:
    kind = {str: "text", int: "int", bool: "bool", type(None): "unset"}.get(type(v))
    if kind is None:
        raise TemplateError(f"constant {v!r}")
    return Value(F.lit(v), kind)


def _truth(v: Value) -> Column:
    return {
        "text": lambda c: F.coalesce(c, F.lit("")) != "",
        "int": lambda c: F.coalesce(c, F.lit(0)) != 0,
        "bool": lambda c: F.coalesce(c, F.lit(False)),
        "message": lambda c: c.isNotNull(),
        "messages": lambda c: F.coalesce(F.size(c), F.lit(0)) > 0,
        "unset": lambda c: F.lit(False),
    }[v.kind](v.col)


def _printed(v: Value) -> Column:
    if v.kind == "unset":
        return F.lit("")
    if v.kind == "bool":
        return F.when(_truth(v), "True").otherwise("False")
    if v.kind not in ("text", "int"):
        raise TemplateError(f"{v.kind} cannot be printed")
    return F.coalesce(v.col.cast("string"), F.lit(""))


def _common_kind(values: list[Value]) -> str:
    kinds = {v.kind for v in values if v.kind != "unset"}
    if len(kinds) > 1:
        raise TemplateError(f"one name or choice is {' and '.join(sorted(kinds))}")
    return kinds.pop() if kinds else "unset"


def _compare(op: ast.cmpop, a: Value, node: ast.expr, env: dict) -> Column:
    if isinstance(op, ast.Is | ast.IsNot):
        word = node.id if isinstance(node, ast.Name) else getattr(node, "value", 0) is None and "none"
        if word not in ("defined", "none", "undefined"):
            raise TemplateError(f"is {ast.unparse(node)}")
        missing = F.lit(True) if a.kind == "unset" else a.col.isNull()
        return ~missing if (word == "defined") == isinstance(op, ast.Is) else missing
    if isinstance(op, ast.In | ast.NotIn):
        if isinstance(node, ast.List | ast.Tuple):
            found = reduce(lambda x, e: x | _compare(ast.Eq(), a, e, env), node.elts, F.lit(False))
        else:
            b = _value(node, env)
            if (a.kind, b.kind) != ("text", "text"):
                raise TemplateError(f"in {ast.unparse(node)}")
            found = F.coalesce(F.contains(b.col, a.col), F.lit(False))
        return found if isinstance(op, ast.In) else ~found
    b = _value(node, env)
    if isinstance(op, ast.Eq | ast.NotEq):
        same = (F.lit(a.kind == b.kind) if "unset" in (a.kind, b.kind) and not {a.kind, b.kind} & {"message", "messages"}
                else F.lit(False) if a.kind != b.kind else a.col.eqNullSafe(b.col))
        return same if isinstance(op, ast.Eq) else ~same
    order = {ast.Lt: lambda x, y: x < y, ast.LtE: lambda x, y: x <= y, ast.Gt: lambda x, y: x > y, ast.GtE: lambda x, y: x >= y}
    if a.kind != b.kind or a.kind not in ("int", "text"):
        raise TemplateError(f"{a.kind} compared with {b.kind}")
    return F.coalesce(order[type(op)](a.col, b.col), F.lit(False))


def _subscript(node: ast.Subscript, env: dict) -> Value:
    base, at = _value(node.value, env), node.slice
    if base.kind == "unset":
        return base
    if base.kind == "message" and isinstance(at, ast.Constant):
        return _member(base, at.value)
    if base.kind != "messages":
        raise TemplateError(ast.unparse(node))
    size = F.size(base.col)

    def place(n, otherwise):
        if n is None:
            return otherwise
        i = _value(n, env)
        if i.kind != "int":
            raise TemplateError(ast.unparse(node))
        return F.when(i.col < 0, i.col + size).otherwise(i.col)
    if isinstance(at, ast.Slice):
        if at.step is not None:
            raise TemplateError("slice with a step")
        first = F.greatest(place(at.lower, F.lit(0)), F.lit(0))
        length = F.greatest(F.least(place(at.upper, size), size) - first, F.lit(0))
        return Value(F.slice(base.col, first + 1, length), "messages")
    return Value(F.get(base.col, place(at, None)), "message")


def _member(message: Value, name) -> Value:
    return Value(message.col[name], "text") if name in ("role", "content") else _constant(None)


def _call(node: ast.Call, env: dict) -> Value:
    args = [_value(a, env) for a in node.args]
    if isinstance(node.func, ast.Name) and node.func.id == "raise_exception" and [a.kind for a in args] == ["text"]:
        return Value(F.raise_error(args[0].col).cast("string"), "text")
    if not isinstance(node.func, ast.Attribute) or node.keywords:
        raise TemplateError(ast.unparse(node))
    base, name = _value(node.func.value, env), node.func.attr
    if name == "default" and len(args) == 1:
        return Value(F.coalesce(base.col, args[0].col), _common_kind([base, args[0]]))
    if name == "length" and not args and base.kind in ("text", "messages"):
        return Value(F.coalesce((F.length if base.kind == "text" else F.size)(base.col), F.lit(0)), "int")
    plain = {"trim": strip, "strip": strip, "upper": F.upper, "lower": F.lower}
    tests = {"startswith": F.startswith, "endswith": F.endswith}
    if base.kind == "unset" and name in plain:
        return base
    if base.kind == "text" and name in plain and not args:
        return Value(plain[name](base.col), "text")
    if base.kind == "text" and name in tests and [a.kind for a in args] == ["text"]:
        return Value(F.coalesce(tests[name](base.col, args[0].col), F.lit(False)), "bool")
    raise TemplateError(ast.unparse(node))


def _value(node: ast.expr, env: dict) -> Value:
    if isinstance(node, ast.Constant):
        return _constant(node.value)
    if isinstance(node, ast.Name):
        return env[node.id] if node.id in env else _constant(_CONSTANTS.get(node.id))
    if isinstance(node, ast.Attribute):
        if isinstance(node.value, ast.Name) and node.value.id == "loop":
            if f"loop.{node.attr}" not in env:
                raise TemplateError(f"loop.{node.attr}")
            return env[f"loop.{node.attr}"]
        base = _value(node.value, env)
        if base.kind not in ("message", "unset"):
            raise TemplateError(ast.unparse(node))
        return _member(base, node.attr) if base.kind == "message" else base
    if isinstance(node, ast.Subscript):
        return _subscript(node, env)
    if isinstance(node, ast.Call):
        return _call(node, env)
    if isinstance(node, ast.Compare):
        left, found = _value(node.left, env), F.lit(True)
        for op, right in zip(node.ops, node.comparators):
            found = found & _compare(op, left, right, env)
            left = left if isinstance(op, ast.Is | ast.IsNot) or isinstance(right, ast.List | ast.Tuple) else _value(right, env)
        return Value(found, "bool")
    if isinstance(node, ast.BoolOp):
        values = [_value(v, env) for v in node.values]
        if isinstance(node.op, ast.Or) and _kinds(values) == {"text"}:       # the first that is not empty
            return reduce(lambda a, b: Value(F.when(_truth(a), a.col).otherwise(b.col), "text"), values)
        join = (lambda a, b: a & b) if isinstance(node.op, ast.And) else (lambda a, b: a | b)
        return Value(reduce(join, map(_truth, values)), "bool")
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.Not):
        return Value(~_truth(_value(node.operand, env)), "bool")
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub) and isinstance(node.operand, ast.Constant):
        return _constant(-node.operand.value)
    if isinstance(node, ast.IfExp):
        c, a, b = _truth(_value(node.test, env)), _value(node.body, env), _value(node.orelse, env)
        return Value(F.when(c, a.col).otherwise(b.col), _common_kind([a, b]))
    if isinstance(node, ast.BinOp):
        a, b = _value(node.left, env), _value(node.right, env)
        if isinstance(node.op, ast.Add) and _kinds([a, b]) <= {"text"}:
            return Value(F.concat(_printed(a), _printed(b)), "text")
        if (a.kind, b.kind) == ("int", "int"):
            if isinstance(node.op, ast.Add):
                return Value(a.col + b.col, "int")
            if isinstance(node.op, ast.Sub):
                return Value(a.col - b.col, "int")
            if isinstance(node.op, ast.Mod):
                return Value(F.pmod(a.col, b.col), "int")
    raise TemplateError(ast.unparse(node))


def _kinds(values: list[Value]) -> set:
    return {v.kind for v in values if v.kind != "unset"}


# ---------------------------------------------------------------- nodes -> Columns
def _joined(parts: list[Column]) -> Column:
    return F.concat(*parts) if parts else F.lit("")


def _render(nodes: list, env: dict) -> list[Column]:
    """Columns of text, in order. Names that ``set`` gives are added to ``env``."""
    out = []
    for node in nodes:
        if node[0] == "text":
            out.append(F.lit(node[1]))
        elif node[0] == "out":
            out.append(_printed(_value(node[1], env)))
        elif node[0] == "set":
            env[node[1]] = _value(node[2], env)
        elif node[0] == "if":
            out.append(_render_if(node[1], node[2], env))
        else:
            out.append(_render_for(*node[1:], env))
    return out


def _render_if(branches: list, otherwise: list, env: dict) -> Column:
    done = []                                             # (condition, text, names after the branch)
    for condition, body in branches:
        own = dict(env)
        done.append((_truth(_value(condition, env)), _joined(_render(body, own)), own))
    last = dict(env)
    tail = _joined(_render(otherwise, last))

    def choose(cols: list[Column], end: Column) -> Column:
        return reduce(lambda c, b: F.when(b[0], b[1]).otherwise(c), reversed([(d[0], c) for d, c in zip(done, cols)]), end)
    for name in {n for _, _, own in done for n in own} | set(last):
        values = [own.get(name) or _constant(None) for own in [d[2] for d in done] + [last]]
        if any(v is not env.get(name) for v in values):
            env[name] = Value(choose([v.col for v in values[:-1]], values[-1].col), _common_kind(values))
    return choose([d[1] for d in done], tail)


def _render_for(name: str, over: ast.expr, only: ast.expr | None, body: list, env: dict) -> Column:
    items = _value(over, env)
    if items.kind == "unset":
        return F.lit("")
    if items.kind != "messages":
        raise TemplateError(f"for over {ast.unparse(over)}")
    array = items.col
    if only is not None:
        array = F.filter(array, lambda x: _truth(_value(only, env | {name: Value(x, "message")})))
    size = F.size(array)

    def one(x, i):
        inner = env | {name: Value(x, "message"), "loop.first": Value(i == 0, "bool"), "loop.last": Value(i == size - 1, "bool"),
                       "loop.index0": Value(i, "int"), "loop.index": Value(i + 1, "int"), "loop.length": Value(size, "int")}
        return _joined(_render(body, inner))
    return F.coalesce(F.array_join(F.transform(array, one), ""), F.lit(""))


@dataclass(frozen=True)
class TextTemplate:
    """A chat template given as text; use it wherever a ``ChatTemplate`` is taken.

    ``variables`` are names the template may use (``bos_token`` and the like).
    """

    source: str
    variables: Mapping[str, str | int | bool] = field(default_factory=dict)

    def __post_init__(self):
        self._parsed                      # a malformed template stops here, not in a job

    @cached_property
    def _parsed(self) -> list:
        return _nodes(_pieces(self.source))[0]

    def render(self, m, add_generation_prompt: bool) -> Column:
        m = col_(m)
        env = {k: _constant(v) for k, v in self.variables.items()}
        env |= {"messages": Value(m, "messages"), "add_generation_prompt": _constant(add_generation_prompt)}
        return F.when(m.isNotNull(), _joined(_render(self._parsed, env)))
