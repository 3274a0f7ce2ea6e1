"""Rule expressions such as ``({a}+1)/2-5+{b}*3`` as Spark SQL expressions.

Python's own ``ast`` reads the text; this module only names the Spark SQL
counterpart of each arithmetic, comparison or logical step, so a rule runs in
generated code like any other expression.

Types follow the rule language: a value is whole or fractional, and ``/``
between two whole values truncates.  Columns with a numeric type decide this
once; text columns decide it row by row from the text (``2`` or ``2.00``).
Anything that cannot be computed (division by zero, overflow, text that is no
number) gives null.  Fractions are double precision throughout.
"""

from __future__ import annotations

import ast
import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

from millrace.functions.text import undock

_WHOLE = r"^-?[0-9]+$"
_NUMBER = r"^-?[0-9]+(\\.[0-9]+)?$"


class RuleError(ValueError):
    """The rule uses something outside the supported expressions."""


@dataclass(frozen=True)
class Value:
    """SQL text of one operand: ``kind`` is int, double, mixed, string, bool or null."""

    kind: str
    sql: str  # the value; for mixed the value as double
    whole: str = ""  # mixed only: the value as bigint
    is_whole: str = ""  # mixed only: whether the row holds a whole value
    raw: str = ""  # mixed only: the text itself

    @property
    def double(self) -> str:
        return f"cast({self.sql} as double)" if self.kind == "int" else self.sql

    @property
    def long(self) -> str:
        return self.whole if self.kind == "mixed" else self.sql

    @property
    def text(self) -> str:
        return self.raw or f"cast({self.sql} as string)"

    @property
    def flag(self) -> str:
        return {"int": "true", "double": "false"}.get(self.kind, self.is_whole)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column(name: str, dtype: T.DataType, text_is_number: bool) -> Value:
    ref = _quoted(name)
    if isinstance(dtype, T.BooleanType):
        return Value("bool", ref)
    if isinstance(dtype, T.IntegralType):
        return Value("int", f"cast({ref} as bigint)")
    if isinstance(dtype, T.NumericType):
        return Value("double", f"cast({ref} as double)")
    if not text_is_number:
        return Value("string", f"cast({ref} as string)")
    s = f"cast({ref} as string)"
    number = f"(case when {s} rlike '{_NUMBER}' then try_cast({s} as double) end)"
    whole = f"(case when {s} rlike '{_WHOLE}' then try_cast({s} as bigint) end)"
    return Value("mixed", number, whole, f"({s} rlike '{_WHOLE}')", s)


_TRY = {ast.Add: "try_add", ast.Sub: "try_subtract", ast.Mult: "try_multiply", ast.Mod: "try_mod"}
_PLAIN = {ast.Add: "+", ast.Sub: "-", ast.Mult: "*"}
_COMPARE = {ast.Eq: "=", ast.NotEq: "<>", ast.Lt: "<", ast.LtE: "<=", ast.Gt: ">", ast.GtE: ">="}
_NUMERIC = ("int", "double", "mixed")

# Function names a rule may call, with their Spark SQL form.
_TEXT_FUNCTIONS = {
    "string.length": ("int", "cast(length({0}) as bigint)"),
    "string.contains": ("bool", "contains({0}, {1})"),
    "string.startsWith": ("bool", "startswith({0}, {1})"),
    "string.endsWith": ("bool", "endswith({0}, {1})"),
    "string.replace_all": ("string", "regexp_replace({0}, {1}, {2})"),
    "date_to_string": ("string", "date_format(try_cast({0} as timestamp), {1})"),
    "string.indexOf": ("int", "cast(instr({0}, {1}) - 1 as bigint)"),
}
_MATH_FUNCTIONS = {
    "math.abs": "abs({0})",
    "math.sqrt": "sqrt({0})",
    "math.pow": "pow({0}, {1})",
    "math.log": "ln({0})",
    "math.log10": "log10({0})",
    "math.sin": "sin({0})",
    "math.cos": "cos({0})",
    "math.tan": "tan({0})",
}


def _int_div(a: str, b: str) -> str:
    # -1 apart: the smallest bigint has no positive counterpart.
    return f"(case when {b} = -1 then try_subtract(0L, {a}) else {a} div nullif({b}, 0L) end)"


def _arith(op: ast.operator, a: Value, b: Value) -> Value:
    kind = type(op)
    if kind is ast.Add and "string" in (a.kind, b.kind):
        return Value("string", f"concat(cast({a.sql} as string), cast({b.sql} as string))")
    if a.kind not in _NUMERIC or b.kind not in _NUMERIC:
        raise RuleError(f"arithmetic on {a.kind} and {b.kind}")
    if kind is ast.Div:
        whole = _int_div(a.long, b.long)
        fraction = f"try_divide({a.double}, {b.double})"
    elif kind in _TRY:
        whole = f"{_TRY[kind]}({a.long}, {b.long})"
        fraction = (
            f"({a.double} {_PLAIN[kind]} {b.double})" if kind in _PLAIN else f"try_mod({a.double}, {b.double})"
        )
    else:
        raise RuleError(f"operator {kind.__name__} is not supported")
    if a.kind == b.kind == "int":
        return Value("int", whole)
    if "double" in (a.kind, b.kind):
        return Value("double", fraction)
    flag = " and ".join(f for f in (a.flag, b.flag) if f != "true")
    if kind is ast.Div:
        fraction = f"(case when {flag} then cast({whole} as double) else {fraction} end)"
    return Value("mixed", fraction, whole, f"({flag})")


def _compare(op: ast.cmpop, a: Value, b: Value) -> Value:
    if isinstance(op, ast.In):
        return Value("bool", f"({a.text} rlike concat('\\\\A(?:', {b.sql}, ')\\\\z'))")
    if "null" in (a.kind, b.kind) and isinstance(op, (ast.Eq, ast.NotEq)):
        value = b if a.kind == "null" else a
        return Value("bool", f"({value.raw or value.sql} is {'not ' if isinstance(op, ast.NotEq) else ''}null)")
    if type(op) not in _COMPARE:
        raise RuleError(f"comparison {type(op).__name__} is not supported")
    if a.kind in _NUMERIC and b.kind in _NUMERIC:
        left, right = (a.sql, b.sql) if a.kind == b.kind == "int" else (a.double, b.double)
    elif a.kind == b.kind:
        left, right = a.sql, b.sql
    else:
        raise RuleError(f"comparing {a.kind} with {b.kind}")
    return Value("bool", f"({left} {_COMPARE[type(op)]} {right})")


def _either(test: Value, a: Value, b: Value) -> Value:
    """``test ? a : b``; a test that is null takes the second value."""
    if test.kind != "bool":
        raise RuleError(f"a condition is needed, not {test.kind}")
    case = lambda x, y: f"(case when {test.sql} then {x} else {y} end)"
    if "null" in (a.kind, b.kind) or a.kind == b.kind != "mixed":
        other = b if a.kind == "null" else a
        if other.kind == "mixed":
            missing = lambda v, form: "null" if v.kind == "null" else form(v)
            forms = [lambda v: v.double, lambda v: v.long, lambda v: v.flag]
            return Value("mixed", *(case(missing(a, f), missing(b, f)) for f in forms))
        return Value(other.kind, case(a.sql, b.sql))
    if a.kind in _NUMERIC and b.kind in _NUMERIC:
        if "double" in (a.kind, b.kind):
            return Value("double", case(a.double, b.double))
        return Value("mixed", case(a.double, b.double), case(a.long, b.long), case(a.flag, b.flag))
    raise RuleError(f"{a.kind} and {b.kind} in one conditional")


def _call(node: ast.Call, walk) -> Value:
    name = ast.unparse(node.func)
    args = [walk(a) for a in node.args]
    if name == "_if":
        return _either(*args)
    if name in _TEXT_FUNCTIONS:
        kind, form = _TEXT_FUNCTIONS[name]
        return Value(kind, form.format(*(a.text for a in args)))
    if name == "string.substring" and len(args) in (2, 3):
        s, begin = args[0].sql, args[1].long
        length = f"{args[2].long} - {begin}" if len(args) == 3 else f"length({s})"
        return Value("string", f"substring({s}, cast({begin} + 1 as int), cast({length} as int))")
    if name == "math.abs" and args[0].kind in ("int", "mixed"):
        a = args[0]
        whole, fraction = f"(case when {a.long} < 0 then try_subtract(0L, {a.long}) else {a.long} end)", f"abs({a.double})"
        return Value("int", whole) if a.kind == "int" else Value("mixed", fraction, whole, a.flag)
    if name in _MATH_FUNCTIONS:
        return Value("double", _MATH_FUNCTIONS[name].format(*(a.double for a in args)))
    if name == "math.round":
        return Value("int", f"cast(floor({args[0].double} + 0.5D) as bigint)")
    if name == "str":
        return Value("string", f"cast({args[0].sql} as string)")
    if name == "long":
        return Value("int", f"try_cast({args[0].sql} as bigint)")
    if name == "double":
        return Value("double", f"try_cast({args[0].sql} as double)")
    raise RuleError(f"function {name} is not supported")


_QUOTED = re.compile(r"('[^']*'|\"[^\"]*\")")


def _python_form(rule: str) -> str:
    """``&&``, ``||``, ``!``, ``=~``, ``nil`` and ``?:`` spelled as Python reads them, outside quoted text."""
    rule = re.sub(r"=~\s*/((?:[^/\\\"]|\\.)*)/", lambda m: "=~ \"" + m.group(1).replace("\\/", "/") + "\"", rule)
    quoted = _QUOTED.findall(rule)
    # quoted texts are put aside, as marks no rule can hold, and come back at the end
    text = _QUOTED.sub("\x00", rule)
    text = text.replace("&&", " and ").replace("||", " or ").replace("=~", " in ")
    text = re.sub(r"!(?!=)", " not ", text)
    text = re.sub(r"\bnil\b", "None", text)
    text = _conditional(text)
    for q in quoted:
        text = text.replace("\x00", q.replace("\\", "\\\\"), 1)
    return text.strip()


def _conditional(text: str) -> str:
    """``c ? a : b`` as ``_if(c, a, b)``, innermost brackets first; ``?`` binds weakest and to the right."""
    depth, start, parts = 0, None, []
    for i, c in enumerate(text):
        if c == "(":
            if depth == 0:
                start = i
            depth += 1
        elif c == ")":
            depth -= 1
            if depth == 0:
                parts.append((start, i))
    out, last = [], 0
    for lo, hi in parts:
        inner = ",".join(_conditional(x) for x in _split_top(text[lo + 1:hi], ","))
        out += [text[last:lo + 1], inner, ")"]
        last = hi + 1
    text = "".join(out) + text[last:]
    at = _top(text, "?")
    if at is None:
        return text
    level = 0
    for i in range(at + 1, len(text)):
        if text[i] == "?" and _top(text[:i + 1], "?", at + 1) is not None:
            level += 1
        elif text[i] == ":" and text[:i].count("(") == text[:i].count(")"):
            if level == 0:
                return f"_if({text[:at]}, {_conditional(text[at + 1:i])}, {_conditional(text[i + 1:])})"
            level -= 1
    raise RuleError(f"':' is missing after '?' in {text!r}")


def _top(text: str, sign: str, start: int = 0) -> int | None:
    """First place of a sign outside brackets."""
    depth = 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if i >= start and depth == 0 and c == sign:
            return i
    return None


def _split_top(text: str, sign: str) -> list[str]:
    out, at = [], 0
    while (i := _top(text, sign, at)) is not None:
        out.append(text[at:i])
        at = i + 1
    return [*out, text[at:]]


def rule_value(rule: str, schema: T.StructType, text_is_number: bool = True) -> Value:
    """Translate a rule; fields are ``{name}`` or bare names of ``schema``."""
    types = {f.name.lower(): f for f in schema.fields}
    slots: dict[str, str] = {}

    def slot(m: re.Match) -> str:
        return slots.setdefault(undock(m.group(0)), f"_field_{len(slots)}")

    text = re.sub(r"\{.*?\}", slot, rule)
    names = {v: k for k, v in slots.items()}
    try:
        tree = ast.parse(_python_form(text), mode="eval")
    except SyntaxError as e:
        raise RuleError(f"cannot read rule {rule!r}") from e

    def walk(node: ast.expr) -> Value:
        if isinstance(node, ast.Constant):
            v = node.value
            if v is None:
                return Value("null", "null")
            if isinstance(v, bool):
                return Value("bool", str(v).lower())
            if isinstance(v, int):
                return Value("int", f"{v}L")
            if isinstance(v, float):
                return Value("double", f"{v!r}D")
            if isinstance(v, str):
                return Value("string", _literal(v))
        if isinstance(node, ast.Name):
            if node.id in ("true", "false"):
                return Value("bool", node.id)
            name = names.get(node.id, node.id)
            if name.lower() not in types:
                raise RuleError(f"unknown field {name!r} in rule {rule!r}")
            f = types[name.lower()]
            return _column(f.name, f.dataType, text_is_number)
        if isinstance(node, ast.BinOp):
            return _arith(node.op, walk(node.left), walk(node.right))
        if isinstance(node, ast.UnaryOp):
            inner = walk(node.operand)
            if isinstance(node.op, ast.USub) and inner.kind in _NUMERIC:
                return _arith(ast.Sub(), Value("int", "0L"), inner)
            if isinstance(node.op, ast.UAdd) and inner.kind in _NUMERIC:
                return inner
            if isinstance(node.op, ast.Not) and inner.kind == "bool":
                return Value("bool", f"(not {inner.sql})")
        if isinstance(node, ast.Compare):
            steps = [walk(node.left), *(walk(c) for c in node.comparators)]
            tests = [_compare(op, a, b).sql for op, a, b in zip(node.ops, steps, steps[1:])]
            return Value("bool", "(" + " and ".join(tests) + ")")
        if isinstance(node, ast.BoolOp):
            values = [walk(v) for v in node.values]
            if all(v.kind == "bool" for v in values):
                word = " and " if isinstance(node.op, ast.And) else " or "
                return Value("bool", "(" + word.join(v.sql for v in values) + ")")
        if isinstance(node, ast.Call):
            return _call(node, walk)
        raise RuleError(f"cannot use {ast.unparse(node)!r} in rule {rule!r}")

    return walk(tree.body)


def compute(rule: str, schema: T.StructType) -> Column:
    """Value of an arithmetic or logical rule: bigint, double, boolean or string."""
    return F.expr(rule_value(rule, schema).sql)


def execute(rule: str, schema: T.StructType) -> Column:
    """``exec:`` template: the rule's value as text; text columns stay text, ``+`` joins them."""
    value = rule_value(rule.removeprefix("exec:"), schema, text_is_number=False)
    return F.expr(value.sql).cast("string")
