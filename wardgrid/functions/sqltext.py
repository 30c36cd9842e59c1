"""Names and constants as SQL text, for operators that build many similar expressions.

One parsed expression costs a single call into the JVM where the Column API needs one per operator,
which matters for wide matrices.
"""

from __future__ import annotations

from collections.abc import Iterable


def ident(name: str) -> str:
    """A column name, quoted."""
    return "`" + name.replace("`", "``") + "`"


def literal(value) -> str:
    """A constant: number, text or NULL."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literals(values: Iterable) -> str:
    return ", ".join(literal(v) for v in values)


def order_cell(value: str, per_octave: int) -> str:
    """The number of a cell that grows with ``value`` (a double that isn't NaN).

    There are ``per_octave`` cells between a number and its double; zero has a cell of its own.
    """
    # 1100 lifts the logarithm of the smallest double above 0; the cap keeps infinity a number.
    size = f"floor(least((log2(abs({value})) + 1100) * {per_octave}, {2200 * per_octave}))"
    return f"case when {value} > 0 then {size} when {value} < 0 then -{size} else 0 end"
