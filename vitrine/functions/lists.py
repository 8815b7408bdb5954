"""Cells that hold a Python list literal, such as ``['Soft cotton', "it's warm"]``.

Plain lists of quoted strings are parsed natively with ``from_json``. A guard decides which cells are
that plain; any other cell that could be a literal goes through one Arrow UDF on
``ast.literal_eval``. Cells that cannot be literals never reach Python (the UDF sees NULL).
"""

from __future__ import annotations

import ast

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from vitrine.functions import fixed
from vitrine.functions.text import lower_strip

_JSON_OPTIONS = {"allowSingleQuotes": "true", "allowUnquotedControlChars": "true"}
_MARK = "\\u0001"  # stands for one quoted string


def _native_items(cell: Column) -> Column:
    """The list's strings when the cell is a plain list of quoted strings, else NULL."""
    skeleton = F.regexp_replace(cell, F.lit("'[^']*'|\"[^\"]*\""), F.lit("\u0001"))
    skeleton = F.regexp_replace(skeleton, F.lit(f"{_MARK}[ \\t]*,[ \\t]*(?={_MARK})"), F.lit(""))
    plain = skeleton.rlike(f"^\\[[ \\t]*{_MARK}?[ \\t]*\\]$") & ~cell.rlike(
        f"[\\\\\\n\\r\\f\\x00{_MARK}]"
    )
    opens = cell.rlike(r"^[ \t]*\[")  # prose is told apart by its first character
    return F.when(opens & plain, F.from_json(cell, T.ArrayType(T.StringType()), _JSON_OPTIONS))


def _maybe_literal(cell: Column) -> Column:
    """Cells that Python could read as a literal; prose starting with a letter is not among them."""
    return cell.rlike(
        r"^\s*([\[({'\"0-9+.#\\-]|[uUrRbB]{1,2}['\"]|(None|True|False)\s*(#|$)|set\s*\()"
    )


def _odd_cells(cell: Column, native: Column) -> Column:
    return F.when(native.isNull() & _maybe_literal(cell), cell)


def _evaluate(cell):
    try:
        return True, ast.literal_eval(cell)
    except Exception:  # not a literal: the caller falls back to the text
        return False, None


def _joined(cell):
    ok, value = _evaluate(cell)
    if not ok:
        return cell
    return " ".join(map(str, value)) if isinstance(value, list) else str(value)


def _colors(cell):
    ok, value = _evaluate(cell)
    if ok and isinstance(value, list) and all(isinstance(item, str) for item in value):
        return ", ".join(item.strip().lower() for item in value)
    return fixed.UNKNOWN


def _each(convert):
    """An Arrow UDF of a text function; NULL cells are passed over."""

    @F.arrow_udf(T.StringType())
    def run(cells: pa.Array) -> pa.Array:
        return pa.array(
            [None if cell is None else convert(cell) for cell in cells.to_pylist()], pa.string()
        )

    return run


_joined_literal = _each(_joined)
_color_literal = _each(_colors)


def parse_list(cell: Column) -> Column:
    """List literal -> items joined by a space; other literal -> its text; other text unchanged."""
    native = _native_items(cell)
    return F.coalesce(
        F.array_join(native, " "), _joined_literal(_odd_cells(cell, native)), cell
    )


def extract_colors(cell: Column) -> Column:
    """List literal of strings -> ``'black, blue'``; ``'unknown'`` -> ``''``; other -> ``'unknown'``."""
    native = _native_items(cell)
    joined = F.array_join(F.transform(native, lower_strip), ", ")
    return F.when(cell == fixed.UNKNOWN, F.lit("")).otherwise(
        F.coalesce(joined, _color_literal(_odd_cells(cell, native)), F.lit(fixed.UNKNOWN))
    )
