"""Column-name rules (driver-side: names only, never data)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from string import ascii_uppercase


def snake_case(name: str) -> str:
    """``TotalCharges`` -> ``total_charges``; every capital opens a word, so
    ``customerID`` -> ``customer_i_d`` and acronyms need a fix-up map."""
    head, tail = name[:1], name[1:]
    return (head + "".join(f"_{ch}" if ch in ascii_uppercase else ch for ch in tail)).lower()


def quoted(name: str) -> str:
    """A column reference that is safe for dots and spaces in the name."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string as a SQL literal, whatever characters it holds. Tables of
    constants go into a plan as one parsed expression: building them call by
    call costs more driver time than a small job takes."""
    if "'" in value or "\\" in value:
        return f"decode(X'{value.encode().hex()}', 'UTF-8')"
    return f"'{value}'"


def rows_of(names: Sequence[str], rows: Iterable[Sequence[str]]) -> str:
    """SQL that yields one row per entry of ``rows``, each a list of SQL
    expressions; use it as the only item of a ``selectExpr``."""
    structs = (
        ", ".join(f"{value} AS {quoted(name)}" for name, value in zip(names, row)) for row in rows
    )
    return "inline(array(" + ", ".join(f"struct({s})" for s in structs) + "))"
