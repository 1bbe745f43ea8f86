"""Pieces of SQL text.  A wide expression written as text is parsed in one call."""

from __future__ import annotations


def name(column: str) -> str:
    """Quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """Quoted string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def same(pairs: dict[str, str]) -> str:
    """Null-safe equality of column pairs."""
    return " and ".join(f"{name(a)} <=> {name(b)}" for a, b in pairs.items()) or "true"
