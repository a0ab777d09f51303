"""Keeping a caller's columns apart from an operator's own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def set_aside(df: DataFrame, own: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """df with the columns that bear one of the operator's own names renamed, and what gives a
    result's columns their names back.  Names differ in more than case."""
    taken = {c.lower() for c in df.columns} | set(own)
    renamed: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in own:
            k = 0
            while f"_aside{k}" in taken:
                k += 1
            taken.add(f"_aside{k}")
            renamed[c] = f"_aside{k}"
    back = {v: k for k, v in renamed.items()}
    return df.withColumnsRenamed(renamed), lambda out: out.withColumnsRenamed(back)
