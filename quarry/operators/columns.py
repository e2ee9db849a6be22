"""Schema-level helpers (P1-P5, P12-P17, U4): pure functions over column
names, applied to a DataFrame with one ``select`` so no data moves twice."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Full-width brackets unified to ASCII ones.
BRACKETS = {"（": "(", "）": ")"}


def trim_names(names: Sequence[str]) -> list[str]:
    """Strip whitespace around column names."""
    return [n.strip() for n in names]


def unify_brackets(names: Sequence[str]) -> list[str]:
    """Full-width parentheses -> ASCII."""
    out = []
    for n in names:
        for a, b in BRACKETS.items():
            n = n.replace(a, b)
        out.append(n)
    return out


def rename_names(names: Sequence[str], mapping: Mapping[str, str]) -> list[str]:
    """Mapped names replaced, unmapped kept."""
    return [mapping.get(n, n) for n in names]


def dedupe_names(names: Sequence[str]) -> list[str]:
    """P5: pandas-style de-duplication: the second ``x`` becomes ``x.1`` and so on."""
    seen: dict[str, int] = {}
    taken = set(names)
    out = []
    for n in names:
        if n not in seen:
            seen[n] = 0
            out.append(n)
            continue
        k = seen[n] + 1
        while f"{n}.{k}" in taken:
            k += 1
        seen[n] = k
        taken.add(f"{n}.{k}")
        out.append(f"{n}.{k}")
    return out


def clean_headers(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """P1 + P2 + P3 + P5 in one projection."""
    names = trim_names(df.columns)
    names = rename_names(names, {k.strip(): v for k, v in (mapping or {}).items()})
    names = dedupe_names(unify_brackets(trim_names(names)))
    return df.toDF(*names)


def unmapped_columns(names: Sequence[str], mapping: Mapping[str, str]) -> list[str]:
    """Columns that are not among the mapping's target names."""
    targets = set(mapping.values())
    return [n for n in names if n not in targets]


def between(names: Sequence[str], start: str, end: str) -> list[str]:
    """Columns from ``start`` to ``end`` inclusive, by position."""
    names = list(names)
    i, j = names.index(start), names.index(end)
    return names[i:j + 1]


def containing(names: Sequence[str], parts: Sequence[str]) -> list[str]:
    """Columns whose name contains any of ``parts`` (case-insensitive)."""
    low = [p.lower() for p in parts]
    return [n for n in names if any(p in n.lower() for p in low)]


def with_prefix(names: Sequence[str], *prefixes: str) -> list[str]:
    return [n for n in names if n.startswith(tuple(prefixes))]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte", "decimal")]


def scalable_columns(df: DataFrame, exclude: Sequence[str] = (), binary: Sequence[str] = ()) -> list[str]:
    """Numeric columns minus ids, indicators, binaries and exclusions."""
    skip = set(exclude) | set(binary)
    return [c for c in numeric_columns(df)
            if c not in skip and not c.startswith(("Missing_", "Tested_")) and not c.endswith("_Encoded")]


def keep_all(df: DataFrame, masks: Sequence) -> DataFrame:
    """Keep a row iff every mask is true (NULL mask -> keep)."""
    cond = F.lit(True)
    for m in masks:
        cond = cond & F.coalesce(m, F.lit(True))
    return df.where(cond)


def safe_name(n: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", n)
