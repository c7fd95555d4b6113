"""Column-name cleaning (P1) -- driver-side metadata only, no data moves."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType


def clean_name(name: str) -> str:
    """snake_case a single name: accents stripped, camelCase split, lower-cased.

    ``Latitude`` -> ``latitude``, ``MaxSizeTL`` -> ``max_size_tl``,
    ``Protection Level`` -> ``protection_level``, ``PC1`` -> ``pc1``.
    """
    s = unicodedata.normalize("NFKD", str(name))
    s = "".join(ch for ch in s if not unicodedata.combining(ch))
    s = s.replace("%", "_percent_").replace("#", "_number_")
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"[^A-Za-z0-9]+", "_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s


def clean_names(names: Sequence[str]) -> list[str]:
    """Clean every name; repeats get ``_2``, ``_3`` ... suffixes."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for n in names:
        c = clean_name(n)
        if c in seen:
            seen[c] += 1
            c = f"{c}_{seen[c]}"
        else:
            seen[c] = 1
        out.append(c)
    return out


def with_clean_names(df: DataFrame) -> DataFrame:
    """``janitor::clean_names()`` for a DataFrame."""
    return df.toDF(*clean_names(df.columns))


def drop_first_column(df: DataFrame) -> DataFrame:
    """``select(-1)`` -- drop a column by position (the row id of an export)."""
    return df.drop(df.columns[0])


def numeric_columns(df: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    """``select(where(is.numeric))`` -- numeric columns, chosen from the schema."""
    names = set(among) if among is not None else None
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and (names is None or f.name in names)]
