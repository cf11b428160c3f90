"""Projections, sentinels and predicates on listing frames."""
from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ANALYSIS_NULL_TOKENS, ETL_NULL_SENTINELS


def null_sentinels(df: DataFrame, tokens: Iterable[str] = ETL_NULL_SENTINELS,
                   exclude: Iterable[str] = ("VIN",)) -> DataFrame:
    """Exact-match sentinel tokens -> NULL on every string column but ``exclude``.
    One ``select``; non-string columns pass through untouched."""
    tokens, exclude = list(tokens), set(exclude)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in exclude or not isinstance(f.dataType, T.StringType):
            cols.append(c)
        else:
            cols.append(F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c).alias(f.name))
    return df.select(cols)


def null_tokens(df: DataFrame) -> DataFrame:
    """The analysis token list (NULL, null, NA, N/A, ...) on every column."""
    return null_sentinels(df, ANALYSIS_NULL_TOKENS, exclude=())


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def project_final(df: DataFrame, columns: list[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Fixed column order; missing columns appear as typed NULLs (an untyped
    NULL column cannot be written to Parquet)."""
    types = types or {}
    present = set(df.columns)
    return df.select([F.col(f"`{c}`") if c in present else F.lit(None).cast(types.get(c, "string")).alias(c)
                      for c in columns])


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Plan-time check; raises ``ValueError`` naming the missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def not_null_key(df: DataFrame, key: str = "VIN") -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def installment_flag(down_payment: Column | str, fixed: bool = False) -> Column:
    """True when a down payment exists. As defined, '' counts as support;
    ``fixed`` treats '' as missing."""
    c = F.col(f"`{down_payment}`") if isinstance(down_payment, str) else down_payment
    if fixed:
        c = F.nullif(c, F.lit(""))
    return c.isNotNull()


def typed_cast(c: Column | str, to: str = "int") -> Column:
    """Cast that yields NULL for '' or junk instead of raising under ANSI."""
    col = F.col(f"`{c}`") if isinstance(c, str) else c
    return col.try_cast(to)


def any_non_null(cols: Iterable[str], empty_is_null: bool = True) -> Column:
    """'Yes' when any of the columns holds a value, else 'No'."""
    parts = [F.nullif(F.col(f"`{c}`"), F.lit("")) if empty_is_null else F.col(f"`{c}`") for c in cols]
    return F.when(F.coalesce(*parts).isNotNull(), F.lit("Yes")).otherwise(F.lit("No"))


def display_or_na(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NULL -> 'N/A' for display (values cast to text)."""
    cols = set(columns or df.columns)
    return df.select([F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("N/A")).alias(c) if c in cols
                      else F.col(f"`{c}`") for c in df.columns])
