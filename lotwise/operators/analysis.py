"""Cleaning for analysis: listing text -> typed, validated, categorised rows."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as L
from ..schemas import LOAN_COLUMNS, TITLE_CASE_COLUMNS
from .cleaning import any_non_null, null_tokens, require_columns

CURRENT_YEAR = 2026  # default of the range check; a parameter, fixed for reproducible runs


def _c(n: str):
    return F.col(f"`{n}`")


def range_validate(df: DataFrame, current_year: int = CURRENT_YEAR) -> DataFrame:
    """price > 0, mileage >= 0, both MPG in [0, 100], year in [1900, current+1].
    A NULL in any of them drops the row (as NaN comparisons do)."""
    return df.filter(
        (_c("Cash Price (USD)") > 0) & (_c("Mileage") >= 0)
        & _c("City MPG").between(0, 100) & _c("Highway MPG").between(0, 100)
        & (_c("Year of Manufacture") >= 1900) & (_c("Year of Manufacture") <= current_year + 1))


def clean_for_analysis(listing: DataFrame, current_year: int = CURRENT_YEAR) -> DataFrame:
    """null tokens -> financing flag -> numeric coercion -> validation ->
    price category -> MPG split -> title case. One narrow plan, no shuffle."""
    require_columns(listing, ["Cash Price (USD)", "Mileage", "MPG"])
    df = null_tokens(listing)
    loans = [c for c in LOAN_COLUMNS if c in df.columns]
    df = df.withColumn("Financing Support", any_non_null(loans) if loans else F.lit("No"))
    df = df.drop(*loans)
    df = df.withColumns({
        "Cash Price (USD)": L.numeric_coerce(_c("Cash Price (USD)")),
        "Mileage": L.numeric_coerce(_c("Mileage")),
        "City MPG": L.mpg_city(_c("MPG")),
        "Highway MPG": L.mpg_highway(_c("MPG")),
        "Year of Manufacture": _c("Year of Manufacture").try_cast("double"),
    })
    df = df.withColumn("Price Category", L.price_category(_c("Cash Price (USD)")))
    df = range_validate(df, current_year)
    return df.withColumns({c: L.title_case(_c(c)) for c in TITLE_CASE_COLUMNS if c in df.columns})


def add_analysis_columns(clean: DataFrame, fixed: bool = False) -> DataFrame:
    """Price Segment (right-closed bins), State, Listed Days."""
    return clean.withColumns({
        "Price Segment": L.price_segment(_c("Cash Price (USD)")),
        "State": L.extract_state(_c("Location"), fixed),
        "Listed Days": L.listed_days(_c("Listed Since"), fixed),
    })
