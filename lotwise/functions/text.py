"""Text extraction and normalisation on listing fields."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "year_of_title", "make_of_title", "strip_dollar", "first_integer", "split_finance",
    "finance_chunk", "down_payment", "apr", "mileage_digits", "title_case", "py_strip",
    "split_features", "features_lines", "feature_join", "listed_days", "mpg_city", "mpg_highway",
]

MPG_PATTERN = r"(\d+) city / (\d+) highway"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_of_title(c) -> Column:
    """Leading four digits of a title; '' when the title has no leading year."""
    return F.regexp_extract(_c(c), r"^(\d{4})", 1)


def make_of_title(c) -> Column:
    """First token after the leading year (two-word makes are cut, as defined)."""
    return F.regexp_extract(_c(c), r"^\d{4}\s+(\S+)", 1)


def strip_dollar(c) -> Column:
    """Remove every '$' and trim; thousands commas stay."""
    return F.trim(F.regexp_replace(_c(c), r"\$", ""))


def first_integer(c, fixed: bool = False) -> Column:
    """First run of digits. ``fixed`` drops thousands commas first, so
    '$1,853/mo' gives '1853' instead of '1'."""
    src = F.regexp_replace(_c(c), ",", "") if fixed else _c(c)
    return F.regexp_extract(src, r"(\d+)", 1)


def split_finance(c) -> Column:
    """Finance details split on the middle dot into (up to) three chunks."""
    return F.split(_c(c), "·")


def finance_chunk(c, i: int) -> Column:
    """0-based chunk i; NULL past the end (``get`` never raises)."""
    return F.get(split_finance(c), i)


def down_payment(chunk1, fixed: bool = False) -> Column:
    """Digits and commas of the first chunk. ``fixed`` keeps the value only
    when the chunk really is a 'due at signing' amount."""
    ch = _c(chunk1)
    out = F.regexp_replace(ch, r"[^\d,]", "")
    if fixed:
        out = F.when(ch.contains("due at signing"), out)
    return out


def apr(chunk3) -> Column:
    return F.regexp_extract(_c(chunk3), r"(\d+(\.\d+)?)", 1)


def mileage_digits(c) -> Column:
    return F.trim(F.regexp_replace(_c(c), r"[^\d,]", ""))


def py_strip(c) -> Column:
    """Strip leading/trailing white space like Python's ``str.strip``."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def title_case(c) -> Column:
    """Python ``str.strip().title()``: each run of letters gets an upper-case
    first letter and lower-case rest ('MERCEDES-BENZ' -> 'Mercedes-Benz',
    "o'hare" -> "O'Hare", '4WD' -> '4Wd'). ``initcap`` differs (it splits on
    spaces only)."""
    pieces = F.regexp_extract_all(py_strip(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(
        F.transform(pieces, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))),
        "")


def split_features(c) -> Column:
    """'A; B; ;C' -> ['A', 'B', 'C'] (trimmed, empties dropped)."""
    return F.filter(F.transform(F.split(_c(c), ";"), lambda x: F.trim(x)), lambda x: x != "")


def features_lines(c) -> Column:
    """One feature per line -> trimmed non-empty items."""
    return F.filter(F.transform(F.split(_c(c), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def feature_join(c) -> Column:
    """Array of features -> '; '-joined text."""
    return F.array_join(_c(c), "; ")


def listed_days(c, fixed: bool = False) -> Column:
    """First integer of 'Listed Since' as double; the unit is ignored unless
    ``fixed`` (weeks x7, months x30, years x365)."""
    v = F.nullif(F.regexp_extract(_c(c), r"(\d+)", 1), F.lit("")).try_cast("double")
    if fixed:
        low = F.lower(_c(c))
        v = (F.when(low.contains("week"), v * 7).when(low.contains("month"), v * 30)
             .when(low.contains("year"), v * 365).otherwise(v))
    return v


def mpg_city(c) -> Column:
    return F.nullif(F.regexp_extract(_c(c), MPG_PATTERN, 1), F.lit("")).try_cast("double")


def mpg_highway(c) -> Column:
    return F.nullif(F.regexp_extract(_c(c), MPG_PATTERN, 2), F.lit("")).try_cast("double")
