"""Price parsing, formatting and binning."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PRICE_CATEGORY_LABELS, PRICE_EDGES, PRICE_SEGMENT_LABELS

__all__ = ["price_numeric", "clean_price", "format_price", "numeric_coerce",
           "price_category", "price_segment", "segment_ordinal"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_numeric(c, as_double: bool = True) -> Column:
    """Search-side price: drop '$', ',' and spaces, cast to NUMERIC(18,2);
    unreadable text ('No Cash Price') is NULL instead of an error."""
    dec = F.translate(_c(c), "$, ", "").try_cast("decimal(18,2)")
    return dec.cast("double") if as_double else dec


def clean_price(c) -> Column:
    """Keep digits and dots -> double; empty or NULL -> 0; unparsable -> NULL."""
    raw = _c(c)
    val = F.regexp_replace(raw, r"[^\d.]", "").try_cast("double")
    return F.when(raw.isNull() | (raw == ""), F.lit(0.0)).otherwise(val)


def format_price(c) -> Column:
    """'$1,234.00'; empty/NULL -> 'N/A'; text that does not parse is returned as is."""
    raw = _c(c)
    val = clean_price(raw)
    return (F.when(raw.isNull() | (raw == ""), F.lit("N/A"))
            .when(val.isNull(), raw)
            .otherwise(F.concat(F.lit("$"), F.format_number(val, 2))))


def numeric_coerce(c) -> Column:
    """Keep [0-9.] and cast; anything unreadable becomes NULL."""
    return F.nullif(F.regexp_replace(_c(c).cast("string"), r"[^0-9.]", ""), F.lit("")).try_cast("double")


def _bins(x: Column, labels: list[str], right: bool) -> Column:
    edges = PRICE_EDGES + [float("inf")]
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = ((x > lo) & (x <= hi)) if right else ((x >= lo) & (x < hi))
        out = F.when(cond, lab) if out is None else out.when(cond, lab)
    return out


def price_category(c) -> Column:
    """Left-closed bins [0,5K) [5K,15K) [15K,30K) [30K,60K) [60K,inf)."""
    return _bins(_c(c), PRICE_CATEGORY_LABELS, right=False)


def price_segment(c) -> Column:
    """Right-closed bins (0,5K] ... (60K,inf]; 0 and below -> NULL."""
    return _bins(_c(c), PRICE_SEGMENT_LABELS, right=True)


def segment_ordinal(c) -> Column:
    """Position of a segment label (0..4) for ordered output."""
    return F.array_position(F.array(*[F.lit(v) for v in PRICE_SEGMENT_LABELS]), _c(c)).cast("int") - 1
