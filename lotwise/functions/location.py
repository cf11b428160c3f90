"""State extraction from a free-text dealer location."""
from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import STATE_CODES

__all__ = ["extract_state"]


def extract_state(c, fixed: bool = False) -> Column:
    """'City, xx' -> full lower-case state name ('xx' upper-cased when not a
    known code); otherwise the first dictionary entry whose code or name is a
    substring of the lower-cased text; otherwise NULL.

    ``fixed`` matches the code and the name as whole words only, so
    'Portland, Oregon' gives 'oregon' instead of 'louisiana'.
    """
    raw = F.col(c) if isinstance(c, str) else c
    loc = F.lower(raw)
    code = F.regexp_extract(loc, r",\s*([a-z]{2})\s*$", 1)
    code_map = F.create_map(*chain.from_iterable((F.lit(k.lower()), F.lit(n)) for n, k in STATE_CODES))
    ladder = None
    for name, k in STATE_CODES:
        if fixed:
            cond = loc.rlike(rf"\b{k.lower()}\b") | loc.rlike(rf"\b{name}\b")
        else:
            cond = loc.contains(k.lower()) | loc.contains(name)
        ladder = F.when(cond, F.lit(name)) if ladder is None else ladder.when(cond, F.lit(name))
    return (F.when(raw.isNull(), F.lit(None).cast("string"))
            .when(code != "", F.coalesce(F.element_at(code_map, code), F.upper(code)))
            .otherwise(ladder))
