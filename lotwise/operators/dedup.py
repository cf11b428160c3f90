"""Deterministic de-duplication by key."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# A run of text columns as one text whose order is theirs: each value after a mark (PRESENT or, later in
# order, MISSING) and before END; END and ESCAPE inside values are written as two characters.
_END, _ESCAPE, _PRESENT, _MISSING = "\x00", "\x01", "\x02", "\x03"


def pack_texts(cols: list[Column]) -> Column:
    """Text columns as one text that compares as they do left to right, NULL last. It has neither
    the eight-byte slots nor the padding of a row's columns, so less is sorted and shuffled."""
    parts = []
    for c in cols:
        safe = F.replace(F.replace(c, F.lit(_ESCAPE), F.lit(_ESCAPE + "\x02")), F.lit(_END), F.lit(_ESCAPE + "\x01"))
        parts.append(F.coalesce(F.concat(F.lit(_PRESENT), safe, F.lit(_END)), F.lit(_MISSING + _END)))
    return F.concat(*parts)


def unpack_texts(packed: Column, n: int) -> Column:
    """The ``n`` texts of ``pack_texts`` as an array. Texts that hold an escape, or bytes that are
    no UTF-8 (splitting would change them), are cut byte by byte."""
    def part(i: Column) -> Column:
        p = F.substring_index(F.call_function("substring_index", packed, F.lit(_END), i + 1), _END, -1)
        value = F.replace(F.replace(F.substr(p, F.lit(2)), F.lit(_ESCAPE + "\x01"), F.lit(_END)), F.lit(_ESCAPE + "\x02"), F.lit(_ESCAPE))
        return F.when(F.startswith(p, F.lit(_PRESENT)), value)

    def plain(p: Column) -> Column:
        return F.when(F.startswith(p, F.lit(_PRESENT)), F.substr(p, F.lit(2)))

    return F.when(F.is_valid_utf8(packed) & ~F.contains(packed, F.lit(_ESCAPE)), F.transform(F.slice(F.split(packed, _END, -1), 1, n), plain)) \
        .otherwise(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), part))


def packed_row(df: DataFrame, key: str) -> tuple[Column, list[Column], dict[str, Column]]:
    """The columns of ``df`` but ``key`` as a struct that compares as they do left to right, NULL last; and,
    over that struct as ``__row``, the arrays of its texts and each column again. Neighbouring text columns are packed."""
    fields, arrays, back, run = [], [], {}, []

    def close() -> None:
        if run:
            name = f"t{len(fields)}"
            fields.append(pack_texts([F.col(f"`{c}`") for c in run]).alias(name))
            arrays.append(unpack_texts(F.col(f"__row.{name}"), len(run)).alias(f"__{name}"))
            back.update({c: F.col(f"__{name}")[i] for i, c in enumerate(run)})
            run.clear()

    for i, c in enumerate(c for c in df.columns if c != key):
        if df.schema[c].dataType == T.StringType():
            run.append(c)
            continue
        close()  # (is NULL, value) pairs order NULLs after values
        fields += [F.col(f"`{c}`").isNull().alias(f"n{i}"), F.col(f"`{c}`").alias(f"c{i}")]
        back[c] = F.col(f"__row.c{i}")
    close()
    return F.struct(*fields), arrays, back


def dedup_by_key(df: DataFrame, key: str = "VIN") -> DataFrame:
    """One row per key value (NULL is one group, as in ``dropDuplicates``).

    The survivor is the row whose remaining columns, compared left to right
    (NULL last, so the more complete copy wins), are smallest, so reruns and
    both engines agree. Written as
    ``groupBy().agg(min(struct))`` so the partial aggregate collapses a hot
    key on the map side before the shuffle: a key holding a third of all rows
    costs one row per map partition, not one huge sort group. Rows are packed
    before they are grouped, so what a task sorts is the packed rows.
    """
    row, arrays, back = packed_row(df, key)
    packed = df.select(F.col(f"`{key}`"), row.alias("__row"))
    agg = packed.groupBy(F.col(f"`{key}`")).agg(F.min("__row").alias("__row")).select("*", *arrays)
    return agg.select([F.col(f"`{key}`") if c == key else back[c].alias(c) for c in df.columns])


def dedup_report(df: DataFrame, key: str = "VIN") -> DataFrame:
    """(before, after, removed): rows, distinct keys (NULL counted once), difference."""
    k = F.col(f"`{key}`")
    out = df.agg(F.count(F.lit(1)).alias("before"),
                 (F.count_distinct(k) + F.max(F.when(k.isNull(), 1).otherwise(0))).alias("after"))
    return out.select("before", F.col("after").cast("bigint").alias("after"),
                      (F.col("before") - F.col("after")).cast("bigint").alias("removed"))
