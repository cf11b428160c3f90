"""Keys for aggregations, crosstabs, top-k and profiles."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators import segments as S
from ..operators.dedup import dedup_report
from ..operators.cleaning import null_sentinels
from ..operators.encode import label_encode
from ..operators.model import CATEGORICAL
from ..operators.runlog import events_run_log, run_status_rollup, task_durations
from ..schemas import PRICE_SEGMENT_LABELS
from ..session import cut_lineage
from .catalog import analysis, clean, raw, register
from .oracle import lit, q, with_ctes

SEGQ = q("Price Segment")
SEG_DIM = "SELECT * FROM (VALUES " + ", ".join(f"({i}, {lit(v)})" for i, v in enumerate(PRICE_SEGMENT_LABELS)) + \
    ") t(segment_order, segment)"


def _top(col: str) -> str:
    return (f"SELECT {q(col)} AS v FROM analysis WHERE {q(col)} IS NOT NULL GROUP BY 1 "
            f"ORDER BY count(*) DESC, v ASC LIMIT 5")


TOPPED = [("seg_dim", SEG_DIM), ("top_ext", _top("Exterior")), ("top_state", _top("State")),
          ("topped", "SELECT a.*, CASE WHEN e.v IS NOT NULL THEN a.\"Exterior\" ELSE 'Other' END AS \"Top Exterior Color\", "
                     "CASE WHEN t.v IS NOT NULL THEN a.\"State\" ELSE 'Unmatched' END AS \"Top State\" FROM analysis a "
                     "LEFT JOIN top_ext e ON a.\"Exterior\" = e.v LEFT JOIN top_state t ON a.\"State\" = t.v")]


def A(select: str, extra=None) -> str:
    return with_ctes(["analysis"], select, TOPPED + (extra or []))


# ---------------------------------------------------------------------------
# counts
# ---------------------------------------------------------------------------
@register("dedup_report", with_ctes(["listing_cleaned"], 'SELECT count(*) AS before, '
                                    '(count(DISTINCT "VIN") + max(CASE WHEN "VIN" IS NULL THEN 1 ELSE 0 END)) AS after, '
                                    'count(*) - (count(DISTINCT "VIN") + max(CASE WHEN "VIN" IS NULL THEN 1 ELSE 0 END)) '
                                    'AS removed FROM listing_cleaned'))
def _dedup_report(s, d):
    return dedup_report(null_sentinels(raw(s, d)))


@register("value_counts", A('SELECT "Location" AS value, count(*) AS n FROM analysis WHERE "Location" IS NOT NULL '
                            'GROUP BY 1 ORDER BY n DESC, value'))
def _value_counts(s, d):
    return S.value_counts(analysis(s, d), "Location")


@register("segment_counts", A(f"SELECT segment_order, segment, coalesce(n, 0) AS n FROM seg_dim LEFT JOIN "
                              f"(SELECT {SEGQ} AS segment, count(*) AS n FROM analysis WHERE {SEGQ} IS NOT NULL "
                              f"GROUP BY 1) c USING (segment) ORDER BY segment_order"))
def _segment_counts(s, d):
    return S.segment_counts(analysis(s, d))


def _ct_sql(name, row, col, src="topped"):
    return (f"SELECT '{name}' AS crosstab, CAST({q(row)} AS VARCHAR) AS row_value, CAST({q(col)} AS VARCHAR) AS col_value, "
            f"count(*) AS n FROM {src} WHERE {q(row)} IS NOT NULL AND {q(col)} IS NOT NULL GROUP BY 2, 3")


CT3 = [("make_by_segment", "Car Make", "Price Segment"), ("year_by_segment", "Year of Manufacture", "Price Segment"),
       ("segment_by_financing", "Price Segment", "Financing Support")]


@register("crosstab_counts", A(" UNION ALL ".join(_ct_sql(*t) for t in CT3)))
def _crosstab_counts(s, d):
    return S.crosstab_many(analysis(s, d), CT3).drop("pct")


def _pct_sql(name, row, col):
    return (f"SELECT '{name}' AS crosstab, row_value, col_value, n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY row_value) "
            f"AS pct FROM ({_ct_sql(name, row, col)})")


@register("crosstab_pct", A(" UNION ALL ".join(_pct_sql(*t) for t in S.CROSSTABS)))
def _crosstab_pct(s, d):
    return S.crosstab_many(S.with_top_columns(cut_lineage(analysis(s, d))), S.CROSSTABS).drop("n")


def _seg_sql(aggs: str) -> str:
    return (f"SELECT segment_order, segment, g.* EXCLUDE (segment) FROM seg_dim LEFT JOIN "
            f"(SELECT {SEGQ} AS segment, {aggs} FROM analysis WHERE {SEGQ} IS NOT NULL GROUP BY 1) g USING (segment) "
            f"ORDER BY segment_order")


@register("segment_mpg", A(_seg_sql('avg("City MPG") AS city_mpg, avg("Highway MPG") AS highway_mpg')))
def _segment_mpg(s, d):
    return S.segment_mpg(analysis(s, d))


@register("segment_listed_days", A(_seg_sql('avg("Listed Days") AS listed_days')))
def _segment_listed_days(s, d):
    return S.segment_listed_days(analysis(s, d))


_MILEAGE_AGGS = ('avg("Mileage") AS mean, quantile_cont("Mileage", 0.5) AS median, min("Mileage") AS min, '
                 'max("Mileage") AS max, count("Mileage") AS count')


@register("segment_mileage", A(
    f"SELECT segment_order, segment, mean, median, min, max, coalesce(count, 0) AS count FROM ({_seg_sql(_MILEAGE_AGGS)})"))
def _segment_mileage(s, d):
    return S.segment_mileage(analysis(s, d))


def _report_sql() -> str:
    parts = [f"SELECT 'count' AS section, segment, 'n' AS key, CAST(coalesce(n, 0) AS DOUBLE) AS value FROM seg_dim "
             f"LEFT JOIN (SELECT {SEGQ} AS segment, count(*) AS n FROM topped WHERE {SEGQ} IS NOT NULL GROUP BY 1) "
             f"USING (segment)"]
    for name, row, col in S.CROSSTABS:
        parts.append(f"SELECT '{name}' AS section, row_value AS segment, col_value AS key, pct AS value "
                     f"FROM ({_pct_sql(name, row, col)})")
    mpg = _seg_sql('avg("City MPG") AS city_mpg, avg("Highway MPG") AS highway_mpg')
    parts.append(f"SELECT 'mpg', segment, 'city_mpg', city_mpg FROM ({mpg})")
    parts.append(f"SELECT 'mpg', segment, 'highway_mpg', highway_mpg FROM ({mpg})")
    parts.append(f"SELECT 'listed_days', segment, 'mean', listed_days FROM ({_seg_sql('avg(\"Listed Days\") AS listed_days')})")
    mi = _seg_sql(_MILEAGE_AGGS)
    for k in ("mean", "median", "min", "max"):
        parts.append(f"SELECT 'mileage', segment, '{k}', {k} FROM ({mi})")
    parts.append(f"SELECT 'mileage', segment, 'count', CAST(coalesce(count, 0) AS DOUBLE) FROM ({mi})")
    return " UNION ALL ".join(f"({p})" for p in parts)


@register("segment_report", A(_report_sql()))
def _segment_report(s, d):
    return S.segment_report(analysis(s, d))


# ---------------------------------------------------------------------------
# top-k / limits
# ---------------------------------------------------------------------------
@register("top_n_else_other", A('SELECT "VIN", "Top Exterior Color", "Top State" FROM topped'))
def _top_n_else_other(s, d):
    return S.with_top_columns(cut_lineage(analysis(s, d).select("VIN", "Exterior", "State"))).select("VIN", "Top Exterior Color", "Top State")


@register("top_k_values", A('SELECT "Exterior" AS value, count(*) AS n FROM analysis WHERE "Exterior" IS NOT NULL '
                            'GROUP BY 1 ORDER BY n DESC, value LIMIT 5'))
def _top_k_values(s, d):
    return S.top_k_values(analysis(s, d), "Exterior", 5)


@register("head_n", with_ctes(["clean_listing"], 'SELECT * FROM clean_listing ORDER BY "VIN" ASC NULLS FIRST LIMIT 5'))
def _head_n(s, d):
    return S.head_n(clean(s, d), 5, "VIN")


@register("limit_per_group", with_ctes(["clean_listing"], 'SELECT * FROM (SELECT "Car Make", "VIN", "Cash Price (USD)", '
                                       'row_number() OVER (PARTITION BY "Car Make" ORDER BY "Cash Price (USD)" ASC, '
                                       '"VIN" ASC NULLS FIRST) AS rank FROM clean_listing) WHERE rank <= 3'))
def _limit_per_group(s, d):
    c = clean(s, d).select("Car Make", "VIN", "Cash Price (USD)")
    return S.limit_per_group(c, "Car Make", [F.col("`Cash Price (USD)`").asc(), F.col("VIN").asc_nulls_first()], 3)


@register("distinct_values", A('SELECT DISTINCT "State" FROM analysis WHERE "State" IS NOT NULL ORDER BY 1'))
def _distinct_values(s, d):
    return S.distinct_values(analysis(s, d), "State")


@register("unpivot_metrics", A("SELECT \"VIN\", 'City MPG' AS metric, \"City MPG\" AS value FROM analysis UNION ALL "
                               "SELECT \"VIN\", 'Highway MPG', \"Highway MPG\" FROM analysis"))
def _unpivot_metrics(s, d):
    return S.unpivot_metrics(analysis(s, d), ["VIN"], ["City MPG", "Highway MPG"])


# ---------------------------------------------------------------------------
# profiles
# ---------------------------------------------------------------------------
NUMERIC = ["Year of Manufacture", "Cash Price (USD)", "Mileage", "City MPG", "Highway MPG"]


def _describe_sql() -> str:
    parts = []
    for c in NUMERIC:
        x = q(c)
        parts.append(f"SELECT '{c}' AS \"column\", count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, "
                     f"min({x}) AS min, quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
                     f"quantile_cont({x}, 0.75) AS p75, max({x}) AS max FROM clean_listing")
    return " UNION ALL ".join(parts)


@register("describe_numeric", with_ctes(["clean_listing"], _describe_sql()))
def _describe_numeric(s, d):
    return P.describe_numeric(clean(s, d), NUMERIC)


CLEAN_COLUMNS = ["Year of Manufacture", "Car Make", "Car Full Title", "Cash Price (USD)", "VIN", "Mileage", "Fuel Type",
                 "MPG", "Exterior", "Interior", "Transmission", "Engine", "Location", "Listed Since", "Stock Number",
                 "Features", "Drivetrain", "Financing Support", "City MPG", "Highway MPG", "Price Category"]
_DOUBLES = set(NUMERIC)


@register("column_profile", with_ctes(["clean_listing"], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{'double' if c in _DOUBLES else 'string'}' AS dtype, count({q(c)}) AS non_null "
    f"FROM clean_listing" for c in CLEAN_COLUMNS)))
def _column_profile(s, d):
    return P.column_profile(clean(s, d).select(*[F.col(f"`{c}`") for c in CLEAN_COLUMNS]))


@register("quality_metrics", with_ctes(["clean_listing"], " UNION ALL ".join(
    ["SELECT 'total_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM clean_listing"]
    + [f"SELECT 'missing:{c}', CAST(sum(CASE WHEN {q(c)} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) FROM clean_listing"
       for c in CLEAN_COLUMNS]
    + ["SELECT 'price_min', min(\"Cash Price (USD)\") FROM clean_listing",
       "SELECT 'price_max', max(\"Cash Price (USD)\") FROM clean_listing",
       "SELECT 'price_mean', avg(\"Cash Price (USD)\") FROM clean_listing"])))
def _quality_metrics(s, d):
    return P.quality_metrics(clean(s, d).select(*[F.col(f"`{c}`") for c in CLEAN_COLUMNS]))


# The nine label-encoded columns and the six numbers.
CORR_COLS = NUMERIC + ["Listed Days"] + CATEGORICAL


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(CORR_COLS):
        for j, b in enumerate(CORR_COLS):
            if i == j:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, CASE WHEN count({q(a)}) > 1 THEN 1.0 END AS corr "
                             f"FROM analysis")
            else:
                parts.append(f"SELECT '{a}', '{b}', corr({q(a)}, {q(b)}) FROM analysis")
    coded = ", ".join(f"(dense_rank() OVER (ORDER BY {q(c)} ASC NULLS LAST) - 1)::DOUBLE AS {q(c)}" for c in CATEGORICAL)
    return with_ctes(["analysis"], " UNION ALL ".join(parts).replace("FROM analysis", "FROM src"),
                     [("src", f"SELECT {', '.join(q(c) for c in NUMERIC + ['Listed Days'])}, {coded} FROM analysis")])


@register("correlation_matrix", _corr_sql())
def _correlation_matrix(s, d):
    a = cut_lineage(analysis(s, d).select(*[F.col(f"`{c}`") for c in CORR_COLS]))
    return P.correlation_matrix(label_encode(a, CATEGORICAL), CORR_COLS)


@register("boxplot_summary", A(f"""
SELECT grp AS "Price Segment", q1, median, q3,
  min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_low,
  max(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_high,
  sum(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END) AS n_outliers,
  count(*) AS n
FROM (SELECT {SEGQ} AS grp, CAST("Mileage" AS DOUBLE) AS v FROM analysis WHERE {SEGQ} IS NOT NULL AND "Mileage" IS NOT NULL) b
JOIN (SELECT {SEGQ} AS grp, quantile_cont(CAST("Mileage" AS DOUBLE), 0.25) AS q1,
             quantile_cont(CAST("Mileage" AS DOUBLE), 0.5) AS median, quantile_cont(CAST("Mileage" AS DOUBLE), 0.75) AS q3
      FROM analysis WHERE {SEGQ} IS NOT NULL AND "Mileage" IS NOT NULL GROUP BY 1) qq USING (grp)
GROUP BY grp, q1, median, q3"""))
def _boxplot_summary(s, d):
    return P.boxplot_summary(analysis(s, d), "Price Segment", "Mileage")


@register("histogram_by_group", A(f"""
SELECT grp AS "Price Segment", bin, lo + (bin - 1) * (hi - lo) / 30.0 AS bin_lo, count(*) AS n FROM (
  SELECT grp, lo, hi, CAST(CASE WHEN hi - lo = 0 THEN 1 ELSE least(floor((v - lo) * 30.0 / (hi - lo)) + 1, 30) END AS INTEGER) AS bin
  FROM (SELECT {SEGQ} AS grp, CAST("Listed Days" AS DOUBLE) AS v FROM analysis
        WHERE {SEGQ} IS NOT NULL AND "Listed Days" IS NOT NULL) b,
       (SELECT min(CAST("Listed Days" AS DOUBLE)) AS lo, max(CAST("Listed Days" AS DOUBLE)) AS hi FROM analysis
        WHERE {SEGQ} IS NOT NULL AND "Listed Days" IS NOT NULL) m)
GROUP BY grp, bin, lo, hi"""))
def _histogram_by_group(s, d):
    return P.histogram_by_group(analysis(s, d), "Price Segment", "Listed Days", 30)


# ---------------------------------------------------------------------------
# run log roll-up (the driver's events stand in for task runs)
# ---------------------------------------------------------------------------
RUNLOG_SQL = """
WITH log AS (
  SELECT user_id AS run_id, event_type || '#' || CAST(event_id AS VARCHAR) AS task_id,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' ELSE 'success' END AS status,
         ts AS start_time,
         CASE WHEN event_type = 'view' THEN NULL
              ELSE make_timestamp(epoch_us(ts) + CAST(floor(value * 1000000.0) AS BIGINT)) END AS end_time
  FROM events)
SELECT run_id, count(*) AS n_tasks,
  sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS n_failed,
  sum(CASE WHEN status = 'running' THEN 1 ELSE 0 END) AS n_running,
  CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_and(status = 'success') THEN 'success'
       ELSE 'running' END AS overall_status,
  (epoch_us(max(end_time)) - epoch_us(min(start_time))) / 1000000.0 AS duration_s
FROM log GROUP BY run_id"""


@register("run_status_rollup", RUNLOG_SQL)
def _run_status_rollup(s, d):
    return run_status_rollup(events_run_log(s.read.parquet(f"{d}/events.parquet")))


_TOOK = "CASE WHEN event_type <> 'view' THEN floor(value * 1000000.0) / 1000000.0 END"


@register("duration_seconds", f"SELECT event_type || '#' || CAST(event_id AS VARCHAR) AS task_id, {_TOOK} AS duration_s, "
                              f"printf('%.2fs', {_TOOK}) AS duration FROM events")
def _duration_seconds(s, d):
    return task_durations(events_run_log(s.read.parquet(f"{d}/events.parquet"))).select("task_id", "duration_s", "duration")
