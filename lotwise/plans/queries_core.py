"""Keys for scalar functions, projections, the ETL transform, warehouse split,
joins and search (SURVEY 2.2, 2.3, 2.8, 2.12 transform)."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import functions as L
from ..operators import cleaning as C
from ..operators.dedup import dedup_by_key
from ..operators.search import SearchCriteria, ilike_contains, order_by_price, price_between, search_serving
from ..operators.transform import transform_listings
from ..operators.trigrams import search_indexed, write_indexed
from ..operators.warehouse import anti_join_existing, listing_wide
from ..schemas import TRANSFORMED_COLUMNS
from ..session import scratch_path
from . import oracle as O
from ..streaming.events import encode_events
from .catalog import FLAGSHIP, analysis, clean, listing, raw, register, serving, staged, tables, wide
from .oracle import q, with_ctes


def _c(n):
    return F.col(f"`{n}`")


def R(select: str, needs=("raw_listing",)) -> str:
    return with_ctes(list(needs), select)


# ---------------------------------------------------------------------------
# 2.8 scalar functions (over every raw listing row)
# ---------------------------------------------------------------------------
@register("year_of_title", R(f'SELECT "Title", {O.year_of_title(q("Title"))} AS year_of_title FROM raw_listing'))
def _year_of_title(s, d):
    return raw(s, d).select("Title", L.year_of_title("Title").alias("year_of_title"))


@register("make_of_title", R(f'SELECT "Title", {O.make_of_title(q("Title"))} AS make_of_title FROM raw_listing'))
def _make_of_title(s, d):
    return raw(s, d).select("Title", L.make_of_title("Title").alias("make_of_title"))


@register("strip_dollar", R(f'SELECT "Cash Price", {O.strip_dollar(q("Cash Price"))} AS price_text FROM raw_listing'))
def _strip_dollar(s, d):
    return raw(s, d).select("Cash Price", L.strip_dollar("Cash Price").alias("price_text"))


@register("first_integer", R(
    f'SELECT "Finance Price", {O.first_integer(q("Finance Price"))} AS monthly, '
    f'{O.first_integer("replace(" + q("Finance Price") + ", \',\', \'\')")} AS monthly_fixed FROM raw_listing'))
def _first_integer(s, d):
    return raw(s, d).select("Finance Price", L.first_integer("Finance Price").alias("monthly"),
                            L.first_integer("Finance Price", fixed=True).alias("monthly_fixed"))


@register("split_finance", R(
    f'SELECT "Finance Details", {O.chunk(q("Finance Details"), 0)} AS chunk1, '
    f'{O.chunk(q("Finance Details"), 1)} AS chunk2, {O.chunk(q("Finance Details"), 2)} AS chunk3 FROM raw_listing'))
def _split_finance(s, d):
    fd = _c("Finance Details")
    return raw(s, d).select(fd, *[L.finance_chunk(fd, i).alias(f"chunk{i + 1}") for i in range(3)])


@register("down_payment", R(
    f'SELECT "Finance Details", {O.down_payment(O.chunk(q("Finance Details"), 0))} AS down_payment FROM raw_listing'))
def _down_payment(s, d):
    fd = _c("Finance Details")
    return raw(s, d).select(fd, L.down_payment(L.finance_chunk(fd, 0)).alias("down_payment"))


@register("apr", R(f'SELECT "Finance Details", {O.apr(O.chunk(q("Finance Details"), 2))} AS apr FROM raw_listing'))
def _apr(s, d):
    fd = _c("Finance Details")
    return raw(s, d).select(fd, L.apr(L.finance_chunk(fd, 2)).alias("apr"))


@register("mileage_digits", R(f'SELECT "Mileage", {O.mileage_digits(q("Mileage"))} AS mileage_digits FROM raw_listing'))
def _mileage_digits(s, d):
    return raw(s, d).select("Mileage", L.mileage_digits("Mileage").alias("mileage_digits"))


@register("price_numeric_sql", R(f'SELECT "Cash Price", {O.price_numeric(q("Cash Price"))} AS price FROM raw_listing'))
def _price_numeric(s, d):
    return raw(s, d).select("Cash Price", L.price_numeric("Cash Price").alias("price"))


@register("clean_price", R(f'SELECT "Cash Price", {O.clean_price(q("Cash Price"))} AS price FROM raw_listing'))
def _clean_price(s, d):
    return raw(s, d).select("Cash Price", L.clean_price("Cash Price").alias("price"))


@register("format_price", R(f'SELECT "Cash Price", {O.format_price(q("Cash Price"))} AS shown FROM raw_listing'))
def _format_price(s, d):
    return raw(s, d).select("Cash Price", L.format_price("Cash Price").alias("shown"))


@register("numeric_coerce", R(
    f'SELECT "Cash Price", "Mileage", {O.numeric_coerce(q("Cash Price"))} AS price, '
    f'{O.numeric_coerce(q("Mileage"))} AS miles FROM raw_listing'))
def _numeric_coerce(s, d):
    return raw(s, d).select("Cash Price", "Mileage", L.numeric_coerce("Cash Price").alias("price"),
                            L.numeric_coerce("Mileage").alias("miles"))


@register("mpg_city_highway", R(
    f'SELECT "MPG", {O.mpg(q("MPG"), 1)} AS city_mpg, {O.mpg(q("MPG"), 2)} AS highway_mpg FROM raw_listing'))
def _mpg(s, d):
    return raw(s, d).select("MPG", L.mpg_city("MPG").alias("city_mpg"), L.mpg_highway("MPG").alias("highway_mpg"))


@register("title_case", R(
    f'SELECT "Title", "Exterior", "Location", {O.title_case(q("Title"))} AS title_tc, '
    f'{O.title_case(q("Exterior"))} AS exterior_tc, {O.title_case(q("Location"))} AS location_tc FROM raw_listing'))
def _title_case(s, d):
    return raw(s, d).select("Title", "Exterior", "Location", L.title_case("Title").alias("title_tc"),
                            L.title_case("Exterior").alias("exterior_tc"), L.title_case("Location").alias("location_tc"))


@register("extract_state", R(f'SELECT "Location", {O.extract_state(q("Location"))} AS state FROM raw_listing'))
def _extract_state(s, d):
    return raw(s, d).select("Location", L.extract_state("Location").alias("state"))


@register("listed_days", R(f'SELECT "Listed Since", {O.listed_days(q("Listed Since"))} AS listed_days FROM raw_listing'))
def _listed_days(s, d):
    return raw(s, d).select("Listed Since", L.listed_days("Listed Since").alias("listed_days"))


_SPLIT_FEAT = "list_filter(list_transform(string_split({0}, '{1}'), lambda x: trim(x)), lambda x: x <> '')"


@register("split_features", R(
    f'SELECT "Features", len({_SPLIT_FEAT.format(q("Features"), ";")}) AS n_features, '
    f'array_to_string({_SPLIT_FEAT.format(q("Features"), ";")}, \'|\') AS items FROM raw_listing'))
def _split_features(s, d):
    arr = L.split_features("Features")
    return raw(s, d).select("Features", F.size(arr).alias("n_features"), F.array_join(arr, "|").alias("items"))


@register("feature_join", R(
    f'SELECT "Features", array_to_string({_SPLIT_FEAT.format(q("Features"), ";")}, \'; \') AS rejoined FROM raw_listing'))
def _feature_join(s, d):
    return raw(s, d).select("Features", L.feature_join(L.split_features("Features")).alias("rejoined"))


@register("features_lines", R(
    "SELECT \"Features\", array_to_string(" + _SPLIT_FEAT.format("replace(" + q("Features") + ", '; ', chr(10))", "\n")
    + ", '|') AS lines FROM raw_listing"))
def _features_lines(s, d):
    lines = F.regexp_replace(_c("Features"), "; ", "\n")
    return raw(s, d).select("Features", F.array_join(L.features_lines(lines), "|").alias("lines"))


@register("date_keys", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day_key, "
                       "strftime(ts, '%Y%m%d%H%M%S') AS ts_key FROM events")
def _date_keys(s, d):
    ev = s.read.parquet(f"{d}/events.parquet")
    return ev.select("event_id", L.date_key("ts").alias("day_key"), L.timestamp_key("ts").alias("ts_key"))


@register("event_json_decode", "SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _event_json_decode(s, d):
    ev = s.read.parquet(f"{d}/events.parquet")
    return ev.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@register("event_json_encode",
          "SELECT event_id, '{\"status\":\"' || event_type || '\",\"timestamp\":\"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') "
          "|| '\",\"source\":\"events\",\"data_info\":{\"user_id\":\"' || CAST(user_id AS VARCHAR) || '\"}}' AS message FROM events")
def _event_json_encode(s, d):
    """Every event as a message of the event contract."""
    ev = s.read.parquet(f"{d}/events.parquet").withColumn("origin", F.lit("events"))
    return encode_events(ev, "event_id", "event_type", "ts", "origin", ["user_id"]) \
        .select(F.col("key").cast("bigint").alias("event_id"), F.col("value").alias("message"))


# ---------------------------------------------------------------------------
# 2.2 projections / filters
# ---------------------------------------------------------------------------
@register("null_sentinels", with_ctes(["listing_cleaned"], "SELECT * FROM listing_cleaned"))
def _null_sentinels(s, d):
    return C.null_sentinels(raw(s, d))


@register("null_tokens", with_ctes(["clean_tokens"], "SELECT * FROM clean_tokens"))
def _null_tokens(s, d):
    return C.null_tokens(listing(s, d))


@register("drop_if_present", R('SELECT * EXCLUDE ("Finance Price", "Finance Details", page, idx) FROM raw_listing'))
def _drop_if_present(s, d):
    return C.drop_if_present(raw(s, d), "Finance Price", "Finance Details", "page", "idx", "datalake_metadata")


@register("rename_columns", R('SELECT * EXCLUDE (page, idx) RENAME ("Cash Price" AS "Cash Price (USD)", '
                              '"Finance Price" AS "Installment Per Month") FROM raw_listing'))
def _rename_columns(s, d):
    return C.rename_columns(raw(s, d).drop("page", "idx"),
                            {"Cash Price": "Cash Price (USD)", "Finance Price": "Installment Per Month"})


@register("project_final", R("SELECT " + ", ".join(
    (q(c) if c in ("VIN", "Mileage", "Fuel Type", "MPG", "Exterior", "Interior", "Transmission", "Engine",
                   "Location", "Listed Since", "Stock Number", "Features") else f"CAST(NULL AS VARCHAR) AS {q(c)}")
    for c in TRANSFORMED_COLUMNS) + " FROM raw_listing"))
def _project_final(s, d):
    return C.project_final(raw(s, d), TRANSFORMED_COLUMNS)


@register("require_columns", with_ctes(["listing"], "SELECT * FROM listing"))
def _require_columns(s, d):
    return C.require_columns(listing(s, d), ["Cash Price (USD)", "Mileage", "MPG"])


@register("not_null_key", with_ctes(["listing"], 'SELECT * FROM listing WHERE "VIN" IS NOT NULL'))
def _not_null_key(s, d):
    return C.not_null_key(listing(s, d))


@register("installment_flag", with_ctes(["listing"], 'SELECT "VIN", "Down Payment", "Down Payment" IS NOT NULL AS '
                                                     'installment, nullif("Down Payment", \'\') IS NOT NULL AS '
                                                     'installment_fixed FROM listing'))
def _installment_flag(s, d):
    return listing(s, d).select("VIN", "Down Payment", C.installment_flag("Down Payment").alias("installment"),
                                C.installment_flag("Down Payment", fixed=True).alias("installment_fixed"))


@register("typed_cast", with_ctes(["listing"], 'SELECT "VIN", TRY_CAST("Year of Manufacture" AS INTEGER) AS year, '
                                               'TRY_CAST("Loan Term (Months)" AS INTEGER) AS loan_term FROM listing'))
def _typed_cast(s, d):
    return listing(s, d).select("VIN", C.typed_cast("Year of Manufacture").alias("year"),
                                C.typed_cast("Loan Term (Months)").alias("loan_term"))


@register("transform_listings", with_ctes(["listing"], "SELECT * FROM listing"))
def _transform_listings(s, d):
    return transform_listings(raw(s, d))


for _name in ("car_info", "installment_info", "in_exterior", "evaluate", "engine_info", "other_detail"):
    register(_name, with_ctes([_name], f"SELECT * FROM {_name}"))(
        lambda s, d, _n=_name: tables(s, d)[_n])

_SPLIT = ["car_info", "installment_info", "in_exterior", "evaluate", "engine_info", "other_detail"]


@register("vertical_split", with_ctes(_SPLIT, " UNION ALL ".join(f"SELECT '{t}' AS \"table\", \"VIN\" FROM {t}" for t in _SPLIT)))
def _vertical_split(s, d):
    """The keys of all six tables (their other columns have a key of their own each)."""
    out = None
    for name, df in tables(s, d).items():
        part = df.select(F.lit(name).alias("table"), "VIN")
        out = part if out is None else out.unionAll(part)
    return out


@register("register_view", with_ctes(["listing"], 'SELECT "VIN", "Car Make" FROM listing WHERE "VIN" IS NOT NULL'))
def _register_view(s, d):
    listing(s, d).createOrReplaceTempView("transformed_cars")
    try:
        return s.sql("SELECT VIN, `Car Make` FROM transformed_cars WHERE VIN IS NOT NULL")
    finally:  # the plan is resolved; no later key sees the view
        s.catalog.dropTempView("transformed_cars")


@register("any_non_null", with_ctes(["clean_listing"], 'SELECT "VIN", "Financing Support" FROM clean_listing'))
def _any_non_null(s, d):
    return clean(s, d).select("VIN", "Financing Support")


@register("range_validate", with_ctes(["clean_listing"], 'SELECT "VIN", "Cash Price (USD)", "Mileage", "City MPG", '
                                                         '"Highway MPG", "Year of Manufacture" FROM clean_listing'))
def _range_validate(s, d):
    return clean(s, d).select("VIN", "Cash Price (USD)", "Mileage", "City MPG", "Highway MPG", "Year of Manufacture")


@register("clean_for_analysis", with_ctes(["clean_listing"], "SELECT * FROM clean_listing"))
def _clean_for_analysis(s, d):
    return clean(s, d)


@register("price_category", with_ctes(["clean_listing"], 'SELECT "VIN", "Cash Price (USD)", "Price Category" '
                                                         'FROM clean_listing'))
def _price_category(s, d):
    return clean(s, d).select("VIN", "Cash Price (USD)", "Price Category")


@register("price_segment", with_ctes(["analysis"], 'SELECT "VIN", "Cash Price (USD)", "Price Segment" FROM analysis'))
def _price_segment(s, d):
    return analysis(s, d).select("VIN", "Cash Price (USD)", "Price Segment")


_SHOWN = ["VIN", "Year_Of_Manufacture", "Installment_Support", "Fuel_Type", "Loan_Term"]


@register("display_or_na", with_ctes(["wide"], "SELECT " + ", ".join(
    f"coalesce(CAST({q(c)} AS VARCHAR), 'N/A') AS {q(c)}" for c in _SHOWN) + " FROM wide"))
def _display_or_na(s, d):
    return C.display_or_na(wide(s, d).select(*_SHOWN))


# ---------------------------------------------------------------------------
# 2.1 dedup step, 2.3 joins and search
# ---------------------------------------------------------------------------
@register("dedup_by_key", with_ctes(["listing_dedup"], "SELECT * FROM listing_dedup"))
def _dedup_by_key(s, d):
    return dedup_by_key(C.null_sentinels(raw(s, d)), "VIN")


@register("listing_wide", with_ctes(["wide"], "SELECT * FROM wide"))
def _listing_wide(s, d):
    return wide(s, d)


def _search_sql(where: str) -> str:
    return with_ctes(["wide"], f"SELECT * FROM wide WHERE {where}")


_P = O.price_numeric('"Car_Price_USD"')


@register("search_listings", _search_sql(
    f"contains(lower(\"Car_Make\"), 'to') AND {_P} >= 0.0 AND {_P} <= 100000.0 "
    f"AND contains(lower(\"Fuel_Type\"), 'gas') ORDER BY {_P} ASC NULLS LAST, \"VIN\""))
def _search_listings(s, d):
    return search_serving(serving(s, d), FLAGSHIP)


ALL_SET = SearchCriteria(year=2018, car_make="o", price_min=1000, price_max=60000, installment_support=True,
                         engine="gas", fuel_type="gas", features="bluetooth")


@register("dynamic_filter", _search_sql(
    f"\"Year_Of_Manufacture\" = 2018 AND contains(lower(\"Car_Make\"), 'o') AND {_P} >= 1000.0 AND {_P} <= 60000.0 "
    "AND \"Installment_Support\" = TRUE AND contains(lower(\"Engine\"), 'gas') "
    "AND contains(lower(\"Fuel_Type\"), 'gas') AND contains(lower(\"Features\"), 'bluetooth')"))
def _dynamic_filter(s, d):
    return search_serving(serving(s, d), ALL_SET, ordered=False)


@register("dynamic_filter_none", with_ctes(["wide"], "SELECT * FROM wide"))
def _dynamic_filter_none(s, d):
    return search_serving(serving(s, d), SearchCriteria(), ordered=False)


@register("ilike_contains", _search_sql("contains(lower(\"Car_Make\"), 'an') OR contains(lower(\"Features\"), '%')"))
def _ilike_contains(s, d):
    w = wide(s, d)
    return w.filter(ilike_contains("Car_Make", "AN") | ilike_contains("Features", "%"))


def _indexed(s, d) -> str:
    """The wide listings with a trigram index, written by the first user."""
    def write():
        root = scratch_path(s, f"indexed-{uuid.uuid4().hex}")
        write_indexed(wide(s, d), root, ["Car_Full_Title", "Features"], "Car_Full_Title", 4 * int(s.conf.get("spark.sql.shuffle.partitions")))
        return root
    return staged(s, d, "indexed", write)


@register("ilike_indexed", with_ctes(["wide"], "SELECT 'title' AS search, \"VIN\", \"Car_Full_Title\", \"Features\" FROM wide WHERE contains(lower(\"Car_Full_Title\"), '2018 mazda') "
                                     "UNION ALL SELECT 'features', \"VIN\", \"Car_Full_Title\", \"Features\" FROM wide WHERE \"Features\" ILIKE '%heated_s%bluetooth%'"))
def _ilike_indexed(s, d):
    """Substring searches through the trigram index: only files that may hold the text are read."""
    root, shown = _indexed(s, d), ["VIN", "Car_Full_Title", "Features"]
    return search_indexed(s, root, "Car_Full_Title", "2018 Mazda").select(F.lit("title").alias("search"), *shown) \
        .unionByName(search_indexed(s, root, "Features", "heated_s%bluetooth", raw_like=True).select(F.lit("features").alias("search"), *shown))


@register("ilike_raw", _search_sql("\"Car_Make\" ILIKE '%m_z%'"))
def _ilike_raw(s, d):
    return wide(s, d).filter(ilike_contains("Car_Make", "m_z", raw_like=True))


@register("price_between", _search_sql(f"{_P} >= 5000.0 AND {_P} <= 15000.0"))
def _price_between(s, d):
    return wide(s, d).filter(price_between("Car_Price_USD", 5000, 15000))


@register("order_by_price", with_ctes(["wide"], f"SELECT * FROM wide ORDER BY {_P} ASC NULLS LAST, \"VIN\""))
def _order_by_price(s, d):
    return order_by_price(wide(s, d))


@register("anti_join_existing", with_ctes(["listing", "car_info"], 'SELECT * FROM listing l WHERE l."VIN" IS NOT NULL '
                                          'AND NOT EXISTS (SELECT 1 FROM car_info c WHERE c."Installment_Support" '
                                          'AND c."VIN" = l."VIN")'))
def _anti_join_existing(s, d):
    t = tables(s, d)
    existing = t["car_info"].filter(F.col("Installment_Support"))
    return anti_join_existing(listing(s, d), existing)


@register("listing_wide_fanout", with_ctes(["car_info", "in_exterior"], """
SELECT ci."VIN", ie."Exterior" FROM car_info ci
LEFT JOIN (SELECT * FROM in_exterior UNION ALL SELECT "VIN", 'Repainted' AS "Exterior", "Interior" FROM in_exterior
           WHERE "Interior" = 'Beige') ie ON ci."VIN" = ie."VIN\""""))
def _listing_wide_fanout(s, d):
    """Two child rows for one parent fan the parent out (children are not unique)."""
    t = tables(s, d)
    child = t["in_exterior"].unionByName(
        t["in_exterior"].filter(F.col("Interior") == "Beige").withColumn("Exterior", F.lit("Repainted")))
    return t["car_info"].join(child, "VIN", "left").select("VIN", "Exterior")
