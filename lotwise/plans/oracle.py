"""DuckDB SQL twins of the Spark plans, used only as the correctness oracle.

Each ``*_cte`` returns the body of one CTE; :func:`with_ctes` chains the ones a
query needs. They mirror ``lotwise.plans.views`` and the operators step by
step (same survivor rule for dedup, same regexes, same bins).
"""
from __future__ import annotations

from ..schemas import (ANALYSIS_NULL_TOKENS, ETL_NULL_SENTINELS, LISTING_FIELDS, PRICE_CATEGORY_LABELS,
                       PRICE_EDGES, PRICE_SEGMENT_LABELS, STATE_CODES, TRANSFORMED_COLUMNS)
from .views import raw_listing_sql


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


RAW_COLUMNS = LISTING_FIELDS + ["page", "idx"]


# ---------------------------------------------------------------------------
# scalar twins
# ---------------------------------------------------------------------------
def year_of_title(c): return f"regexp_extract({c}, '^(\\d{{4}})', 1)"
def make_of_title(c): return f"regexp_extract({c}, '^\\d{{4}}\\s+(\\S+)', 1)"
def strip_dollar(c): return f"trim(regexp_replace({c}, '\\$', '', 'g'))"
def first_integer(c): return f"regexp_extract({c}, '(\\d+)', 1)"
def chunk(c, i): return f"string_split({c}, '·')[{i + 1}]"
def down_payment(ch): return f"regexp_replace({ch}, '[^\\d,]', '', 'g')"
def apr(ch): return f"regexp_extract({ch}, '(\\d+(\\.\\d+)?)', 1)"
def mileage_digits(c): return f"trim(regexp_replace({c}, '[^\\d,]', '', 'g'))"
def py_strip(c): return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def title_case(c):
    pieces = f"regexp_extract_all({py_strip(c)}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1)"
    return f"array_to_string(list_transform({pieces}, lambda x: upper(x[1:1]) || lower(x[2:])), '')"


def price_numeric(c):
    return f"CAST(TRY_CAST(replace(replace(replace({c}, '$', ''), ',', ''), ' ', '') AS DECIMAL(18,2)) AS DOUBLE)"


def numeric_coerce(c):
    return f"TRY_CAST(nullif(regexp_replace(CAST({c} AS VARCHAR), '[^0-9.]', '', 'g'), '') AS DOUBLE)"


MPG_RE = "'(\\d+) city / (\\d+) highway'"


def mpg(c, i): return f"TRY_CAST(nullif(regexp_extract({c}, {MPG_RE}, {i}), '') AS DOUBLE)"
def listed_days(c): return f"TRY_CAST(nullif(regexp_extract({c}, '(\\d+)', 1), '') AS DOUBLE)"


def clean_price(c):
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN 0.0 ELSE TRY_CAST(regexp_replace({c}, '[^\\d.]', '', 'g') AS DOUBLE) END"


def format_price(c):
    v = clean_price(c)
    return (f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'N/A' WHEN ({v}) IS NULL THEN {c} "
            f"ELSE '$' || format('{{:,.2f}}', {v}) END")


def _bins(x, labels, right):
    edges = PRICE_EDGES + [None]
    parts = []
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        if right:
            cond = f"{x} > {lo}" + (f" AND {x} <= {hi}" if hi is not None else f" AND {x} <= 'inf'::DOUBLE")
        else:
            cond = f"{x} >= {lo}" + (f" AND {x} < {hi}" if hi is not None else f" AND {x} < 'inf'::DOUBLE")
        parts.append(f"WHEN {cond} THEN {lit(lab)}")
    return "CASE " + " ".join(parts) + " END"


def price_category(x): return _bins(x, PRICE_CATEGORY_LABELS, right=False)
def price_segment(x): return _bins(x, PRICE_SEGMENT_LABELS, right=True)


def segment_ordinal(c):
    return "CASE " + " ".join(f"WHEN {c} = {lit(v)} THEN {i}" for i, v in enumerate(PRICE_SEGMENT_LABELS)) + " END"


def extract_state(c):
    loc = f"lower({c})"
    code = f"regexp_extract({loc}, ',\\s*([a-z]{{2}})\\s*$', 1)"
    code_case = "CASE " + " ".join(f"WHEN {code} = '{k.lower()}' THEN '{n}'" for n, k in STATE_CODES) + \
        f" ELSE upper({code}) END"
    ladder = "CASE " + " ".join(
        f"WHEN contains({loc}, '{k.lower()}') OR contains({loc}, '{n}') THEN '{n}'" for n, k in STATE_CODES) + " END"
    return f"CASE WHEN {c} IS NULL THEN NULL WHEN {code} <> '' THEN {code_case} ELSE {ladder} END"


def null_if_in(c, tokens):
    return f"CASE WHEN {c} IN ({', '.join(lit(t) for t in tokens)}) THEN NULL ELSE {c} END"


# ---------------------------------------------------------------------------
# CTE bodies
# ---------------------------------------------------------------------------
def raw_listing_cte() -> str:
    return raw_listing_sql()


def dedup_sql(src: str, key: str, columns: list[str]) -> str:
    """Same survivor as ``dedup_by_key``: smallest remaining columns, NULL last."""
    order = ", ".join(f"{q(c)} ASC NULLS LAST" for c in columns if c != key)
    return (f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY {q(key)} "
            f"ORDER BY {order}) AS __rn FROM {src}) WHERE __rn = 1")


def listing_cleaned_cte() -> str:
    cols = ", ".join(q(c) if c in ("VIN", "page", "idx") else f"{null_if_in(q(c), ETL_NULL_SENTINELS)} AS {q(c)}"
                     for c in RAW_COLUMNS)
    return f"SELECT {cols} FROM raw_listing"


def listing_dedup_cte() -> str:
    return dedup_sql("listing_cleaned", "VIN", RAW_COLUMNS)


def listing_cte() -> str:
    fd = q("Finance Details")
    exprs = {
        "Year of Manufacture": year_of_title(q("Title")),
        "Car Make": make_of_title(q("Title")),
        "Car Full Title": q("Title"),
        "Cash Price (USD)": strip_dollar(q("Cash Price")),
        "Down Payment": down_payment(chunk(fd, 0)),
        "Installment Per Month": first_integer(q("Finance Price")),
        "Loan Term (Months)": first_integer(chunk(fd, 1)),
        "Interest Rate (APR)": apr(chunk(fd, 2)),
        "Mileage": mileage_digits(q("Mileage")),
    }
    cols = [f"{exprs.get(c, q(c))} AS {q(c)}" for c in TRANSFORMED_COLUMNS + ["Drivetrain"]]
    return "SELECT " + ", ".join(cols) + " FROM listing_dedup"


TABLE_SQL = {
    "car_info": 'SELECT "VIN", TRY_CAST("Year of Manufacture" AS INTEGER) AS "Year_Of_Manufacture", '
                '"Car Make" AS "Car_Make", "Car Full Title" AS "Car_Full_Title", '
                '"Cash Price (USD)" AS "Car_Price_USD", "Down Payment" IS NOT NULL AS "Installment_Support" '
                'FROM listing WHERE "VIN" IS NOT NULL',
    "installment_info": 'SELECT "VIN", "Down Payment" AS "Down_Payment", '
                        '"Installment Per Month" AS "Installment_Per_Month", '
                        'TRY_CAST("Loan Term (Months)" AS INTEGER) AS "Loan_Term", '
                        '"Interest Rate (APR)" AS "Interest_Rate" FROM listing WHERE "VIN" IS NOT NULL',
    "in_exterior": 'SELECT "VIN", "Exterior", "Interior" FROM listing WHERE "VIN" IS NOT NULL',
    "evaluate": 'SELECT "VIN", "Mileage", "Fuel Type" AS "Fuel_Type", "MPG" FROM listing WHERE "VIN" IS NOT NULL',
    "engine_info": 'SELECT "VIN", "Transmission", "Engine" FROM listing WHERE "VIN" IS NOT NULL',
    "other_detail": 'SELECT "VIN", "Location", "Listed Since" AS "Listed_Since", '
                    '"Stock Number" AS "Stock_Number", "Features" FROM listing WHERE "VIN" IS NOT NULL',
}


def wide_cte() -> str:
    return """SELECT ci."VIN", ci."Year_Of_Manufacture", ci."Car_Make", ci."Car_Full_Title", ci."Car_Price_USD",
  ci."Installment_Support", ie."Exterior", ie."Interior", ev."Mileage", ev."Fuel_Type", ev."MPG",
  ei."Transmission", ei."Engine", od."Location", od."Listed_Since", od."Stock_Number", od."Features",
  ii."Down_Payment", ii."Installment_Per_Month", ii."Loan_Term", ii."Interest_Rate"
FROM car_info ci
LEFT JOIN in_exterior ie ON ci."VIN" = ie."VIN"
LEFT JOIN evaluate ev ON ci."VIN" = ev."VIN"
LEFT JOIN engine_info ei ON ci."VIN" = ei."VIN"
LEFT JOIN other_detail od ON ci."VIN" = od."VIN"
LEFT JOIN installment_info ii ON ci."VIN" = ii."VIN\""""


CURRENT_YEAR = 2026  # parameter of the analysis range check, fixed for reproducible runs


def clean_tokens_cte() -> str:
    cols = ", ".join(f"{null_if_in(q(c), ANALYSIS_NULL_TOKENS)} AS {q(c)}" for c in TRANSFORMED_COLUMNS + ["Drivetrain"])
    return f"SELECT {cols} FROM listing"


def clean_listing_cte(current_year: int = CURRENT_YEAR) -> str:
    loans = ", ".join(f"nullif({q(c)}, '')" for c in
                      ["Down Payment", "Installment Per Month", "Loan Term (Months)", "Interest Rate (APR)"])
    price = numeric_coerce(q("Cash Price (USD)"))
    miles = numeric_coerce(q("Mileage"))
    keep = ["Year of Manufacture", "Car Make", "Car Full Title", "Cash Price (USD)", "VIN", "Mileage", "Fuel Type",
            "MPG", "Exterior", "Interior", "Transmission", "Engine", "Location", "Listed Since", "Stock Number",
            "Features", "Drivetrain"]
    titled = {"Car Make", "Car Full Title", "Exterior", "Interior", "Fuel Type", "Transmission", "Drivetrain",
              "Engine", "Location"}
    sel = []
    for c in keep:
        if c == "Cash Price (USD)":
            sel.append(f"{price} AS {q(c)}")
        elif c == "Mileage":
            sel.append(f"{miles} AS {q(c)}")
        elif c == "Year of Manufacture":
            sel.append(f"TRY_CAST({q(c)} AS DOUBLE) AS {q(c)}")
        elif c in titled:
            sel.append(f"{title_case(q(c))} AS {q(c)}")
        else:
            sel.append(q(c))
    sel.append(f"CASE WHEN coalesce({loans}) IS NOT NULL THEN 'Yes' ELSE 'No' END AS \"Financing Support\"")
    sel.append(f"{price_category(price)} AS \"Price Category\"")
    sel.append(f"{mpg(q('MPG'), 1)} AS \"City MPG\"")
    sel.append(f"{mpg(q('MPG'), 2)} AS \"Highway MPG\"")
    where = (f"{price} > 0 AND {miles} >= 0 AND {mpg(q('MPG'), 1)} BETWEEN 0 AND 100 "
             f"AND {mpg(q('MPG'), 2)} BETWEEN 0 AND 100 "
             f"AND TRY_CAST({q('Year of Manufacture')} AS DOUBLE) >= 1900 "
             f"AND TRY_CAST({q('Year of Manufacture')} AS DOUBLE) <= {current_year + 1}")
    return f"SELECT {', '.join(sel)} FROM clean_tokens WHERE {where}"


def analysis_cte() -> str:
    """clean_listing + Price Segment, State, Listed Days (the analysis frame)."""
    return (f"SELECT *, {price_segment(q('Cash Price (USD)'))} AS \"Price Segment\", "
            f"{extract_state(q('Location'))} AS \"State\", {listed_days(q('Listed Since'))} AS \"Listed Days\" "
            f"FROM clean_listing")


CTES = {
    "raw_listing": raw_listing_cte,
    "listing_cleaned": listing_cleaned_cte,
    "listing_dedup": listing_dedup_cte,
    "listing": listing_cte,
    **{k: (lambda k=k: TABLE_SQL[k]) for k in TABLE_SQL},
    "wide": wide_cte,
    "clean_tokens": clean_tokens_cte,
    "clean_listing": clean_listing_cte,
    "analysis": analysis_cte,
}
ORDER = list(CTES)
DEPS = {
    "listing_cleaned": ["raw_listing"], "listing_dedup": ["listing_cleaned"], "listing": ["listing_dedup"],
    **{k: ["listing"] for k in TABLE_SQL},
    "wide": list(TABLE_SQL), "clean_tokens": ["listing"], "clean_listing": ["clean_tokens"],
    "analysis": ["clean_listing"],
}


def with_ctes(needs: list[str], select: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` the needed CTEs (and their dependencies) then ``select``."""
    seen: set[str] = set()

    def visit(n):
        if n in seen:
            return
        for d in DEPS.get(n, []):
            visit(d)
        seen.add(n)
    for n in needs:
        visit(n)
    # frames that a query reads more than once are computed once
    shared = {"listing", "analysis", "src", "topped", "filled", "features", "nearest", "sample"}
    parts = [(n, CTES[n]()) for n in ORDER if n in seen] + list(extra or [])
    parts = [f"{n} AS {'MATERIALIZED ' if n in shared else ''}({body})" for n, body in parts]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select
