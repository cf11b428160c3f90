"""Derived views that bridge the driver's star-schema tables to listings.

The driver's tables hold no vehicle listings, so ``raw_listing`` derives one
listing record (the 17 crawled string fields, plus ``page`` and ``idx``)
per ``lineitem`` row from ``lineitem ⋈ orders ⋈ part ⋈ supplier``. The
derivation plants the dirt the listing operators must handle: sentinels,
thousands separators, empty strings, repeated and missing VINs, titles with
no leading year, unknown state codes and two-word makes. Work grows with
``lineitem``; no row is filtered out.

``raw_listing_sql`` is the same derivation for DuckDB (the oracle). Keep the
two in step.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES of the bridge (invented for this view, not crawled data)
# ---------------------------------------------------------------------------
# Brand#n -> make n (1-based).
VIEW_MAKES = [
    "Toyota", "Ford", "Honda", "Chevrolet", "Nissan", "Land Rover", "Mercedes-Benz", "BMW",
    "Hyundai", "Kia", "Subaru", "Mazda", "Volkswagen", "Audi", "Lexus", "Jeep", "Tesla",
    "Aston Martin", "Dodge", "Ram", "GMC", "Volvo", "Porsche", "Alfa Romeo", "Cadillac",
]
# partkey % 8 -> exterior colour.
VIEW_EXTERIORS = ["Harbor Mist", "Coal Dust", "Lake Gray", "Brick Red", "blue-gray",
                  "O'dell Blue", "Unknown", "Moon Silver"]
# suppkey % 4 -> interior colour.
VIEW_INTERIORS = ["Black", "Gray", "Beige", "Unknown"]
# supplier nation key -> dealer location (None = no location).
VIEW_LOCATIONS = [
    "Elmstead, FL", "Las Vegas, NV", "Austin, TX", "Portland, Oregon", "Washington, DC",
    "Denver, CO", "Miami, FL", "New York, NY", "Los Angeles, California", "Phoenix, AZ",
    "Seattle, WA", "Chicago, IL", "Boston, MA", "Atlanta, GA", "Dallas, TX", "Houston, TX",
    "San Diego, CA", "Orlando, FL", "Columbus, OH", "Detroit, MI", "Nashville, Tennessee",
    "Tampa,FL", "Reno, nv ", "Toronto, ON", None,
]
# p_type -> fuel type.
VIEW_FUEL_BY_TYPE = [("ECONOMY", "Gas"), ("MEDIUM", "Gas"), ("STANDARD", "Hybrid"),
                     ("LARGE", "Diesel"), ("PROMO", "Electric"), ("SMALL", "Plug-In Hybrid")]
# o_orderpriority -> drivetrain (4-NOT SPECIFIED -> none).
VIEW_DRIVETRAIN = [("1-URGENT", "FWD"), ("2-HIGH", "AWD"), ("3-MEDIUM", "RWD"), ("5-LOW", "4WD")]
# Feature flags: (label, column, modulus) -> present when column % modulus == 0.
VIEW_FEATURES = [("Backup Camera", "l_partkey", 2), ("Bluetooth", "l_partkey", 3),
                 ("Heated Seats", "l_suppkey", 2), ("Navigation System", "l_orderkey", 5)]
VIEW_REFERENCE_DATE = "2002-01-01"
#: Rows that a task of a large input derives, and suppliers (two numbers each) up to which they are broadcast.
TASK_ROWS, BROADCAST_SUPPLIERS = 250_000, 1_000_000
VIEW_YEAR_SHIFT = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list, idx: Column) -> Column:
    """1-based pick from a literal list (bounded, fixed-size lookup)."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), idx)


def _case(col: Column, pairs: list[tuple[str, str]]) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(col == k, v) if out is None else out.when(col == k, v)
    return out


def _thousands(c: Column) -> Column:
    return F.format_number(c.cast("bigint"), 0)


#: Finance forms that a discount gives.
FINANCED, PLAIN, NO_FINANCE = 2, 1, 0


def _priced(price: Column, discount: Column) -> list[Column]:
    """What the listing shows of a price and a discount, as whole numbers: rows are shuffled twice, and these
    take fewer bytes there than the numbers they come from."""
    form = F.when(discount >= 0.05, FINANCED).when(discount < 0.005, PLAIN).otherwise(NO_FINANCE)
    return [F.floor(price).alias("cash"), F.when(form == FINANCED, F.floor(price / 60)).alias("monthly"), form.cast("tinyint").alias("finance_form")]


def raw_listing(spark: SparkSession, sf_dir: str, by_page: bool = False) -> DataFrame:
    """17 string fields of a crawled listing + ``page`` + ``idx``; ``by_page``: the rows of a page come in one
    partition, dealt before they grow several times as wide."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("shipped"),
        *_priced(F.col("l_extendedprice"), F.col("l_discount")))
    # A small input of one or two Parquet row groups would leave the derivation, which is the
    # work, to as many tasks; its narrow rows are dealt over all cores first. A large input has splits enough.
    cores = spark.sparkContext.defaultParallelism
    if li.rdd.getNumPartitions() < cores:
        li = li.repartition(cores)
    tasks = -(-table(spark, sf_dir, "lineitem").count() // TASK_ROWS)  # from the Parquet footers
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.floor(F.col("o_totalprice") / 20).alias("due"), F.year("o_orderdate").alias("o_year"),
        _case(F.col("o_orderpriority"), VIEW_DRIVETRAIN).alias("drivetrain"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Suppliers come first, to the narrowest rows, and without a shuffle of these while they are few.
    if s.count() <= BROADCAST_SUPPLIERS:
        s = F.broadcast(s)
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(o, li.l_orderkey == o.o_orderkey)
    # Rows grow several times as wide after the last join and are sorted there. Adaptive execution joins
    # partitions by the bytes of the narrow rows, so a large input's partitions are counted in rows instead.
    if tasks > cores:
        j, p = j.repartition(tasks, "l_partkey"), p.repartition(tasks, "p_partkey")
    j = j.join(p, F.col("l_partkey") == F.col("p_partkey"))
    page = (F.col("l_orderkey") / 100).cast("int")
    if by_page:
        j = j.withColumn("__page", page).hint("rebalance", "__page")

    ln, rf = F.col("l_linenumber"), F.col("l_returnflag")
    size = F.col("p_size")
    brand_no = F.expr("try_cast(substring_index(p_brand, '#', -1) as int)")
    make = _pick(VIEW_MAKES, ((brand_no - 1) % len(VIEW_MAKES)) + 1)
    year = (F.col("o_year") + VIEW_YEAR_SHIFT).cast("string")
    title = (F.when(size % 17 == 0, F.concat_ws(" ", make, F.col("p_name"), year))
             .otherwise(F.concat(year, F.lit(" "), make, F.lit(" "), F.col("p_name"))))
    cash = F.col("cash")
    cash_price = (F.when(ln == 7, "N/A").when(size == 1, "No Cash Price")
                  .when(ln == 6, F.concat(F.lit("$"), cash.cast("string")))
                  .otherwise(F.concat(F.lit("$"), _thousands(cash))))
    form = F.col("finance_form")
    fin_price = (F.when(form == FINANCED, F.concat(F.lit("$"), _thousands(F.col("monthly")), F.lit("/moEstimate")))
                 .when(form == PLAIN, "").otherwise("Not Available"))
    apr = F.concat(F.round(F.col("l_tax") * 100).cast("int").cast("string"), F.lit("."), ln.cast("string"), F.lit("9% APR"))
    fin_details = (F.when(form == FINANCED, F.concat(
                        F.lit("$"), _thousands(F.col("due")), F.lit(" due at signing · "),
                        (36 + 12 * (ln % 4)).cast("string"), F.lit(" mo · "), apr))
                   .when(form == PLAIN, "60 months at 3.9% APR").otherwise("Not Available"))
    miles = (F.col("l_quantity") * 2000).cast("bigint") + F.col("l_partkey")
    mileage = (F.when((ln == 5) & (rf == "N"), "N/A")
               .when(ln == 4, F.concat(miles.cast("string"), F.lit(" miles")))
               .otherwise(F.concat(_thousands(miles), F.lit(" miles"))))
    fuel = (F.when(size == 49, F.lit(None).cast("string")).when(size == 48, "Hydrogen")
            .otherwise(_case(F.col("p_type"), VIEW_FUEL_BY_TYPE)))
    mpg = (F.when((fuel == "Electric") | ((ln == 3) & (rf == "R")), "N/A")
           .otherwise(F.concat((10 + size % 25).cast("string"), F.lit(" city / "),
                               (18 + size % 30).cast("string"), F.lit(" highway"))))
    transmission = (F.when(rf == "N", "Manual Transmission")
                    .when((rf == "R") & (ln == 1), F.lit(None).cast("string"))
                    .otherwise("Automatic Transmission"))
    disp = F.concat((1 + size % 4).cast("string"), F.lit("."), (size % 10).cast("string"))
    engine = (F.when(fuel == "Electric", "N/A")
              .when(fuel == "Diesel", F.concat(disp, F.lit("L V6 Diesel")))
              .otherwise(F.concat(disp, F.lit("L Inline-4 Gas"))))
    days = F.datediff(F.lit(VIEW_REFERENCE_DATE).cast("date"), F.col("shipped"))
    listed = (F.when(size == 2, "Listed recently")
              .when((ln == 3) & (rf == "A"), F.concat((days % 8 + 1).cast("string"), F.lit(" weeks ago")))
              .otherwise(F.concat((days % 200 + 1).cast("string"), F.lit(" days ago"))))
    vin = (F.when((ln == 2) & (F.col("l_linestatus") == "F") & (rf == "N"), F.lit(None).cast("string"))
           .when((size == 3) & (ln == 1), "N/A")
           .otherwise(F.concat(F.lit("1LW"), F.lpad(F.col("l_partkey").cast("string"), 8, "0"),
                               F.lpad(F.col("l_suppkey").cast("string"), 6, "0"))))
    stock = (F.when((ln == 6) & (rf == "A"), "null")
             .otherwise(F.concat(F.lit("S"), F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string"))))
    feats = [F.when(F.col(c) % m == 0, F.lit(label)) for label, c, m in VIEW_FEATURES]
    feats.append(F.when(ln == 1, F.lit("Sunroof/Moonroof")))
    features = F.concat_ws("; ", *feats)
    return j.select(
        title.alias("Title"), cash_price.alias("Cash Price"), fin_price.alias("Finance Price"),
        fin_details.alias("Finance Details"),
        _pick(VIEW_EXTERIORS, (F.col("l_partkey") % 8 + 1).cast("int")).alias("Exterior"),
        _pick(VIEW_INTERIORS, (F.col("l_suppkey") % 4 + 1).cast("int")).alias("Interior"),
        mileage.alias("Mileage"), fuel.alias("Fuel Type"), mpg.alias("MPG"),
        transmission.alias("Transmission"), F.col("drivetrain").alias("Drivetrain"), engine.alias("Engine"),
        _pick(VIEW_LOCATIONS, (F.col("s_nationkey") % 25 + 1).cast("int")).alias("Location"),
        listed.alias("Listed Since"), vin.alias("VIN"), stock.alias("Stock Number"),
        features.alias("Features"),
        page.alias("page"), ln.alias("idx"),
    )


# ---------------------------------------------------------------------------
# DuckDB form of the same view (oracle side)
# ---------------------------------------------------------------------------
def _sql_list(values: list) -> str:
    def q(v):
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return "[" + ", ".join(q(v) for v in values) + "]::VARCHAR[]"


def _sql_case(col: str, pairs: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in pairs) + " END"


def raw_listing_sql() -> str:
    """DuckDB SELECT producing the same rows as :func:`raw_listing`."""
    thousands = "format('{{:,}}', CAST({} AS BIGINT))"
    make = (f"list_extract({_sql_list(VIEW_MAKES)}, "
            f"((TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) - 1) % {len(VIEW_MAKES)}) + 1)")
    year = f"CAST(year(o_orderdate) + {VIEW_YEAR_SHIFT} AS VARCHAR)"
    fuel = (f"CASE WHEN p_size = 49 THEN NULL WHEN p_size = 48 THEN 'Hydrogen' "
            f"ELSE {_sql_case('p_type', VIEW_FUEL_BY_TYPE)} END")
    disp = "CAST(1 + p_size % 4 AS VARCHAR) || '.' || CAST(p_size % 10 AS VARCHAR)"
    days = f"date_diff('day', CAST(l_shipdate AS DATE), DATE '{VIEW_REFERENCE_DATE}')"
    miles = "(CAST(l_quantity * 2000 AS BIGINT) + l_partkey)"
    feats = [f"CASE WHEN {c} % {m} = 0 THEN '{label}' END" for label, c, m in VIEW_FEATURES]
    feats.append("CASE WHEN l_linenumber = 1 THEN 'Sunroof/Moonroof' END")
    return f"""
SELECT
  CASE WHEN p_size % 17 = 0 THEN concat_ws(' ', {make}, p_name, {year})
       ELSE {year} || ' ' || {make} || ' ' || p_name END AS "Title",
  CASE WHEN l_linenumber = 7 THEN 'N/A' WHEN p_size = 1 THEN 'No Cash Price'
       WHEN l_linenumber = 6 THEN '$' || CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR)
       ELSE '$' || {thousands.format('floor(l_extendedprice)')} END AS "Cash Price",
  CASE WHEN l_discount >= 0.05 THEN '$' || {thousands.format('floor(l_extendedprice / 60)')} || '/moEstimate'
       WHEN l_discount < 0.005 THEN '' ELSE 'Not Available' END AS "Finance Price",
  CASE WHEN l_discount >= 0.05 THEN '$' || {thousands.format('floor(o_totalprice / 20)')} || ' due at signing · '
            || CAST(36 + 12 * (l_linenumber % 4) AS VARCHAR) || ' mo · '
            || CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) || '9% APR'
       WHEN l_discount < 0.005 THEN '60 months at 3.9% APR' ELSE 'Not Available' END AS "Finance Details",
  list_extract({_sql_list(VIEW_EXTERIORS)}, CAST(l_partkey % 8 + 1 AS INTEGER)) AS "Exterior",
  list_extract({_sql_list(VIEW_INTERIORS)}, CAST(l_suppkey % 4 + 1 AS INTEGER)) AS "Interior",
  CASE WHEN l_linenumber = 5 AND l_returnflag = 'N' THEN 'N/A'
       WHEN l_linenumber = 4 THEN CAST({miles} AS VARCHAR) || ' miles'
       ELSE {thousands.format(miles)} || ' miles' END AS "Mileage",
  {fuel} AS "Fuel Type",
  CASE WHEN ({fuel}) = 'Electric' OR (l_linenumber = 3 AND l_returnflag = 'R') THEN 'N/A'
       ELSE CAST(10 + p_size % 25 AS VARCHAR) || ' city / ' || CAST(18 + p_size % 30 AS VARCHAR) || ' highway'
  END AS "MPG",
  CASE WHEN l_returnflag = 'N' THEN 'Manual Transmission'
       WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL
       ELSE 'Automatic Transmission' END AS "Transmission",
  {_sql_case('o_orderpriority', VIEW_DRIVETRAIN)} AS "Drivetrain",
  CASE WHEN ({fuel}) = 'Electric' THEN 'N/A'
       WHEN ({fuel}) = 'Diesel' THEN {disp} || 'L V6 Diesel'
       ELSE {disp} || 'L Inline-4 Gas' END AS "Engine",
  list_extract({_sql_list(VIEW_LOCATIONS)}, CAST(s_nationkey % 25 + 1 AS INTEGER)) AS "Location",
  CASE WHEN p_size = 2 THEN 'Listed recently'
       WHEN l_linenumber = 3 AND l_returnflag = 'A' THEN CAST({days} % 8 + 1 AS VARCHAR) || ' weeks ago'
       ELSE CAST({days} % 200 + 1 AS VARCHAR) || ' days ago' END AS "Listed Since",
  CASE WHEN l_linenumber = 2 AND l_linestatus = 'F' AND l_returnflag = 'N' THEN NULL
       WHEN p_size = 3 AND l_linenumber = 1 THEN 'N/A'
       ELSE '1LW' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') || lpad(CAST(l_suppkey AS VARCHAR), 6, '0')
  END AS "VIN",
  CASE WHEN l_linenumber = 6 AND l_returnflag = 'A' THEN 'null'
       ELSE 'S' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS "Stock Number",
  concat_ws('; ', {', '.join(feats)}) AS "Features",
  CAST(l_orderkey // 100 AS INTEGER) AS page,
  l_linenumber AS idx
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
"""
