"""Canonical schemas and fixed values.

Values under "FIXED VALUES" must equal the behaviour the library reproduces
(field names, sentinel tokens, bins, labels, the state dictionary). They are
stated plainly, in their natural order.
"""
from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: listing record layout
# ---------------------------------------------------------------------------
# The 17 keys of one crawled listing record, in file order.
LISTING_FIELDS = [
    "Title", "Cash Price", "Finance Price", "Finance Details", "Exterior",
    "Interior", "Mileage", "Fuel Type", "MPG", "Transmission", "Drivetrain",
    "Engine", "Location", "Listed Since", "VIN", "Stock Number", "Features",
]

# Keys moved into the nested ``overview`` struct of the nested JSON form.
OVERVIEW_FIELDS = [
    "Exterior", "Interior", "Mileage", "Fuel Type", "MPG", "Transmission",
    "Drivetrain", "Engine", "Location", "Listed Since", "VIN", "Stock Number",
]

# Column order of a transformed listing (20 columns); Drivetrain is kept as an
# optional 21st column because the analysis needs it.
TRANSFORMED_COLUMNS = [
    "Year of Manufacture", "Car Make", "Car Full Title", "Cash Price (USD)",
    "Down Payment", "Installment Per Month", "Loan Term (Months)",
    "Interest Rate (APR)", "VIN", "Mileage", "Fuel Type", "MPG", "Exterior",
    "Interior", "Transmission", "Engine", "Location", "Listed Since",
    "Stock Number", "Features",
]
OPTIONAL_COLUMNS = ["Drivetrain"]

# Sentinels nulled by the ETL transform (every column except VIN).
ETL_NULL_SENTINELS = ["N/A", "Not Available"]
# Tokens nulled by the analysis cleaning step (every column, exact match).
ANALYSIS_NULL_TOKENS = ["NULL", "null", "Null", "NA", "na", "N/A", "n/a"]
# Loan columns folded into "Financing Support" and then dropped.
LOAN_COLUMNS = ["Down Payment", "Installment Per Month", "Loan Term (Months)", "Interest Rate (APR)"]
# Text columns standardised with title case.
TITLE_CASE_COLUMNS = ["Car Make", "Car Full Title", "Exterior", "Interior", "Fuel Type",
                      "Transmission", "Drivetrain", "Engine", "Location"]

# Price bins: edges 0, 5000, 15000, 30000, 60000, infinity.
PRICE_EDGES = [0.0, 5000.0, 15000.0, 30000.0, 60000.0]
# Left-closed bins [a, b) -> "Price Category".
PRICE_CATEGORY_LABELS = ["Budget (<5K)", "Affordable (5K-15K)", "Mid-range (15K-30K)",
                         "Premium (30K-60K)", "Luxury (>60K)"]
# Right-closed bins (a, b] -> "Price Segment".
PRICE_SEGMENT_LABELS = ["Budget / Used", "Affordable", "Mid-range", "Premium", "Luxury / Supercar"]

# Drivetrain values recognised by the overview classifier.
DRIVETRAIN_VALUES = ["AWD", "4WD", "FWD", "RWD"]

# Event statuses understood by the listeners.
EVENT_STATUSES = ["new_data_available", "warehouse_updated"]

# Full state names and their postal codes, in dictionary order.
STATE_CODES = [
    ("alabama", "AL"), ("alaska", "AK"), ("arizona", "AZ"), ("arkansas", "AR"), ("california", "CA"),
    ("colorado", "CO"), ("connecticut", "CT"), ("delaware", "DE"), ("florida", "FL"), ("georgia", "GA"),
    ("hawaii", "HI"), ("idaho", "ID"), ("illinois", "IL"), ("indiana", "IN"), ("iowa", "IA"),
    ("kansas", "KS"), ("kentucky", "KY"), ("louisiana", "LA"), ("maine", "ME"), ("maryland", "MD"),
    ("massachusetts", "MA"), ("michigan", "MI"), ("minnesota", "MN"), ("mississippi", "MS"),
    ("missouri", "MO"), ("montana", "MT"), ("nebraska", "NE"), ("nevada", "NV"), ("new hampshire", "NH"),
    ("new jersey", "NJ"), ("new mexico", "NM"), ("new york", "NY"), ("north carolina", "NC"),
    ("north dakota", "ND"), ("ohio", "OH"), ("oklahoma", "OK"), ("oregon", "OR"), ("pennsylvania", "PA"),
    ("rhode island", "RI"), ("south carolina", "SC"), ("south dakota", "SD"), ("tennessee", "TN"),
    ("texas", "TX"), ("utah", "UT"), ("vermont", "VT"), ("virginia", "VA"), ("washington", "WA"),
    ("west virginia", "WV"), ("wisconsin", "WI"), ("wyoming", "WY"),
]

# Lake metadata stamped on each loaded document.
LAKE_METADATA_FIELDS = ["load_timestamp", "data_source", "data_version", "processing_pipeline",
                        "storage_system", "loader_user"]

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------
RAW_LISTING_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in LISTING_FIELDS]
)

# Flat JSON as read by the ETL: the 17 strings plus the lake metadata as text.
LISTING_JSON_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in LISTING_FIELDS]
    + [T.StructField("datalake_metadata", T.StringType(), True)]
)

META_SIDECAR_SCHEMA = T.StructType([
    T.StructField("crawl_time", T.StringType(), True),
    T.StructField("page", T.IntegerType(), True),
    T.StructField("index", T.IntegerType(), True),
])

EVENT_VALUE_SCHEMA = T.StructType([
    T.StructField("status", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("data_info", T.MapType(T.StringType(), T.StringType()), True),
])

# Warehouse tables (name -> list of (column, type)).
WAREHOUSE_TABLES = {
    "car_info": [("VIN", "string"), ("Year_Of_Manufacture", "int"), ("Car_Make", "string"),
                 ("Car_Full_Title", "string"), ("Car_Price_USD", "string"), ("Installment_Support", "boolean")],
    "installment_info": [("VIN", "string"), ("Down_Payment", "string"), ("Installment_Per_Month", "string"),
                         ("Loan_Term", "int"), ("Interest_Rate", "string")],
    "in_exterior": [("VIN", "string"), ("Exterior", "string"), ("Interior", "string")],
    "evaluate": [("VIN", "string"), ("Mileage", "string"), ("Fuel_Type", "string"), ("MPG", "string")],
    "engine_info": [("VIN", "string"), ("Transmission", "string"), ("Engine", "string")],
    "other_detail": [("VIN", "string"), ("Location", "string"), ("Listed_Since", "string"),
                     ("Stock_Number", "string"), ("Features", "string")],
    "etl_log": [("id", "bigint"), ("execution_date", "timestamp"), ("num_records_processed", "int"),
                ("status", "string"), ("executed_by", "string"), ("kind", "string")],
    "transformed_cars": [(c, "string") for c in TRANSFORMED_COLUMNS] + [("Drivetrain", "string"),
                                                                        ("load_date", "timestamp")],
}
CHILD_TABLES = ["installment_info", "in_exterior", "evaluate", "engine_info", "other_detail"]


def ddl(table: str) -> str:
    """Spark DDL string for a warehouse table."""
    return ", ".join(f"`{c}` {t}" for c, t in WAREHOUSE_TABLES[table])
