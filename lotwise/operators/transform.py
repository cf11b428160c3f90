"""The ETL transform: raw listing strings -> typed-as-text listing columns."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as L
from ..schemas import OPTIONAL_COLUMNS, TRANSFORMED_COLUMNS
from .cleaning import drop_if_present, null_sentinels, project_final
from .dedup import dedup_by_key


def transform_listings(raw: DataFrame, fixed: bool = False, keep_drivetrain: bool = True,
                       key: str = "VIN") -> DataFrame:
    """null sentinels -> dedup by VIN -> field extraction -> fixed projection.

    Schema tolerant: finance and mileage fields are derived only when present;
    absent target columns come out as NULL. ``fixed`` switches on the
    corrected forms (thousands in the monthly price, 'due at signing' check,
    sentinel VINs treated as missing).
    """
    df = drop_if_present(raw, "datalake_metadata")
    df = null_sentinels(df, exclude=() if fixed else (key,))
    df = dedup_by_key(df, key)
    cols = set(df.columns)
    c = lambda n: F.col(f"`{n}`")
    out = {
        "Year of Manufacture": L.year_of_title(c("Title")) if "Title" in cols else None,
        "Car Make": L.make_of_title(c("Title")) if "Title" in cols else None,
        "Car Full Title": c("Title") if "Title" in cols else None,
        "Cash Price (USD)": L.strip_dollar(c("Cash Price")) if "Cash Price" in cols else None,
        "Installment Per Month": L.first_integer(c("Finance Price"), fixed) if "Finance Price" in cols else None,
    }
    if "Finance Details" in cols:
        out["Down Payment"] = L.down_payment(L.finance_chunk(c("Finance Details"), 0), fixed)
        out["Loan Term (Months)"] = F.regexp_extract(L.finance_chunk(c("Finance Details"), 1), r"(\d+)", 1)
        out["Interest Rate (APR)"] = L.apr(L.finance_chunk(c("Finance Details"), 2))
    if "Mileage" in cols:
        out["Mileage"] = L.mileage_digits(c("Mileage"))
    for name in TRANSFORMED_COLUMNS + (OPTIONAL_COLUMNS if keep_drivetrain else []):
        if name not in out and name in cols:
            out[name] = c(name)
    present = {k: v.alias(k) for k, v in out.items() if v is not None}
    wanted = TRANSFORMED_COLUMNS + (OPTIONAL_COLUMNS if keep_drivetrain else [])
    return project_final(df.select(*present.values()), wanted)
