"""Normalised warehouse: vertical split, wide join, incremental load."""
from __future__ import annotations

import getpass
import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import CHILD_TABLES, WAREHOUSE_TABLES, ddl
from ..session import release, stage
from .cleaning import installment_flag, not_null_key, typed_cast
from .dedup import dedup_by_key
from .snapshots import CODEC, Folders, latest, update

# Column order returned by the search join (parent first, then the children).
WIDE_COLUMNS = [
    "VIN", "Year_Of_Manufacture", "Car_Make", "Car_Full_Title", "Car_Price_USD", "Installment_Support",
    "Exterior", "Interior", "Mileage", "Fuel_Type", "MPG", "Transmission", "Engine",
    "Location", "Listed_Since", "Stock_Number", "Features",
    "Down_Payment", "Installment_Per_Month", "Loan_Term", "Interest_Rate",
]


def _c(n: str):
    return F.col(f"`{n}`")


def vertical_split(listing: DataFrame, fixed: bool = False) -> dict[str, DataFrame]:
    """One transformed frame -> six tables keyed by VIN (NULL keys dropped).
    Callers that write all six should persist or stage ``listing`` first."""
    base = not_null_key(listing, "VIN")
    return {
        "car_info": base.select(
            _c("VIN"), typed_cast("Year of Manufacture", "int").alias("Year_Of_Manufacture"),
            _c("Car Make").alias("Car_Make"), _c("Car Full Title").alias("Car_Full_Title"),
            _c("Cash Price (USD)").alias("Car_Price_USD"),
            installment_flag("Down Payment", fixed).alias("Installment_Support")),
        "installment_info": base.select(
            _c("VIN"), _c("Down Payment").alias("Down_Payment"),
            _c("Installment Per Month").alias("Installment_Per_Month"),
            typed_cast("Loan Term (Months)", "int").alias("Loan_Term"),
            _c("Interest Rate (APR)").alias("Interest_Rate")),
        "in_exterior": base.select(_c("VIN"), _c("Exterior"), _c("Interior")),
        "evaluate": base.select(_c("VIN"), _c("Mileage"), _c("Fuel Type").alias("Fuel_Type"), _c("MPG")),
        "engine_info": base.select(_c("VIN"), _c("Transmission"), _c("Engine")),
        "other_detail": base.select(
            _c("VIN"), _c("Location"), _c("Listed Since").alias("Listed_Since"),
            _c("Stock Number").alias("Stock_Number"), _c("Features")),
    }


def listing_wide(tables: dict[str, DataFrame], extra: list[str] | None = None) -> DataFrame:
    """Car_Info LEFT JOIN the five children on VIN. Children are not unique,
    so a child with two rows fans the parent out; a parent without a child
    keeps NULLs. All joins share one key: over the bucketed serving copy
    (``storage``) none of them shuffles. ``extra`` names further columns to keep."""
    out = tables["car_info"]
    for name in ("in_exterior", "evaluate", "engine_info", "other_detail", "installment_info"):
        out = out.join(tables[name], on="VIN", how="left")
    return out.select(*[_c(c) for c in [*WIDE_COLUMNS, *(extra or [])]])


def anti_join_existing(new: DataFrame, existing: DataFrame, key: str = "VIN") -> DataFrame:
    """Rows of ``new`` whose key is not loaded yet; NULL keys never load.
    A distributed left-anti join instead of collecting the keys to the driver."""
    return not_null_key(new, key).join(existing.select(key), on=key, how="left_anti")


# ---------------------------------------------------------------------------
# Physical warehouse on Parquet: folders of loads under ``root``, listed by snapshots
# ---------------------------------------------------------------------------
def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], ddl(name))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hp)


def _read(spark: SparkSession, root: str, name: str, folders: Folders) -> DataFrame:
    paths = [os.path.join(root, p) for p in folders.get(name, [])]
    return spark.read.schema(ddl(name)).parquet(*paths) if paths else empty_table(spark, name)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A warehouse table as of the last snapshot; a table that holds nothing yet is an empty
    frame (and only that case: a corrupt table raises). The run log is a plain folder."""
    if name == "etl_log":
        path = os.path.join(root, name)
        return spark.read.schema(ddl(name)).parquet(path) if _exists(spark, path) else empty_table(spark, name)
    return _read(spark, root, name, latest(spark, root)[1])


def read_warehouse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The six tables, all of the same snapshot."""
    folders = latest(spark, root)[1]
    return {n: _read(spark, root, n, folders) for n in ["car_info"] + CHILD_TABLES}


LOAD_TABLES = CHILD_TABLES + ["transformed_cars", "car_info"]


def _write_part(rows: DataFrame, path: str) -> int:
    """Write a folder that no snapshot lists yet; returns its number of rows, counted while they are written."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", CODEC).parquet(path)
    return int(seen.get["n"])


def append_audit(spark: SparkSession, root: str, audit: DataFrame) -> None:
    """Append audit rows whose (id, kind) is not logged yet, so a replayed run logs once."""
    log = read_table(spark, root, "etl_log").select("id", "kind")
    audit.join(log, ["id", "kind"], "left_anti").select(audit.columns).write.mode("append").parquet(os.path.join(root, "etl_log"))


def incremental_load(spark: SparkSession, listing: DataFrame, root: str, run_id: int | None = None,
                     user: str | None = None, fixed: bool = False) -> DataFrame:
    """transform output -> new keys only -> six tables + wide table + audit row.

    * The rows are staged once (a Parquet copy in the shared folder, deleted at the end). Their keys alone
      meet those of ``car_info``; a first load takes all rows, a load that adds nothing moves none.
      The new rows are written to new folders, one a table. One snapshot then shows all seven
      tables' new rows at once; a reader during the load, or after a run that stopped
      anywhere, sees the old warehouse. Loading the same input twice adds 0.
    * If another load commits first, the missing keys are taken again from its result, so two
      loads at once add no key twice.
    * A failure is logged as a FAILED audit row and raised again; a run id is
      logged once for each outcome.
    Returns (table, rows_added).
    """
    user = user or getpass.getuser()
    run_id = run_id if run_id is not None else int(uuid.uuid4().int % (1 << 62))
    added: dict[str, int] = {}
    copies: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        df, path = stage(df)
        copies.append(path)
        return df

    def load(folders: Folders) -> Folders:
        fresh = staged
        if folders.get("car_info"):
            missing = keep(anti_join_existing(staged.select("VIN"), _read(spark, root, "car_info", folders)).distinct())
            fresh = keep(staged.join(missing, "VIN", "left_semi"))
        parts = vertical_split(fresh, fixed)
        parts["transformed_cars"] = fresh.withColumn("load_date", F.current_timestamp()) \
            .select(*[F.col(f"`{c}`") for c, _ in WAREHOUSE_TABLES["transformed_cars"]])
        load_id = uuid.uuid4().hex
        added.clear()
        for name in LOAD_TABLES:
            added[name] = 0 if added and not next(iter(added.values())) else _write_part(parts[name], os.path.join(root, name, load_id))
            if added[name]:
                folders.setdefault(name, []).append(f"{name}/{load_id}")
        return folders

    try:
        staged = keep(not_null_key(listing, "VIN"))
        update(spark, root, load)
    except Exception:
        append_audit(spark, root, run_audit_row(spark, run_id, 0, "FAILED", user, kind="load-failed"))
        raise
    finally:
        for path in copies:
            release(spark, path)
    append_audit(spark, root, run_audit_row(spark, run_id, added["car_info"], "SUCCESS", user, kind="load"))
    return spark.createDataFrame(sorted(added.items()), "table string, rows_added long")


# ---------------------------------------------------------------------------
# Survivors of a stream: runs that are merged in tiers
# ---------------------------------------------------------------------------
#: Runs of one tier that are merged into one run of the next.
FANOUT = 4


def merge_survivors(spark: SparkSession, batch: DataFrame, state: str, key: str = "VIN", fanout: int = FANOUT) -> int:
    """Add raw rows to the survivor state: one row per key, chosen by the same order as
    ``dedup_by_key``, whatever micro-batch a copy came in.

    A batch writes only its own survivors, as a new run of tier 0 (as many rows as it has keys); nothing
    that earlier batches wrote is read. ``fanout`` runs of a tier are merged into one of
    the next, so a row is rewritten a logarithmic number of times over all batches. The order's minimum is
    associative and a replayed batch changes nothing, so stream and batch agree. Returns the
    number of rows written, merges included.
    """
    run = f"runs/{uuid.uuid4().hex}"
    written = _write_part(dedup_by_key(batch, key), os.path.join(state, run))
    if written:
        update(spark, state, lambda tiers: {**tiers, "0": [*tiers.get("0", []), run]})
    return written + compact_survivors(spark, state, key, fanout)


def compact_survivors(spark: SparkSession, state: str, key: str = "VIN", fanout: int = FANOUT) -> int:
    """Merge every tier that holds ``fanout`` runs; returns the number of rows written."""
    written, tier = 0, 0
    while True:
        tiers = latest(spark, state)[1]
        if tier > max(map(int, tiers), default=-1):
            return written
        old = tiers.get(str(tier), [])[:fanout]
        if len(old) < fanout:
            tier += 1
            continue
        merged = f"runs/{uuid.uuid4().hex}"
        written += _write_part(dedup_by_key(spark.read.parquet(*[os.path.join(state, p) for p in old]), key), os.path.join(state, merged))

        def swap(now: Folders, old=old, merged=merged, tier=tier) -> Folders:
            if not set(old) <= set(now.get(str(tier), [])):  # another writer merged them
                return now
            up = str(tier + 1)
            return {**now, str(tier): [p for p in now[str(tier)] if p not in old], up: [*now.get(up, []), merged]}
        update(spark, state, swap)


def read_survivors(spark: SparkSession, state: str, key: str = "VIN") -> DataFrame | None:
    """The survivors over all runs of the last snapshot; None before the first batch."""
    paths = [os.path.join(state, p) for tier in latest(spark, state)[1].values() for p in tier]
    return dedup_by_key(spark.read.parquet(*paths), key) if paths else None


def run_audit_row(spark: SparkSession, run_id: int, n: int, status: str, user: str,
                  kind: str = "load") -> DataFrame:
    """One audit row (execution time, records processed, status, user)."""
    return spark.range(1).select(
        F.lit(run_id).cast("bigint").alias("id"), F.current_timestamp().alias("execution_date"),
        F.lit(n).cast("int").alias("num_records_processed"), F.lit(status).alias("status"),
        F.lit(user).alias("executed_by"), F.lit(kind).alias("kind"))
