"""Keys for the streaming listeners, run over a message folder
(the Kafka contract without a broker) with ``trigger(availableNow=True)``."""
from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import null_sentinels
from ..operators.snapshots import CODEC
from ..operators.transform import transform_listings
from ..operators.warehouse import incremental_load, listing_wide, merge_survivors, read_survivors, read_warehouse, vertical_split
from ..schemas import LISTING_FIELDS
from ..session import scratch_path
from ..streaming import events as EV
from .catalog import listing, raw, register
from .oracle import with_ctes

# events.event_type -> message status ('error' events carry malformed JSON)
STATUS_SQL = ("CASE event_type WHEN 'purchase' THEN 'new_data_available' WHEN 'signup' THEN 'warehouse_updated' "
              "ELSE event_type END")

# The keys drain what is there and end; a listener in production keeps the default trigger.
DRAIN = {"availableNow": True}


def _scratch(spark: SparkSession, key: str) -> str:
    return scratch_path(spark, f"{key}-{uuid.uuid4().hex[:12]}")


def _messages(s: SparkSession, d: str):
    ev = s.read.parquet(f"{d}/events.parquet")
    ev = ev.withColumn("status", F.expr(STATUS_SQL)).withColumn("source", F.lit("events"))
    return EV.encode_events(ev, "event_id", "status", "ts", "source", ["user_id"])


def _publish(s: SparkSession, d: str, key: str) -> str:
    # error events are published as broken JSON (a truncated value)
    out = _scratch(s, key)
    EV.publish_event(_messages(s, d).withColumn("value", F.when(F.get_json_object("value", "$.status") == "error", '{"status": "new_data_avail')
                                                .otherwise(F.col("value"))), out)
    return out


@register("publish_event", "SELECT CASE WHEN event_type = 'error' THEN NULL ELSE " + STATUS_SQL + " END AS status, "
                           "count(*) AS n FROM events GROUP BY 1")
def _publish_event(s, d):
    out = _publish(s, d, "topic")
    back = EV.decode_events(s.read.schema(EV.MESSAGE_DDL).json(out))
    return back.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("event_stream", "SELECT CASE WHEN event_type = 'error' THEN NULL ELSE " + STATUS_SQL + " END AS status, "
                          "event_type IN ('purchase', 'signup') AS valid, count(*) AS n FROM events GROUP BY 1, 2")
def _event_stream(s, d):
    src = _publish(s, d, "topic_stream")
    sink, ck = _scratch(s, "stream_sink"), _scratch(s, "stream_ck")
    q = (EV.event_stream(s, src).writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return s.read.parquet(sink).groupBy("status", "valid").agg(F.count(F.lit(1)).alias("n"))


@register("etl_on_event", with_ctes(["wide"], "SELECT * FROM wide"))
def _etl_on_event(s, d):
    """Every new_data_available batch runs the idempotent load; the warehouse ends equal to
    one batch load, row by row, however many messages arrive."""
    src = _publish(s, d, "topic_etl")
    root, ck, quar = _scratch(s, "wh_stream"), _scratch(s, "etl_ck"), _scratch(s, "quarantine")
    lst = listing(s, d)
    q = EV.etl_on_event(EV.event_stream(s, src, max_files_per_trigger=2),
                        lambda bid: incremental_load(s, lst, root, run_id=bid), ck, quar, DRAIN)
    q.awaitTermination()
    return listing_wide(read_warehouse(s, root))


@register("refresh_on_event", with_ctes(["wide"], "SELECT * FROM wide"))
def _refresh_on_event(s, d):
    """The serving table after a warehouse_updated message, row by row."""
    src = _publish(s, d, "topic_refresh")
    root, ck, serving = _scratch(s, "wh_refresh"), _scratch(s, "refresh_ck"), _scratch(s, "serving")
    incremental_load(s, listing(s, d), root, run_id=1)

    def refresh(_bid):
        listing_wide(read_warehouse(s, root)).write.mode("overwrite").option("compression", CODEC).parquet(serving)
    EV.refresh_on_event(EV.event_stream(s, src), refresh, ck, trigger=DRAIN).awaitTermination()
    return s.read.parquet(serving)


@register("ingest_listings_stream", with_ctes(["car_info"], 'SELECT "VIN", "Car_Make", "Car_Price_USD" FROM car_info'))
def _ingest_listings_stream(s, d):
    """Lake files -> survivor table per micro-batch -> transform + split; equals
    the batch result although the copies of a VIN are dealt over all files."""
    lake, ck, state = _scratch(s, "lake_in"), _scratch(s, "ingest_ck"), _scratch(s, "survivors")
    raw(s, d).repartition(6, "idx", "page").write.option("compression", "gzip").json(lake)
    schema = ", ".join(f"`{c}` string" for c in LISTING_FIELDS) + ", page int, idx int"
    EV.ingest_listings_stream(s, lake, schema, lambda batch, _bid: merge_survivors(s, null_sentinels(batch, exclude=("VIN",)), state), ck,
                              max_files_per_trigger=2, trigger=DRAIN).awaitTermination()
    return vertical_split(transform_listings(read_survivors(s, state)))["car_info"].select("VIN", "Car_Make", "Car_Price_USD")


_FAILS = 3


@register("supervise_streams", f"""SELECT listener, event, CAST(attempt AS INTEGER) AS attempt, wait_seconds, (SELECT count(*) FROM events) AS handled FROM (
  SELECT 'etl_listener' AS listener, 'failed' AS event, unnest(range(1, {_FAILS + 1})) AS attempt, 0.05::DOUBLE * pow(2, unnest(range(0, {_FAILS}))) AS wait_seconds
  UNION ALL SELECT 'etl_listener', 'ended', {_FAILS + 1}, NULL UNION ALL SELECT 'refresh_listener', 'ended', 1, NULL)""")
def _supervise(s, d):
    """The supervisor's log of two listeners: one fails three times and is restarted from its
    checkpoint with growing waits, the other ends on its own; both handle every message once."""
    src, log = _publish(s, d, "topic_sup"), _scratch(s, "sup_log")
    folders = {n: (_scratch(s, n), _scratch(s, n + "_ck")) for n in ("etl_listener", "refresh_listener")}
    calls = []

    def start(name, fails):
        out, ck = folders[name]

        def handle(batch, batch_id):
            if name == "etl_listener":
                calls.append(1)
                if len(calls) <= fails:
                    raise RuntimeError("listener crashed")
            batch.select("key").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        return EV.event_stream(s, src).writeStream.option("checkpointLocation", ck).foreachBatch(handle).trigger(availableNow=True).start()

    EV.supervise_streams({"etl_listener": lambda: start("etl_listener", _FAILS), "refresh_listener": lambda: start("refresh_listener", 0)},
                         first_wait=0.05, log_path=log)
    handled = None
    for name, (out, _) in folders.items():
        part = s.read.parquet(out).agg(F.count("*").alias("handled")).select(F.lit(name).alias("listener"), "handled")
        handled = part if handled is None else handled.unionByName(part)
    return s.read.schema(EV.LOG_DDL).json(log).join(handled, "listener").select("listener", "event", "attempt", "wait_seconds", "handled")
