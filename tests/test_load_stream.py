import uuid

import pytest
from pyspark.sql import functions as F

from lotwise.operators import snapshots as S
from lotwise.operators import warehouse as W
from lotwise.operators.cleaning import null_sentinels
from lotwise.operators.dedup import dedup_by_key
from lotwise.operators.transform import transform_listings
from lotwise.schemas import LISTING_FIELDS
from lotwise.session import scratch_path
from lotwise.streaming import events as EV

from .conftest import raw_rows

ROWS = [{"Title": f"20{10 + i} Make{i} Model", "VIN": f"V{i}", "Cash Price": f"${i},000", "Mileage": f"{i} miles"} for i in range(6)]


def scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def contents(spark, root):
    return {n: sorted(map(str, W.read_table(spark, root, n).drop("load_date").collect())) for n in W.LOAD_TABLES}


def test_a_load_that_stops_anywhere_shows_nothing_and_the_next_one_all(spark, monkeypatch):
    listing = transform_listings(raw_rows(spark, ROWS))
    whole, none = scratch(spark, "whole"), {n: [] for n in W.LOAD_TABLES}
    W.incremental_load(spark, listing, whole, run_id=1)
    want, write = contents(spark, whole), W._write_part
    for stop in range(len(W.LOAD_TABLES)):
        root, done = scratch(spark, "crash"), []

        def crash(*args, done=done, stop=stop, root=root):
            if len(done) == stop:
                raise RuntimeError("lost")
            done.append(1)
            n = write(*args)
            assert contents(spark, root) == none  # a reader during the load
            return n
        monkeypatch.setattr(W, "_write_part", crash)
        with pytest.raises(RuntimeError, match="lost"):
            W.incremental_load(spark, listing, root, run_id=5)
        monkeypatch.setattr(W, "_write_part", write)
        assert contents(spark, root) == none
        added = {r.table: r.rows_added for r in W.incremental_load(spark, listing, root, run_id=6).collect()}
        assert added == dict.fromkeys(W.LOAD_TABLES, 6) and contents(spark, root) == want
        log = {(r.id, r.status) for r in W.read_table(spark, root, "etl_log").collect()}
        assert log == {(5, "FAILED"), (6, "SUCCESS")}


def test_a_second_load_during_a_load_adds_no_key_twice_and_readers_see_whole_loads(spark, monkeypatch):
    first, all_rows = transform_listings(raw_rows(spark, ROWS[:4])), transform_listings(raw_rows(spark, ROWS))
    root, whole, write, seen = scratch(spark, "two"), scratch(spark, "whole"), W._write_part, []
    W.incremental_load(spark, all_rows, whole, run_id=1)

    def meet(rows, path):
        n = write(rows, path)
        if not seen:
            seen.append(1)
            W.incremental_load(spark, first, root, run_id=8)  # commits while the other load is writing
        assert {len(x) for x in contents(spark, root).values()} in ({0}, {4})
        return n
    monkeypatch.setattr(W, "_write_part", meet)
    added = {r.table: r.rows_added for r in W.incremental_load(spark, all_rows, root, run_id=9).collect()}
    monkeypatch.setattr(W, "_write_part", write)
    assert added == dict.fromkeys(W.LOAD_TABLES, 2) and contents(spark, root) == contents(spark, whole)
    assert {r.table: r.rows_added for r in W.incremental_load(spark, all_rows, root, run_id=9).collect()} == dict.fromkeys(W.LOAD_TABLES, 0)
    assert W.read_table(spark, root, "etl_log").count() == 2 and S.latest(spark, root)[0] == 2


def test_snapshots_conflict_and_empty(spark):
    root = scratch(spark, "snap")
    assert S.latest(spark, root) == (0, {})
    S.commit(spark, root, 1, {"a": ["x"]})
    with pytest.raises(S.SnapshotConflict):
        S.commit(spark, root, 1, {"a": ["y"]})
    assert S.latest(spark, root) == (1, {"a": ["x"]})
    assert S.update(spark, root, lambda f: f) == {"a": ["x"]} and S.latest(spark, root)[0] == 1
    assert W.read_table(spark, root, "car_info").count() == 0


def test_stream_equals_batch_with_copies_in_different_files(spark):
    copies = ROWS + [{**r, "Title": "1999 Aaa First", "Fuel Type": "Gas"} for r in ROWS[:3]] + [{**ROWS[4], "Mileage": None}, {"Title": "2001 No Vin"}]
    raw = null_sentinels(raw_rows(spark, copies), exclude=("VIN",))
    lake, state, ck = scratch(spark, "lake"), scratch(spark, "state"), scratch(spark, "ck")
    assert W.read_survivors(spark, state) is None
    raw.repartition(len(copies)).write.option("maxRecordsPerFile", 1).json(lake)
    schema = ", ".join(f"`{c}` string" for c in LISTING_FIELDS)
    EV.ingest_listings_stream(spark, lake, schema, lambda b, _i: W.merge_survivors(spark, b, state), ck, trigger={"availableNow": True}).awaitTermination()
    got = W.read_survivors(spark, state)
    want = dedup_by_key(raw.select(got.columns))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 7
    W.merge_survivors(spark, raw.limit(3), state)  # a replayed batch changes nothing
    assert sorted(map(str, W.read_survivors(spark, state).collect())) == sorted(map(str, want.collect()))


def test_a_batch_writes_its_own_keys_and_merges_stay_logarithmic(spark):
    rows = spark.range(640).selectExpr("concat('K', id % 400) AS VIN", "CAST(id AS string) AS Title", "id % 16 AS b")
    state, written = scratch(spark, "state"), []
    for i in range(16):
        batch = rows.where(F.col("b") == i).drop("b")
        keys = batch.select("VIN").distinct().count()
        n = W.merge_survivors(spark, batch, state, fanout=4)
        written.append(n)
        if (i + 1) % 4:
            assert n == keys  # nothing else is rewritten
    assert sum(written) <= 640 * 3  # once a tier
    tiers = S.latest(spark, state)[1]
    assert [len(tiers.get(str(t), [])) for t in range(3)] == [0, 0, 1]
    want = dedup_by_key(rows.drop("b"))
    assert sorted(map(str, W.read_survivors(spark, state).collect())) == sorted(map(str, want.collect()))


def test_supervisor_restarts_as_often_as_it_takes(spark):
    src, ck = scratch(spark, "msgs"), scratch(spark, "ck")
    spark.createDataFrame([("1", '{"status": "warehouse_updated"}')], "key string, value string").write.json(src)
    calls = []

    def flaky(_b, _i):
        calls.append(1)
        if len(calls) <= 10:
            raise RuntimeError("down")

    def start():
        return EV.event_stream(spark, src).writeStream.option("checkpointLocation", ck).foreachBatch(flaky).trigger(availableNow=True).start()
    log = scratch(spark, "log")
    assert EV.supervise_streams({"one": start}, first_wait=0.01, longest_wait=0.1, log_path=log) == {"one": 10}
    rows = sorted((r.attempt, r.event, r.wait_seconds) for r in spark.read.schema(EV.LOG_DDL).json(log).collect())
    assert rows == [(i, "failed", min(0.1, 0.01 * 2 ** (i - 1))) for i in range(1, 11)] + [(11, "ended", None)]


def test_supervisor_stops_what_runs_and_retries_starts(spark):
    src, ck, tries = scratch(spark, "msgs"), scratch(spark, "ck"), []
    spark.createDataFrame([], "key string, value string").write.json(src)

    def start():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("broker away")
        return EV.event_stream(spark, src).writeStream.option("checkpointLocation", ck).format("noop").start()
    assert EV.supervise_streams({"one": start}, poll_seconds=0.05, until=lambda: len(tries) == 3 and bool(spark.streams.active), first_wait=0.01) == {"one": 2}
    assert not spark.streams.active


def test_quarantine_of_a_replayed_batch(spark):
    bad = EV.decode_events(spark.createDataFrame([("3", "{broken")], "key string, value string"))
    path = scratch(spark, "quar")
    for _ in range(2):
        EV.quarantine(bad, path, 4)
    EV.quarantine(bad, path, 5)
    assert spark.read.json(path).agg(F.count("key")).first()[0] == 2


def test_listeners_run_on_by_default(spark):
    src, ck = scratch(spark, "msgs"), scratch(spark, "ck")
    spark.createDataFrame([], "key string, value string").write.json(src)
    q = EV.etl_on_event(EV.event_stream(spark, src), lambda _i: None, ck)
    assert q.isActive
    q.stop()


def test_an_error_of_the_callback_is_logged_and_the_stream_goes_on(spark):
    src, ck, errors = scratch(spark, "msgs"), scratch(spark, "ck"), scratch(spark, "errors")
    for i in range(4):
        spark.createDataFrame([(str(i), '{"status": "new_data_available"}')], "key string, value string").coalesce(1).write.mode("append").json(src)
    ran = []

    def etl(batch_id):
        ran.append(batch_id)
        if batch_id == 1:
            raise RuntimeError("no warehouse")
    EV.etl_on_event(EV.event_stream(spark, src, max_files_per_trigger=1), etl, ck, trigger={"availableNow": True}, error_path=errors).awaitTermination()
    assert ran == [0, 1, 2, 3]
    log = spark.read.json(errors).collect()
    assert len(log) == 1 and log[0].error == "RuntimeError: no warehouse" and log[0].batch_id == 1
