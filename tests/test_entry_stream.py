import uuid


import __spark_entry__ as E
from lotwise.session import scratch_path
from lotwise.streaming import events as EV


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "Car_Price_USD" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_event_decode_and_quarantine(spark):
    raw = spark.createDataFrame([("1", '{"status": "new_data_available", "timestamp": "2025-01-01T00:00:00"}'),
                                 ("2", '{"status": "mystery"}'), ("3", "{broken")], "key string, value string")
    dec = EV.decode_events(raw)
    assert {r["key"]: r["valid"] for r in dec.collect()} == {"1": True, "2": False, "3": False}
    q = scratch_path(spark, f"quar-{uuid.uuid4().hex}")
    EV.quarantine(dec, q)
    assert spark.read.json(q).count() == 2


def test_one_refresh_for_a_batch_of_messages(spark):
    src = scratch_path(spark, f"msgs-{uuid.uuid4().hex}")
    spark.createDataFrame([(str(i), '{"status": "warehouse_updated"}') for i in range(5)],
                          "key string, value string").write.json(src)
    calls = []
    ck = scratch_path(spark, f"ck-{uuid.uuid4().hex}")
    EV.refresh_on_event(EV.event_stream(spark, src), lambda bid: calls.append(bid), ck,
                        trigger={"availableNow": True}).awaitTermination()
    assert len(calls) == 1


def test_the_package_can_be_shipped(spark):
    import zipfile

    from lotwise.session import ship_package
    names = zipfile.ZipFile(ship_package(spark)).namelist()
    assert "lotwise/__init__.py" in names and "lotwise/operators/knn.py" in names
