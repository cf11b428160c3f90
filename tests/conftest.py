import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lotwise.session import get_spark
    s = get_spark("local[4]", app="lotwise-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lotwise-test-ckpt-"))
    yield s


LISTING_KEYS = ["Title", "Cash Price", "Finance Price", "Finance Details", "Exterior", "Interior", "Mileage",
                "Fuel Type", "MPG", "Transmission", "Drivetrain", "Engine", "Location", "Listed Since", "VIN",
                "Stock Number", "Features"]


def raw_rows(spark, rows):
    """Hand-made raw listing rows (dicts with any subset of the 17 keys)."""
    data = [tuple(r.get(k) for k in LISTING_KEYS) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"`{k}` string" for k in LISTING_KEYS))
