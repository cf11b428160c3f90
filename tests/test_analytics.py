import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lotwise.operators import profile as P
from lotwise.operators import segments as S


def _frame(spark):
    rows = [("Budget / Used", "Ford", "Yes", 10.0), ("Budget / Used", "Kia", "No", 20.0),
            ("Premium", "Ford", "Yes", 30.0), ("Premium", None, "Yes", 40.0), (None, "Kia", "No", 50.0)]
    return spark.createDataFrame(rows, "`Price Segment` string, `Car Make` string, `Financing Support` string, "
                                       "Mileage double")


def test_segment_counts_keep_empty_segments(spark):
    out = S.segment_counts(_frame(spark)).collect()
    assert [r["n"] for r in out] == [2, 0, 0, 2, 0]


def test_crosstab_rows_sum_to_100(spark):
    ct = S.crosstab_pct(_frame(spark), "Car Make", "Price Segment")
    sums = ct.groupBy("row_value").agg(F.sum("pct").alias("s")).collect()
    assert all(abs(r["s"] - 100.0) < 1e-9 for r in sums)


def test_top_n_else_other(spark):
    df = spark.createDataFrame([(c,) for c in "aaabbc"] + [(None,)], "x string")
    out = S.top_n_else_other(df, "x", "top", n=2, other="Other")
    assert sorted(r["top"] for r in out.collect()) == ["Other", "Other", "a", "a", "a", "b", "b"]


def test_boxplot_and_histogram(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [1, 2, 3, 4, 100]], "g string, v double")
    b = P.boxplot_summary(df, "g", "v").first()
    assert (b["q1"], b["median"], b["q3"], b["whisker_high"], b["n_outliers"]) == (2.0, 3.0, 4.0, 4.0, 1)
    h = P.histogram_by_group(df, "g", "v", bins=3).collect()
    assert sum(r["n"] for r in h) == 5 and max(r["bin"] for r in h) == 3


def test_correlation_matrix_equals_pandas(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(300, 4)) * [1, 1e4, 3, 1] + [0, 5e4, 2000, 0]
    x[:, 2] += 2 * x[:, 0]
    x[rnd.random(x.shape) < 0.1] = np.nan
    x[:, 3] = 7.0
    pdf = pd.DataFrame(x, columns=list("abcd"))
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double, d double").repartition(5)
    want = pdf.corr()
    got = {(r.col_a, r.col_b): r["corr"] for r in P.correlation_matrix(df, list("abcd")).collect()}
    assert len(got) == 16
    for (a, b), v in got.items():
        if "d" in (a, b) and a != b:
            assert v is None
        else:
            assert abs(v - (1.0 if a == b else want.loc[a, b])) < 1e-9
