from pyspark.sql import functions as F

from lotwise import functions as L


def one(spark, col, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col(F.col("x")).alias("y")).collect()]


def test_title_case_matches_python(spark):
    vals = ["  mercedes-BENZ ", "o'hare blue", "4WD", "land rover", "", "2wd auto"]
    assert one(spark, L.title_case, vals) == [v.strip().title() for v in vals]


def test_year_and_make(spark):
    assert one(spark, L.year_of_title, ["2017 Veldt Harrier LX", "Veldt Harrier 2016", None]) == ["2017", "", None]
    assert one(spark, L.make_of_title, ["2014 Moor Runner Tall"]) == ["Moor"]


def test_finance_parsing_quirks(spark):
    assert one(spark, L.first_integer, ["$2,417/moEstimate"]) == ["2"]
    assert one(spark, lambda c: L.first_integer(c, fixed=True), ["$2,417/moEstimate"]) == ["2417"]
    fd = ["$3,150 due at signing · 54 mo · 6.05% APR", "60 months at 3.9% APR", None]
    assert one(spark, lambda c: L.down_payment(L.finance_chunk(c, 0)), fd) == ["3,150", "6039", None]
    assert one(spark, lambda c: L.down_payment(L.finance_chunk(c, 0), fixed=True), fd) == ["3,150", None, None]
    assert one(spark, lambda c: L.apr(L.finance_chunk(c, 2)), fd) == ["6.05", None, None]


def test_price_bins_boundaries(spark):
    vals = [0.0, 4999.99, 5000.0, 15000.0, 30000.0, 60000.0, 60001.0, None]
    assert one(spark, L.price_category, vals, "double") == [
        "Budget (<5K)", "Budget (<5K)", "Affordable (5K-15K)", "Mid-range (15K-30K)", "Premium (30K-60K)",
        "Luxury (>60K)", "Luxury (>60K)", None]
    assert one(spark, L.price_segment, vals, "double") == [
        None, "Budget / Used", "Budget / Used", "Affordable", "Mid-range", "Premium", "Luxury / Supercar", None]


def test_price_text(spark):
    assert one(spark, L.price_numeric, ["$31,407", "$ 20000", "No Cash Price", None]) == [31407.0, 20000.0, None, None]
    assert one(spark, L.format_price, ["$1234", "", None, "Call us"]) == ["$1,234.00", "N/A", "N/A", "Call us"]
    assert one(spark, L.clean_price, ["", "$9.5", None]) == [0.0, 9.5, 0.0]


def test_state_extraction(spark):
    vals = ["Las Vegas, NV", "Washington, DC", "Los Angeles, California", "Portland, Oregon", "Nowhere", None]
    # substring ladder as defined: 'al' (alabama) is found inside "california", 'la' inside "portland"
    assert one(spark, L.extract_state, vals) == ["nevada", "DC", "alabama", "louisiana", None, None]
    assert one(spark, lambda c: L.extract_state(c, fixed=True), vals[2:4]) == ["california", "oregon"]


def test_listed_days_and_mpg(spark):
    assert one(spark, L.listed_days, ["57 days ago", "2 weeks ago", "recently"]) == [57.0, 2.0, None]
    assert one(spark, lambda c: L.listed_days(c, fixed=True), ["2 weeks ago"]) == [14.0]
    assert one(spark, L.mpg_city, ["31 city / 44 highway", "N/A"]) == [31.0, None]
    assert one(spark, L.mpg_highway, ["31 city / 44 highway"]) == [44.0]


def test_features(spark):
    assert one(spark, L.split_features, ["A; B; ;C;", ""]) == [["A", "B", "C"], []]
    assert one(spark, L.features_lines, ["a\n\n b \n"]) == [["a", "b"]]
