import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from attriflux.operators import features as fe
from attriflux.operators import journeys as jo
from attriflux.operators import ranges as ra


def rows_of(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def touches(spark):
    """One user with half of all touches, one whose touches are all at one time, users with one touch, conversions in a row."""
    draws = random.Random(3)
    rows = [("hot", i // 3, i, draws.random() < 0.05, draws.random()) for i in range(6000)]
    rows += [("still", 7, 10000 + i, i % 400 == 399, 1.0) for i in range(1500)]
    rows += [("never", i, 20000 + i, False, 1.0) for i in range(1500)]
    rows += [("always", i, 30000 + i, True, 2.0) for i in range(300)]
    rows += [(f"u{i % 700}", draws.randrange(50), 40000 + i, draws.random() < 0.3, draws.random()) for i in range(2700)]
    rows += [(None, 1, 50000, True, 1.0), ("nulls", None, 50001, None, None), ("nulls", 2, 50002, True, 3.0)]
    draws.shuffle(rows)
    return spark.createDataFrame(rows, "user_id string, ts int, event_id int, is_conversion boolean, value double").repartition(9).persist()


@pytest.mark.parametrize("parts", [1, 7, 40, 300])
def test_journeys_are_those_of_one_window(spark, touches, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert rows_of(jo.build_journeys_in_ranges(touches)) == rows_of(jo.build_journeys(touches))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_hot_user_spreads(spark, touches):
    sizes = [r["count"] for r in ra.cut_in_ranges(touches, "user_id", ["ts", "event_id"], 40).groupBy(ra.PART).count().collect()]
    assert len(sizes) >= 35 and max(sizes) < 2.5 * sorted(sizes)[len(sizes) // 2]
    border = ra.border_rows(ra.cut_in_ranges(touches, "user_id", ["ts", "event_id"], 40), "user_id")
    assert border.select(ra.PART, "user_id").distinct().count() <= 80


@pytest.mark.parametrize("parts", [1, 13, 200])
def test_features_are_those_of_one_window(spark, parts):
    draws = random.Random(4)
    campaigns = ["hot"] * 300 + [f"c{i % 40}" for i in range(200)] + ["single"]
    rows = [(f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}", c, "s", i, draws.randint(0, 900), float(draws.randint(0, 50)), draws.randint(0, 40),
             draws.randint(0, 9), draws.randint(0, 4), float(draws.randint(0, 90))) for i, c in enumerate(campaigns)]
    columns = "c_date string, campaign_name string, category string, id int, impressions int, mark_spent double, clicks int, leads int, orders int, revenue double"
    facts = spark.createDataFrame([*rows, ("2024-01-01", None, "s", 999, 1, 1.0, 1, 1, 1, 1.0)], columns).withColumn("c_date", F.to_date("c_date"))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        one, two = fe.engineer_features(facts, keep_incomplete=True), fe.engineer_features(facts, keep_incomplete=True, in_ranges=True)
        assert rows_of(one) == rows_of(two) and two.columns == one.columns
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_tables(spark, touches):
    assert jo.build_journeys_in_ranges(touches.limit(0)).count() == 0
