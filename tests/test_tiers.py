from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldstats.operators import tiers as t


def labels(spark, values, make):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, n double")
    return [r[0] for r in frame.orderBy("i").select(make(F.col("n"))).collect()]


COUNTS = [0.0, None, 0.5, 1.0, 6.0, 7.0, 12.0, 13.0, 29.0, 30.0, 49.0, 50.0, 69.0, 70.0]


def test_population_limits_and_the_gap_below_one(spark):
    got = labels(spark, COUNTS, lambda n: t.activity_tier(n, t.POPULATION_TIERS))
    assert got == [
        "Stalled", "Stalled", None, "Dabbler", "Dabbler", "Bubble", "Bubble", "Sustainable", "Sustainable",
        "SuperUser", "SuperUser", "MegaUser", "MegaUser", "SuperMega",
    ]


def test_model_and_detailed_limits(spark):
    assert labels(spark, [13.0, 12.9, 6.9, 0.9], lambda n: t.activity_tier(n, t.MODEL_TIERS)) == [
        "Sustainable", "Bubble", "Dabbler", None,
    ]
    assert labels(spark, [20.0, 19.0, 12.0, 9.0, 6.0, 3.0], lambda n: t.activity_tier(n, t.DETAILED_TIERS)) == [
        "Super", "Sustainable", "Upper Bubble", "Lower Bubble", "Upper Dabbler", "Lower Dabbler",
    ]


def test_volume_cohort_productivity(spark):
    assert labels(spark, [0.0, 0.5, 7.0, 13.0, None], t.volume_tier) == [
        "Non-Active", "Dabbler", "Bubble", "Sustainable+", "Dabbler",
    ]
    assert labels(spark, [None, 1.0, 7.0, 13.0], t.cohort_tier) == [
        "No Procedure in Last Quarter", "Dabbler", "Bubble", "Sustainable",
    ]
    assert labels(spark, [0.0, 1.0, 7.0, 13.0, 30.0, 50.0, 70.0], t.productivity_group) == [
        "Untrained/Stalled", "Dabbler", "Bubble", "Sustainable User", "Super User", "Mega User", "Super Mega User",
    ]


def test_missing_and_null_labels_read_as_stalled(spark):
    frame = spark.createDataFrame([(1, "A"), (2, None), (3, "B"), (4, "C")], "q int, label string")
    window = Window.partitionBy(F.lit(1)).orderBy("q")
    got = frame.select("q", t.earlier(F.col("label"), 1, window), t.earlier(F.col("label"), 2, window)).collect()
    assert [tuple(r) for r in got] == [
        (1, "Stalled", "Stalled"), (2, "A", "Stalled"), (3, "Stalled", "A"), (4, "B", "Stalled"),
    ]
