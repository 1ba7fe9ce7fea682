from __future__ import annotations

from datetime import date

from pyspark.sql import Window as W, functions as F

from perfspark.functions import events as ev
from perfspark.operators import norms

NORMS = "event string, age_bin string, p0 double, p25 double, p50 double, p75 double, p100 double"
RESULTS = ("athlete_id string, Start_Date string, Event_standard string, Result_numerical string, "
           "date_of_birth string")


def norm_rows(spark):
    return spark.createDataFrame([
        ("Long Jump", "15 - 16", 4.0, 5.0, 5.5, 6.0, 7.0),
        ("Long Jump", "13 - 14", 3.0, 4.0, 4.5, 5.0, 6.0),
        ("Long Jump", "17 - 18", 5.0, 5.5, 6.0, 6.5, 8.0),
        ("800m", "15 - 16", 140.0, 130.0, 120.0, 112.0, 100.0)], NORMS)


def percentiles(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, Event_standard string, mark string, age double")
    out = norms.percentile_of_mark(df, norm_rows(spark))
    return [r.percentile for r in out.orderBy("i").collect()]


def test_percentiles(spark):
    assert percentiles(spark, [
        ("Long Jump", "5.50", 15.5), ("Long Jump", "5.75", 15.5), ("Long Jump", "8.00", 15.5),
        ("Long Jump", "3.00", 15.5), ("800m", "120", 15.5), ("800m", "116", 15.5),
        ("800m", "95", 15.5), ("800m", "145", 15.5), ("Long Jump", "6.00", 13.0),
        ("Long Jump", "6.00", 18.0), ("4x100m Relay", "50", 15.0), ("Long Jump", "DNF", 15.0),
        ("Long Jump", "5.50", None), ("800m", "120", None)]) == [
        50.0, 62.5, 100.0, 0.0, 50.0, 62.5, 100.0, 0.0, 100.0, 50.0, None, None, None, 50.0]


def test_percentile_never_falls_with_a_better_mark(spark):
    marks = [("Long Jump", str(3 + i / 20), 15.5) for i in range(100)]
    got = percentiles(spark, marks)
    assert got == sorted(got)


def test_curve_edges(spark):
    table = spark.createDataFrame([("Long Jump", "15 - 16", 5.0, 5.0, 5.0, 5.0, 5.0),
                                   ("High Jump", "15 - 16", None, None, 1.5, None, None)], NORMS)
    df = spark.createDataFrame([("Long Jump", 5.0, 15.0), ("High Jump", 1.5, 15.0)],
                               "Event_standard string, mark double, age double")
    got = {r.Event_standard: r.percentile for r in norms.percentile_of_mark(df, table).collect()}
    assert got == {"Long Jump": 0.0, "High Jump": None}


def test_implement_by_age(spark):
    table = spark.createDataFrame([("Shot Put (4kg)", "14.5 - 15.5", 8.0, 9.0, 10.0, 11.0, 12.0),
                                   ("Shot Put", "15.5 - 16.5", 4.0, 5.0, 6.0, 7.0, 8.0)], NORMS)
    df = spark.createDataFrame([("Shot Put", 10.0, 15.9), ("Shot Put", 6.0, 17.0)],
                               "Event_standard string, mark double, age double")
    got = [r.percentile for r in norms.percentile_of_mark(df, table).orderBy("age").collect()]
    assert got == [50.0, 50.0]
    bands = norms.norm_bands(table, pct=(25, 50)).orderBy("age").collect()
    assert [(r.age, r.p50, r.p100) for r in bands] == [(15.0, 10.0, 12.0), (16.0, 6.0, 8.0)]


def test_bands_and_labels(spark):
    df = spark.createDataFrame([(12.5,), (13.49,), (13.5,), (9.0,), (None,), (13.2,)], "a double")
    rows = df.select(ev.age_band_centre(F.col("a")).alias("c"),
                     ev.age_band_label(F.col("a")).alias("l")).collect()
    assert [r.c for r in rows] == [13.0, 13.0, 14.0, 9.0, None, 13.0]
    assert [rows[0].l, rows[5].l, rows[3].l] == ["12.5 - 13.5", "12.5 - 13.5", "8.5 - 9.5"]
    bins = spark.createDataFrame([("12.5 - 13.5",), ("14",), ("x",), (None,)], "b string")
    assert [r[0] for r in bins.select(ev.bin_centre(F.col("b"))).collect()] == [13.0, 14.0, None, None]


def test_directions(spark):
    names = ["100m", "Long Jump", "long jump", "Decathlon", None, "Hammer Throw"]
    df = spark.createDataFrame([(n,) for n in names], "e string")
    got = [r[0] for r in df.select(ev.lower_is_better(F.col("e"))).collect()]
    assert got == [True, False, True, False, True, False]
    aliases = spark.createDataFrame([("contact",), ("tf_tc",), ("other",)], "e string")
    got = [tuple(r) for r in aliases.select(ev.rebound_field(F.col("e")),
                                            ev.rebound_takes_min(F.col("e"))).collect()]
    assert got == [("contactTimeSeconds", True), ("flightTimeOverContractionTime", False),
                   ("other", False)]


def results(spark, event, *rows, who="a"):
    return spark.createDataFrame([(who, d, event, v, "2010-01-01") for d, v in rows], RESULTS)


def test_best_by_age_band(spark):
    table = spark.createDataFrame([("Long Jump", "12.5 - 13.5", 4.5, 5.0, 5.5, 6.0, 6.5),
                                   ("Long Jump", "13.5 - 14.5", 5.0, 5.5, 6.0, 6.5, 7.0)], NORMS)
    df = results(spark, "Long Jump", ("2023-01-05", "5.20"), ("2023-03-01", "5.50"),
                 ("2024-01-05", "6.00"), ("bad", "9"), ("2024-01-06", "DNS"))
    out = norms.best_by_age_band(df, norms=table).orderBy("age_band").collect()
    assert [(r.age_band, r.mark, r.n, r.percentile) for r in out] == [
        (13.0, 5.5, 2, 50.0), (14.0, 6.0, 1, 50.0)]
    assert out[0].age_band_label == "12.5 - 13.5" and out[0].date == date(2023, 3, 1)
    track = results(spark, "200m", ("2023-01-05", "28.1"), ("2023-01-06", "27.2"))
    assert norms.best_by_age_band(track).first().mark == 27.2


def test_running_best_and_ties(spark):
    df = results(spark, "100m", ("2022-01-01", "13.0"), ("2022-02-01", "13.0"),
                 ("2022-02-03", "12.5"), ("2023-01-01", "12.7"), ("2023-01-02", "12.4"))
    out = norms.marks_from_results(df).orderBy("date").collect()
    assert [r.pb for r in out] == [True, False, True, False, True]
    assert out[0].age == 12.0


def test_running_best_equals_a_plain_window(spark):
    """Chunks of any size give the answer of one ordered pass."""
    df = spark.range(600).select(
        F.when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 7))
        .alias("athlete_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 37 % 400).cast("int"))
        .alias("Start_Date"), F.lit("100m").alias("Event_standard"),
        (F.hash("id") % 1000).cast("double").alias("Result_numerical"),
        F.lit("2005-01-01").alias("date_of_birth"), F.col("id").alias("seq"))
    w = (W.partitionBy("athlete_id").orderBy("Start_Date", "seq")
         .rowsBetween(W.unboundedPreceding, -1))
    best = F.min("Result_numerical").over(w)
    want = {r.seq: r.pb for r in df.select(
        "seq", (best.isNull() | (F.col("Result_numerical") < best)).alias("pb")).collect()}
    for chunk in ("day", "month", "year"):
        got = norms.marks_from_results(df, seq="seq", chunk=chunk)
        assert {r.seq: r.pb for r in got.collect()} == want


def test_benchmark_inputs(spark):
    standards = spark.createDataFrame(
        [("100m", "M", 10.5, "10.50", "time", True), ("Long Jump", "W", None, "x", "distance", False)],
        "event_standard string, sex string, standard_numeric double, standard_raw string, "
        "metric string, lower_is_better boolean")
    df = results(spark, "100m", ("2023-01-05", "12.0"), ("2023-02-05", "11.5")).withColumn(
        "sex", F.lit("Male"))
    extra = spark.createDataFrame([("100m", "M", 9.8, "Record")], "event string, sex string, y double, label string")
    made = norms.benchmark_inputs(df, standards, norm_rows(spark), extra_refs=extra)
    assert {(r.lower_is_better, r.value_format, r.pb) for r in made.marks.collect()} == {
        (True, "time", True)}
    lines = {(r.event, r.y, r.label) for r in made.reference_lines.collect()}
    assert lines == {("100m", 10.5, "World U20 standard (10.50)"), ("100m", 9.8, "Record")}
    assert made.bands.count() == 4
