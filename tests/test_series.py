from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from perfspark.functions.numbers import blank_to_null, round_py, to_day, to_int, to_num
from perfspark.functions.text import clock_slot, first_listed, flat_label
from perfspark.functions.zones import acwr_zone, recovery_zone
from perfspark.operators import roster, series, summaries

METRIC = ("vald_id string, test_type string, metric_name string, limb string, trial_limb string, "
          "recorded_date string, value string")
A, B = "AAAA1111-0000", "BBBB2222-0000"


def metric(spark, *rows):
    full = [(i, "CMJ", m, limb, leg, d, v) for i, m, limb, leg, d, v in rows]
    return spark.createDataFrame(full, METRIC)


def jumps(spark, *rows, who=A, name=series.JUMP_HEIGHT):
    return metric(spark, *[(who, name, "Trial", None, d, v) for d, v in rows])


def test_parsers(spark):
    cells = [" 5 ", "1e3", "nan", "inf", "1.0d", "1_000", "x", None, "-.5", "3.0"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r[0] for r in df.select(to_num("c")).collect()]
    assert got == [5.0, 1000.0, None, None, None, None, None, None, -0.5, 3.0]
    assert [r[0] for r in df.select(to_int("c")).collect()][-1] is None
    odd = spark.createDataFrame([("±12.5y",), ("-",)], "c string")
    assert [r[0] for r in odd.select(to_num("c", strip=True)).collect()] == [12.5, None]
    days = spark.createDataFrame([("2024-02-03T10:00",), ("20240203",), ("2024-02-30",)], "c string")
    assert [r[0] for r in days.select(to_day("c")).collect()] == [date(2024, 2, 3), None, None]


def test_round_is_exact_half_even(spark):
    values = [2.675, 0.125, 0.375, 1.005, -2.675, -0.125, 1e15 + 0.3, 42.0005, 0.5, 1.5]
    values += [i / 2000 for i in range(-400, 400)]
    for digits in (0, 1, 2, 3):
        df = spark.createDataFrame([(v, float(round(v, digits))) for v in values], "v double, w double")
        assert df.where(round_py("v", digits) != F.col("w")).count() == 0


def test_session_best(spark):
    df = jumps(spark, ("2026-02-01", "40.0"), ("2026-02-01", "42.5"), ("2026-02-08", "41.0"),
               ("2026-02-08", "bad"), (None, "50"))
    got = {(r.session_date, r.value, r.n) for r in series.jump_history(df).collect()}
    assert got == {(date(2026, 2, 1), 42.5, 2), (date(2026, 2, 8), 41.0, 1)}
    low = series.session_best(jumps(spark, ("2026-02-01", "180"), ("2026-02-01", "170")),
                              keys=["vald_id"], day="recorded_date", best="min").first()
    assert (low.value, low.n) == (170.0, 2)


def test_acute_chronic(spark):
    df = jumps(spark, ("2026-02-01", "40"), ("2026-02-01", "44"), ("2026-02-04", "46"))
    out = series.acute_chronic(df, keys=["vald_id"], day="recorded_date").orderBy("date").collect()
    assert out[0].dailymean == 42.0
    assert (out[1].acute, out[1].chronic, out[1].acwr) == (44.0, 44.0, 1.0)


def test_acute_chronic_counts_calendar_days_and_zero(spark):
    df = jumps(spark, ("2026-02-01", "10"), ("2026-02-08", "30"), ("2026-03-30", "0"))
    out = series.acute_chronic(df, keys=["vald_id"], day="recorded_date").orderBy("date").collect()
    assert (out[1].acute, out[1].chronic, out[1].acwr) == (30.0, 20.0, 1.5)
    assert out[2].acwr is None


def test_asymmetry(spark):
    name = series.JUMP_HEIGHT
    df = metric(spark, (A, name, "Trial", "Left", "2026-03-01", "900"),
                (A, name, "Trial", "Right", "2026-03-01", "1100"),
                (A, name, "Trial", "Left", "2026-03-08", "1000"))
    out = series.asymmetry_history(df, keys=["vald_id"], day="recorded_date").collect()
    assert [(r.left, r.right, r.asym_pct) for r in out] == [(900.0, 1100.0, 20.0)]


def test_squad_keeps_ids_and_ignores_case(spark):
    df = jumps(spark, ("2026-01-01", "40")).unionByName(jumps(spark, ("2026-01-01", "50"), who=B))
    ids = spark.createDataFrame([(A,), (B.lower(),), ("CCCC3333",)], "vald_id string")
    got = {r.vald_id: r.value for r in series.squad_metric(ids, df).collect()}
    assert got == {A: 40.0, B.lower(): 50.0, "CCCC3333": None}


def test_rebound_history(spark):
    schema = "vald_id string, test_name string, test_date string, field string, value string"
    raw = "flightTimeOverContractionTime"
    df = spark.createDataFrame([(A, series.REBOUND_TEST, "2026-04-01", raw, "2.6"),
                                (A, series.REBOUND_TEST, "2026-04-01", raw, "2.9"),
                                (A, series.REBOUND_TEST, "2026-04-01", "contactTimeSeconds", "180"),
                                (A, series.REBOUND_TEST, "2026-04-01", "contactTimeSeconds", "170")],
                               schema)
    row = series.rebound_history(df).first()
    assert (row.value, row.n) == (2.9, 2)
    assert series.rebound_history(df, "contact").first().value == 170.0


def test_zones(spark):
    df = spark.createDataFrame([(None,), (0.8,), (1.3,), (1.4,), (1.51,), (0.49,)], "v double")
    got = [r[0] for r in df.select(acwr_zone(F.col("v"))).collect()]
    assert got == ["#94a3b8", "#16a34a", "#16a34a", "#fbb800", "#dc2626", "#dc2626"]
    df = spark.createDataFrame([(None,), (67.0,), (34.0,), (33.9,)], "v double")
    assert [r[0] for r in df.select(recovery_zone(F.col("v"))).collect()] == [
        "#94a3b8", "#16a34a", "#fbb800", "#dc2626"]


def test_text_rules(spark):
    clocks = ["16:00", "07:30", "2026-06-08T13:05:00", "2026-06-08T09:00", "", None, "garbage"]
    df = spark.createDataFrame([(c,) for c in clocks], "c string")
    assert [r[0] for r in df.select(clock_slot("c")).collect()] == [
        "PM", "AM", "PM", "AM", "AM", "AM", "AM"]
    lists = spark.createDataFrame([("TBD, 200m , x",), ("tbd",), (None,)], "c string")
    assert [r[0] for r in lists.select(first_listed("c")).collect()] == ["200m", None, None]
    labels = spark.createDataFrame([('{"name": "Male"}',), ('{"description": "F"}',), ("M",)], "c string")
    assert [r[0] for r in labels.select(flat_label("c")).collect()] == ["Male", "F", "M"]
    ids = spark.createDataFrame([("",), ("0",), ("None",), (None,), ("77",)], "c string")
    assert [r[0] for r in ids.select(blank_to_null("c")).collect()] == [None] * 4 + ["77"]


SESSION = ("athlete_id string, date string, startTime string, durationMinutes double, trimp double, "
           "calories double, aerobicTE double, acwr double")


def resolved(spark, **ids):
    row = {"sams_player_id": 1, "sams_mrn": "m1", "sams_name": "Ann", "vald_id": None,
           "whoop_id": None, "firstbeat_id": None, **ids}
    schema = ("sams_player_id int, sams_mrn string, sams_name string, vald_id string, "
              "whoop_id string, firstbeat_id string")
    idents = spark.createDataFrame([tuple(row.values())], schema)
    asked = spark.createDataFrame([(1, None), (9, None)], "player_id int, mrn string")
    return roster.resolve_ids(asked, idents).drop("resolved_by")


def test_load_summary(spark):
    sessions = spark.createDataFrame([
        ("77", "2026-06-08", "16:00", 60.0, 40.0, 500.0, 3.0, None),
        ("77", "2026-06-02", "07:00", 30.0, 10.0, 100.0, None, 1.2),
        ("77", "2026-05-13", "07:00", 30.0, 20.0, 100.0, None, None),
        ("77", "2026-04-01", "07:00", 30.0, 99.0, 100.0, None, None)], SESSION)
    as_of = F.lit("2026-06-09").cast("date")
    out = summaries.load_summary(resolved(spark, firstbeat_id="77"), sessions, as_of)
    one, other = out.orderBy("player_id").collect()
    assert (one.matched, one.has_data, one.athlete_name) == (True, True, "Ann")
    assert (one.last7.n, one.last7.kcal, one.last7.load, one.last7.intensity) == (2, 600, 50, 3.0)
    assert (one.last28.n, one.last28.load, one.acwr) == (3, 70, 1.2)
    assert one.load_series[-2] == 40 and one.load_series[6] == 10 and sum(one.load_series) == 50
    assert (other.matched, other.has_data) == (False, False)


def test_energy_by_slot(spark):
    day = "2026-06-08"
    df = spark.createDataFrame([("1", day, "16:00", 0.0, 0.0, 300.0, None, None),
                                ("1", day, None, 0.0, 0.0, 200.0, None, None),
                                ("1", day, "07:30", 0.0, 0.0, 50.0, None, None),
                                ("1", day, "07:30", 0.0, 0.0, 0.0, None, None)], SESSION)
    slots = series.energy_by_slot(df, keys=["athlete_id"])
    assert {r.slot: r.kcal for r in slots.collect()} == {"PM": 300.0, "AM": 250.0}
    wide = series.energy_calendar(slots, keys=["athlete_id"]).first()
    assert (wide.AM, wide.PM) == (250.0, 300.0)


def test_jump_summary(spark):
    results = jumps(spark, ("2026-01-01", "40"), ("2026-02-01", "45")).unionByName(
        jumps(spark, ("2026-02-01", "60"), name=series.PEAK_POWER))
    rebounds = spark.createDataFrame(
        [(A, series.REBOUND_TEST, "2026-04-01", "flightTimeOverContractionTime", "2.8")],
        "vald_id string, test_name string, test_date string, field string, value string")
    out = summaries.jump_summary(resolved(spark, vald_id=A.lower()), results, rebounds)
    one, other = out.orderBy("player_id").collect()
    assert one.today.cmj_jump_height_cm == 45.0 and one.today.rjt_tf_tc == 2.8
    assert [s.value for s in one.cmj_series] == [40.0, 45.0] and one.n_cmj_sessions == 2
    assert (other.matched, other.has_data) == (False, False)
    bad = summaries.jump_summary(resolved(spark, vald_id="x'; drop"), results, rebounds)
    assert not bad.orderBy("player_id").first().matched


def test_recovery_summary(spark):
    day = "whoop_user_id int, recorded_date string, "
    rec = spark.createDataFrame([(5, "2026-06-08", 80.0, 100.0, 50.0), (5, "2026-06-07", None, 1.0, 1.0)],
                                day + "recovery_score double, hrv_rmssd_milli double, "
                                      "resting_heart_rate double")
    load = spark.createDataFrame([(5, "2026-06-08", 12.5, 2000.0)], day + "strain double, calories double")
    sleep = spark.createDataFrame(
        [(5, "2026-06-08T23:00", 440.0, 90.0, 90.0, 100.0, 200.0, 30.0)],
        "whoop_user_id int, start_time string, total_sleep_mins double, sleep_performance double, "
        "deep_sleep_mins double, rem_sleep_mins double, light_sleep_mins double, awake_mins double")
    out = summaries.recovery_summary(resolved(spark, whoop_id="5"), rec, load, sleep)
    one = out.orderBy("player_id").first()
    assert (one.today.recovery, one.today.strain, one.today.sleep_mins) == (80.0, 12.5, 440.0)
    assert one.sleep_stages.deep == 90.0 and one.avg7.recovery == 80.0 and one.n_days == 2
    assert one.recovery_series == [80.0]


def test_windows_use_one_sort_and_late_limits(spark):
    df = jumps(spark, ("2026-02-01", "40"))
    plan = series.acute_chronic(df, keys=["vald_id"], day="recorded_date")
    text = plan._jdf.queryExecution().executedPlan().toString()
    # One shuffle to reduce rows to days, one to bring an athlete's days together; one window.
    assert text.count("Exchange hashpartitioning") == 2 and text.count("- Window ") == 1
    ranked = series.recent_rows_avg(df, keys=["vald_id"], order=[F.desc("recorded_date")],
                                    values=["value"])
    assert "WindowGroupLimit" in ranked._jdf.queryExecution().executedPlan().toString()
