from __future__ import annotations

import json
from datetime import date

from pyspark.sql import functions as F

from perfspark.functions import body
from perfspark.functions.maturity import growth_phase, maturity_status
from perfspark.functions.numbers import age_at, to_day
from perfspark.operators import bodycomp, maturity

RECORD = ("player_id int, athlete_name string, date_of_birth string, date_of_measure string, "
          "level string, measurements string, maturation string")


def record(spark, *rows):
    return spark.createDataFrame([(p, "Ann", dob, dom, "L1", m if isinstance(m, str) else json.dumps(m),
                                   mat) for p, dob, dom, m, mat in rows], RECORD)


def one(spark, sites, dob="2000-06-01", dom="2018-07-01"):
    return bodycomp.anthro_sessions(record(spark, (1, dob, dom, sites, None))).first()


def test_trials(spark):
    df = spark.createDataFrame([(10.0, 12.0, 11.0), (10.0, 12.0, None), (10.0, None, None),
                                (None, 5.0, None)], "a double, b double, c double")
    got = [r[0] for r in df.select(body.trial_result(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [11.0, 11.0, 10.0, None]


def test_plain_numbers_and_trials_mix(spark):
    row = one(spark, {"bodyMass": {"m1": "64.2"}, "stature": 179.5, "armSpan": "180",
                      "sittingHeight": {"m1": 90, "m2": 91}})
    assert (row.bmi, row.percent_bf, row.arm_span, row.sitting_height) == (19.9, None, 180.0, 90.5)
    empty = one(spark, "not json")
    assert empty.bmi is None and empty.somatotype is None


def test_skinfolds(spark):
    sites = {k: {"m1": 8.0} for k in body.SKINFOLDS_8}
    row = one(spark, {**sites, "bodyMass": {"m1": 70}})
    assert (row.sum8, row.sum4, row.age) == (64.0, 32.0, 18)
    assert 0 < row.percent_bf < 30 and row.ffm < 70
    assert row.body_density == round(1.162 - 0.063 * 1.505149978, 4)
    none = one(spark, {k: 0 for k in body.SKINFOLDS_8} | {"bodyMass": 70, "stature": 170})
    assert none.body_density is None and none.bmi == 24.2


def test_somatotype(spark):
    sites = {"sf_triceps": 8, "sf_subscapular": 8, "sf_supraspinale": 6, "sf_medialCalf": 7,
             "b_humerus": 7, "b_femur": 9.5, "g_armFlexed": 32, "g_calf": 36, "stature": 178,
             "bodyMass": 70}
    folds = (8 + 8 + 6) * (170.18 / 178)
    endo = -0.7182 + 0.1451 * folds - 0.00068 * folds ** 2 + 0.0000014 * folds ** 3
    row = one(spark, sites)
    parts = row.somatotype.split("-")
    assert len(parts) == 3 and parts[0] == f"{endo:.1f}"
    assert one(spark, {k: v for k, v in sites.items() if k != "g_calf"}).somatotype is None


def test_trials_as_text_and_numbers(spark):
    sites = {"bodyMass": {"m1": "70", "m2": 71.0, "m3": " 72 "}, "stature": "180.5",
             "sittingHeight": {"m1": 90, "m2": "x"}, "armSpan": {"m1": True, "m2": 3}}
    got = one(spark, sites)
    assert (got.body_mass, got.stature, got.sitting_height, got.arm_span) == (71.0, 180.5, 90.0, None)
    wild = one(spark, '{"bodyMass": {"m1": NaN, "m2": 1e999}, "stature": {"m1": \'170\'}}')
    assert (wild.body_mass, wild.stature) == (None, 170.0)


def test_growth_parses_below_no_filter(spark):
    """Measurements are parsed once for all that is asked of them, not again by a pushed filter."""
    rows = record(spark, (1, "2008-01-01", "2024-09-17", {"bodyMass": 50, "stature": 167.5}, None))
    growth = bodycomp.growth_series(bodycomp.anthro_sessions(rows))
    plan = growth._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x.split("(")[0] and "from_json" in x]
    assert not [x for x in plan.splitlines() if " Filter " in f" {x.lstrip(':+- ')}" and "from_json" in x]
    assert growth.count() == 1


def test_ages(spark):
    df = spark.createDataFrame([("2000-06-02", "2018-06-01"), ("2000-06-01", "2018-06-01"),
                                ("2018-01-01", "2000-01-01"), ("x", "2000-01-01")], "a string, b string")
    got = [r[0] for r in df.select(age_at(to_day("a"), to_day("b"))).collect()]
    assert got == [17, 18, None, None]


def test_anthro_summary(spark):
    old, new = {"bodyMass": 40, "stature": 150}, {"bodyMass": 50, "stature": 167.5}
    rows = record(spark, (1, "2008-01-01", "2024-09-17", new, None),
                  (1, "2008-01-01", "2019-01-01", old, '{"phv": 1}'),
                  (1, "2008-01-01", "2018-01-01", {}, "{}"))
    sessions = bodycomp.anthro_sessions(rows)
    people = spark.createDataFrame([(1,), (2,)], "player_id int")
    got = {r.player_id: r for r in bodycomp.anthro_summary(sessions, athletes=people).collect()}
    assert got[1].latest.date == date(2024, 9, 17) and got[1].latest.bmi == 17.8
    assert got[1].n_sessions == 3 and got[1].maturation == '{"phv": 1}'
    assert (got[2].matched, got[2].has_data) == (True, False)
    growth = bodycomp.growth_series(sessions).orderBy("date").collect()
    assert [g.stature for g in growth] == [150.0, 167.5]


def test_maturity_rules(spark):
    df = spark.createDataFrame([(-1.0,), (-0.5,), (0.9,), (1.0,), (None,)], "v double")
    assert [r[0] for r in df.select(maturity_status(F.col("v"))).collect()] == [
        "Late", "Normal", "Normal", "Early", None]
    df = spark.createDataFrame([(84.9,), (85.0,), (90.0,), (96.0,), (None,)], "v double")
    assert [r[0] for r in df.select(growth_phase(F.col("v"))).collect()] == [
        "Pre PHV", "Approaching PHV", "Circa PHV", "Post PHV", None]


def test_assessments(spark):
    schema = ("sams_id int, sams_name string, record_date string, current_age string, fels string, "
              "predicted_adult_height_reached string, maturity_status string, "
              "maturity_status_interim string, phv_predicted_height_status string")
    df = spark.createDataFrame([
        (1, "Ann", "2024-01-01", "14.03", "13.94", "92", "Stored", "", "Kept"),
        (2, None, "2024-01-01", "12.5", "± 14.0", "91", "", None, ""),
        (1, "Ann", "2023-01-01", "13", "x", None, None, None, None)], schema)
    history = maturity.assessments(df)
    a = history.where("sams_id = 1 and date = '2024-01-01'").first()
    assert (a.maturity_offset, a.maturity_status, a.phv_status) == (-0.09, "Stored", "Kept")
    b = history.where("sams_id = 2").first()
    assert (b.maturity_offset, b.maturity_status, b.phv_status) == (1.5, "Early", "Circa PHV")
    people = spark.createDataFrame([(1,), (3,)], "sams_id int")
    got = {r.sams_id: r for r in maturity.maturity_summary(history, athletes=people).collect()}
    assert got[1].n_assessments == 2 and got[1].latest.date == date(2024, 1, 1)
    assert (got[3].matched, got[3].has_data) == (False, False)
