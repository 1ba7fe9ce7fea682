"""Body queries. Orders are measurement sessions of customers; site trials come from the line
items of the order, as JSON. Skeletal assessments are parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import body as fb
from ..functions.numbers import exact_mean, iso
from ..operators import bodycomp, maturity
from .common import day_text, sql_mean, sql_round, table

#: Site -> (offset, factor) of the trial values.
SITES = {"bodyMass": (40.0, 1.0), "stature": (150.0, 0.5), "sf_triceps": (4.0, 0.25),
         "sf_subscapular": (5.0, 0.25), "sf_biceps": (3.0, 0.125), "sf_iliacCrest": (6.0, 0.25),
         "sf_supraspinale": (5.0, 0.125), "sf_abdominal": (8.0, 0.25),
         "sf_frontThigh": (7.0, 0.25), "sf_medialCalf": (4.0, 0.125), "b_humerus": (6.0, 0.03125),
         "b_femur": (8.0, 0.03125), "g_armFlexed": (25.0, 0.25), "g_calf": (30.0, 0.25)}


def records(spark, d) -> DataFrame:
    """Sessions with measurement JSON: lowest, highest and (from three lines on) mean quantity
    are the three trials. The girth of the arm is a plain number."""
    q = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_quantity").alias("a"), F.max("l_quantity").alias("b"),
        exact_mean("l_quantity").alias("s"), F.count(F.lit(1)).alias("n"))
    third = F.when(F.col("n") >= 3, F.col("s"))

    def trial(site: str, v: Column) -> Column:
        base, factor = SITES[site]
        return F.lit(base) + v * factor

    cells = {s: F.struct(trial(s, F.col("a")).alias("m1"), trial(s, F.col("b")).alias("m2"),
                         trial(s, third).alias("m3")) for s in SITES if s != "g_armFlexed"}
    cells["g_armFlexed"] = trial("g_armFlexed", F.col("a"))
    text = F.to_json(F.struct(*[c.alias(s) for s, c in cells.items()]))
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal")
    back = F.floor(F.abs("c_acctbal")).cast("int")
    dob = iso(F.date_sub(F.lit("1988-01-01").cast("date"), back))
    stage = F.when(F.col("o_orderstatus") == "F", F.to_json(F.struct(
        F.col("o_orderpriority").alias("stage"))))
    return (table(spark, d, "orders").join(q, F.col("o_orderkey") == F.col("l_orderkey"))
            .join(c, "o_custkey").select(
                F.col("o_custkey").alias("player_id"), F.col("o_orderkey").alias("mrn"),
                F.col("c_name").alias("athlete_name"), F.col("o_orderstatus").alias("level"),
                dob.alias("date_of_birth"), iso("o_orderdate").alias("date_of_measure"),
                text.alias("measurements"), stage.alias("maturation")))


def body_composition(spark, d):
    s = bodycomp.anthro_sessions(records(spark, d))
    return s.select("player_id", F.col("mrn").alias("session"), iso("date").alias("date"), "age",
                    "body_mass", "stature", "bmi", "sum8", "sum4", "body_density", "percent_bf",
                    "ffm", "fat_mass", "somatotype")


def growth_series(spark, d):
    g = bodycomp.growth_series(bodycomp.anthro_sessions(records(spark, d)))
    return g.withColumn("date", iso("date"))


def anthro_summary(spark, d):
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("player_id"))
    s = bodycomp.anthro_summary(bodycomp.anthro_sessions(records(spark, d)), athletes=people)
    return s.select("player_id", "matched", "has_data", "athlete_name", "n_sessions",
                    iso("latest.date").alias("latest_date"),
                    F.col("maturation").isNotNull().alias("has_maturation"))


def trial_result(spark, d):
    """Median, mean or single value of up to three quantities per order."""
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        *[F.max(F.when(F.col("l_linenumber") == i, F.col("l_quantity"))).alias(f"m{i}")
          for i in (1, 2, 3)])
    return rows.select("l_orderkey", fb.trial_result(
        F.col("m1"), F.col("m2"), F.col("m3")).alias("result"))


def _assessments(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    age = F.col("p_retailprice") / 100
    return p.select(
        F.col("p_brand").alias("sams_id"), F.col("p_name").alias("sams_name"),
        F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_partkey").cast("int")),
                      "yyyy-MM-dd").alias("record_date"),
        age.cast("string").alias("current_age"),
        F.concat(F.lit("± "), (age + (F.col("p_size") - 25) / 10.0).cast("string")).alias("fels"),
        F.col("p_size").cast("string").alias("g_p2"),
        F.when(F.col("p_type") == "LARGE", "1.25").otherwise("").alias("maturity_status_interim"),
        (F.col("p_size") + 60).cast("string").alias("predicted_adult_height_reached"),
        F.when(F.col("p_type") == "SMALL", "Late").otherwise("").alias("maturity_status"),
        F.lit(None).cast("string").alias("phv_predicted_height_status"),
        F.col("p_partkey").alias("mrn"))


def maturity_history(spark, d):
    a = maturity.assessments(_assessments(spark, d))
    return a.select("sams_id", "mrn", iso("date").alias("date"), "current_age", "fels", "gp",
                    "pct_aph", "maturity_offset", "maturity_status", "phv_status")


def maturity_summary(spark, d):
    s = maturity.maturity_summary(maturity.assessments(_assessments(spark, d)))
    return s.select("sams_id", "athlete_name", "n_assessments",
                    iso("latest.date").alias("date"), F.col("latest.fels").alias("fels"),
                    F.col("latest.maturity_status").alias("maturity_status"),
                    F.col("latest.phv_status").alias("phv_status"))


QUERIES = {f.__name__: f for f in (
    body_composition, growth_series, anthro_summary, trial_result, maturity_history,
    maturity_summary)}


# --- SQL twins -------------------------------------------------------------------------------

def _site(s: str) -> str:
    base, factor = SITES[s]
    v = {x: f"({base!r}e0 + {x}*{factor!r}e0)" for x in "abs"}
    if s == "g_armFlexed":
        return f"{v['a']} as {s}"
    mid = f"greatest(least({v['a']}, {v['b']}), least(greatest({v['a']}, {v['b']}), {v['s']}))"
    return f"case when n >= 3 then {mid} else ({v['a']} + {v['b']})/2 end as {s}"


def _exact(sites: list[str]) -> str:
    return "(0e0 + " + " + ".join(sites) + ")"


SUM8, SUM4 = _exact(fb.SKINFOLDS_8), _exact(fb.SKINFOLDS_4)

SESSIONS = f"""
    q as (select l_orderkey, min(l_quantity) as a, max(l_quantity) as b,
            {sql_mean('l_quantity')} as s, count(*) as n from lineitem group by l_orderkey),
    base as (select o_custkey as player_id, o_orderkey as session, cast(o_orderdate as date) as day,
               date '1988-01-01' - cast(floor(abs(c_acctbal)) as integer) as dob, c_name,
               o_orderstatus, {', '.join(_site(s) for s in SITES)}
             from orders join q on o_orderkey = l_orderkey join customer on o_custkey = c_custkey),
    t1 as (select *, year(day) - year(dob) - case when month(day)*100 + day(day)
                     < month(dob)*100 + day(dob) then 1 else 0 end as years,
             bodyMass/((stature/100)*(stature/100)) as x_bmi, {SUM8} as x8, {SUM4} as x4,
             (sf_triceps + sf_subscapular + sf_supraspinale)*(170.18e0/stature) as f,
             stature/pow(bodyMass, 1e0/3e0) as ratio from base),
    t2 as (select *, case when years between 0 and 100 then years end as age,
             {sql_round('x_bmi', 1)} as bmi, {sql_round('x8', 1)} as sum8,
             {sql_round('x4', 1)} as sum4,
             greatest(0.1e0, -0.7182e0 + 0.1451e0*f - 0.00068e0*pow(f, 2)
                             + 0.0000014e0*pow(f, 3)) as endo,
             greatest(0.1e0, 0.858e0*b_humerus + 0.601e0*b_femur
               + 0.188e0*(g_armFlexed - sf_triceps/10) + 0.161e0*(g_calf - sf_medialCalf/10)
               - 0.131e0*stature + 4.5e0) as meso,
             greatest(0.1e0, case when ratio >= 40.75 then 0.732e0*ratio - 28.58e0
                    when ratio >= 38.25 then 0.463e0*ratio - 17.63e0 else 0.1e0 end) as ecto
           from t1),
    t3 as (select *, case when age < 20 then 1.162e0 - 0.063e0*log10(sum4)
                          when age < 30 then 1.1631e0 - 0.0632e0*log10(sum4)
                          when age < 40 then 1.1422e0 - 0.0544e0*log10(sum4)
                          when age < 50 then 1.162e0 - 0.07e0*log10(sum4)
                          when age is not null then 1.1715e0 - 0.0779e0*log10(sum4) end as xd
           from t2),
    t4 as (select *, {sql_round('xd', 4)} as body_density from t3),
    t5 as (select *, (4.95e0/body_density - 4.5e0)*100 as xf from t4),
    t6 as (select *, {sql_round('xf', 1)} as percent_bf from t5),
    t7 as (select *, bodyMass*(1 - percent_bf/100) as x_ffm, bodyMass*(percent_bf/100) as x_fm
           from t6)"""


def _one(c: str) -> str:
    return f"cast(cast({sql_round(c, 1)} as decimal(12,1)) as varchar)"


ASSESSMENTS = f"""
    p0 as (select *, p_retailprice/100 as age, p_retailprice/100 + (p_size - 25)/10e0 as fels
           from part),
    p1 as (select *, fels - age as x from p0),
    p2 as (select *, case when p_type = 'LARGE' then 1.25e0 else {sql_round('x', 2)} end as off
           from p1),
    a as (select p_brand as sams_id, p_name, p_partkey as mrn,
            date '2000-01-01' + cast(p_partkey as integer) as day, age as current_age, fels,
            cast(p_size as double) as gp, cast(p_size + 60 as double) as pct_aph,
            off as maturity_offset,
            case when p_type = 'SMALL' or off <= -1 then 'Late' when off >= 1 then 'Early'
                 else 'Normal' end as maturity_status,
            case when p_size + 60 < 85 then 'Pre PHV' when p_size + 60 < 90 then 'Approaching PHV'
                 when p_size + 60 < 96 then 'Circa PHV' else 'Post PHV' end as phv_status
          from p2)"""

SQL = {
    "body_composition": f"""
        with {SESSIONS}
        select player_id, session, {day_text('day')} as date, age, bodyMass as body_mass, stature,
               bmi, sum8, sum4, body_density, percent_bf, {sql_round('x_ffm', 1)} as ffm,
               {sql_round('x_fm', 1)} as fat_mass,
               {_one('endo')} || '-' || {_one('meso')} || '-' || {_one('ecto')} as somatotype
        from t7""",
    "growth_series": f"""
        with {SESSIONS}
        select player_id, {day_text('day')} as date, stature, bodyMass as body_mass, bmi from t7""",
    "anthro_summary": f"""
        with {SESSIONS},
        g as (select player_id, max(c_name) as name, count(*) as n_sessions, max(day) as day,
                bool_or(o_orderstatus = 'F') as stage from base group by player_id)
        select c_custkey as player_id, true as matched, g.player_id is not null as has_data,
               name as athlete_name, n_sessions, {day_text('day')} as latest_date,
               coalesce(stage, false) as has_maturation
        from customer left join g on c_custkey = g.player_id""",
    "trial_result": """
        select l_orderkey, case
            when m1 is not null and m2 is not null and m3 is not null
              then list_sort([m1, m2, m3])[2]
            when m1 is not null and m2 is not null then (m1 + m2)/2 else m1 end as result
        from (select l_orderkey, max(case when l_linenumber = 1 then l_quantity end) as m1,
                     max(case when l_linenumber = 2 then l_quantity end) as m2,
                     max(case when l_linenumber = 3 then l_quantity end) as m3
              from lineitem group by l_orderkey)""",
    "maturity_history": f"""
        with {ASSESSMENTS}
        select sams_id, mrn, {day_text('day')} as date, current_age, fels, gp, pct_aph,
               maturity_offset, maturity_status, phv_status from a""",
    "maturity_summary": f"""
        with {ASSESSMENTS}
        select sams_id, arg_max(p_name, day) as athlete_name, count(*) as n_assessments,
               {day_text('max(day)')} as date, arg_max(fels, day) as fels,
               arg_max(maturity_status, day) as maturity_status,
               arg_max(phv_status, day) as phv_status
        from a group by sams_id""",
}
