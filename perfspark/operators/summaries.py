"""One row per athlete: jump, recovery and load summaries.

Each takes athletes already resolved to their identifiers (``roster.resolve_ids``), aggregates its
source tables once, and joins the results. Athletes without an id or without data stay, with
``matched`` and ``has_data`` telling which.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.ids import safe_id
from ..functions.numbers import blank_to_null, day_of, exact_mean, num_of, present, round_py, to_int
from .series import (JUMP_HEIGHT, PEAK_POWER, REBOUND_TEST, last_values, load_block, session_best)
from ..functions.events import REBOUND_FIELDS
from ..plans.shapes import top_rows


def _name(device_name: str, resolved: DataFrame) -> Column:
    found = [present(c) for c in (device_name, "sams_name") if c in resolved.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def jump_summary(resolved: DataFrame, results: DataFrame, rebounds: DataFrame, *,
                 n_recent: int = 10) -> DataFrame:
    """Newest jump height, relative peak power and reactive ratio, recent series and counts."""
    jumps = results.where((F.col("test_type") == "CMJ") & (F.col("limb") == "Trial")
                          & F.col("metric_name").isin(JUMP_HEIGHT, PEAK_POWER))
    name = F.when(F.col("metric_name") == JUMP_HEIGHT, "jh").otherwise("pp")
    ratio = rebounds.where((F.col("test_name") == REBOUND_TEST)
                           & (F.col("field") == REBOUND_FIELDS["tf_tc"][0]))
    rows = (jumps.select("vald_id", name.alias("series"), day_of(results, "recorded_date")
                         .alias("day"), num_of(results, "value").alias("value"))
            .unionByName(ratio.select("vald_id", F.lit("rt").alias("series"),
                                      day_of(rebounds, "test_date").alias("day"),
                                      num_of(rebounds, "value").alias("value"))))
    rows = rows.withColumn("vald_id", F.upper("vald_id"))
    # At most one row per athlete, series and day is left; placing an athlete's days together
    # lets the ranking and the final aggregate run without another exchange.
    days = session_best(rows, keys=["vald_id", "series"]).repartition("vald_id")
    newest = W.partitionBy("vald_id", "series").orderBy(F.desc("session_date"))
    ranked = days.withColumn("recency", F.row_number().over(newest))

    def at(series: str, column: str) -> Column:
        here = (F.col("series") == series) & (F.col("recency") == 1)
        return F.max(F.when(here, F.col(column)))

    def recent(series: str) -> Column:
        here = (F.col("series") == series) & (F.col("recency") <= n_recent)
        return F.array_sort(F.collect_list(F.when(here, F.struct("session_date", "value"))))

    def count(series: str) -> Column:
        return F.count(F.when(F.col("series") == series, 1))

    per_id = ranked.groupBy("vald_id").agg(
        F.struct(at("jh", "value").alias("cmj_jump_height_cm"),
                 at("jh", "session_date").alias("cmj_jump_height_date"),
                 at("pp", "value").alias("cmj_peak_power_bm"),
                 at("rt", "value").alias("rjt_tf_tc"),
                 at("rt", "session_date").alias("rjt_date")).alias("today"),
        recent("jh").alias("cmj_series"), recent("rt").alias("rjt_series"),
        count("jh").alias("n_cmj_sessions"), count("rt").alias("n_rjt_sessions"))
    return _attach(resolved, per_id, safe_id(blank_to_null("vald_id")), "vald_id", "vald_name")


def _attach(resolved: DataFrame, data: DataFrame, device: Column, id_name: str,
            name_column: str) -> DataFrame:
    """Summaries joined to athletes by device id."""
    people = resolved.withColumns({"_id": device, "athlete_name": _name(name_column, resolved)})
    people = people.drop(id_name, name_column, "has_data")
    rows = data.withColumnRenamed(id_name, "_key")
    joined = people.join(rows, people["_id"] == rows["_key"], "left")
    flags = {"matched": F.col("_id").isNotNull(), "has_data": F.col("_key").isNotNull(),
             id_name: F.col("_id")}
    values = [c for c in data.columns if c != id_name]
    keep = [c for c in ("player_id", "mrn") if c in people.columns]
    return joined.withColumns(flags).select(*keep, "matched", "has_data", "athlete_name", id_name,
                                            *values)


def _recent(df: DataFrame, order: str, columns: dict[str, Column], limit: int) -> DataFrame:
    rows = df.where(F.col("whoop_user_id").isNotNull()).select(
        F.col("whoop_user_id").cast("long").alias("whoop_user_id"),
        F.col(order).cast("string").alias("_at"), *[c.alias(n) for n, c in columns.items()])
    # Ties within one day are settled by the values themselves.
    ties = [F.desc_nulls_last(n) for n in columns]
    return top_rows(rows, ["whoop_user_id"], [F.desc("_at"), *ties], limit, rank="recency")


def _average(value: str, span: int | None) -> Column:
    c = F.col(value) if span is None else F.when(F.col("recency") <= span, F.col(value))
    return round_py(exact_mean(c), 1).alias(value)


def _first(value: str) -> Column:
    return F.max(F.when(F.col("recency") == 1, F.col(value)))


def recovery_summary(resolved: DataFrame, recovery: DataFrame, strain: DataFrame,
                     sleep: DataFrame, *, limit_days: int = 30) -> DataFrame:
    """Newest recovery, strain and sleep values, 7- and 30-row means and 14-value series.

    Only the newest ``limit_days`` rows per athlete of each table count; the cut happens before
    the shuffle."""
    rec = _recent(recovery, "recorded_date", {
        "recovery": num_of(recovery, "recovery_score"), "hrv": num_of(recovery, "hrv_rmssd_milli"),
        "rhr": num_of(recovery, "resting_heart_rate")}, limit_days)
    load = _recent(strain, "recorded_date", {
        "strain": num_of(strain, "strain"), "calories": num_of(strain, "calories")}, limit_days)
    nights = _recent(sleep, "start_time", {
        "sleep_mins": num_of(sleep, "total_sleep_mins"),
        "sleep_perf": num_of(sleep, "sleep_performance"),
        "deep": num_of(sleep, "deep_sleep_mins"), "rem": num_of(sleep, "rem_sleep_mins"),
        "light": num_of(sleep, "light_sleep_mins"), "awake": num_of(sleep, "awake_mins")},
        limit_days)
    key = "whoop_user_id"
    a = rec.groupBy(key).agg(
        F.struct(_first("_at").alias("date"), _first("recovery").alias("recovery"),
                 _first("hrv").alias("hrv"), _first("rhr").alias("rhr")).alias("_rec"),
        last_values("recovery", 14).alias("recovery_series"),
        _average("recovery", 7).alias("_rec7"), _average("recovery", None).alias("_rec30"),
        F.count(F.lit(1)).alias("n_days"))
    b = load.groupBy(key).agg(
        F.struct(_first("strain").alias("strain"), _first("calories").alias("calories"))
        .alias("_load"),
        last_values("strain", 14).alias("strain_series"),
        _average("strain", 7).alias("_load7"), _average("strain", None).alias("_load30"))
    c = nights.groupBy(key).agg(
        F.struct(_first("sleep_mins").alias("sleep_mins"),
                 _first("sleep_perf").alias("sleep_perf")).alias("_sleep"),
        F.struct(*[_first(s).alias(s) for s in ("deep", "rem", "light", "awake")])
        .alias("sleep_stages"),
        last_values("sleep_mins", 14).alias("sleep_series"),
        _average("sleep_mins", 7).alias("_mins7"), _average("sleep_mins", None).alias("_mins30"),
        _average("sleep_perf", 7).alias("_perf7"))
    data = a.join(b, key, "full").join(c, key, "full").select(
        key,
        F.struct("_rec.date", "_rec.recovery", "_rec.hrv", "_rec.rhr", "_load.strain",
                 "_load.calories", "_sleep.sleep_mins", "_sleep.sleep_perf").alias("today"),
        "sleep_stages", "recovery_series", "strain_series", "sleep_series",
        F.struct(F.col("_rec7").alias("recovery"), F.col("_load7").alias("strain"),
                 F.col("_mins7").alias("sleep_mins"), F.col("_perf7").alias("sleep_perf"))
        .alias("avg7"),
        F.struct(F.col("_rec30").alias("recovery"), F.col("_load30").alias("strain"),
                 F.col("_mins30").alias("sleep_mins")).alias("avg30"),
        F.coalesce("n_days", F.lit(0)).alias("n_days"))
    device = to_int(blank_to_null("whoop_id")).cast("long")
    return _attach(resolved.withColumn("whoop_user_id", device).drop("whoop_id"), data,
                   F.col("whoop_user_id"), "whoop_user_id", "whoop_name")


def load_summary(resolved: DataFrame, sessions: DataFrame, as_of: Column, *,
                 days: int = 28) -> DataFrame:
    """Training-load blocks, latest ratio and 14-day series per athlete up to ``as_of``."""
    keyed = sessions.withColumn("firstbeat_id", F.col("athlete_id").cast("string"))
    data = load_block(keyed, as_of, keys=["firstbeat_id"], days=days)
    return _attach(resolved, data, blank_to_null("firstbeat_id"), "firstbeat_id",
                   "firstbeat_name")
