"""Time-series operators over long metric tables and load sessions.

Every operator first reduces raw rows to one row per key and day with a partially aggregated
``groupBy``; windows run over these days only, so a key never brings more rows to a task than it
has calendar days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import events
from ..functions.numbers import day_of, exact_mean, exact_sum, num_of, round_py
from ..functions.text import clock_slot
from ..functions.zones import acwr_zone
from ..plans.shapes import top_rows

JUMP_HEIGHT = "Jump Height (Imp-Mom)"
PEAK_POWER = "Peak Power / BM"
REBOUND_TEST = "10/5 Rebound Jump Test"


def readable(df: DataFrame, day: str, value: str) -> DataFrame:
    """Rows whose value and day both parse, as ``_day`` and ``_value``."""
    parsed = df.withColumns({"_day": day_of(df, day), "_value": num_of(df, value)})
    return parsed.where(F.col("_day").isNotNull() & F.col("_value").isNotNull())


def session_best(df: DataFrame, *, keys: list[str], day: str = "day", value: str = "value",
                 best: str | Column = "max") -> DataFrame:
    """Best value and number of trials per key and day.

    ``best`` is ``max``, ``min``, or a boolean column that is true where the lowest value is best
    (it must be constant within a key)."""
    rows = readable(df, day, value)
    n = F.count(F.lit(1)).alias("n")
    if isinstance(best, str):
        pick = F.min("_value") if best == "min" else F.max("_value")
    else:
        pick = F.when(F.bool_or(best), F.min("_value")).otherwise(F.max("_value"))
    return (rows.groupBy(*keys, F.col("_day").alias("session_date"))
            .agg(pick.alias("value"), n))


def metric_history(results: DataFrame, test_type: str, metric: str, *, limb: str = "Trial",
                   athletes: list[str] | None = None) -> DataFrame:
    """Session best of one jump metric for all athletes, or for the ids given."""
    rows = results.where((F.col("test_type") == test_type) & (F.col("metric_name") == metric)
                         & (F.col("limb") == limb))
    if athletes is not None:
        rows = rows.where(F.col("vald_id").isin([a.upper() for a in athletes]))
    return session_best(rows, keys=["vald_id"], day="recorded_date")


def jump_history(results: DataFrame, metric: str = JUMP_HEIGHT) -> DataFrame:
    """Session best of one countermovement-jump metric."""
    return metric_history(results, "CMJ", metric)


def rebound_history(results: DataFrame, field: str = "tf_tc",
                    test_name: str = REBOUND_TEST) -> DataFrame:
    """Session best of one rebound-jump field (an alias or a stored field name)."""
    raw, best = events.REBOUND_FIELDS.get(field, (field, "max"))
    rows = results.where((F.col("test_name") == test_name) & (F.col("field") == raw))
    return session_best(rows, keys=["vald_id"], day="test_date", best=best)


def daily_mean(df: DataFrame, *, keys: list[str], day: str = "day",
               value: str = "value") -> DataFrame:
    """Mean value per key and day."""
    return (readable(df, day, value).groupBy(*keys, F.col("_day").alias("date"))
            .agg(exact_mean("_value").alias("dailymean")))


def acute_chronic(df: DataFrame, *, keys: list[str], day: str = "day", value: str = "value",
                  acute_days: int = 7, chronic_days: int = 28) -> DataFrame:
    """Daily mean, trailing acute and chronic means over calendar days, and their ratio.

    Both frames share one sort. The ratio is taken before rounding and is NULL when either mean
    is zero."""
    return rolling_load(daily_mean(df, keys=keys, day=day, value=value), keys=keys,
                        acute_days=acute_days, chronic_days=chronic_days)


def rolling_load(daily: DataFrame, *, keys: list[str], acute_days: int = 7,
                 chronic_days: int = 28, keep: list[str] | None = None) -> DataFrame:
    """``acute_chronic`` over rows that are a ``dailymean`` per key and ``date`` already; ``keep``
    passes further columns through."""
    order = W.partitionBy(*keys).orderBy(F.unix_date("date"))

    def trailing(days: int) -> Column:
        frame = order.rangeBetween(-(days - 1), 0)
        return exact_sum("dailymean", frame) / F.count("dailymean").over(frame)

    rolled = daily.withColumns({"acute": trailing(acute_days), "chronic": trailing(chronic_days)})
    both = (F.col("acute") != 0) & (F.col("chronic") != 0)
    return rolled.select(
        *keys, "date", *(keep or []), round_py("dailymean", 3).alias("dailymean"),
        round_py("acute", 3).alias("acute"), round_py("chronic", 3).alias("chronic"),
        round_py(F.when(both, F.col("acute") / F.col("chronic")), 3).alias("acwr"))


def asymmetry_history(df: DataFrame, *, keys: list[str], day: str = "day", value: str = "value",
                      leg: str = "trial_limb") -> DataFrame:
    """Best left and right value per session and their difference in percent of the mean.

    Sessions with one leg only are left out."""
    def side(name: str) -> Column:
        return F.max(F.when(F.col(leg) == name, F.col("_value")))

    sides = (readable(df.where(F.col(leg).isin("Left", "Right")), day, value)
             .groupBy(*keys, F.col("_day").alias("session_date"))
             .agg(side("Left").alias("left"), side("Right").alias("right"))
             .where(F.col("left").isNotNull() & F.col("right").isNotNull()))
    mean = (F.col("left") + F.col("right")) / 2
    pct = F.when(mean != 0, round_py((F.col("right") - F.col("left")) / mean * 100, 2))
    return sides.withColumn("asym_pct", pct)


def squad_metric(ids: DataFrame, results: DataFrame, *, athlete: str = "vald_id",
                 day: str = "recorded_date", value: str = "value") -> DataFrame:
    """Session best of an (already filtered) metric for a squad; ids are matched without regard
    to case and those without results keep one row of NULLs."""
    keyed = results.withColumn("_id", F.upper(F.col(athlete).cast("string")))
    asked = ids.select(F.col(athlete)).distinct().withColumn(
        "_id", F.upper(F.col(athlete).cast("string")))
    wanted = keyed.join(asked.select("_id").distinct(), "_id", "left_semi")
    best = session_best(wanted, keys=["_id"], day=day, value=value)
    return asked.join(best, "_id", "left").drop("_id")


def squad_load(df: DataFrame, *, keys: list[str], day: str = "day",
               value: str = "value") -> DataFrame:
    """Acute/chronic load of every athlete and day with its zone colour."""
    out = acute_chronic(df, keys=keys, day=day, value=value)
    return out.withColumn("zone", acwr_zone(F.col("acwr")))


def squad_heatmap(ids: DataFrame, results: DataFrame, *, athlete: str = "vald_id",
                  day: str = "recorded_date", value: str = "value") -> DataFrame:
    """Session best next to load ratio and zone for each athlete of a squad and each of their
    days; athletes without results keep one row.

    Best, count and mean come from one daily aggregate; the ratio is a window over these days."""
    keyed = results.withColumn("_id", F.upper(F.col(athlete).cast("string")))
    asked = ids.select(F.col(athlete)).distinct().withColumn(
        "_id", F.upper(F.col(athlete).cast("string")))
    wanted = keyed.join(asked.select("_id").distinct(), "_id", "left_semi")
    daily = (readable(wanted, day, value).groupBy("_id", F.col("_day").alias("date"))
             .agg(F.max("_value").alias("value"), F.count(F.lit(1)).alias("n"),
                  exact_mean("_value").alias("dailymean")))
    load = rolling_load(daily, keys=["_id"], keep=["value", "n"])
    load = load.withColumn("zone", acwr_zone(F.col("acwr"))).select(
        "_id", F.col("date").alias("session_date"), "value", "n", "acwr", "zone")
    return asked.join(load, "_id", "left").drop("_id")


def latest_non_null(df: DataFrame, *, keys: list[str], order: list[Column],
                    values: list[str]) -> DataFrame:
    """Per key the newest non-null value of each column."""
    newest = [F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.struct(*order))).alias(v)
              for v in values]
    return df.groupBy(*keys).agg(*newest)


def recent_rows(df: DataFrame, *, keys: list[str], order: list[Column], values: list[str],
                rows: int = 30) -> DataFrame:
    """The newest ``rows`` rows per key, ranked 1 for the newest."""
    ranked = top_rows(df, keys, order, rows, rank="recency")
    return ranked.select(*keys, *values, "recency")


def recent_rows_avg(df: DataFrame, *, keys: list[str], order: list[Column], values: list[str],
                    spans: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Null-skipping means over the newest 7 and 30 *rows* (not days), one decimal, as
    ``<value>_avg<span>``."""
    ranked = recent_rows(df, keys=keys, order=order, values=values, rows=max(spans))
    means = [round_py(exact_mean(F.when(F.col("recency") <= s, F.col(v))), 1).alias(f"{v}_avg{s}")
             for v in values for s in spans]
    return ranked.groupBy(*keys).agg(*means, F.count(F.lit(1)).alias("n_rows"))


def last_values(value: str, n: int, recency: str = "recency") -> Column:
    """Aggregate: the newest ``n`` non-null values of a ranked group, oldest first."""
    pairs = F.collect_list(F.when(F.col(value).isNotNull(),
                                  F.struct((-F.col(recency)).alias("at"),
                                           F.col(value).alias("v"))))
    ordered = F.array_sort(pairs)
    size = F.size(ordered)
    tail = F.slice(ordered, F.greatest(size - (n - 1), F.lit(1)), F.lit(n))
    return F.transform(tail, lambda p: p["v"])


def load_block(sessions: DataFrame, as_of: Column, *, keys: list[str], days: int = 28,
               day: str = "date") -> DataFrame:
    """Training load up to ``as_of`` per athlete in one pass over the sessions.

    Totals over the last 7 and over all ``days`` (both ends of the window count, as in "from the
    date seven days ago"), the newest non-null ratio, and a dense 14-day daily load series."""
    d = day_of(sessions, day)
    rows = (sessions.where(d.between(F.date_sub(as_of, days), as_of))
            .select(*keys, d.alias("_day"),
                    num_of(sessions, "durationMinutes", 0).alias("_minutes"),
                    num_of(sessions, "trimp", 0).alias("_load"),
                    num_of(sessions, "calories", 0).alias("_kcal"),
                    num_of(sessions, "aerobicTE").alias("_effect"),
                    num_of(sessions, "acwr").alias("_acwr"),
                    F.col("startTime").cast("string").alias("_start")))

    spans = {"last7": 7, "last28": days}
    columns = ("minutes", "kcal", "load")
    raw = []
    for name, since in spans.items():
        inside = F.col("_day") >= F.date_sub(as_of, since)
        raw.append(F.count(F.when(inside, 1)).alias(f"{name}_n"))
        raw += [exact_sum(F.when(inside, F.col(f"_{c}"))).alias(f"{name}_{c}") for c in columns]
        raw.append(exact_mean(F.when(inside, F.col("_effect"))).alias(f"{name}_effect"))
    raw += [exact_sum(F.when(F.col("_day") == F.date_sub(as_of, b), F.col("_load"))).alias(f"_s{b}")
            for b in range(14)]
    newest = F.when(F.col("_acwr").isNotNull(), F.struct("_day", "_start", "_acwr"))
    sums = rows.groupBy(*keys).agg(*raw, F.max_by("_acwr", newest).alias("acwr"),
                                   F.max("_day").alias("latest_date"))

    def whole(c: str) -> Column:
        return round_py(F.coalesce(F.col(c), F.lit(0.0)), 0).cast("long")

    blocks = [F.struct(F.col(f"{name}_n").alias("n"),
                       *[whole(f"{name}_{c}").alias(c) for c in columns],
                       round_py(f"{name}_effect", 1).alias("intensity")).alias(name)
              for name in spans]
    series = F.array(*[whole(f"_s{b}") for b in range(13, -1, -1)]).alias("load_series")
    return sums.select(*keys, *blocks, "acwr", series, "latest_date")


def daily_load(df: DataFrame, *, keys: list[str], day: str = "day",
               value: str = "value") -> DataFrame:
    """Total per key and day."""
    return (readable(df, day, value).groupBy(*keys, F.col("_day").alias("date"))
            .agg(exact_sum("_value").alias("load")))


def dense_days(df: DataFrame, as_of: Column, *, keys: list[str], value: str = "load",
               days: int = 14, window: int = 28, day: str = "date") -> DataFrame:
    """One row per key and calendar day of the last ``days`` days, gaps filled with 0, for every
    key with a row in the load window of the last ``window`` days.

    Input is one row per key and day. Sums are placed on the calendar within the aggregate, so
    that no calendar join is needed."""
    inside = df.where(F.col(day).between(F.date_sub(as_of, window), as_of))
    slots = [F.coalesce(F.max(F.when(F.col(day) == F.date_sub(as_of, b), F.col(value))),
                        F.lit(0.0)) for b in range(days - 1, -1, -1)]
    dense = inside.groupBy(*keys).agg(F.array(*slots).alias("_slots"))
    return (dense.select(*keys, F.posexplode("_slots").alias("_pos", value))
            .withColumn(day, F.date_add(F.date_sub(as_of, days - 1), F.col("_pos")))
            .select(*keys, day, value))


def energy_by_slot(sessions: DataFrame, *, keys: list[str], start: Column | None = None,
                   end: Column | None = None, day: str = "date", value: str = "calories",
                   clock: str = "startTime") -> DataFrame:
    """Energy per key, day and AM/PM slot. Sessions without a day or with no energy are skipped."""
    d, kcal = day_of(sessions, day), num_of(sessions, value)
    rows = sessions.where(d.isNotNull() & kcal.isNotNull() & (kcal != 0))
    if start is not None:
        rows = rows.where(d >= start)
    if end is not None:
        rows = rows.where(d <= end)
    return (rows.groupBy(*keys, d.alias("date"), clock_slot(clock).alias("slot"))
            .agg(exact_sum(kcal).alias("kcal")))


def energy_calendar(slots: DataFrame, *, keys: list[str]) -> DataFrame:
    """AM and PM energy side by side."""
    return slots.groupBy(*keys, "date").pivot("slot", ["AM", "PM"]).agg(F.sum("kcal"))


def session_counts(df: DataFrame, *, keys: list[str], athlete: str) -> DataFrame:
    """Sessions and distinct athletes per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_sessions"),
                                 F.count_distinct(athlete).alias("n_athletes"))
