"""Time-series queries. Athletes are event users, metrics are event types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import events as ev
from ..functions.numbers import iso
from ..functions.zones import recovery_zone
from ..operators import roster, series, summaries
from .common import day_text, sql_mean, sql_round, sql_sum, table

def as_of():
    return F.lit("2024-01-30").cast("date")


KEYS = ["user_id", "event_type"]


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def _iso(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: iso(n) for n in names})


def session_best(spark, d):
    return _iso(series.session_best(events(spark, d), keys=KEYS, day="ts"), "session_date")


# Event types stand for the aliases of rebound-jump fields.
ALIASES = {"click": "tf_tc", "view": "contact", "purchase": "flight", "signup": "height",
           "error": "rsi"}


def rebound_best(spark, d):
    names = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    rows = events(spark, d).withColumn("alias", F.try_element_at(names, F.col("event_type")))
    rows = rows.withColumns({"field": ev.rebound_field(F.col("alias")),
                             "_low": ev.rebound_takes_min(F.col("alias"))})
    best = series.session_best(rows, keys=["user_id", "field"], day="ts", best=F.col("_low"))
    return _iso(best, "session_date")


def acute_chronic(spark, d):
    return _iso(series.acute_chronic(events(spark, d), keys=KEYS, day="ts"), "date")


def squad_load(spark, d):
    return _iso(series.squad_load(events(spark, d), keys=["user_id"], day="ts"), "date")


def asymmetry(spark, d):
    rows = events(spark, d).withColumn("leg", F.when(F.hour("ts") < 12, "Left").otherwise("Right"))
    return _iso(series.asymmetry_history(rows, keys=KEYS, day="ts", leg="leg"), "session_date")


def squad_metric(spark, d):
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    rows = events(spark, d).where(F.col("event_type") == "click")
    return _iso(series.squad_metric(ids, rows, athlete="user_id", day="ts"), "session_date")


def squad_heatmap(spark, d):
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    out = series.squad_heatmap(ids, events(spark, d), athlete="user_id", day="ts")
    return _iso(out, "session_date")


def _sessions(spark, d) -> DataFrame:
    """Load sessions out of events."""
    effect = F.when(F.col("value") >= 20, F.col("value") / 100)
    return events(spark, d).select(
        F.col("user_id").alias("athlete_id"), F.to_date("ts").alias("date"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("startTime"),
        F.col("value").alias("durationMinutes"), (F.col("value") * 0.5).alias("trimp"),
        F.get_json_object("props", "$.k").alias("calories"), effect.alias("aerobicTE"),
        effect.alias("acwr"))


def _flat_load(df: DataFrame, *keys: str) -> DataFrame:
    blocks = [F.col(f"{b}.{f}").alias(f"{b}_{f}") for b in ("last7", "last28")
              for f in ("n", "minutes", "kcal", "load", "intensity")]
    slots = [F.get("load_series", F.lit(i)).alias(f"day{i:02d}") for i in range(14)]
    return df.select(*keys, *blocks, "acwr", iso("latest_date").alias("latest_date"), *slots)


def load_block(spark, d):
    return _flat_load(series.load_block(_sessions(spark, d), as_of(), keys=["athlete_id"]),
                      "athlete_id")


def dense_series(spark, d):
    daily = series.daily_load(events(spark, d), keys=["user_id"], day="ts")
    return _iso(series.dense_days(daily, as_of(), keys=["user_id"]), "date")


def daily_load(spark, d):
    return _iso(series.daily_load(events(spark, d), keys=KEYS, day="ts"), "date")


def energy_by_slot(spark, d):
    out = series.energy_by_slot(_sessions(spark, d), keys=["athlete_id"],
                                start=F.date_sub(as_of(), 21), end=as_of())
    return _iso(out, "date")


def energy_calendar(spark, d):
    slots = series.energy_by_slot(_sessions(spark, d), keys=["athlete_id"])
    return _iso(series.energy_calendar(slots, keys=["athlete_id"]), "date")


def _readings(spark, d) -> DataFrame:
    """Values with gaps: readings below 20 are missing."""
    return events(spark, d).withColumn("reading",
                                       F.when(F.col("value") >= 20, F.col("value")))


def newest() -> list:
    return [F.desc("ts"), F.desc("event_id")]


def recent_rows_avg(spark, d):
    return series.recent_rows_avg(_readings(spark, d), keys=["user_id"], order=newest(),
                                  values=["reading"])


def latest_non_null(spark, d):
    out = series.latest_non_null(_readings(spark, d), keys=KEYS,
                                 order=[F.col("ts"), F.col("event_id")], values=["reading"])
    return out.withColumn("zone", recovery_zone(F.col("reading")))


def last_n_series(spark, d):
    rows = series.recent_rows(_readings(spark, d), keys=["user_id"], order=newest(),
                              values=["reading"])
    out = rows.groupBy("user_id").agg(series.last_values("reading", 14).alias("s"))
    return out.select("user_id", F.posexplode("s").alias("pos", "reading"))


def session_counts(spark, d):
    return series.session_counts(events(spark, d), keys=["event_type"], athlete="user_id")


# --- summaries: every customer is asked for, event users are the ones with data ---------------

def _resolved(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    hex_id = F.lpad(F.col("c_custkey").cast("string"), 12, "0")
    known = F.when(F.col("c_mktsegment") != "BUILDING", hex_id)
    identifiers = c.select(
        F.col("c_custkey").cast("int").alias("sams_player_id"), F.lit("").alias("sams_mrn"),
        F.col("c_name").alias("sams_name"), known.alias("vald_id"),
        F.col("c_custkey").cast("string").alias("whoop_id"),
        F.col("c_custkey").cast("string").alias("firstbeat_id"))
    asked = c.select(F.col("c_custkey").alias("player_id"), F.lit(None).cast("string").alias("mrn"))
    return roster.resolve_ids(asked, identifiers).drop("resolved_by")


def jump_summary(spark, d):
    e = events(spark, d).withColumn("vald_id", F.lpad(F.col("user_id").cast("string"), 12, "0"))
    metric = F.when(F.col("event_type") == "click", series.JUMP_HEIGHT).when(
        F.col("event_type") == "view", series.PEAK_POWER)
    results = e.select("vald_id", F.lit("CMJ").alias("test_type"), metric.alias("metric_name"),
                       F.lit("Trial").alias("limb"), F.col("ts").alias("recorded_date"), "value")
    field = F.when(F.col("event_type") == "purchase", ev.REBOUND_FIELDS["tf_tc"][0])
    rebounds = e.select("vald_id", F.lit(series.REBOUND_TEST).alias("test_name"),
                        field.alias("field"), F.col("ts").alias("test_date"), "value")
    s = summaries.jump_summary(_resolved(spark, d), results, rebounds)
    t = F.col("today")
    return s.select(
        "player_id", "matched", "has_data", "athlete_name", "vald_id",
        t["cmj_jump_height_cm"].alias("height"), iso(t["cmj_jump_height_date"]).alias("height_date"),
        t["cmj_peak_power_bm"].alias("power"), t["rjt_tf_tc"].alias("ratio"),
        iso(t["rjt_date"]).alias("ratio_date"), F.size("cmj_series").alias("n_series"),
        F.get("cmj_series", F.lit(0))["value"].alias("first_value"),
        "n_cmj_sessions", "n_rjt_sessions")


def recovery_summary(spark, d):
    e = events(spark, d).withColumn("whoop_user_id", F.col("user_id"))
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")

    def of(kind: str, when: str, **columns) -> DataFrame:
        return e.where(F.col("event_type") == kind).select(
            "whoop_user_id", at.alias(when), *[c.alias(n) for n, c in columns.items()])

    v = F.col("value")
    gap = F.when(v >= 20, v)
    recovery = of("click", "recorded_date", recovery_score=gap, hrv_rmssd_milli=v * 2,
                  resting_heart_rate=v)
    strain = of("view", "recorded_date", strain=gap, calories=v * 4)
    sleep = of("signup", "start_time", total_sleep_mins=gap, sleep_performance=v,
               deep_sleep_mins=v * 0.5, rem_sleep_mins=v * 0.25, light_sleep_mins=v, awake_mins=v)
    s = summaries.recovery_summary(_resolved(spark, d), recovery, strain, sleep)
    return s.select(
        "player_id", "matched", "has_data", "athlete_name", "whoop_user_id",
        F.col("today.recovery").alias("recovery"), F.col("today.hrv").alias("hrv"),
        F.col("today.strain").alias("strain"), F.col("today.sleep_mins").alias("sleep_mins"),
        F.col("sleep_stages.deep").alias("deep"), F.col("avg7.recovery").alias("recovery7"),
        F.col("avg7.sleep_perf").alias("sleep_perf7"), F.col("avg30.strain").alias("strain30"),
        F.size("recovery_series").alias("n_series"),
        F.get("recovery_series", F.size("recovery_series") - 1).alias("last_recovery"), "n_days")


def load_summary(spark, d):
    s = summaries.load_summary(_resolved(spark, d), _sessions(spark, d), as_of())
    return _flat_load(s, "player_id", "matched", "has_data", "athlete_name", "firstbeat_id")


QUERIES = {f.__name__: f for f in (
    session_best, rebound_best, acute_chronic, squad_load, asymmetry, squad_metric, squad_heatmap,
    load_block,
    dense_series, daily_load, energy_by_slot, energy_calendar, recent_rows_avg, latest_non_null,
    last_n_series, session_counts, jump_summary, recovery_summary, load_summary)}


# --- SQL twins -------------------------------------------------------------------------------

def _rolled(keys: str) -> str:
    def frame(days: int) -> str:
        return (f"over (partition by {keys} order by date "
                f"range between interval {days - 1} day preceding and current row)")

    def mean(days: int) -> str:
        return f"{sql_sum('dailymean', frame(days))}/count(dailymean) {frame(days)}"

    return f"""
        select {keys}, date, dailymean, {mean(7)} as acute, {mean(28)} as chronic
        from (select {keys}, cast(ts as date) as date, {sql_mean('value')} as dailymean
              from events where value is not null group by {keys}, cast(ts as date))"""


def _acwr(keys: str) -> str:
    return f"""
      select {keys}, {day_text('date')} as date, {sql_round('dailymean', 3)} as dailymean,
             {sql_round('acute', 3)} as acute, {sql_round('chronic', 3)} as chronic,
             {sql_round('ratio', 3)} as acwr
      from (select *, case when acute <> 0 and chronic <> 0 then acute/chronic end as ratio
            from ({_rolled(keys)}))"""


SESSIONS = """
    select user_id as athlete_id, cast(ts as date) as date, ts as start, value as minutes,
           value*0.5e0 as load, cast(json_extract_string(props, '$.k') as double) as kcal,
           case when value >= 20 then value/100e0 end as effect
    from events"""


def _load_sql() -> str:
    inside = "date between date '2024-01-30' - 28 and date '2024-01-30'"

    def block(name: str, since: int) -> str:
        cond = f"date >= date '2024-01-30' - {since}"

        def when(c: str) -> str:
            return f"case when {cond} then {c} end"

        def tot(c: str) -> str:
            return f"coalesce({sql_sum(when(c))}, 0e0) as t_{name}_{c}"

        return (f"count({when('1')}) as {name}_n, {tot('minutes')}, {tot('kcal')}, {tot('load')}, "
                f"{sql_mean(when('effect'))} as t_{name}_effect")

    slots = ", ".join(
        f"coalesce({sql_sum(f'''case when date = date '2024-01-30' - {b} then load end''')}, 0e0)"
        f" as s{13 - b:02d}" for b in range(13, -1, -1))
    inner = f"""
        select athlete_id, {block('last7', 7)}, {block('last28', 28)}, {slots},
               arg_max(effect, start) filter (where effect is not null) as acwr,
               max(date) as latest
        from ({SESSIONS}) where {inside} group by athlete_id"""
    outs = []
    for name in ("last7", "last28"):
        outs.append(f"{name}_n")
        outs += [f"cast({sql_round(f't_{name}_{c}', 0)} as bigint) as {name}_{c}"
                 for c in ("minutes", "kcal", "load")]
        outs.append(f"{sql_round(f't_{name}_effect', 1)} as {name}_intensity")
    outs += [f"cast({sql_round(f's{i:02d}', 0)} as bigint) as day{i:02d}" for i in range(14)]
    return (f"select athlete_id, {', '.join(outs)}, acwr, {day_text('latest')} as latest_date "
            f"from ({inner})")


SLOT = "case when hour(start) >= 12 then 'PM' else 'AM' end"

READINGS = """
    select *, case when value >= 20 then value end as reading,
           row_number() over (partition by user_id order by ts desc, event_id desc) as recency
    from events"""

PEOPLE = """
    select c_custkey as player_id, c_name as athlete_name,
           case when c_mktsegment <> 'BUILDING' then lpad(cast(c_custkey as varchar), 12, '0') end
             as vald_id
    from customer"""


def _ranked(kind: str) -> str:
    return f"""(select *, case when value >= 20 then value end as gap,
              row_number() over (partition by user_id order by ts desc) as rn
              from events where event_type = '{kind}') """


SQL = {
    "session_best": f"""
        select user_id, event_type, {day_text('cast(ts as date)')} as session_date,
               max(value) as value, count(*) as n
        from events where value is not null group by user_id, event_type, cast(ts as date)""",
    "rebound_best": f"""
        select user_id,
               case event_type when 'click' then 'flightTimeOverContractionTime'
                 when 'view' then 'contactTimeSeconds' when 'purchase' then 'flightTimeSeconds'
                 when 'signup' then 'heightMeters' else 'rsi' end as field,
               {day_text('cast(ts as date)')} as session_date,
               case when event_type = 'view' then min(value) else max(value) end as value,
               count(*) as n
        from events where value is not null group by user_id, event_type, cast(ts as date)""",
    "acute_chronic": _acwr("user_id, event_type"),
    "squad_load": f"""
        select *, case when acwr is null then '#94a3b8'
                       when acwr >= 0.8 and acwr <= 1.3 then '#16a34a'
                       when acwr > 1.5 or acwr < 0.5 then '#dc2626' else '#fbb800' end as zone
        from ({_acwr('user_id')})""",
    "asymmetry": f"""
        select user_id, event_type, {day_text('day')} as session_date, l as "left", r as "right",
               case when (l + r)/2 <> 0 then {sql_round('pct', 2)} end as asym_pct
        from (select *, (r - l)/((l + r)/2)*100 as pct from (
                select user_id, event_type, cast(ts as date) as day,
                       max(case when hour(ts) < 12 then value end) as l,
                       max(case when hour(ts) >= 12 then value end) as r
                from events group by user_id, event_type, cast(ts as date))
              where l is not null and r is not null)""",
    "squad_metric": f"""
        select c_custkey as user_id, {day_text('day')} as session_date, value, n
        from customer left join (
            select user_id, cast(ts as date) as day, max(value) as value, count(*) as n
            from events where event_type = 'click' and value is not null
            group by user_id, cast(ts as date)) on user_id = c_custkey""",
    "load_block": _load_sql(),
    "dense_series": f"""
        select u.user_id, {day_text('d')} as date, coalesce(load, 0e0) as load
        from (select distinct user_id from events
              where value is not null
                and cast(ts as date) between date '2024-01-30' - 28 and date '2024-01-30') as u
        cross join (select cast(unnest(generate_series(timestamp '2024-01-17',
                      timestamp '2024-01-30', interval 1 day)) as date) as d) as days
        left join (select user_id, cast(ts as date) as day, {sql_sum('value')} as load
                   from events group by user_id, cast(ts as date)) as s
          on s.user_id = u.user_id and s.day = days.d""",
    "daily_load": f"""
        select user_id, event_type, {day_text('cast(ts as date)')} as date,
               {sql_sum('value')} as load
        from events where value is not null group by user_id, event_type, cast(ts as date)""",
    "energy_by_slot": f"""
        select athlete_id, {day_text('date')} as date, {SLOT} as slot, {sql_sum('kcal')} as kcal
        from ({SESSIONS}) where kcal <> 0 and date between date '2024-01-30' - 21
          and date '2024-01-30' group by athlete_id, date, {SLOT}""",
    "energy_calendar": f"""
        select athlete_id, {day_text('date')} as date,
               {sql_sum(f"case when {SLOT} = 'AM' then kcal end")} as "AM",
               {sql_sum(f"case when {SLOT} = 'PM' then kcal end")} as "PM"
        from ({SESSIONS}) where kcal <> 0 group by athlete_id, date""",
    "recent_rows_avg": f"""
        select user_id, {sql_round('a7', 1)} as reading_avg7, {sql_round('a30', 1)} as reading_avg30,
               n_rows
        from (select user_id, {sql_mean('case when recency <= 7 then reading end')} as a7,
                     {sql_mean('reading')} as a30, count(*) as n_rows
              from ({READINGS}) where recency <= 30 group by user_id)""",
    "latest_non_null": f"""
        select *, case when reading is null then '#94a3b8' when reading >= 67 then '#16a34a'
                       when reading >= 34 then '#fbb800' else '#dc2626' end as zone
        from (select user_id, event_type,
                     arg_max(reading, (ts, event_id)) filter (where reading is not null) as reading
              from ({READINGS}) group by user_id, event_type)""",
    "last_n_series": f"""
        select user_id, cast(total - k as integer) as pos, reading
        from (select user_id, reading,
                     row_number() over (partition by user_id order by recency) as k,
                     least(14, count(*) over (partition by user_id)) as total
              from ({READINGS}) where recency <= 30 and reading is not null) where k <= 14""",
    "session_counts": """
        select event_type, count(*) as n_sessions, count(distinct user_id) as n_athletes
        from events group by event_type""",
    "jump_summary": f"""
        with best as (
            select user_id, event_type, cast(ts as date) as day, max(value) as value
            from events where event_type in ('click', 'view', 'purchase') group by all),
        ranked as (select *, row_number() over (partition by user_id, event_type
                                                order by day desc) as rn from best),
        per as (select lpad(cast(user_id as varchar), 12, '0') as vald_id,
            max(case when event_type = 'click' and rn = 1 then value end) as height,
            max(case when event_type = 'click' and rn = 1 then day end) as height_date,
            max(case when event_type = 'view' and rn = 1 then value end) as power,
            max(case when event_type = 'purchase' and rn = 1 then value end) as ratio,
            max(case when event_type = 'purchase' and rn = 1 then day end) as ratio_date,
            count(case when event_type = 'click' and rn <= 10 then 1 end) as n_series,
            arg_min(value, day) filter (where event_type = 'click' and rn <= 10) as first_value,
            count(case when event_type = 'click' then 1 end) as n_cmj_sessions,
            count(case when event_type = 'purchase' then 1 end) as n_rjt_sessions
            from ranked group by user_id)
        select player_id, p.vald_id is not null as matched, per.vald_id is not null as has_data,
               athlete_name, p.vald_id, height, {day_text('height_date')} as height_date, power,
               ratio, {day_text('ratio_date')} as ratio_date, n_series, first_value,
               n_cmj_sessions, n_rjt_sessions
        from ({PEOPLE}) as p left join per on p.vald_id = per.vald_id""",
    "recovery_summary": f"""
        with a as (select user_id, max(case when rn = 1 then gap end) as recovery,
                     max(case when rn = 1 then value*2 end) as hrv,
                     {sql_mean('case when rn <= 7 then gap end')} as r7,
                     least(14, count(gap)) as n_series,
                     arg_max(gap, ts) filter (where gap is not null) as last_recovery,
                     count(*) as n_days
                   from {_ranked('click')} where rn <= 30 group by user_id),
        b as (select user_id, max(case when rn = 1 then gap end) as strain,
                     {sql_mean('gap')} as s30
              from {_ranked('view')} where rn <= 30 group by user_id),
        c as (select user_id, max(case when rn = 1 then gap end) as sleep_mins,
                     max(case when rn = 1 then value*0.5e0 end) as deep,
                     {sql_mean('case when rn <= 7 then value end')} as p7
              from {_ranked('signup')} where rn <= 30 group by user_id),
        j as (select * from a full join b using (user_id) full join c using (user_id))
        select c_custkey as player_id, c_custkey <> 0 as matched, user_id is not null as has_data,
               c_name as athlete_name, nullif(c_custkey, 0) as whoop_user_id, recovery, hrv, strain,
               sleep_mins, deep, {sql_round('r7', 1)} as recovery7,
               {sql_round('p7', 1)} as sleep_perf7, {sql_round('s30', 1)} as strain30,
               n_series, last_recovery,
               case when user_id is not null then coalesce(n_days, 0) end as n_days
        from customer left join j on nullif(c_custkey, 0) = user_id""",
    "load_summary": f"""
        select c_custkey as player_id, c_custkey <> 0 as matched,
               athlete_id is not null as has_data, c_name as athlete_name,
               cast(nullif(c_custkey, 0) as varchar) as firstbeat_id,
               l.* exclude (athlete_id)
        from customer left join ({_load_sql()}) as l on athlete_id = nullif(c_custkey, 0)""",
}

SQL["squad_heatmap"] = f"""
    select c_custkey as user_id, s.date as session_date, value, n, acwr, zone
    from customer left join ({SQL['squad_load']}) as s on s.user_id = c_custkey
    left join (select user_id, {day_text('cast(ts as date)')} as date, max(value) as value,
                      count(*) as n from events group by user_id, cast(ts as date)) as b
      on b.user_id = s.user_id and b.date = s.date"""
