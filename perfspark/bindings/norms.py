"""Competition queries. Results are orders: the customer is the athlete, the priority names the
event, the price is the mark. Norms and standards are aggregated from the same results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import events as ev
from ..functions.numbers import exact_mean, iso
from ..operators import norms
from ..session import cut
from .common import day_text, sql_mean, sql_round, table

EVENTS = {"1-URGENT": "100m", "2-HIGH": "800m", "3-MEDIUM": "Long Jump", "4-NOT SPECIFIED":
          "Shot Put", "5-LOW": "Discus Throw"}


def results(spark, d) -> DataFrame:
    """Orders with the birth date (from the account balance) and sex of their customer."""
    names = F.create_map(*[F.lit(x) for kv in EVENTS.items() for x in kv])
    back = F.floor(F.abs("c_acctbal")).cast("int")
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.date_sub(F.lit("1988-01-01").cast("date"), back).alias("dob"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "Female").otherwise("male")
        .alias("sex"))
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
        F.try_element_at(names, F.col("o_orderpriority")).alias("event"))
    return o.join(c, "o_custkey")


NAMES = dict(athlete="o_custkey", event="event", date="o_orderdate", value="o_totalprice",
             dob="dob")


def norm_rows(spark, d) -> DataFrame:
    """Norms by event, implement and age bin: worst, quarter points around the mean, best."""
    aged = norms.aged_results(results(spark, d), date="o_orderdate", value="o_totalprice",
                              dob="dob")
    centre = ev.age_band_centre(F.col("_age"))
    keyed = aged.select(ev.norm_variant(ev.norm_base(F.col("event")), centre).alias("event"),
                        ev.age_band_label(F.col("_age")).alias("age_bin"),
                        ev.lower_is_better(F.col("event")).alias("low"), "_mark")
    g = keyed.groupBy("event", "age_bin", "low").agg(
        F.min("_mark").alias("a"), exact_mean("_mark").alias("m"), F.max("_mark").alias("b"))
    worst, best = (F.when(F.col("low"), F.col(x)).otherwise(F.col(y))
                   for x, y in (("b", "a"), ("a", "b")))
    m = F.col("m")
    return g.select("event", "age_bin", worst.alias("p0"), ((worst + m) / 2).alias("p25"),
                    m.alias("p50"), ((m + best) / 2).alias("p75"), best.alias("p100"))


def norm_table(spark, d) -> DataFrame:
    """The norms as a reference table of their own (a few rows per event), so that the rules
    applied to its rows are not pushed down to the results it was made from."""
    return cut(norm_rows(spark, d))


def standards(spark, d) -> DataFrame:
    """Standards by event and sex; women have none in the 800m."""
    r = results(spark, d)
    sex = ev.sex_code(F.col("sex"))
    g = r.groupBy(F.col("event").alias("event_standard"), sex.alias("sex")).agg(
        F.max("o_totalprice").alias("top"))
    none = (F.col("event_standard") == "800m") & (F.col("sex") == "W")
    number = F.when(~none, F.col("top"))
    # Men's 100m is kept as a distance, so that standard and event name disagree.
    odd = (F.col("event_standard") == "100m") & (F.col("sex") == "M")
    low = ev.lower_is_better(F.col("event_standard")) & ~odd
    return g.select("event_standard", "sex", number.alias("standard_numeric"),
                    F.when(F.col("sex") == "M", F.col("event_standard")).alias("standard_raw"),
                    F.when(low, "time").otherwise("distance").alias("metric"),
                    low.alias("lower_is_better"))


def running_best(spark, d):
    out = norms.marks_from_results(results(spark, d), seq="o_orderkey", **NAMES)
    return out.withColumn("date", iso("date"))


def pb_by_ageband(spark, d):
    out = norms.best_by_age_band(results(spark, d), **NAMES)
    return out.withColumn("date", iso("date"))


def pb_percentile(spark, d):
    out = norms.best_by_age_band(results(spark, d), norms=norm_table(spark, d), **NAMES)
    return out.select("o_custkey", "event", "age_band", "mark", "percentile")


def percentile_of_mark(spark, d):
    """Every result at its age, against norms of whole-year bins."""
    r = results(spark, d).withColumn("age", F.round(
        F.datediff(F.to_date("o_orderdate"), F.col("dob")) / F.lit(365.25), 1))
    out = norms.percentile_of_mark(r, norm_table(spark, d), event="event", mark="o_totalprice",
                                   age="age")
    return out.select("o_orderkey", "event", "age", "percentile")


def norm_bands(spark, d):
    return norms.norm_bands(norm_table(spark, d), pct=(25, 50, 75))


def standard_lines(spark, d):
    return norms.standard_lines(standards(spark, d))


def benchmark_inputs(spark, d):
    made = norms.benchmark_inputs(results(spark, d), standards(spark, d), norm_rows(spark, d),
                                  seq="o_orderkey", sex="sex", **NAMES)
    return made.marks.withColumn("date", iso("date"))


def reference_lines(spark, d):
    """Lines of a benchmark with the best mark of each event as an extra line."""
    r = results(spark, d)
    best = r.groupBy("event").agg(F.max("o_totalprice").alias("y")).select(
        "event", F.lit("M").alias("sex"), "y", F.lit("Best").alias("label"))
    made = norms.benchmark_inputs(r, standards(spark, d), norm_rows(spark, d), sex="sex",
                                  extra_refs=best, **NAMES)
    return made.reference_lines


QUERIES = {f.__name__: f for f in (
    running_best, pb_by_ageband, pb_percentile, percentile_of_mark, norm_bands, standard_lines,
    benchmark_inputs, reference_lines)}


# --- SQL twins -------------------------------------------------------------------------------

EVENT = """case o_orderpriority when '1-URGENT' then '100m' when '2-HIGH' then '800m'
    when '3-MEDIUM' then 'Long Jump' when '4-NOT SPECIFIED' then 'Shot Put'
    when '5-LOW' then 'Discus Throw' end"""

VARIANT = """case event when 'Shot Put' then case when {a} < 14 then 'Shot Put (3kg)'
        when {a} < 16 then 'Shot Put (4kg)' when {a} < 18 then 'Shot Put (5kg)'
        when {a} < 20 then 'Shot Put (6kg)' else 'Shot Put' end
    when 'Discus Throw' then case when {a} < 12 then 'Discus Throw (0.750kg)'
        when {a} < 14 then 'Discus Throw (1.000kg)' when {a} < 16 then 'Discus Throw (1.250kg)'
        when {a} < 18 then 'Discus Throw (1.500kg)' when {a} < 20 then 'Discus Throw (1.750kg)'
        else 'Discus Throw' end else event end"""

LOW = "event in ('100m', '800m')"

RESULTS = f"""
    r0 as (select o_orderkey, o_custkey, cast(o_orderdate as date) as day, o_totalprice as mark,
             {EVENT} as event, date '1988-01-01' - cast(floor(abs(c_acctbal)) as integer) as dob,
             case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'W' else 'M' end as sex
           from orders join customer on o_custkey = c_custkey),
    r as (select * from (select *, (day - dob)/365.25e0 as age from r0)
          where age between 8 and 40)"""

NORMS = f"""
    n0 as (select {VARIANT.format(a='c')} as nevent, c, event, min(mark) as a,
             {sql_mean('mark')} as m, max(mark) as b
           from (select *, floor(age + 0.5e0) as c from r) group by all),
    n as (select nevent, c, event, case when {LOW} then b else a end as p0, m as p50,
             case when {LOW} then a else b end as p100 from n0),
    norms as (select nevent, event, c, p0, (p0 + p50)/2 as p25, p50, (p50 + p100)/2 as p75, p100
              from n)"""


def _percentile(rows: str, keys: str) -> str:
    """Percentile of ``rows(keys, event, pmark, page)``."""
    return f"""
    q as ({rows}),
    picked as (select {keys}, pmark, arg_min(pts, (case when nevent = {VARIANT.format(a='page')}
                                                   then 0 else 1 end, abs(c - page), c)) as pts
               from (select q.*, nevent, c, [
                       {{'k': p0, 'p': 0e0}}, {{'k': p25, 'p': 25e0}}, {{'k': p50, 'p': 50e0}},
                       {{'k': p75, 'p': 75e0}}, {{'k': p100, 'p': 100e0}}] as pts
                     from q join norms on norms.event = q.event)
               group by all),
    curve as (select {keys}, pmark, pt.k, min(pt.p) as p
              from (select {keys}, pmark, unnest(pts) as pt from picked) group by all),
    ends as (select {keys}, pmark, arg_min(p, k) as p_first, arg_max(p, k) as p_last,
               min(k) as k_first, max(k) as k_last,
               max(k) filter (where k < pmark) as x0, min(k) filter (where k >= pmark) as x1,
               arg_max(p, k) filter (where k < pmark) as y0,
               arg_min(p, k) filter (where k >= pmark) as y1
             from curve group by all),
    pct as (select {keys}, case when k_first = k_last or x0 is null then p_first
                                when x1 is null then p_last
                                else y0 + (y1 - y0)*(pmark - x0)/(x1 - x0) end as v from ends)"""


PB = f"""
    select o_custkey, event, floor(age + 0.5e0) as age_band,
           arg_min(struct_pack(mark := mark, day := day, age := age),
                   (case when {LOW} then mark else -mark end, day)) as b, count(*) as n
    from r group by all"""


def _label(c: str) -> str:
    return (f"concat(cast(cast({c} as integer) - 1 as varchar), '.5 - ', "
            f"cast(cast({c} as integer) as varchar), '.5')")


STANDARDS = """
    s0 as (select event, sex, max(mark) as top from r0 group by all),
    s as (select event, sex, case when not (event = '800m' and sex = 'W') then top end as num,
            case when sex = 'M' then event end as raw,
            event in ('100m', '800m') and not (event = '100m' and sex = 'M') as low from s0)"""

LINES = """select event, sex, num as y, case when raw is not null
             then 'World U20 standard (' || raw || ')' else 'World U20 standard' end as label,
             case when low then 'time' else 'distance' end as metric, low as lower_is_better
           from s where num is not null"""


def _pb_flag(low: str) -> str:
    return f"""
        case when {low} then
          mark < coalesce(min(mark) over w, 'infinity'::double)
        else mark > coalesce(max(mark) over w, '-infinity'::double) end"""


WINDOW = """window w as (partition by o_custkey, event order by day, o_orderkey
                         rows between unbounded preceding and 1 preceding)"""

SQL = {
    "running_best": f"""
        with {RESULTS}
        select o_custkey, event, o_orderkey, {day_text('day')} as date,
               {sql_round('age', 2)} as age, mark, {_pb_flag(LOW)} as pb
        from r {WINDOW}""",
    "pb_by_ageband": f"""
        with {RESULTS}
        select o_custkey, event, age_band, {_label('age_band')} as age_band_label,
               {sql_round('b.age', 2)} as age, b.mark as mark, {day_text('b.day')} as date, n
        from ({PB})""",
    "pb_percentile": f"""
        with {RESULTS}, {NORMS}, {_percentile(
            f"select o_custkey, event, age_band, b.mark as pmark, age_band as page from ({PB})",
            "o_custkey, event, age_band")}
        select o_custkey, event, age_band, b.mark as mark, {sql_round('v', 1)} as percentile
        from ({PB}) join pct using (o_custkey, event, age_band)""",
    "percentile_of_mark": f"""
        with {RESULTS}, {NORMS}, {_percentile(
            "select o_orderkey, event, round((day - dob)/365.25e0, 1) as page, mark as pmark "
            "from r0", "o_orderkey, event, page")}
        select o_orderkey, event, page as age, {sql_round('v', 1)} as percentile from pct""",
    "norm_bands": f"""
        with {RESULTS}, {NORMS}
        select event, c as age, p25, p50, p75, p100 from norms
        where nevent = {VARIANT.format(a='c')}""",
    "standard_lines": f"with {RESULTS}, {STANDARDS} {LINES}",
    "benchmark_inputs": f"""
        with {RESULTS}, {STANDARDS}, lines as ({LINES}),
        k as (select r.*, coalesce(lines.lower_is_better, {LOW.replace('event', 'r.event')}) as low,
                case when lines.event is not null
                     then case when metric = 'time' then 'time' end
                     when {LOW.replace('event', 'r.event')} then 'time' end as value_format
              from r left join lines on lines.event = r.event and lines.sex = r.sex)
        select o_custkey, event, o_orderkey, {day_text('day')} as date,
               {sql_round('age', 2)} as age, mark, {_pb_flag('low')} as pb,
               low as lower_is_better, value_format
        from k {WINDOW}""",
    "reference_lines": f"""
        with {RESULTS}, {STANDARDS}, lines as ({LINES})
        select event, sex, y, label from lines
        union all select event, 'M', max(mark), 'Best' from r0 group by event""",
}
