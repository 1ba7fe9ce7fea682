"""Competition marks against age, qualifying standards and percentile norms.

Norms and standards are reference tables (one row per event and age bin); they are reduced to one
row per event before they meet the results, so each result finds its age band inside one joined
row and no result is ever multiplied by the number of bands.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import events
from ..functions.numbers import day_of, decimal_age, finite, lookup, num_of, round_py
from ..plans.shapes import latest, running_min
from ..session import cut

AGE_RANGE = (8, 40)
BAND_PERCENTILES = (10, 25, 50, 75, 90)


def aged_results(results: DataFrame, *, date: str, value: str, dob: str,
                 age_range: tuple[float, float] = AGE_RANGE) -> DataFrame:
    """Results whose date, mark and birth date parse and whose age is in range, with ``_day``,
    ``_mark`` and unrounded ``_age``."""
    rows = results.withColumns({"_day": day_of(results, date), "_mark": num_of(results, value),
                                "_born": day_of(results, dob)})
    rows = rows.withColumn("_age", decimal_age(F.col("_born"), F.col("_day")))
    return rows.where(F.col("_mark").isNotNull() & F.col("_age").between(*age_range)).drop("_born")


def _direction(event: str, lower: str | bool | None) -> Column:
    if lower is None:
        return events.lower_is_better(F.col(event))
    return F.lit(lower) if isinstance(lower, bool) else F.col(lower)


def marks_from_results(results: DataFrame, *, athlete: str = "athlete_id",
                       event: str = "Event_standard", date: str = "Start_Date",
                       value: str = "Result_numerical", dob: str = "date_of_birth",
                       seq: str | None = None, lower: str | bool | None = None,
                       age_range: tuple[float, float] = AGE_RANGE,
                       chunk: str = "day") -> DataFrame:
    """Age, mark and personal-best flag of every result.

    A mark is a personal best when it is strictly better than all earlier ones of the athlete in
    the event. ``seq`` orders results of one day. ``chunk`` is the time unit by which one athlete's
    results are spread over tasks."""
    rows = aged_results(results, date=date, value=value, dob=dob, age_range=age_range)
    signed = F.when(_direction(event, lower), F.col("_mark")).otherwise(-F.col("_mark"))
    rows = rows.withColumn("_signed", signed)
    order = [F.col("_day")] + ([F.col(seq)] if seq else [F.col("_signed")])
    ran = running_min(rows, [athlete, event], order, F.col("_signed"),
                      F.trunc("_day", chunk) if chunk != "day" else F.col("_day"), out="_before")
    pb = F.col("_before").isNull() | (F.col("_signed") < F.col("_before"))
    keep = [athlete, event] + ([seq] if seq else [])
    return ran.select(*keep, F.col("_day").alias("date"), round_py("_age", 2).alias("age"),
                      F.col("_mark").alias("mark"), pb.alias("pb"))


def best_by_age_band(results: DataFrame, *, athlete: str = "athlete_id",
                     event: str = "Event_standard", date: str = "Start_Date",
                     value: str = "Result_numerical", dob: str = "date_of_birth",
                     lower: str | bool | None = None,
                     age_range: tuple[float, float] = AGE_RANGE,
                     norms: DataFrame | None = None) -> DataFrame:
    """Best mark per athlete, event and whole-year age band, when it was set, and how many
    results the band holds. Equal marks: the earliest counts. With ``norms`` also its percentile."""
    rows = aged_results(results, date=date, value=value, dob=dob, age_range=age_range)
    signed = F.when(_direction(event, lower), F.col("_mark")).otherwise(-F.col("_mark"))
    best = (rows.withColumn("age_band", events.age_band_centre(F.col("_age")))
            .groupBy(athlete, event, "age_band")
            .agg(F.min(F.struct(signed.alias("signed"), "_day", "_age", "_mark")).alias("b"),
                 F.count(F.lit(1)).alias("n")))
    out = best.select(
        athlete, event, "age_band", events.age_band_label(F.col("age_band")).alias("age_band_label"),
        round_py("b._age", 2).alias("age"), F.col("b._mark").alias("mark"),
        F.col("b._day").alias("date"), "n")
    if norms is None:
        return out
    return percentile_of_mark(out, norms, event=event, mark="mark", age="age_band")


# --- percentile norms ------------------------------------------------------------------------

def percentile_columns(norms: DataFrame) -> list[str]:
    return [c for c in norms.columns if re.fullmatch("[pP][0-9]+", c)]


def norm_curves(norms: DataFrame) -> DataFrame:
    """``(family, event, age_centre, curve)``: the curve of each norm row as an array of
    ``(mark, p)`` in ascending mark, one entry per distinct mark (the lowest percentile)."""
    points = F.array(*[F.struct(num_of(norms, c).alias("mark"), F.lit(float(c[1:])).alias("p"))
                       for c in percentile_columns(norms)])
    ordered = F.array_sort(F.filter(points, lambda x: x["mark"].isNotNull()))
    rows = norms.select(
        F.col("event").cast("string").alias("event"),
        events.bin_centre(F.col("age_bin")).alias("age_centre"), ordered.alias("all"))
    distinct = F.filter(F.col("all"), lambda x, i: (i == 0) | (
        x["mark"] > F.get(F.col("all"), F.greatest(i - 1, F.lit(0)))["mark"]))
    return rows.select(events.family_of(F.col("event")).alias("family"), "event", "age_centre",
                       distinct.alias("curve"), F.size("all").alias("n_points")).where(
        F.col("family").isNotNull() & F.col("age_centre").isNotNull())


def age_cells(norms: DataFrame) -> DataFrame:
    """``(family, n_bands, cells)``: by norm event of a family, and under ``ALL`` for the whole of
    it, sorted ages between which one band is the nearest, and these bands in the same order.

    The age half way between two bands belongs to the lower one. Of bands listed twice one row is
    kept, and of equal centres under ``ALL`` the event that sorts first. A family is bounded by
    its age bins and implements."""
    one = latest(norm_curves(norms), ["family", "event", "age_centre"],
                 [F.col("n_points"), F.col("curve")], columns=["curve", "n_points"])
    band = F.struct("age_centre", F.transform("curve", lambda x: x["mark"]).alias("marks"),
                    F.transform("curve", lambda x: x["p"]).alias("ps"), "n_points")
    every = one.groupBy("family", "age_centre").agg(
        F.min_by(band, "event").alias("band"), F.count(F.lit(1)).alias("n")).select(
        "family", F.lit(ALL).alias("event"), "band", "n")
    both = one.select("family", "event", band.alias("band"), F.lit(0).alias("n")).unionByName(every)
    lists = both.groupBy("family", "event").agg(
        F.array_sort(F.collect_list("band")).alias("bands"), F.sum("n").alias("n"))
    middles = F.transform(F.slice("bands", F.lit(2), F.greatest(F.size("bands") - 1, F.lit(0))),
                          lambda b, i: (F.get(F.col("bands"), i)["age_centre"] + b["age_centre"]) / 2)
    cell = F.struct(middles.alias("ages"), "bands")
    return lists.groupBy("family").agg(
        F.map_from_entries(F.collect_list(F.struct("event", cell))).alias("cells"),
        F.sum("n").alias("n_bands"))


#: Stands for all norm events of a family; no event has an empty name.
ALL = ""


def place_in(rows: DataFrame, values: str, x: Column, most: int, out: str) -> DataFrame:
    """Adds how many of the sorted array ``values``, of ``most`` at most, are below ``x``: one
    comparison per halving, each a column of its own, without a loop over the array."""
    step = 1 << max(most, 1).bit_length()
    rows = rows.withColumn(out, F.lit(0))
    while step := step >> 1:
        beyond = F.get(F.col(values), F.col(out) + (step - 1)) < x
        rows = rows.withColumn(out, F.when(beyond, F.col(out) + step).otherwise(F.col(out)))
    return rows


def read_curve(rows: DataFrame, band: str, mark: str, out: str, most: int) -> DataFrame:
    """Adds the percentile of ``mark`` on the curve of the struct column ``band``, of at most
    ``most`` points: linear between points, the end value beyond the ends.

    Needs two points. Points with one common mark read as the lowest percentile. Each step is a
    column of its own, so that no step is repeated inside the next."""
    rows = rows.withColumns({"_marks": F.col(band)["marks"], "_ps": F.col(band)["ps"]})
    rows = place_in(rows, "_marks", F.col(mark), most, "_below")
    m, below, size = F.col(mark), F.col("_below"), F.size("_marks")
    rows = rows.withColumns({"_lo": F.get("_marks", below - 1), "_hi": F.get("_marks", below),
                             "_plo": F.get("_ps", below - 1), "_phi": F.get("_ps", below)})
    lo, hi, plo, phi = (F.col(c) for c in ("_lo", "_hi", "_plo", "_phi"))
    value = (F.when((F.col(band)["n_points"] < 2) | m.isNull(), F.lit(None))
             .when((size < 2) | (below == 0), F.get(F.col("_ps"), F.lit(0)))
             .when(below >= size, plo).otherwise(plo + (phi - plo) * (m - lo) / (hi - lo)))
    rows = rows.withColumn("_raw", value)
    return rows.withColumn(out, round_py("_raw", 1)).drop(
        "_marks", "_ps", "_below", "_lo", "_hi", "_plo", "_phi", "_raw")


def percentile_of_mark(results: DataFrame, norms: DataFrame, *, event: str = "Event_standard",
                       mark: str = "mark", age: str = "age",
                       out: str = "percentile") -> DataFrame:
    """Adds the percentile of each mark within its event's norms at its age, 0 to 100.

    The band is the one nearest in age of the age-correct implement (the lower one on a tie); of
    another implement only when that implement has none. NULL when the event has no norm, the
    mark does not parse, or the age is missing and the event has more than one band."""
    # One short row per event family, and how far its arrays go.
    cells = cut(age_cells(norms))
    longest = cells.select(F.explode("cells").alias("event", "cell")).agg(
        F.max(F.size("cell.ages"))).first()[0] or 0
    based = results.withColumns({"_base": events.norm_base(F.col(event)),
                                 "_pmark": num_of(results, mark), "_page": num_of(results, age)})
    based = based.withColumn("_variant", events.norm_variant(F.col("_base"), F.col("_page")))
    joined = based.join(cells, based["_base"] == cells["family"], "left")
    joined = joined.withColumn("_cell", F.coalesce(
        F.try_element_at("cells", F.col("_variant")), F.try_element_at("cells", F.lit(ALL))))
    joined = joined.withColumns({"_ages": F.col("_cell.ages"), "_bands": F.col("_cell.bands")})
    joined = place_in(joined, "_ages", F.col("_page"), longest, "_at")
    at = F.when(F.col("_page").isNotNull(), F.col("_at")).when(F.col("n_bands") == 1, F.lit(0))
    joined = joined.withColumn("_band", F.get(F.col("_bands"), at))
    return read_curve(joined, "_band", "_pmark", out, len(percentile_columns(norms))).select(
        *results.columns, out)


def norm_bands(norms: DataFrame, *, event_names: list[str] | None = None,
               pct: tuple[int, ...] = BAND_PERCENTILES, elite: int | None = 100) -> DataFrame:
    """Percentile bands per event and age centre, with the age-correct implement at each age (the
    base event where that is missing). Rows without any value are dropped."""
    wanted = list(dict.fromkeys([*pct, *([elite] if elite is not None else [])]))
    there = {c.lower(): c for c in norms.columns}
    values = [(num_of(norms, there[f"p{p}"]) if f"p{p}" in there
               else F.lit(None).cast("double")).alias(f"p{p}") for p in wanted]
    rows = norms.select(F.col("event").cast("string").alias("norm_event"),
                        events.bin_centre(F.col("age_bin")).alias("age"), *values)
    rows = rows.withColumn("base", events.family_of(F.col("norm_event"))).where(
        F.col("base").isNotNull() & F.col("age").isNotNull())
    variant = events.norm_variant(F.col("base"), F.col("age"))
    rows = rows.withColumn("_pref", F.when(F.col("norm_event") == variant, 0)
                           .when(F.col("norm_event") == F.col("base"), 1))
    cols = [f"p{p}" for p in wanted]
    picked = latest(rows.where(F.col("_pref").isNotNull()), ["base", "age"],
                    [F.col("_pref"), *[F.col(c) for c in cols]], columns=cols, newest=False)
    picked = picked.where(F.coalesce(*[F.col(c) for c in cols]).isNotNull())
    names = {base: name for name, base in events.NORM_EVENTS.items()}
    out = picked.select(lookup(names, F.col("base")).alias("event"), "age", *cols)
    return out if event_names is None else out.where(F.col("event").isin(event_names))


# --- qualifying standards --------------------------------------------------------------------

def standard_lines(standards: DataFrame, *, label: str = "World U20 standard",
                   seq: str | None = None) -> DataFrame:
    """One reference line per event and sex: position, label, metric, direction.

    The first row of an event and sex counts (by ``seq`` where the table has an order); when that
    row has no number there is no line."""
    order = [F.col(seq)] if seq else [F.col("standard_numeric").isNull(),
                                      F.col("standard_numeric"), F.col("standard_raw")]
    first = latest(
        standards.select(F.col("event_standard").cast("string").alias("event"),
                         F.col("sex").cast("string").alias("sex"), "standard_numeric",
                         "standard_raw", "metric", "lower_is_better", *([seq] if seq else [])),
        ["event", "sex"], order, newest=False)
    raw = F.col("standard_raw").cast("string")
    text = F.when(raw.isNotNull() & (raw != ""), F.concat(F.lit(f"{label} ("), raw, F.lit(")")))
    return first.select(
        "event", "sex", finite(F.col("standard_numeric")).alias("y"),
        F.coalesce(text, F.lit(label)).alias("label"), "metric",
        F.coalesce(F.col("lower_is_better").cast("boolean"), F.lit(False))
        .alias("lower_is_better")).where(F.col("y").isNotNull())


class BenchmarkInputs(NamedTuple):
    """What a progression chart needs, for all athletes and events."""

    marks: DataFrame
    reference_lines: DataFrame
    bands: DataFrame


def benchmark_inputs(results: DataFrame, standards: DataFrame, norms: DataFrame, *,
                     athlete: str = "athlete_id", event: str = "Event_standard",
                     date: str = "Start_Date", value: str = "Result_numerical",
                     dob: str = "date_of_birth", sex: str = "sex", seq: str | None = None,
                     extra_refs: DataFrame | None = None,
                     pct: tuple[int, ...] = BAND_PERCENTILES,
                     chunk: str = "day") -> BenchmarkInputs:
    """Marks with direction and format, reference lines and norm bands.

    The standard of the athlete's sex decides the direction and format of an event; without one
    they follow from the event name."""
    lines = standard_lines(standards)
    side = lines.select(F.col("event").alias("_event"), F.col("sex").alias("_sex"),
                        F.col("metric").alias("_metric"), F.col("lower_is_better").alias("_lower"))
    named = F.col(event)
    known = results.join(
        side, (named == F.col("_event")) & (events.sex_code(F.col(sex)) == F.col("_sex")), "left")
    has = F.col("_event").isNotNull()
    known = known.withColumns({
        "lower_is_better": F.when(has, F.col("_lower")).otherwise(events.lower_is_better(named)),
        "value_format": F.when(has, F.when(F.col("_metric") == "time", "time"))
        .otherwise(events.value_format(named))})
    known = known.drop("_event", "_sex", "_metric", "_lower")
    # Direction and format are constant per athlete and event and travel with the key.
    keyed = known.withColumn("_key", F.struct(F.col(event).alias("event"),
                                              F.col("lower_is_better").alias("lower"),
                                              F.col("value_format").alias("fmt")))
    marks = marks_from_results(keyed, athlete=athlete, event="_key", date=date, value=value,
                               dob=dob, seq=seq, lower="lower_is_better", chunk=chunk)
    marks = marks.withColumns({event: F.col("_key")["event"],
                               "lower_is_better": F.col("_key")["lower"],
                               "value_format": F.col("_key")["fmt"]}).drop("_key")
    refs = lines.select("event", "sex", "y", "label")
    if extra_refs is not None:
        refs = refs.unionByName(extra_refs.select("event", "sex", "y", "label"))
    return BenchmarkInputs(marks, refs, norm_bands(norms, pct=pct))


def percentile_norms(rows: DataFrame) -> DataFrame:
    """The norm table with lower-case column names and a text event."""
    low = rows.toDF(*[c.lower() for c in rows.columns])
    return low.withColumn("event", F.col("event").cast("string"))

