"""Anthropometry: per-session derivations, growth series and the latest snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import body
from ..functions.numbers import age_at, day_of, present, round_py
from ..functions.text import parse_map
from ..plans.shapes import latest

DERIVED = ["age", "body_mass", "stature", "sitting_height", "arm_span", "bmi", "sum8", "sum4",
           "body_density", "percent_bf", "ffm", "fat_mass", "somatotype"]


def body_composition(df: DataFrame, sites: dict[str, Column], age: Column) -> DataFrame:
    """Adds the derived block to a frame whose site results are the given columns.

    Results are materialised step by step so that each expression is computed once."""
    named = {s: f"_{s}" for s in sites}
    rows = df.withColumns({**{named[s]: c for s, c in sites.items()}, "age": age})
    v = {s: F.col(n) for s, n in named.items()}
    mass, stature = v["bodyMass"], v["stature"]
    rows = rows.withColumns({
        "bmi": body.body_mass_index(mass, stature),
        "_sum8": body.skinfold_total([v[s] for s in body.SKINFOLDS_8]),
        "_sum4": body.skinfold_total([v[s] for s in body.SKINFOLDS_4]),
        "_soma": body.somatotype(v)})
    rows = rows.withColumns({"sum8": round_py("_sum8", 1), "sum4": round_py("_sum4", 1)})
    rows = rows.withColumn("_density", body.body_density(F.col("sum4"), F.col("age")))
    rows = rows.withColumn("body_density", round_py("_density", 4))
    rows = rows.withColumn("percent_bf", body.percent_fat(F.col("body_density")))
    return rows.withColumns({
        "ffm": body.fat_free_mass(mass, F.col("percent_bf")),
        "fat_mass": body.fat_mass(mass, F.col("percent_bf")),
        "somatotype": body.somatotype_text(F.col("_soma"))})


def anthro_sessions(records: DataFrame, *, dob: str = "date_of_birth",
                    date: str = "date_of_measure") -> DataFrame:
    """One derived row per measurement session; measurement JSON is parsed twice, as trials and as
    plain numbers, and a third time where it holds quoted values."""
    wanted = list(dict.fromkeys([*body.SOMATOTYPE_SITES, *body.SKINFOLDS_8,
                                 "sittingHeight", "armSpan"]))
    text = F.col("measurements")
    texts = F.when(text.rlike(body.QUOTED), body.typed_sites(text, wanted, body.TEXTS))
    rows = records.withColumns({"_numbers": body.typed_sites(text, wanted, body.NUMBERS),
                                "_texts": texts,
                                "_plain": body.typed_sites(text, wanted, "string"),
                                "date": day_of(records, date)})
    sites = {s: body.cell_result(F.col("_numbers")[s], F.col("_texts")[s], F.col("_plain")[s])
             for s in wanted}
    age = age_at(day_of(records, dob), F.col("date"))
    out = body_composition(rows, sites, age)
    maturation = F.lit(None).cast("string")
    if "maturation" in records.columns:
        maturation = F.when(F.size(parse_map("maturation")) > 0, F.col("maturation"))
    keep = [c for c in ("player_id", "mrn", "athlete_name", "level") if c in records.columns]
    return out.select(
        *keep, "date", "age", F.col("_bodyMass").alias("body_mass"),
        F.col("_stature").alias("stature"), F.col("_sittingHeight").alias("sitting_height"),
        F.col("_armSpan").alias("arm_span"), "bmi", "sum8", "sum4", "body_density", "percent_bf",
        "ffm", "fat_mass", "somatotype", maturation.alias("maturation"))


def growth_series(sessions: DataFrame, *, key: str = "player_id") -> DataFrame:
    """Stature, mass and BMI of every session that has either of the first two, in long form."""
    # Rows of an array: a filter on plain columns would be moved below the parsing and repeat it.
    rows = F.inline(F.array(F.struct("date", "stature", "body_mass", "bmi")))
    return sessions.select(key, rows).where(
        F.col("stature").isNotNull() | F.col("body_mass").isNotNull())


def anthro_summary(sessions: DataFrame, *, key: str = "player_id",
                   athletes: DataFrame | None = None) -> DataFrame:
    """Latest session, number of sessions and newest maturation block per athlete, in one
    aggregation. With ``athletes``, those without a session stay, flagged ``has_data`` false."""
    order = F.struct("date", *[F.col(c) for c in DERIVED])
    body_cols = F.struct("date", "level", *DERIVED) if "level" in sessions.columns \
        else F.struct("date", *DERIVED)
    name = F.max_by("athlete_name", F.when(present("athlete_name").isNotNull(), F.col("date")))
    has = F.col("maturation").isNotNull()
    out = sessions.groupBy(key).agg(
        name.alias("athlete_name"), F.count(F.lit(1)).alias("n_sessions"),
        F.max_by(body_cols, order).alias("latest"),
        F.max_by("maturation", F.when(has, F.col("date"))).alias("maturation"))
    out = out.withColumns({"matched": F.lit(True), "has_data": F.lit(True)})
    if athletes is None:
        return out
    asked = athletes.select(key).distinct()
    joined = asked.join(out, key, "left")
    return joined.withColumns({
        "matched": F.col(key).isNotNull(),
        "has_data": F.coalesce(F.col("has_data"), F.lit(False))})


def latest_sessions(sessions: DataFrame, *, key: str = "player_id") -> DataFrame:
    """The newest session of each athlete as plain columns."""
    return latest(sessions, [key], [F.col("date"), *[F.col(c) for c in DERIVED]],
                  columns=["date", *DERIVED])
