"""Anthropometric derivations as column expressions.

A site's value is either a plain number or a JSON object with up to three trials ``m1``, ``m2``,
``m3``.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from .numbers import finite, once, round_py, to_num

# Skinfold sites of the sum of eight and the sum of four.
SKINFOLDS_8 = ["sf_triceps", "sf_subscapular", "sf_biceps", "sf_iliacCrest",
               "sf_supraspinale", "sf_abdominal", "sf_frontThigh", "sf_medialCalf"]
SKINFOLDS_4 = ["sf_triceps", "sf_biceps", "sf_subscapular", "sf_iliacCrest"]

# Durnin-Womersley (age below, intercept, slope); None is the open last band.
DENSITY_BANDS = [(20, 1.162, 0.063), (30, 1.1631, 0.0632), (40, 1.1422, 0.0544),
                 (50, 1.162, 0.07), (None, 1.1715, 0.0779)]

# The ten inputs of the somatotype.
SOMATOTYPE_SITES = ["sf_triceps", "sf_subscapular", "sf_supraspinale", "sf_medialCalf",
                    "b_humerus", "b_femur", "g_armFlexed", "g_calf", "stature", "bodyMass"]


def trial_result(m1: Column, m2: Column, m3: Column) -> Column:
    """Median of three trials, mean of the first two, else the first."""
    middle = F.greatest(F.least(m1, m2), F.least(F.greatest(m1, m2), m3))
    return (F.when(m1.isNotNull() & m2.isNotNull() & m3.isNotNull(), middle)
            .when(m1.isNotNull() & m2.isNotNull(), (m1 + m2) / 2)
            .otherwise(m1))


def typed_sites(measurements: Column, sites: list[str], cell: str) -> Column:
    """The named sites of the measurement JSON as a struct; a cell that is not of the type asked
    for is NULL."""
    return F.from_json(measurements, ", ".join(f"{s} {cell}" for s in sites))


#: Trials of a site: as numbers, and as text for records that hold quoted values.
NUMBERS = "struct<m1: double, m2: double, m3: double>"
TEXTS = "struct<m1: string, m2: string, m3: string>"

#: A quoted value somewhere in the JSON: a trial may be a number written as text.
QUOTED = r""":\s*["']"""


def cell_result(numbers: Column, texts: Column, plain: Column) -> Column:
    """Final result of a site that holds either trials (``numbers``, and ``texts`` where a record
    has quoted values) or a plain number."""
    trials = [F.coalesce(finite(numbers[m]), to_num(texts[m])) for m in ("m1", "m2", "m3")]
    # A plain number is its own only trial.
    cells = F.when(numbers.isNotNull(), F.array(*trials)).otherwise(F.array(to_num(plain)))
    return once(cells, lambda v: trial_result(v[0], F.get(v, F.lit(1)), F.get(v, F.lit(2))))


def body_mass_index(mass: Column, stature: Column) -> Column:
    metres = stature / 100
    ok = (mass != 0) & (stature != 0)
    return F.when(ok, round_py(mass / (metres * metres), 1))


def skinfold_total(values: list[Column]) -> Column:
    """Sum of the sites from left to right; NULL when one is missing.

    Folded over an array: Spark may share a prefix of two plain sums, which would make the last
    digit depend on the plan."""
    return F.aggregate(F.array(*values), F.lit(0.0), lambda total, v: total + v)


def body_density(sum4: Column, age: Column) -> Column:
    """Durnin-Womersley density; needs a positive sum and an age."""
    log_sum = F.when(sum4 > 0, F.log10(sum4))
    out = None
    for below, intercept, slope in DENSITY_BANDS:
        value = F.lit(intercept) - F.lit(slope) * log_sum
        if below is None:
            out = out.otherwise(value)
        else:
            out = F.when(age < below, value) if out is None else out.when(age < below, value)
    return F.when(age.isNotNull(), out)


def percent_fat(density: Column) -> Column:
    """Siri percentage from the rounded density, one decimal."""
    return round_py((F.lit(4.95) / density - 4.5) * 100, 1)


def fat_free_mass(mass: Column, pct: Column) -> Column:
    return round_py(mass * (F.lit(1) - pct / 100), 1)


def fat_mass(mass: Column, pct: Column) -> Column:
    return round_py(mass * (pct / 100), 1)


def somatotype(v: dict[str, Column]) -> Column:
    """Heath-Carter ``struct(endo, meso, ecto)``; NULL when an input is missing or zero-sized.

    Endomorphy from the stature-corrected sum of three skinfolds, mesomorphy from breadths and
    skinfold-corrected girths, ectomorphy from stature over the cube root of mass."""
    stature, mass = v["stature"], v["bodyMass"]
    folds = (v["sf_triceps"] + v["sf_subscapular"] + v["sf_supraspinale"]) * (170.18 / stature)
    endo = (F.lit(-0.7182) + 0.1451 * folds - 0.00068 * F.pow(folds, 2.0)
            + 0.0000014 * F.pow(folds, 3.0))
    meso = (0.858 * v["b_humerus"] + 0.601 * v["b_femur"]
            + 0.188 * (v["g_armFlexed"] - v["sf_triceps"] / 10)
            + 0.161 * (v["g_calf"] - v["sf_medialCalf"] / 10) - 0.131 * stature + 4.5)
    ratio = stature / F.pow(mass, 1 / 3)
    ecto = (F.when(ratio >= 40.75, 0.732 * ratio - 28.58)
            .when(ratio >= 38.25, 0.463 * ratio - 17.63).otherwise(0.1))
    complete = reduce(lambda a, b: a & b, [v[s].isNotNull() for s in SOMATOTYPE_SITES])
    floor = F.lit(0.1)
    return F.when(complete & (stature != 0) & (mass > 0),
                  F.struct(F.greatest(floor, endo).alias("endo"),
                           F.greatest(floor, meso).alias("meso"),
                           F.greatest(floor, ecto).alias("ecto")))


def somatotype_text(s: Column) -> Column:
    """``endo-meso-ecto`` with one decimal each."""
    def one(c: Column) -> Column:
        shown = round_py(c, 1)
        return F.coalesce(shown.try_cast("decimal(38,1)").cast("string"), shown.cast("string"))

    # One rounding rule over an array: written out three times it is too long to be compiled.
    parts = F.transform(F.array(s["endo"], s["meso"], s["ecto"]), one)
    return F.when(s.isNotNull(), F.array_join(parts, "-"))
