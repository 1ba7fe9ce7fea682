"""Event names: direction, norm families, age bands, rebound-jump fields."""

from __future__ import annotations

import json

from pyspark.sql import Column, functions as F

from .numbers import lookup

# Words (case-sensitive) that mark a field event, where higher is better.
FIELD_WORDS = ["Jump", "Vault", "Throw", "Put", "Discus", "Hammer", "Javelin"]

# Event name -> event name in the norm table.
NORM_EVENTS = {
    "60m": "60m", "100m": "100m", "200m": "200m", "300m": "300m", "400m": "400m",
    "800m": "800m", "1000m": "1000m", "1500m": "1500m", "2000m": "2000m",
    "3000m": "3000m", "5000m": "5000m", "10000m": "10000m",
    "60m Hurdles": "60mH", "110m Hurdles": "110mH",
    "Long Jump": "Long Jump", "High Jump": "High Jump",
    "Triple Jump": "Triple Jump", "Pole Vault": "Pole Vault",
    "Shot Put": "Shot Put", "Discus Throw": "Discus Throw",
    "Hammer Throw": "Hammer Throw", "Javelin Throw": "Javelin Throw",
}

# Implement or hurdle by age, as (below this age, suffix); 999 is the senior one.
IMPLEMENTS = {
    "Shot Put": [(14, "(3kg)"), (16, "(4kg)"), (18, "(5kg)"), (20, "(6kg)"), (999, "")],
    "Discus Throw": [(12, "(0.750kg)"), (14, "(1.000kg)"), (16, "(1.250kg)"),
                     (18, "(1.500kg)"), (20, "(1.750kg)"), (999, "")],
    "Hammer Throw": [(14, "(3kg)"), (16, "(4kg)"), (18, "(5kg)"), (20, "(6kg)"), (999, "")],
    "Javelin Throw": [(12, "(400g)"), (14, "(500g)"), (16, "(600g)"), (18, "(700g)"),
                      (999, "(800g)")],
    "110mH": [(16, "(84cm)"), (18, "(91cm)"), (20, "(99cm)"), (999, "")],
}

# Rebound-jump field alias -> (stored field name, which trial is best).
REBOUND_FIELDS = {
    "tf_tc": ("flightTimeOverContractionTime", "max"),
    "contact": ("contactTimeSeconds", "min"),
    "flight": ("flightTimeSeconds", "max"),
    "height": ("heightMeters", "max"),
    "rsi": ("rsi", "max"),
}


def lower_is_better(event: Column) -> Column:
    """Runs and walks are better when lower, field and combined events when higher."""
    e = F.coalesce(event.cast("string"), F.lit(""))
    return ~(e.rlike("|".join(FIELD_WORDS)) | F.lower(e).contains("athlon"))


def value_format(event: Column) -> Column:
    return F.when(lower_is_better(event), "time")


def sex_code(sex: Column) -> Column:
    s = F.lower(F.trim(F.coalesce(sex.cast("string"), F.lit(""))))
    return F.when(s.isin("female", "f", "w", "women"), "W").otherwise("M")


def age_band_centre(age: Column) -> Column:
    """Whole-year band with inclusive lower edge: 12.5 up to 13.5 is 13."""
    shifted = age + 0.5
    return F.when(shifted >= 0, F.floor(shifted)).otherwise(F.ceil(shifted)).cast("double")


def _plain(c: Column) -> Column:
    text = F.format_string("%.1f", c)
    return F.regexp_replace(text, r"\.0$", "")


def age_band_label(age: Column) -> Column:
    """Label of the band, e.g. ``12.5 - 13.5``."""
    centre = age_band_centre(age)
    return F.when(centre.isNotNull(),
                  F.concat(_plain(centre - 0.5), F.lit(" - "), _plain(centre + 0.5)))


def bin_centre(label: Column) -> Column:
    """Centre of an age-bin label: two numbers are averaged, one is taken, else NULL."""
    found = F.regexp_extract_all(label.cast("string"), F.lit(r"([0-9.]+)"), F.lit(1))
    n = F.size(found)
    first = F.get(found, F.lit(0)).try_cast("double")
    second = F.get(found, F.lit(1)).try_cast("double")
    return F.when(n == 2, (first + second) / 2).when(n == 1, first)


def norm_base(event: Column) -> Column:
    """Norm-table base event of an event name, NULL when there is no norm."""
    return lookup(NORM_EVENTS, F.trim(event))


def norm_variant(base: Column, age: Column) -> Column:
    """The implement or hurdle variant of the base event for an age; the base when age is NULL."""
    steps = F.from_json(F.lit(json.dumps(
        {event: [{"below": below, "name": f"{event} {suffix}".strip()} for below, suffix in rows]
         for event, rows in IMPLEMENTS.items()})),
        "map<string,array<struct<below:int,name:string>>>")
    fitting = F.filter(F.try_element_at(steps, base), lambda s: age < s["below"])
    return F.coalesce(F.get(fitting, F.lit(0))["name"], base)


def has_implements(base: Column) -> Column:
    return base.isin(*IMPLEMENTS)


def family_of(norm_event: Column) -> Column:
    """Base event of a norm-table event: variants lead back to their base."""
    variants = {b: b for b in NORM_EVENTS.values()}
    for base, steps in IMPLEMENTS.items():
        variants.update({f"{base} {suffix}".strip(): base for _, suffix in steps})
    return lookup(variants, norm_event)


def rebound_field(alias: Column) -> Column:
    """Stored field name of an alias; unknown aliases pass through."""
    return F.coalesce(lookup({k: raw for k, (raw, _) in REBOUND_FIELDS.items()}, alias), alias)


def rebound_takes_min(alias: Column) -> Column:
    """Whether the lowest trial is best. Only a known alias can say so."""
    lows = [k for k, (_, best) in REBOUND_FIELDS.items() if best == "min"]
    return F.coalesce(alias.isin(*lows), F.lit(False))
