"""Small text rules: clock slots, nested labels, comma lists, product labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import present


def clock_slot(c: Column | str) -> Column:
    """``AM``/``PM`` of ``HH:MM`` or an ISO datetime; blank or unreadable times count as AM."""
    s = F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
    at = F.instr(s, "T")
    clock = F.when(at > 0, F.substr(s, at + F.lit(1))).otherwise(s)
    hour = F.when(clock.rlike("^[0-9]{2}"), F.substring(clock, 1, 2).try_cast("int"))
    return F.when(hour >= 12, "PM").otherwise("AM")


def flat_label(c: Column | str) -> Column:
    """A plain value as is; of a JSON object its ``name``, else its ``description``."""
    s = (F.col(c) if isinstance(c, str) else c).cast("string")
    nested = F.coalesce(present(F.get_json_object(s, "$.name")),
                        present(F.get_json_object(s, "$.description")))
    return F.when(s.rlike(r"^\s*\{"), nested).otherwise(s)


def first_listed(c: Column | str, skip: str = "TBD") -> Column:
    """First usable token of a comma list."""
    s = F.col(c) if isinstance(c, str) else c
    tokens = F.transform(F.split(s, ","), lambda t: F.trim(t))
    return F.get(F.filter(tokens, lambda t: (t != "") & (F.upper(t) != skip)), F.lit(0))


def product_label(name: Column | str, brand: Column | str, unit: Column | str) -> Column:
    """``name brand (unit)`` from the parts that are there."""
    text = F.concat_ws(" ", present(name), present(brand))
    return F.concat(text, F.coalesce(F.concat(F.lit(" ("), present(unit), F.lit(")")), F.lit("")))


def parse_map(c: Column | str) -> Column:
    """JSON object text to ``map<string,string>``; blank or bad JSON gives an empty map."""
    parsed = F.from_json(c, "map<string,string>")
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(parsed, empty)
