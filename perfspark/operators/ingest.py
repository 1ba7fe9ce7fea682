"""The ingest lane: clean, profile, check, resolve, identify, upsert."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.ids import sanitize_columns, uuid5
from ..functions.numbers import num_of, to_num
from ..plans.shapes import top_rows
from ..sources.keyed import KeyedTable
from .identity import resolve_ladder

Rules = dict[str, tuple[float, float]]


# --- range checks ----------------------------------------------------------------------------

def null_out_of_range(df: DataFrame, rules: Rules) -> DataFrame:
    """Values outside their column's bounds become NULL; text that is no number stays."""
    def checked(c: str, lo: float, hi: float) -> Column:
        v = num_of(df, c)
        return F.when(v.isNull() | v.between(lo, hi), F.col(c))

    return df.withColumns({c: checked(c, *b) for c, b in rules.items() if c in df.columns})


def range_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """``(column, n_checked, n_out_of_range)`` in one pass and without a shuffle of rows."""
    named = {c: b for c, b in rules.items() if c in df.columns}
    checks = []
    for c, (lo, hi) in named.items():
        v = num_of(df, c)
        checks += [F.count(v).alias(f"n_{c}"),
                   F.count(F.when(~v.between(lo, hi), 1)).alias(f"o_{c}")]
    out = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n_checked"),
                             F.col(f"o_{c}").alias("n_out_of_range")) for c in named])
    return df.agg(*checks).select(F.inline(out))


def range_examples(df: DataFrame, rules: Rules, *, order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` out-of-range values per column by ``order``: ``(column, rank, example)``."""
    found = []
    for c, (lo, hi) in rules.items():
        if c in df.columns:
            v = num_of(df, c)
            found.append(F.when(~v.between(lo, hi),
                                F.struct(F.lit(c).alias("column"), v.alias("example"))))
    bad = F.filter(F.array(*found), lambda x: x.isNotNull())
    rows = df.select(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                     F.explode_outer(bad).alias("_b")).where(F.col("_b").isNotNull())
    rows = rows.select("*", "_b.column", "_b.example")
    keys = [F.col(f"_o{i}") for i in range(len(order))]
    return top_rows(rows, ["column"], [*keys, F.col("example")], n).select(
        "column", "rank", "example")


def range_report(df: DataFrame, rules: Rules, *, order: list[str]) -> DataFrame:
    """Counts with the examples as an array of at most five."""
    shown = range_examples(df, rules, order=order).groupBy("column").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "example"))),
                    lambda x: x["example"]).alias("examples"))
    out = range_counts(df, rules).join(shown, "column", "left")
    empty = F.array().cast("array<double>")
    return out.withColumn("examples", F.coalesce("examples", empty))


def future_rows(df: DataFrame, column: str, as_of: Column) -> DataFrame:
    """Rows dated after ``as_of``: swapped days and months show up here."""
    at = (F.col(column) if not isinstance(df.schema[column].dataType, T.StringType)
          else F.try_to_timestamp(column))
    return df.where(at > as_of)


# --- column profile --------------------------------------------------------------------------

# Longest text (characters) -> declared type.
WIDTHS = [(30, "VARCHAR(40)"), (80, "VARCHAR(100)"), (250, "VARCHAR(255)")]
NUMERIC_SHARE = 0.95


def declared_type(n: Column, n_numeric: Column, longest: Column) -> Column:
    """Column type from counts: mostly numbers, else text by its longest value."""
    kind = F.when(n == 0, "VARCHAR(100)").when(n_numeric / n >= NUMERIC_SHARE, "DOUBLE")
    for width, name in WIDTHS:
        kind = kind.when(longest <= width, name)
    return kind.otherwise("TEXT")


def column_profile(df: DataFrame) -> DataFrame:
    """``(column, n_values, n_numeric, max_len, sql_type)`` of every column in one aggregation."""
    def cell(c: str) -> Column:
        s = F.trim(F.col(c).cast("string"))
        return F.when(s != "", s)

    aggs = []
    for i, c in enumerate(df.columns):
        v = cell(c)
        aggs += [F.count(v).alias(f"n{i}"), F.count(to_num(v)).alias(f"m{i}"),
                 F.max(F.length(v)).alias(f"l{i}")]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_values"),
                              F.col(f"m{i}").alias("n_numeric"), F.col(f"l{i}").alias("max_len"))
                     for i, c in enumerate(df.columns)])
    flat = df.agg(*aggs).select(F.inline(rows))
    return flat.withColumn("sql_type", declared_type(
        F.col("n_values"), F.col("n_numeric"), F.col("max_len")))


def typed(df: DataFrame, profile: dict[str, str]) -> DataFrame:
    """Columns profiled as numbers become doubles; cells that are none become NULL."""
    return df.withColumns({c: num_of(df, c) for c, t in profile.items()
                           if t == "DOUBLE" and c in df.columns})


# --- the lane --------------------------------------------------------------------------------

class Ingested(NamedTuple):
    """Rows ready to upsert, their column types, the range report and future-dated rows."""

    rows: DataFrame
    types: dict[str, str]
    report: DataFrame
    future: DataFrame


def ingest_lane(df: DataFrame, *, name_column: str, date_column: str, natural_key: list[str],
                rules: Rules, as_of: Column, entered_by: str | None = None,
                **evidence: DataFrame) -> Ingested:
    """A messy frame to rows of the target table.

    Columns are renamed and typed by their profile, impossible values removed, names resolved by
    ``evidence`` (see ``identity.resolve_ladder``) and every row given an id from its natural key,
    so that loading the same data again changes nothing. Arguments name cleaned columns."""
    clean = sanitize_columns(df)
    data = [c for c in clean.columns if c != name_column]
    # One short row per column.
    types = {r["column"]: r["sql_type"] for r in column_profile(clean.select(*data)).collect()}
    report = range_report(clean, rules, order=natural_key)
    future = future_rows(clean, date_column, as_of)
    # The id is taken from the text as it came, before any value is checked or retyped.
    checked = null_out_of_range(clean.withColumn("row_uid", uuid5(*natural_key)), rules)
    numbered = typed(checked, types)
    keyed = numbered.withColumns({
        "event_uuid": F.col("row_uid"), "group_uuid": F.lit(None).cast("string"),
        "record_date": F.try_to_date(F.substring(F.col(date_column).cast("string"), 1, 10),
                                     "yyyy-MM-dd"),
        "source_name": F.col(name_column).cast("string"),
        "entered_by": F.lit(entered_by).cast("string")})
    names = keyed.select(F.col("source_name").alias("name")).where(F.col("name").isNotNull())
    who = resolve_ladder(names, **evidence).select(
        F.col("name").alias("source_name"), "sams_id", "sams_name",
        F.col("verdict").alias("match_verdict"), F.col("confidence").alias("match_confidence"))
    rows = keyed.join(who, "source_name", "left")
    head = ["row_uid", "event_uuid", "group_uuid", "record_date", "source_name", "entered_by",
            "sams_id", "sams_name", "match_verdict", "match_confidence"]
    return Ingested(rows.select(*head, *data), types, report, future)


STAMPS = ("created_at", "updated_at")


def load(made: Ingested, target: KeyedTable, at: Column) -> DataFrame:
    """Upsert ingested rows into ``target``, stamped; returns the rejected rows.

    A new row is created and updated ``at``; a known one keeps its creation time and is updated
    only if a value differs, so that loading the same data again changes and writes nothing."""
    try:
        there = target.read()
    except LookupError:
        there = None
    columns = made.rows.columns
    if there is None:
        stamped = made.rows.withColumns({"created_at": at, "updated_at": at})
    else:
        old = [F.col(c) if c in there.columns else F.lit(None).cast(made.rows.schema[c].dataType)
               for c in columns]
        known = there.select("row_uid", F.col("created_at").alias("_created"),
                             F.col("updated_at").alias("_updated"),
                             F.struct(*[o.alias(c) for o, c in zip(old, columns, strict=True)])
                             .alias("_was"))
        same = F.struct(*columns).eqNullSafe(F.col("_was"))
        stamped = made.rows.join(known, "row_uid", "left").select(
            *columns, F.coalesce("_created", at).alias("created_at"),
            F.when(same, F.col("_updated")).otherwise(at).alias("updated_at"),
            (same & F.col("_created").isNotNull()).alias("_stands"))
        stored = {f.name: f.dataType for f in there.schema if f.name not in STAMPS}
        if stored == {f.name: f.dataType for f in made.rows.schema}:
            return target.upsert(stamped, stands="_stands")
        stamped = stamped.drop("_stands")
    return target.upsert(stamped)
