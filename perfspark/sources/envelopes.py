"""Landed API responses: rows out of their envelopes, failures apart from successes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Where the rows of a response may be, in the order they are tried.
ROW_PATHS = ["$.result.data.records", "$.records", "$.data", "$.items", "$.rows"]


def rows_json(body: Column) -> Column:
    """JSON text of the row array of a response; a bare list is its own row array. NULL when the
    response holds no array."""
    bare = F.when(body.rlike(r"^\s*\["), body)
    found = [F.get_json_object(body, p) for p in ROW_PATHS]
    return F.coalesce(bare, *[F.when(f.rlike(r"^\s*\["), f) for f in found])


def unwrap(df: DataFrame, schema: T.StructType | str, *, body: str = "body",
           keep: list[str] | None = None, outer: bool = False) -> DataFrame:
    """One output row per record of each response, typed by ``schema``.

    ``outer`` keeps responses without records as a row of NULLs."""
    kind = schema.simpleString() if isinstance(schema, T.StructType) else f"struct<{schema}>"
    rows = F.from_json(rows_json(F.col(body)), f"array<{kind}>")
    found = df.select(*(keep or []), F.explode_outer(rows).alias("_r"))
    if not outer:
        found = found.where(F.col("_r").isNotNull())
    return found.select(*(keep or []), "_r.*")


def split_failures(df: DataFrame, *, body: str = "body",
                   strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(succeeded, failed)``: a response may arrive in good order and still say
    ``success: false`` inside. ``failed`` carries the error text; ``strict`` fails the job."""
    inner = F.get_json_object(body, "$.result.success")
    bad = F.coalesce(F.lower(inner) == "false", F.lit(False))
    error = F.coalesce(F.get_json_object(body, "$.result.error"),
                       F.get_json_object(body, "$.result.message"), F.lit("failed"))
    if strict:
        checked = df.where(F.when(bad, F.raise_error(error).cast("boolean")).otherwise(True))
        return checked, df.where(F.lit(False)).withColumn("error", error)
    return df.where(~bad), df.where(bad).withColumn("error", error)
