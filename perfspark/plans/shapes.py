"""Latest record, top rows and running values: the plan shapes behind most operators.

All of them stay whole under skew. ``latest`` is one partially aggregated ``max_by``; ``top_rows``
is a ranked window that Spark cuts to ``n`` rows per key before the shuffle; ``running_min``
splits each key into chunks of time, so that one key holding a third of all rows is worked on by
as many tasks as it has chunks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column], *,
           columns: list[str] | None = None, newest: bool = True) -> DataFrame:
    """One row per key: the last (or first) by ``order``. No window, no sort of the group."""
    names = [c for c in (columns or df.columns) if c not in keys]
    pick = F.max_by if newest else F.min_by
    body = F.struct(*[F.col(n) for n in names])
    rows = df.groupBy(*keys).agg(pick(body, F.struct(*order)).alias("_row"))
    return rows.select(*keys, *[F.col("_row")[n].alias(n) for n in names])


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int,
             rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per key with their rank from 1."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def running_min(df: DataFrame, keys: list[str], order: list[Column], value: Column,
                chunk: Column, out: str = "before") -> DataFrame:
    """Adds the least ``value`` of the rows before each row of its key (NULL at the first).

    ``chunk`` must not decrease along ``order``. Chunk minima are aggregated first; a window over
    these few rows carries them forward, and only rows of one chunk are sorted together."""
    rows = df.withColumn("_v", value).withColumn("_chunk", chunk)
    least = rows.groupBy(*keys, "_chunk").agg(F.min("_v").alias("_least"))
    back = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    other = {c: f"_r{i}" for i, c in enumerate([*keys, "_chunk"])}
    carried = least.select(*[F.col(c).alias(n) for c, n in other.items()],
                           F.min("_least").over(back).alias("_carried"))
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in other.items()])
    joined = rows.join(carried, match).drop(*other.values())
    inside = (W.partitionBy(*keys, "_chunk").orderBy(*order)
              .rowsBetween(W.unboundedPreceding, -1))
    return (joined.withColumn(out, F.least(F.min("_v").over(inside), F.col("_carried")))
            .drop("_v", "_chunk", "_carried"))
