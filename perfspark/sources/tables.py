"""Table queries, relational reads, curated views and headerless results."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def query_table(df: DataFrame, *, where: str | Column | None = None, order_by: str | None = None,
                desc: bool = False, limit: int | None = None, offset: int = 0,
                columns: list[str] | None = None, tie: list[str] | None = None) -> DataFrame:
    """Filter, one sort column, limit and offset over a table.

    The filter and the columns reach the scan. An offset needs an order, or pages would differ
    from run to run; ``tie`` makes equal sort values definite."""
    if offset and order_by is None:
        raise ValueError("an offset needs order_by")
    out = df if where is None else df.where(where)
    if order_by is not None:
        out = out.orderBy(F.desc(order_by) if desc else F.asc(order_by),
                          *[F.asc(t) for t in (tie or [])])
    if columns:
        out = out.select(*columns)
    if offset:
        out = out.offset(offset)
    return out if limit is None else out.limit(limit)


def read_view(df: DataFrame, **filters: Any) -> DataFrame:
    """A curated view filtered by ``column=value``."""
    for name, value in filters.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def sql_with_params(spark: SparkSession, text: str, params: dict | list | None = None,
                    row_limit: int | None = None) -> DataFrame:
    """A read-only statement over registered views with bound parameters."""
    if not text.lstrip().lower().startswith(("select", "with")):
        raise ValueError("only SELECT or WITH statements are read")
    out = spark.sql(text, args=params) if params else spark.sql(text)
    return out if row_limit is None else out.limit(row_limit)


def read_jdbc(spark: SparkSession, url: str, table: str, *, column: str | None = None,
              bounds: tuple[Any, Any] | None = None, partitions: int | None = None,
              fetch: int = 10000, **options: str) -> DataFrame:
    """A relational table or ``(query) alias`` as one partitioned scan; filters and columns are
    pushed to the database. Without a partition column the read is a single connection."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", fetch))
    if column is not None:
        if bounds is None or partitions is None:
            raise ValueError("a partition column needs bounds and a partition count")
        reader = (reader.option("partitionColumn", column).option("lowerBound", bounds[0])
                  .option("upperBound", bounds[1]).option("numPartitions", partitions))
    return reader.options(**options).load()


def write_jdbc(df: DataFrame, url: str, table: str, *, cells: int = 20000, mode: str = "append",
               **options: str) -> None:
    """Append to a relational table in batches sized by width."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table)
     .option("batchsize", batch_rows(len(df.columns), cells)).options(**options).mode(mode).save())


def batch_rows(n_columns: int, cells: int = 20000) -> int:
    """Rows per write batch: wide tables get smaller ones, never below 50."""
    return max(50, cells // max(1, n_columns))


def read_headerless(spark: SparkSession, path: str, *, sep: str = ",") -> DataFrame:
    """Delimited text without a header line, columns ``col_0``, ``col_1``, ..."""
    raw = spark.read.csv(path, header=False, sep=sep)
    return raw.toDF(*[f"col_{i}" for i in range(len(raw.columns))])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               kind: str = "parquet") -> DataFrame:
    """A landed table, with a declared schema where one is given (no inference pass)."""
    reader = spark.read.format(kind)
    return (reader.schema(schema) if schema is not None else reader).load(path)
