"""Plan shapes and array helpers shared by the training-data operators.

Work on groups follows one pattern: rows are repartitioned by key, sorted inside their partitions
and handed to numpy as Arrow batches; ``whole_groups`` cuts that stream at key changes, so a task
holds one batch and one group at a time. Groups above a size are cut into chunks first
(``chunk_pairs``): every pair of rows of a hot group still meets in exactly one bounded task.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut


def document_key() -> list[Column]:
    """Two hashes that name a document row by its id and its whole text."""
    parts = [F.col("doc_id"), F.col("text")]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def first_of_each(docs: DataFrame, near: DataFrame) -> DataFrame:
    """``docs`` with the row of least id (null last) of each ``root`` of ``(doc_id, k1, k2, root)``."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k1", "k2"))
    stays = near.groupBy("root").agg(first.alias("f")).select(
        F.col("f.k1").alias("_k1"), F.col("f.k2").alias("_k2"))
    k1, k2 = document_key()
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"),
                       k1.alias("_k1"), k2.alias("_k2"))
    kept = rows.join(stays, ["_k1", "_k2"]).groupBy("_k1", "_k2").agg(F.first("_row").alias("r"))
    return kept.select(*[F.col("r")[c].alias(c) for c in docs.columns])


def held_out(doc_id: str, folds: int) -> Column:
    """Whether crc32 of the id as text leaves remainder 0; rows without an id are held out."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(folds)) == 0, F.lit(True))


def drop_table(df: DataFrame) -> None:
    """Remove the files behind a table that ``cut`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if "/cut-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def lean(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``function`` for ``mapInArrow``, after which the worker returns its freed memory to the
    system. Spark keeps workers for later tasks; what one task needed would else stay with them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return run


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that texts are Python objects and output a few at a time."""
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def text_column(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """Texts as UTF-8; null as empty."""
    return [b"" if v is None else v.encode() for v in batch.column(name).to_pylist()]


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple]:
    """``(table, starts)`` of whole groups from batches sorted by numeric ``keys``.

    ``starts`` holds the first row of each group and, last, the number of rows."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = last is not None and any(c[0] != v for c, v in zip(cols, last, strict=True))
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        last = [c[-1] for c in cols]
        at = np.nonzero(change)[0]
        if not at.size:
            held.append(batch)
            continue
        done = [*held, batch.slice(0, at[-1])]
        held = [batch.slice(at[-1])]
        table = pa.Table.from_batches([b for b in done if b.num_rows])
        if table.num_rows:
            yield table, group_starts(table, keys)
    if held:
        table = pa.Table.from_batches(held)
        yield table, group_starts(table, keys)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.ones(table.num_rows, bool)
    change[1:] = False
    for k in keys:
        c = table.column(k).to_numpy()
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.nonzero(change)[0], table.num_rows)


def chunk_pairs(df: DataFrame, keys: list[str], uid: str, size: int) -> DataFrame:
    """Rows of keys with two rows or more, placed so that any two of a key meet once.

    Keys of up to ``size`` rows stay whole (``_i = _j = 0``). Larger ones are cut by a hash of
    ``uid`` into chunks; a row of chunk ``_c`` goes to each pair ``_i <= _j`` of chunks that its
    own belongs to. The counts are joined by key; Spark splits the rows of a hot key."""
    sizes = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
             .withColumn("_n", F.ceil(F.col("_n") / size).cast("int")))
    own = F.pmod(F.xxhash64(uid), F.col("_n")).cast("int")
    rows = df.join(sizes, keys).withColumn("_c", own)
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    return (rows.withColumn("_o", other)
            .withColumns({"_i": F.least("_c", "_o"), "_j": F.greatest("_c", "_o")})
            .drop("_n", "_o"))


def sorted_groups(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Groups placed by key and sorted inside partitions."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that each of ``n`` items reaches over the links ``a - b``."""
    label = np.arange(n)
    while a.size:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``: the least node it reaches.

    Alternating star steps: each node hands its larger, then its smaller neighbours to its least
    one. A round is two aggregations and joins of links; its result is a table in the shared
    folder, so nothing gathers on the driver and a lost executor costs one round. A node with
    very many links is pre-aggregated and its join is split by Spark."""
    links = cut(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lower, "a").where("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        turned = cut(small.unionAll(lower.select("a", F.col("m").alias("b"))).distinct())
        state = turned.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                           ).first()
        drop_table(links)
        links = turned
        if state == seen:
            break
        seen = state
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(roots.select("root", "root").distinct().toDF("node", "root"))
