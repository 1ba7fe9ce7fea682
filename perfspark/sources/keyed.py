"""Keyed tables: idempotent upserts and replacement of a parent's children.

A write never touches what is already there. It claims a number nobody else can get, stages its
rows in a folder of that number and commits by creating one small file; readers keep the newest
number of each key. All live folders are one scan. Generations have levels: once a level holds more
than ``fold`` of them, a write folds these into one of the next level, whose rows keep their
numbers. So a row is rewritten once a level, as often as the logarithm of the number of writes,
neither plans nor listings grow, and a slower writer with a smaller number still finds its place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.ids import META_COLUMNS
from ..session import cut
from .versions import _exists, claim

# Identity columns every ingest target starts with, and whether they may be NULL.
META_HEAD = [("row_uid", T.StringType(), False), ("event_uuid", T.StringType(), False),
             ("group_uuid", T.StringType(), True), ("record_date", T.DateType(), True),
             ("source_name", T.StringType(), True), ("entered_by", T.StringType(), True),
             ("sams_id", T.IntegerType(), True), ("sams_name", T.StringType(), True),
             ("match_verdict", T.StringType(), True), ("match_confidence", T.IntegerType(), True)]


def target_schema(columns: dict[str, str]) -> T.StructType:
    """The identity head followed by typed data columns."""
    fields = [T.StructField(n, t, null) for n, t, null in META_HEAD]
    fields += [T.StructField(c, T.DoubleType() if t == "DOUBLE" else T.StringType(), True)
               for c, t in columns.items() if c not in META_COLUMNS]
    return T.StructType(fields)


def create_statement(table: str, columns: dict[str, str]) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with the identity head and the data columns."""
    lines = [f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
             for f in target_schema(columns).fields]
    lines += ["`created_at` timestamp", "`updated_at` timestamp"]
    return f"CREATE TABLE IF NOT EXISTS {table} (\n  " + ",\n  ".join(lines) + "\n) USING parquet"


def merge_latest(generations: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Newest row per key; a partially aggregated ``max_by``, no window."""
    names = [c for c in generations.columns if c not in keys]
    rows = generations.groupBy(*keys).agg(
        F.max_by(F.struct(*names), F.struct(*order)).alias("_row"))
    return rows.select(*keys, *[F.col("_row")[n].alias(n) for n in names])


def split_keys(batch: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(writable rows, rejected rows with a reason)``: a key with a NULL part, or one that a
    batch brings more than once, cannot be upserted."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    counts = batch.where(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # Written, so that Spark knows how few they are and does not move the batch to meet them.
    repeated = cut(counts.where(F.col("_n") > 1).select(*keys))
    good = batch.where(whole).join(repeated, keys, "left_anti")
    bad = (batch.where(~whole).withColumn("reject_reason", F.lit("null key"))
           .unionByName(batch.where(whole).join(repeated, keys, "left_semi")
                        .withColumn("reject_reason", F.lit("duplicate key in batch"))))
    return good, bad


class KeyedTable:
    """A table of generations under a shared directory."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], fold: int = 16):
        self.spark, self.root, self.keys, self.fold = spark, root.rstrip("/"), keys, fold

    # -- commits: ``_commits/<number>`` or, for a folded generation, ``_commits/<number>-<folded
    # numbers>-<level>``, so that a listing of names tells all there is to know.

    def _levels(self) -> dict[int, int]:
        """Levels of the committed generations that no other one has folded in."""
        path = f"{self.root}/_commits"
        if not _exists(self.spark, path):
            return {}
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        levels, folded = {}, set()
        for status in fs.listStatus(folder):
            number, old, level = [*status.getPath().getName().split("-"), "", "0"][:3]
            levels[int(number)] = int(level or 0)
            folded |= {int(x) for x in old.split("_") if x}
        return {n: levels[n] for n in sorted(levels) if n not in folded}

    def _live(self) -> list[int]:
        return list(self._levels())

    def _claim(self) -> int:
        live = self._live()
        return claim(self.spark, f"{self.root}/_claims", live[-1] + 1 if live else 1)

    def _stage(self, df: DataFrame, gen: int, kind: str = "rows") -> None:
        numbered = df if "_gen" in df.columns else df.withColumn("_gen", F.lit(gen).cast("long"))
        numbered.write.mode("overwrite").parquet(f"{self.root}/{kind}/{gen:012d}")

    def _commit(self, gen: int, folded: list[int] | None = None, level: int = 0) -> None:
        name = f"{gen:012d}" + (f"-{'_'.join(map(str, folded))}-{level}" if folded else "")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_commits/{name}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.create(path, False).close()
        if folded:  # the new commit is there: the names of the old ones say nothing more
            for status in fs.listStatus(path.getParent()):
                if int(status.getPath().getName().partition("-")[0]) in folded:
                    fs.delete(status.getPath(), False)

    def _stacked(self, live: list[int], kind: str = "rows") -> DataFrame:
        """The generations as one scan; ``_gen`` is the number a row was written under."""
        if not live:
            raise LookupError(f"nothing written under {self.root}")
        return self.spark.read.option("mergeSchema", True).parquet(
            *[f"{self.root}/{kind}/{gen:012d}" for gen in live])

    def _write(self, rows: DataFrame) -> None:
        gen = self._claim()
        self._stage(rows, gen)
        self._commit(gen)
        self._fold_if_many()

    def _fold_if_many(self) -> None:
        """Fold every level that holds more than ``fold`` generations, the lowest first."""
        level, levels = 0, self._levels()
        while levels and level <= max(levels.values()):
            own = [n for n, at in levels.items() if at == level]
            if len(own) > self.fold:
                self._merge(own, level + 1)
                levels = self._levels()
            level += 1

    # -- upsert

    def upsert(self, batch: DataFrame, stands: str | None = None) -> DataFrame:
        """Insert new keys and overwrite known ones. Returns the rejected rows.

        ``stands`` names a column of the batch that is true for rows which the table holds as they
        are: their keys are checked like all others, but they are not written again."""
        good, bad = split_keys(batch, self.keys)
        if stands is not None:
            good, bad = good.where(~F.col(stands)).drop(stands), bad.drop(stands)
        self._write(good)
        return bad

    def _order(self) -> list[Column]:
        return [F.col("_gen")]

    def _current(self, live: list[int]) -> DataFrame:
        return merge_latest(self._stacked(live), self.keys, self._order())

    def read(self) -> DataFrame:
        """The current rows."""
        return self._current(self._live()).drop("_gen")

    def compact(self) -> None:
        """Fold all live generations into one."""
        levels = self._levels()
        self._merge(list(levels), max(levels.values(), default=0))

    def _merge(self, some: list[int], level: int) -> None:
        """Fold some generations into one. What is newest in any of them, by number or by the
        order of the table, is all that can be newest over all."""
        gen = self._claim()
        self._stage(self._current(some), gen)
        self._commit(gen, some, level)


class ChildTable(KeyedTable):
    """Child rows owned by a parent key; a parent's children are replaced as a whole."""

    def __init__(self, spark: SparkSession, root: str, parent: str, fold: int = 16):
        super().__init__(spark, root, [parent], fold)

    def replace(self, rows: DataFrame, parents: DataFrame) -> None:
        """Replace the children of the listed parents. A parent listed without rows loses its
        children; when staging fails, the children there stay."""
        gen, parent = self._claim(), self.keys[0]
        listed = parents.select(parent).distinct()
        self._stage(rows.join(listed, parent, "left_semi"), gen)
        self._stage(listed, gen, "parents")
        self._commit(gen)
        self._fold_if_many()

    def _marks(self, live: list[int]) -> DataFrame:
        return self._stacked(live, "parents").groupBy(self.keys[0]).agg(
            F.max("_gen").alias("_gen"))

    def _current(self, live: list[int]) -> DataFrame:
        """Children of each parent's newest generation."""
        return newest_generation(self._stacked(live), self._marks(live), self.keys[0])

    def _merge(self, some: list[int], level: int) -> None:
        gen = self._claim()
        self._stage(self._current(some), gen)
        self._stage(self._marks(some), gen, "parents")
        self._commit(gen, some, level)


def newest_generation(rows: DataFrame, marks: DataFrame, parent: str) -> DataFrame:
    """Rows that belong to their parent's last generation (``_gen``)."""
    last = marks.select(parent, F.col("_gen").alias("_last"))
    return (rows.join(last, parent, "left")
            .where(F.col("_last").isNull() | (F.col("_gen") >= F.col("_last"))).drop("_last"))


def replace_children(current: DataFrame, replacement: DataFrame, parents: DataFrame,
                     parent: str) -> DataFrame:
    """The table after replacing the children of the listed parents."""
    listed = parents.select(parent).distinct()
    return current.join(listed, parent, "left_anti").unionByName(
        replacement.join(listed, parent, "left_semi"), allowMissingColumns=True)
