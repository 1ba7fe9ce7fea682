"""Versioned datasets: every publication is a new immutable directory listed in a manifest.

The manifest row is appended last, by Spark's own commit protocol: a failed or repeated write
leaves the published version as it was. Manifests hold one short row per publication.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

MANIFEST = ("name string, version string, path string, kind string, rows bigint, title string, "
            "description string")


def full_name(name: str, owner: str) -> str:
    """``owner/name`` as is; a bare name gets the owner in front."""
    return name if "/" in name else f"{owner}/{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def claim(spark: SparkSession, folder: str, first: int = 1) -> int:
    """The least number from ``first`` on that is above all taken ones, taken by creating its file
    exclusively: two writers never get the same one.

    One listing tells where to start, so only writers that meet try more than once. The store must
    create files exclusively, as file systems do; not every object store does."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    taken = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    number = max([first, *[int(n) + 1 for n in taken if n.isdigit()]])
    while not fs.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{number:012d}")):
        number += 1
    return number


class VersionedStore:
    """Datasets under one shared root, published by name."""

    def __init__(self, spark: SparkSession, root: str, owner: str):
        self.spark, self.root, self.owner = spark, root.rstrip("/"), owner

    def publish(self, df: DataFrame, name: str, *, title: str | None = None,
                description: str | None = None, kind: str = "csv") -> dict:
        """Write a new version and make it the latest: ``{name, version, rows}``."""
        full = full_name(name, self.owner)
        stamp = datetime.now(UTC).strftime("%Y%m%dT%H%M%S%fZ")
        version = f"{stamp}-{uuid.uuid4().hex[:5]}"
        path = f"{self.root}/{full}/version={version}"
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = counted.write.mode("errorifexists")
        if kind == "csv":
            writer.option("header", True).csv(path)
        else:
            writer.format(kind).save(path)
        rows = seen.get["rows"]
        entry = self.spark.createDataFrame(
            [(full, version, path, kind, rows, title, description)], MANIFEST)
        entry.coalesce(1).write.mode("append").json(f"{self.root}/_manifest")
        return {"name": full, "version": version, "rows": rows}

    def manifest(self) -> DataFrame:
        path = f"{self.root}/_manifest"
        if not _exists(self.spark, path):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).json(path)

    def read(self, name: str, version: str | None = None, schema: str | None = None,
             complete: bool = False) -> DataFrame:
        """The latest version, or the one named.

        ``complete`` counts what there is to read (from file footers, where a format has them) and
        fails if it is not as many rows as were published."""
        rows = self.manifest().where(F.col("name") == full_name(name, self.owner))
        if version is not None:
            rows = rows.where(F.col("version") == version)
        found = rows.orderBy(F.desc("version")).limit(1).collect()
        if not found:
            raise LookupError(f"no published version of {name}")
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        if found[0]["kind"] == "csv":
            reader = reader.option("header", True)
            if schema is None:
                reader = reader.option("inferSchema", True)
        rows = reader.format(found[0]["kind"]).load(found[0]["path"])
        if complete and (n := rows.count()) != found[0]["rows"]:
            raise ValueError(f"{n} of {found[0]['rows']} rows of {name} are there")
        return rows
