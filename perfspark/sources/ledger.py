"""Append-only ledger of human decisions; the last decision of a name counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.shapes import latest
from .versions import _exists, claim

LEDGER = ("source_name string, sams_id int, decision string, decided_on string, seq bigint, "
          "batch bigint")
# The decisions there are.
DECISIONS = ("yes", "no", "drop")


class DecisionLedger:
    """Decisions under a shared directory."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        if not _exists(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).csv(self.path, header=True)

    def record(self, name: str, sams_id: int | None, decision: str,
               decided_on: str | date) -> None:
        """Append one decision."""
        row = [(name, sams_id, decision, str(decided_on))]
        self.record_all(self.spark.createDataFrame(
            row, "source_name string, sams_id int, decision string, decided_on string"))

    def record_all(self, decisions: DataFrame) -> None:
        """Append decisions; an unknown decision fails before anything is written. A ``seq``
        column in the input orders decisions of one call on the same name; calls are ordered by
        a number that each claims for itself."""
        said = F.lower(F.trim("decision"))
        checked = F.when(said.isin(*DECISIONS), said).otherwise(
            F.raise_error(F.concat(F.lit("not a decision: "), F.coalesce("decision", F.lit("")))))
        order = F.col("seq") if "seq" in decisions.columns else F.lit(1)
        rows = decisions.select("source_name", F.col("sams_id").cast("int").alias("sams_id"),
                                checked.alias("decision"), "decided_on",
                                order.cast("bigint").alias("seq"),
                                F.lit(claim(self.spark, f"{self.path}-claims")).alias("batch"))
        rows.write.mode("append").csv(self.path, header=True)

    def decisions(self) -> DataFrame:
        """One row per name: its last decision."""
        return last_decisions(self.entries())


def last_decisions(entries: DataFrame, order: tuple[str, ...] = ("batch", "seq")) -> DataFrame:
    """The last decision per name."""
    return latest(entries, ["source_name"], [F.col(c) for c in order])
