"""Skeletal age and maturity: per-assessment values, latest assessment, history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.maturity import growth_phase, maturity_offset, maturity_status
from ..functions.numbers import day_of, present, to_num

#: Output column -> stored column, all parsed leniently.
MEASURES = {"current_age": "current_age", "fels": "fels", "gp": "g_p2", "tw3": "tw3",
            "tw2": "tw22", "height_cm": "height_cm",
            "predicted_adult_height": "height_prediction",
            "pct_aph": "predicted_adult_height_reached"}

OUTPUT = [*MEASURES, "maturity_offset", "maturity_status", "phv_status"]


def assessments(records: DataFrame) -> DataFrame:
    """One row per assessment. Stored statuses win; blank ones are recomputed."""
    def cell(name: str):
        return F.col(name) if name in records.columns else F.lit(None).cast("string")

    rows = records.withColumns({f"_{out}": to_num(cell(src), strip=True)
                                for out, src in MEASURES.items()})
    stored = to_num(cell("maturity_status_interim"), strip=True)
    rows = rows.withColumn("_offset", F.coalesce(
        stored, maturity_offset(F.col("_fels"), F.col("_current_age"))))
    keep = [c for c in ("sams_id", "mrn", "sams_name", "source_name") if c in records.columns]
    return rows.select(
        *keep, day_of(records, "record_date").alias("date"),
        *[F.col(f"_{out}").alias(out) for out in MEASURES],
        F.col("_offset").alias("maturity_offset"),
        F.coalesce(present(cell("maturity_status")), maturity_status(F.col("_offset")))
        .alias("maturity_status"),
        F.coalesce(present(cell("phv_predicted_height_status")), growth_phase(F.col("_pct_aph")))
        .alias("phv_status"),
        present(cell("notes")).alias("notes"))


def maturity_summary(history: DataFrame, *, key: str = "sams_id",
                     athletes: DataFrame | None = None) -> DataFrame:
    """Latest assessment and number of assessments per athlete in one aggregation.

    The history itself stays long (``assessments``). With ``athletes``, those without an
    assessment stay, flagged ``matched`` false."""
    values = [F.col(c) for c in ("date", *OUTPUT)]
    extra = [F.col("notes")] if "notes" in history.columns else []
    names = [present(c) for c in ("sams_name", "source_name") if c in history.columns]
    name = F.coalesce(*names) if names else F.lit(None).cast("string")
    out = history.groupBy(key).agg(
        F.max_by(name, F.when(name.isNotNull(), F.col("date"))).alias("athlete_name"),
        F.count(F.lit(1)).alias("n_assessments"),
        F.max_by(F.struct(*values, *extra), F.struct(*values)).alias("latest"))
    out = out.withColumns({"matched": F.lit(True), "has_data": F.lit(True)})
    if athletes is None:
        return out
    joined = athletes.select(key).distinct().join(out, key, "left")
    return joined.withColumns({"matched": F.coalesce("matched", F.lit(False)),
                               "has_data": F.coalesce("has_data", F.lit(False))})
