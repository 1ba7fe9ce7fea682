"""Load and recovery zone colours."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Display colours and zone limits.
GREY = "#94a3b8"
GREEN = "#16a34a"
RED = "#dc2626"
LOAD_AMBER = "#fbb800"
RECOVERY_AMBER = "#fbb800"


def acwr_zone(acwr: Column) -> Column:
    """Acute/chronic ratio: 0.8 to 1.3 is green, outside 0.5 to 1.5 red, the rest amber."""
    return (F.when(acwr.isNull(), GREY)
            .when(acwr.between(0.8, 1.3), GREEN)
            .when((acwr > 1.5) | (acwr < 0.5), RED)
            .otherwise(LOAD_AMBER))


def recovery_zone(score: Column) -> Column:
    """Recovery score: from 67 green, from 34 amber, below red."""
    return (F.when(score.isNull(), GREY).when(score >= 67, GREEN)
            .when(score >= 34, RECOVERY_AMBER).otherwise(RED))
