"""Row identity: natural keys to stable UUIDs, id checks, safe column names."""

from __future__ import annotations

import re
from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

#: RFC 4122 namespace for URLs.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"

SAFE_ID = "^[0-9A-Fa-f-]{8,40}$"

# Identity columns of every ingest target.
META_COLUMNS = ["row_uid", "event_uuid", "group_uuid", "record_date", "source_name",
                "entered_by", "sams_id", "sams_name", "match_verdict", "match_confidence"]
RESERVED_COLUMNS = set(META_COLUMNS) | {"id", "created_at", "updated_at"}


def uuid5(*parts: Column | str) -> Column:
    """Version-5 UUID of the parts joined by ``|``; a NULL part reads ``None``.

    The same natural key gives the same id on every run, which makes a re-run an upsert."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("None"))
             for p in parts]
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)),
                             F.encode(F.concat_ws("|", *texts), "UTF-8")))
    nibble = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex(nibble.bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def safe_id(c: Column | str) -> Column:
    """The id upper-cased when well formed, else NULL."""
    s = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(s.rlike(SAFE_ID), F.upper(s))


def split_bad_ids(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``(rows with a normalised id, rejected rows)``."""
    good = safe_id(name)
    return (df.where(good.isNotNull()).withColumn(name, good), df.where(good.isNull()))


def _plain_name(raw: str, max_len: int) -> str:
    """Letters and digits of ``raw`` in lower case, joined by underscores; ``c_`` comes first
    where no letter would."""
    joined = "_".join(re.findall("[0-9A-Za-z]+", raw)).lower()
    return (joined if joined[:1].isalpha() else f"c_{joined}")[:max_len]


def sanitize_columns(df: DataFrame, reserved: set[str] | None = None,
                     max_len: int = 60) -> DataFrame:
    """Rename columns to safe snake case.

    A name that is reserved, or that an earlier column has, gets as many ``_x`` as it takes to
    be free."""
    taken = set(RESERVED_COLUMNS if reserved is None else reserved)
    renamed: dict[int, str] = {}
    for at, plain in enumerate(_plain_name(raw, max_len) for raw in df.columns):
        spare = (plain + "_x" * k for k in count())
        renamed[at] = next(name for name in spare if name not in taken)
        taken.add(renamed[at])
    return df.toDF(*renamed.values())
