"""Rosters, identifiers and enrolment: id resolution, athlete cards, sport rosters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import (blank_to_null, day_of, int_of, iso, present, to_day, to_int,
                                 whole_years)
from ..functions.text import first_listed, flat_label
from ..plans.shapes import latest

# Sport ids.
SPORTS = {1: "Athletics", 2: "Fencing", 3: "Padel", 4: "Squash", 5: "Table Tennis",
          6: "Swimming", 7: "Shooting"}


def sport_name(sport_id: Column, sports: dict[int, str] | None = None) -> Column:
    table = F.create_map(*[F.lit(x) for kv in (sports or SPORTS).items() for x in kv])
    return F.try_element_at(table, sport_id.cast("int"))


# --- identifiers -----------------------------------------------------------------------------

def _key_text(c: Column) -> Column:
    s = F.trim(c.cast("string"))
    return F.when(~s.isin("", "None"), s)


def one_per(df: DataFrame, key: Column, name: str, order: list[Column],
            newest: bool = True) -> DataFrame:
    """One row per non-null key, by ``order``, without a window."""
    keyed = df.withColumn(name, key).where(F.col(name).isNotNull())
    return latest(keyed, [name], order, columns=df.columns, newest=newest)


def resolve_ids(requests: DataFrame, identifiers: DataFrame, *, player: str = "player_id",
                mrn: str = "mrn", order: list[str] | None = None) -> DataFrame:
    """Identifier rows for requested athletes: by player id first, by MRN where that misses.

    All identifier columns are added (NULL when unresolved) with ``resolved_by``."""
    cols = identifiers.columns
    tie = [F.col(c) for c in (order or cols)]
    by_player = one_per(identifiers, to_int("sams_player_id").cast("long"), "_pid", tie,
                        newest=False).select("_pid", F.struct(*cols).alias("_a"))
    by_mrn = one_per(identifiers, _key_text(F.col("sams_mrn")), "_mrn", tie,
                     newest=False).select("_mrn", F.struct(*cols).alias("_b"))
    asked = requests.withColumns({"_want": to_int(F.col(player)).cast("long"),
                                  "_wantmrn": _key_text(F.col(mrn))})
    joined = (asked.join(by_player, F.col("_want") == F.col("_pid"), "left")
              .join(by_mrn, F.col("_wantmrn") == F.col("_mrn"), "left"))
    how = F.when(F.col("_a").isNotNull(), "player_id").when(F.col("_b").isNotNull(), "mrn")
    row = F.coalesce("_a", "_b")
    return joined.select(*requests.columns, how.alias("resolved_by"),
                         *[row[c].alias(c) for c in cols if c not in requests.columns])


def device_ids(df: DataFrame, *names: str) -> DataFrame:
    """Blank and zero ids become NULL."""
    return df.withColumns({n: blank_to_null(n) for n in names})


def identifiers_by_mrn(identifiers: DataFrame, seq: str | None = None) -> DataFrame:
    """One identifier row per non-blank MRN; of several, the last by ``seq``."""
    order = [F.col(seq)] if seq else [F.col(c) for c in identifiers.columns]
    return one_per(identifiers, _key_text(F.col("sams_mrn")), "mrn_key", order)


def athletes_by_mrn(wanted: DataFrame, players: DataFrame, *, mrn: str = "mrn") -> DataFrame:
    """The player row whose trimmed MRN equals the wanted one; wanted MRNs without one stay."""
    one = one_per(players.where(F.col("playerId").isNotNull()), _key_text(F.col("mrn")),
                  "_mrn", [F.col("playerId")], newest=False)
    asked = wanted.select(_key_text(F.col(mrn)).alias("wanted_mrn")).where(
        F.col("wanted_mrn").isNotNull()).distinct()
    return asked.join(one, asked["wanted_mrn"] == one["_mrn"], "left").drop("_mrn")


# --- roster projections ----------------------------------------------------------------------

def _any(df: DataFrame, *names: str) -> Column:
    found = [present(n) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def picker_rows(players: DataFrame, sports: dict[int, str] | None = None,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """The picker shape of player rows; rows without a player id are dropped."""
    rows = players.where(int_of(players, "playerId").isNotNull())
    sport = int_of(players, "sportId")
    return rows.select(
        int_of(players, "playerId").alias("player_id"),
        F.coalesce(_any(players, "fullName", "playerName", "name"), F.lit("")).alias("full_name"),
        (F.col("arabicName") if "arabicName" in players.columns
         else F.lit(None).cast("string")).alias("arabic_name"),
        F.col("mrn").cast("string").alias("mrn"), sport.alias("sport_id"),
        sport_name(sport, sports).alias("sport"),
        _any(players, "imageUrl", "profileImageUrl").alias("photo_url"),
        (F.col("isActive") if "isActive" in players.columns
         else F.lit(None).cast("boolean")).alias("is_active"), *keep)


def search_players(players: DataFrame, text: str = "", *, limit: int | None = None,
                   active_only: bool = True, sports: dict[int, str] | None = None) -> DataFrame:
    """Active players whose name or MRN contains the text, by name, first ``limit``."""
    hits = picker_rows(players, sports)
    if active_only:
        hits = hits.where(F.col("is_active").eqNullSafe(F.lit(True)))
    if text.strip():
        needle = text.strip().lower()
        hits = hits.where(F.lower("full_name").contains(needle)
                          | F.coalesce(F.lower("mrn").contains(needle), F.lit(False)))
    hits = hits.orderBy(F.lower("full_name"), "player_id")
    return hits if limit is None else hits.limit(limit)


def link_roster(players: DataFrame) -> DataFrame:
    """Named players in the shape record linkage takes."""
    rows = players.where((int_of(players, "playerId") != 0) & present("fullName").isNotNull())
    return rows.select(int_of(players, "playerId").alias("player_id"),
                       F.col("fullName").alias("full_name"), F.col("dateOfBirth").alias("dob"),
                       F.col("currentSportName").alias("sport"),
                       F.col("mrn").cast("string").alias("mrn"),
                       F.col("profileImageUrl").alias("photo_url"))


def context_rows(players: DataFrame, as_of: Column,
                 sports: dict[int, str] | None = None) -> DataFrame:
    """The context shape: birth date, age at ``as_of``, sex, sport, pathway flag."""
    born = to_day(F.substring_index(F.col("dateOfBirth").cast("string"), "T", 1))
    sport = int_of(players, "sportId")
    pathway = F.col("pathway") if "pathway" in players.columns else F.lit(None).cast("string")
    return players.where(int_of(players, "playerId").isNotNull()).select(
        int_of(players, "playerId").alias("player_id"), F.col("mrn").cast("string").alias("mrn"),
        F.coalesce(present("fullName"), F.lit("")).alias("full_name"),
        (F.col("arabicName") if "arabicName" in players.columns
         else F.lit(None).cast("string")).alias("arabic_name"),
        iso(born).alias("date_of_birth"), whole_years(born, as_of).alias("age"),
        flat_label("gender").alias("sex"), sport.alias("sport_id"),
        sport_name(sport, sports).alias("sport"),
        _any(players, "profileImageUrl", "imageUrl").alias("photo_url"),
        (F.col("isActive") if "isActive" in players.columns
         else F.lit(None).cast("boolean")).alias("is_active"), pathway.alias("pathway"),
        F.when(present(pathway).isNotNull(), pathway == "Target").alias("is_target"))


# --- enrolment -------------------------------------------------------------------------------

def current_enrollment(periods: DataFrame, *, tie: list[str] | None = None) -> DataFrame:
    """One open period per athlete: a primary one first, else the latest start."""
    open_rows = periods.where(F.coalesce(F.col("endDate").cast("string"), F.lit("")) == "")
    order = [F.coalesce(F.col("isPrimary").cast("string").try_cast("boolean"), F.lit(False)),
             F.coalesce(F.col("startDate").cast("string"), F.lit("")),
             *[F.col(c) for c in (tie or [])]]
    return latest(open_rows, ["playerId"], order)


def athlete_cards(contexts: DataFrame, enrollment: DataFrame,
                  sports: dict[int, str] | None = None) -> DataFrame:
    """Context rows with sport, discipline, target event and coach of the current enrolment."""
    e = enrollment.select(
        to_int("playerId").alias("_pid"), to_int("sportId").alias("_sid"),
        present("sportName").alias("_sname"), F.col("disciplineId").alias("discipline_id"),
        flat_label("disciplineName").alias("discipline"),
        first_listed("targetEventNames").alias("target_event"),
        F.col("targetEventNames").alias("target_event_raw"),
        F.col("playerTypeName").alias("player_type"), F.col("coachName").alias("coach_name"))
    joined = contexts.join(e, contexts["player_id"] == e["_pid"], "left")
    has = F.col("_sid").isNotNull()
    named = F.coalesce(F.col("_sname"), sport_name(F.col("_sid"), sports), F.col("sport"))
    return joined.withColumns({
        "sport": F.when(has, named).otherwise(F.col("sport")),
        "sport_id": F.coalesce(F.col("_sid"), F.col("sport_id"))}).drop("_pid", "_sid", "_sname")


def sport_roster(plans: DataFrame, plan_players: DataFrame, as_of: Column, *,
                 sport_id: int | None = None, committee_id: int | None = None,
                 days_back: int = 60, sports: dict[int, str] | None = None) -> DataFrame:
    """Distinct athletes on the training plans of the last ``days_back`` days.

    Each athlete keeps the row of the newest plan; with no ``sport_id`` every plan sport gets its
    roster."""
    day = day_of(plans, "TrainingDate")
    rows = plans.where(day.between(F.date_sub(as_of, days_back - 1), as_of)
                       & F.col("trainingPlanId").isNotNull())
    if sport_id is not None:
        rows = rows.where(F.col("SportId") == sport_id)
    if committee_id is not None:
        rows = rows.where(F.col("CommitteeId") == committee_id)
    kept = rows.select(F.col("trainingPlanId").alias("_plan"), day.alias("_day"),
                       F.col("SportId").alias("plan_sport_id"))
    on_plan = plan_players.where(
        int_of(plan_players, "playerId") != 0).join(
        kept, plan_players["trainingPlanId"] == kept["_plan"])
    newest = latest(on_plan.drop("_plan"), ["plan_sport_id", "playerId"],
                    [F.col("_day"), F.col("trainingPlanId")],
                    columns=[c for c in plan_players.columns])
    return picker_rows(newest, sports, keep=("plan_sport_id",))


def find_either(df: DataFrame, needle: str, first: str, second: str) -> DataFrame:
    """Rows where either column equals the text without regard to case."""
    n = needle.strip().lower()
    return df.where((F.lower(first) == n) | (F.lower(second) == n))
