from __future__ import annotations

import random
from decimal import Decimal

from pyspark.sql import functions as F

from perfspark.operators import roster, stock

MOVE = "product_id string, quantity string"


def test_on_hand_and_catalogue(spark):
    receipts = spark.createDataFrame([("1", "2"), ("1", "3.5"), ("2", "bad"), ("x", "9")], MOVE)
    given = spark.createDataFrame([("1", "1"), ("3", "4")], MOVE)
    got = {r.product_id: r.on_hand for r in stock.on_hand(receipts, given).collect()}
    assert got == {1: 4.5, 2: 0.0, 3: -4.0}
    products = spark.createDataFrame(
        [(1, "Zinc", "B", "g", 1), (2, "Iron", None, "", None), (4, "Old", "C", "g", 0)],
        "id int, name string, brand string, unit string, active int")
    rows = stock.catalogue(products, receipts, given).collect()
    assert [(r.label, r.on_hand) for r in rows] == [("Zinc B (g)", 4.5), ("Iron", 0.0)]
    assert stock.catalogue(products, receipts, given, active_only=False).count() == 3


def test_history(spark):
    given = spark.createDataFrame([(7, 1, "2026-01-01"), (7, 9, "2026-02-01"), (8, 1, None)],
                                  "sams_player_id int, product_id int, assigned_at string")
    products = spark.createDataFrame([(1, "Zinc")], "id int, name string")
    rows = stock.issue_history(given, products, players=[7]).collect()
    assert [r.product_name for r in rows] == [None, "Zinc"]


REQUEST = "request_id long, product_id int, quantity double, requested_at timestamp"


def _requests(spark, rows):
    df = spark.createDataFrame([(i, p, float(q), d) for i, (p, q, d) in enumerate(rows)],
                               "request_id long, product_id int, quantity double, day int")
    at = F.timestamp_add("MINUTE", F.col("day") * 700, F.lit("2026-01-01").cast("timestamp"))
    return df.withColumn("requested_at", at).drop("day")


def test_issue_guard(spark):
    left = spark.createDataFrame([(1, 5.0)], "product_id int, on_hand double")
    out = stock.issue(_requests(spark, [(1, 3, 0), (1, 4, 1), (1, 2, 2), (1, 0, 3), (2, 1, 4)]), left)
    got = {r.request_id: (r.accepted, r.reason) for r in out.collect()}
    assert [got[i][0] for i in range(5)] == [True, False, True, False, False]
    assert got[3][1] == "quantity must be greater than zero" and got[4][1] == "not enough in stock"
    free = stock.issue(_requests(spark, [(1, 9, 0), (1, -1, 1)]), left, allow_negative=True)
    assert [r.accepted for r in free.orderBy("request_id").collect()] == [True, False]


def test_issue_against_brute_force(spark):
    """One product takes most requests; several requests share a time."""
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.choice([0.5, 1, 2, 5, 30, 90]), rng.randint(0, 40))
            for _ in range(400)]
    have = {1: 150.0, 2: 10.0, 3: 1000.0}
    left, want = dict(have), {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][2], i)):
        p, q, _ = rows[i]
        want[i] = 0 < q <= left[p]
        left[p] -= q if want[i] else 0
    base = spark.createDataFrame(list(have.items()), "product_id int, on_hand double")
    for few in (512, 20, 0):
        out = stock.issue(_requests(spark, rows), base, few=few)
        assert {r.request_id: r.accepted for r in out.collect()} == want


def test_issue_of_odd_quantities_and_times(spark):
    """Requests without a time come first, quantities finer than the fixed point take a step of it
    and ones beyond it are larger than any stock."""
    rng = random.Random(5)
    rows = [(1, rng.choice([1e-18, 0.1, 0.7, 3.3, 1e300]), rng.choice([None, *range(9)]))
            for _ in range(120)]
    left, want = Decimal(12), {}
    for i in sorted(range(len(rows)), key=lambda i: (-1 if rows[i][2] is None else rows[i][2], i)):
        q = max(Decimal(str(rows[i][1])), Decimal("1e-15"))
        want[i] = q <= left
        left -= q if want[i] else 0
    base = spark.createDataFrame([(1, 12.0)], "product_id int, on_hand double")
    for few in (512, 0):
        out = stock.issue(_requests(spark, rows), base, few=few)
        assert {r.request_id: r.accepted for r in out.collect()} == want


PLAYER = ("playerId int, fullName string, mrn string, sportId int, isActive boolean, "
          "dateOfBirth string, gender string, pathway string")


def players(spark):
    return spark.createDataFrame([
        (1, "Zoe Z", "11", 1, True, "2000-02-29T00:00:00", '{"name": "Female"}', "Target"),
        (2, "adam A", "22", 6, True, "bad", "Male", None),
        (3, "Gone G", "33", 2, False, None, None, "Dev"),
        (None, "No id", "44", 2, True, None, None, None)], PLAYER)


def test_picker_and_context(spark):
    hits = roster.search_players(players(spark)).collect()
    assert [(h.player_id, h.sport) for h in hits] == [(2, "Swimming"), (1, "Athletics")]
    assert [h.player_id for h in roster.search_players(players(spark), "zoe").collect()] == [1]
    ctx = {r.player_id: r for r in roster.context_rows(
        players(spark), F.lit("2024-02-28").cast("date")).collect()}
    assert (ctx[1].age, ctx[1].sex, ctx[1].is_target, ctx[1].date_of_birth) == (23, "Female", True, "2000-02-29")
    assert (ctx[2].age, ctx[2].sex, ctx[2].is_target) == (None, "Male", None) and ctx[3].is_target is False


PERIOD = ("playerId int, isPrimary boolean, startDate string, endDate string, sportId int, "
          "sportName string, disciplineId int, disciplineName string, targetEventNames string, "
          "playerTypeName string, coachName string")


def test_enrollment_and_cards(spark):
    periods = spark.createDataFrame([
        (1, False, "2024-01-01", "", 2, "Fencing", 1, "Foil", "Foil", "t", "c"),
        (1, True, "2020-01-01", None, 6, "Swim", 2, '{"name": "Free"}', "TBD, 100m", "t", "c"),
        (1, True, "2025-01-01", "2025-06-01", 3, "Padel", 3, "x", "x", "t", "c"),
        (2, None, "2024-01-01", None, 7, "", 4, "d", "TBD", "t", "c"),
        (2, False, "2023-01-01", "", 1, "A", 5, "d", "x", "t", "c")], PERIOD)
    current = roster.current_enrollment(periods)
    assert {r.playerId: r.disciplineId for r in current.collect()} == {1: 2, 2: 4}
    ctx = roster.context_rows(players(spark), F.lit("2024-02-28").cast("date"))
    cards = {r.player_id: r for r in roster.athlete_cards(ctx, current).collect()}
    assert (cards[1].sport, cards[1].discipline, cards[1].target_event) == ("Swim", "Free", "100m")
    assert (cards[2].sport, cards[2].sport_id, cards[2].target_event) == ("Shooting", 7, None)
    assert (cards[3].sport, cards[3].discipline) == ("Fencing", None)


def test_sport_roster(spark):
    plans = spark.createDataFrame([(1, 1, "2024-01-10", 2), (2, 1, "2024-01-20", 2), (3, 2, "2024-01-20", 2),
                                   (4, 1, "2023-01-01", 2), (5, 1, "2024-01-20", 4)],
                                  "trainingPlanId int, SportId int, TrainingDate string, CommitteeId int")
    on = spark.createDataFrame([(1, 7, "Old name", "m"), (2, 7, "New name", "m"), (2, 8, "alan", "m"),
                                (3, 9, "Other", "m"), (4, 10, "Late", "m"), (2, None, "x", "m"), (5, 11, "Ext", "m")],
                               "trainingPlanId int, playerId int, fullName string, mrn string").withColumn(
        "sportId", F.lit(1))
    out = roster.sport_roster(plans, on, F.lit("2024-01-31").cast("date"), sport_id=1, committee_id=2)
    assert {(r.player_id, r.full_name) for r in out.collect()} == {(7, "New name"), (8, "alan")}
    both = roster.sport_roster(plans, on, F.lit("2024-01-31").cast("date"))
    assert {(r.plan_sport_id, r.player_id) for r in both.collect()} == {(1, 7), (1, 8), (1, 11), (2, 9)}


def test_identifiers(spark):
    ids = spark.createDataFrame([("1", "m1", "Ann"), ("2", "m2", "Bob"), ("x", "", "Eve"), ("3", None, "Kim")],
                                "sams_player_id string, sams_mrn string, sams_name string")
    asked = spark.createDataFrame([("1", "m2"), ("9", "m2"), ("bad", " m1 "), (None, "None"), ("", "")],
                                  "player_id string, mrn string")
    got = {(r.player_id, r.mrn): (r.resolved_by, r.sams_name) for r in roster.resolve_ids(asked, ids).collect()}
    assert got == {("1", "m2"): ("player_id", "Ann"), ("9", "m2"): ("mrn", "Bob"),
                   ("bad", " m1 "): ("mrn", "Ann"), (None, "None"): (None, None), ("", ""): (None, None)}
    assert {r.mrn_key for r in roster.identifiers_by_mrn(ids).collect()} == {"m1", "m2"}
    mrns = spark.createDataFrame([(" 11 ",), ("99",), ("",)], "mrn string")
    found = {r.wanted_mrn: r.playerId for r in roster.athletes_by_mrn(mrns, players(spark)).collect()}
    assert found == {"11": 1, "99": None}


def test_link_roster_and_find(spark):
    rows = players(spark).withColumns({"currentSportName": F.lit("Swimming"),
                                       "profileImageUrl": F.lit("u")})
    assert {r.player_id for r in roster.link_roster(rows).collect()} == {1, 2, 3}
    users = spark.createDataFrame([("Ann", "ann@x"), ("Bob", "b@x")], "username string, email string")
    assert roster.find_either(users, " ANN@X ", "username", "email").first().username == "Ann"
