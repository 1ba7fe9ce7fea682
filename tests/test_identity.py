from __future__ import annotations

import random
import types
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from perfspark.functions import linkage
from perfspark.functions.ids import sanitize_columns, split_bad_ids, uuid5
from perfspark.functions.numbers import to_day
from perfspark.functions.similarity import lcs_pairs, token_set_ratio, token_set_scores
from perfspark.operators import identity
from perfspark.plans.blocks import _numbered

ROSTER = "player_id int, full_name string, dob string, sport string"
PEOPLE = [(2893, "Mohamed Noufal", "2005-08-14", "Athletics"),
          (3247, "Mohammed Ali", "2014-03-05", "Athletics"),
          (2892, "Anas Fadeel", "2004-01-21", "Athletics"),
          (3141, "Abderrahman Alsaleck", "1995-09-05", "Athletics"),
          (9001, "Khalid Saad", "2008-02-02", "Fencing")]
INPUT = "key string, name string, dob string, sport string"


def resolve(spark, *inputs, people=PEOPLE, scores=None):
    rows = spark.createDataFrame([(str(i), *r) for i, r in enumerate(inputs)], INPUT)
    roster = spark.createDataFrame(people, ROSTER)
    given = None if scores is None else spark.createDataFrame(
        scores, "name_a string, name_b string, score int")
    return identity.resolve_entities(rows, roster, given).orderBy("key").collect()


def test_resolver_verdicts(spark):
    got = resolve(spark, ("Mohammed Aly Abdelmonem Monsef Noufal", "2005-08-14", "Jumps"),
                  ("Mohammed Khalifa", "2004-05-01", "Athletics"),
                  ("Khalid Saad", "2008-02-02", "Athletics"),
                  ("Abderrahman Samba", "1995-09-05", "Athletics"),
                  ("Anas Meerghani Ali Fadil", "2004-01-21", "Athletics"),
                  ("Zzzzqq Nobody", None, None))
    assert (got[0].verdict, got[0].player_id) == ("auto", 2893)
    assert got[1].player_id is None and got[2].player_id is None
    assert (got[3].verdict, got[3].player_id) == ("review", None)
    assert (got[4].verdict, got[4].player_id) == ("auto", 2892)
    assert (got[5].verdict, got[5].confidence, got[5].candidate_player_id) == ("no_match", 0, None)


def test_given_scores_decide(spark):
    same_year = resolve(spark, ("Saleh Al-Sadi", "2004-06-15", "Endurance"),
                        people=[(3115, "Saeed Salem Salem", "2004-11-29", "Athletics")],
                        scores=[("Saleh Al-Sadi", "Saeed Salem Salem", 90)])
    assert (same_year[0].verdict, same_year[0].player_id) == ("review", None)
    swapped = resolve(spark, ("Khalid Bourenane", "2010-03-07", "Athletics"),
                      people=[(4001, "Mohammed Khalid Bourenane", "2010-07-03", "Athletics")],
                      scores=[("Khalid Bourenane", "Mohammed Khalid Bourenane", 84)])[0]
    assert (swapped.verdict, swapped.player_id, swapped.dob_swapped) == ("auto", 4001, True)
    close = resolve(spark, ("Anas Fadil", "2004-01-22", "Athletics"),
                    scores=[("Anas Fadil", "Anas Fadeel", 97)])[0]
    assert (close.verdict, close.player_id, close.name_score) == ("auto", 2892, 97)


def test_relations_tokens_sports(spark):
    pairs = [("2004-06-15", "2004-06-15"), ("2010-03-07", "2010-07-03"),
             ("2004-06-15", "2004-11-29"), ("2007-01-01", "2007-01-01"), (None, "2004-06-15")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(linkage.dob_relation(to_day("a"), to_day("b"))).collect()]
    assert [g.rel for g in got] == ["exact", "swapped", None, None, None]
    assert got[0].gap == 0.0 and 0.4 < got[2].gap < 0.5 and got[4].gap is None
    names = spark.createDataFrame([("Al-Sahoti Bin Saleh",)], "n string")
    assert set(names.select(linkage.name_tokens(F.col("n"))).first()[0]) == {"sahoti", "saleh"}
    sports = spark.createDataFrame([("Jumps", "Athletics"), ("Swimming", "Athletics"),
                                    ("Development 1", "Athletics")], "a string, b string")
    assert [r[0] for r in sports.select(linkage.sport_agrees(F.col("a"), F.col("b"))).collect()] == [
        True, False, None]


def test_similarity_values(spark):
    pairs = [("Mohammed Aly Abdelmonem Monsef Noufal", "Mohamed Noufal", 60.0),
             ("Mohammed Aly Abdelmonem Monsef Noufal", "Mohammed Ali", 80.0),
             ("Mohammed Khalifa", "Mohammed Ali", 80.0),
             ("Abderrahman Samba", "Abderrahman Alsaleck", 78.57),
             ("Anas Meerghani Ali Fadil", "Anas Fadeel", 57.14),
             ("Mohamed Noufal", "Mohamed Noufal", 100.0), ("", "x", 0.0), (None, "x", 0.0)]
    df = spark.createDataFrame([(a, b) for a, b, _ in pairs], "a string, b string")
    got = [round(r[0], 2) for r in df.select(token_set_ratio("a", "b")).collect()]
    assert got == [v for *_, v in pairs]


def _brute(inputs, people):
    """Four best names and everyone born the same day, for every input, one pair at a time."""
    pools = {}
    for key, name, dob, _ in inputs:
        scored = sorted((-token_set_scores([name], [n])[0], pid) for pid, n, *_ in people)
        pool = {pid for s, pid in scored[:4] if -s >= 55}
        if dob and dob[5:10] != "01-01":
            pool |= {pid for pid, _, d, _ in people if d == dob}
        pools[key] = pool
    return pools


@pytest.mark.parametrize(("seed", "outside", "planned"), [
    (1, False, False), (2, False, True), (3, True, False), (4, True, True), (5, False, True)])
def test_resolver_against_brute_force(spark, seed, outside, planned, monkeypatch):
    """Small blocks, many equal names and one birth date held by a third of the roster."""
    if planned:
        monkeypatch.setattr(identity, "FEW_PAIRS", 0)
    rng = random.Random(seed)
    words = ["ali", "omar", "noufal", "Saad", "Khalifa", "Samba", "fadeel", "Al-Sadi", "Zed", "Qi"]

    def person():
        name = " ".join(rng.sample(words, rng.choice([1, 2, 3])))
        dob = "2001-02-03" if rng.random() < 0.34 else f"200{rng.randint(0, 3)}-0{rng.randint(1, 4)}-0{rng.randint(1, 4)}"
        return name, dob, rng.choice(["Athletics", "Swimming", "Squad 1", None])

    people = [(i, *person()) for i in range(60)]
    inputs = [(str(i), *person()) for i in range(40)]
    full_inputs = spark.createDataFrame(inputs, INPUT)
    roster = spark.createDataFrame(people, ROSTER)
    pools = _brute(inputs, people)
    pairs = full_inputs.join(
        spark.createDataFrame([(k, p) for k, pool in pools.items() for p in pool], "key string, player_id int"),
        "key").join(roster.select("player_id", "full_name", F.col("dob").alias("sams_dob"),
                                  F.col("sport").alias("sams_sport")), "player_id")
    score, given = F.floor(token_set_ratio("name", "full_name")), None
    if outside:
        names = sorted({(a, n) for _, a, *_ in inputs for _, n, *_ in people})
        given = spark.createDataFrame([(a, n, rng.randint(0, 100)) for a, n in names if rng.random() < 0.4],
                                      "name_a string, name_b string, score int")
        told = given.select(F.col("name_a").alias("name"), F.col("name_b").alias("full_name"), "score")
        pairs = pairs.join(told, ["name", "full_name"], "left")
        score = F.coalesce("score", score)
    judged = identity.judge(pairs, score)
    want = {r.key: tuple(r[1:]) for r in identity.best_candidates(
        judged, fields=["player_id", "verdict", "confidence", "name_score"]).collect()}
    from perfspark.plans import blocks
    monkeypatch.setattr(blocks, "_blocks", lambda rows, size: max(1, rows // 17))
    got = {r.key: (r.candidate_player_id, r.verdict, r.confidence, r.name_score)
           for r in identity.resolve_entities(full_inputs.repartition(3), roster.repartition(5), given).collect()
           if r.verdict != "no_match"}
    assert got == want


def test_planned_search_visits_few_blocks_and_loses_nothing(spark, monkeypatch):
    """Names of many lengths and spellings; every score against all of them."""
    monkeypatch.setattr(identity, "FEW_PAIRS", 0)
    rng = random.Random(8)
    stems = ["".join(rng.choice("aeiourstnlmkbd") for _ in range(rng.randint(2, 9))) for _ in range(90)]
    people = sorted({" ".join(rng.sample(stems, rng.choice([1, 2, 2, 3]))) for _ in range(900)})
    asked = people[::9] + [n[:-1] + "x" for n in people[::40]] + ["zzz", "ali " + stems[0]]
    left = spark.createDataFrame([(n,) for n in asked], "_name string").distinct()
    right = spark.createDataFrame([(n, i) for i, n in enumerate(people)], "_full string, _first int")
    found, visits = identity.name_search(left, right, 4, 55, block_rows=16)
    got = {}
    for r in found.collect():
        got.setdefault(r._name, []).append((-round(r.score, 9), r._first))
    for name in set(asked):
        scores = token_set_scores([name] * len(people), people)
        want = sorted((-round(s, 9), i) for i, s in enumerate(scores) if s >= 55)[:4]
        assert sorted(got.get(name, [])) == want
    asked, people = ([f"{kind}#{i:06d}" for i in range(n)]
                     for kind, n in (("Supplier", 60), ("Customer", 2500)))
    found, visits = identity.name_search(
        spark.createDataFrame([(n,) for n in asked], "_name string"),
        spark.createDataFrame([(n, i) for i, n in enumerate(people)], "_full string, _first int"),
        4, 55, block_rows=16)
    got = sorted((r._name, -round(r.score, 9), r._first) for r in found.collect())
    want = [(n, *t) for n in asked for t in sorted(
        (-round(s, 9), i) for i, s in enumerate(token_set_scores([n] * 2500, people)))[:4]]
    assert got == want and visits.share() < 0.1


def test_block_bound_holds(spark):
    rng = random.Random(2)
    words = ["ali", "omar", "al", "noufal", "a", "bo", "khalifa"]
    names = [" ".join(rng.sample(words, rng.randint(1, 4))) for _ in range(40)]
    for _ in range(20):
        block = rng.sample(names, 5)
        limit = identity._block_bound(names, [identity._block_summary(block)])[:, 0]
        for name, bound in zip(names, limit, strict=True):
            assert max(token_set_scores([name] * 5, block)) <= bound + 1e-9


def test_ladder(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    names = frame([("exact one",), ("by mrn",), ("told no",), ("Anas Fadil",), ("dummy",),
                   ("told yes",), ("drop me",), ("odd no",)], "name string")
    out = identity.resolve_ladder(
        names, exact=frame([("exact one", 1, "E")], "name string, sams_player_id int, sams_name string"),
        mrns=frame([("by mrn", " 55 ")], "name string, mrn string"),
        dobs=frame([("Anas Fadil", "2004-01-21")], "name string, dob string"),
        sports=frame([("Anas Fadil", "Athletics")], "name string, sport string"),
        drops=frame([("dummy",)], "name string"),
        ledger=frame([("told no", None, "no"), ("told yes", 3391, "yes"), ("drop me", None, "drop"),
                      ("odd no", 7, "no")], "source_name string, sams_id int, decision string"),
        identifiers=frame([(55, "55", "M")], "sams_player_id int, sams_mrn string, sams_name string"),
        roster=frame(PEOPLE, ROSTER))
    got = {r.name: (r.verdict, r.sams_id, r.confidence) for r in out.collect()}
    assert got["exact one"] == ("exact", 1, 100) and got["by mrn"] == ("mrn_exact", 55, 100)
    assert got["told no"] == ("manual_rejected", None, 100)
    assert got["told yes"] == ("manual_confirmed", 3391, 100)
    assert got["odd no"] == ("manual_confirmed", 7, 100)
    assert got["dummy"] == got["drop me"] == ("dummy", None, 0)
    assert got["Anas Fadil"][:2] == ("auto", 2892)


def test_uuid5_and_columns(spark):
    df = spark.createDataFrame([("é|x", None), ("a", "b")], "a string, b string")
    for r in df.select("a", "b", uuid5("a", "b").alias("u")).collect():
        assert r.u == str(uuid.uuid5(uuid.NAMESPACE_URL, f"{r.a}|{r.b}"))
    odd = spark.createDataFrame([(1, 2, 3, 4, 5)], ["ID", "Height (cm)", "5 Bound Standing", "Tf / Tc", "tf tc"])
    assert sanitize_columns(odd).columns == ["id_x", "height_cm", "c_5_bound_standing", "tf_tc", "tf_tc_x"]
    ids = spark.createDataFrame([("abcd-1234",), ("x'; --",)], "i string")
    good, bad = split_bad_ids(ids, "i")
    assert [r.i for r in good.collect()] == ["ABCD-1234"] and bad.count() == 1


def test_only_given_pairs_born_together_travel_to_birth_dates(spark, monkeypatch):
    inputs = spark.createDataFrame([(i, f"Ann {i}", f"2001-02-{1 + i:02}", None) for i in range(5)],
                                   "key long, name string, dob string, sport string")
    roster = spark.createDataFrame([(i, f"Bea {i}", f"2001-02-{1 + i:02}", None) for i in range(9)],
                                   "player_id long, full_name string, dob string, sport string")
    given = spark.createDataFrame([(f"Ann {i}", f"Bea {j}", 90) for i in range(5) for j in range(9)],
                                  "name string, full_name string, _given int")
    lefts, within = [], identity.block_best_within
    monkeypatch.setattr(identity, "block_best_within",
                        lambda left, right, **more: lefts.append(left) or within(left, right, **more))
    pool = identity.candidate_pool(inputs, roster, given).collect()
    assert lefts[0].count() == 5 + 5
    assert {(r.key, r.player_id) for r in pool if r.local_score is None} == {
        (i, i) for i in range(5)}


def test_blocks_are_cut_many_to_a_task(spark):
    rows = spark.range(3000).selectExpr("id", "(id * 7919) % 3001 as at")
    numbered, blocks = _numbered(rows, [F.col("at")], 3000, 8)
    assert len(numbered.inputFiles()) <= 2
    spans = sorted((r.lo, r.hi, r.n, r._rb) for r in numbered.groupBy("_rb").agg(
        F.min("at").alias("lo"), F.max("at").alias("hi"), F.count("*").alias("n")).collect())
    assert sum(s[2] for s in spans) == 3000 and max(s[2] for s in spans) == 8
    assert [s[3] for s in spans] == list(range(blocks)) and blocks <= 376
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert _numbered(rows.limit(0), [F.col("at")], 0, 8)[0].count() == 0


def test_common_letters_of_all_pairs_of_a_block():
    rng = random.Random(6)
    names = ["", "a", "x" * 64, "ab" * 40, *(
        "".join(rng.choice("abcde ") for _ in range(rng.randint(0, 90))) for _ in range(30)),
        *(f"Customer#{i:06d}" for i in range(20))]
    for left, right in ((names, names[::3]), (names[::3], names), (names, []), ([], names)):
        i, j = (k.ravel() for k in np.indices((len(left), len(right))))
        want = lcs_pairs(left, right, i, j).reshape(len(left), len(right))
        assert (identity._common(left, right) == want).all()


def test_names_without_a_token_match_only_without_a_floor():
    for floor, want in ((0.0, [(0, 0, 100.0), (0, 1, 0.0)]), (55.0, [])):
        found = identity._block_scores([" "], ["  ", "ali"], floor)
        assert list(zip(*(x.tolist() for x in found))) == want


def test_places_alike_are_looked_up_once_for_many_blocks(monkeypatch):
    """Blocks of numbered names: their beginnings and their sets of digits are much alike."""
    told = [identity._block_summary([f"Customer#{i:06d}" for i in range(b, b + 64)])
            for b in range(0, 6400, 64)]
    lookups = []

    class Counted(types.ModuleType):
        bitwise_or = types.SimpleNamespace(
            reduce=lambda *a, **k: lookups.append(1) or np.bitwise_or.reduce(*a, **k))

        def __getattr__(self, name):
            return getattr(np, name)

    names = [f"Supplier#{i:06d}" for i in range(50)]
    want = identity._block_bound(names, told)
    monkeypatch.setattr(identity, "np", Counted("np"))
    assert (identity._block_bound(names, told) == want).all()
    assert 0 < len(lookups) < 200


def test_inputs_alike_meet_given_pairs_once(spark):
    inputs = spark.createDataFrame([(i, "Ann", "2001-02-03", None) for i in range(20)],
                                   "key long, name string, dob string, sport string")
    roster = spark.createDataFrame([(i, f"Bea {i % 3}", "2001-02-03", None) for i in range(9)],
                                   "player_id long, full_name string, dob string, sport string")
    given = spark.createDataFrame([("Ann", f"Bea {j}") for j in range(3)],
                                  "name string, full_name string")
    met = identity._given_dobs(inputs, roster, given)
    assert sorted((r.key, r.full_name, r.player_id) for r in met.collect()) == [
        (i, f"Bea {j}", j) for i in range(20) for j in range(3)]
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [name" in plan
