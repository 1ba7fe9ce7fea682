"""Birth-date-first record linkage of names to a roster.

Candidates of a name are its four most similar roster names plus everyone with the same birth
date. Both are found block against block (``plans.blocks``), so neither a popular name nor a
popular date brings an unbounded group to one task. Distinct names are scored once, and only in
blocks whose letters, place by place, and tokens can hold a name similar enough.
"""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import linkage
from ..functions.numbers import present, round_py, to_day
from ..functions.similarity import lcs_pairs, token_set_scores
from ..plans.blocks import Visits, block_best, block_best_within, bounded_best
from ..plans.shapes import latest, top_rows
from ..session import cut

CANDIDATES = 4


def _block_scores(lnames: list[str], rnames: list[str], floor: float | np.ndarray,
                  k: int | None = None):
    """Pairs of a block that reach the floor (one for all or one for each left name); with ``k``,
    of each left name those no worse than its ``k`` best. Names that share no token are compared
    by their letters in order, all at once."""
    floor = np.broadcast_to(np.asarray(floor, dtype=float), len(lnames))
    ltok, rtok = [set(n.split()) for n in lnames], [set(n.split()) for n in rnames]
    ljoin, rjoin = [" ".join(sorted(t)) for t in ltok], [" ".join(sorted(t)) for t in rtok]
    both = (np.array([len(x) for x in ljoin], dtype=np.int64)[:, None]
            + np.array([len(x) for x in rjoin], dtype=np.int64)[None, :])
    grid = 100.0 - 100.0 * (both - 2 * _common(ljoin, rjoin)) / np.maximum(both, 1)
    grid[(both == 0) & (floor[:, None] > 1e-9)] = -1.0  # names without a token
    holders = defaultdict(list)
    for j, tokens in enumerate(rtok):
        for t in tokens:
            holders[t].append(j)
    sharing = np.zeros(grid.shape, dtype=bool)
    for i, tokens in enumerate(ltok):
        for t in tokens:
            if t in holders:
                sharing[i, holders[t]] = True
    si, sj = np.nonzero(sharing)
    grid[si, sj] = token_set_scores([lnames[i] for i in si], [rnames[j] for j in sj])
    least = floor
    if k is not None and len(rnames) > k:
        least = np.maximum(floor, np.partition(grid, len(rnames) - k, axis=1)[:, len(rnames) - k])
    li, ri = np.nonzero(grid >= least[:, None])
    return li, ri, grid[li, ri]


def _joined(names: list[str]) -> list[str]:
    return [" ".join(sorted(set(n.split()))) for n in names]


def _block_summary(names: list[str]) -> str:
    """What bounds the similarity to a block of names: the shortest length, the letters at each
    place, the greatest count of each letter, and the tokens. Tokens are sorted and joined."""
    places, most, tokens = [], Counter(), set()
    for name in (joined := _joined(names)):
        places += [set() for _ in range(len(name) - len(places))]
        for letters, letter in zip(places, name):
            letters.add(letter)
        most |= Counter(name)
        tokens |= set(name.split())
    return json.dumps([min(map(len, joined)), ["".join(sorted(p)) for p in places], most,
                       sorted(tokens)])


#: Sets of letters whose places in all names are kept at a time.
EITHER = 256


def _in_order(names: list[str], places: Iterable[Sequence[str]]) -> Iterator[np.ndarray]:
    """For each of ``places``, the most letters that each name's first 64 can have in common, in
    order, with any text that has one of the letters given at each place.

    What begins like the one before is taken up where it differs: give them sorted."""
    alphabet = {c: i for i, c in enumerate(sorted(set("".join(names))))}
    size = np.array([len(n) for n in names], dtype=np.int64)
    masks = np.zeros((len(alphabet), len(names)), dtype=np.uint64)
    for i, name in enumerate(names):
        bits: dict[str, int] = {}
        for j, letter in enumerate(name[:64]):
            bits[letter] = bits.get(letter, 0) | 1 << j
        for letter, bit in bits.items():
            masks[alphabet[letter], i] = bit
    used = np.full(len(names), np.iinfo(np.uint64).max, dtype=np.uint64)
    used[size < 64] = (np.uint64(1) << size[size < 64].astype(np.uint64)) - np.uint64(1)
    either: dict[str, np.ndarray | None] = {}

    def mask(letters: str) -> np.ndarray | None:
        if letters not in either:
            if len(either) >= EITHER:
                either.clear()
            at = [alphabet[c] for c in letters if c in alphabet]
            either[letters] = np.bitwise_or.reduce(masks[at], axis=0) if at else None
        return either[letters]

    path: list[str] = []
    rows = [np.full(len(names), np.iinfo(np.uint64).max, dtype=np.uint64)]
    for letters_at in places:
        same = next((k for k, (x, y) in enumerate(zip(path, letters_at)) if x != y),
                    min(len(path), len(letters_at)))
        del path[same:], rows[same + 1:]
        for letters in letters_at[same:]:
            row, hit = rows[-1], mask(letters)
            if hit is not None:
                hit = row & hit
                row = (row + hit) | (row - hit)
            path.append(letters)
            rows.append(row)
        yield np.bitwise_count(~rows[-1] & used)


def _common(left: list[str], right: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each name of ``left`` and each of ``right``."""
    if len(left) < len(right):
        return _common(right, left).T
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    order = sorted(range(len(right)), key=right.__getitem__)
    for j, common in zip(order, _in_order(left, [right[j] for j in order])):
        out[:, j] = common
    long = np.flatnonzero([len(x) > 64 for x in left])
    if len(long):
        li, ri = np.repeat(long, len(right)), np.tile(np.arange(len(right)), len(long))
        out[li, ri] = lcs_pairs(left, right, li, ri)
    return out


def _block_bound(names: list[str], told: list[str]) -> np.ndarray:
    """For each name and summary, a similarity that no name of the block exceeds.

    Names without a shared token are compared in order. Names with one are bounded by their
    letters, and by their shared tokens alone compared with either side, which is most if they
    share all tokens that the block knows with the shortest name there."""
    blocks = [json.loads(t) for t in told]
    shortest = np.array([b[0] for b in blocks], dtype=np.int32)
    joined = _joined(names)
    size = np.array([len(j) for j in joined], dtype=np.int32)
    # A block to a row while it is filled, which stays in the cache. Letters beyond a machine word
    # count as common.
    limit, beyond = np.empty((len(blocks), len(joined))), np.maximum(size - 64, 0)
    for row, least, common in zip(limit, shortest.tolist(),
                                  _in_order(joined, [b[1] for b in blocks])):
        np.divide(200.0 * (common + beyond), np.maximum(size + least, 1), out=row)
    limit = limit.T
    holders = defaultdict(list)
    for at, b in enumerate(blocks):
        for token in b[3]:
            holders[token].append(at)
    meet = [(i, holders[token], len(token) + 1) for i, name in enumerate(joined)
            for token in name.split() if token in holders]
    if not meet:
        return np.minimum(limit, 100.0, out=limit)
    shared = np.zeros(limit.shape, dtype=np.int32)  # letters of shared tokens, with spaces
    for i, at, letters in meet:
        shared[i, at] += letters
    i, j = np.nonzero(shared)
    common = np.zeros(limit.shape, dtype=np.int32)
    for letter in sorted(set("".join(joined))):
        most = np.array([b[2].get(letter, 0) for b in blocks], dtype=np.int32)
        if most.any():
            common += np.minimum.outer(
                np.array([n.count(letter) for n in joined], dtype=np.int32), most)
    c = shared[i, j] - 1
    alone = 200.0 * c / (c + np.minimum(np.maximum(size[i], c), np.maximum(shortest[j], c)))
    total = np.maximum(size[i] + shortest[j], 1)
    limit[i, j] = np.maximum(200.0 * common[i, j] / total, alone)
    return np.minimum(limit, 100.0)


#: Up to so many pairs of names are compared block by block without planning.
FEW_PAIRS = 1 << 25


def _spelling(name: str) -> list[Column]:
    """Sort order that brings names of one length and like beginnings together."""
    joined = F.array_join(F.array_sort(F.split(F.trim(F.col(name)), r"\s+")), " ")
    return [F.length(joined), joined, F.col(name)]


def name_search(names: DataFrame, roster: DataFrame, k: int, floor: float,
                block_rows: int = 64) -> tuple[DataFrame, Visits | None]:
    """``(_name, _first, score, rank)``: of each name the ``k`` best of the roster's names, and
    the blocks that names visited (None for a search so small that all meet all).

    ``names`` has ``_name``, ``roster`` has ``_full`` and its number ``_first``, each once."""
    rows = names.count(), roster.count()
    ids = {"left_id": "_name", "right_id": "_first", "k": k, "rows": rows}
    if rows[0] * rows[1] <= FEW_PAIRS:
        return block_best(names, roster, **ids, block_rows=(512, 4096), scorer=lambda left, right: (
            _block_scores(left["_name"].tolist(), right["_full"].tolist(), floor, k))), None
    return bounded_best(
        names, roster, **ids, floor=floor, block_rows=block_rows,
        order=_spelling("_full"),
        summarise=lambda right: _block_summary(right["_full"].tolist()),
        bound=lambda left, told: _block_bound(left["_name"].tolist(), told),
        scorer=lambda left, right, least: _block_scores(
            left["_name"].tolist(), right["_full"].tolist(), least, k))


def similar_names(names: DataFrame, roster: DataFrame, *, name: str = "name",
                  full_name: str = "full_name", k: int = CANDIDATES,
                  floor: float = linkage.NAME_FLOOR) -> DataFrame:
    """The ``k`` roster entries most similar to each distinct name, at least at the floor:
    ``(name, player_id, score)``. Equal scores go to the smaller player id.

    Roster entries of one name score alike: each distinct name is compared once, under its
    smallest id, and stands for its ``k`` smallest."""
    left = cut(names.select(F.col(name).alias("_name")).where(F.col("_name") != "").distinct())
    entries = roster.select("player_id", F.col(full_name).alias("_full")).where(
        F.col("_full").isNotNull())
    distinct = cut(entries.groupBy("_full").agg(F.min("player_id").alias("_first")))
    best, _ = name_search(left, distinct, k, floor)
    found = best.select("_name", "_first", "score").join(distinct, "_first")
    few = top_rows(entries, ["_full"], [F.asc("player_id")], k).select("_full", "player_id")
    found = found.join(few, "_full")
    order = [F.desc("score"), F.asc("player_id")]
    return top_rows(found, ["_name"], order, k).select(
        F.col("_name").alias(name), "player_id", "score")


def _dated(df: DataFrame, out: str) -> DataFrame:
    return df.withColumn(out, to_day("dob")).where(F.col(out).isNotNull())


def born_together(inputs: DataFrame, roster: DataFrame,
                  apart: DataFrame | None = None) -> DataFrame:
    """Roster entries with an input's exact, trusted birth date that can be its best candidate:
    ``(key, player_id, score)``.

    Among equal birth dates only the sport (agreeing or in conflict), a shared distinctive token
    and the name score decide, and within each of the four classes a higher score is never worse.
    One entry per class and block is therefore enough, however many share the date. Pairs in
    ``apart`` (of ``_given_dobs``) are left out: their score comes from elsewhere."""
    def described(df: DataFrame, name: str) -> list[Column]:
        return [linkage.distinctive(linkage.name_tokens(F.col(name))).alias("_tokens"),
                linkage.normal_sport(F.col("sport")).alias("_sport"), F.col(name).alias("_n")]

    dated = _dated(inputs, "_dob").where(~linkage.is_placeholder(F.col("_dob")))
    left = dated.select("_dob", "key", *described(inputs, "name"),
                        F.lit(None).cast("string").alias("_skip"))
    if apart is not None:
        # They travel with their input into its blocks.
        left = left.unionByName(apart.select("_dob", "key", F.col("full_name").alias("_skip")),
                                allowMissingColumns=True)
    right = _dated(roster, "_dob").select("_dob", "player_id", *described(roster, "full_name"))

    def scorer(lpdf: pd.DataFrame, rpdf: pd.DataFrame):
        at = np.flatnonzero(lpdf["_skip"].isna().to_numpy())
        people = lpdf.iloc[at]
        skips = defaultdict(set)
        for key, name in zip(lpdf["key"], lpdf["_skip"], strict=True):
            if isinstance(name, str):
                skips[key].add(name)
        li, ri, score = _block_scores(people["_n"].tolist(), rpdf["_n"].tolist(), 0.0)
        keys, rnames = people["key"].tolist(), rpdf["_n"].tolist()
        if skips:
            kept = np.array([rnames[j] not in skips.get(keys[i], ())
                             for i, j in zip(li, ri, strict=True)], dtype=bool)
            li, ri, score = li[kept], ri[kept], score[kept]
        lt, rt = [set(t) for t in people["_tokens"]], [set(t) for t in rpdf["_tokens"]]
        token = np.array([not lt[i].isdisjoint(rt[j]) for i, j in zip(li, ri, strict=True)],
                         dtype=int)
        ls, rs = people["_sport"].to_numpy(object)[li], rpdf["_sport"].to_numpy(object)[ri]
        clash = np.array([isinstance(a, str) and isinstance(b, str) and a != b
                          for a, b in zip(ls, rs, strict=True)], dtype=int)
        # Scores count as whole numbers; ties within one go to the smaller id.
        return at[li], ri, np.floor(score), 2 * clash + token

    return block_best_within(left, right, on="_dob", left_id="key", right_id="player_id",
                             scorer=scorer)


def _given_dobs(inputs: DataFrame, roster: DataFrame, given: DataFrame) -> DataFrame:
    """``(key, _dob, full_name, player_id)`` of equal, trusted birth dates among the name pairs
    scored elsewhere. Of entries alike in name, birth date and sport the smallest id stands for
    all."""
    dated = _dated(inputs, "_dob").where(~linkage.is_placeholder(F.col("_dob")))
    entries = _dated(roster, "_dob").groupBy("full_name", "_dob", "sport").agg(
        F.min("player_id").alias("player_id"))
    # Inputs alike in name and birth date meet the given pairs once.
    met = (dated.select("name", "_dob").distinct()
           .join(given.select("name", "full_name"), "name").join(entries, ["full_name", "_dob"]))
    return dated.select("key", "name", "_dob").join(met, ["name", "_dob"]).select(
        "key", "_dob", "full_name", "player_id")


def candidate_pool(inputs: DataFrame, roster: DataFrame,
                   given: DataFrame | None = None) -> DataFrame:
    """``(key, player_id, local_score)``: similar names united with equal, trusted birth dates.
    Pairs known only through ``given`` have no local score."""
    by_name = inputs.join(similar_names(inputs, roster), "name").select(
        "key", "player_id", F.floor("score").cast("int").alias("local_score"))
    # Only given pairs born together can meet by birth date: few, however many are given.
    apart = None if given is None else cut(_given_dobs(inputs, roster, given))
    by_dob = born_together(inputs, roster, apart).select(
        "key", "player_id", F.col("score").cast("int").alias("local_score"))
    pool = by_name.unionByName(by_dob)
    if apart is not None:
        pool = pool.unionByName(apart.select(
            "key", "player_id", F.lit(None).cast("int").alias("local_score")))
    return pool.groupBy("key", "player_id").agg(F.max("local_score").alias("local_score"))


def described(df: DataFrame, side: str, *, name: str, dob: str, sport: str) -> DataFrame:
    """Adds what ``judge`` compares: tokens, birth date and sport of one side (``a`` or ``b``).

    Derived once per record here rather than once per pair there."""
    return df.withColumns({f"_tokens_{side}": linkage.name_tokens(F.col(name)),
                           f"_born_{side}": to_day(dob),
                           f"_sport_{side}": linkage.normal_sport(F.col(sport))})


def judge(pairs: DataFrame, score: Column) -> DataFrame:
    """Adds relation, tokens, verdict and confidence to rows with both sides' name, birth date and
    sport (``name``/``dob``/``sport`` against ``full_name``/``sams_dob``/``sams_sport``).

    Sides that were ``described`` before they met are not derived again."""
    for side, columns in (("a", {"name": "name", "dob": "dob", "sport": "sport"}),
                          ("b", {"name": "full_name", "dob": "sams_dob", "sport": "sams_sport"})):
        if f"_tokens_{side}" not in pairs.columns:
            pairs = described(pairs, side, **columns)
    rows = pairs.withColumns({"name_score": score.cast("int"),
                              "_shared": F.array_intersect("_tokens_a", "_tokens_b")})
    rows = rows.withColumns({
        "_dob": linkage.dob_relation(F.col("_born_a"), F.col("_born_b")),
        "_n": F.size(linkage.distinctive(F.col("_shared"))),
        "sport_ok": F.col("_sport_a") == F.col("_sport_b")})
    r, gap, n = F.col("_dob")["rel"], F.col("_dob")["gap"], F.col("_n")
    return rows.withColumns({
        "verdict": linkage.verdict(F.col("name_score"), r, gap, n, F.col("sport_ok")),
        "confidence": linkage.confidence(F.col("name_score"), r, n).cast("int"),
        "dob_exact": F.coalesce(r == "exact", F.lit(False)),
        "dob_swapped": F.coalesce(r == "swapped", F.lit(False)),
        "dob_gap": round_py(gap, 2),
        "shared_tokens": F.array_join(F.array_sort("_shared"), " ")}).drop(
        "_dob", "_shared", "_n", *[f"_{x}_{s}" for x in ("tokens", "born", "sport") for s in "ab"])


CANDIDATE_FIELDS = ["player_id", "sams_name", "sams_dob", "sams_sport", "name_score", "dob_exact",
                    "dob_swapped", "dob_gap", "shared_tokens", "sport_ok", "mrn", "photo_url",
                    "verdict", "confidence"]


def best_candidates(judged: DataFrame, *, key: str = "key",
                    fields: list[str] | None = None) -> DataFrame:
    """One candidate per input: best verdict, then confidence, then name score, then smaller id."""
    order = [linkage.verdict_rank(F.col("verdict")), F.col("confidence"), F.col("name_score"),
             -F.col("player_id")]
    return latest(judged, [key], order, columns=fields or CANDIDATE_FIELDS)


def resolve_entities(inputs: DataFrame, roster: DataFrame,
                     scores: DataFrame | None = None) -> DataFrame:
    """Best roster candidate and verdict of every input.

    ``inputs``: ``key, name`` and optionally ``dob, sport``. ``roster``: ``player_id, full_name,
    dob, sport`` and optionally ``mrn, photo_url``. ``scores`` (``name_a, name_b, score``) come
    from an outside name matcher and replace the local similarity where given. ``player_id`` is
    set for an ``auto`` verdict only; inputs without a candidate read ``no_match``."""
    for column in ("dob", "sport"):
        if column not in inputs.columns:
            inputs = inputs.withColumn(column, F.lit(None).cast("string"))
    inputs = inputs.withColumns({"dob": F.substring(F.col("dob").cast("string"), 1, 10)})
    people = roster.select(
        "player_id", "full_name", F.substring(F.col("dob").cast("string"), 1, 10).alias("sams_dob"),
        F.col("sport").alias("sams_sport"), F.col("full_name").alias("sams_name"),
        *[(F.col(c) if c in roster.columns else F.lit(None).cast("string")).alias(c)
          for c in ("mrn", "photo_url")])
    given = None
    if scores is not None:
        # Written: read for birth dates and for scores, and an outside matcher may be costly.
        given = cut(scores.groupBy(F.col("name_a").alias("name"), F.col("name_b")
                                   .alias("full_name")).agg(F.max("score").cast("int")
                                                            .alias("_given")))
    pool = candidate_pool(inputs, roster, given)
    if given is not None:
        pool = cut(pool)
    left = described(inputs.select("key", "name", "dob", "sport"), "a", name="name", dob="dob",
                     sport="sport")
    right = described(people, "b", name="full_name", dob="sams_dob", sport="sams_sport")
    pairs = pool.join(left, "key").join(right, "player_id")
    known = F.col("local_score")
    if given is not None:
        # Candidates are few beside the given pairs, which stream past them unsorted.
        asked = pairs.select("name", "full_name").distinct()
        told = given.join(asked.hint("shuffle_hash"), ["name", "full_name"])
        pairs = pairs.join(told, ["name", "full_name"], "left")
        known = F.coalesce("_given", known)
    judged = judge(pairs, known)
    best = best_candidates(judged)
    out = inputs.select("key", "name").join(
        best.withColumnRenamed("player_id", "candidate_player_id"), "key", "left")
    linked = F.col("verdict") == "auto"
    return out.withColumns({
        "player_id": F.when(linked, F.col("candidate_player_id")),
        "verdict": F.coalesce("verdict", F.lit("no_match")),
        "confidence": F.coalesce("confidence", F.lit(0))})


# --- the ladder ------------------------------------------------------------------------------

LADDER_FIELDS = ["sams_id", "sams_name", "verdict", "confidence", "best_candidate",
                 "candidate_player_id", "name_score", "dob_exact", "dob_swapped",
                 "candidate_sport"]


def resolve_ladder(names: DataFrame, *, exact: DataFrame | None = None,
                   mrns: DataFrame | None = None, dobs: DataFrame | None = None,
                   sports: DataFrame | None = None, drops: DataFrame | None = None,
                   ledger: DataFrame | None = None, identifiers: DataFrame | None = None,
                   roster: DataFrame | None = None,
                   scores: DataFrame | None = None) -> DataFrame:
    """Names to athletes by the cheapest sure evidence: dropped, exact source name, MRN, human
    decision; only what is left goes to record linkage.

    ``exact``: ``name, sams_player_id, sams_name``; ``mrns``: ``name, mrn``; ``dobs``: ``name,
    dob``; ``sports``: ``name, sport``; ``drops``: ``name``; ``ledger``: ``source_name, sams_id,
    decision``, one row per name; ``identifiers``: ``sams_player_id, sams_mrn, sams_name``.
    A decision other than ``drop`` confirms when it carries an id and rejects when it does not."""
    rows = names.select("name").distinct()

    def lookup(side: DataFrame | None, columns: dict[str, tuple[str, str]]) -> None:
        nonlocal rows
        if side is None:
            rows = rows.withColumns({out: F.lit(None).cast(kind)
                                     for out, (_, kind) in columns.items()})
            return
        one = side.groupBy("name").agg(F.max(F.struct(
            *[F.col(src).cast(kind).alias(out) for out, (src, kind) in columns.items()])).alias("_s"))
        one = one.select("name", *[F.col("_s")[out].alias(out) for out in columns])
        rows = rows.join(one, "name", "left")

    lookup(None if drops is None else drops.select("name", F.lit(True).alias("hit")),
           {"_drop": ("hit", "boolean")})
    lookup(exact, {"_eid": ("sams_player_id", "int"), "_ename": ("sams_name", "string")})
    lookup(mrns, {"_mrn": ("mrn", "string")})
    lookup(None if ledger is None else ledger.withColumnRenamed("source_name", "name"),
           {"_decision": ("decision", "string"), "_lid": ("sams_id", "int")})
    rows = rows.withColumn("_mrn", present(F.trim("_mrn")))
    if identifiers is None:
        rows = rows.withColumns({"_mid": F.lit(None).cast("int"),
                                 "_mname": F.lit(None).cast("string")})
    else:
        known = identifiers.groupBy(present(F.trim(F.col("sams_mrn").cast("string"))).alias("_m")) \
            .agg(F.max(F.struct(F.col("sams_player_id").cast("int").alias("i"),
                                F.col("sams_name").alias("n"))).alias("_s"))
        known = known.select("_m", F.col("_s.i").alias("_mid"), F.col("_s.n").alias("_mname"))
        rows = rows.join(known, F.col("_mrn") == F.col("_m"), "left").drop("_m")

    def usable(c: str) -> Column:
        return F.coalesce(F.col(c) != 0, F.lit(False))

    dropped = F.coalesce("_drop", F.lit(False))
    decided = F.col("_decision").isNotNull()
    route = (F.when(dropped, "dummy").when(usable("_eid"), "exact").when(usable("_mid"), "mrn_exact")
             .when(decided & (F.col("_decision") == "drop"), "dummy")
             .when(decided & usable("_lid"), "manual_confirmed").when(decided, "manual_rejected"))
    rows = rows.withColumn("verdict", route)
    found = rows.where(F.col("verdict").isNotNull()).select(
        "name",
        F.when(F.col("verdict") == "exact", F.col("_eid"))
        .when(F.col("verdict") == "mrn_exact", F.col("_mid"))
        .when(F.col("verdict") == "manual_confirmed", F.col("_lid")).alias("sams_id"),
        F.when(F.col("verdict") == "exact", F.col("_ename"))
        .when(F.col("verdict") == "mrn_exact", F.col("_mname")).alias("sams_name"),
        "verdict", F.when(F.col("verdict") == "dummy", 0).otherwise(100).alias("confidence"))
    if roster is None:
        return found
    need = rows.where(F.col("verdict").isNull()).select("name", F.col("name").alias("key"))
    for side, column in ((dobs, "dob"), (sports, "sport")):
        if side is not None:
            one = side.groupBy("name").agg(F.max(F.col(column).cast("string")).alias(column))
            need = need.join(one, "name", "left")
    linked = resolve_entities(need, roster, scores)
    told = F.col("player_id").isNotNull()
    resolved = linked.select(
        "name", F.col("player_id").cast("int").alias("sams_id"),
        F.when(told, F.col("sams_name")).alias("sams_name"), "verdict", "confidence",
        F.col("sams_name").alias("best_candidate"),
        F.col("candidate_player_id").cast("int").alias("candidate_player_id"),
        "name_score", "dob_exact", "dob_swapped", F.col("sams_sport").alias("candidate_sport"))
    return found.unionByName(resolved, allowMissingColumns=True)
