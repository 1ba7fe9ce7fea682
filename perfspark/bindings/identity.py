"""Record-linkage and roster queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import linkage
from ..functions.ids import safe_id, uuid5
from ..functions.numbers import iso, round_py
from ..functions.similarity import token_set_ratio
from ..operators import identity, roster
from .common import day_text, sql_round, table


def dob_relation(spark, d):
    """Order and ship dates as two records of one birth date."""
    rows = table(spark, d, "lineitem").join(
        table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rel = linkage.dob_relation(F.to_date("o_orderdate"), F.to_date("l_shipdate"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", rel.alias("r")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("r.rel").alias("rel"),
        round_py("r.gap", 2).alias("gap"))


# Fixed labels standing for sports and programmes.
SPORTS = {"1-URGENT": "Sprints", "2-HIGH": "Swimming", "3-MEDIUM": "Development 1",
          "4-NOT SPECIFIED": "Table Tennis", "5-LOW": "Athletics"}
PART_SPORTS = {"ECONOMY": "Athletics", "SMALL": "swim squad", "LARGE": "Padel"}


def _pairs(spark, d) -> DataFrame:
    """Line items as candidate pairs: the order is the input, the part the roster entry, the
    quantity the given name score."""
    li, o, p = (table(spark, d, t) for t in ("lineitem", "orders", "part"))

    def label(c: str, names: dict[str, str]) -> Column:
        return F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]),
                                F.col(c))

    orders = identity.described(
        o.select("o_orderkey", F.concat(F.lower("o_orderpriority"), F.lit(" widget Ali"))
                 .alias("name"), iso("o_orderdate").alias("dob"),
                 label("o_orderpriority", SPORTS).alias("sport")),
        "a", name="name", dob="dob", sport="sport")
    parts = identity.described(
        p.select("p_partkey", F.concat(F.col("p_name"), F.lit(" Ali")).alias("full_name"),
                 F.lit(None).cast("string").alias("_none"),
                 label("p_type", PART_SPORTS).alias("sams_sport")),
        "b", name="full_name", dob="_none", sport="sams_sport").drop("_none", "_born_b")
    return (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .withColumnsRenamed({"l_orderkey": "key", "p_partkey": "player_id"})
            .withColumns({"_born_b": F.to_date("l_shipdate"), "_given": F.col("l_quantity") * 2}))


def verdict(spark, d):
    j = identity.judge(_pairs(spark, d), F.col("_given"))
    return j.select("key", "l_linenumber", "player_id", "name_score", "dob_exact", "dob_swapped",
                    "dob_gap", "shared_tokens", "sport_ok", "verdict", "confidence")


def best_candidate(spark, d):
    j = identity.judge(_pairs(spark, d), F.col("_given"))
    return identity.best_candidates(j, fields=["player_id", "verdict", "confidence",
                                               "name_score"])


def token_set(spark, d):
    """Each part's name against its type, brand and last word."""
    p = table(spark, d, "part")
    other = F.concat_ws(" ", F.lower("p_type"), F.substring_index("p_name", " ", -1), "p_brand")
    return p.select("p_partkey", round_py(token_set_ratio(F.col("p_name"), other), 6)
                    .alias("near"),
                    round_py(token_set_ratio(F.col("p_name"), F.col("p_brand")), 6).alias("far"))


def name_tokens(spark, d):
    """Tokens of document texts: distinct words and how many are not common first names."""
    t = linkage.name_tokens(F.col("text"))
    return table(spark, d, "documents").select("doc_id", t.alias("t")).select(
        "doc_id", F.size("t").alias("n_tokens"),
        F.size(linkage.distinctive(F.col("t"))).alias("n_distinctive"))


def similar_names(spark, d):
    """The four parts most similar in name to each part name."""
    p = table(spark, d, "part")
    names = p.select(F.col("p_name").alias("name"))
    people = p.select(F.col("p_partkey").alias("player_id"), F.col("p_name").alias("full_name"))
    out = identity.similar_names(names, people)
    return out.select("name", "player_id", round_py("score", 6).alias("score"))


def _born(balance: str) -> Column:
    return F.date_sub(F.lit("2010-06-15").cast("date"), F.floor(F.abs(balance)).cast("int"))


def _segment_sport() -> Column:
    return F.when(F.col("c_mktsegment") == "MACHINERY", "Swimming").otherwise("Sprint")


def _two_rosters(spark, d) -> tuple[DataFrame, DataFrame]:
    """Suppliers as inputs and customers as roster, with birth dates that some of them share."""
    inputs = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        iso(_born("s_acctbal")).alias("dob"), F.lit("Athletics").alias("sport"))
    people = table(spark, d, "customer").select(
        F.col("c_custkey").alias("player_id"), F.col("c_name").alias("full_name"),
        iso(_born("c_acctbal")).alias("dob"), _segment_sport().alias("sport"))
    return inputs, people


def resolve_entities(spark, d):
    """Suppliers linked to customers by name and a birth date that some of them share."""
    out = identity.resolve_entities(*_two_rosters(spark, d))
    return out.select("key", "name", "player_id", "candidate_player_id", "verdict", "confidence",
                      "name_score", "dob_exact")


def resolve_scored(spark, d):
    """Suppliers linked to customers with the scores of an outside matcher, which knows the pairs
    that traded."""
    traded = table(spark, d, "lineitem").join(
        table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        "l_suppkey", "o_custkey").agg(F.least(F.lit(100), 60 + 10 * F.count(F.lit(1))).alias("score"))
    s, c = table(spark, d, "supplier"), table(spark, d, "customer")
    scores = (traded.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(c, F.col("o_custkey") == F.col("c_custkey"))
              .select(F.col("s_name").alias("name_a"), F.col("c_name").alias("name_b"), "score"))
    out = identity.resolve_entities(*_two_rosters(spark, d), scores)
    return out.select("key", "name", "player_id", "candidate_player_id", "verdict", "confidence",
                      "name_score", "dob_exact")


def ladder(spark, d):
    """Customers by the first evidence that holds: dropped segment, exact name, MRN, decision."""
    return identity.resolve_ladder(**_evidence(spark, d)).select(
        "name", "sams_id", "sams_name", "verdict", "confidence")


def ladder_linked(spark, d):
    """The same to its last step: names without such evidence are linked to the suppliers, and
    every name is told."""
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    people = s.select(F.col("s_suppkey").alias("player_id"), F.col("s_name").alias("full_name"),
                      iso(_born("s_acctbal")).alias("dob"), F.lit("Athletics").alias("sport"))
    out = identity.resolve_ladder(
        **_evidence(spark, d), roster=people,
        dobs=c.select(F.col("c_name").alias("name"), iso(_born("c_acctbal")).alias("dob")),
        sports=c.select(F.col("c_name").alias("name"), _segment_sport().alias("sport")))
    return out.select("name", "sams_id", "sams_name", "verdict", "confidence",
                      "candidate_player_id", "name_score", "dob_exact")


def _evidence(spark, d) -> dict[str, DataFrame]:
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    names = c.select(F.col("c_name").alias("name"))
    drops = c.where(F.col("c_acctbal") < 0).select(F.col("c_name").alias("name"))
    exact = c.join(s, F.col("c_custkey") == F.col("s_suppkey")).select(
        F.col("c_name").alias("name"), F.col("s_suppkey").alias("sams_player_id"),
        F.col("s_name").alias("sams_name"))
    mrns = c.select(F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("mrn"))
    identifiers = table(spark, d, "nation").where(F.col("n_regionkey") < 3).select(
        F.col("n_nationkey").alias("sams_player_id"), F.col("n_nationkey").alias("sams_mrn"),
        F.col("n_name").alias("sams_name"))
    ledger = c.where(F.col("c_mktsegment").isin("BUILDING", "FURNITURE", "HOUSEHOLD")).select(
        F.col("c_name").alias("source_name"),
        F.when(F.col("c_mktsegment") == "FURNITURE", F.col("c_custkey")).alias("sams_id"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "drop").otherwise("no").alias("decision"))
    return {"names": names, "exact": exact, "mrns": mrns, "drops": drops, "ledger": ledger,
            "identifiers": identifiers}


def row_uid(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", uuid5("o_custkey", iso("o_orderdate"), "o_orderpriority")
                    .alias("row_uid"))


# --- roster ----------------------------------------------------------------------------------

def resolve_ids(spark, d):
    """Customers against supplier identifiers: by key, else by nation as record number."""
    identifiers = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("sams_player_id"),
        F.when(F.col("s_acctbal") > 0, F.col("s_nationkey").cast("string")).otherwise("")
        .alias("sams_mrn"), F.col("s_name").alias("sams_name"),
        F.format_string("%012d", "s_suppkey").alias("vald_id"))
    asked = table(spark, d, "customer").select(
        F.col("c_custkey").alias("player_id"), F.col("c_nationkey").cast("string").alias("mrn"))
    out = roster.resolve_ids(asked, identifiers, order=["sams_name"])
    return out.select("player_id", "mrn", "resolved_by", "sams_name",
                      safe_id("vald_id").alias("vald_id"))


def mrn_lookup(spark, d):
    s = table(spark, d, "supplier").select(
        F.col("s_nationkey").alias("sams_mrn"), "s_suppkey", F.col("s_name").alias("sams_name"))
    return roster.identifiers_by_mrn(s, seq="s_suppkey").select("mrn_key", "s_suppkey",
                                                                "sams_name")


def _players(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    gender = F.when(F.col("c_nationkey") < 10, F.lit('{"name": "Female"}')).otherwise("Male")
    return c.select(
        F.col("c_custkey").alias("playerId"), F.col("c_name").alias("fullName"),
        F.col("c_nationkey").alias("mrn"), (F.col("c_nationkey") + 1).alias("sportId"),
        F.concat(iso(F.date_sub(F.lit("2000-03-01").cast("date"),
                                F.floor(F.abs("c_acctbal")).cast("int"))), F.lit("T00:00:00"))
        .alias("dateOfBirth"), gender.alias("gender"),
        (F.col("c_acctbal") > 0).alias("isActive"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Target")
        .when(F.col("c_mktsegment") == "MACHINERY", "Development").alias("pathway"),
        F.lit(None).cast("string").alias("profileImageUrl"))


def _periods(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    sport = F.when(F.col("o_orderpriority") == "1-URGENT", 6).when(
        F.col("o_orderpriority") == "5-LOW", 2)
    return o.select(
        F.col("o_custkey").alias("playerId"), (F.col("o_orderstatus") == "F").alias("isPrimary"),
        iso("o_orderdate").alias("startDate"),
        F.when(F.col("o_totalprice") > 400000, "2001-12-31").otherwise("").alias("endDate"),
        sport.alias("sportId"), F.when(sport == 6, "Swim").alias("sportName"),
        F.col("o_orderkey").alias("disciplineId"),
        F.col("o_orderpriority").alias("disciplineName"),
        F.concat(F.lit("TBD, "), F.col("o_orderpriority"), F.lit(", other"))
        .alias("targetEventNames"),
        F.col("o_orderstatus").alias("playerTypeName"), F.lit(None).cast("string").alias("coachName"))


def current_enrollment(spark, d):
    e = roster.current_enrollment(_periods(spark, d), tie=["disciplineId"])
    return e.select("playerId", "isPrimary", "startDate", "disciplineId")


def athlete_cards(spark, d):
    contexts = roster.context_rows(_players(spark, d), F.lit("2024-01-30").cast("date"))
    enrolled = roster.current_enrollment(_periods(spark, d), tie=["disciplineId"])
    cards = roster.athlete_cards(contexts, enrolled)
    return cards.select("player_id", "full_name", "date_of_birth", "age", "sex", "sport_id",
                        "sport", "is_active", "is_target", "discipline_id", "discipline",
                        "target_event", "player_type")


def sport_roster(spark, d):
    """Orders are training plans, their status the sport, suppliers of their lines the athletes."""
    plans = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("trainingPlanId"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
        .otherwise(3).alias("SportId"), F.col("o_orderdate").alias("TrainingDate"),
        F.lit(2).alias("CommitteeId"))
    on_plan = table(spark, d, "lineitem").join(
        table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("trainingPlanId"), F.col("l_suppkey").alias("playerId"),
        F.col("s_name").alias("fullName"), F.col("s_nationkey").alias("mrn"),
        F.col("s_nationkey").alias("sportId"))
    out = roster.sport_roster(plans, on_plan, F.lit("2001-08-01").cast("date"))
    return out.select("plan_sport_id", "player_id", "full_name", "mrn", "sport")


def search_players(spark, d):
    """Active players by name; the first 50."""
    return roster.search_players(_players(spark, d), "customer", limit=50).select(
        "player_id", "full_name", "mrn", "sport_id", "sport", "is_active")


def lookup_either(spark, d):
    return roster.find_either(table(spark, d, "customer"), " machinery ", "c_mktsegment", "c_name").select(
        "c_custkey", "c_name")


def athletes_by_mrn(spark, d):
    """The player of every nation key used as a record number."""
    wanted = table(spark, d, "nation").select(F.col("n_nationkey").alias("mrn"))
    out = roster.athletes_by_mrn(wanted, _players(spark, d))
    return out.select("wanted_mrn", F.col("playerId").alias("player_id"))


QUERIES = {f.__name__: f for f in (
    dob_relation, verdict, best_candidate, token_set, similar_names, name_tokens,
    resolve_entities, resolve_scored, ladder, ladder_linked,
    row_uid, resolve_ids, mrn_lookup, current_enrollment, athlete_cards, sport_roster,
    search_players, lookup_either, athletes_by_mrn)}


# --- SQL twins -------------------------------------------------------------------------------

REL = """case when a = b and not (month(a) = 1 and day(a) = 1) then 'exact'
              when a <> b and year(a) = year(b) and month(a) = day(b) and day(a) = month(b)
                   and month(a) <> day(a) then 'swapped' end"""

JUDGED = f"""
    c0 as (select l_orderkey as key, l_linenumber, p_partkey as player_id, l_quantity*2 as ns,
             cast(o_orderdate as date) as a, cast(l_shipdate as date) as b, p_name,
             case o_orderpriority when '1-URGENT' then 'Athletics' when '2-HIGH' then 'Swimming'
               when '4-NOT SPECIFIED' then 'Table Tennis' when '5-LOW' then 'Athletics' end as s1,
             case p_type when 'ECONOMY' then 'Athletics' when 'SMALL' then 'Swimming'
               when 'LARGE' then 'Padel' end as s2, o_orderpriority
           from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey),
    c1 as (select *, {REL} as rel, abs(a - b)/365.25e0 as gap, s1 = s2 as sport_ok,
             p_name like '% widget' as token from c0),
    c2 as (select *, rel is not null as strong, coalesce(not sport_ok, false) as clash from c1),
    c as (select *, case
            when clash and not strong then 'reject'
            when strong and not clash and (token or ns >= 85) then 'auto'
            when ns >= 92 and gap <= 1 and not clash then 'auto'
            when ns >= 88 and strong and not clash then 'auto'
            when gap > 2 then 'reject'
            when strong or ns >= 80 or (token and gap <= 1) then 'review' else 'reject' end as verdict,
            least(100, ns + case rel when 'exact' then 18 when 'swapped' then 14 else 0 end
                       + case when token then 6 else 0 end) as confidence
          from c2)"""


def _lcs(x: str, y: str) -> str:
    """Longest common subsequence by a fold over the letters of ``x`` whose accumulator is the
    running row of best lengths over the letters of ``y``."""
    cell = ("list_append(r, greatest(r[len(r)], prev[len(r) + 1], "
            "prev[len(r)] + case when c = ch then 1 else 0 end))")
    row = f"list_reduce(string_split({y}, ''), lambda r, c: {cell}, [0])"
    return (f"list_last(list_reduce(string_split({x}, ''), lambda prev, ch: {row}, "
            f"list_transform(range(0, length({y}) + 1), lambda z: 0)))")


SQL = {
    "dob_relation": f"""
        select l_orderkey, l_linenumber, l_partkey, {REL} as rel, {sql_round('gap', 2)} as gap
        from (select *, abs(a - b)/365.25e0 as gap from (
                select l_orderkey, l_linenumber, l_partkey, cast(o_orderdate as date) as a,
                       cast(l_shipdate as date) as b
                from lineitem join orders on l_orderkey = o_orderkey))""",
    "verdict": f"""
        with {JUDGED}
        select key, l_linenumber, player_id, cast(ns as integer) as name_score,
               coalesce(rel = 'exact', false) as dob_exact,
               coalesce(rel = 'swapped', false) as dob_swapped, {sql_round('gap', 2)} as dob_gap,
               case when token then 'ali widget' else 'ali' end as shared_tokens, sport_ok,
               verdict, cast(confidence as integer) as confidence from c""",
    "best_candidate": f"""
        with {JUDGED}
        select key, player_id, verdict, cast(confidence as integer) as confidence,
               cast(ns as integer) as name_score
        from (select *, row_number() over (partition by key order by
                case verdict when 'auto' then 3 when 'review' then 2 else 1 end desc,
                confidence desc, ns desc, player_id) as rn from c) where rn = 1""",
    "name_tokens": f"""
        select doc_id, len(t) as n_tokens,
               len(list_filter(t, lambda x: not list_contains(
                 {linkage.COMMON_FIRST_NAMES!r}, x))) as n_distinctive
        from (select doc_id, list_filter(list_distinct(regexp_extract_all(lower(text), '[a-z]+')),
                lambda x: length(x) >= 3 and not list_contains({linkage.PARTICLES!r}, x)) as t
              from documents)""",
    "ladder": """
        select c_name as name,
               case verdict when 'exact' then s_suppkey when 'mrn_exact' then n_nationkey
                    when 'manual_confirmed' then c_custkey end as sams_id,
               case verdict when 'exact' then s_name when 'mrn_exact' then n_name end as sams_name,
               verdict, case when verdict = 'dummy' then 0 else 100 end as confidence
        from (select *, case when c_acctbal < 0 then 'dummy' when s_suppkey <> 0 then 'exact'
                when n_nationkey <> 0 then 'mrn_exact'
                when c_mktsegment = 'HOUSEHOLD' then 'dummy'
                when c_mktsegment = 'FURNITURE' and c_custkey <> 0 then 'manual_confirmed'
                when c_mktsegment in ('FURNITURE', 'BUILDING') then 'manual_rejected' end as verdict
              from customer left join supplier on c_custkey = s_suppkey
              left join (select * from nation where n_regionkey < 3) on n_nationkey = c_nationkey)
        where verdict is not null""",
    "row_uid": """
        select o_orderkey, concat(h[1:8], '-', h[9:12], '-5', h[14:16], '-',
               substr('89ab', 1 + (strpos('0123456789abcdef', h[17]) - 1) % 4, 1), h[18:20], '-',
               h[21:32]) as row_uid
        from (select o_orderkey, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(
                concat(o_custkey, '|', strftime(o_orderdate, '%Y-%m-%d'), '|', o_orderpriority)))
                as h from orders)""",
    "resolve_ids": """
        select c_custkey as player_id, cast(c_nationkey as varchar) as mrn,
               case when a.s_suppkey is not null then 'player_id'
                    when b.nk is not null then 'mrn' end as resolved_by,
               coalesce(a.s_name, b.name) as sams_name,
               lpad(cast(coalesce(a.s_suppkey, b.suppkey) as varchar), 12, '0') as vald_id
        from customer left join supplier as a on a.s_suppkey = c_custkey
        left join (select s_nationkey as nk, min(s_name) as name, arg_min(s_suppkey, s_name)
                     as suppkey from supplier where s_acctbal > 0 group by s_nationkey) as b
          on b.nk = c_nationkey""",
    "mrn_lookup": """
        select cast(s_nationkey as varchar) as mrn_key, max(s_suppkey) as s_suppkey,
               arg_max(s_name, s_suppkey) as sams_name from supplier group by s_nationkey""",
    "current_enrollment": """
        select o_custkey as "playerId", o_orderstatus = 'F' as "isPrimary",
               strftime(o_orderdate, '%Y-%m-%d') as "startDate", o_orderkey as "disciplineId"
        from orders where o_totalprice <= 400000
        qualify row_number() over (partition by o_custkey order by o_orderstatus = 'F' desc,
                                   o_orderdate desc, o_orderkey desc) = 1""",
    "athlete_cards": """
        with e as (select *, case o_orderpriority when '1-URGENT' then 6 when '5-LOW' then 2 end
                     as sid from orders where o_totalprice <= 400000
                   qualify row_number() over (partition by o_custkey order by
                     o_orderstatus = 'F' desc, o_orderdate desc, o_orderkey desc) = 1),
        c as (select *, date '2000-03-01' - cast(floor(abs(c_acctbal)) as integer) as dob
              from customer)
        select c_custkey as player_id, c_name as full_name, strftime(dob, '%Y-%m-%d')
                 as date_of_birth,
               2024 - year(dob) - case when 130 < month(dob)*100 + day(dob) then 1 else 0 end as age,
               case when c_nationkey < 10 then 'Female' else 'Male' end as sex,
               coalesce(sid, c_nationkey + 1) as sport_id,
               case when sid = 6 then 'Swim' when sid = 2 then 'Fencing'
                    else ['Athletics', 'Fencing', 'Padel', 'Squash', 'Table Tennis', 'Swimming',
                          'Shooting'][c_nationkey + 1] end as sport,
               c_acctbal > 0 as is_active,
               case c_mktsegment when 'BUILDING' then true when 'MACHINERY' then false end
                 as is_target,
               o_orderkey as discipline_id, o_orderpriority as discipline,
               o_orderpriority as target_event, o_orderstatus as player_type
        from c left join e on o_custkey = c_custkey""",
    "sport_roster": """
        select distinct case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end
                 as plan_sport_id, s_suppkey as player_id, s_name as full_name,
               cast(s_nationkey as varchar) as mrn,
               ['Athletics', 'Fencing', 'Padel', 'Squash', 'Table Tennis', 'Swimming',
                'Shooting'][nullif(s_nationkey, 0)] as sport
        from orders join lineitem on o_orderkey = l_orderkey join supplier on s_suppkey = l_suppkey
        where cast(o_orderdate as date) between date '2001-08-01' - 59 and date '2001-08-01'
          and s_suppkey <> 0""",
    "search_players": """
        select c_custkey as player_id, c_name as full_name, cast(c_nationkey as varchar) as mrn,
               c_nationkey + 1 as sport_id,
               ['Athletics', 'Fencing', 'Padel', 'Squash', 'Table Tennis', 'Swimming',
                'Shooting'][c_nationkey + 1] as sport, true as is_active
        from customer where c_acctbal > 0 order by lower(c_name), c_custkey limit 50""",
    "lookup_either": """
        select c_custkey, c_name from customer
        where lower(c_mktsegment) = 'machinery' or lower(c_name) = 'machinery'""",
    "athletes_by_mrn": """
        select cast(n_nationkey as varchar) as wanted_mrn, min(c_custkey) as player_id
        from nation left join customer on c_nationkey = n_nationkey group by n_nationkey""",
}

_WORD = "split_part(p_name, ' ', -1)"
SQL["token_set"] = f"""
    with names as (select distinct p_name as a, lower(p_type) as t, {_WORD} as w, p_brand as b
                   from part),
    -- The last word is shared; what is left of each side is compared.
    rest as (select *, left(a, length(a) - length(w) - 1) as x,
                    list_aggregate(list_sort([t, b]), 'string_agg', ' ') as y,
                    list_aggregate(list_sort(string_split(a, ' ')), 'string_agg', ' ') as full_a
             from names),
    lens as (select *, length(x) as lx, length(y) as ly, length(w) as lw,
                    {_lcs('x', 'y')} as m, {_lcs('full_a', 'b')} as mb from rest),
    scores as (select *, case when x = t then 100e0 else greatest(100e0 - 100e0*(lx + ly - 2*m)/(2*(lw + 1) + lx + ly),
                      100e0 - 100e0*(1 + lx)/(2*lw + 1 + lx),
                      100e0 - 100e0*(1 + ly)/(2*lw + 1 + ly)) end as s1,
                    100e0 - 100e0*(length(full_a) + length(b) - 2*mb)/(length(full_a) + length(b))
                      as s2
               from lens)
    select p_partkey, {sql_round('s1', 6)} as near, {sql_round('s2', 6)} as far
    from part join scores on p_name = a and lower(p_type) = t and p_brand = b"""

SQL["similar_names"] = f"""
    with names as (select distinct p_name as n, split_part(p_name, ' ', 1) as w1,
                          split_part(p_name, ' ', 2) as w2 from part),
    pairs as (select a.n as a, b.n as b,
                case when a.w1 = b.w1 then a.w1 when a.w2 = b.w2 then a.w2 end as w,
                case when a.w1 = b.w1 then a.w2 when a.w2 = b.w2 then a.w1
                     else least(a.w1, a.w2) || ' ' || greatest(a.w1, a.w2) end as x,
                case when a.w1 = b.w1 then b.w2 when a.w2 = b.w2 then b.w1
                     else least(b.w1, b.w2) || ' ' || greatest(b.w1, b.w2) end as y
              from names as a, names as b),
    lens as (select *, length(x) as lx, length(y) as ly, length(w) as lw, {_lcs('x', 'y')} as m
             from pairs),
    scores as (select a, b, case when a = b then 100e0
                 when w is null then 100e0 - 100e0*(lx + ly - 2*m)/(lx + ly)
                 else greatest(100e0 - 100e0*(lx + ly - 2*m)/(2*(lw + 1) + lx + ly),
                               100e0 - 100e0*(1 + lx)/(2*lw + 1 + lx),
                               100e0 - 100e0*(1 + ly)/(2*lw + 1 + ly)) end as score
               from lens)
    select a as name, p_partkey as player_id, {sql_round('score', 6)} as score
    from (select a, p_partkey, score, row_number() over (partition by a
            order by score desc, p_partkey) as k
          from scores join part on p_name = b where score >= 55) where k <= 4"""

BORN = "date '2010-06-15' - cast(floor(abs({})) as integer)"

#: Best candidate of each input ``i(key, name, a, sport)`` in the roster ``r(pid, y, b, sport)``,
#: with scores from elsewhere in ``g(key, pid, gs)``.
LINKED = f"""
    s as (select key, name, pid, a, b, i.sport <> r.sport as clash,
                 length(name) + length(y) as total, {_lcs('name', 'y')} as m from i, r),
    t as (select *, 100e0 - 100e0*(total - 2*m)/total as score from s),
    k as (select *, row_number() over (partition by key order by score desc, pid) as nth from t),
    c0 as (select k.*, coalesce(gs, floor(score)) as ns, {REL} as rel, abs(a - b)/365.25e0 as gap
           from k left join g on g.key = k.key and g.pid = k.pid
           where (nth <= 4 and score >= 55) or (a = b and not (month(a) = 1 and day(a) = 1))),
    c1 as (select *, rel is not null as strong from c0),
    c as (select *, case when clash and not strong then 'reject'
            when strong and not clash and ns >= 85 then 'auto'
            when ns >= 92 and gap <= 1 and not clash then 'auto'
            when gap > 2 then 'reject' when strong or ns >= 80 then 'review'
            else 'reject' end as verdict,
            least(100, ns + case rel when 'exact' then 18 when 'swapped' then 14 else 0 end)
              as confidence from c1),
    best as (select * from (select *, row_number() over (partition by key order by
               case verdict when 'auto' then 3 when 'review' then 2 else 1 end desc,
               confidence desc, ns desc, pid) as rn from c) where rn = 1)"""

TOLD = """
    case when pid is not null then coalesce(rel = 'exact', false) end as dob_exact"""

ROSTERS = f"""
    i as (select s_suppkey as key, s_name as name, {BORN.format('s_acctbal')} as a,
                 'Athletics' as sport from supplier),
    r as (select c_custkey as pid, c_name as y, {BORN.format('c_acctbal')} as b,
                 case when c_mktsegment = 'MACHINERY' then 'Swimming' else 'Athletics' end as sport
          from customer)"""

RESOLVED = f"""
    select i.key, i.name, case when verdict = 'auto' then pid end as player_id,
           pid as candidate_player_id, coalesce(verdict, 'no_match') as verdict,
           cast(coalesce(confidence, 0) as integer) as confidence,
           cast(ns as integer) as name_score, {TOLD}
    from i left join best on best.key = i.key"""

SQL["resolve_entities"] = f"""
    with {ROSTERS}, g as (select 0 as key, 0 as pid, 0 as gs where false), {LINKED} {RESOLVED}"""

SQL["resolve_scored"] = f"""
    with {ROSTERS},
    g as (select l_suppkey as key, o_custkey as pid, least(100, 60 + 10*count(*)) as gs
          from lineitem join orders on l_orderkey = o_orderkey group by all), {LINKED} {RESOLVED}"""

SQL["ladder_linked"] = f"""
    with known as ({SQL['ladder']}),
    i as (select c_name as key, c_name as name, {BORN.format('c_acctbal')} as a,
                 case when c_mktsegment = 'MACHINERY' then 'Swimming' else 'Athletics' end as sport
          from customer where c_name not in (select name from known)),
    r as (select s_suppkey as pid, s_name as y, {BORN.format('s_acctbal')} as b,
                 'Athletics' as sport from supplier),
    g as (select '' as key, 0 as pid, 0 as gs where false), {LINKED}
    select name, cast(sams_id as integer) as sams_id, sams_name, verdict, confidence,
           cast(null as integer) as candidate_player_id, cast(null as integer) as name_score,
           cast(null as boolean) as dob_exact from known
    union all
    select i.name, case when verdict = 'auto' then cast(pid as integer) end,
           case when verdict = 'auto' then s_name end, coalesce(verdict, 'no_match'),
           cast(coalesce(confidence, 0) as integer), cast(pid as integer), cast(ns as integer),
           {TOLD}
    from i left join best on best.key = i.key left join supplier on s_suppkey = pid"""
