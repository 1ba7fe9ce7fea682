"""Ingest, write-path and source queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..operators import ingest
from ..session import shared_dir
from ..sources import envelopes, keyed, ledger as ledgers, tables
from ..sources.versions import VersionedStore
from ..functions.ids import sanitize_columns
from ..functions.numbers import iso
from ..streaming.incremental import NewestTable, daily_stream, ingest_stream, keep_daily
from .common import sql_sum, table

RULES = {"l_quantity": (5, 45), "l_discount": (0.01, 0.09), "l_extendedprice": (2000, 80000)}


def _fresh(spark, name: str) -> str:
    """A new directory in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def validate_report(spark, d):
    return ingest.range_counts(table(spark, d, "lineitem"), RULES)


def validate_examples(spark, d):
    """The first five offending values per column by order and line."""
    return ingest.range_examples(table(spark, d, "lineitem"), RULES,
                                 order=["l_orderkey", "l_linenumber", "l_partkey"])


def range_report(spark, d):
    """Both in one: counts with the offending examples."""
    out = ingest.range_report(table(spark, d, "lineitem"), RULES,
                              order=["l_orderkey", "l_linenumber", "l_partkey"])
    return out.select("column", "n_checked", "n_out_of_range",
                      F.size("examples").alias("n_examples"),
                      F.try_element_at("examples", F.lit(1)).alias("first_example"))


def validated_rows(spark, d):
    out = ingest.null_out_of_range(table(spark, d, "lineitem"), RULES)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                      "l_discount", "l_extendedprice")


def column_profile(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return ingest.column_profile(docs).unionAll(ingest.column_profile(table(spark, d, "events")))


def clean_columns(spark, d):
    """Documents under the headings of a messy sheet."""
    sheet = table(spark, d, "documents").select(
        F.col("doc_id").alias("ID"), F.col("n_chars").alias("Height (cm)"),
        F.col("lang").alias("5 Bound Standing"), F.col("source").alias("Tf / Tc"),
        F.col("lang").alias("TF.TC"))
    return sanitize_columns(sheet)


def target_columns(spark, d):
    """The table that profiled orders ask for, column by column."""
    types = {r["column"]: r["sql_type"] for r in ingest.column_profile(
        table(spark, d, "orders")).collect()}
    fields = keyed.target_schema(types).fields
    return spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(fields)],
        "position int, name string, type string, nullable boolean")


def future_dates(spark, d):
    out = ingest.future_rows(table(spark, d, "events"), "ts",
                             F.lit("2024-01-20").cast("timestamp"))
    return out.select("event_id")


# --- writes: each reads back what it wrote to the shared folder ------------------------------

def _generations(spark, d) -> tuple[DataFrame, DataFrame]:
    """All orders, and a newer generation of the finished ones at half price."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                         "o_totalprice")
    newer = o.where(F.col("o_orderstatus") == "F").withColumn(
        "o_totalprice", F.col("o_totalprice") * 0.5)
    return o, newer


def upsert(spark, d):
    first, second = _generations(spark, d)
    target = keyed.KeyedTable(spark, _fresh(spark, "upsert"), ["o_orderkey"])
    target.upsert(first)
    target.upsert(second)
    target.upsert(second)
    return target.read()


def replace_children(spark, d):
    """Orders of customers who have a finished one are replaced by those finished ones."""
    first, second = _generations(spark, d)
    target = keyed.ChildTable(spark, _fresh(spark, "children"), "o_custkey")
    target.replace(first, first)
    target.replace(second, second)
    return target.read()


def versioned_read(spark, d):
    """The latest of two published versions."""
    first, second = _generations(spark, d)
    store = VersionedStore(spark, _fresh(spark, "published"), "bench")
    store.publish(first, "orders", kind="parquet")
    store.publish(second, "orders", kind="parquet")
    return store.read("orders")


def ledger(spark, d):
    """Orders as decisions about customers; the last one of each counts."""
    said = F.when(F.col("o_orderstatus") == "F", "yes").when(
        F.col("o_orderstatus") == "O", " NO ").otherwise("drop")
    rows = table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("source_name"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("sams_id"),
        said.alias("decision"), iso("o_orderdate").alias("decided_on"),
        F.col("o_orderkey").alias("seq"))
    book = ledgers.DecisionLedger(spark, _fresh(spark, "ledger"))
    book.record_all(rows)
    return book.decisions().select("source_name", "sams_id", "decision", "decided_on")


# --- sources ---------------------------------------------------------------------------------

def table_query(spark, d):
    """A page of the finished orders by price: the 100 after the first 50."""
    return tables.query_table(
        table(spark, d, "orders"), where="o_orderstatus = 'F' AND o_totalprice > 1000",
        order_by="o_totalprice", desc=True, tie=["o_orderkey"], limit=100, offset=50,
        columns=["o_orderkey", "o_totalprice"])


def curated_view(spark, d):
    out = tables.read_view(table(spark, d, "lineitem"), l_linestatus="F", l_returnflag="R")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def sql_params(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("perf_orders")
    return tables.sql_with_params(
        spark, "SELECT o_custkey, count(*) AS n FROM perf_orders WHERE o_orderstatus = :status "
               "GROUP BY o_custkey", {"status": "O"})


def _responses(spark, d) -> DataFrame:
    """Events wrapped as API responses of four shapes, one in five of them a failure."""
    record = F.concat(F.lit('{"id": '), F.col("event_id"), F.lit(', "props": '), F.col("props"),
                      F.lit("}"))
    kind = F.col("event_type")
    body = (F.when(kind == "click", F.concat(
                F.lit('{"result": {"success": true, "data": {"records": ['), record, F.lit("]}}}")))
            .when(kind == "view", F.concat(F.lit('{"items": ['), record, F.lit("]}")))
            .when(kind == "signup", F.concat(F.lit("["), record, F.lit("]")))
            .when(kind == "purchase", F.lit('{"result": {"data": {"total": 42}}}'))
            .otherwise(F.concat(F.lit('{"result": {"success": false, "error": "no '),
                                F.col("event_id"), F.lit('"}}'))))
    return table(spark, d, "events").select("event_id", body.alias("body"))


def envelope_unwrap(spark, d):
    out = envelopes.unwrap(_responses(spark, d), "id:bigint,props:struct<k:int>",
                           keep=["event_id"])
    return out.select("event_id", "id", F.col("props.k").alias("k"))


def write_guard(spark, d):
    _, failed = envelopes.split_failures(_responses(spark, d))
    return failed.select("event_id", "error")


def full_extract(spark, d):
    """A whole table, published and read back with a check that it is complete."""
    store = VersionedStore(spark, _fresh(spark, "extract"), "bench")
    store.publish(table(spark, d, "customer"), "customer", kind="parquet")
    return store.read("customer", complete=True)


def ingest_roundtrip(spark, d):
    """A messy sheet of orders to the stored table and back: loaded, loaded again later, and
    loaded once more with other heights for one status."""
    def sheet(raised: int) -> DataFrame:
        height = F.floor(F.col("o_totalprice") / 1000).cast("int") + F.when(
            F.col("o_orderstatus") == "P", raised).otherwise(0)
        rows = table(spark, d, "orders").join(table(spark, d, "customer"),
                                              F.col("o_custkey") == F.col("c_custkey"))
        return rows.select(
            F.col("o_orderkey").alias("ID"), F.col("c_name").alias("Athlete Name"),
            iso("o_orderdate").alias("Test Date"),
            F.when(F.col("o_orderkey") % 50 == 0, "n/a").otherwise(height.cast("string"))
            .alias("Height (cm)"))

    people = table(spark, d, "customer")
    evidence = {
        "exact": people.where("c_nationkey < 10").select(
            F.col("c_name").alias("name"), F.col("c_custkey").alias("sams_player_id"),
            F.col("c_name").alias("sams_name")),
        "ledger": people.where("c_nationkey >= 20").select(
            F.col("c_name").alias("source_name"), F.lit(None).cast("int").alias("sams_id"),
            F.lit("no").alias("decision"))}
    target = keyed.KeyedTable(spark, _fresh(spark, "lane"), ["row_uid"])
    for raised, day in ((0, "2024-01-01"), (0, "2024-02-01"), (3, "2024-03-01")):
        made = ingest.ingest_lane(
            sheet(raised), name_column="athlete_name", date_column="test_date",
            natural_key=["id_x", "test_date"], rules={"height_cm": (50, 400)},
            as_of=F.lit("2030-01-01").cast("timestamp"), entered_by="lane", **evidence)
        ingest.load(made, target, F.lit(day).cast("date"))
    return target.read().select("row_uid", "record_date", "source_name", "sams_id", "sams_name",
                                "match_verdict", "height_cm", "created_at", "updated_at")


def headerless(spark, d):
    """Orders exported without a header line and read back."""
    path = _fresh(spark, "export")
    table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                     "o_orderpriority").write.csv(path)
    return tables.read_headerless(spark, path)


# --- streams: over the files that are there, then read back -----------------------------------

def _event_stream(spark, d) -> DataFrame:
    schema = table(spark, d, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .parquet(d))


def daily_stream_table(spark, d):
    """Best, total and count per user, event and day, kept by a stream."""
    keys = ["user_id", "event_type"]
    target = NewestTable(spark, _fresh(spark, "daily"), [*keys, "date"], ["n"])
    daily = daily_stream(_event_stream(spark, d), keys=keys, ts="ts", value="value")
    keep_daily(daily, target, _fresh(spark, "daily-log")).awaitTermination()
    return target.read().withColumn("date", iso("date"))


def ingest_stream_table(spark, d):
    """The newest event of each user and kind, range-checked on its way in."""
    target = NewestTable(spark, _fresh(spark, "ingest"), ["row_uid"], ["ts", "event_id"])
    rows = _event_stream(spark, d).select("event_id", "user_id", "event_type", "ts", "value")
    ingest_stream(rows, target, _fresh(spark, "ingest-log"), natural_key=["user_id", "event_type"],
                  rules={"value": (0, 80)}).awaitTermination()
    return target.read().select("user_id", "event_type", "event_id", "value")


QUERIES = {f.__name__: f for f in (
    range_report, clean_columns, target_columns, full_extract, ingest_roundtrip, headerless,
    daily_stream_table, ingest_stream_table, validate_report, validate_examples, validated_rows, column_profile, future_dates, upsert,
    replace_children, versioned_read, ledger, table_query, curated_view, sql_params,
    envelope_unwrap, write_guard)}


# --- SQL twins -------------------------------------------------------------------------------

def _bad(c: str) -> str:
    lo, hi = RULES[c]
    return f"not ({c} between {lo} and {hi})"


def _profile(source: str, column: str) -> str:
    v = f"nullif(trim(cast({column} as varchar)), '')"
    return (f"select '{column}' as \"column\", count({v}) as n_values, "
            f"count(try_cast({v} as double)) as n_numeric, max(length({v})) as max_len "
            f"from {source}")


PROFILED = [("documents", c) for c in ("doc_id", "text", "lang", "source", "n_chars")] + [
    ("events", c) for c in ("event_id", "user_id", "event_type", "ts", "value", "props")]
ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
          "o_orderpriority")
# The identity head of an ingest target.
HEAD = [("row_uid", "string", False), ("event_uuid", "string", False),
        ("group_uuid", "string", True), ("record_date", "date", True),
        ("source_name", "string", True), ("entered_by", "string", True),
        ("sams_id", "int", True), ("sams_name", "string", True),
        ("match_verdict", "string", True), ("match_confidence", "int", True)]

SQL = {
    "validate_report": " union all ".join(
        f"select '{c}' as \"column\", count({c}) as n_checked, "
        f"count(case when {_bad(c)} then 1 end) as n_out_of_range from lineitem" for c in RULES),
    "validate_examples": "select \"column\", rank, example from (" + " union all ".join(
        f"select '{c}' as \"column\", row_number() over (order by l_orderkey, l_linenumber, "
        f"l_partkey, {c}) as rank, {c} as example from lineitem where {_bad(c)}"
        for c in RULES) + ") where rank <= 5",
    "range_report": " union all ".join(f"""
        select '{c}' as "column", count({c}) as n_checked,
               count(case when {_bad(c)} then 1 end) as n_out_of_range,
               least(5, count(case when {_bad(c)} then 1 end)) as n_examples,
               arg_min({c}, (l_orderkey, l_linenumber, l_partkey, {c}))
                 filter ({_bad(c)}) as first_example from lineitem""" for c in RULES),
    "clean_columns": """
        select doc_id as id_x, n_chars as height_cm, lang as c_5_bound_standing,
               source as tf_tc, lang as tf_tc_x from documents""",
    "target_columns": f"""
        with head as (select * from (values {", ".join(
            f"({i}, '{n}', '{t}', {str(x).lower()})" for i, (n, t, x) in enumerate(HEAD))})
              as h(position, name, type, nullable)),
        profile as ({" union all ".join(
            f"select {len(HEAD) + i} as position, * from ({_profile('orders', c)})"
            for i, c in enumerate(ORDERS))})
        select * from head union all
        select position, "column", case when n_numeric/n_values >= 0.95 then 'double'
                 else 'string' end, true from profile""",
    "full_extract": "select * from customer",
    "ingest_roundtrip": """
        select concat(h[1:8], '-', h[9:12], '-5', h[14:16], '-',
                 substr('89ab', 1 + (strpos('0123456789abcdef', h[17]) - 1) % 4, 1), h[18:20], '-',
                 h[21:32]) as row_uid, day as record_date, c_name as source_name,
               case when known then cast(c_custkey as integer) end as sams_id,
               case when known then c_name end as sams_name,
               case when known then 'exact' when c_nationkey >= 20
                    then 'manual_rejected' end as match_verdict,
               now_is as height_cm, date '2024-01-01' as created_at,
               case when was is distinct from now_is then date '2024-03-01'
                    else date '2024-01-01' end as updated_at
        from (select *, c_nationkey < 10 and c_custkey <> 0 as known, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(
                concat(o_orderkey, '|', strftime(day, '%Y-%m-%d')))) as h,
                case when o_orderkey % 50 <> 0 and v between 50 and 400 then v end as was,
                case when o_orderkey % 50 <> 0 and v + r between 50 and 400 then v + r end as now_is
              from (select *, cast(o_orderdate as date) as day, floor(o_totalprice/1000) as v,
                      case when o_orderstatus = 'P' then 3e0 else 0e0 end as r
                    from orders join customer on o_custkey = c_custkey))""",
    "headerless": """
        select cast(o_orderkey as varchar) as col_0, cast(o_custkey as varchar) as col_1,
               o_orderstatus as col_2, o_orderpriority as col_3 from orders""",
    "daily_stream_table": f"""
        select user_id, event_type, strftime(cast(ts as date), '%Y-%m-%d') as date,
               max(value) as best, {sql_sum('value')} as load, count(*) as n
        from events where value is not null group by user_id, event_type, cast(ts as date)""",
    "ingest_stream_table": """
        select user_id, event_type, event_id,
               case when value between 0 and 80 then value end as value
        from events qualify row_number() over (partition by user_id, event_type
                                               order by ts desc, event_id desc) = 1""",
    "validated_rows": "select l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(
        f"case when {_bad(c)} then null else {c} end as {c}" for c in RULES) + " from lineitem",
    "column_profile": f"""
        select *, case when n_values = 0 then 'VARCHAR(100)'
                       when n_numeric/n_values >= 0.95 then 'DOUBLE'
                       when max_len <= 30 then 'VARCHAR(40)' when max_len <= 80 then 'VARCHAR(100)'
                       when max_len <= 250 then 'VARCHAR(255)' else 'TEXT' end as sql_type
        from ({' union all '.join(_profile(*p) for p in PROFILED)})""",
    "future_dates": "select event_id from events where ts > timestamp '2024-01-20'",
    "upsert": """
        select o_orderkey, o_custkey, o_orderstatus,
               case when o_orderstatus = 'F' then o_totalprice*0.5e0 else o_totalprice end
                 as o_totalprice from orders""",
    "replace_children": """
        select o_orderkey, o_custkey, o_orderstatus,
               case when o_orderstatus = 'F' then o_totalprice*0.5e0 else o_totalprice end
                 as o_totalprice
        from orders where o_orderstatus = 'F' or o_custkey not in
          (select o_custkey from orders where o_orderstatus = 'F')""",
    "versioned_read": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice*0.5e0 as o_totalprice
        from orders where o_orderstatus = 'F'""",
    "ledger": """
        select cast(o_custkey as varchar) as source_name,
               case when o_orderstatus = 'F' then o_custkey end as sams_id,
               case o_orderstatus when 'F' then 'yes' when 'O' then 'no' else 'drop' end
                 as decision, strftime(o_orderdate, '%Y-%m-%d') as decided_on
        from orders qualify row_number() over (partition by o_custkey
                                               order by o_orderkey desc) = 1""",
    "table_query": """
        select o_orderkey, o_totalprice from orders
        where o_orderstatus = 'F' and o_totalprice > 1000
        order by o_totalprice desc, o_orderkey limit 100 offset 50""",
    "curated_view": """
        select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem
        where l_linestatus = 'F' and l_returnflag = 'R'""",
    "sql_params": """
        select o_custkey, count(*) as n from orders where o_orderstatus = 'O'
        group by o_custkey""",
    "envelope_unwrap": """
        select event_id, event_id as id, cast(json_extract_string(props, '$.k') as integer) as k
        from events where event_type in ('click', 'view', 'signup')""",
    "write_guard": """
        select event_id, 'no ' || cast(event_id as varchar) as error
        from events where event_type = 'error'""",
}
