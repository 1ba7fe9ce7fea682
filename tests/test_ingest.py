from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from perfspark.operators import ingest
from perfspark.sources import envelopes, keyed, ledger, tables
from perfspark.sources.versions import VersionedStore


def test_profile(spark):
    rows = [("1.5", "10:20", None, "x" * 300), ("2", "11:30", None, "y"), (None, "", " ", "z")]
    df = spark.createDataFrame(rows, "n string, t string, e string, l string")
    got = {r.column: r.sql_type for r in ingest.column_profile(df).collect()}
    assert got == {"n": "DOUBLE", "t": "VARCHAR(40)", "e": "VARCHAR(100)", "l": "TEXT"}


def test_ranges(spark):
    df = spark.createDataFrame([("165", 1), ("999", 2), (None, 3), ("tall", 4)], "height_cm string, i int")
    rules = {"height_cm": (100, 230), "missing": (0, 1)}
    report = ingest.range_report(df, rules, order=["i"]).collect()
    assert [(r.column, r.n_checked, r.n_out_of_range, r.examples) for r in report] == [
        ("height_cm", 2, 1, [999.0])]
    kept = [r.height_cm for r in ingest.null_out_of_range(df, rules).orderBy("i").collect()]
    assert kept == ["165", None, None, "tall"]


def test_future(spark):
    df = spark.createDataFrame([("2030-01-01",), ("2020-01-01",), ("x",)], "d string")
    out = ingest.future_rows(df, "d", F.lit("2024-01-01").cast("timestamp"))
    assert [r.d for r in out.collect()] == ["2030-01-01"]


def test_lane_end_to_end_and_idempotent(spark, tmp_path):
    df = spark.createDataFrame([("Ann", "2024-01-01", "165", "1"), ("Bob", "2024-01-02", "999", "2"),
                                ("Ann", "2024-01-03", "166", "3")],
                               ["Name", "Date", "Height (cm)", "ID"])
    exact = spark.createDataFrame([("Ann", 7, "Ann A")], "name string, sams_player_id int, sams_name string")
    roster = spark.createDataFrame([(1, "Zed", "2000-01-02", "Squash")],
                                   "player_id int, full_name string, dob string, sport string")
    made = ingest.ingest_lane(df, name_column="name", date_column="date",
                              natural_key=["name", "date"], rules={"height_cm": (100, 230)},
                              as_of=F.lit("2024-01-02").cast("timestamp"), exact=exact, roster=roster)
    assert made.types["height_cm"] == "DOUBLE" and made.types["id_x"] == "DOUBLE"
    assert made.future.count() == 1 and made.report.first().n_out_of_range == 1
    target = keyed.KeyedTable(spark, str(tmp_path / "t"), ["row_uid"])
    assert target.upsert(made.rows).count() == 0
    first = sorted(target.read().collect(), key=str)
    target.upsert(made.rows)
    assert sorted(target.read().collect(), key=str) == first and len(first) == 3
    got = {(r.source_name, r.sams_id, r.match_verdict, r.height_cm) for r in first}
    assert got == {("Ann", 7, "exact", 165.0), ("Ann", 7, "exact", 166.0), ("Bob", None, "no_match", None)}


KV = "k int, v string"


def test_unchanged_rows_are_checked_but_not_written_again(spark, tmp_path):
    target = keyed.KeyedTable(spark, str(tmp_path / "t"), ["row_uid"])

    def load(day, *rows):
        frame = spark.createDataFrame(rows, "row_uid string, v double")
        made = ingest.Ingested(frame, {}, None, None)
        return ingest.load(made, target, F.lit(day).cast("date")).collect()

    assert load("2024-01-01", ("a", 1.0), ("b", None), ("c", 3.0)) == []
    assert load("2024-02-01", ("a", 1.0), ("b", None), ("c", 3.0)) == []
    rejected = load("2024-03-01", ("a", 1.0), ("a", 2.0), ("b", 5.0), ("c", 3.0), ("d", None))
    assert sorted((r.row_uid, r.v, r.reject_reason) for r in rejected) == [
        ("a", 1.0, "duplicate key in batch"), ("a", 2.0, "duplicate key in batch")]
    sizes = [target._stacked([n]).count() for n in target._live()]
    assert sizes == [3, 0, 2]
    got = {r.row_uid: (r.v, str(r.created_at), str(r.updated_at)) for r in target.read().collect()}
    assert got == {"a": (1.0, "2024-01-01", "2024-01-01"), "b": (5.0, "2024-01-01", "2024-03-01"),
                   "c": (3.0, "2024-01-01", "2024-01-01"), "d": (None, "2024-03-01", "2024-03-01")}


def test_upsert_rejects_and_compacts(spark, tmp_path):
    target = keyed.KeyedTable(spark, str(tmp_path / "kv"), ["k"])
    target.upsert(spark.createDataFrame([(1, "a"), (2, "b")], KV))
    bad = target.upsert(spark.createDataFrame([(2, "B"), (3, "c"), (3, "d"), (None, "n")], KV))
    assert {(r.k, r.reject_reason) for r in bad.collect()} == {
        (3, "duplicate key in batch"), (None, "null key")}
    assert sorted(target.read().collect()) == [(1, "a"), (2, "B")]
    target.compact()
    assert sorted(target.read().collect()) == [(1, "a"), (2, "B")]
    target.upsert(spark.createDataFrame([(1, "z")], KV))
    assert sorted(target.read().collect()) == [(1, "z"), (2, "B")]


def test_replace_children(spark, tmp_path):
    target = keyed.ChildTable(spark, str(tmp_path / "c"), "k")
    target.replace(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], KV),
                   spark.createDataFrame([(1,), (2,)], "k int"))
    with pytest.raises(Exception):
        broken = spark.createDataFrame([(1, "x")], KV).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
        target.replace(broken, spark.createDataFrame([(1,)], "k int"))
    assert sorted(target.read().collect()) == [(1, "a"), (1, "b"), (2, "c")]
    target.replace(spark.createDataFrame([(1, "n")], KV), spark.createDataFrame([(1,)], "k int"))
    assert sorted(target.read().collect()) == [(1, "n"), (2, "c")]
    target.replace(spark.createDataFrame([], KV), spark.createDataFrame([(2,)], "k int"))
    assert sorted(target.read().collect()) == [(1, "n")]


def test_ledger(spark, tmp_path):
    book = ledger.DecisionLedger(spark, str(tmp_path / "ledger"))
    assert book.decisions().count() == 0
    book.record("a", None, "no", "2026-01-01")
    book.record("b", 3391, " YES ", "2026-01-01")
    book.record("a", None, "drop", "2026-01-02")
    got = {r.source_name: (r.sams_id, r.decision) for r in ledger.DecisionLedger(
        spark, str(tmp_path / "ledger")).decisions().collect()}
    assert got == {"a": (None, "drop"), "b": (3391, "yes")}
    with pytest.raises(Exception):
        book.record("c", None, "maybe", "2026-01-01")
    assert book.entries().count() == 3


def test_versions(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "store"), "ann")
    one = store.publish(spark.createDataFrame([(1, "a")], KV), "set")
    two = store.publish(spark.createDataFrame([(2, "b"), (3, "c")], KV), "set", title="t")
    assert (one["name"], one["rows"], two["rows"]) == ("ann/set", 1, 2)
    assert sorted(r.k for r in store.read("set").collect()) == [2, 3]
    assert [r.k for r in store.read("ann/set", one["version"]).collect()] == [1]
    with pytest.raises(LookupError):
        store.read("other/set")


def test_target_schema():
    schema = keyed.target_schema({"height_cm": "DOUBLE", "note": "TEXT"})
    assert not schema["row_uid"].nullable and schema["height_cm"].dataType.simpleString() == "double"
    text = keyed.create_statement("t", {"height_cm": "DOUBLE"})
    assert "`row_uid` string NOT NULL" in text and "`height_cm` double" in text


def test_batch_rows():
    assert tables.batch_rows(100) == 200 and tables.batch_rows(1000) == 50


def test_table_query(spark):
    df = spark.createDataFrame([(i, str(i % 2)) for i in range(10)], KV)
    out = tables.query_table(df, where="v = '1'", order_by="k", desc=True, limit=2, offset=1)
    assert [r.k for r in out.collect()] == [7, 5]
    with pytest.raises(ValueError):
        tables.query_table(df, offset=1)
    df.createOrReplaceTempView("kv")
    assert tables.sql_with_params(spark, "select * from kv where k > :k", {"k": 7}).count() == 2
    with pytest.raises(ValueError):
        tables.sql_with_params(spark, "drop table kv")


def test_jdbc(spark):
    url = "jdbc:derby:memory:perf;create=true"
    driver = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(i, float(i)) for i in range(100)], "ID int, V double")
    tables.write_jdbc(df, url, "T", mode="overwrite", **driver)
    back = tables.read_jdbc(spark, url, "T", column="ID", bounds=(0, 100), partitions=2, **driver)
    assert back.rdd.getNumPartitions() == 2
    low = back.where("ID < 10")
    assert low.count() == 10
    assert "*LessThan(ID,10)" in low._jdf.queryExecution().executedPlan().toString()


def test_headerless(spark, tmp_path):
    (tmp_path / "r.csv").write_text('1,"a,b"\n2,c\n')
    out = tables.read_headerless(spark, str(tmp_path / "r.csv"))
    assert out.columns == ["col_0", "col_1"] and out.first().col_1 == "a,b"


def test_envelopes(spark):
    bodies = ['{"result":{"data":{"records":[{"a":1},{"a":2}]}}}', '{"result":{"data":{"total":42}}}',
              '[{"a":3}]', '{"items":[{"a":4}]}', '{"data":[{"a":5}]}', '{"rows":[{"a":6}]}',
              '{"records":[{"a":7}]}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert sorted(r.a for r in envelopes.unwrap(df, "a: int").collect()) == [1, 2, 3, 4, 5, 6, 7]
    fails = spark.createDataFrame([('{"result":{"success":false,"error":"bad"}}',),
                                   ('{"result":{"success":true}}',)], "body string")
    ok, failed = envelopes.split_failures(fails)
    assert ok.count() == 1 and failed.first().error == "bad"
    with pytest.raises(Exception, match="bad"):
        envelopes.split_failures(fails, strict=True)[0].collect()


def test_writers_never_share_a_number_and_plans_stay_small(spark, tmp_path):
    root = str(tmp_path / "many")
    a, b = (keyed.KeyedTable(spark, root, ["k"], fold=5) for _ in range(2))
    first, second = a._claim(), b._claim()
    assert first != second
    b._stage(spark.createDataFrame([(1, "late")], KV), second)
    b._commit(second)
    for i in range(12):
        a.upsert(spark.createDataFrame([(i, "new"), (100, str(i))], KV))
        assert len(a._live()) <= 6
    a._stage(spark.createDataFrame([(1, "early"), (200, "kept")], KV), first)
    a._commit(first)
    got = {r.k: r.v for r in a.read().collect()}
    assert got == {**{i: "new" for i in range(12)}, 100: "11", 200: "kept"}
    assert len(a.read()._jdf.queryExecution().toString()) < 20_000


def test_rows_are_rewritten_once_a_level(spark, tmp_path):
    """Writes of one new key and one old one each; two levels of three."""
    target = keyed.KeyedTable(spark, str(tmp_path / "levels"), ["k"], fold=2)
    for i in range(18):
        target.upsert(spark.createDataFrame([(i, f"new {i}"), (i // 2, f"by {i}")][:1 + (i > 1)], KV))
    want = {}
    for i in range(18):
        want[i] = f"new {i}"
        want[i // 2] = f"by {i}" if i > 1 else want[i // 2]
    assert {r.k: r.v for r in target.read().collect()} == want
    levels = sorted(target._levels().values())
    assert levels == [2, 2]
    written = spark.read.option("recursiveFileLookup", True).parquet(
        str(tmp_path / "levels" / "rows")).count()
    assert written <= 3 * (2 * 18 - 2)
    target.compact()
    assert {r.k: r.v for r in target.read().collect()} == want


def test_children_through_levels(spark, tmp_path):
    """Parents replaced again, emptied and left alone, in folded and open generations."""
    target, want = keyed.ChildTable(spark, str(tmp_path / "c"), "k", fold=2), {}
    for i in range(11):
        listed, rows = [i % 4, 10 + i // 3], [(i % 4, f"{i}a"), (i % 4, f"{i}b")]
        rows = rows if i % 5 else []
        rows += [(10 + i // 3, f"{i}")]
        target.replace(spark.createDataFrame(rows, KV),
                       spark.createDataFrame([(p,) for p in listed], "k int"))
        want.update({p: sorted(v for k, v in rows if k == p) for p in listed})
    got = {}
    for r in target.read().collect():
        got.setdefault(r.k, []).append(r.v)
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    assert len(target._live()) < 6


def test_ledger_calls_are_ordered_without_reading_them(spark, tmp_path):
    a, b = (ledger.DecisionLedger(spark, str(tmp_path / "book")) for _ in range(2))
    a.record("x", 1, "yes", "2026-01-01")
    b.record("x", 2, "yes", "2026-01-01")
    assert [r.batch for r in a.entries().orderBy("batch").collect()] == [1, 2]
    assert a.decisions().first().sams_id == 2
