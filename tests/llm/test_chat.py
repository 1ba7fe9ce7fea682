from __future__ import annotations

import hashlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from perfspark.llm import chat
from perfspark.llm.queries import PLANTED, op4_chat_events

EVENTS = "conv_id long, turn long, seq long, kind string, role string, text string"


def _fold(spark, rows):
    out = chat.fold(spark.createDataFrame(rows, EVENTS)).orderBy("conv_id", "turn").collect()
    return [tuple(r) for r in out]


def test_deltas_edits_and_regenerations_fold_in_sequence(spark):
    log = [(1, 0, 0, "message", "user", "hi"), (1, 0, 5, "edit", "user", "hello"),
           (1, 1, 1, "message", "assistant", ""), (1, 1, 3, "delta", None, "b"),
           (1, 1, 2, "delta", None, "a"), (1, 1, 4, "regenerate", None, "gone"),
           (1, 1, 6, "delta", None, "c"), (1, 1, 7, "delta", None, "d"),
           (2, 0, 0, "message", None, None)]
    assert _fold(spark, log) == [(1, 0, "user", "hello"), (1, 1, "assistant", "cd"),
                                 (2, 0, "", "")]
    assert _fold(spark, log[::-1]) == _fold(spark, log)


def test_order_of_ties_and_repeated_rows_is_fixed(spark):
    log = [(1, 0, 0, "message", "user", "b"), (1, 0, 0, "message", "user", "a"),
           (1, 0, 0, "message", "user", "a"), (None, None, None, None, None, "x")]
    assert _fold(spark, log) == [(None, None, "", "x"), (1, 0, "user", "aab")]


def test_empty_table(spark):
    none = spark.createDataFrame([], EVENTS)
    assert chat.render(chat.fold(none)).count() == 0


def _round_trip(spark, turns):
    data = [(0, i, role, text) for i, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    made = chat.render(df.withColumn("head", F.lit("x")))
    row = made.select("formatted", chat.parse(F.col("formatted")).alias("t"),
                      chat.masked(F.col("formatted"), F.col("mask")).alias("m")).first()
    return row.formatted, [(t.role, t.text) for t in row.t], row.m


def test_control_strings_come_back(spark):
    turns = [("user", PLANTED), ("assistant", PLANTED), ("a\nb<\\n|", "<\\|<<|\\\n\\|>é𝄞"),
             ("assistant", ""), ("assistant", "x" * 300_000)]
    text, back, loss = _round_trip(spark, turns)
    assert back == turns
    assert text.count(chat.START) == text.count(chat.END) == len(turns)
    assert loss == PLANTED + "x" * 300_000


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|", "a\n"]),
                          st.text(alphabet="<|\\>\nnim_aé", max_size=12)), min_size=1, max_size=4))
def test_any_text_comes_back(spark, turns):
    _, back, loss = _round_trip(spark, turns)
    assert back == turns
    assert loss == "".join(t for r, t in turns if r == "assistant")


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(0, 0, "user", "x")],
                               "conv_id long, turn long, role string, text string")
    plan = chat.render(chat.fold(chat.messages(df)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_that_share_a_turn_or_have_none_stay_messages_of_their_own(spark, tmp_path):
    rows = [(1, 0, "assistant", "yes"), (1, 0, "user", "no"), (1, 0, "user", "no"),
            (1, None, "assistant", "b"), (1, None, "user", "a"), (1, None, None, None),
            (2, None, "user", "x"), (2, None, "assistant", "y"), (2, 3, "user", "w"),
            (None, None, "assistant", "z"), (None, 1, "assistant", "z")]
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in op4_chat_events(spark, str(tmp_path)).collect()}
    told = {1: ["user", "no", "user", "no", "assistant", "yes", "user", "a", "", "",
                "assistant", "b"],
            2: ["user", "w", "user", "x", "assistant", "y"], None: ["assistant", "z"] * 2}
    loss = {1: "yesb", 2: "y", None: "zz"}
    for conv, parts in told.items():
        r, sha = got[conv], lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert (r.n_turns, r.loss_chars) == (len(parts) // 2, len(loss[conv]))
        assert r.turns_sha256 == sha("".join(p + "\n" for p in parts))
        assert r.loss_sha256 == sha(loss[conv])
