from __future__ import annotations

import random

import pytest

from helpers import docs, prose, rows
from perfspark.llm import toxicity
from perfspark.llm.toxicity import Grammar

LABELS = "doc_id long, quality int, toxic int"


def _grammar():
    return Grammar(words={"idiot": 4.0}, stems={"lowei": 4.0}, bias=-2.0, slope=1.0)


def _evidence(text):
    g = _grammar()
    return g.evidence(text, g.arcs())


def test_clauses_compose_target_negation_and_report():
    plain = _evidence("what an idiot")
    assert plain == 4.0
    assert _evidence("you are an idiot") == 6.0
    assert _evidence("he is not an idiot") == pytest.approx(1.6)
    assert _evidence("he is not what one would call an idiot") == plain
    assert _evidence("they said idiot") == pytest.approx(2.4)
    assert _evidence("idiot. idiot") == 2 * plain
    assert _evidence("ein Loweisch da") == plain
    assert _evidence("idiotic lower xlowei") == 0.0


def test_threats_need_a_target():
    assert _evidence("I will kill you") == pytest.approx(4.5)
    assert _evidence("they kill time") == 0.0
    assert _evidence("I will never kill you") == pytest.approx(1.8)


def _corpus():
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(400):
        text = prose(rng.randint(20, 90), i)
        toxic = i % 5 == 0
        if toxic:
            words = text.split(" ")
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["scum", "Moron", "gromish",
                                                                     "gromata", "gromel"]))
            text = " ".join(words)
        texts.append(text)
        labels.append(int(toxic))
    return texts, labels


def test_learned_grammar_separates_held_out_rows(spark):
    texts, labels = _corpus()
    known = spark.createDataFrame([(i, 1, t) for i, t in enumerate(labels)], LABELS)
    out = toxicity.score(docs(spark, texts, clash=True).drop("score"), known)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(texts)
    assert all(got[i].predicted == t for i, t in enumerate(labels))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_labels_of_held_out_rows_are_never_read(spark):
    texts, labels = _corpus()
    frame = docs(spark, texts).select("doc_id", "text")
    held = {r.doc_id for r in frame.where(toxicity.held_out("doc_id", 5)).collect()}
    turned = [(i, 1, 1 - t if i in held else t) for i, t in enumerate(labels)]
    plain = [(i, 1, t) for i, t in enumerate(labels)]
    a, b = (rows(toxicity.score(frame, spark.createDataFrame(x, LABELS)), "doc_id", "score")
            for x in (plain, turned))
    assert a == b


def test_copies_of_one_toxic_text_teach_no_word(spark):
    text = "lone words in one copied text about nothing scum"
    texts = [text] * 60 + [prose(30, i) for i in range(100)]
    known = spark.createDataFrame([(i, 1, int(i < 60)) for i in range(160)], LABELS)
    train = toxicity.training_rows(docs(spark, texts), known)
    assert toxicity.fit(train).words == {}


def test_edges(spark):
    none = spark.createDataFrame([], LABELS)
    frame = docs(spark, [None, "", "x " * 200_000, "kill you"], ids=[None, 1, 1, 2])
    got = rows(toxicity.score(frame, none), "doc_id", "predicted")
    assert got == [(1, 0), (1, 0), (2, 1), (None, 0)]
    assert toxicity.score(docs(spark, []), none).count() == 0
    odd = spark.createDataFrame([(1, None, None), (None, 0, 1), (2, 0, 7), (2, 0, 1), (2, 1, 0)],
                                LABELS)
    assert toxicity.score(frame, odd).count() == 4
