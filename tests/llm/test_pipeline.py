from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline as pipeline
import pytest

from helpers import rows
from perfspark.llm import linededup, queries, simhash

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Each stage's input and output."""
    folder, docs, out = tmp_path_factory.mktemp("steps"), queries.table(spark, SF, "documents"), {}
    for name, stage in pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = (before, docs)
    return out


def test_all_but_the_last_keep_the_columns(spark, steps):
    columns = queries.table(spark, SF, "documents").columns
    assert [n for n, _ in pipeline.STAGES] == list(steps)
    for name, (_, after) in list(steps.items())[:-1]:
        assert after.columns == columns, name


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    before, after = steps["toxicity"]
    label = {r.doc_id: r.toxic for r in queries.table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in after.collect()}
    clean, toxic = ([i for i, t in label.items() if t == x] for x in (0, 1))
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)
    assert sum(i in kept for i in toxic) <= 0.4 * len(toxic)
    assert before.count() > len(kept)


def test_common_lines_go(steps):
    before, after = steps["line_dedup"]
    key = linededup.line_key
    texts = {r.doc_id: (r.text or "").encode().split(b"\n") for r in before.collect()}
    seen = Counter(k for lines in texts.values() for k in {key(x) for x in lines} if k)
    for r in after.collect():
        lines = [x for x in texts[r.doc_id] if not key(x) or seen[key(x)] < 10]
        assert r.text.encode() == b"\n".join(lines) and r.n_chars == len(r.text)


def test_one_of_each_group_stays(steps):
    before, after = steps["simhash_near_dedup"]
    prints = {r.doc_id: simhash.fingerprint((r.text or "").encode()) for r in before.collect()}
    label = {i: i for i in prints}
    for _ in prints:
        turned = {i: min(label[j] for j, q in prints.items() if (p ^ q).bit_count() <= 4)
                  for i, p in prints.items()}
        if turned == label:
            break
        label = turned
    assert {r.doc_id for r in after.collect()} == set(label.values())


def test_mix_takes_near_its_targets(steps):
    before, after = steps["mixing"]
    size = {r.doc_id: (r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text)))
            for r in before.collect()}
    times = Counter(r.doc_id for r in after.collect())
    assert max(times.values()) <= 2
    taken, whole = sum(n * size[i][1] for i, n in times.items()), sum(s for _, s in size.values())
    assert abs(taken - 1.5 * whole) <= len({s for s, _ in size.values()})


def test_packing_holds_every_document(steps):
    before, after = steps["packing"]
    copies = Counter(r.doc_id for r in before.collect())
    total = defaultdict(int)
    n = {}
    for r in after.collect():
        total[r.doc_id] += r.length
        n[r.doc_id] = r.doc_tokens
    assert {i: n[i] * c for i, c in copies.items()} == dict(total)


def test_run_gives_the_last_stage(spark, steps):
    got = pipeline.run(spark, SF)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.columns == columns
    assert rows(got, *columns) == rows(steps["packing"][1], *columns)
