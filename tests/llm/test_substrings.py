from __future__ import annotations

import random

import numpy as np

from helpers import docs, prose
import pyarrow as pa
from perfspark.llm import substrings
from perfspark.llm.common import components


def _found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_planted_passages_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(4)
    passages = [prose(60 + 10 * i, 900 + i) for i in range(4)]
    texts, planted = [], {}
    for i in range(60):
        text = prose(120, i, 50_000)
        if i < 24:
            p = passages[i % 4]
            words = text.split(" ")
            at = rng.randrange(len(words))
            text = " ".join([*words[:at], p, *words[at:]])
            planted[i] = p
        texts.append(text)
    got = _found(substrings.repeated_passages(docs(spark, texts, clash=True)))
    assert set(got) == set(planted)
    for i, spans in got.items():
        covered = sum(r.n_words for r in spans)
        assert covered >= 0.5 * len(planted[i].split())
        for r in spans:
            # A line that is the passage but for a few words of its host is near the others' line.
            span = set(texts[i][r.start:r.start + r.length].split())
            assert len(span & set(planted[i].split())) >= 0.75 * len(span)
            assert r.run_words >= 30
            assert r.first_doc_id % 4 == i % 4 and r.kept == (r.first_doc_id == i)
    assert all(any(r.kept for r in got[i]) for i in range(4))


def test_passages_without_punctuation_and_of_short_lines_are_found(spark):
    rng = random.Random(31)

    def words(n):
        return [f"w{rng.randrange(50_000)}" for _ in range(n)]

    def lines(own):
        out = []
        while own:
            n = rng.randint(3, 5)
            out.append(" ".join(own[:n]))
            own = own[n:]
        return "\n".join(out)

    texts, sizes = [], {}
    for n in (50, 55, 70, 100, 150, 200):
        for shape in (" ".join, lines):
            passage = shape(words(n))
            for _ in range(2):
                sizes[len(texts)] = n
                # Hosts so long that whole lines are not near each other.
                texts.append(f"{' '.join(words(300))} {passage} {' '.join(words(300))}")
    texts += [" ".join(words(600)), lines(words(600))]
    got = _found(substrings.repeated_passages(docs(spark, texts)))
    assert set(got) == set(sizes)
    for i, spans in got.items():
        assert len(spans) == 1 and spans[0].kept == (i % 2 == 0)
        assert spans[0].first_doc_id == i - i % 2
        assert sizes[i] - 18 <= spans[0].n_words <= sizes[i]
        span = texts[i][spans[0].start:spans[0].start + spans[0].length]
        assert len(span.split()) == spans[0].n_words and span in texts[i - i % 2]


def test_edited_lines_cluster_by_exact_jaccard(spark):
    line = " ".join(f"w{i}" for i in range(100))
    near = line.replace("w50 ", "v50 ")
    far = " ".join(f"w{i}" if i % 9 else f"u{i}" for i in range(100))
    got = _found(substrings.repeated_passages(docs(spark, [line, near, far, prose(99, 3)])))
    assert set(got) == {0, 1}
    assert {r.cluster_id for v in got.values() for r in v} == {got[0][0].cluster_id}
    assert (got[0][0].kept, got[1][0].kept) == (True, False)


def test_links_against_brute_force(spark):
    rng = random.Random(6)
    lines = []
    for c in range(12):
        base = [f"t{rng.randrange(500)}" for _ in range(60)]
        for _ in range(8):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(60)] = f"x{rng.randrange(99)}"
            lines.append(" ".join(own))
    frame = docs(spark, lines)
    units = frame.selectExpr("doc_id as d", "text").mapInArrow(
        substrings._read_units, substrings.UNITS).cache()
    unit = {r.d: r.unit for r in units.where("kind = 0").collect()}
    for chunk in (256, 2):
        root = {r.node: r.root for r in substrings.line_clusters(frame, units, chunk=chunk
                                                                 ).collect()}
        sets = [{tuple(x.split()[i:i + 5]) for i in range(56)} for x in lines]
        link = np.array([[len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets])
        reach = np.linalg.matrix_power(link.astype(float), 64) > 0
        for i in range(len(lines)):
            for j in range(i):
                a, b = (root.get(unit[k], unit[k]) for k in (i, j))
                assert (a == b) == bool(reach[i, j])


def test_edges(spark):
    texts = [None, "", "\n\n", "short line here", "word " * 50_000, prose(40, 1), prose(40, 1)]
    ids = [None, 1, 2, 3, 4, 5, 5]
    assert substrings.repeated_passages(docs(spark, texts, ids=ids)).count() == 0
    assert substrings.repeated_passages(docs(spark, [])).count() == 0


def test_texts_without_an_id_are_one_document(spark):
    """A passage shared by a text without an id and document 3 is kept in the latter; one shared by
    two texts without an id repeats inside one document. Texts of one id keep their positions."""
    a, b, c = (prose(60, 70 + i, 50_000) for i in range(3))
    pad = [prose(90, 80 + i, 50_000) for i in range(5)]
    texts = [f"{pad[0]}\n{b}\n{a}", f"{a}\n{pad[1]}", f"{pad[2]}\n{b}", f"{pad[3]}\n{c}",
             f"{c}\n{pad[4]}", f"{c}\n{pad[4]}", pad[0]]
    ids = [None, 3, None, 5, 6, 6, 6]
    out = substrings.repeated_passages(docs(spark, texts, ids=ids)).collect()
    by_hash = {r.h: r.text for r in docs(spark, texts).selectExpr("xxhash64(text) as h", "text")
               .collect()}
    found = {}
    for r in out:
        found.setdefault((r.doc_id, r.text_hash), []).append(r)
    spans = {(d, by_hash[h]): [(r.kept, r.first_doc_id) for r in sorted(v, key=lambda r: r.start)]
             for (d, h), v in found.items()}
    assert spans == {(None, texts[0]): [(False, 6), (False, 3)], (3, texts[1]): [(True, 3)],
                     (5, texts[3]): [(True, 5)], (6, texts[4]): [(False, 5)],
                     (6, texts[6]): [(True, 6)]}
    for r in out:
        shared = by_hash[r.text_hash][r.start:r.start + r.length]
        assert sum(w in shared.split() for w in f"{a} {c} {pad[0]}".split()) >= 30


def test_components_of_chains_and_stars(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)]
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)]
    links += [(7, 7), (-5, 3), (-5, 3)]
    label = {x: x for e in links for x in e}
    for _ in range(400):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")
                                              ).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: label[x] for x in linked}


def test_texts_hashed_together_have_the_units_of_each_alone(monkeypatch):
    texts = [prose(60, 1), "", None, "a b c", "w " * 12, "w " * 18, "É ü\n" * 30, prose(12, 2),
             "one, two three four five six seven. " * 4 + "\n" + prose(25, 3)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)],
                                       ["d", "text"])

    def units():
        return [b for b in substrings._read_units(iter([batch]))]

    together = units()
    monkeypatch.setattr(substrings, "WORDS", 0)
    alone = units()
    assert len(together) < len(alone)
    assert sorted(str(r) for b in together for r in b.to_pylist()) == sorted(
        str(r) for b in alone for r in b.to_pylist())
