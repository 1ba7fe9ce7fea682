"""Ranked retrieval over a document table: BM25, vectors, rank fusion.

Queries are a table. All of them are answered in one job and each gets its ``k`` best documents;
the lists are cut by a ranked window that Spark limits before the shuffle.
"""

from __future__ import annotations

import json
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..plans.blocks import Visits, block_best, bounded_best
from ..plans.shapes import top_rows
from ..session import cut

# BM25 saturation and length weight, and the rank offset of the fusion.
K1, B, RRF = 1.2, 0.75, 60

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text: Column | str) -> Column:
    """Lower-case words: maximal runs of letters and digits of any script."""
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: t != "")


#: Stands once in every document's terms and carries its length; no word is empty.
WHOLE = ""


def _occurrences(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """``(doc, n_tokens, term)``, one row per token and one ``WHOLE`` per document."""
    # The length is taken before the explosion, or every token's row would carry the whole array.
    words = docs.select(doc, tokens(text).alias("_tokens")).select(
        doc, F.size("_tokens").alias("n_tokens"),
        F.concat(F.array(F.lit(WHOLE)), F.coalesce("_tokens", F.array().cast("array<string>")))
        .alias("_tokens"))
    # The outer form keeps Spark from testing the token array in a filter of its own, which would
    # split every text again.
    return words.select(doc, "n_tokens", F.explode_outer("_tokens").alias("term"))


def term_index(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, n_tokens, term, tf)``. Write it once and search it often."""
    return _occurrences(docs, doc, text).where(F.col("term") != WHOLE).groupBy(
        doc, "n_tokens", "term").agg(F.count(F.lit(1)).alias("tf"))


def corpus_size(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """One row: number of documents and mean length in tokens."""
    return docs.agg(F.count(F.lit(1)).alias("n_docs"),
                    (F.sum(F.size(tokens(text))) / F.count(F.lit(1))).alias("avg_tokens"))


#: Terms in more than this share of the documents are looked up for promising documents only.
COMMON = 0.25
#: Bands of document length per doubling; within a band a term's best contribution is tight.
BANDS = 2
#: Scores are added in billionths and shown in millionths; so much may change what is shown.
SHOWN = 1000


#: Up to so many pairs of queries and documents are scored without planning.
FEW_PAIRS = 1 << 25


def bm25_topk(queries: DataFrame, docs: DataFrame, *, k: int = 5, query: str = "query_id",
              query_text: str = "text", doc: str = "doc_id", text: str = "text",
              index: DataFrame | None = None, size: DataFrame | None = None,
              common: float = COMMON) -> DataFrame:
    """The ``k`` best documents per query: ``(query, doc, score, rank)``.

    Terms no query asks for leave the index before anything is joined. A query term counts once.
    Ties go to the smaller document id. ``index`` and ``size`` take a stored index. Few queries
    over few documents are scored in one plan; else rarer terms come first (``_rare_first``). The
    answers are the same."""
    named = (query, query_text, doc, text, index, size)
    if queries.count() * docs.count() <= FEW_PAIRS:
        return _in_one(queries, docs, k, *named)
    return _rare_first(queries, docs, k, common, *named)


def _in_one(queries: DataFrame, docs: DataFrame, k: int, query: str, query_text: str, doc: str,
            text: str, index: DataFrame | None, size: DataFrame | None) -> DataFrame:
    """One row per query and document that share a term."""
    asked = queries.select(F.col(query).alias(query),
                           F.explode(F.array_distinct(tokens(query_text))).alias("term"))
    wanted = asked.select("term").distinct()
    # Placed by document once, what is left of the index is counted and later summed per query and
    # document without moving again. A document is one input row, so no place gets too much.
    if index is None:
        whole = queries.sparkSession.range(1).select(F.lit(WHOLE).alias("term"))
        kept = (_occurrences(docs, doc, text).join(wanted.unionAll(whole), "term", "left_semi")
                .repartition(doc))
        postings = kept.groupBy(doc, "n_tokens", "term").agg(F.count(F.lit(1)).alias("tf"))
    else:
        postings = index.join(wanted, "term", "left_semi").repartition(doc)
    # Counting through ``tf`` and by condition keeps these branches identical up to the shuffle,
    # which is then reused: texts are read once for postings, frequencies and corpus size.
    freq = postings.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))
    stats = size
    if size is None and index is None:
        one = (F.col("term") == WHOLE) & (F.col("tf") > 0)
        stats = postings.agg(
            F.count_if(one).alias("n_docs"),
            (F.sum(F.when(one, F.greatest("n_tokens", F.lit(0)))) / F.count_if(one))
            .alias("avg_tokens"))
    elif size is None:
        stats = corpus_size(docs, text=text)
    n_docs = stats.select(F.col("n_docs").cast("double")).scalar()
    avg = stats.select("avg_tokens").scalar()
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = asked.join(freq, "term").withColumn("idf", idf)
    damp = K1 * (F.lit(1.0 - B) + F.lit(B) * F.col("n_tokens") / avg)
    part = F.col("idf") * (F.col("tf") * (K1 + 1.0)) / (F.col("tf") + damp)
    scored = (postings.join(weights, "term")
              .groupBy(query, doc)
              .agg(F.sum(F.rint(part * 1e9).cast("long")).alias("_score")))
    # Added as whole billionths (the order of rows cannot matter), shown to six decimals.
    scored = scored.select(query, doc, (F.floor((F.col("_score") + 500) / F.lit(1000)) / 1e6)
                           .alias("score"))
    return top_rows(scored, [query], [F.desc("score"), F.asc(doc)], k)


def _rare_first(queries: DataFrame, docs: DataFrame, k: int, common: float, query: str,
                query_text: str, doc: str, text: str, index: DataFrame | None,
                size: DataFrame | None) -> DataFrame:
    """Documents are first scored by a query's rarer terms alone; the ``k``-th best of these is a
    score that the answer reaches. Terms in more than the share ``common`` of the documents have an
    upper bound per band of document lengths, and only documents that could get there with them are
    looked up under them. Queries that a document might answer by common terms alone are scored in
    full."""
    # Written, so that Spark knows how small the queries are and does not sort postings for them.
    asked = cut(queries.select(F.col(query).alias(query),
                               F.explode(F.array_distinct(tokens(query_text))).alias("term")))
    wanted = cut(asked.select("term").distinct())
    whole = queries.sparkSession.range(1).select(F.lit(WHOLE).alias("term"))
    if index is None:
        kept = _occurrences(docs, doc, text).join(wanted.unionAll(whole), "term", "left_semi")
        found = kept.groupBy(doc, "n_tokens", "term").agg(F.count(F.lit(1)).alias("tf"))
    else:
        found = index.join(wanted, "term", "left_semi")
    # Texts are read once, for postings, frequencies and corpus size.
    postings = cut(found)
    freq = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    if size is None and index is None:
        size = postings.where(F.col("term") == WHOLE).agg(
            F.count(F.lit(1)).alias("n_docs"),
            (F.sum(F.greatest("n_tokens", F.lit(0))) / F.count(F.lit(1))).alias("avg_tokens"))
    elif size is None:
        size = corpus_size(docs, text=text)
    told = size.first()
    n_docs, avg = F.lit(float(told["n_docs"])), F.lit(told["avg_tokens"])
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    damp = K1 * (F.lit(1.0 - B) + F.lit(B) * F.col("n_tokens") / avg)
    part = F.col("idf") * (F.col("tf") * (K1 + 1.0)) / (F.col("tf") + damp)
    # Whole billionths: the order of rows cannot matter.
    freq = cut(freq)
    parts = (postings.where(F.col("term") != WHOLE).join(freq.withColumn("idf", idf), "term")
             .select(doc, "term", (F.col("df") > n_docs * common).alias("common"),
                     F.floor(F.log2(F.col("n_tokens") + 1) * BANDS).cast("int").alias("band"),
                     F.rint(part * 1e9).cast("long").alias("part")))
    parts = cut(parts)
    rare, often = parts.where(~F.col("common")), parts.where("common")

    def added(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("part").alias("_score"))

    partial = cut(added(asked.join(rare, "term"), query, doc, "band"))
    best = top_rows(partial, [query], [F.desc("_score")], k).groupBy(query).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_score").alias("_least"))
    tops = often.groupBy("term", "band").agg(F.max("part").alias("part"))
    more = added(asked.join(tops, "term"), query, "band").withColumnRenamed("_score", "_more")
    most = more.groupBy(query).agg(F.max("_more").alias("_most"))
    # A score known to be reached, for queries that common terms alone cannot answer.
    reached = best.where(F.col("_n") == k).join(most, query, "left").where(
        F.coalesce("_most", F.lit(0)) + SHOWN < F.col("_least")).select(query, "_least")
    reached = cut(reached)
    closed = cut(partial.join(reached, query).join(more, [query, "band"], "left")
                 .where(F.col("_score") + F.coalesce("_more", F.lit(0)) + SHOWN >= F.col("_least"))
                 .select(query, doc, F.col("_score").alias("part")))
    rest = (closed.select(query, doc).join(asked, query)
            .join(often.select(doc, "term", "part"), [doc, "term"]).select(query, doc, "part"))
    full = asked.join(reached, query, "left_anti").join(parts, "term").select(query, doc, "part")
    scored = added(closed.unionByName(rest).unionByName(full), query, doc).select(
        query, doc, (F.floor((F.col("_score") + SHOWN // 2) / F.lit(SHOWN)) / 1e6).alias("score"))
    return top_rows(scored, [query], [F.desc("score"), F.asc(doc)], k)


def _unit(rows: pd.Series) -> np.ndarray:
    m = np.stack([np.asarray(r, dtype=np.float64) for r in rows])
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _six_decimals(x: np.ndarray) -> np.ndarray:
    """Rounded half away from zero to six decimals, from nine, as fixed-point numbers are."""
    nine = np.rint(np.abs(x) * 1e9)
    return np.sign(x) * np.floor((nine + 500.0) / 1000.0) / 1e6 + 0.0


#: Up to so many times ``FEW_PAIRS`` (2**40) vectors meet block by block, as products of matrices;
#: without clusters among them planning visits every block anyway and moves the queries to each.
DENSE_TIMES = 1 << 15
#: Most rows of a side's block, and blocks that a smaller side is cut into.
DENSE_ROWS, DENSE_BLOCKS = 1 << 15, 12
#: Cells of one product of matrices.
CELLS = 1 << 21
#: Scores differ by less than this from what they are rounded to.
ROUNDED = 2e-6


def _nearest(qs: np.ndarray, vs: np.ndarray, ids: np.ndarray, k: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, vector, score)`` of the ``k`` nearest of a block's unit vectors; ties go to the
    smaller id."""
    take = min(k, len(vs))
    groups = max(take, min(256, len(vs)))
    edges = np.arange(groups) * len(vs) // groups
    li, ri, sc = [], [], []
    rows = max(1, CELLS // len(vs))
    for lo in range(0, len(qs), rows):
        raw = qs[lo:lo + rows] @ vs.T
        # Of the best of each group, the k-th is a score that the k nearest reach.
        tops = np.maximum.reduceat(raw, edges, axis=1)
        reached = np.partition(tops, groups - take, axis=1)[:, groups - take]
        i, j = np.nonzero(raw >= reached[:, None] - ROUNDED)
        score = _six_decimals(raw[i, j])
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        near = np.arange(len(i)) - np.searchsorted(i, i) < take
        li.append(i[near] + lo)
        ri.append(j[near])
        sc.append(score[near])
    return np.concatenate(li), np.concatenate(ri), np.concatenate(sc)


def _near_pivots(vectors: DataFrame, doc: str, pivots: int) -> DataFrame:
    """Adds the nearest of at most ``pivots`` sampled vectors and the angle to it; the sample is
    by least hash of the id and small enough to travel with the plan."""
    sample = vectors.orderBy(F.xxhash64(doc), doc).limit(pivots).toPandas()
    centres = _chained(_unit(sample["_v"]))

    def place(batches):
        for pdf in batches:
            cosine = _unit(pdf["_v"]) @ centres.T
            best = cosine.argmax(axis=1)
            angle = np.arccos(np.clip(cosine[np.arange(len(pdf)), best], -1, 1))
            yield pdf.assign(_pivot=best.astype("int32"), _angle=angle)

    schema = T.StructType([*vectors.schema, T.StructField("_pivot", T.IntegerType()),
                           T.StructField("_angle", T.DoubleType())])
    return vectors.mapInPandas(place, schema)


def _chained(units: np.ndarray) -> np.ndarray:
    """The vectors in an order in which each is followed by its nearest among the rest, so that a
    block that holds the end of one cluster and the start of the next stays narrow."""
    rest, order = np.ones(len(units), dtype=bool), [0]
    rest[0] = False
    while rest.any():
        cosine = np.where(rest, units @ units[order[-1]], -np.inf)
        order.append(int(cosine.argmax()))
        rest[order[-1]] = False
    return units[order]


def _ball(vectors: pd.Series) -> str:
    """Centre and radius, as an angle, of a block, and whether it holds a zero vector."""
    units = _unit(vectors)
    real = units[np.any(units, axis=1)]
    centre = real.sum(axis=0) if len(real) else units[0]
    norm = np.linalg.norm(centre)
    if norm:
        centre = centre / norm
    radius = float(np.arccos(np.clip((real @ centre).min(), -1, 1))) if norm and len(real) else 4.0
    return json.dumps([centre.tolist(), radius, len(real) < len(units)])


def _ball_bound(queries: pd.Series, told: list[str]) -> np.ndarray:
    """The greatest rounded cosine that each query can have in each block, by the triangle
    inequality of angles."""
    balls, units = [json.loads(t) for t in told], _unit(queries)
    centres = np.array([b[0] for b in balls])
    angle = np.arccos(np.clip(units @ centres.T, -1, 1)) - np.array([b[1] for b in balls])
    limit = np.cos(np.maximum(angle, 0.0)) + 1e-6
    zero = np.array([b[2] for b in balls])
    limit[:, zero] = np.maximum(limit[:, zero], 0.0)
    limit[~np.any(units, axis=1)] = 1e-6
    return limit


def vector_search(queries: DataFrame, vectors: DataFrame, *, k: int = 5,
                  query: str = "query_id", query_vector: str = "embedding", doc: str = "vec_id",
                  vector: str = "embedding", block_rows: int = 256, pivots: int = 256
                  ) -> tuple[DataFrame, Visits | None]:
    """``vector_topk`` and the clusters that queries visited (None for a search so small that all
    queries meet all vectors)."""
    left = queries.select(query, F.col(query_vector).alias("_q")).where(F.col("_q").isNotNull())
    right = vectors.select(doc, F.col(vector).alias("_v")).where(F.col("_v").isNotNull())

    def scorer(q: pd.DataFrame, v: pd.DataFrame, least: np.ndarray | None = None):
        return _nearest(_unit(q["_q"]), _unit(v["_v"]), v[doc].to_numpy(), k)

    rows = left.count(), right.count()
    ids = {"left_id": query, "right_id": doc, "k": k, "rows": rows}
    if rows[0] * rows[1] <= FEW_PAIRS * DENSE_TIMES:
        sizes = tuple(min(DENSE_ROWS, max(least, n // DENSE_BLOCKS))
                      for n, least in zip(rows, (1024, 8192), strict=True))
        return block_best(left, right, **ids, scorer=scorer, block_rows=sizes), None
    return bounded_best(
        left, _near_pivots(right, doc, pivots), **ids, floor=-2.0, block_rows=block_rows,
        order=[F.col("_pivot"), F.col("_angle"), F.col(doc)],
        summarise=lambda pdf: _ball(pdf["_v"]),
        bound=lambda pdf, told: _ball_bound(pdf["_q"], told), scorer=scorer)


def vector_topk(queries: DataFrame, vectors: DataFrame, *, k: int = 5, query: str = "query_id",
                query_vector: str = "embedding", doc: str = "vec_id",
                vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest vectors per query by cosine, exact: ``(query, doc, score, rank)``.

    Vectors lie in clusters around sampled ones. A query visits the clusters that its angle to
    their centre, less their radius, allows to hold a better vector than the ``k`` it has. Scores
    are kept to six decimals and ties go to the smaller id."""
    return vector_search(queries, vectors, k=k, query=query, query_vector=query_vector, doc=doc,
                         vector=vector)[0]


def fuse(lists: list[DataFrame], *, k: int = 5, query: str = "query_id",
         doc: str = "doc_id") -> DataFrame:
    """Reciprocal-rank fusion of ranked lists: the sum of 1 / (60 + rank) per document."""
    stacked = reduce(lambda a, b: a.unionByName(b), [r.select(query, doc, "rank") for r in lists])
    share = (F.lit(1.0) / (F.col("rank") + F.lit(RRF))).cast("decimal(28,12)")
    scored = stacked.groupBy(query, doc).agg(F.sum(share).alias("_score"))
    scored = scored.select(query, doc, F.round("_score", 9).cast("double").alias("score"))
    return top_rows(scored, [query], [F.desc("score"), F.asc(doc)], k)


def fuse_variants(ranked: DataFrame, *, k: int = 5, query: str = "query_id",
                  doc: str = "doc_id") -> DataFrame:
    """Fusion over the reformulations of each query: one ranked list per ``(query, variant)``."""
    return fuse([ranked], k=k, query=query, doc=doc)


def from_source(docs: DataFrame, source: str | None, column: str = "source") -> DataFrame:
    """Documents of one source; all without a source."""
    return docs if source is None else docs.where(F.col(column) == source)


def hits(ranked: DataFrame, docs: DataFrame, *, doc: str = "doc_id",
         columns: tuple[str, ...] = ("source", "text")) -> DataFrame:
    """Ranked rows with document columns added."""
    return ranked.join(docs.select(doc, *columns), doc)


def corpus_stats(docs: DataFrame, *, source: str = "source", chunks: Column | None = None,
                 posted: str | None = None) -> DataFrame:
    """Documents, chunks and newest date per source and, with a NULL source and ``is_total``, of
    the whole corpus, in one pass. A document is one chunk unless ``chunks`` counts them."""
    many = F.count(F.lit(1)) if chunks is None else F.sum(chunks)
    newest = F.max(posted) if posted else F.lit(None).cast("date")
    return docs.rollup(source).agg(
        F.count(F.lit(1)).alias("n_docs"), many.cast("long").alias("n_chunks"),
        newest.alias("latest"), (F.grouping(source) == 1).alias("is_total"))


def reassemble(chunks: DataFrame, *, doc: str, position: str, line: Column,
               separator: str = "\n") -> DataFrame:
    """All chunks of each document joined in order: ``(doc, n_chunks, text)``, one row each.

    A document is one text, however many chunks it has, so its lines meet in one row."""
    grouped = chunks.groupBy(doc).agg(
        F.array_sort(F.collect_list(F.struct(F.col(position).alias("at"), line.alias("line"))))
        .alias("_lines"), F.count(F.lit(1)).alias("n_chunks"))
    text = F.array_join(F.transform("_lines", lambda x: x["line"]), separator)
    return grouped.select(doc, "n_chunks", text.alias("text"))
