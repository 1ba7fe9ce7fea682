"""Retrieval, corpus and leak-scan queries over whole documents and whole query texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import leakscan, retrieval
from .common import table

K = 5


def _queries(spark, d) -> DataFrame:
    return table(spark, d, "benchmark").withColumnRenamed("item_id", "query_id")


def bm25_topk(spark, d):
    """Every benchmark text as a query over all documents."""
    return retrieval.bm25_topk(_queries(spark, d), table(spark, d, "documents"), k=K)


def bm25_by_source(spark, d):
    """The same within one source, with the hit's text length."""
    docs = retrieval.from_source(table(spark, d, "documents"), "src7")
    ranked = retrieval.bm25_topk(_queries(spark, d), docs, k=K)
    return retrieval.hits(ranked, docs, columns=("source", "n_chars"))


def vector_topk(spark, d):
    """Every vector as a query over all vectors (itself included)."""
    v = table(spark, d, "embeddings")
    return retrieval.vector_topk(v.withColumnRenamed("vec_id", "query_id"), v, k=K)


def _lists(spark, d) -> list[DataFrame]:
    """Ranked lists of the benchmark items by words and, with vectors standing in by number, by
    direction."""
    words = bm25_topk(spark, d)
    v = table(spark, d, "embeddings")
    asked = v.join(_queries(spark, d), F.col("vec_id") == F.col("query_id")).select(
        "query_id", "embedding")
    near = retrieval.vector_topk(asked, v, k=K).withColumnRenamed("vec_id", "doc_id")
    return [words, near]


def hybrid_rrf(spark, d):
    return retrieval.fuse(_lists(spark, d), k=K)


def multi_query(spark, d):
    """Each text in full and by its longer words as two wordings of one query."""
    q = _queries(spark, d)
    longer = F.filter(retrieval.tokens("text"), lambda t: F.length(t) >= 6)
    short = q.withColumn("text", F.array_join(longer, " "))
    both = q.withColumn("variant", F.lit(0)).unionByName(short.withColumn("variant", F.lit(1)))
    worded = both.withColumn("wording", F.col("query_id") * 10 + F.col("variant"))
    ranked = retrieval.bm25_topk(worded.select("wording", "text"), table(spark, d, "documents"),
                                 k=K, query="wording")
    keyed = ranked.withColumn("query_id", F.floor(F.col("wording") / 10))
    return retrieval.fuse_variants(keyed, k=K)


#: Characters of a chunk, to count the chunks of a document.
CHUNK_CHARS = 1000


def corpus_stats(spark, d):
    """Documents, chunks and the highest number per source and in total."""
    return retrieval.corpus_stats(table(spark, d, "documents"),
                                  chunks=F.ceil(F.col("n_chars") / CHUNK_CHARS), posted="doc_id")


def doc_reassembly(spark, d):
    """Conversations as text, one ``[role] text`` line per turn."""
    line = F.concat(F.lit("["), F.col("role"), F.lit("] "), F.col("text"))
    return retrieval.reassemble(table(spark, d, "conversations"), doc="conv_id", position="turn",
                                line=line)


# --- leak scan -------------------------------------------------------------------------------

#: Listed values: words that the generated texts use.
LISTED = ["tion", "eaux", "://", "the ", "@", "<script>"]


#: Invented values of every kind, in parts so that no file holds one whole, then an address with
#: placeholder credentials; document ``n`` gets the line of number ``n`` modulo 16, if there is one.
WOVEN = [("-----BEGIN RSA ", "PRIVATE KEY-----"), ("sk-", "ant-abcdefghijklmnop1234"),
         ("sk-", "proj-abcdefghijklmnop1234"), ("gh", "p_abcdefghijklmnopqrstuvwxyz012345"),
         ("AK", "IAABCDEFGHIJKLMNOP"), ("ey", "Jabcdefghijk.lmnopqrstuvw.xyzabcdefgh"),
         ("db://root:", "hunter2@host/x"), ("db://user:", "password@host/x")]


def leak_scan(spark, d):
    """Documents, with invented secrets woven in, and the raw web pages against the built-in
    detectors."""
    line = F.try_element_at(F.array(*[F.lit("".join(w)) for w in WOVEN]),
                            (F.pmod("doc_id", F.lit(16)) + 1).cast("int"))
    docs = table(spark, d, "documents").withColumn("text", F.concat(
        F.lit("first line\n"), F.coalesce(line, F.lit("")), F.lit("\n"), F.col("text")))
    return leakscan.scan(_with_pages(docs, spark, d), doc="doc")


def _texts(spark, d) -> DataFrame:
    return _with_pages(table(spark, d, "documents"), spark, d)


def _with_pages(docs: DataFrame, spark, d) -> DataFrame:
    return docs.select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("doc"), "text").unionAll(
        table(spark, d, "pages").select(F.concat(F.lit("p"), F.col("page_id")),
                                        F.concat_ws("\n", "url", "html")))


def word_scan(spark, d):
    """The scanner with patterns of its caller: addresses and long numbers."""
    return leakscan.scan(_texts(spark, d), doc="doc", patterns=WORD_RULES)


WORD_RULES = [("mail", r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}"), ("number", r"[0-9]{6,}"),
              ("link", r"https?://[A-Za-z0-9./?=&#_-]+")]


def deny_list(spark, d):
    return leakscan.deny_scan(_texts(spark, d), LISTED, doc="doc")


def deny_table(spark, d):
    """Documents against every longer word of the benchmark texts, as a list that is a table."""
    words = table(spark, d, "benchmark").select(F.explode(retrieval.tokens("text")).alias("value"))
    return leakscan.deny_table(table(spark, d, "documents"), words.where(F.length("value") >= 9))


def scan_summary(spark, d):
    return leakscan.scan_summary(_texts(spark, d), word_scan(spark, d))


QUERIES = {f.__name__: f for f in (
    bm25_topk, bm25_by_source, vector_topk, hybrid_rrf, multi_query, corpus_stats,
    doc_reassembly, leak_scan, word_scan, deny_list, deny_table,
    scan_summary)}


# --- SQL twins -------------------------------------------------------------------------------

def _tokens(c: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def _bm25(queries: str, key: str, docs: str = "documents") -> str:
    return f"""
    d as (select doc_id, {_tokens('text')} as toks from {docs}),
    size as (select count(*) as n, sum(len(toks))/count(*) as avg_tokens from d),
    post as (select doc_id, len(toks) as n_tokens, term, count(*) as tf
             from (select doc_id, toks, unnest(toks) as term from d) group by all),
    qt as (select distinct {key}, term from (select {key}, unnest({_tokens('text')}) as term
                                             from ({queries}))),
    freq as (select term, count(*) as df from post where term in (select term from qt)
             group by term),
    scored as (select {key}, doc_id, floor((sum(cast(round_even(1e9*
                 (ln(1e0 + (n - df + 0.5e0)/(df + 0.5e0))*(tf*2.2e0)
                   /(tf + 1.2e0*(0.25e0 + 0.75e0*n_tokens/avg_tokens))), 0) as bigint)) + 500)
                 /1000e0)/1e6 as score
               from post join qt using (term) join freq using (term), size
               group by {key}, doc_id),
    words as (select * from (select *, row_number() over (partition by {key}
                order by score desc, doc_id) as rank from scored) where rank <= {K})"""


def _cosine(queries: str) -> str:
    return f"""
    e as (select vec_id, cast(embedding as double[]) as v from embeddings),
    near as (select * from (select *, row_number() over (partition by query_id
               order by score desc, vec_id) as rank
             from (select q.vec_id as query_id, e.vec_id,
                          cast(round(cast(list_cosine_similarity(q.v, e.v) as decimal(18,9)), 6)
                            as double) as score
                   from ({queries}) as q, e)) where rank <= {K})"""


def _fused(ranked: str, keys: str = "query_id") -> str:
    return f"""
    select query_id, doc_id, score, rank from (
      select *, row_number() over (partition by query_id order by score desc, doc_id) as rank
      from (select query_id, doc_id, cast(round(sum(cast(1e0/(rank + 60) as decimal(28,12))), 9)
              as double) as score from ({ranked}) group by query_id, doc_id)) where rank <= {K}"""


QUERY_TEXTS = "select item_id as query_id, text from benchmark"

def _texts_sql(text: str = "text") -> str:
    return f"""
    texts as (select 'd' || doc_id as doc, {text} as text from documents
              union all select 'p' || page_id, url || chr(10) || html from pages),
    lines as (select doc, unnest(string_split(text, chr(10))) as line,
                     generate_subscripts(string_split(text, chr(10)), 1) as line_no from texts)"""


TEXTS = _texts_sql()
WOVEN_TEXT = ("'first line' || chr(10) || coalesce(case doc_id % 16 " + " ".join(
    f"when {i} then '{a}' || '{b}'" for i, (a, b) in enumerate(WOVEN))
    + " end, '') || chr(10) || text")


def _scan(rules: list[tuple[str, str]]) -> str:
    def one(label: str, rule: str) -> str:
        text = rule.replace("'", "''")
        return (f"select doc, line_no, '{label}' as label, "
                f"unnest(regexp_extract_all(line, '{text}')) as m from lines")

    placeholder = leakscan.PLACEHOLDER.replace("'", "''")
    return f"""
        select doc, cast(line_no as integer) as line_no, label, substr(m, 1, 48) as found
        from ({' union all '.join(one(*r) for r in rules)})
        where not (label = '{leakscan.URL_LABEL}' and regexp_matches(m, '{placeholder}'))"""


SQL = {
    "bm25_topk": f"with {_bm25(QUERY_TEXTS, 'query_id')} select query_id, doc_id, score, rank "
                 "from words",
    "bm25_by_source": f"""
        with s as (select * from documents where source = 'src7'),
        {_bm25(QUERY_TEXTS, 'query_id', 's')}
        select query_id, words.doc_id, score, rank, source, n_chars
        from words join documents on documents.doc_id = words.doc_id""",
    "vector_topk": f"with {_cosine('select * from e')} select query_id, vec_id, score, rank "
                   "from near",
    "hybrid_rrf": f"""
        with {_bm25(QUERY_TEXTS, 'query_id')},
        {_cosine('select e.* from e join benchmark on item_id = vec_id')}
        {_fused('select query_id, doc_id, rank from words union all '
                'select query_id, vec_id, rank from near')}""",
    "multi_query": f"""
        with w as (select item_id*10 as wording, text from benchmark
                   union all select item_id*10 + 1, array_to_string(list_filter(
                     {_tokens('text')}, lambda t: length(t) >= 6), ' ') from benchmark),
        {_bm25('select * from w', 'wording')}
        {_fused('select wording//10 as query_id, doc_id, rank from words')}""",
    "corpus_stats": f"""
        select source, count(*) as n_docs,
               cast(sum(ceil(n_chars/{CHUNK_CHARS}e0)) as bigint) as n_chunks,
               max(doc_id) as latest, grouping(source) = 1 as is_total
        from documents group by rollup (source)""",
    "doc_reassembly": """
        select conv_id, count(*) as n_chunks,
               string_agg('[' || role || '] ' || text, chr(10) order by turn) as text
        from conversations group by conv_id""",
    "leak_scan": f"with {_texts_sql(WOVEN_TEXT)} {_scan(leakscan.PATTERNS)}",
    "word_scan": f"with {TEXTS} {_scan(WORD_RULES)}",
    "deny_list": f"""
        with {TEXTS}
        select doc, len(string_split(substr(text, 1, strpos(text, value) - 1), chr(10)))
                 as line_no, value
        from texts, (select unnest({LISTED!r}) as value) where strpos(text, value) > 0""",
    "deny_table": f"""
        with listed as (select distinct value from (select unnest({_tokens('text')}) as value
                                                    from benchmark) where length(value) >= 9)
        select doc_id, cast(len(string_split(substr(text, 1, strpos(text, value) - 1), chr(10)))
                            as integer) as line_no, value
        from documents, listed where strpos(text, value) > 0""",
    "scan_summary": f"""
        with {TEXTS}
        select (select count(*) from texts) as n_scanned, count(*) as n_findings,
               count(*) = 0 as clean
        from ({_scan(WORD_RULES)})""",
}
