"""The registered queries of this subpackage, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableferry.llm import (bpe, divergence, infill, langid, mixing, neardup, pii, quality,
                            repeats, sharding, topk, toxicity, winnow)
from tableferry.llm.common import held_out
from tableferry.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

QUERY_EVERY = 50
SCALE = 256


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_bpe(spark, sf_dir):
    """Ids of every text and their decoded text, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    merges = bpe.Merges(tokenizer_path())
    ids = bpe.encode(docs, merges).select("doc_id", "ids")
    return bpe.decode(ids, merges).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op2_mixing(spark, sf_dir):
    """Every reading of a document in the mixture, with its block."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.planned(docs).select("doc_id", "source", F.col("tokens").alias("n_tokens"),
                                       F.col("pass").alias("pass_no"), "place", "block")


@query
def op3_topk(spark, sf_dir):
    """The five best inner products of every 50th vector."""
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", SCALE)
    return topk.top_k(vectors.where(F.col("id") % QUERY_EVERY == 0), vectors, 5)


@query
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    model = langid.fitted(docs)
    return langid.identified(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
        F.size("spans").cast("long").alias("n_spans"))


@query
def op6_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query
def op7_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fitted(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op9_fingerprints(spark, sf_dir):
    return winnow.edit_check(table(spark, sf_dir, "documents"))


@query
def op10_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_divergence(spark, sf_dir):
    """Divergence of the sources of each language, and the terms that set each source apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op12_fill_in_middle(spark, sf_dir):
    """Every text in its new order, and rebuilt from that, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return infill.restored(infill.fill_in_middle(docs).drop("text")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


@query
def op13_personal_data(spark, sf_dir):
    """Spans of personal data in every text, the base kinds counted and digested."""
    docs = pii.found(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(list(pii.BASE)))
    return docs.select(
        "doc_id", *[pii.count_of(F.col("spans"), k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"))


WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

ORACLE["op2_mixing"] = rf"""
WITH docs AS (
  SELECT doc_id, source, len({WORDS.format('text')}) AS n_tokens FROM documents),
sums AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS t FROM docs GROUP BY source),
ends AS (SELECT CAST(min(t) AS DOUBLE) AS lo, CAST(max(t) AS DOUBLE) AS hi FROM sums WHERE t > 0),
ex AS (SELECT lo, hi, CASE WHEN hi / lo <= {mixing.MAX_REPEATS} THEN 0.0
              ELSE 1 - ln({mixing.MAX_REPEATS}) / ln(hi / lo) END AS e FROM ends),
budgets AS (
  SELECT source, t, CASE WHEN t > 0 THEN greatest(t, CAST(round(hi * pow(t / hi, e)) AS BIGINT))
                         ELSE 0 END AS budget FROM sums LEFT JOIN ex ON true),
plan AS (SELECT *, CAST(greatest(1, ceil(budget / greatest(t, 1))) AS INTEGER) AS passes,
                CAST(ceil((SELECT sum(budget) FROM budgets) / {float(mixing.BLOCK_TOKENS)}) AS BIGINT)
                  AS blocks FROM budgets),
reads AS (
  SELECT d.doc_id, d.source, d.n_tokens, p.t, p.budget, p.blocks, u.pass_no,
         CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || '|' || u.pass_no), 1, 15)
              AS BIGINT) AS place
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source,
       LATERAL (SELECT unnest(range(1, p.passes + 1)) AS pass_no) u),
run AS (
  SELECT *, (pass_no - 1) * t + coalesce(sum(n_tokens) OVER (
           PARTITION BY source, pass_no ORDER BY place, doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM reads)
SELECT doc_id, source, n_tokens, CAST(pass_no AS INTEGER) AS pass_no, place,
       CAST(least(floor((pass_no - 1 + place / {float(1 << mixing.PLACE_BITS)}) * t
            / greatest(budget, 1) * greatest(blocks, 1)), greatest(blocks, 1) - 1) AS BIGINT) AS block
FROM run WHERE pass_no = 1 OR before < budget"""

ORACLE["op3_topk"] = f"""
WITH sound AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, generate_subscripts(embedding, 1) AS at,
         CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM sound),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.at = c.at AND q.vec_id <> c.vec_id
  WHERE q.vec_id % {QUERY_EVERY} = 0 GROUP BY 1, 2)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
       AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 5"""

ORACLE["op7_substring_dedup"] = rf"""
WITH docs AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM docs, LATERAL (SELECT unnest(range(1, len(w) - 11)) AS i)),
firsts AS (SELECT s, min(doc_id) AS first FROM wins GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos
  FROM wins JOIN firsts USING (s) WHERE first < doc_id),
lists AS (SELECT doc_id, list(pos) AS ats, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE
         list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(ats, i)),
                        lambda i: w[i]) END, ' ')) AS kept_sha256
FROM docs LEFT JOIN lists USING (doc_id)"""

ORACLE["op10_near_dedup"] = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
                               " 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM docs, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i) WHERE len(w) >= 5
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM docs WHERE len(w) BETWEEN 1 AND 4)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b
           ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS id, b AS other FROM both_ways
          UNION SELECT r.id, l.b FROM reach r JOIN both_ways l ON l.a = r.other),
least_of AS (SELECT id, min(other) AS low FROM reach GROUP BY id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON id = d.doc_id"""

ORACLE["op11_divergence"] = r"""
WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS text, row_number() OVER () AS row_no
              FROM documents),
words AS (SELECT lang, source, row_no,
                 unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY 1, 2
         HAVING count(DISTINCT row_no) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term)
           GROUP BY ALL),
vs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
grps AS (SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(c.n, 0) AS n
         FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN vs USING (lang)
         LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL) c
           ON c.lang = g.lang AND c.source = g.source),
ps AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS c,
              1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (g.n + g.v) AS p,
              1 + CAST(1000000000 AS HUGEINT) * (k.n + 1) // (vs.n + vs.v) AS p_lang
       FROM grps g JOIN kept k USING (lang) JOIN vs USING (lang)
       LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item,
                    sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
             FROM ps x JOIN ps y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
             GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - p_lang) * (p - p_lang) // p_lang FROM ps
  WHERE c > 0 AND p > p_lang)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (
         PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200"""

ORACLE["op12_fill_in_middle"] = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
              FROM documents),
drawn AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
                 CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                 CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
          FROM docs),
cuts AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
                greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                          OR h3 % 100 >= 100 THEN 'plain'
                     WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
pieces AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
                  array_to_string(u[b + 1:n], '') AS suffix FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM pieces"""
