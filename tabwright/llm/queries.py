"""Registered queries of the subpackage, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import align, html, lines, middle, mixing, ngrams, packing, quality, repeats, sharding, tokens, topk, warc
from tabwright.llm.common import read
from tabwright.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "op1_warc_salvage",
    """
    WITH p AS (
      SELECT page_id, sha1(encode(coalesce(html, ''))) AS payload_digest, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
    f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= 1000 AND page_id < first THEN first END AS refers_to
    FROM f""",
)
def warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.roundtrip(read(spark, sf_dir, "pages")).where(F.col("kind") == "record")
    number = lambda c: F.expr(f"try_cast(substring({c}, {len(warc.URN) + 1}) as bigint)")
    return found.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )


@query("op2_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = materialize(quality.with_features(docs).drop("text"), "features")
    rules = quality.fit_rules(rows, read(spark, sf_dir, "labels"))
    failed = quality.base_failed()
    return rows.select(
        "doc_id", *[F.col(f"features.{c}").alias(c) for c in quality.COUNTS], failed.alias("base_failed"),
        (~failed & ~rules.rejects(F.col("lang"))).alias("kept"), *quality.settled(rules, F.col("lang")),
    )


@query("op3_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    automaton = tokens.Automaton(*tokens.read_pieces(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return tokens.count_tokens(spark, read(spark, sf_dir, "documents").select("doc_id", "text"), automaton)


@query(
    "op4_kd_topk",
    """
    WITH x AS (
      SELECT vec_id, [floor(64 * c::DOUBLE)::BIGINT FOR c IN embedding] AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM x q JOIN x c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
)
def kd_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query(
    "op5_repeat_removal",
    """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (
      SELECT doc_id, unnest(range(0, len(h) // 2 - 399)) AS i, h FROM d WHERE len(h) >= 800),
    k AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS m FROM w),
    r AS (SELECT doc_id, i FROM k WHERE m IN (SELECT m FROM k GROUP BY m HAVING count(*) > 1)),
    g AS (SELECT *, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400, TRUE)::INTEGER AS new FROM r),
    n AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS nth FROM g),
    s AS (SELECT doc_id, nth, min(i) AS lo, max(i) + 400 AS hi FROM n GROUP BY 1, 2),
    p AS (SELECT *, lead(lo) OVER (PARTITION BY doc_id ORDER BY nth) AS next FROM s),
    t AS (
      SELECT doc_id, count(*) AS n_spans, sum(hi - lo)::BIGINT AS n_removed,
        string_agg(substr(h, 2 * hi + 1, 2 * (coalesce(next, len(h) // 2) - hi)), '' ORDER BY nth) AS tail,
        any_value(substr(h, 1, 2 * (SELECT min(lo) FROM s x WHERE x.doc_id = p.doc_id))) AS head
      FROM p JOIN d USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
      sha256(unhex(coalesce(head || tail, h))) AS kept_sha256,
      decode(unhex(array_to_string([x FOR x IN regexp_extract_all(coalesce(head || tail, h),
        '[0-7].|C[2-9A-F][89AB].|D.[89AB].|E0[AB].[89AB].|E[1-9A-CEF][89AB].[89AB].|ED[89].[89AB].|F0[9AB].[89AB].[89AB].|F[1-3][89AB].[89AB].[89AB].|F48.[89AB].[89AB].|..')
        IF x < '80' OR length(x) > 2], ''))) AS text
    FROM d LEFT JOIN t USING (doc_id)""",
)
def repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), keep="text")
    return found.withColumnRenamed("id", "doc_id")


@query(
    "op6_ngram_join",
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    b AS (SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
    e AS (
      SELECT u, v, c = p.n AND c = q.n AS same FROM b JOIN n p ON p.doc_id = u JOIN n q ON q.doc_id = v
      WHERE 5 * c >= 4 * (p.n + q.n - c)),
    r AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, e.v FROM r JOIN e ON e.u = r.v)
    SELECT doc_id, (SELECT min(v) FROM r WHERE r.u = doc_id) AS class_id,
      least(doc_id, coalesce((SELECT min(v) FROM e WHERE e.u = doc_id AND same), doc_id)) AS copy_of,
      (SELECT count(*) FROM e WHERE e.u = doc_id) AS n_links
    FROM documents""",
)
def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngrams.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("id", "doc_id")


@query("op7_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, 0)
    return packing.pack_best_fit(pieces, 2048).withColumnRenamed("id", "doc_id")


@query(
    "op8_line_dedup",
    """
    WITH l AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
    k AS (
      SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last AS lost FROM k LEFT JOIN c USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
    FROM m GROUP BY doc_id""",
)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_common_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op9_histogram_sort")
def histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return sharding.histogram_shards(docs, 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op10_mix_sources")
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixing.taken_words(mix).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query(
    "op11_fill_in_middle",
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
    g AS (
      SELECT doc_id, t, w, len(w) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
        ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
    c AS (
      SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
          WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM g),
    x AS (
      SELECT *, array_to_string(w[1:lo], '') AS p, array_to_string(w[lo + 1:hi], '') AS m, array_to_string(w[hi + 1:n], '') AS s FROM c)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
    FROM x""",
)
def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = middle.fill_in_middle(read(spark, sf_dir, "documents"))
    return made.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query("op12_cross_tokenizer")
def cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    found = align.align(read(spark, sf_dir, "documents"), *paths)
    return found.withColumnRenamed("id", "doc_id")


@query("op13_main_text")
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract_main_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
