"""The whole-table queries over the operators, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm import (
    embedding_dedup,
    fingerprints,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    piece_lattice,
    prefix_trie,
    source_mix,
    structure_repair,
    suffix_dedup,
    url_filter,
)


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def vocabulary() -> dict:
    """Paths of the public vocabulary files (parameters of the operators)."""
    import public_tokenizers as public

    return {"json_path": public.path("byte_bpe_50k.json"), "ranks_path": public.path("byte_bpe_50k.tiktoken"), "pattern": public.PATTERN}


def op1_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return url_filter.judge_urls(spark.read.parquet(f"{d}/pages.parquet"))


def op2_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.fingerprint_documents(documents(spark, d))


def op3_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, d))


def op4_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(documents(spark, d))


def op5_piece_lattice(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers as public

    return piece_lattice.encode_documents(documents(spark, d), public.path("piece_bpe_32k.model"))


def op6_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, d).select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.col("lk_n_lines").alias("n_lines"),
        F.col("lk_n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op7_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(documents(spark, d), **vocabulary())


def op8_embedding_dedup(spark: SparkSession, d: str) -> DataFrame:
    return embedding_dedup.near_vectors(spark.read.parquet(f"{d}/embeddings.parquet"))


def language_decisions(docs: DataFrame) -> DataFrame:
    """Languages of ``documents``: the text, the declared language and the source (as host) are the evidence."""
    model = language_id.fit_text_model(docs)
    return language_id.identify(docs, model, declared=language_id.language_code(F.col("lang")), host=F.col("source"))


def op9_language_id(spark: SparkSession, d: str) -> DataFrame:
    return language_decisions(documents(spark, d)).drop("lk_tid")


def pages_language_id(spark: SparkSession, d: str) -> DataFrame:
    """Languages of ``pages``: article text, markup language, address suffix and host hierarchy."""
    model = language_id.fit_text_model(documents(spark, d))
    pages = spark.read.parquet(f"{d}/pages.parquet").withColumn("text", language_id.page_text(F.col("html")))
    markup = language_id.language_code(F.regexp_extract("html", r"""(?i)<html[^>]*\slang=["']?([A-Za-z_-]+)""", 1))
    return language_id.identify(pages, model, "page_id", "text", declared=markup, **language_id.address_parts(F.col("url"))).drop("lk_tid")


def op10_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.ngram_groups(documents(spark, d), words=4, num=85, den=100)


def rebuilt_conversations(turns: DataFrame) -> DataFrame:
    """Conversations that share openings: the first h turns of conversation c - c % 5, then c's own after its first h.

    h is crc32(c) % 9.  ``(conv, seq, sizes)`` as ``prefix_trie.turn_sequences`` gives them.
    """
    own = prefix_trie.turn_sequences(turns)
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % 9).cast("int")
    own = own.withColumn("h", h).withColumn("from", F.col("conv") - F.col("conv") % 5)
    opening = own.select(F.col("conv").alias("from"), F.col("seq").alias("seq0"), F.col("sizes").alias("sizes0"))

    def joined(first, rest):
        head = F.slice(F.coalesce(F.col(first), F.array().cast("array<bigint>")), F.lit(1), F.col("h"))
        return F.concat(head, F.slice(F.col(rest), F.col("h") + 1, F.size(rest))).alias(rest)

    return own.join(opening, "from", "left").select("conv", joined("seq0", "seq"), joined("sizes0", "sizes"))


def op11_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.prefix_trie(rebuilt_conversations(spark.read.parquet(f"{d}/conversations.parquet")))


def op12_source_mix(spark: SparkSession, d: str) -> DataFrame:
    return source_mix.taken_words(documents(spark, d))


def damaged_conversations(turns: DataFrame) -> DataFrame:
    """The turns with faults by crc32 of ``conv_id:turn``; ``gone`` marks those that are dropped."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    code = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", blank)
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(code == 4, F.lit("user")).otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(code == 1, F.lit("")).when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (code == 0).alias("gone"),
        F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    )
    return rows.drop("col")


def op13_structure_repair(spark: SparkSession, d: str) -> DataFrame:
    turns = damaged_conversations(spark.read.parquet(f"{d}/conversations.parquet"))
    return structure_repair.repair_conversations(turns, gone_col="gone")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_url_filter,
        op2_fingerprints,
        op3_license_scan,
        op4_suffix_dedup,
        op5_piece_lattice,
        op6_line_dedup,
        op7_best_fit_packing,
        op8_embedding_dedup,
        op9_language_id,
        pages_language_id,
        op10_ngram_join,
        op11_prefix_trie,
        op12_source_mix,
        op13_structure_repair,
    )
    return {f.__name__: f for f in found}


_KEY = r"""translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

def _crc32(number: str) -> str:
    """DuckDB expression: unsigned CRC-32 of the ASCII string ``number``."""
    bit = "list_reduce(range(8), lambda v, i: xor(v >> 1, (v & 1) * 3988292384), xor(c, b::BIGINT))"
    return f"xor(list_reduce([unicode(x) FOR x IN string_split({number}, '')], lambda c, b: {bit}, 4294967295::BIGINT), 4294967295)"


def _then(value: str, cost: int | str, edit: str) -> str:
    """DuckDB expression: a value (eight digits of cost, then the audit) after one more edit."""
    return f"lpad((left({value}, 8)::INT + {cost})::VARCHAR, 8, '0') || substr({value}, 9) || '{edit}'"


_ORACLE = {
    "op6_line_dedup": f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split),
keyed AS (SELECT doc_id, pos, line, {_KEY} AS k FROM lines),
judged AS (SELECT *, length(k) >= 10 AND min(doc_id) OVER (PARTITION BY k) < doc_id AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op8_embedding_dedup": """
WITH RECURSIVE
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
fit AS (
  SELECT vec_id, e, sqrt(list_sum([x * x for x in e])) AS size FROM v
  WHERE e IS NOT NULL AND len(e) > 0
    AND len([x for x in e if x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x for x in e if x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
   AND list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.95),
reach AS (
  SELECT vec_id, vec_id AS c FROM embeddings
  UNION
  SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.c)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = r.vec_id) AS n_links, min(c) AS component_id, min(c) = vec_id AS kept
FROM reach r GROUP BY vec_id""",
    "op11_prefix_trie": f"""
WITH turns AS (
  SELECT conv_id AS c, turn, strlen(coalesce(text, '')) AS bytes, dense_rank() OVER (ORDER BY coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, {_crc32("c::VARCHAR")} % 9 AS h, list(t ORDER BY turn NULLS FIRST) AS s, list(bytes ORDER BY turn NULLS FIRST) AS b
  FROM turns GROUP BY c),
rebuilt AS (
  SELECT o.c, list_concat(coalesce(f.s, [])[1:o.h], o.s[o.h + 1:]) AS s, list_concat(coalesce(f.b, [])[1:o.h], o.b[o.h + 1:]) AS b
  FROM own o LEFT JOIN own f ON f.c = o.c - o.c % 5),
prefixes AS (SELECT c, s, b, unnest(range(0, len(s) + 1)) AS d FROM rebuilt),
members AS (
  SELECT c, d, len(s) = d AS ends, CASE WHEN d > 0 THEN b[d] ELSE 0 END AS bytes, min(c) OVER (PARTITION BY s[1:d]) AS node FROM prefixes),
nodes AS (
  SELECT node, d, count(*) AS n, any_value(bytes) AS bytes, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '') AS ids
  FROM members GROUP BY node, d),
linked AS (SELECT x.*, y.node AS parent FROM nodes x LEFT JOIN members y ON y.c = x.node AND y.d = x.d - 1),
kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS k FROM linked WHERE d > 0 GROUP BY ALL),
own_part AS (SELECT l.*, coalesce(k.k, 0) AS k, (l.n - 1) * l.bytes AS saved FROM linked l LEFT JOIN kids k USING (node, d)),
sums AS (
  SELECT a.node, a.d, count(*) FILTER (WHERE f.k = 0) AS leaves, sum(f.saved)::BIGINT AS saved
  FROM own_part f JOIN members a ON a.c = f.node AND a.d <= f.d GROUP BY a.node, a.d)
SELECT node AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, k AS n_children, leaves AS n_leaves,
       sums.saved AS saved_tokens, sha256(ids) AS ends_sha256
FROM own_part JOIN sums USING (node, d)""",
    "op13_structure_repair": rf"""
WITH RECURSIVE
source AS (
  SELECT conv_id AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k
  FROM conversations),
damaged AS (
  SELECT c, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM source WHERE k <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS r FROM damaged),
faults AS (
  SELECT *, lag(r) OVER (PARTITION BY c ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
              WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault
  FROM placed),
prices AS (SELECT *, fault NOT IN ('b', 'd') AS may_stay, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS more FROM faults),
-- cheapest edits up to row i that leave nothing, or end in a system, user or assistant turn
scan AS (
  SELECT DISTINCT c, 0::BIGINT AS i, '00000000' AS e, NULL::VARCHAR AS s, '00000005I' AS u, '00000010II' AS a FROM source
  UNION ALL
  SELECT c, i, e, s, least(u, {_then("e", 5, "I")}, {_then("s", 5, "I")}, {_then("a", 5, "I")}) AS u2,
         least(a, {_then("u", 5, "I")}, {_then("e", 10, "II")}, {_then("s", 10, "II")})
  FROM (
    SELECT p.c, p.i, {_then("e", 2, "D")} AS e,
           least({_then("s", 2, "D")}, CASE WHEN may_stay AND r = 's' THEN {_then("e", "more", "K")} END) AS s,
           least({_then("u", 2, "D")}, CASE WHEN may_stay AND r = 'u' THEN {_then("least(e, s, a)", "more", "K")} END,
                 CASE WHEN may_stay THEN {_then("least(e, s, a)", "1 + more", "R")} END) AS u,
           least({_then("a", 2, "D")}, CASE WHEN may_stay AND r = 'a' THEN {_then("u", "more", "K")} END,
                 CASE WHEN may_stay THEN {_then("u", "1 + more", "R")} END) AS a
    FROM scan JOIN prices p ON p.c IS NOT DISTINCT FROM scan.c AND p.i = scan.i + 1)),
best AS (
  SELECT c, least(e, a) AS v, [x FOR x IN string_split(substr(least(e, a), 9), '')] AS edits FROM scan
  QUALIFY row_number() OVER (PARTITION BY c ORDER BY i DESC) = 1),
edits AS (SELECT c, substr(v, 9) AS audit, unnest(edits) AS edit, generate_subscripts(edits, 1) AS j FROM best),
steps AS (
  SELECT *, length(replace(left(audit, j), 'I', '')) AS i, length(replace(left(audit, j), 'D', '')) AS place,
         length(replace(audit, 'D', '')) % 2 AS system
  FROM edits WHERE edit IN ('K', 'R', 'I')),
lines AS (
  SELECT s.c, s.place,
         CASE WHEN edit = 'K' THEN p.role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
         || CASE WHEN edit = 'I' THEN '' ELSE p.text END AS line
  FROM steps s LEFT JOIN placed p ON p.c IS NOT DISTINCT FROM s.c AND p.i = s.i),
texts AS (SELECT c, string_agg(line, chr(10) ORDER BY place) AS t FROM lines GROUP BY c),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
         count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
         count(*) FILTER (WHERE before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY c)
SELECT b.c AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, left(v, 8)::BIGINT AS cost, substr(v, 9) AS audit,
       sha256(coalesce(t, '')) AS repaired_sha256
FROM best b LEFT JOIN counts n ON n.c IS NOT DISTINCT FROM b.c LEFT JOIN texts t ON t.c IS NOT DISTINCT FROM b.c""",
    "op10_ngram_join": r"""
WITH RECURSIVE
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS c FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.c)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.c) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.doc_id = d.doc_id
GROUP BY d.doc_id, s.n""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
