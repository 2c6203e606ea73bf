"""Registered queries of this package (``opN_<name>``) and their DuckDB SQL.

Each query applies its operator with production parameters to its whole table and
derives the digest columns of its contract from the operator's own output.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, chat, line_dedup, lm_score, packing, pii, quality, ranked_search, simhash, superminhash,
               toxicity, warc_fixity, winnowing)
from .common import materialize, ship_package, table


QUALITY_CUT, TOXIC_CUT = 0.3, 0.5


def op1_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


def op7_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_CUT).cast("int"))


def op2_site_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return done.select("doc_id", "n_lines", "n_removed", "left_whole",
                       F.length(text).cast("long").alias("n_chars"),
                       F.sha2(text.cast("binary"), 256).alias("text_sha256"))


def op3_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records in two replicas, of which the second has altered and lost some; the audit finds them.

    Planted damage: a page whose id leaves 13 modulo 97 has one more byte at its end changed, one whose id
    leaves 5 modulo 211 is gone.
    """
    record = warc_fixity.record_bytes(F.col("url"), F.col("html"))
    held = F.when(F.col("page_id") % 97 == 13, F.concat(
        F.substring(F.col("record"), 1, F.octet_length("record") - 1), F.lit("!").cast("binary"))).otherwise(
        F.col("record"))
    pages = (table(spark, sf_dir, "pages").select("page_id", record.alias("record"))
             .select("page_id", F.sha2("record", 256).alias("digest"), F.sha2(held, 256).alias("held"),
                     F.octet_length("record").cast("long").alias("length")))
    records = materialize(warc_fixity.catalogue(materialize(
        warc_fixity.numbered_copies(pages), "op3-records")), "op3-catalogue")
    a = records.select("file", "offset", "length", "digest")
    b = (records.where(F.coalesce(F.col("page_id") % 211 != 5, F.lit(True)))
         .select("file", "offset", "length", F.col("held").alias("digest")))
    found = warc_fixity.audit(a, b)
    return (found.join(records.select("file", "offset", "page_id"), ["file", "offset"])
            .select("page_id", "file", "offset", "length", "digest", "replica_digest", "status"))


def op5_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(table(spark, sf_dir, "documents"), pii.TEST_KEY)


def op10_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled of quality 1. Background: all documents."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return lm_score.score_all(docs, labels.where("quality = 1").select("doc_id"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, and for each id divisible by 100 how many other documents
    have a fingerprint within the search radius (NULL for the others)."""
    prints = materialize(simhash.edited_prints(table(spark, sf_dir, "documents")), "op4")
    asked = F.col("doc_id") % 100 == 0
    found = simhash.near_counts(prints.where(asked).select("f0", "f1"), prints)
    f, e, g = ([F.col(f"{x}{i}") for i in range(2)] for x in "feg")
    return (prints.withColumn("asked", F.coalesce(asked, F.lit(False)))
            .join(found.withColumn("asked", F.lit(True)), ["f0", "f1", "asked"], "left")
            .select("doc_id", "n_chars", "edited_sha256", simhash.as_text(f).alias("fingerprint"),
                    simhash.as_text(e).alias("edited_fingerprint"),
                    simhash.likeness(f, e).alias("near_edited"), simhash.likeness(f, g).alias("near_next"),
                    (F.col("n_within") - 1).alias("n_near")))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_grammar_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one (-7) whose texts hold the template's own control strings."""
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, chat.USER, said), (-7, 1, chat.ASSISTANT, said)],
                                    "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.read_back(chat.format_chats(rows))


def op13_hybrid_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS gram FROM (
    SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 8, 2))) AS p
    FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS gram FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, item_id, n, p FROM doc_windows JOIN item_windows USING (n, gram)),
words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits)
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT u, v FROM common JOIN size x ON x.doc_id = u JOIN size y ON y.doc_id = v
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT a, v FROM reach JOIN link ON u = b)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(b) AS component_id,
       min(b) = d.doc_id AS kept
FROM d LEFT JOIN size USING (doc_id) JOIN reach ON a = d.doc_id GROUP BY d.doc_id, n
"""

OP2_SQL = r"""
WITH l AS (
  SELECT doc_id, source, pos, line, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM (
    SELECT doc_id, source, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM (
      SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
spread AS (
  SELECT bare FROM l WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= 10),
flagged AS (SELECT l.*, (bare IN (SELECT bare FROM spread)) AS hit FROM l),
docs AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hit) AS n_hit,
         count(*) FILTER (hit) > 0 AND bool_and(hit) FILTER (bare <> '') AS left_whole,
         coalesce(string_agg(line, chr(10) ORDER BY pos), '') AS whole,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit), '') AS rest
  FROM flagged GROUP BY doc_id)
SELECT doc_id, n_lines, CASE WHEN left_whole THEN 0 ELSE n_hit END AS n_removed, left_whole,
       CAST(length(t) AS BIGINT) AS n_chars, sha256(t) AS text_sha256
FROM (SELECT *, CASE WHEN left_whole THEN whole ELSE rest END AS t FROM docs)
"""

OP3_SQL = r"""
WITH r AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
      || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13)
      || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
      || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS rec FROM pages),
d AS (
  SELECT page_id, strlen(rec) AS length, sha256(rec) AS digest,
         sha256(CASE WHEN page_id % 97 = 13 THEN left(rec, length(rec) - 1) || '!' ELSE rec END) AS held FROM r),
c AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, digest) - 1 AS copy,
         greatest(1, CAST(ceil(sum(length) OVER () / 4194304.0) AS BIGINT)) AS files FROM d),
f AS (
  SELECT *, CAST('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '') || '|' || copy || '|' || digest), 1, 8)
              AS BIGINT) % files AS file FROM c),
o AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id NULLS FIRST, digest, copy
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM f)
SELECT page_id, file, CAST(off AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length, digest,
       CASE WHEN page_id % 211 = 5 THEN NULL ELSE held END AS replica_digest,
       CASE WHEN page_id % 211 = 5 THEN 'missing' ELSE 'changed' END AS status
FROM o WHERE page_id % 211 = 5 OR digest <> held
"""

OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(text, '<<(\\*)(/?SYS>>)', '<<\1\\\2', 'g'),
              '<(\\*)(/?s>)', '<\1\\\2', 'g'), '\[(\\*)((/?INST|/?ROLE|TEXT)\])', '[\1\\\2', 'g') AS text_out,
         regexp_replace(regexp_replace(regexp_replace(role, '<<(\\*)(/?SYS>>)', '<<\1\\\2', 'g'),
              '<(\\*)(/?s>)', '<\1\\\2', 'g'), '\[(\\*)((/?INST|/?ROLE|TEXT)\])', '[\1\\\2', 'g') AS role_out
  FROM t),
r AS (
  SELECT *, CASE role WHEN 'system' THEN '<<SYS>> ' || text_out || ' <</SYS>>'
                      WHEN 'user' THEN '[INST] ' || text_out || ' [/INST]'
                      WHEN 'assistant' THEN '<s> ' || text_out || ' </s>'
                      ELSE '[ROLE] ' || role_out || ' [TEXT] ' || text_out || ' [/ROLE]' END AS out FROM e),
c AS (
  SELECT conv_id, count(*) AS n_turns, sum(length(out)) AS n,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, out) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, out) FILTER (role = 'assistant'), '') AS loss
  FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars
FROM c
"""

OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, t, len(t) AS n, row_number() OVER () AS row FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents)),
q AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark),
qt AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest(t) AS term FROM q) GROUP BY item_id, term),
g AS (SELECT count(*) FILTER (n > 0) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
tf AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM qt) GROUP BY row, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, g GROUP BY term, docs),
s AS (
  SELECT item_id, row, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))
                            AS BIGINT) AS score
  FROM qt JOIN w USING (term) JOIN tf USING (term) JOIN d USING (row), g GROUP BY item_id, row),
r AS (
  SELECT item_id, doc_id, score, row_number() OVER (
      PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM s JOIN d USING (row) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""

QUERIES = {f.__name__: f for f in (
    op1_subword_quality, op2_site_spread, op3_merkle_fixity, op4_simhash, op5_feistel_pseudonyms, op6_winnowing,
    op7_superminhash, op8_ftrl_toxicity, op9_packing, op10_cross_entropy_difference, op11_pair_bitmaps,
    op12_grammar_round_trip, op13_hybrid_ranking)}


def _shipped(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict:
    return {name: _shipped(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {"op2_site_spread": OP2_SQL, "op3_merkle_fixity": OP3_SQL, "op6_winnowing": OP6_SQL,
            "op7_superminhash": OP7_SQL, "op12_grammar_round_trip": OP12_SQL, "op13_hybrid_ranking": OP13_SQL}
