"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (collocations, decontamination, exact_dedup, exact_fit, jaccard_join, packing, preferences, secrets,
               sharding, substring_dedup, token_files, toxicity, whitening)
from .common import free_name, table


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op1_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(packing.pack(table(spark, sf_dir, "documents")))


def op2_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_files.read_documents(token_files.write_files(table(spark, sf_dir, "documents")))
    return rows.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    paths, _ = secrets.blob_scan(docs)
    held = free_name(docs, "spans")
    count = lambda kind: F.size(F.filter(held, lambda s: s["kind"] == kind)).cast("long")
    spans = secrets.joined_spans(held)
    return paths.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op4_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.byte_shards(table(spark, sf_dir, "documents"), shards=24)
    return rows.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op5_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 48, 1))) AS i FROM w WHERE len(ws) >= 50),
h AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS win FROM p),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS least FROM h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM m WHERE least < doc_id),
k AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS k FROM w),
j AS (SELECT k.doc_id, count(*) FILTER (gone.k IS NOT NULL) AS n_removed,
             coalesce(string_agg(word, ' ' ORDER BY k.k) FILTER (gone.k IS NULL), '') AS kept
      FROM k LEFT JOIN gone ON gone.doc_id = k.doc_id AND gone.k = k.k GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN j USING (doc_id)
"""


def op6_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = preferences.conversations(table(spark, sf_dir, "conversations"))
    rows = preferences.preference_rows(preferences.swapped_halves(convs))
    return rows.select("pair_id", F.col("prompt_turns").cast("long").alias("prompt_turns"), "prompt", "chosen", "rejected",
                       preferences.spans_text("chosen_mask").alias("chosen_mask"),
                       preferences.spans_text("rejected_mask").alias("rejected_mask"))


OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, 'unknown'),
                                     replace(coalesce(text, ''), '<|', '< |')) - 1 AS pos,
         coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS txt
  FROM conversations WHERE conv_id IS NOT NULL),
z AS (SELECT conv_id, count(*) AS n FROM t GROUP BY 1),
p AS (SELECT a.conv_id AS pair_id, xor(a.conv_id, 1) AS other, a.n, a.n // 2 AS half
      FROM z a JOIN z b ON b.conv_id = xor(a.conv_id, 1)),
c AS (SELECT pair_id, pos, role, txt FROM p JOIN t ON t.conv_id = pair_id),
r AS (SELECT pair_id, pos, role, txt FROM p JOIN t ON t.conv_id = pair_id WHERE pos < half
      UNION ALL SELECT pair_id, pos, role, txt FROM p JOIN t ON t.conv_id = other WHERE pos >= half),
d AS (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, min(coalesce(c.pos, r.pos)) AS k
      FROM c FULL JOIN r ON c.pair_id = r.pair_id AND c.pos = r.pos
      WHERE c.pos IS NULL OR r.pos IS NULL OR c.role <> r.role OR c.txt <> r.txt GROUP BY 1),
k AS (SELECT pair_id, coalesce(d.k, p.n) AS prompt_turns FROM p LEFT JOIN d USING (pair_id)),
s AS (SELECT 'c' AS side, * FROM c UNION ALL SELECT 'r', * FROM r),
f AS (SELECT s.*, prompt_turns, '<|im_start|>' || role || chr(10) || txt || '<|im_end|>' || chr(10) AS out
      FROM s JOIN k USING (pair_id)),
g AS (SELECT *, coalesce(sum(length(out)) OVER (PARTITION BY side, pair_id ORDER BY pos
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 13 + length(role) AS a,
             sum(length(out)) OVER (PARTITION BY side, pair_id ORDER BY pos) AS b
      FROM f WHERE pos >= prompt_turns),
h AS (SELECT pair_id, side, string_agg(out, '' ORDER BY pos) AS out,
             coalesce(string_agg(a::BIGINT || ':' || b::BIGINT, ',' ORDER BY pos) FILTER (role = 'assistant'), '') AS m
      FROM g GROUP BY 1, 2),
q AS (SELECT pair_id, string_agg(out, '' ORDER BY pos) AS prompt FROM f WHERE side = 'c' AND pos < prompt_turns GROUP BY 1)
SELECT k.pair_id, prompt_turns, coalesce(prompt, '') AS prompt, coalesce(x.out, '') AS chosen,
       coalesce(y.out, '') AS rejected, coalesce(x.m, '') AS chosen_mask, coalesce(y.m, '') AS rejected_mask
FROM k LEFT JOIN q USING (pair_id) LEFT JOIN h x ON x.pair_id = k.pair_id AND x.side = 'c'
LEFT JOIN h y ON y.pair_id = k.pair_id AND y.side = 'r'
"""


def op7_toxic_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = toxicity.train(docs, labels)
    rows = toxicity.score(docs, lexicon)
    return rows.select(F.col("id").alias("doc_id"), toxicity.held_out(F.col("id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(F.col("id").alias("doc_id"), "item_id", "n_windows", "item_windows", "n_slots", "consistency",
                       "same_values")


def op9_adaptive_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jaccard_join.near_classes(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT m.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id FROM m LEFT JOIN n USING (doc_id)
"""


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP10_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
             row_number() OVER w AS rk
      FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id))
SELECT doc_id, keep_id, group_size, rk = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""

def op11_setm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, ws[i:i + k - 1] AS ph, k FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
      FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, ph, k, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 10),
cut AS (SELECT lang, ph, k, a, unnest(range(1, k)) AS j FROM c),
s AS (SELECT cut.*, x.a AS l, y.a AS r, (1000000 * cut.a::HUGEINT * cut.a // (x.a::HUGEINT * y.a))::BIGINT AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.ph = cut.ph[1:j]
      JOIN f y ON y.lang = cut.lang AND y.ph = cut.ph[j + 1:cut.k]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, j) = 1),
i AS (SELECT lang, ph, max(a) AS around FROM (SELECT lang, ph[1:2] AS ph, a FROM c WHERE k = 3
      UNION ALL SELECT lang, ph[2:3], a FROM c WHERE k = 3) GROUP BY ALL),
o AS (SELECT b.lang, array_to_string(b.ph, ' ') AS phrase, a, l, r, score
      FROM b LEFT JOIN i ON i.lang = b.lang AND i.ph = b.ph WHERE around IS NULL OR 100 * around < 50 * a)
SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       score
FROM o JOIN n USING (lang) QUALIFY rank <= 2000
"""


def op12_exact_complements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_fit.pack(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op13_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where it does not fit a long; ``deviation_exact`` always holds it."""
    rows = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return rows.select(F.col("id").alias("vec_id"), "component", "n", F.col("deviation").try_cast("long").alias("deviation"),
                       "whitened", "explained", "identity_error", F.col("deviation").alias("deviation_exact"))


QUERIES = {q.__name__: q for q in (
    op6_preference_pairs, op8_template_leaks, op1_retrieval_packing, op2_arrow_sequences, op9_adaptive_prefixes,
    op5_repeated_windows, op3_blob_ledger, op7_toxic_lexicon, op4_byte_shards, op10_exact_dedup, op11_setm_phrases,
    op12_exact_complements, op13_lanczos_whitening)}
SQL = {"op6_preference_pairs": OP6_SQL, "op9_adaptive_prefixes": OP9_SQL, "op5_repeated_windows": OP5_SQL,
       "op10_exact_dedup": OP10_SQL, "op11_setm_phrases": OP11_SQL}
