"""Plans for text statistics (X01-X12) on ``documents`` (+ ``labels``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import textops as TO
from .registry import Tables, plan, rnd

# The reference's domain stop words (appended to a base list).
STOPWORDS_EXTRA = ["durante", "foram", "sendo", "pelo", "pela", "pelos", "pelas", "para", "como", "com", "sem",
                   "nos", "nas", "dos", "das", "pelo", "uma", "um", "este", "esta", "esse", "essa", "isso",
                   "ocorrência", "registro", "registrado", "realizado", "realizada", "conforme", "atividade"]
# Base stop words of the plans (the corpus languages are en/fr/de/es).
STOPWORDS_BASE = ["the", "and", "that", "for", "with", "this", "are", "was", "from", "les", "des", "que", "der",
                  "die", "und", "den", "von", "ein", "las", "los", "del", "una", "por", "qui", "est", "dans"]
STOPWORDS = sorted(set(STOPWORDS_BASE) | set(STOPWORDS_EXTRA))

# Rule detector of the plans: positions are (word set, optional).
PATTERNS = [
    [(["the"], False), (["of", "and"], False)],
    [(["der", "die", "das"], False), (["und"], True), (["der", "die", "den"], False)],
    [(["de"], False), (["la", "le", "les"], False)],
    [(["que"], False), (["en", "la"], True)],
]
NEGATIONS = ["nicht", "not", "pas", "sin"]


def _sql_list(words):
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


FOLD_SQL = f"regexp_replace(translate(lower(text), '{TX.ACCENTED}', '{TX.PLAIN}'), '[^\\x00-\\x7F]', '', 'g')"


def TOK_SQL(min_len=3, src=FOLD_SQL):
    return f"list_filter(regexp_extract_all(coalesce({src}, ''), '\\b[a-zA-Z]+\\b'), lambda x: length(x) >= {min_len})"


STOP_SQL = f"list_filter({TOK_SQL()}, lambda x: NOT list_contains({_sql_list(STOPWORDS)}, x))"


def _bigram_sql(t):
    return f"list_transform(range(1, len({t})), lambda i: {t}[i] || ' ' || {t}[i + 1])"


def _toks(t: Tables, min_len=3):
    docs = t.documents.select("doc_id", "lang", "text")
    return docs.select("doc_id", "lang", TX.tokens("text", min_len=min_len).alias("toks"))


@plan("x01_word_count", "X01", """
SELECT doc_id, CAST(len(list_filter(string_split_regex(trim(text), '\\s+'), lambda x: x <> '')) AS INTEGER) AS words FROM documents""")
def x01(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", TX.word_count("text").alias("words"))


@plan("x02_fold_accents", "X02", f"""
SELECT doc_id, CAST(length({FOLD_SQL}) AS INTEGER) AS n_chars, md5({FOLD_SQL}) AS folded_md5 FROM documents""")
def x02(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.withColumn("f", TX.fold_accents("text"))
    return d.select("doc_id", F.length("f").alias("n_chars"), F.md5("f").alias("folded_md5"))


@plan("x03_tokens", "X03", f"""
SELECT doc_id, CAST(len({TOK_SQL()}) AS INTEGER) AS n_tokens, md5(array_to_string({TOK_SQL()}, ' ')) AS tokens_md5 FROM documents""")
def x03(spark, sf_dir):
    d = _toks(Tables(spark, sf_dir))
    return d.select("doc_id", F.size("toks").alias("n_tokens"), F.md5(F.array_join("toks", " ")).alias("tokens_md5"))


@plan("x04_stopword_removal", "X04", f"""
SELECT doc_id, CAST(len({STOP_SQL}) AS INTEGER) AS n_kept, md5(array_to_string({STOP_SQL}, ' ')) AS kept_md5 FROM documents""")
def x04(spark, sf_dir):
    d = _toks(Tables(spark, sf_dir)).withColumn("k", TX.remove_stopwords(F.col("toks"), STOPWORDS))
    return d.select("doc_id", F.size("k").alias("n_kept"), F.md5(F.array_join("k", " ")).alias("kept_md5"))


@plan("x05_bigrams", "X05", f"""
WITH s AS (SELECT doc_id, {STOP_SQL} AS t FROM documents)
SELECT doc_id, CAST(len({_bigram_sql('t')}) AS INTEGER) AS n_bigrams, md5(array_to_string({_bigram_sql('t')}, '|')) AS bigrams_md5 FROM s""")
def x05(spark, sf_dir):
    d = _toks(Tables(spark, sf_dir)).withColumn("k", TX.remove_stopwords(F.col("toks"), STOPWORDS))
    d = TO.with_bigrams(d, "k", "b")
    return d.select("doc_id", F.size("b").alias("n_bigrams"), F.md5(F.array_join("b", "|")).alias("bigrams_md5"))


@plan("x06_top_tokens", "X06", f"""
WITH t AS (SELECT unnest({STOP_SQL}) AS token FROM documents)
SELECT token, count(*) AS count FROM t GROUP BY 1 ORDER BY count DESC, token LIMIT 30""")
def x06(spark, sf_dir):
    d = _toks(Tables(spark, sf_dir))
    return TO.top_tokens(d, TX.remove_stopwords(F.col("toks"), STOPWORDS), 30)


@plan("x06_top_tokens_per_class", "X06", f"""
WITH t AS (SELECT lang, unnest({STOP_SQL}) AS token FROM documents),
c AS (SELECT lang, token, count(*) AS count FROM t GROUP BY 1, 2)
SELECT lang, token, count, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY count DESC, token) AS rank FROM c) WHERE rank <= 10""")
def x06b(spark, sf_dir):
    d = _toks(Tables(spark, sf_dir))
    return TO.top_tokens(d, TX.remove_stopwords(F.col("toks"), STOPWORDS), 10, ["lang"])


@plan("x07_top_bigrams", "X07", f"""
WITH s AS (SELECT {STOP_SQL} AS t FROM documents),
b AS (SELECT unnest({_bigram_sql('t')}) AS bigram FROM s)
SELECT bigram, count(*) AS count FROM b GROUP BY 1 ORDER BY count DESC, bigram LIMIT 20""")
def x07(spark, sf_dir):
    d = _toks(Tables(spark, sf_dir)).withColumn("k", TX.remove_stopwords(F.col("toks"), STOPWORDS))
    return TO.top_tokens(TO.with_bigrams(d, "k", "b"), F.col("b"), 20, name="bigram")


@plan("x08_length_stats", "X08", """
WITH w AS (SELECT lang, len(list_filter(string_split_regex(trim(text), '\\s+'), lambda x: x <> '')) AS words FROM documents)
SELECT lang, count(*) AS n, CAST(min(words) AS INTEGER) AS min, CAST(max(words) AS INTEGER) AS max, round(avg(words), 6) AS mean,
  round(stddev_samp(words), 6) AS std, round(median(words), 6) AS median FROM w GROUP BY 1""")
def x08(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    out = TO.length_stats(d, "text", ["lang"])
    return out.select("lang", "n", "min", "max", rnd("mean", 6).alias("mean"), rnd("std", 6).alias("std"),
                      rnd("median", 6).alias("median"))


def _tfidf_sql(min_df=3, max_features=20000):
    toks = TOK_SQL(2)
    return f"""
WITH t AS (SELECT doc_id, {toks} AS t FROM documents),
g AS (SELECT doc_id, list_concat(t, {_bigram_sql('t')}) AS g FROM t),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(g) AS term FROM g) GROUP BY 1, 2),
st AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY 1 HAVING count(*) >= {min_df}
       ORDER BY cf DESC, term LIMIT {max_features}),
n AS (SELECT count(*)::DOUBLE AS n FROM documents),
w AS (SELECT doc_id, tf.term, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN st USING (term), n)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 9) AS weight FROM w"""


@plan("x09_tfidf", "X09", _tfidf_sql())
def x09(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return TO.tfidf(d, "doc_id", "text", min_df=3, max_features=20000).withColumn("weight", rnd("weight", 9))


def _rule_sql():
    t = "t"
    counts = []
    for pat in PATTERNS:
        for var in TX.expand_optional(pat):
            m = len(var)
            conds = " AND ".join(f"list_contains({_sql_list(s)}, {t}[i + {j}])" for j, s in enumerate(var))
            neg = (f"len(list_filter({t}[greatest(i - 3, 1):i - 1], lambda x: list_contains({_sql_list(NEGATIONS)}, x))) = 0")
            counts.append(f"CASE WHEN len({t}) >= {m} THEN len(list_filter(range(1, len({t}) - {m} + 2), "
                          f"lambda i: {conds} AND {neg})) ELSE 0 END")
    total = " + ".join(counts)
    return f"""
WITH d AS (SELECT doc_id, {TOK_SQL(1)} AS t FROM documents),
m AS (SELECT doc_id, ({total}) AS matches, len(t) AS n_tokens FROM d)
SELECT doc_id, CAST(matches AS INTEGER) AS matches, CAST(n_tokens AS INTEGER) AS n_tokens,
  CAST(matches > 0 AS INTEGER) AS flag, round(matches / greatest(n_tokens, 1), 9) AS score FROM m"""


@plan("x10_x11_rule_detector", "X10,X11", _rule_sql())
def x10(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    out = TO.rule_scores(d, "doc_id", "text", PATTERNS, NEGATIONS)
    return out.select("doc_id", "matches", "n_tokens", "flag", rnd("score", 9).alias("score"))


@plan("x12_token_ablation", "X12,A09")
def x12(spark, sf_dir):
    from ..operators.models import fit_text_logistic
    t = Tables(spark, sf_dir)
    lab = t.documents.join(t.labels, "doc_id")
    coef, intercept = fit_text_logistic(lab, "doc_id", "text", "quality", vocab_size=2000)
    return TO.token_ablation(lab, "doc_id", "text", coef, intercept)
