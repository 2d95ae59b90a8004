"""Text aggregates (X06-X12): token/bigram frequencies, length statistics,
long-form TF-IDF, rule detector, token ablation.

Token streams are exploded and aggregated with map-side partial aggregation,
so a token that makes up a third of the corpus is combined per task before
the shuffle. Top-N selection is ``TakeOrderedAndProject`` (global) or
``row_number`` with a partial ``WindowGroupLimit`` (per class).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.columns import scalars
from .order import exact_quantiles, land


def token_counts(df: DataFrame, toks: Column, group_cols: Sequence[str] = (), name: str = "token") -> DataFrame:
    return (df.select(*group_cols, F.explode(toks).alias(name))
            .groupBy(*group_cols, name).agg(F.count(F.lit(1)).alias("count")))


def top_tokens(df: DataFrame, toks: Column, n: int, group_cols: Sequence[str] = (), name: str = "token") -> DataFrame:
    """Top ``n`` tokens by count (ties: token ascending), overall or per group."""
    cnt = token_counts(df, toks, group_cols, name)
    if not group_cols:
        return cnt.orderBy(F.col("count").desc(), F.col(name)).limit(n)
    w = Window.partitionBy(*group_cols).orderBy(F.col("count").desc(), F.col(name))
    return cnt.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def length_stats(df: DataFrame, text: str, group_cols: Sequence[str]) -> DataFrame:
    """Word-count min, max, mean, median, std per group."""
    wc = df.select(*group_cols, TX.word_count(text).alias("words"))
    st = wc.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"), F.min("words").alias("min"),
                                     F.max("words").alias("max"), F.avg("words").alias("mean"),
                                     F.stddev_samp("words").alias("std"))
    med = exact_quantiles(wc, "words", [0.5], group_cols).withColumnRenamed("q_0", "median")
    return st.join(med, list(group_cols), "left")


def with_bigrams(df: DataFrame, tokens_col: str, out: str) -> DataFrame:
    """X05 on a DataFrame: consecutive token pairs ``"a b"`` with MLlib's
    ``NGram`` (compiled), much faster than a higher-order-function lambda."""
    from pyspark.ml.feature import NGram
    return NGram(n=2, inputCol=tokens_col, outputCol=out).transform(df)


#: Bytes of text a task takes when documents are dealt by key: its term counts stay in memory.
TEXT_BYTES = 16 << 20


def term_rows(df: DataFrame, key: str, text: str, ngram_max: int = 2, min_len: int = 2) -> DataFrame:
    """``(key, term)``, a row per occurrence of a unigram (or bigram) of a whole text.
    The texts are dealt by key beforehand: what is grouped by the key, or by key
    and term, moves no terms."""
    size = scalars(df.agg(F.sum(F.octet_length(F.col(text))).alias("b")))["b"] or 0
    base = df.select(key, text).repartition(int(size) // TEXT_BYTES + 1, key)
    base = base.select(key, TX.tokens(text, min_len=min_len).alias("_t"))
    arr = F.col("_t")
    if ngram_max >= 2:
        base = with_bigrams(base, "_t", "_b")
        arr = F.concat(F.col("_t"), F.col("_b"))
    return base.select(key, F.explode(arr).alias("term"))


def doc_terms(df: DataFrame, key: str, text: str, ngram_max: int = 2, min_len: int = 2) -> DataFrame:
    """Term counts ``(key, term, tf)`` of unigrams (and bigrams) of whole texts."""
    return term_rows(df, key, text, ngram_max, min_len).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf(df: DataFrame, key: str, text: str, min_df: int = 3, max_features: int | None = 5000,
          ngram_max: int = 2, sublinear: bool = True) -> DataFrame:
    """Sklearn-style TF-IDF as a long table ``(key, term, weight)``:
    ``idf = ln((1+n)/(1+df)) + 1`` (smooth), ``tf -> 1 + ln(tf)`` when sublinear,
    rows L2-normalised (rule M13). Vocabulary: ``df >= min_df``, then the
    ``max_features`` terms with the largest corpus count (ties: term)."""
    occurrences = term_rows(df, key, text, ngram_max)
    terms = occurrences.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    n_docs = scalars(df.agg(F.count(F.lit(1)).alias("n")))["n"]
    stats = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")) \
        .where(F.col("df") >= min_df)
    if max_features:
        # at most ``max_features`` rows: a proven bound for the broadcast, which
        # drops the other terms before they are counted per document
        stats = land(stats.orderBy(F.col("cf").desc(), F.col("term")).limit(max_features), "vocabulary")
        found = (occurrences.join(F.broadcast(stats.select("term", "df")), "term")
                 .groupBy(key, "term", "df").agg(F.count(F.lit(1)).alias("tf")))
    else:
        found = terms.join(stats.select("term", "df"), "term")
    idf = F.ln((F.lit(1.0) + F.lit(float(n_docs))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    tfw = (F.lit(1.0) + F.ln(F.col("tf").cast("double"))) if sublinear else F.col("tf").cast("double")
    w = found.withColumn("w", tfw * idf)
    # L2 norm per document: a document has at most ``max_features`` kept terms,
    # so a window per document is bounded (and saves the aggregate + join)
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return w.select(key, "term", (F.col("w") / norm).alias("weight"))


def rule_scores(df: DataFrame, key: str, text: str, patterns, negations: Sequence[str],
                min_len: int = 1) -> DataFrame:
    """``flag`` (any valid match) and ``score`` (valid matches / tokens)."""
    toks = TX.tokens(text, min_len=min_len)
    base = df.select(key, toks.alias("_t"))
    m = TX.rule_matches(F.col("_t"), patterns, negations)
    return (base.select(key, m.alias("matches"), F.size("_t").alias("n_tokens"))
            .withColumn("flag", (F.col("matches") > 0).cast("int"))
            .withColumn("score", F.col("matches") / F.greatest(F.col("n_tokens"), F.lit(1))))


def token_ablation(df: DataFrame, key: str, text: str, coef: DataFrame, intercept: float,
                   min_uses: int = 3, top: int = 20) -> DataFrame:
    """Mean change of the model probability when one occurrence of a
    token is removed, for a logistic model over term counts
    (``coef``: ``(term, coef)``). For that model the change is closed-form
    per (document, token), so no document is rebuilt once per position:
    ``impact = p(d) - sigmoid(logit(d) - coef_w)``, weighted by occurrences."""
    terms = doc_terms(df, key, text, ngram_max=1, min_len=1)
    scored = terms.join(coef, "term", "left").fillna(0.0, subset=["coef"])
    logit = scored.groupBy(key).agg((F.sum(F.col("tf") * F.col("coef")) + F.lit(intercept)).alias("logit"))
    j = scored.join(logit, key)
    sig = lambda z: F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    j = j.withColumn("impact", sig(F.col("logit")) - sig(F.col("logit") - F.col("coef")))
    agg = j.groupBy("term").agg(F.sum("tf").alias("uses"),
                                (F.sum(F.col("tf") * F.col("impact")) / F.sum("tf")).alias("mean_impact"))
    return (agg.where(F.col("uses") >= min_uses).withColumn("abs_impact", F.abs("mean_impact"))
            .orderBy(F.col("abs_impact").desc(), F.col("term")).limit(top))
