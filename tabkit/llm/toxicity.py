"""Toxicity by a weighted lexicon, matched with Aho-Corasick.

Texts are folded first: lower case, accents stripped, look-alike letters of
other scripts and digit substitutions mapped to plain letters. The lexicon
holds whole words and word stems with log-odds weights learned from labelled
documents; exception phrases (given, or words that clean training documents
use) cancel the hits inside them. The score is a logistic function of the
weighted hits, as a sum and normalised by the text's length.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import land, pick

#: Bound of the training sample: labelled rows, the first by a hash of the id.
MAX_TRAIN_ROWS = 20_000
STEMS = (4, 5, 6, 7)
#: An entry needs this log odds ratio and this evidence (in nats) for it.
LEAST_WEIGHT, LEAST_EVIDENCE = 3.0, 14.0

# Letters of other scripts that look like a Latin letter, and
# digits or signs that stand for one.
LOOKALIKES = {"а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
              "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "α": "a",
              "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def fold_table() -> dict[int, str]:
    """Code point -> folded letters, for ``str.translate``."""
    table = {ord(k): v for k, v in (LOOKALIKES | DIGITS).items()}
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c)).lower()
        if plain.isascii() and plain:
            table.setdefault(cp, "".join(DIGITS.get(c, c) for c in plain))
    table |= {cp: "" for cp in [*range(0x300, 0x370), 0xAD, 0x200B, 0x200C, 0x200D, 0xFEFF]}
    return table


FOLD = fold_table()
WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    return text.lower().translate(FOLD)


@dataclass
class Lexicon:
    """``words`` match whole, ``stems`` at a word's start; both have weights.
    ``exceptions`` are folded phrases whose inside never counts. ``coef`` are
    the logistic intercept and the weights of sum and density."""
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    coef: tuple[float, float, float] = (-2.0, 1.0, 1.0)

    def automaton(self):
        import ahocorasick
        a, kinds = ahocorasick.Automaton(), {}
        for kind, entries in (("w", self.words), ("s", self.stems), ("x", dict.fromkeys(self.exceptions, 0.0))):
            for e, weight in entries.items():
                kinds.setdefault(e, []).append((kind, weight))
        for e, value in kinds.items():
            a.add_word(e, (len(e), value))
        if kinds:
            a.make_automaton()
        return a if kinds else None


def weighted_hits(text: str, automaton) -> tuple[float, int, int]:
    """(weight of the hits, hits, words). Hits start at a word's start; of hits
    with one start the heaviest counts; hits inside an exception phrase do not."""
    folded = fold(text)
    n_words = folded.count(" ") + folded.count("\n") + 1
    if automaton is None:
        return 0.0, 0, n_words
    best: dict[int, tuple[float, int]] = {}
    spared: list[tuple[int, int]] = []
    for end, (n, kinds) in automaton.iter(folded):
        start = end - n + 1
        if start and folded[start - 1].isalnum():
            continue
        closed = end + 1 == len(folded) or not folded[end + 1].isalnum()
        for kind, weight in kinds:
            if kind == "x":
                if closed:
                    spared.append((start, end))
            elif (kind == "s" or closed) and weight > best.get(start, (0.0, 0))[0]:
                best[start] = (weight, end)
    if spared:
        # a hit is inside where the furthest end of the phrases that start before it is not behind it
        spared.sort()
        starts, ends = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))
        best = {s: w for s, w in best.items() if not (k := bisect_right(starts, s)) or ends[k - 1] < s}
    return sum(w for w, _ in best.values()), len(best), n_words


def features(hit_weight: float, n_words: int) -> tuple[float, float]:
    return math.log1p(hit_weight), math.log1p(100.0 * hit_weight / (n_words + 50.0))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each word or stem, by label, summed per batch."""
    for b in batches:
        n: Counter = Counter()
        for t, y in zip(b.column("text"), b.column("toxic").to_pylist(), strict=True):
            words = set(WORD.findall(fold(t.as_py() or "")))
            seen = {("w", w) for w in words} | {("s", w[:k]) for w in words for k in STEMS if len(w) >= k}
            n.update((kind, e, y) for kind, e in seen)
        yield pa.RecordBatch.from_pydict(
            {"kind": [k[0] for k in n], "entry": [k[1] for k in n], "toxic": pa.array([k[2] for k in n], pa.int32()),
             "n": pa.array(list(n.values()), pa.int64())})


def held_out(id_col: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", exceptions: Sequence[str] = (), max_rows: int = MAX_TRAIN_ROWS) -> Lexicon:
    """Learn a lexicon from the labelled rows that are not held out, at most
    ``max_rows`` of them (the first by a hash of the id). Ids with several
    labels take the largest; rows without id or label are not used. Without
    both classes, or without entries of enough evidence, the lexicon is empty and
    every score low."""
    ids = F.col(f"`{id_col}`")
    chosen = (labels.where(ids.isNotNull() & F.col(f"`{label_col}`").isNotNull() & ~held_out(ids))
              .groupBy(ids.alias("id")).agg(F.max(F.col(f"`{label_col}`").cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    # landed: it is read four times, the table once
    sample = land(docs.select(ids.alias("id"), F.col(f"`{text_col}`").alias("text"))
                  .join(F.broadcast(chosen), "id").select("text", "toxic"), "labelled")
    rows = (sample.mapInArrow(_counts, "kind string, entry string, toxic int, n long").groupBy("kind", "entry")
            .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("pos"),
                 F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("neg")))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not n_pos or not n_neg:
        return Lexicon(exceptions=tuple(fold(e) for e in exceptions), coef=(-2.0, 1.0, 1.0))
    pos, neg = F.col("pos"), F.col("neg")
    odds = F.log((pos + 0.5) / (n_pos + 1.0)) - F.log((neg + 0.5) / (n_neg + 1.0))
    # evidence: n times the divergence of the entry's toxic share from the base share
    base, share, n = n_pos / (n_pos + n_neg), pos / (pos + neg), pos + neg
    evidence = n * (F.when(pos > 0, share * F.log(share / base)).otherwise(0.0)
                    + F.when(neg > 0, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0))
    strong = (rows.withColumn("weight", odds).where((F.col("weight") >= LEAST_WEIGHT) & (evidence >= LEAST_EVIDENCE))
              .orderBy(F.desc("weight"), F.length("entry"), "kind", "entry").collect())
    # heaviest first; an entry that starts with a taken stem, or is the start of a taken one, adds nothing
    stems: dict[str, float] = {}
    words: dict[str, float] = {}
    for r in strong:
        e, heads = r["entry"], {r["entry"][:k] for k in STEMS}
        if heads & stems.keys() or (r["kind"] == "s" and any(t.startswith(e) for t in [*stems, *words])):
            continue
        (stems if r["kind"] == "s" else words)[e] = float(r["weight"])
    spare: tuple[str, ...] = ()
    if stems:
        found = (rows.where((F.col("kind") == "w") & (F.col("neg") >= 2) & (F.col("neg") * n_pos > F.col("pos") * n_neg))
                 .where(F.substring("entry", 1, STEMS[0]).isin(sorted({s[:STEMS[0]] for s in stems})))
                 .orderBy(F.desc("neg"), "entry").collect())
        spare = tuple(r["entry"] for r in found if any(r["entry"].startswith(s) for s in stems))
    lexicon = Lexicon(words, stems, tuple(dict.fromkeys([*(fold(e) for e in exceptions), *spare])))
    if not words and not stems:
        return lexicon
    fitted = sample.mapInArrow(_matcher(lexicon, ["toxic"]), "toxic int, weight double, hits long, words long")
    # one row for each training document, so at most max_rows
    x = fitted.select("toxic", "weight", "words").toPandas()
    lexicon.coef = _logistic([features(w, n) for w, n in zip(x["weight"], x["words"], strict=True)], x["toxic"])
    return lexicon


def _logistic(x, y, ridge: float = 1.0, steps: int = 50) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    x, y = np.column_stack([np.ones(len(y)), np.asarray(x, float)]), np.asarray(y, float)
    beta, penalty = np.zeros(3), ridge * np.diag([0.0, 1.0, 1.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - penalty @ beta
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def _matcher(lexicon: Lexicon, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for b in batches:
            got = [weighted_hits(t.as_py() or "", automaton) for t in b.column("text")]
            cols = [b.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([g[2] for g in got], pa.int64())], names=[*keep, "weight", "hits", "words"])
    return run


def probability(lexicon: Lexicon) -> Column:
    a, b, c = lexicon.coef
    z = (F.lit(a) + F.lit(b) * F.log1p(F.col("weight"))
         + F.lit(c) * F.log1p(100.0 * F.col("weight") / (F.col("words") + 50.0)))
    return 1 / (1 + F.exp(-z))


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, weight, hits, words, score (0 to 1).

    Only the whole text is read; null counts as empty and has no hits. Repeated
    rows get equal rows; an empty table gives none."""
    ids = F.col(f"`{id_col}`")
    kind = docs.select(ids).schema[0].dataType.simpleString()
    got = (docs.select(ids.alias("id"), F.col(f"`{text_col}`").alias("text"))
           .mapInArrow(_matcher(lexicon, ["id"]), f"id {kind}, weight double, hits long, words long"))
    return got.withColumn("score", probability(lexicon))


def drop_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows scored 0.5 or more, columns as given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, (a, b, c) = lexicon.automaton(), lexicon.coef
        for batch in batches:
            stay = []
            for t in batch.column(text_col):
                weight, _, n = weighted_hits(t.as_py() or "", automaton)
                x, d = features(weight, n)
                stay.append(a + b * x + c * d < 0)
            yield batch.filter(pa.array(stay, pa.bool_()))
    return docs.select(*pick(*docs.columns)).mapInArrow(run, docs.schema)


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
