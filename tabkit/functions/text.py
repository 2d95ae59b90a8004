"""Text column functions (X01-X05): all JVM-side expressions (regex and SQL
higher-order functions), so they stay inside whole-stage codegen and process
whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col

# Accented letters of the four corpus languages and their base
# letters (what NFKD + ASCII-ignore keeps). Other non-ASCII characters are dropped.
ACCENTED = "áàâãäåçéèêëíìîïñóòôõöúùûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def word_count(text: str | Column) -> Column:
    """Number of whitespace-separated words; null text -> 0."""
    t = col(text)
    return F.coalesce(F.size(F.filter(F.split(F.trim(t), r"\s+"), lambda x: x != F.lit(""))), F.lit(0))


def fold_accents(text: str | Column) -> Column:
    """Lower case, accents folded to base letters, other non-ASCII dropped."""
    low = F.lower(col(text))
    folded = F.regexp_replace(F.translate(low, ACCENTED, PLAIN), r"[^\x00-\x7F]+", "")
    # a text of as many bytes as characters is ASCII and stays as it is
    return F.when(F.octet_length(low) == F.length(low), low).otherwise(folded)


def tokens(text: str | Column, min_len: int = 3, fold: bool = True) -> Column:
    """``\\b[a-zA-Z]+\\b`` tokens of the folded text with a minimum length."""
    t = fold_accents(text) if fold else col(text)
    # no boundary lies between two letters: a shorter run is no match at all
    return F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(rf"\b[a-zA-Z]{{{max(1, min_len)},}}\b"), 0)


def remove_stopwords(toks: Column, stopwords: Sequence[str]) -> Column:
    """Drop stop words, keep order and duplicates."""
    stop = sorted(set(stopwords))  # more than a few literals are looked up in a hash set
    return F.filter(toks, lambda x: ~x.isin(stop))


def bigrams(toks: Column, sep: str = " ") -> Column:
    """Consecutive token pairs ``a b``."""
    n = F.size(toks)
    left = F.slice(toks, F.lit(1), F.greatest(n - 1, F.lit(0)))
    right = F.slice(toks, F.lit(2), F.greatest(n - 1, F.lit(0)))
    return F.when(n >= 2, F.zip_with(left, right, lambda a, b: F.concat_ws(sep, a, b))) \
        .otherwise(F.array().cast("array<string>"))


def expand_optional(pattern: Sequence[tuple[Sequence[str], bool]]) -> list[list[list[str]]]:
    """Expand a pattern of ``(word set, optional)`` positions into fixed-length variants."""
    variants: list[list[list[str]]] = [[]]
    for words, optional in pattern:
        nxt = [v + [list(words)] for v in variants]
        if optional:
            nxt += [list(v) for v in variants]
        variants = nxt
    return [v for v in variants if v]


def _match_at(toks: Column, sets: list[Column], neg: Column, window: int):
    """Predicate ``i -> pattern matches at 1-based position i and no negation word
    is among the ``window`` tokens before it``."""

    def hit(i):
        cond = None
        for j, s in enumerate(sets):
            c = F.array_contains(s, F.try_element_at(toks, i + F.lit(j)))
            cond = c if cond is None else (cond & c)
        lo = F.greatest(i - F.lit(window), F.lit(1))
        negated = F.exists(F.slice(toks, lo, i - lo), lambda x: F.array_contains(neg, x))
        return cond & ~negated

    return hit


def rule_matches(toks: Column, patterns: Sequence[Sequence[tuple[Sequence[str], bool]]],
                 negations: Sequence[str], window: int = 3) -> Column:
    """Number of pattern matches (start, variant) not preceded by a
    negation word among the ``window`` previous tokens. One expression of SQL
    higher-order functions over the token array; no shuffle."""
    neg = F.array(*[F.lit(w) for w in negations])
    n = F.size(toks)
    total = F.lit(0)
    for pat in patterns:
        for var in expand_optional(pat):
            m = len(var)
            sets = [F.array(*[F.lit(w) for w in s]) for s in var]

            hit = _match_at(toks, sets, neg, window)
            starts = F.sequence(F.lit(1), F.greatest(n - F.lit(m - 1), F.lit(1)))
            cnt = F.when(n >= m, F.size(F.filter(starts, hit))).otherwise(F.lit(0))
            total = total + cnt
    return total
