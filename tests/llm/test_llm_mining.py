"""Collocations, exact-complement packing and whitening: brute force and hard cases."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabkit.llm import collocations, exact_fit, queries, whitening

SCHEMA = ("doc_id long, text string, lang string, n long, phrase string, slice long, member int, kind int, part int, "
          "length long, nth long, base long, x int")
REST = (5, "p", 1, 2, 0, 3, 4, 5, 6, 7)


def brute_phrases(rows, longest=3, least=10, share=50, first=2000):
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = tuple(w for w in re.split("[ \t]", piece) if w)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                count[lang].update(words[i:i + k] for i in range(len(words) - k + 1))
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            if any(100 * b >= share * a for q, b in found.items() if len(q) > len(p)
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(5)
    vocab = ["a", "B", "b", "\x00c", "été", "漢字", "d e", "don't", "x=1"]
    glue = [" ", "  ", "\t", ". ", ",", "\n", " ; "]
    make = lambda n: "".join(rng.choice(vocab) + rng.choice(glue) for _ in range(n))
    out = [(i, make(rng.randint(0, 60)), rng.choice(["en", "de", None, "und"])) for i in range(60)]
    out += [(100, None, "en"), (101, "", None), (None, " \t.,", "en"), (102, "a b " * 4000, "de"), (None, "a a a a", "fr")]
    out += [(200 + i, "hot line of words repeated", "en") for i in range(40)]
    return out


@pytest.mark.parametrize("longest,least,share,slice_words", [(3, 10, 50, 4_000_000), (3, 3, 80, 500), (5, 4, 50, 900), (2, 2, 50, 50)])
def test_collocations(spark, prose, longest, least, share, slice_words):
    docs = spark.createDataFrame([(*r, *REST) for r in prose], SCHEMA).repartition(5)
    got = collocations.collocations(docs, longest, least, share, slice_words=slice_words).collect()
    assert sorted(tuple(r) for r in got) == brute_phrases([r[1:] for r in prose], longest, least, share)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, None, None, *REST)], SCHEMA)).collect() == []
    first = collocations.collocations(spark.createDataFrame([(1, "b b a a c c " * 50, "en", *REST)], SCHEMA), 2, 2, first=3)
    assert sorted(r["rank"] for r in first.collect()) == [1, 2, 3]


def test_scores_pass_64_bits(spark):
    a = 3 * 10**13
    rows = spark.createDataFrame([("en", "x y", 2, a, [(a + 1, a + 7)])],
                                 "lang string, phrase string, words int, a long, parts array<struct<l: long, r: long>>")
    got = collocations.scored(rows).first()
    assert got["score"] == 10**6 * a * a // ((a + 1) * (a + 7)) and (got["l"], got["r"]) == (a + 1, a + 7)


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    window = int(rng.integers(3, 300))
    lengths = np.minimum(window, np.maximum(1, rng.lognormal(np.log(window / 4), 1, 2000).astype(int)))
    lengths[:700] = 1
    counts = np.bincount(lengths, minlength=window + 1)
    patterns, used = exact_fit.plan(counts), np.zeros(window + 1, int)
    for times, pattern in patterns:
        assert times > 0 and sum(x * n for x, n in pattern.items()) <= window
        for x, n in pattern.items():
            used[x] += times * n
    assert (used == counts).all()
    assert sum(t for t, _ in patterns) <= -(-int(lengths.sum()) // window) + 1
    places, seen = exact_fit.Places(patterns, window), defaultdict(list)
    for x in range(1, window + 1):
        ranks = np.arange(counts[x])
        for s, o in zip(*places.of(np.full(len(ranks), x), ranks), strict=True):
            seen[s].append((o, x))
    for bin_ in seen.values():
        at = 0
        for o, x in sorted(bin_):
            assert o == at
            at += x


def test_complements_of_one_two_and_three():
    patterns = exact_fit.plan(np.bincount([10, 6, 4, 5, 3, 2, 7, 1, 1, 1], minlength=11))
    assert all(sum(x * n for x, n in p.items()) == 10 for _, p in patterns)
    brute = [c for n in (1, 2, 3) for c in itertools.combinations_with_replacement(range(1, 10), n)]
    rng = random.Random(2)
    for _ in range(50):
        counts = np.array([0] + [rng.choice([0, 0, 1, 2]) for _ in range(10)])
        sums = exact_fit.Sums(counts)
        for x in range(1, 11):
            if counts[x] and rng.random() < 0.3:
                sums.take(x, 1)
        for gap in range(1, 10):
            possible = any(sum(c) == gap and all(sums.counts[x] >= n for x, n in Counter(c).items()) for c in brute)
            found = sums.filling(gap, Counter())
            assert (found is not None) == possible
            assert found is None or sum(found) == gap


def token_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = test_tok.setdefault("t", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    return [*tok.encode(text or "", add_special_tokens=False).ids, 0]


test_tok: dict = {}


def check_exact_fit(rows, texts, window):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        ids, at = token_ids(texts[i]), 0
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // window)))
        assert all(r.length == window for r in pieces[1:])
        for r in pieces:
            assert r.start == at and r.crc == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return len(by_seq) - -(-sum(r.length for r in rows) // window)


def test_op12_on_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries.QUERIES["op12_exact_complements"](spark, sf_dir).withColumnRenamed("ids_crc32", "crc").collect()
    assert check_exact_fit(rows, {r.doc_id: r.text for r in docs.collect()}, 2048) <= 1


def test_exact_fit_cases(spark, prose):
    from pyspark.sql import functions as F
    data = [(i, t, *REST) for i, t in [(1, None), (2, ""), (3, "one"), (4, "one two " * 900), (5, "a" * 5000), (6, "<|endoftext|>")]]
    data += [(100 + i, None, *REST) for i in range(30)]
    docs = spark.createDataFrame([(i, t, "en", *r) for i, t, *r in data], SCHEMA).repartition(4)
    pieces = exact_fit.pack(docs, window=64)
    rows = pieces.withColumn("crc", F.crc32("ids")).collect()
    assert check_exact_fit(rows, {i: t for i, t, *_ in data}, 64) <= 1
    whole = {r.sequence_id: r for r in exact_fit.sequences(pieces).collect()}
    assert sum(r.n_tokens for r in whole.values()) == sum(r.length for r in rows)
    assert all(len(r.ids) == 4 * r.n_tokens and sum(r.lengths) == r.n_tokens for r in whole.values())
    assert exact_fit.pack(spark.createDataFrame([], SCHEMA)).collect() == []
    twice = exact_fit.pack(spark.createDataFrame([(None, "x", "en", *REST), (None, "x", "en", *REST)], SCHEMA)).collect()
    assert [r.doc_id for r in twice] == [None, None] and {r.offset for r in twice} == {0, twice[0].length}


VECTORS = "vec_id long, embedding array<float>, id int, x int, n int, component int, at int"


def check_whitening(rows, data, unique=True):
    """Against eigh: exact n and deviation, explained, and the projection on every simple eigenvector."""
    usable = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in data
              if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.unique(np.array([v for _, v in usable]), axis=0)
    n, s = len(x), x.sum(axis=0)
    cov = (x - s / n).T @ (x - s / n) / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    k = min(4, int((e > 1e-12 * e[0]).sum()))
    assert len(rows) == k * len(usable)
    want = defaultdict(list)
    for i, v in usable:
        want[i].append(v)
    sign = {}
    for r in rows:
        assert r.n == n and r.identity_error <= 1e-10
        assert r.deviation in {int(((n * v - s) ** 2).sum()) for v in want[r.id]}
        c = r.component - 1
        assert r.explained == pytest.approx(e[c] / e.sum(), rel=1e-9)
        simple = all(abs(e[c] - e[j]) > 1e-6 * e[0] for j in range(len(e)) if j != c)
        if simple and len(want[r.id]) == 1:
            w = float((want[r.id][0] - s / n) @ q[:, c] / np.sqrt(e[c]))
            if abs(w) > 1e-6:
                sign.setdefault(c, np.sign(w * r.whitened))
                assert r.whitened == pytest.approx(sign[c] * w, abs=1e-8)
    return sign


def test_op13_on_the_table(spark, sf_dir):
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    rows = queries.QUERIES["op13_lanczos_whitening"](spark, sf_dir).withColumnRenamed("vec_id", "id").collect()
    assert len(check_whitening(rows, data)) == 4


@pytest.mark.parametrize("case", ["bad", "repeated", "flat", "ties", "rank", "lengths"])
def test_whitening_cases(spark, case):
    rng = np.random.default_rng(4)
    base = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(40, 5)) * [5, 3, 2, 1, 0.5])]
    nan, inf = float("nan"), float("inf")
    data = {"bad": [*base, (90, None), (91, []), (92, [1.0, None, 1.0, 1.0, 1.0]), (93, [nan] * 5), (94, [inf, 1.0, 1.0, 1.0, 1.0]),
                    (None, [1.0] * 5)],
            "repeated": base + [(100 + i, base[0][1]) for i in range(40)],
            "flat": [(i, [1.0, 2.0]) for i in range(5)],
            "ties": [(i, [float(c) for c in v]) for i, v in enumerate(itertools.product([0, 1], repeat=6))],
            "rank": [(i, [t, 2 * t, 0.0, -t]) for i, t in enumerate(map(float, range(1, 30)))],
            "lengths": [*base, (200, [1.0, 2.0])]}[case]
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4, 5) for i, v in data], VECTORS).repartition(3)
    rows = whitening.whitened(df).collect()
    if case == "flat":
        assert rows == []
        return
    check_whitening(rows, data[:40] if case == "lengths" else data)


def test_whitening_of_nothing(spark):
    assert whitening.whitened(spark.createDataFrame([], VECTORS)).collect() == []


def test_deviation_in_any_size():
    x = np.array([[1 << 40, -(1 << 41)], [5, 7]])
    n, sums = 3_000_000, [1 << 60, -(1 << 61)]
    assert whitening.exact_deviation(x, n, sums) == [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in x]
