"""Registered queries against DuckDB or brute force on the small tables."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tabkit.llm import decontamination, queries, secrets, toxicity
from tabkit.llm.common import table
from tools.oracle_check import digest


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def test_all_are_registered():
    names = E.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(queries.SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, sf_dir, con, name):
    got, want = queries.QUERIES[name](spark, sf_dir).toPandas(), con.execute(queries.SQL[name]).df()
    assert digest(got) == digest(want)


def tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(name))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_packing(rows, texts):
    tok = tokenizer("byte_bpe_50k.json")
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        ids, at = [*tok.encode(texts[i], add_special_tokens=False).ids, 0], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[at:at + r.length])
            at += r.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return sum(r.length for r in rows) / (1024 * len(by_seq))


def test_op1_holds_every_id_once_with_little_padding(spark, sf_dir, texts):
    rows = queries.QUERIES["op1_retrieval_packing"](spark, sf_dir).collect()
    assert check_packing(rows, texts) > 0.99


def test_op2_round_trip(spark, sf_dir, texts):
    tok, at = tokenizer("word_bpe_49k.json"), 0
    rows = sorted(queries.QUERIES["op2_arrow_sequences"](spark, sf_dir).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == sorted(texts)
    for r in rows:
        ids = [*tok.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)


def brute_spans(text):
    rules = {"assign": (re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                                   re.I | re.A), 2, 6),
             "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20), "hex": (re.compile(r"[0-9a-f]+"), 0, 24)}
    kinds = list(rules)
    out = [(m.start(), kinds.index(k), f"{k}:{m.start()}:{m.end()}") for k, (p, g, n) in rules.items()
           for m in p.finditer(text) if len(m[g]) >= n]
    return [s for *_, s in sorted(out)]


def test_op3_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in table(spark, d, "documents").collect()}
    rows = queries.QUERIES["op3_blob_ledger"](spark, d).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = brute_spans(texts[r.doc_id])
        assert r.spans == ",".join(want)
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex"))
    assert any(r.spans for r in rows)


def test_op4_shards_are_contiguous_and_balanced(spark, sf_dir, texts):
    rows = queries.QUERIES["op4_byte_shards"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
    ordered = sorted(rows, key=lambda r: r.doc_id)
    assert [r.shard for r in ordered] == sorted(r.shard for r in rows)
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for k in range(24):
        own = [r for r in ordered if r.shard == k]
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 24) <= largest


def test_op7_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    rows = (queries.QUERIES["op7_toxic_lexicon"](spark, d)
            .join(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id").where("held_out").collect())
    assert all(toxicity.is_held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95
    assert np.mean([r.predicted for r in rows if r.toxic == 1]) > 0.8  # a tenth of the toxic labels is on texts without any toxic word


def template_words(text):
    """The canonical words of the operator, written with Python's tools."""
    d = decontamination
    upper = "".join(chr(c) for c in range(0x250) if chr(c).isupper())
    lower = "".join(chr(c) for c in range(0x250) if chr(c).islower())
    x = re.sub(r"[0-9]+(?:[.,:/][0-9]+)*", d.NUMBER, text)
    x = re.sub(f"[$€£]{d.NUMBER}", d.UNIT + d.NUMBER, x)
    x = re.sub(f"({d.NUMBER} ?)(?:{d.UNIT_PATTERN})(?![^\\W\\d_])", lambda m: m[1] + d.UNIT, x)
    for _ in range(2):
        x = re.sub(f"([{lower},;{d.NUMBER}-{d.CLOSE}] )[{upper}][^\\W\\d_]+", lambda m: m[1] + d.NAME, x)
    x = "".join(c for c in x.lower() if c.isalnum() or c in f"{d.NUMBER}{d.UNIT}{d.NAME} \t\n\x0b\x0c\r")
    return x.split()


def test_op8_against_brute_force(spark, sf_dir, con, texts):
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    windows, sizes = defaultdict(set), {}
    marks = {decontamination.NUMBER, decontamination.UNIT, decontamination.NAME}
    for i, t in items:
        w = template_words(t)
        usable = [(k, tuple(w[k:k + 8])) for k in range(len(w) - 7)
                  if sum(not marks & set(x) for x in w[k:k + 8]) >= 4]
        sizes[i] = len(usable)
        for k, win in usable:
            windows[win].add((i, k))
    want = set()
    for doc, t in texts.items():
        w, found = template_words(t), defaultdict(int)
        for p in range(len(w) - 7):
            for i, k in windows.get(tuple(w[p:p + 8]), ()):
                found[i, p - k] += 1
        best = defaultdict(int)
        for (i, _), n in found.items():
            best[i] = max(best[i], n)
        want |= {(doc, i, n, sizes[i]) for i, n in best.items() if n >= min(5, sizes[i])}
    rows = queries.QUERIES["op8_template_leaks"](spark, sf_dir).collect()
    assert {(r.doc_id, r.item_id, r.n_windows, r.item_windows) for r in rows} == want
    assert want


def test_pipeline_stages(spark, sf_dir, texts, con):
    import corpus_pipeline as P
    docs, columns = table(spark, sf_dir, "documents"), table(spark, sf_dir, "documents").columns
    held = {}
    for name, stage in P.STAGES[:-1]:
        docs = P.land(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        held[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    lexicon = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scores = toxicity.score(table(spark, sf_dir, "documents"), lexicon).collect()
    assert held["toxicity"] == {r.id for r in scores if r.score < 0.5}
    best = {}
    for i in sorted(held["toxicity"]):
        norm = re.sub(r"[\x20\x09-\x0D]", "", texts[i])
        if norm not in best or len(texts[i]) > len(texts[best[norm]]):
            best[norm] = i
    assert held["exact_dedup"] == set(best.values())
    con.execute("CREATE OR REPLACE TEMP TABLE kept AS SELECT * FROM documents WHERE doc_id IN "
                f"({','.join(map(str, held['exact_dedup']))})")
    classes = con.execute(queries.SQL["op9_adaptive_prefixes"].replace("documents", "kept")).df()
    assert held["near_dedup"] == set(classes.component_id)
    leaks = {r.id for r in decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).collect()}
    assert held["decontamination"] == held["near_dedup"] - leaks
    pieces = P.STAGES[-1][1](spark, docs, sf_dir).withColumn("ids_crc32", F.crc32("ids")).collect()
    assert check_packing(pieces, {i: texts[i] for i in held["decontamination"]}) > 0.98


def test_scan_rules_drop_short_matches():
    assert secrets.scan_text("token=abc12 token: abc123") == [{"kind": "assign", "start": 12, "end": 25}]
    assert secrets.scan_text("é" + "AKIA" + "A" * 16)[0]["start"] == 1
