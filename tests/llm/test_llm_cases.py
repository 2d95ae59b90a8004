"""Hard cases of every operator: nulls, empty and long texts, ties, repeated
rows, empty tables, clashing column names, hot groups."""

import random
import time
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabkit.llm import (decontamination, exact_dedup, jaccard_join, packing, preferences, ring, secrets, sharding,
                        substring_dedup, token_files, tokens, toxicity)

SCHEMA = ("doc_id long, text string, lang string, id int, loc string, digest string, n string, kept string, node string, "
          "home int, spans string, label string, hash string, size string, block int")
REST = (None, 1, "x", "d", "n", "k", "o", 2, "s", "l", "h", "z", 3)


@pytest.fixture(scope="module")
def words():
    rng = random.Random(7)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(4000)]


@pytest.fixture(scope="module")
def rows(words):
    rng = random.Random(8)
    pick = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = pick(200), pick(60)
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "ONE\ttwo"), (5, base), (6, base.replace(" ", "\n")),
           (7, base + " " + pick(3)), (8, pick(30) + " " + passage + " " + pick(40)), (9, passage), (None, passage),
           (10, pick(20) + " " + passage), (11, "zażółć gęślą jaźń 漢字 <|endoftext|> x  y  z "), (12, pick(15_000)),
           (3, "one two"), (13, "a\x1cb"), (14, "   lead  and trail   ")]
    out += [(100 + i, base) for i in range(60)]  # a third of the rows is one group of copies
    return [(i, t, *REST) for i, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def norm(t):
    return "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.substring(F.sha2(c, 256), 1, 1)])
def test_exact_dedup(docs, rows, digest):
    """Also with a digest of 16 values, where only the byte check tells texts apart."""
    got = exact_dedup.exact_dedup(docs, digest=digest).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i))
    best = sorted((min(g)[3], len(g)) for g in groups.values())
    key = lambda x: (x[0] is None, x)
    assert sorted(((r.id, r.group_size) for r in got if r.kept), key=key) == sorted(best, key=key)
    assert len({tuple(r.keep_loc) for r in got}) == len(groups)


def test_exact_dedup_goes_on_from_its_state(spark, tmp_path):
    from tabkit.llm.common import shared_path
    entries, state = shared_path(spark, "t-entries"), shared_path(spark, "t-state")
    row = "struct<file:string,row:long>"
    for k, batch in enumerate([[(1, 5, "a"), (2, 5, "b")], [(3, 9, "a"), (4, 1, "b")]]):
        (spark.createDataFrame([(i, c, d, ("f", i)) for i, c, d in batch], f"id long, chars long, digest string, loc {row}")
         .write.mode("append").parquet(entries))
        exact_dedup.update_state(entries, spark, state)
    got = {r.digest: (r.best.id, r.n) for r in exact_dedup.read_state(spark, state).collect()}
    assert got == {"a": (3, 2), "b": (2, 2)}


def test_drop_copies_keeps_columns(docs, rows):
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns
    assert got.count() == len({norm(t) for _, t, *_ in rows})


def test_jaccard_join(docs, rows):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {b" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = list(sets)
    comp = {i: i for i in ids}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for a in ids:
        for b in ids:
            s = len(sets[a] & sets[b])
            if s and 100 * s >= 80 * (len(sets[a]) + len(sets[b]) - s):
                x, y = root(a), root(b)
                if x != y:
                    comp[x] = y
    want = {}
    for i in ids:
        want.setdefault(root(i), []).append(i)
    least = {i: min((j for j in g if j is not None), default=None) for g in want.values() for i in g}
    got = jaccard_join.near_classes(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles == len(sets[r.id])
        assert r.component_id == least[r.id]


def test_jaccard_join_of_many_near_copies(spark, words, monkeypatch):
    """Perturbed copies of one text: no exact set repeats, links form chains."""
    monkeypatch.setattr(jaccard_join, "SLICE_ENTRIES", 2_000)
    rng = random.Random(3)
    base = [rng.choice(words) for _ in range(120)]
    data = []
    for i in range(120):
        t = list(base)
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(len(t))] = rng.choice(words)
        data.append((i, " ".join(t)))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = {r.id: r.component_id for r in jaccard_join.near_classes(df).collect()}
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(116)} for i, t in data}
    label = {i: i for i in sets}
    for _ in range(8):
        for a in sets:
            for b in sets:
                s = len(sets[a] & sets[b])
                if 100 * s >= 80 * (len(sets[a]) + len(sets[b]) - s):
                    label[a] = label[b] = min(label[a], label[b])
    assert got == label
    assert len(set(label.values())) > 1


def test_jaccard_join_spreads_copies():
    """Batches of documents go round the buckets, whatever their texts."""
    texts = pa.array([b"one text that all the rows share"] * 6 + [None] * 6, pa.binary())
    batches = [pa.RecordBatch.from_arrays([pa.array(range(12 * k, 12 * k + 12), pa.int64()), texts], names=["id", "text"])
               for k in range(200)]
    out = [r for b in jaccard_join._count_shingles(64, 5)(iter(batches)) for r in b.to_pylist() if r["kind"] == 1]
    members = [m for r in out for b in jaccard_join._member_rows(iter([pa.RecordBatch.from_pylist([r])])) for m in b.to_pylist()]
    assert sorted(m["id"] for m in members) == list(range(2400))
    assert len({m["node"] for m in members}) == 2
    assert max(Counter(r["bucket"] for r in out).values()) <= 200 / 64 + 1


def test_drop_near_copies_goes_by_row(spark, words):
    """Null and repeated ids: one row of each class stays, and no row goes for
    another's id."""
    rng = random.Random(5)
    near = [rng.choice(words) for _ in range(150)]
    like = lambda k: " ".join([*near[:-1], f"end{k}"])
    own = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(3)]
    data = [(None, like(0)), (None, like(1)), (7, like(2)), (3, like(3)), (3, like(4)), (7, own[0]),
            (None, own[1] + " x"), (None, own[1] + " y"), (5, own[2]), (None, None), (None, ""), (7, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    got = jaccard_join.drop_near_copies(docs)
    assert got.columns == docs.columns
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or "")
    want = [(3, like(3)), (7, own[0]), (None, own[1] + " x"), (5, own[2]), (None, None), (None, ""), (7, None)]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def brute_removal(rows, window):
    first = {}
    order = lambda i: substring_dedup.NO_ID if i is None else i
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            s = tuple(w[k:k + window])
            first[s] = min(first.get(s, order(i)), order(i))
    out = []
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < order(i):
                gone |= set(range(k, k + window))
        out.append((i is None, i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("window", [50, 3])
def test_substring_dedup(docs, rows, window, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SLICE_ENTRIES", 500)
    got = substring_dedup.remove_repeats(docs, window=window).collect()
    assert sorted((r.id is None, r.id, r.n_words, r.n_removed, bytes(r.kept)) for r in got) == brute_removal(rows, window)
    assert all(sum(s.end - s.start for s in r.intervals) == r.n_removed for r in got)
    assert all(a.end < b.start for r in got for a, b in zip(r.intervals, r.intervals[1:], strict=False))


def test_substring_dedup_spreads_rows_of_one_id(spark, words, monkeypatch, tmp_path):
    """No id decides where a text goes: rows of one id, of none, and of ids with
    a common step; ties in a slice learn what the first of them learns."""
    monkeypatch.setattr(substring_dedup, "SLICE_ENTRIES", 700)
    rng = random.Random(11)
    passage = " ".join(rng.choice(words) for _ in range(30))
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    data = [(i, f"{text(12)} {passage} {text(9)}") for i in [None] * 60 + [65] * 30 + [65 * k for k in range(2, 40)]]
    data += [((1 << 63) - 1, passage), (None, text(40)), (65, text(40))]
    remove, sizes = substring_dedup._remove, str(tmp_path)

    def counted(window):
        run = remove(window)

        def wrapped(docs, known):
            with open(f"{sizes}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(len(docs)))
            return run(docs, known)
        return wrapped
    monkeypatch.setattr(substring_dedup, "_remove", counted)
    df = spark.createDataFrame(data, "doc_id long, text string").coalesce(2)
    got = substring_dedup.remove_repeats(df, window=10).collect()
    groups = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert sum(groups) >= len(data) and max(groups) < 20
    assert sorted((r.id is None, r.id, r.n_words, r.n_removed, bytes(r.kept)) for r in got) == brute_removal(data, 10)


def test_blobs_round_trip():
    rng = np.random.default_rng(0)
    for h in (np.sort(rng.integers(0, 1 << 63, 50, np.uint64)), np.array([5], np.uint64),
              np.array([0, (1 << 64) - 1], np.uint64)):
        assert (ring.unpack_hashes(*ring.pack_hashes(h)) == h).all()
    owners = np.array([-5, 3, 9], np.int64)
    assert ring.unpack_owners(*ring.pack_owners(np.array([2, 0, 2]), owners)).tolist() == [9, -5, 9]


def test_rolling_hash_depends_on_the_words_only():
    w = [b"a", b"b", b"c", b"d"]
    h = substring_dedup.window_hashes(w + [b"x"] + w, 4)
    assert h[0] == h[5] and len(set(h.tolist())) == 5


def test_shards(docs, rows):
    got = sorted(sharding.byte_shards(docs, shards=7).collect(), key=lambda r: r.before)
    assert sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 8 for _, t, *_ in rows)
    at = 0
    for r in got:
        assert r.before == at
        at += r["size"]
    assert [r.shard for r in got] == sorted(r.shard for r in got)
    for k in {r.shard for r in got}:
        own = [r.slot for r in got if r.shard == k]
        assert own == list(range(len(own)))


def test_ledger_scans_only_unseen_pairs(spark, docs, none):
    text = "x = 1; password = 'hunter2secret'"
    old = spark.createDataFrame([("p1", text), ("p2", text), ("p3", None)], "path string, text string")
    paths, first = secrets.blob_scan(old)
    assert sorted((r.path, len(r.spans)) for r in paths.collect()) == [("p1", 1), ("p2", 1), ("p3", 0)]
    assert first.count() == 2
    more = old.union(spark.createDataFrame([("p4", text), ("p5", "AKIA" + "B" * 16)], "path string, text string"))
    paths, new = secrets.blob_scan(more, ledger=first)
    assert new.count() == 1
    assert sorted((r.path, len(r.spans)) for r in paths.collect()) == [
        ("p1", 1), ("p2", 1), ("p3", 0), ("p4", 1), ("p5", 1)]
    assert secrets.blob_scan(more, rules="base-2", ledger=first)[1].count() == 3
    assert secrets.blob_scan(docs)[0].count() == docs.count()
    assert secrets.blob_scan(none)[0].count() == 0


def test_encoded_ids_equal_whole_texts(rows):
    draw = random.Random(7)
    alphabet = ("abcDEF 0189 \t\n.,;!?'s't\"-_<|>&%#\x00\x1c\x1f\x7f\x85\xa0ÀÉßéüſŒİŉŸı×÷ªµº²½“”’—…€ΣσςДж中文"
                "\u0301\u200b🙂Ⱥẞﬁ")
    mixed = ["".join(draw.choices(alphabet, k=draw.randrange(60))) for _ in range(1500)]
    plain = ["".join(draw.choices("aAeéÉŒœ'tsTSlLmd .,!1\n", k=50)) for _ in range(500)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        enc = tokens.Encoder(tokens.default_path(name))
        texts = [t or "" for _, t, *_ in rows] + mixed + plain + [
            " a", "  a", "a ", "a  b", "\n a", "a \n b", "a\n\n b", " ", "  ", "a b", "x <|endoftext|> y", "it's  we'll\t",
            "a \x1c b", "5 000,1", "a" * 100_000, " " * 1_000_000, "a" + "\n" * 300_000 + "b", "." * 100_000, "é1" * 30_000]
        for t, got in zip(texts, enc.encode(texts), strict=True):
            assert np.frombuffer(got, enc.dtype).tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, repr(t[:99])


def test_packing_of_hard_rows(docs, rows):
    got = packing.pack(docs, window=64).collect()
    assert sum(r.length for r in got) == sum(r.doc_tokens for r in got if r.start == 0)
    assert sum(r.start == 0 for r in got) == len(rows)
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r.length for r in got) / (64 * len(by_seq)) > 0.99


def test_packing_puts_neighbours_together():
    rng = np.random.default_rng(1)
    topics = [rng.integers(100 * k + 1, 100 * k + 100, (20, 31)).astype("<u2") for k in range(5)]
    docs = [np.append(d, np.uint16(0)) for k in range(20) for d in (t[k] for t in topics)]
    pieces = packing.pack_shard(docs, np.ones(1000, np.float32), 32.0, 128)
    by_seq = {}
    for i, _, _, seq, _ in pieces:
        by_seq.setdefault(seq, set()).add(i % 5)
    assert np.mean([len(s) for s in by_seq.values()]) < 1.5


def test_token_files(spark, docs, rows):
    manifest = token_files.write_files(docs, length=32).cache()
    got = sorted(token_files.read_documents(manifest).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    at = 0
    for r in got:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    known = [r.id for r in got if r.id is not None]
    assert known == sorted(known) and got[-1].id is None
    m = manifest.orderBy("part").first()
    seqs, masks = token_files.read_sequences(m.tokens_file, 0, 3)
    flat = np.concatenate([np.frombuffer(r.ids, "<u4") for r in got])[:m.n_tokens]
    real = min(96, m.n_tokens)
    assert seqs.shape[1] == 32 and (seqs.ravel()[masks.ravel()][:real] == flat[:real]).all()


def test_toxicity_folds_and_spares(spark):
    lexicon = toxicity.Lexicon(words={"idiot": 5.0}, stems={"mor": 3.0}, exceptions=("village idiot", "morning"))
    a = lexicon.automaton()
    hits = lambda t: toxicity.weighted_hits(t, a)[:2]
    assert hits("you IDIOT") == hits("you 1d10t") == hits("you іdiоt") == hits("ídïot!") == (5.0, 1)
    assert hits("idiotic") == hits("the village idiot") == hits("good morning") == (0.0, 0)
    assert hits("moronic") == (3.0, 1)
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "idiot idiot", "c"), (2, "", "b")],
                               "doc_id long, text string, score string")
    got = toxicity.score(df, lexicon).collect()
    assert len(got) == 4 and [r.hits for r in got if r.id is None] == [2]


def test_token_files_by_number(spark, tmp_path, monkeypatch):
    """Batches are of one size, and any sequence or document is read by its number alone."""
    monkeypatch.setattr(token_files, "BATCH", 4)
    rng = np.random.default_rng(3)
    docs, at = [], 0
    path = str(tmp_path / "x.arrow")
    with open(path, "wb") as sink:
        w = token_files.SequenceWriter(sink, "<u2", 8)
        for n in [0, 1, 7, 200, 3, 32, 64, 5, 90]:
            docs.append((at, rng.integers(1, 60000, n).astype("<u2")))
            w.add(docs[-1][1])
            at += n
        w.close()
    flat = np.concatenate([ids for _, ids in docs])
    with token_files.SequenceFile(path) as f:
        rows = [f.file.get_batch(k).num_rows for k in range(f.file.num_record_batches)]
        assert set(rows[:-1]) == {4} and sum(rows) == -(-at // 8)
        assert all((f.ids(a, len(ids)) == ids).all() for a, ids in reversed(docs))
        f.held, opened = (-1, None), []
        read = f._column
        f._column = lambda name, k: opened.append(k) or read(name, k)
        seqs, masks = f.sequences(30, 3)
        assert (seqs.ravel() == flat[240:264]).all() and masks.all() and set(opened) == {7, 8}
        last, mask = f.sequences(sum(rows) - 1, 5)
        assert len(last) == 1 and mask.sum() == at % 8 and not last[~mask].any()
        assert f.sequences(sum(rows), 2)[0].shape == (0, 8)


def plain_hits(text, lexicon):
    """(weight, hits) by trying every entry and exception at every word's start."""
    t, best, spared = toxicity.fold(text), {}, []
    edge = lambda i: i == len(t) or not t[i].isalnum()
    for s in range(len(t)):
        if s and t[s - 1].isalnum():
            continue
        spared += [(s, s + len(e)) for e in lexicon.exceptions if t.startswith(e, s) and edge(s + len(e))]
        found = [w for e, w in lexicon.words.items() if t.startswith(e, s) and edge(s + len(e))]
        found += [w for e, w in lexicon.stems.items() if t.startswith(e, s)]
        if found:
            best[s] = max(found)
    left = [w for s, w in best.items() if not any(a <= s < b for a, b in spared)]
    return sum(left), len(left)


def test_toxic_hits_against_every_entry_at_every_place():
    rng = random.Random(5)
    lexicon = toxicity.Lexicon(words={"ab": 2.0, "b": 1.0, "cab": 4.0}, stems={"ba": 3.0, "caba": 1.5},
                               exceptions=("a b c", "b c a", "ab cab b", "c", "bac"))
    a = lexicon.automaton()
    for _ in range(300):
        text = " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 60)))
        assert toxicity.weighted_hits(text, a)[:2] == plain_hits(text, lexicon)


def test_toxic_hits_of_a_very_long_text():
    lexicon = toxicity.Lexicon(words={"idiot": 5.0}, exceptions=("village idiot",))
    start = time.process_time()
    got = toxicity.weighted_hits("idiot village idiot " * 50_000, lexicon.automaton())
    assert got[:2] == (250_000.0, 50_000) and time.process_time() - start < 10


def test_toxicity_learns(spark, none):
    rng = random.Random(2)
    clean = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) for _ in range(30))
    data = [(i, clean() + (" grubnak" + rng.choice(["", "ish", "ton"]) if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (7, None)],
                                   "doc_id long, toxic int")
    lexicon = toxicity.train(docs, labels)
    assert set(lexicon.stems) == {"grub"}
    held = toxicity.score(docs, lexicon).where(toxicity.held_out(F.col("id"))).collect()
    assert all((r.score >= 0.5) == (r.id % 4 == 0) for r in held)
    assert toxicity.drop_toxic(docs, lexicon).count() == 300
    empty = toxicity.train(none, labels)
    assert not empty.stems and toxicity.score(none, empty).count() == 0


def test_decontamination_catches_other_parameters(spark, none):
    item = "A farmer named Alice Smith sold 12 apples for $3 each and then 12 pears that weighed 5 kg in the market"
    same = item.replace("Alice", "Berta").replace("12", "40").replace("$3", "$7").replace("5 kg", "8 km")
    bad = item.replace("12 apples", "40 apples").replace("12 pears", "41 pears")
    data = [(1, "intro here. " + same + " and more text"), (2, item), (3, bad), (4, None), (5, ""), (6, "short"),
            (7, "a farmer sold nothing at all today and then went home to sleep for a while"), (None, item), (2, item)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (None, item), (1, item)],
                                  "item_id long, text string")
    got = decontamination.contaminated(docs, items).collect()
    assert sorted((r.id or 0, r.item_id, r.same_values) for r in got if r.id != 3) == [
        (0, 1, True), (1, 1, False), (2, 1, True), (2, 1, True)]
    three = [r for r in got if r.id == 3]
    assert all(r.consistency < 1 for r in three)
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and {4, 5, 6, 7} <= {r.doc_id for r in kept.collect()} <= {3, 4, 5, 6, 7}
    assert decontamination.contaminated(none, items).count() == 0
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0


def test_decontamination_takes_names_at_sentence_starts(spark):
    item = "Anna has 5 red apples. Ben gives her 3 more apples. Anna then eats 2 of them. How many are left now?"
    other = item.replace("Anna", "Rosa").replace("Ben", "Tom").replace("5", "8").replace("3", "6").replace("2", "4")
    longer = other.replace("Rosa", "Mary Ann")
    shifted = other.replace("then eats", "then quickly eats")  # an extra word moves what follows
    data = [(1, other), (2, "some text before: " + longer + " and after"), (3, shifted), (4, item),
            (5, "Anna has a red car. Ben gives her more rides. How many are left now is not known to anybody here.")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.id: r.same_values for r in decontamination.contaminated(docs, items).collect()}
    assert got == {1: False, 2: False, 3: False, 4: True}


def test_decontamination_by_anchors_and_by_all_windows(spark, sf_dir, monkeypatch):
    """Windows around anchors give what all windows give, also where a window holds
    its anchor twice or another window's anchor."""
    words = "lorem ipsum dolor lorem sit amet ipsum dolor sit lorem consetetur dolor ipsum sit sit amet amet".split()
    odd = [" ".join(words[k:] + words[:k]) for k in range(0, 16, 3)]
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").unionByName(
        spark.createDataFrame([(900 + k, t) for k, t in enumerate(odd)], "item_id long, text string"))
    more = [(10_000 + k, f"{t} {t} and {odd[k - 1]}") for k, t in enumerate(odd)] + [(20_000, None), (20_001, "")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame(more, "doc_id long, text string"))
    rows = lambda: Counter(tuple(r) for r in decontamination.contaminated(docs, bench).drop("loc").collect())
    near = rows()
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert near == rows() and {r[0] for r in near} >= {10_000 + k for k in range(len(odd))}


def test_decontamination_finds_copies_of_short_items(spark):
    items = {1: "What is the capital city of the country France today?", 2: "Who wrote Hamlet?", 3: "12.5 + 7 = ?",
             4: "Anna, Ben, Carl, Dora, Emil, Fritz, Gerd, Hans, Ida, Jan", 5: "zygote", 6: "...", 7: None,
             8: "1 2 3 4 5 6 7 8 9 10 11 13"}
    data = [(k, f"some text before {t} And after") for k, t in items.items() if k < 6 or k == 8]
    data += [(11, "he knew who wrote Othello"), (12, "12.5 - 7 = 5.5"), (13, "125 + 7 ="), (14, "1 2 3 4 5 6 7 8 9 10 11 12"),
             (15, "zygotes"), (16, None), (17, "..."), (18, "Anna, Ben, Carl, Dora, Emil, Fritz, Gerd, Hans, Ida, Tom"),
             (19, items[2].lower())]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = decontamination.contaminated(docs, bench).collect()
    assert {(r.id, r.item_id) for r in got} == {*((k, k) for k in (1, 2, 3, 4, 5, 8)), (19, 2)}
    assert all(r.same_values for r in got)


def test_preferences(spark):
    t = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "<|im_end|>"), (1, 3, "assistant", "ok"),
         (0, 0, "user", "hi"), (0, 1, "assistant", "yo"), (0, 2, "user", "bye"), (4, 0, None, None), (None, 0, "user", "x"),
         (6, 0, "user", "a"), (7, 0, "user", "a"), (7, 0, "user", "a")]
    turns = spark.createDataFrame([(*r, "x") for r in t], "conv_id long, turn int, role string, text string, prompt string")
    convs = preferences.conversations(turns)
    assert {r.conv_id: len(r.turns) for r in convs.collect()} == {0: 3, 1: 4, 4: 1, 6: 1, 7: 2}
    pairs = convs.where("conv_id = 1").select(F.col("turns").alias("chosen_turns")).crossJoin(
        convs.where("conv_id = 0").select(F.col("turns").alias("rejected_turns"))).withColumn("pair_id", F.lit(9))
    r = preferences.preference_rows(pairs).first()
    mark = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert r.prompt == mark("user", "hi") + mark("assistant", "yo") and r.prompt_turns == 2
    assert r.rejected == mark("user", "bye") and r.rejected_mask == []
    (span,) = r.chosen_mask
    assert r.chosen[span.start:span.end] == "ok<|im_end|>\n" and "< |im_end|>" in r.chosen
    swapped = {r.pair_id: r for r in preferences.preference_rows(preferences.swapped_halves(convs)).collect()}
    assert set(swapped) == {0, 1, 6, 7}
    assert swapped[6].rejected == mark("user", "a") and swapped[6].chosen == ""
    assert preferences.preference_rows(preferences.swapped_halves(convs.limit(0))).count() == 0


def test_empty_tables(none):
    assert exact_dedup.exact_dedup(none).count() == 0
    assert jaccard_join.near_classes(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
    assert sharding.byte_shards(none).count() == 0
    assert packing.pack(none).count() == 0
    assert token_files.read_documents(token_files.write_files(none)).count() == 0


def test_held_out_rule():
    assert toxicity.is_held_out(7) == (zlib.crc32(b"7") % 5 == 0)


def test_clashing_names_of_results_and_locator(spark, docs, rows):
    """The fixture has columns digest, spans and loc; here also the locator's name."""
    paths, new = secrets.blob_scan(docs)
    assert paths.columns == [*docs.columns, "digest_2", "spans_2"]
    assert {r["digest"] for r in paths.collect()} == {"d"}
    named = docs.withColumn("__loc", F.lit(7))
    items = spark.createDataFrame([(1, "no such words in any of these texts at all")], "item_id long, text string")
    for drop in (exact_dedup.drop_copies, jaccard_join.drop_near_copies,
                 lambda d: decontamination.drop_contaminated(d, items), lambda d: secrets.blob_scan(d)[0].drop("digest_2", "spans_2")):
        out = drop(named)
        assert out.columns == named.columns and {r["__loc"] for r in out.collect()} == {7}
