"""N-gram Jaccard join with adaptive multi-match prefixes.

1. Every document becomes a set of 64-bit shingle hashes; equal sets are one
   node. Shingles are counted over all nodes in blobs (see ``ring``); only
   shingles of two or more nodes come back. Shared shingles are among them, so
   nothing else is needed to find or verify a link.
2. Shingles are ordered by (count, hash), rarest first. A node of n shingles
   needs an overlap of o = ceil(0.8 n) with any partner, so two linked nodes
   share at least l shingles of their (n - o + l)-prefixes, for any l. Each node
   picks its own l: a longer prefix is scanned, but more shared prefix shingles
   are required; the expected candidates with l matches are at most the sum of
   counts divided by l (Markov), which gives the cost to minimise. The first of
   those shingles lies in both 1-prefixes, so pairs are made from these and the
   longer prefixes are compared once a pair.
3. Leader rounds link the nodes of a prefix bucket to one leader and merge
   classes, a linear number of pairs. Then every remaining pair of different
   classes is generated through the prefixes and verified. Pairs inside a class
   need no check: classes are what is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOC, keeps_locator_name, land, located, pick, releasing, text_bytes
from .ring import (U64, bucket_slices, buckets_for, cut_runs, mix, pack_hashes, pack_owners,
                   unpack_hashes, unpack_owners, word_hashes)

SHINGLE = 5
#: Similarity 80 / 100.
NUM, DEN = 80, 100
#: Longest prefix extension that a node may choose.
MAX_MATCHES = 6
#: Verifying a candidate costs as much as scanning this share of its shingles.
VERIFY_SHARE = 0.25
LEADER_ROUNDS = 4
#: Entries in a slice before it is flushed; two workers and the JVM share an executor.
SLICE_ENTRIES = 400_000

#: Tasks in which a class's nodes meet its least id.
SALTS = 16

WIRE = ("bucket long, kind int, first long, hashes binary, numbers binary, owners binary, many binary, "
        "members binary")
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                    0xFF51AFD7ED558CCD, 0x2545F4914F6CDD1D, 0x27D4EB2F165667C5, 0x94D049BB133111EB], U64)


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Ascending distinct hashes of the ``size``-word shingles; a shorter text
    is one shingle of all its words; no words, no shingles."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, U64)
    h, k = word_hashes(words), min(size, len(words))
    n = len(h) - k + 1
    out = np.full(n, k, U64)
    for j in range(k):
        out += h[j:j + n] * FACTORS[j]
    return np.unique(mix(out))


def node_key(shingles: np.ndarray) -> int:
    h = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return h - (1 << 64) if h >= 1 << 63 else h


def _types() -> list[tuple[str, pa.DataType]]:
    return [("bucket", pa.int64()), ("kind", pa.int32()), ("first", pa.int64()), ("hashes", pa.binary()),
            ("numbers", pa.binary()), ("owners", pa.binary()), ("many", pa.binary()), ("members", pa.binary())]


def _members(ids: pa.Array, got: list[tuple[int, int]]) -> bytes:
    """(id, node, n) of a batch of documents as one Arrow stream: ids of any type
    pass the buckets as one value."""
    cols = [ids, pa.array([k for k, _ in got], pa.int64()), pa.array([n for _, n in got], pa.int64())]
    batch = pa.RecordBatch.from_arrays(cols, names=["id", "node", "n"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _member_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for blob in b.column("members"):
            yield from pa.ipc.open_stream(blob.as_buffer())


def _count_shingles(buckets: int, size: int):
    """Kind 0: entries of a bucket, one for each hash and slice; ``many`` are
    the positions with two or more nodes in the slice and their counts. Kind 1:
    a batch of documents (id, node, n). Kind 2: entries (hash, node) of such positions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: dict[int, np.ndarray] = {}
        total = 0
        task = TaskContext.get()
        # documents go round the buckets, whatever their node: copies of one text share a node
        turn = task.partitionId() if task else 0
        types = _types()

        def flush() -> dict[str, list]:
            owners = np.array(sorted(nodes), np.int64)
            h = np.concatenate([nodes[o] for o in owners.tolist()])
            number = np.repeat(np.arange(len(owners), dtype=np.int32), [len(nodes[o]) for o in owners.tolist()])
            nodes.clear()
            order = np.argsort(h, kind="stable")
            h, number = h[order], number[order]
            del order
            starts = cut_runs(h)
            count = np.diff(np.append(starts, len(h)))
            rows = {c: [] for c, _ in types}
            add = lambda **r: [v.append(r.get(c)) for c, v in rows.items()]
            shared = np.repeat(count > 1, count)
            if shared.any():
                hs, ns = h[shared], number[shared]
                for b, s, e in bucket_slices(hs, buckets):
                    first, blob = pack_hashes(hs[s:e])
                    numbers, used = pack_owners(ns[s:e], owners)
                    add(bucket=b, kind=2, first=first, hashes=blob, numbers=numbers, owners=used)
            h, number = h[starts], number[starts]
            for b, s, e in bucket_slices(h, buckets):
                first, blob = pack_hashes(h[s:e])
                numbers, used = pack_owners(number[s:e], owners)
                at = np.flatnonzero(count[s:e] > 1)
                many = np.stack([at, count[s:e][at]]).astype("<i8").tobytes()
                add(bucket=b, kind=0, first=first, hashes=blob, numbers=numbers, owners=used, many=many)
            return rows

        for batch in batches:
            got = []
            for t in batch.column("text"):
                s = shingle_set(t.as_py() or b"", size)
                key = node_key(s)
                got.append((key, len(s)))
                if len(s) and key not in nodes:
                    nodes[key] = s
                    total += len(s)
            if got:
                yield _batch(types, {"bucket": [turn % buckets], "kind": [1], "members": [_members(batch.column("id"), got)]}, 1)
                turn += 1
            if total >= SLICE_ENTRIES:
                rows = flush()
                yield _batch(types, rows, len(rows["kind"]))
                total = 0
        if nodes:
            rows = flush()
            yield _batch(types, rows, len(rows["kind"]))
    return run


def _batch(types, rows: dict[str, list], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([(rows[c] if isinstance(rows[c], pa.Array) else pa.array(rows[c], t)) if c in rows else pa.nulls(n, t) for c, t in types],
                                      names=[c for c, _ in types])


OUT = "kind int, members binary, node long, hash long, count long"


def _sum_bucket(table: pa.Table) -> pa.Table:
    """Kind 1 rows as they are. Kind 3: (hash, node, count) of each entry whose
    hash has two or more nodes and is known with its count. Kind 4: (hash,
    node) of kind 2, whose counts come from kind 5: (hash, count)."""
    import pyarrow.compute as pc

    out = []

    def add(kind: int, size: int, **cols):
        types = [("kind", pa.int32()), ("members", pa.binary()), ("node", pa.int64()), ("hash", pa.int64()), ("count", pa.int64())]
        cols["kind"] = pa.array(np.full(size, kind, np.int32))
        out.append(pa.Table.from_arrays([cols.get(c, pa.nulls(size, t)) for c, t in types], names=[c for c, _ in types]))

    docs = table.filter(pc.equal(table["kind"], 1))
    add(1, len(docs), members=docs["members"])
    h, node, count = [], [], []
    for r in table.filter(pc.not_equal(table["kind"], 1)).select(
            ["kind", "first", "hashes", "numbers", "owners", "many"]).to_pylist():
        hs, owner = unpack_hashes(r["first"], r["hashes"]), unpack_owners(r["numbers"], r["owners"])
        if r["kind"] == 2:
            add(4, len(hs), hash=pa.array(hs.view(np.int64)), node=pa.array(owner))
            continue
        c = np.ones(len(hs), np.int64)
        at, many = np.frombuffer(r["many"], "<i8").reshape(2, -1)
        c[at] = many
        h.append(hs)
        node.append(owner)
        count.append(c)
    if h:
        h, node, count = np.concatenate(h), np.concatenate(node), np.concatenate(count)
        order = np.lexsort((node, h))
        h, node, count = h[order], node[order], count[order]
        # one node may come from several slices
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (node[1:] != node[:-1]) | (count[1:] > 1) | (count[:-1] > 1)
        h, node, count = h[fresh], node[fresh], count[fresh]
        starts = cut_runs(h)
        sizes = np.diff(np.append(starts, len(h)))
        sums = np.add.reduceat(count, starts)
        all_counts = np.repeat(sums, sizes)
        several = np.repeat(np.logical_or.reduceat(count > 1, starts), sizes)
        one = (count == 1) & (all_counts > 1)
        add(3, int(one.sum()), hash=pa.array(h[one].view(np.int64)), node=pa.array(node[one]),
            count=pa.array(all_counts[one]))
        keys = np.zeros(len(h), bool)
        keys[starts] = True
        keys &= several
        add(5, int(keys.sum()), hash=pa.array(h[keys].view(np.int64)), count=pa.array(all_counts[keys]))
    return pa.concat_tables(out)


def least_overlap(n):
    """Overlap that a set of n needs with any linked set."""
    return -(-NUM * n // DEN)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index entries (hash, node, n, pos, matches, alone) of each node: pos is
    the shingle's place in the node's order, unshared shingles first. They reach
    as far as the longest prefix that any partner and any l may ask for."""
    for b in batches:
        out = [[], [], [], [], [], []]
        for node, n, items in zip(b.column("node").to_pylist(), b.column("n").to_pylist(), b.column("items"),
                                  strict=True):
            flat = items.values
            count = flat.field("count").to_numpy(zero_copy_only=False)
            h = flat.field("hash").to_numpy(zero_copy_only=False)
            alone = n - len(h)
            need = least_overlap(n)
            base = n - need + 1 - alone  # shared shingles in the 1-prefix
            if base <= 0:
                continue
            best, matches = None, 1
            for m in range(1, min(MAX_MATCHES, need) + 1):
                scan = float((count[:base + m - 1] - 1).sum())
                cost = scan + scan / m * VERIFY_SHARE * n
                if best is None or cost < best:
                    best, matches = cost, m
            k = min(len(h), base + MAX_MATCHES - 1)
            out[0].append(h[:k])
            out[1].append(np.full(k, node, np.int64))
            out[2].append(np.full(k, n, np.int64))
            out[3].append(alone + np.arange(k))
            out[4].append(np.full(k, matches, np.int64))
            out[5].append(np.full(k, alone / n))
        cat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.astype(np.float64 if i == 5 else np.int64)) for i, c in enumerate(cat)],
            names=["hash", "node", "n", "pos", "matches", "alone"])


def classes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label) with the least node of each connected class, by
    alternating large-star and small-star steps (Kiveris et al. 2014)."""
    e = land(edges.select("a", "b").where("a <> b"), "edges")
    before = None
    while True:
        # large star: every larger neighbour points at the least of a node's neighbourhood
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        # small star: every smaller neighbour and the node itself point at the least
        down = large.distinct().select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        small = (down.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .unionByName(low.select("a", F.col("low").alias("b"))))
        e = land(small.where("a <> b").distinct(), "edges")
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    label = e.groupBy("a").agg(F.min("b").alias("low"))
    return nodes.join(label, nodes["node"] == label["a"], "left").select("node", F.coalesce("low", "node").alias("label"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that link, by the overlap of their shared shingles."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"),
                                 F.col("items.hash").alias(f"h_{c}"))
    both = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")
    same = F.size(F.array_intersect("h_a", "h_b"))
    return (both.withColumn("same", same).where(DEN * F.col("same") >= NUM * (F.col("n_a") + F.col("n_b") - F.col("same")))
            .select("a", "b"))


def sized_alike(a: str, b: str):
    return (NUM * F.col(a) <= DEN * F.col(b)) & (NUM * F.col(b) <= DEN * F.col(a))


def in_prefixes(n_a: str, pos_a: str, n_b: str, pos_b: str, matches: F.Column):
    """Both places lie in the prefixes of this pair: with l required matches a
    set of n reaches to n - overlap + l, for the overlap that the two sizes ask."""
    need = pair_overlap(n_a, n_b)
    return (F.col(pos_a) < F.col(n_a) - need + matches) & (F.col(pos_b) < F.col(n_b) - need + matches)


def pair_overlap(n_a: str, n_b: str):
    """Overlap that linked sets of these two sizes have at least."""
    return F.ceil((NUM * (F.col(n_a) + F.col(n_b))) / F.lit(float(NUM + DEN)) - F.lit(1e-9))


def prefix(reach: str, n: str, n_a: str, n_b: str):
    """Hashes of the prefix with ``matches`` required matches for this pair."""
    end = F.col(n) - pair_overlap(n_a, n_b) + F.col("matches")
    return F.transform(F.filter(reach, lambda x: x["pos"] < end), lambda x: x["hash"])


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, node (key of its shingle
    set) and component_id, the least id of its class.

    Two documents link when 100 * intersection >= 80 * union of their shingle
    sets; classes are what links reach. Null texts and texts without words have
    no shingles and a class of their own. Null ids stay null and never name a
    class that has other ids. Repeated rows get equal rows; an empty table gives
    none. Sets are compared by 64-bit shingle hashes."""
    # an entry takes several arrays in its bucket's task, so buckets are half the usual size
    buckets = 2 * buckets_for(text_bytes(docs, text_col))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    # as many tasks as the text asks for, a few buckets each
    found = land(rows.mapInArrow(releasing(_count_shingles(buckets, size)), WIRE).repartition(max(1, buckets // 2), "bucket").groupBy("bucket")
                 .applyInArrow(releasing(_sum_bucket), OUT), "shingles")
    members = found.where("kind = 1").select("members").mapInArrow(_member_rows, f"id {kind}, node long, n long")
    sizes = members.where("n > 0").select("node", "n").distinct()
    counts = found.where("kind = 5").select("hash", "count")
    items = (found.where("kind = 3").select("hash", "node", "count")
             .unionByName(found.where("kind = 4").select("hash", "node").distinct().join(counts, "hash")
                          .select("hash", "node", "count"))
             .groupBy("node").agg(F.array_sort(F.collect_set(F.struct("count", "hash"))).alias("items")))
    sets = land(items.join(sizes, "node"), "sets")
    index = land(sets.select("node", "n", "items").mapInArrow(
        releasing(_prefixes), "hash long, node long, n long, pos long, matches long, alone double"), "prefixes")
    nodes = index.select("node").distinct()
    labels = land(nodes.withColumn("label", F.col("node")), "labels")
    links = None
    for k in range(LEADER_ROUNDS):
        short = index.join(labels, "node")
        # first the node with the fewest shingles of its own, then any, by a hash of the round
        rank = F.struct(*([F.col("alone")] if k == 0 else []), F.xxhash64("node", F.lit(k)).alias("mix"),
                        F.col("node").alias("leader"), F.col("n").alias("n_leader"), F.col("pos").alias("p_leader"),
                        F.col("label").alias("l_leader"))
        lead = (short.groupBy("hash").agg(F.min(rank).alias("lead"), F.min("label").alias("lo"), F.max("label").alias("hi"))
                .where("lo <> hi").select("hash", "lead.*"))
        pairs = (short.join(lead, "hash").where((F.col("label") != F.col("l_leader")) & sized_alike("n", "n_leader")
                                                & in_prefixes("n", "pos", "n_leader", "p_leader", F.lit(1)))
                 .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct())
        new = land(verified(pairs, sets), "links")
        if new.isEmpty():
            break
        links = new if links is None else links.unionByName(new)
        labels = land(classes(links, nodes), "labels")
    # every pair of different classes that the prefixes leave possible
    split = index.join(labels, "node")
    side = lambda c: [F.col(x).alias(f"{y}{c}") for x, y in (("node", ""), ("n", "n_"), ("label", "l_"), ("pos", "p_"))]
    probe, other = split.select("hash", "matches", *side("a")), split.select("hash", *side("b"))
    mixed = split.groupBy("hash").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("hash")
    # a linked pair meets in its 1-prefixes already; the longer prefixes are compared once for each such pair
    meet = (probe.join(mixed, "hash", "left_semi").join(other, "hash")
            .where((F.col("a") < F.col("b")) & (F.col("l_a") != F.col("l_b")) & sized_alike("n_a", "n_b")
                   & in_prefixes("n_a", "p_a", "n_b", "p_b", F.lit(1)))
            .select("a", "b", "n_a", "n_b", "matches").distinct())
    reach = index.groupBy("node").agg(F.collect_list(F.struct("pos", "hash")).alias("reach"))
    end = lambda c: reach.select(F.col("node").alias(c), F.col("reach").alias(f"r_{c}"))
    rest = (meet.join(end("a"), "a").join(end("b"), "b")
            .where(F.size(F.array_intersect(prefix("r_a", "n_a", "n_a", "n_b"), prefix("r_b", "n_b", "n_a", "n_b")))
                   >= F.col("matches")))
    new = land(verified(rest, sets), "links")
    if not new.isEmpty():
        labels = classes(new if links is None else links.unionByName(new), nodes)
    labels = land(labels, "labels")
    # the least id of a node, then of its class, so that rows meet their class by node only; the
    # nodes of a class meet it in SALTS tasks
    named = members.where("n > 0").groupBy("node").agg(F.min("id").alias("least")).join(labels, "node", "left")
    alone, linked = named.where("label IS NULL"), named.where("label IS NOT NULL")
    least = (linked.groupBy("label").agg(F.min("least").alias("component"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    linked = linked.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    of_node = land(linked.join(least, ["label", "salt"]).select("node", "component")
                   .unionByName(alone.select("node", F.col("least").alias("component"))), "of_node")
    return (members.join(of_node, "node", "left")
            .select("id", F.col("n").alias("n_shingles"), "node",
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id")))


@keeps_locator_name
def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the one with the least id (null ids
    last), then the first by locator. Columns as given."""
    src = located(docs)
    ids = F.col(f"`{id_col}`")
    rows = src.select(F.struct(ids.isNull().alias("no_id"), ids.alias("id"), F.col(LOC).alias("loc")).alias("row"),
                      F.col(f"`{text_col}`").alias("text"))
    gone = near_classes(rows, "row", "text").where("id <> component_id").select(F.col("id.loc").alias(LOC))
    return src.join(gone.hint("shuffle_hash"), LOC, "left_anti").select(*pick(*docs.columns))
