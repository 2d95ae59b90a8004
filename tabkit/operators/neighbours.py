"""Nearest neighbours (L07): exact in blocks, and approximate by centroid lists.

Exact: base and query rows are dealt into blocks of bounded size by the hash of
their key, every query block meets every base block in a task of its own, and a
query's candidates are merged by distance and key. Nothing is broadcast or
collected, so neither side has a limit.

Approximate: centroids fitted on a bounded sample cut the base into lists; every
base row is indexed. A query looks into the lists of its nearest centroids only,
as many as a check against the exact path on a bounded sample of queries asks
for. A list is cut into parts of bounded size, so a crowded one is many tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .order import land

#: Rows of a block of either side.
BLOCK_ROWS = 20_000
#: Distances held at once, as queries times base rows.
HELD = 4_000_000
#: Rows that centroids are fitted on, and queries that set the number of lists to look into, at most.
FIT_ROWS, CHECK_QUERIES = 50_000, 1_000
MOST_LISTS = 4_096


def usable(df: DataFrame, key: str, col: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """(key, v, extra...) of the rows whose vector is neither null nor empty and
    holds finite entries only."""
    v = F.col(f"`{col}`").cast("array<double>")
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return (df.select(F.col(f"`{key}`").alias("key"), v.alias("v"), *[F.col(f"`{c}`") for c in extra])
            .where(F.col("v").isNotNull() & (F.size("v") > 0)).where(~F.exists("v", bad)))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(q: np.ndarray, x: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the k nearest rows of each query; equal
    distances by ``order``. Candidates come from the expanded square, with room
    for its rounding; their distances are taken from the differences."""
    norm = (x * x).sum(axis=1)
    out_q, out_x, out_d = [], [], []
    step = max(1, HELD // max(1, len(x)))
    for at in range(0, len(q), step):
        part = q[at:at + step]
        own = (part * part).sum(axis=1)
        d = own[:, None] - 2 * part @ x.T + norm
        room = 1e-9 * (own + norm.max())
        limit = np.partition(d, k - 1, axis=1)[:, k - 1] + room if len(x) > k else np.full(len(part), np.inf)
        qi, xi = np.nonzero(d <= limit[:, None])
        exact = np.sqrt(((part[qi] - x[xi]) ** 2).sum(axis=1))
        by = np.lexsort((order[xi], exact, qi))
        qi, xi, exact = qi[by], xi[by], exact[by]
        place = np.arange(len(qi)) - np.searchsorted(qi, qi)
        keep = place < k
        out_q.append(qi[keep] + at)
        out_x.append(xi[keep])
        out_d.append(exact[keep])
    return np.concatenate(out_q), np.concatenate(out_x), np.concatenate(out_d)


def _meet(k: int, schema: pa.Schema, extra: tuple[str, ...]):
    def run(queries: pa.Table, base: pa.Table) -> pa.Table:
        if not queries.num_rows or not base.num_rows:
            return schema.empty_table()
        order = base.column("key").combine_chunks().dictionary_encode()
        rank = np.empty(len(order.dictionary), np.int64)
        rank[pc.sort_indices(order.dictionary).to_numpy()] = np.arange(len(rank))
        qi, xi, d = nearest(matrix(queries.column("v")), matrix(base.column("v")), rank[order.indices.to_numpy()], k)
        base = base.take(pa.array(xi))
        return pa.Table.from_arrays([queries.column("key").take(pa.array(qi)), base.column("key"), pa.array(d),
                                     *(base.column(c) for c in extra)], schema=schema)
    return run


def _merged(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy("dist", "base")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _schema(base: DataFrame, queries: DataFrame, extra: tuple[str, ...]) -> tuple[str, pa.Schema]:
    fields = [("query", queries.schema["key"]), ("base", base.schema["key"])]
    ddl = ", ".join([f"{n} {f.dataType.simpleString()}" for n, f in fields] + ["dist double"]
                    + [f"`{c}` {base.schema[c].dataType.simpleString()}" for c in extra])
    arrow = pa.schema([(n, to_arrow_type(f.dataType)) for n, f in fields] + [("dist", pa.float64())]
                      + [(c, to_arrow_type(base.schema[c].dataType)) for c in extra])
    return ddl, arrow


def exact_neighbours(base: DataFrame, queries: DataFrame, key: str, col: str, k: int = 5,
                     extra: tuple[str, ...] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query, base, dist, rank (from 1) and the base's ``extra`` columns: the k
    nearest base rows of every query row, equal distances by key.

    Euclidean distances in doubles. Rows with a null, empty or non-finite vector
    are neither base nor query; vectors must be of one length. Fewer base rows
    than k give as many. A base key that repeats is a neighbour of its own."""
    b, q = usable(base, key, col, extra), usable(queries, key, col)
    n_base, n_queries = b.count(), q.count()
    parts, blocks = max(1, -(-n_base // block_rows)), max(1, -(-n_queries // block_rows))
    deal = lambda df, n: F.pmod(F.xxhash64("key"), F.lit(n))
    # every block meets every block once: rows go to as many tasks as the other side has blocks
    qs = q.withColumn("i", deal(q, blocks)).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    bs = b.withColumn("j", deal(b, parts)).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    ddl, schema = _schema(b, q, extra)
    found = (qs.repartition(parts * blocks, "i", "j").groupBy("i", "j")
             .cogroup(bs.repartition(parts * blocks, "i", "j").groupBy("i", "j")).applyInArrow(_meet(k, schema, extra), ddl))
    return _merged(found, k)


@dataclass
class Lists:
    """Centroids and the number of lists that a query looks into."""
    centroids: np.ndarray
    probes: int


def _near_lists(centroids: np.ndarray, probes: int, ddl_schema: pa.Schema):
    """Adds the numbers of the nearest centroids, nearest first."""
    norm = (centroids * centroids).sum(axis=1)

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = matrix(pa.chunked_array([b.column("v")]))
                d = norm - 2 * x @ centroids.T
                lists = np.argsort(d, axis=1, kind="stable")[:, :probes].astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, lists.size + 1, lists.shape[1], dtype=np.int32)),
                                                pa.array(lists.ravel()))
                yield pa.RecordBatch.from_arrays([*b.columns, flat], schema=ddl_schema)
    return run


def with_lists(rows: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", lists array<int>"
    schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in rows.schema] + [("lists", pa.list_(pa.int32()))])
    return rows.mapInArrow(_near_lists(centroids, min(probes, len(centroids)), schema), ddl)


def fit_lists(base: DataFrame, key: str, col: str, k: int = 5, lists: int | None = None, recall: float = 0.95,
              seed: int = 13, fit_rows: int = FIT_ROWS, check_queries: int = CHECK_QUERIES) -> Lists:
    """Centroids by K-means on at most ``fit_rows`` rows (by the key's hash), and
    the least number of lists that holds ``recall`` of the true neighbours of at
    most ``check_queries`` of these rows. Default lists: the root of the rows."""
    b = usable(base, key, col)
    n = b.count()
    drawn = F.md5(F.col("key").cast("string"))
    sample = land(b.orderBy(drawn, "key").limit(fit_rows), "fit_rows")
    count = lists or min(MOST_LISTS, max(1, math.isqrt(n)))
    vectors = sample.select(array_to_vector("v").alias("features"))
    count = min(count, vectors.count())
    if count < 2:
        return Lists(np.zeros((1, len((b.first() or {"v": [0.0]})["v"]))), 1)
    centroids = np.array([c for c in KMeans(k=count, seed=seed, maxIter=10).fit(vectors).clusterCenters()])
    queries = land(sample.orderBy(drawn, "key").limit(check_queries), "check_queries")
    true = exact_neighbours(base.select(key, col), queries.select(F.col("key").alias(key), F.col("v").alias(col)), key, col, k + 1)
    true = true.where("query <> base").where(F.col("rank") <= k + 1).select("query", "base")
    owner = with_lists(b, centroids, 1).select(F.col("key").alias("base"), F.col("lists")[0].alias("list"))
    ranked = with_lists(queries, centroids, count).select(F.col("key").alias("query"), "lists")
    at = true.join(owner, "base").join(ranked, "query").select(F.array_position("lists", F.col("list")).alias("at"))
    seen = {r["at"]: r["n"] for r in at.groupBy("at").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most one row a list
    total, held, probes = sum(seen.values()), 0, 1
    for p in range(1, count + 1):
        held += seen.get(p, 0)
        probes = p
        if held >= recall * total:
            break
    return Lists(centroids, probes)


def list_neighbours(base: DataFrame, queries: DataFrame, key: str, col: str, index: Lists, k: int = 5,
                    extra: tuple[str, ...] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Like ``exact_neighbours``, looking into each query's nearest lists only."""
    b, q = usable(base, key, col, extra), usable(queries, key, col)
    owned = land(with_lists(b, index.centroids, 1).withColumn("list", F.col("lists")[0]).drop("lists"), "lists")
    asked = land(with_lists(q, index.centroids, index.probes).select("key", "v", F.explode("lists").alias("list")), "asked")
    # one row a list: into how many parts its rows, and its queries, are cut
    cut = lambda df, n: df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).alias(n))
    sizes = F.broadcast(cut(owned, "parts").join(cut(asked, "blocks"), "list"))
    last = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    deal = lambda c: F.pmod(F.xxhash64("key"), F.col(c))
    bs = (owned.join(sizes, "list").withColumn("j", deal("parts")).withColumn("i", F.explode(last("blocks"))).drop("parts", "blocks"))
    qs = (asked.join(sizes, "list").withColumn("i", deal("blocks")).withColumn("j", F.explode(last("parts"))).drop("parts", "blocks"))
    ddl, schema = _schema(b, q, extra)
    found = qs.groupBy("list", "i", "j").cogroup(bs.groupBy("list", "i", "j")).applyInArrow(_meet(k, schema, extra), ddl)
    return _merged(found, k)


def recall_of(found: DataFrame, true: DataFrame) -> DataFrame:
    """n_queries, n_true, n_found, recall of ``found`` against ``true`` (query, base)."""
    hit = true.select("query", "base").join(found.select("query", "base").withColumn("hit", F.lit(1)), ["query", "base"], "left")
    return hit.agg(F.count_distinct("query").alias("n_queries"), F.count(F.lit(1)).alias("n_true"),
                   F.count("hit").alias("n_found"), (F.count("hit") / F.count(F.lit(1))).alias("recall"))


def vote(found: DataFrame, label: str, weights: str = "uniform", task: str = "classify") -> DataFrame:
    """(query, prediction): class with the largest weight (equal ones: the least
    class), or weighted mean. Weights ``uniform`` or ``distance`` (1/distance)."""
    w = F.lit(1.0) if weights == "uniform" else F.lit(1.0) / F.greatest(F.col("dist"), F.lit(1e-12))
    if task == "regress":
        return found.groupBy("query").agg((F.sum(w * F.col(label)) / F.sum(w)).alias("prediction"))
    votes = found.groupBy("query", label).agg(F.sum(w).alias("w"))
    return votes.groupBy("query").agg(F.min_by(label, F.struct(-F.col("w"), F.col(label))).alias("prediction"))
