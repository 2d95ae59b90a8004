"""Secret scan over an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text). The
ledger holds the (blob, rule version) pairs scanned before; only pairs that it
lacks are scanned, each once however many paths hold the blob, and findings
join back to all paths through the digest. Per-path traffic is digests only; a
blob's text moves once, to the task that scans it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOC, free_name, land, located, pick

# Rule kinds in their order, patterns and least lengths.
RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", re.A, 0, 20),
    ("hex", r"[0-9a-f]+", re.A, 0, 24),
)
RULE_VERSION = "base-1"

FINDINGS = "digest string, rules string, spans array<struct<kind:string,start:int,end:int>>"


def scan_text(text: str) -> list[dict]:
    """Spans (code points, end exclusive) by start, then kind in rule order.

    Matches are leftmost and non-overlapping per kind over the whole text; a
    match whose group is too short is dropped after matching, so its
    characters stay used."""
    found = []
    for order, (kind, pattern, flags, group, least) in enumerate(RULES):
        for m in re.compile(pattern, flags).finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [{"kind": k, "start": s, "end": e} for s, _, k, e in sorted(found)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for b in batches:
        spans = [scan_text(t.as_py() or "") for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("digest"), b.column("rules"), pa.array(spans, kind)],
                                         names=["digest", "rules", "spans"])


def blob_scan(docs: DataFrame, text_col: str = "text", rules: str = RULE_VERSION,
              ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns (paths, new): ``paths`` is ``docs`` (all columns) plus
    ``digest`` and ``spans`` of its blob (under the first free name of digest,
    digest_2, ... where ``docs`` has such columns); ``new`` holds the ledger rows
    (digest, rules, spans) scanned now, to be appended to the caller's ledger
    table, blobs without findings included.

    ``ledger`` has the columns of ``new``; pairs in it are not scanned again.
    A null text is the empty blob. Repeated rows share one blob. An empty table
    gives empty results."""
    names = [free_name(docs, n) for n in ("digest", "spans")]
    given = [free_name(docs, "__given")] * (LOC in docs.columns)
    src = located(docs.withColumnRenamed(LOC, given[0]) if given else docs)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    digest = F.sha2(text, 256)
    blobs = src.select(digest.alias("digest"), F.col(LOC)).groupBy("digest").agg(F.min(LOC).alias(LOC))
    if ledger is not None:
        blobs = blobs.join(ledger.where(F.col("rules") == rules).select("digest"), "digest", "left_anti")
    unseen = (src.select(text.alias("text"), F.col(LOC))
              .join(blobs.withColumn("rules", F.lit(rules)).hint("shuffle_hash"), LOC)
              .select("digest", "rules", "text"))
    new = land(unseen.mapInArrow(_scan, FINDINGS), "blob-ledger")
    known = new if ledger is None else new.unionByName(ledger.where(F.col("rules") == rules).select(*new.columns))
    own = [F.col(f"`{given[0] if c == LOC else c}`").alias(c) for c in docs.columns]
    mine, found, spans = (free_name(docs, n) for n in ("__mine", "__digest", "__spans"))
    hits = known.where(F.size("spans") > 0).select(F.col("digest").alias(found), F.col("spans").alias(spans))
    paths = src.select(*own, digest.alias(mine)).join(hits.hint("shuffle_hash"), F.col(mine) == F.col(found), "left")
    empty = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    return paths.select(*pick(*docs.columns), F.col(mine).alias(names[0]), F.coalesce(spans, empty).alias(names[1])), new


def joined_spans(spans: str = "spans") -> F.Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
