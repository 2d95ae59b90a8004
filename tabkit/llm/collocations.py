"""Phrase collocations by set-oriented relational mining (SETM).

The occurrence relation R1 holds (place, word) of every word of a slice of
documents, sorted by place; a place counts words through the pieces of a slice
and skips one number behind every piece, so equal distance is adjacency within
a piece. Slices are persisted with their group counts. For each length the
counts are summed in Spark by buckets of groups, the groups that are frequent
go back to the slices that hold them (semi-join), the relation keeps their
occurrences, and a merge join of the relation with itself at the adjacent place
gives the next one. A slice counts its own groups first, so a phrase costs one
entry a slice however often it occurs. A frequent group gets a number, by which
longer groups name it; words and counts of the parts are joined at the end.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import land, text_bytes
from .ring import bucket_of, buckets_for, cut_runs, mix

#: Words of a slice, at which it is closed.
SLICE_WORDS = 4_000_000
UNKNOWN = "und"
#: Parts of a language that are ranked on their own before the language is.
PARTS = 64
U64 = np.uint64

# What ends a piece, and what separates its words (both from the contract).
PIECE_ENDS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Marks that end a piece become a word of their own, upper case A-Z lower case, tab a space.
FOLD = bytes.maketrans(PIECE_ENDS + SPACES + bytes(range(65, 91)),
                       b"\n" * len(PIECE_ENDS) + b"  " + bytes(range(97, 123)))

#: kind 0: a slice's relation and its number of words; kind 1: a bucket of its groups, numbered from ``start``.
RELATION = pa.schema([("kind", pa.int32()), ("slice", pa.int64()), ("lang", pa.string()), ("size", pa.int64()),
                      ("places", pa.binary()), ("members", pa.binary()), ("bucket", pa.int32()), ("start", pa.int32()),
                      ("left", pa.binary()), ("right", pa.binary()), ("n", pa.binary())])
#: kind 0: a frequent group; kind 1: members of a slice's groups that are frequent, with their numbers.
FREQUENT = pa.schema([("kind", pa.int32()), ("slice", pa.int64()), ("members", pa.binary()), ("ids", pa.binary()),
                      ("lang", pa.string()), ("id", pa.int64()), ("left", pa.int64()), ("right", pa.int64()),
                      ("word", pa.binary()), ("a", pa.int64())])
RELATION_DDL = ("kind int, slice long, lang string, size long, places binary, members binary, bucket int, start int, "
                "left binary, right binary, n binary")
FREQUENT_DDL = ("kind int, slice long, members binary, ids binary, lang string, id long, left long, right long, "
                "word binary, a long")


def planes(a: np.ndarray, dtype: str) -> bytes:
    """Numbers as planes of equal bytes, which compress well."""
    a = np.ascontiguousarray(a.astype(dtype))
    return a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()


def numbers(blob: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _row(schema: pa.Schema, **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)


def _relation_row(number: int, lang: str, places: np.ndarray, members: np.ndarray) -> pa.RecordBatch:
    return _row(RELATION, kind=0, slice=number, lang=lang, size=len(places),
                places=planes(np.diff(places, prepend=0), "<u4"), members=planes(members, "<u4"))


def _by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, Iterator[tuple[int, int, int]]]:
    """Groups in the order of their buckets, and (bucket, start, end) of the runs."""
    bucket = bucket_of(mix(hashes), buckets)
    order = np.argsort(bucket, kind="stable")
    starts = cut_runs(bucket[order])
    return order, zip(bucket[order][starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True)


def _renumbered(order: np.ndarray, members: np.ndarray) -> np.ndarray:
    new = np.empty(len(order), np.int64)
    new[order] = np.arange(len(order))
    return new[members]


class _Slice:
    """Open slice of one language."""

    def __init__(self):
        self.words: defaultdict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.words[b""], self.words[b"\n"]  # numbers 0 and 1: nothing, and the end of a piece
        self.texts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> int:
        words = text.translate(FOLD).replace(b"\n", b" \n ").split(b" ")
        words.append(b"\n")
        self.texts.append(np.fromiter(map(self.words.__getitem__, words), np.int32, len(words)))
        self.size += len(words)
        return len(words)

    def close(self, number: int, lang: str, buckets: int) -> Iterator[pa.RecordBatch]:
        seen = np.concatenate(self.texts)
        seen = seen[seen > 0]
        places = np.flatnonzero(seen > 1)  # the end of a piece takes a place
        members = seen[places] - 2
        words = list(self.words)[2:]
        if not words:
            return
        n = np.bincount(members, minlength=len(words))
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        order, runs = _by_bucket(np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), U64, len(words)), buckets)
        yield _relation_row(number, lang, places, _renumbered(order, members))
        order_ = order.tolist()
        for bucket, a, b in runs:
            yield _row(RELATION, kind=1, slice=number, lang=lang, bucket=bucket, start=a,
                       left=b" ".join([words[i] for i in order_[a:b]]), n=planes(n[order[a:b]], "<u4"))


def _occurrences(slice_words: int, buckets: int):
    """Relation and groups of every slice of the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, open_, size = TaskContext.get().partitionId() << 32, {}, 0
        for b in batches:
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                if lang not in open_:
                    open_[lang] = _Slice()
                size += open_[lang].add(text or b"")
                if size >= slice_words:
                    for name, s in open_.items():
                        yield from s.close(number, name, buckets)
                        number += 1
                    open_, size = {}, 0
        for name, s in open_.items():
            yield from s.close(number, name, buckets)
            number += 1
    return run


def _numbered_words(table: pa.Table) -> tuple[np.ndarray, list[tuple[str, bytes]]]:
    """Number of each word of the blobs, by (language, word), and these."""
    seen: dict[tuple[str, bytes], int] = defaultdict()
    seen.default_factory = seen.__len__
    groups = [seen[lang, w] for lang, blob in zip(table.column("lang").to_pylist(), table.column("left").to_pylist(), strict=True)
              for w in blob.split(b" ")]
    return np.array(groups, np.int64), list(seen)


def _numbered_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of each pair of the blobs, the pairs, and a blob in which each lies."""
    lefts = [np.cumsum(numbers(x, "<u8"), dtype=U64) for x in table.column("left").to_pylist()]
    left = np.concatenate(lefts)
    right = np.concatenate([numbers(x, "<u8") for x in table.column("right").to_pylist()])
    blob = np.repeat(np.arange(len(lefts)), [len(x) for x in lefts])
    order = np.lexsort((right, left))
    new = np.ones(len(order), bool)
    new[1:] = (left[order][1:] != left[order][:-1]) | (right[order][1:] != right[order][:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    first = order[new]
    return group, left[first], right[first], blob[first]


def _count(length: int, least: int):
    """Frequent groups of a bucket, and what of them each slice holds."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        counts = [numbers(x, "<u4") for x in table.column("n").to_pylist()]
        if length == 1:
            group, words = _numbered_words(table)
        else:
            group, left, right, blob = _numbered_pairs(table)
        total = np.bincount(group, np.concatenate(counts)).astype(np.int64)  # exact below 2^53
        found = np.flatnonzero(total >= least)
        ids = np.full(len(total), -1, np.int64)
        ids[found] = (bucket << 32) + np.arange(len(found))
        none, k = pa.nulls(len(found), pa.binary()), len(found)
        langs = table.column("lang").to_pylist()
        out = [pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(k, np.int32)), pa.nulls(k, pa.int64()), none, none,
             pa.array([words[i][0] if length == 1 else langs[blob[i]] for i in found.tolist()], pa.string()), pa.array(ids[found]),
             pa.nulls(k, pa.int64()) if length == 1 else pa.array(left[found].astype(np.int64)),
             pa.nulls(k, pa.int64()) if length == 1 else pa.array(right[found].astype(np.int64)),
             pa.array([words[i][1] for i in found.tolist()], pa.binary()) if length == 1 else none,
             pa.array(total[found])], schema=FREQUENT)]
        at = 0
        for number, start, n in zip(table.column("slice").to_pylist(), table.column("start").to_pylist(), counts, strict=True):
            mine = ids[group[at:at + len(n)]]
            keep = np.flatnonzero(mine >= 0)
            at += len(n)
            if len(keep):
                out.append(_row(FREQUENT, kind=1, slice=number, members=planes(keep + start, "<u4"),
                                ids=planes(mine[keep], "<u8")))
        return pa.Table.from_batches(out, FREQUENT)
    return run


def merge_adjacent(places: np.ndarray) -> np.ndarray:
    """Rows i of a relation whose next row lies at the adjacent place."""
    return np.flatnonzero(np.diff(places) == 1)


def _extend(buckets: int):
    """A slice's relation and its frequent groups -> the next relation.

    Two groups at adjacent places share all but one word each and make the next
    longer one, named by the numbers of both."""
    def rows(row: pa.Table, frequent: pa.Table) -> Iterator[pa.RecordBatch]:
        if not row.num_rows or not frequent.num_rows:
            return
        places = np.cumsum(numbers(row.column("places")[0].as_py(), "<u4"), dtype=np.int64)
        members = numbers(row.column("members")[0].as_py(), "<u4")
        known = np.concatenate([numbers(x, "<u4") for x in frequent.column("members").to_pylist()])
        names = np.concatenate([numbers(x, "<u8") for x in frequent.column("ids").to_pylist()])
        order = np.argsort(names)
        names = names[order]
        rank = np.full(int(members.max(initial=0)) + 1, -1, np.int64)
        rank[known[order]] = np.arange(len(names))
        ranks = rank[members]
        keep = ranks >= 0  # semi-join with the frequent groups
        places, ranks = places[keep], ranks[keep]
        at = merge_adjacent(places)
        if not len(at):
            return
        pairs, members, n = np.unique(ranks[at] * len(names) + ranks[at + 1], return_inverse=True, return_counts=True)
        left, right = names[pairs // len(names)], names[pairs % len(names)]
        order, runs = _by_bucket(left * U64(0x9E3779B97F4A7C15) ^ right, buckets)
        number, lang = row.column("slice")[0].as_py(), row.column("lang")[0].as_py()
        yield _relation_row(number, lang, places[at], _renumbered(order, members))
        left, right, n = left[order], right[order], n[order]  # pairs ascend within a bucket
        for bucket, a, b in runs:
            yield _row(RELATION, kind=1, slice=number, lang=lang, bucket=bucket, start=a,
                       left=planes(np.diff(left[a:b], prepend=U64(0)), "<u8"), right=planes(right[a:b], "<u8"),
                       n=planes(n[a:b], "<u4"))

    def run(relation: pa.Table, frequent: pa.Table) -> pa.Table:
        return pa.Table.from_batches(rows(relation, frequent), RELATION)
    return run


def _named(longer: DataFrame, shorter: DataFrame, length: int) -> DataFrame:
    """Phrases of ``length`` words from those they begin and end with: lang, id,
    phrase, a, and the counts of both sides of every cut."""
    def side(name: str) -> DataFrame:
        return shorter.select(F.col("id").alias(name), F.col("phrase").alias(f"{name}_phrase"),
                              F.col("a").alias(f"{name}_a"), F.col("parts").alias(f"{name}_parts"))
    last = F.substring_index("right_phrase", " ", -1)
    # of the shorter phrases' cuts, the left one gives the first sides, the right one the others
    firsts = F.concat(F.transform("left_parts", lambda p: p["l"]), F.array("left_a"))
    rests = F.concat(F.array("right_a"), F.transform("right_parts", lambda p: p["r"]))
    parts = F.transform(F.arrays_zip(firsts.alias("l"), rests.alias("r")), lambda p: F.struct(p["l"].alias("l"), p["r"].alias("r")))
    return (longer.join(side("left"), "left").join(side("right"), "right")
            .select("lang", "id", F.concat_ws(" ", "left_phrase", last).alias("phrase"), F.lit(length).alias("words"), "a",
                    parts.alias("parts")))


def mine(docs: DataFrame, longest: int = 3, least: int = 10, text_col: str = "text", lang_col: str = "lang",
         slice_words: int = SLICE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(phrases, words): lang, phrase, words, a, parts of every phrase of 2 to
    ``longest`` words that occurs at least ``least`` times, and lang, n of the
    languages. ``parts`` holds the counts (l, r) of both sides of each cut.

    Null texts count as empty, null languages as ``und``. Counts take every
    occurrence, overlapping ones too; phrases never cross a piece's end. Repeated
    rows count again; an empty table gives no rows; other columns are not read."""
    buckets = buckets_for(text_bytes(docs, text_col))
    rows = docs.select(F.col(f"`{text_col}`").cast("binary").alias("text"),
                       F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    relation = land(rows.mapInArrow(_occurrences(slice_words, buckets), RELATION_DDL), "occurrences")
    words = relation.where("kind = 0").groupBy("lang").agg(F.sum("size").alias("n")).where("n > 0")
    shorter, phrases = None, None
    for length in range(1, longest + 1):
        groups = relation.where("kind = 1").select("bucket", "slice", "lang", "start", "left", "right", "n")
        frequent = land(groups.repartition(buckets, "bucket").groupBy("bucket")
                        .applyInArrow(_count(length, least), FREQUENT_DDL), "frequent")
        found = frequent.where("kind = 0")
        if length == 1:
            shorter = found.select("lang", "id", F.col("word").cast("string").alias("phrase"), F.lit(1).alias("words"), "a",
                                   F.expr("cast(array() as array<struct<l: long, r: long>>)").alias("parts"))
        else:
            shorter = land(_named(found.select("lang", "id", "left", "right", "a"), shorter, length), "phrases")
            phrases = shorter if phrases is None else phrases.unionByName(shorter)
        if length < longest:
            held = relation.where("kind = 0").select("slice", "lang", "places", "members")
            known = frequent.where("kind = 1").select("slice", "members", "ids")
            relation = land(held.repartition(buckets, "slice").groupBy("slice")
                            .cogroup(known.repartition(buckets, "slice").groupBy("slice"))
                            .applyInArrow(_extend(buckets), RELATION_DDL), "occurrences")
    return phrases.select("lang", "phrase", "words", "a", "parts"), words


def scored(phrases: DataFrame) -> DataFrame:
    """Adds l, r and score of the lowest-scoring cut (ties: the shortest first
    part); score = floor(1000000 a a / (l r)) in decimals, without rounding."""
    whole = lambda c: c.cast("decimal(19,0)")
    top = F.expr("CAST(1000000 AS decimal(7,0)) * CAST(a AS decimal(15,0)) * CAST(a AS decimal(15,0))")
    cuts = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), F.element_at("parts", k)["l"].alias("l"), F.element_at("parts", k)["r"].alias("r")))
    rows = phrases.withColumn("top", top).withColumn("cuts", cuts)
    score = F.transform("cuts", lambda c: F.struct(
        F.call_function("div", F.col("top"), whole(c["l"]) * whole(c["r"])).alias("score"), c["k"].alias("k"),
        c["l"].alias("l"), c["r"].alias("r")))
    return (rows.withColumn("cut", F.array_min(score))
            .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score"))


def inner_phrases(phrases: DataFrame, longest: int) -> DataFrame:
    """lang, phrase, outer: the largest count of a longer phrase around it."""
    word = F.split("phrase", " ", -1)
    runs = F.array(*[F.struct(F.lit(size).alias("size"), F.lit(at).alias("at"))
                     for size in range(2, longest) for at in range(1, longest - size + 2)])
    inside = F.filter(runs, lambda r: (r["size"] < F.col("words")) & (r["at"] + r["size"] - 1 <= F.col("words")))
    each = phrases.where("words > 2").withColumn("word", word).select("lang", "a", F.explode(
        F.transform(inside, lambda r: F.array_join(F.slice("word", r["at"], r["size"]), " "))).alias("phrase"))
    return each.groupBy("lang", "phrase").agg(F.max("a").alias("outer"))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, first: int = 2000,
                 text_col: str = "text", lang_col: str = "lang", slice_words: int = SLICE_WORDS) -> DataFrame:
    """Each language's ``first`` best phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase is left out when a longer one around it has at least ``share``
    percent of its count. Order: score and a falling, then the phrase's UTF-8
    bytes. See ``mine`` for nulls, repeated rows and empty tables."""
    phrases, words = mine(docs, longest, least, text_col, lang_col, slice_words)
    rows = scored(phrases)
    if longest > 2:
        around = inner_phrases(rows, longest)
        rows = rows.join(around, ["lang", "phrase"], "left").where(
            F.col("outer").isNull() | (100 * F.col("outer") < share * F.col("a")))
    # first within parts of a language, so that no task sees more than first * PARTS of its phrases
    order = (F.desc("score"), F.desc("a"), "phrase")
    some = Window.partitionBy("lang", "some").orderBy(*order)
    rows = rows.withColumn("some", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    rows = rows.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= first)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    # one row a language
    return (ranked.join(words, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
