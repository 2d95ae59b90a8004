"""Benchmark decontamination by template canonicalisation.

Numbers, units and names of documents and benchmark items become typed
placeholders, so a question with other parameters keeps its template. Every
window of template words that can match is hashed and joined with the benchmark's
windows: each of those has an anchor, its literal word that the fewest of them
hold, and only windows around a document's anchor words can match. Matches are
counted per document, item and alignment. Where enough windows
match, the slot values are compared: each value of the item must stand for one
value in the document.

A name at the start of a sentence looks like any other first word. A second set
of windows therefore has every capitalised word as a name, runs of names as one,
and adds up the matches of neighbouring alignments; it finds what the first set,
in which first words are literal, does not. Items with too few windows for either
are searched whole: by the hash of their first words, then by the text itself.

All of it is DataFrame code. The benchmark's windows and anchors are broadcast only
when the counted number of windows is under a bound, else every window is hashed
and the join shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, LOC, in_classes, keeps_locator_name, land, located, pick

WINDOW = 8
#: Windows that must match on one alignment, or all of a shorter item.
LEAST_WINDOWS = 5
#: Words in a benchmark window that must not be placeholders.
LEAST_LITERALS = 4
#: Distinct item values per distinct (item value, document value) pair.
LEAST_CONSISTENCY = 0.66
#: Benchmark windows that may be broadcast (16 bytes each).
BROADCAST_WINDOWS = 1_000_000
#: Alignments less than this apart count together where every capital is a name.
BAND = 8

# Placeholders (number, unit, name), end of a slot value, units.
NUMBER, UNIT, NAME, CLOSE = "\ue000", "\ue001", "\ue002", "\ue003"
UNITS = ("km", "cm", "mm", "kg", "mg", "ml", "m", "g", "l", "t", "h", "s", "min", "kmh", "mph", "hours", "hour", "minutes",
         "minute", "seconds", "second", "days", "day", "weeks", "week", "years", "year", "meters", "metres", "miles",
         "feet", "inches", "grams", "liters", "litres", "dollars", "euros", "cents", "percent", "degrees")
UNIT_PATTERN = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
DIGITS = r"[0-9]+(?:[.,:/][0-9]+)*"
SPACE = r"[\x20\x09-\x0D]+"
#: A space after a word inside a sentence that is not itself the end of a match.
NAME_SPACE = f"\\x20(?<=[a-z,;\\p{{Ll}}{NUMBER}-{CLOSE}]\\x20)(?<!\\G\\x20)"
DROP = f"[^a-z\\x20\\p{{L}}\\p{{N}}{NUMBER}-{CLOSE}\\x09-\\x0D]+"


PLACES = f"[{NUMBER}{UNIT}{NAME}]"


def marked(text: Column, values: bool = False) -> Column:
    """Text with its numbers and units as placeholders."""
    close, one = (CLOSE, "$1") if values else ("", "")
    x = F.regexp_replace(F.coalesce(text, F.lit("")), f"({DIGITS})", f"{NUMBER}{one}{close}")
    end = CLOSE if values else NUMBER
    mark = f"{UNIT}$2{CLOSE}" if values else UNIT
    x = F.regexp_replace(x, f"([$€£])({NUMBER})", (f"{UNIT}$1{CLOSE}" if values else UNIT) + "$2")
    return F.regexp_replace(x, f"({end}\\x20?)({UNIT_PATTERN})([^\\p{{L}}]|\\z)", f"$1{mark}$3")


def named(x: Column, values: bool = False) -> Column:
    """Marked text with the names inside sentences as placeholders."""
    for _ in range(2):  # the second pass takes names that follow a name
        x = F.regexp_replace(x, f"{NAME_SPACE}(\\p{{Lu}}\\p{{L}}+)", f" {NAME}$1{CLOSE}" if values else f" {NAME}")
    return F.regexp_replace(F.lower(x), DROP, "")


def all_named(x: Column, values: bool = False) -> Column:
    """Marked text with every capitalised word as a name and the last name of a
    run for the run."""
    x = F.regexp_replace(x, "(\\p{Lu}(?<!\\p{L}\\p{Lu})\\p{L}+)", f"{NAME}$1{CLOSE}" if values else NAME)
    x = F.regexp_replace(F.lower(x), DROP, "")
    return F.regexp_replace(x, f"{NAME}[^{CLOSE}]*{CLOSE}{SPACE}(?={NAME})" if values else f"{NAME}{SPACE}(?={NAME})", "")


def template(text: Column, values: bool = False) -> Column:
    """Canonical text with the words' places unchanged. With ``values`` every
    slot keeps its value between the placeholder and ``CLOSE``."""
    return named(marked(text, values), values)


#: Operators that count as words of a plain text, and a point between digits.
OPERATORS, POINT = r"+*/=<>^%:\-\u00d7\u00f7", "\ue004"


def plain(text: Column) -> Column:
    """Lower-case text with its values, without punctuation but with the
    operators of formulas."""
    x = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "([0-9])[.,](?=[0-9])", f"$1{POINT}")
    x = F.regexp_replace(x, f"(?=[{OPERATORS}])(?:[{OPERATORS}]+(?=\\p{{L}})|(?<=\\p{{L}})[{OPERATORS}]+)", "")
    x = F.regexp_replace(x, f"[^a-z\\x20\\p{{L}}\\p{{N}}{POINT}{OPERATORS}\\x09-\\x0D]+", "")
    return F.regexp_replace(x, f"([{OPERATORS}])", " $1 ")


def words_of(canonical: Column) -> Column:
    """Template words; a text without any is one empty word."""
    return F.split(F.btrim(canonical, F.lit(ASCII_SPACE)), SPACE)


def window_hash(words: Column, start: Column, n: Column | int, kind: Column | int) -> Column:
    """The hash of the ``n`` words from ``start`` on."""
    return F.xxhash64(F.slice(words, start + 1, n), F.lit(kind).cast("int"))


def window_starts(words: Column, n: Column | int) -> Column:
    return F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))


def with_anchors(windows: DataFrame) -> DataFrame:
    """``windows`` (with kind, words) plus word and k, their anchor: the literal
    word that the fewest distinct windows hold, then the longest, then the first."""
    places = (windows.select("kind", "words").distinct().select("kind", "words", F.posexplode("words").alias("k", "word"))
              .where((F.col("kind") == 2) | ~F.col("word").rlike(PLACES)))
    rare = places.groupBy("kind", "word").agg(F.count(F.lit(1)).alias("held"))
    best = F.min(F.struct("held", (-F.length("word")).alias("neg"), "k", "word")).alias("best")
    best = places.join(rare, ["kind", "word"]).groupBy("kind", "words").agg(best)
    return windows.join(best, ["kind", "words"]).select(*windows.columns, "best.word", "best.k")


def matching_windows(here: DataFrame, columns: dict[int, str], lengths: dict[int, list[int]], anchors: DataFrame | None) -> DataFrame:
    """Windows of ``here`` (loc and one array of words for each kind): loc, kind,
    start, hash; where anchors are given, those around anchors and their k. A
    window that holds an anchor word twice can come with two k."""
    if anchors is None:
        def of(kind: int, c: str, n: int) -> Column:
            return F.transform(window_starts(F.col(c), n), lambda i: F.struct(
                F.lit(kind).alias("kind"), i.alias("start"), window_hash(F.col(c), i, n, kind).alias("hash")))

        each = [of(kind, c, n) for kind, c in columns.items() for n in lengths[kind]]
        return here.select("loc", F.explode_outer(F.concat(*each)).alias("w")).select("loc", "w.kind", "w.start", "w.hash")
    ends, so_far = {}, F.lit(0)
    for kind, c in columns.items():
        so_far = so_far + F.size(c)
        ends[kind] = so_far
    here = here.select("loc", F.concat(*columns.values()).alias("words"), *[e.alias(f"end{k}") for k, e in ends.items()])
    by_kind = lambda col: F.coalesce(*[F.when(F.col("pos") < F.col(f"end{k}"), col(k)) for k in columns])
    before = dict(zip(columns, [F.lit(0), *[F.col(f"end{k}") for k in columns]], strict=False))
    # outer: a filter on the array's size would be pushed to the scan and compute the words there again
    here = here.select("*", F.posexplode_outer("words").alias("pos", "word")).select(
        "loc", "words", "pos", by_kind(lambda k: before[k]).alias("base"), by_kind(lambda k: F.col(f"end{k}")).alias("end"),
        F.xxhash64("word", by_kind(F.lit)).alias("anchor"))
    anchors = anchors.select(F.xxhash64("word", "kind").alias("anchor"), "k", F.size("words").alias("length"), "kind").distinct()
    start = F.col("pos") - F.col("k")
    return (here.join(F.broadcast(anchors), "anchor")
            .where((start >= F.col("base")) & (start + F.col("length") <= F.col("end")))
            .select("loc", "kind", "k", (start - F.col("base")).alias("start"),
                    window_hash(F.col("words"), start, F.col("length"), F.col("kind")).alias("hash")))


def slot_value(word: Column) -> Column:
    return F.regexp_replace(word, f"^[{NUMBER}{UNIT}{NAME}]|{CLOSE}", "")


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per (row of ``docs``, item) that leaks: loc, id, item_id,
    n_windows (matched), item_windows, n_slots, consistency, same_values.

    An item leaks when, on one alignment, ``LEAST_WINDOWS`` of its usable
    windows match (all, if it has fewer) and its slots are consistent;
    ``same_values`` tells a plain copy from a re-parameterised one. Of several
    alignments the one with most matches counts, then the first. Where none
    does, every capitalised word counts as a name, and alignments less than
    ``BAND`` apart count together. Items with at most ``LEAST_WINDOWS`` usable
    windows, also those of a word, leak too where all their words occur in a
    row with their values (n_windows and item_windows are 1 then). Null texts are
    empty; items without words match nothing;
    repeated rows each get their row; repeated items with one id count once."""
    return _contaminated(located(docs), items, window, id_col, text_col, item_col, item_text_col)


def _contaminated(src: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    bench = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text")).where(
        F.col("item_id").isNotNull()).distinct()
    literal = lambda i: F.size(F.filter(F.slice("__words", i + 1, window), lambda w: ~w.rlike(PLACES))) >= LEAST_LITERALS

    def item_windows(kind: int, canonical) -> DataFrame:
        words = bench.withColumn("__words", words_of(canonical(marked(F.col("text")))))
        return (words.select("item_id", F.explode(window_starts(F.col("__words"), window)).alias("at"), "__words")
                .where(literal(F.col("at"))).select("item_id", F.lit(kind).alias("kind"), "at", F.slice(
                    "__words", F.col("at") + 1, window).alias("words")))

    # kind 0: names inside sentences, kind 1: every capital a name
    usable = land(item_windows(0, named).unionByName(item_windows(1, all_named)).distinct(), "bench-windows")
    needs = land(usable.groupBy("item_id", "kind").agg(
        F.count(F.lit(1)).alias("item_windows"), F.collect_set("at").alias("ats")), "bench-needs")
    # kind 2: items that a copy in running text may miss, as fewer windows than needed stay without the first word
    short = (bench.join(needs.where((F.col("kind") == 0) & (F.col("item_windows") > LEAST_WINDOWS)), "item_id", "left_anti")
             .select("item_id", words_of(plain(F.col("text"))).alias("words")).where(F.get("words", F.lit(0)) != ""))
    short = land(short.select("item_id", F.array_join("words", " ").alias("whole"), F.slice("words", 1, window).alias("words")),
                 "bench-short")
    lengths = sorted(r.n for r in short.select(F.size("words").alias("n")).distinct().collect())
    usable = usable.unionByName(short.select("item_id", F.lit(2).alias("kind"), F.lit(0).alias("at"), "words").distinct())
    few = usable.count() <= BROADCAST_WINDOWS
    on = ["hash", "kind"]
    if few:
        usable, on = land(with_anchors(usable), "bench-anchors"), [*on, "k"]
    anchors = usable if few else None
    usable = usable.withColumn("hash", F.xxhash64("words", "kind")).select("item_id", "at", *on)
    here = src.select(F.col(f"`{text_col}`").alias("text"), F.col(LOC).alias("loc")).withColumn("__m", marked(F.col("text")))
    here = (here.withColumn("__w0", words_of(named(F.col("__m")))).withColumn("__w1", words_of(all_named(F.col("__m")))))
    columns, sizes = {0: "__w0", 1: "__w1"}, {0: [window], 1: [window], 2: lengths}
    if lengths:
        here, columns = here.withColumn("__w2", words_of(plain(F.col("text")))), columns | {2: "__w2"}
    found = matching_windows(here, columns, sizes, anchors)
    shift = F.when(F.col("kind") == 2, 0).otherwise(F.col("start") - F.col("at"))
    hits = (found.join(F.broadcast(usable) if few else usable, on)
            .groupBy("loc", "item_id", "kind", shift.alias("shift")).agg(
                F.count(F.lit(1)).alias("n_windows")))
    sizes = needs.drop("ats")
    hits = land(hits.join(F.broadcast(sizes) if few else sizes, ["item_id", "kind"], "left"), "leaks")
    enough = F.col("n_windows") >= F.least(F.lit(LEAST_WINDOWS), F.col("item_windows"))
    candidates = hits.where(F.col("kind") == 0).drop("kind").where(enough)
    band = F.floor(F.col("shift") / BAND)
    bands = (hits.where(F.col("kind") == 1).withColumn("band", F.explode(F.array(band, band + 1)))
             .groupBy("loc", "item_id", "band", "item_windows").agg(
                 F.collect_list("shift").alias("found"), F.min("shift").alias("shift"), F.sum("n_windows").alias("n_windows"))
             .where(enough))
    firsts = hits.where(F.col("kind") == 2).select("loc", "item_id")
    where = candidates.select("loc").unionByName(bands.select("loc")).unionByName(firsts.select("loc"))
    texts = in_classes(src.select(F.col(LOC).alias("loc"), F.col(f"`{id_col}`").alias("id"),
                                  F.col(f"`{text_col}`").alias("text")), F.col("loc"), where, F.col("loc"))
    both = (candidates.join(texts, "loc")
            .select("loc", "id", "item_id", "shift", "n_windows", "item_windows",
                    words_of(template(F.col("text"), values=True)).alias("d"))
            .join(bench.select("item_id", words_of(template(F.col("text"), values=True)).alias("b")), "item_id"))
    kind = lambda w: F.regexp_replace(w, f"([{NUMBER}{UNIT}{NAME}])[^{CLOSE}]*{CLOSE}", "$1")
    there = lambda i: F.get(F.col("d"), i + F.col("shift"))
    slots = F.filter(F.sequence(F.lit(0), F.size("b") - 1), lambda i: F.get(F.col("b"), i).rlike(PLACES)
                     & (i + F.col("shift") >= 0) & (i + F.col("shift") < F.size("d"))
                     & (kind(F.get(F.col("b"), i)) == kind(there(i))))
    pairs = F.transform("slots", lambda i: F.struct(F.get(F.col("b"), i).alias("b"), there(i).alias("d")))
    out = ["loc", "item_id", "kind", "n_windows", "shift", "id", "item_windows", "n_slots", "consistency", "same_values"]
    both = (both.withColumn("slots", slots).withColumn("pairs", pairs).withColumn("n_slots", F.size("slots"))
            .withColumn("kind", F.lit(0)))

    def agreeing(rows: DataFrame) -> DataFrame:
        return (rows.withColumn("n_pairs", F.size(F.array_distinct("pairs")))
                .withColumn("consistency", F.when(F.col("n_pairs") == 0, 1.0).otherwise(
                    F.size(F.array_distinct("pairs.b")) / F.col("n_pairs")))
                .withColumn("same_values", F.forall("pairs", lambda p: p["b"] == p["d"]))
                .where(F.col("consistency") >= LEAST_CONSISTENCY).select(*out))

    # the rest only where these do not tell already
    leaked = land(agreeing(both), "leaks-named")
    left = lambda df: df.join(leaked.select("loc", "item_id"), ["loc", "item_id"], "left_anti")
    # every slot of every matched window, each on the alignment of its window
    full = lambda c: words_of(all_named(marked(F.col(c), values=True), values=True))
    near = (left(bands).join(texts, "loc").withColumn("d", full("text")).drop("text")
            .join(bench.select("item_id", full("text").alias("b")), "item_id"))
    kinds = lambda c: F.transform(c, lambda w: kind(w))
    near = near.join(needs.where(F.col("kind") == 1).select("item_id", "ats"), "item_id").withColumns(
        {"kb": kinds("b"), "kd": kinds("d")})
    # a window matches on a shift where all its words do; an item's window counts once
    same = lambda at, to: ((to >= 0) & (at + window <= F.size("kb")) & (to + window <= F.size("kd"))
                           & (F.slice("kb", at + 1, window) == F.slice("kd", F.greatest(to, F.lit(0)) + 1, window)))
    near = near.withColumn("found", F.transform("found", lambda f: F.struct(
        f.alias("shift"), F.filter("ats", lambda at: same(at, (at + f).cast("int"))).alias("ats"))))
    # landed: a filter pushed below would compute the words anew for every window
    near = land(near.select("loc", "id", "item_id", "shift", "item_windows", "b", "d", "found"), "leak-near")
    near = near.withColumn("n_windows", F.size(F.array_distinct(F.flatten("found.ats"))).cast("long")).where(enough)
    of_window = lambda f, at: F.transform(F.sequence(at, at + (window - 1)), lambda i: F.struct(
        i.alias("i"), F.get(F.col("b"), i).alias("b"), F.get(F.col("d"), (i + f["shift"]).cast("int")).alias("d")))
    slots = F.flatten(F.transform("found", lambda f: F.flatten(F.transform(f["ats"], lambda at: of_window(f, at)))))
    near = (near.withColumn("slots", F.array_distinct(F.filter(slots, lambda x: x["b"].rlike(PLACES) & (kind(x["b"]) == kind(x["d"])))))
            .withColumn("pairs", F.transform("slots", lambda x: F.struct(x["b"].alias("b"), x["d"].alias("d"))))
            .withColumn("n_slots", F.size(F.array_distinct("slots.i"))).withColumn("kind", F.lit(1)))

    padded = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    copies = (left(firsts).join(texts, "loc").withColumn("d", padded(F.array_join(words_of(plain(F.col("text"))), " ")))
              .join(short.select("item_id", "whole"), "item_id").where(F.contains(F.col("d"), padded(F.col("whole"))))
              .withColumns({"kind": F.lit(2), "n_windows": F.lit(1).cast("long"), "shift": F.lit(0),
                            "item_windows": F.lit(1).cast("long"), "n_slots": F.lit(0), "consistency": F.lit(1.0),
                            "same_values": F.lit(True)}).select(*out))
    best = F.min(F.struct("kind", (-F.col("n_windows")).alias("neg"), "shift", "id", "item_windows", "n_slots",
                          "consistency", "same_values")).alias("best")
    return leaked.unionByName(agreeing(near)).unionByName(copies).groupBy("loc", "item_id").agg(best).select(
        "loc", F.col("best.id").alias("id"), "item_id", (-F.col("best.neg")).alias("n_windows"), "best.item_windows",
        F.col("best.n_slots").cast("long").alias("n_slots"), "best.consistency", "best.same_values")


@keeps_locator_name
def drop_contaminated(docs: DataFrame, items: DataFrame, **names: str) -> DataFrame:
    """``docs`` without the rows that hold an item, columns as given."""
    src = located(docs)
    gone = land(_contaminated(src, items, **names).select(F.col("loc").alias(LOC)).distinct(), "contaminated")
    return src.join(gone.hint("shuffle_hash"), LOC, "left_anti").select(*pick(*docs.columns))
