"""Benchmark decontamination with DataFrame functions only.

Words are runs of letters and digits (all non-ASCII characters included) after A-Z are lower-cased. The test items give
broadcast hash sets: the hash of each 5-word block of their windows, and their windows. Of a training text only every fifth
5-word block is looked up first: each window of ten words holds one whole block. Around a block that is found, the
windows that hold it are looked up, by hash and then word by word, so every hit is an exact match of ten words. Items of fewer
than ten words are looked up at every word with which one of them begins.

A text is read and cut into words once. Every row also sends one entry of its own, which carries its number of words, so that
hits and rows meet in one aggregation by row number and rows of equal ``doc_id`` stay apart.

The item windows are sent to all tasks, so their number is checked against ``max_item_windows`` first; a larger
benchmark raises, it is never cut. Raise the bound, or pass the benchmark in parts.

Defined results: null and empty texts have no words; an item without words is never found; repeated items count once
for each different ``item_id``; rows of equal or null ``doc_id`` each have the hits of their own text;
further columns, whatever their names, are kept by :func:`without_contamination` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: characters of words besides all non-ASCII ones, and the words of a window.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"
WINDOW = 10
BLOCK = WINDOW // 2

_BREAKS = "".join(c for c in map(chr, range(128)) if c not in UPPER + LOWER + DIGITS)

#: The piece of the entry that every row sends for itself.
OWN = 0


def words_in(text: Column) -> Column:
    """One pass maps capitals and everything that separates words, then the text is cut at spaces."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + _BREAKS, LOWER + " " * len(_BREAKS))
    return F.array_remove(F.split(plain, " "), "")


def item_windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(item, n, words): every window of each item, or the whole item if it is shorter."""
    words = benchmark.select(F.col(item).alias("item"), words_in(F.col(text)).alias("words"))
    size = F.least(F.size("words"), F.lit(WINDOW))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - WINDOW + 1, F.lit(1)))
    cut = words.where(F.size("words") > 0).select(
        "item", size.alias("n"), F.explode(F.transform(starts, lambda s: F.slice("words", s, size))).alias("words")
    )
    return cut.distinct()


def searched_words(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    max_item_windows: int = 2_000_000,
) -> DataFrame:
    """(row, key, n_words, place, n, items): the words ``place`` to ``place + n - 1`` of a row that are a window of ``items``.

    Besides its hits every row has entries without place; all have its number of words.
    """
    windows = item_windows(benchmark, item, item_text)
    counts = {r.n: r["count"] for r in windows.groupBy("n").count().collect()}
    if sum(counts.values()) > max_item_windows:
        raise ValueError(f"{sum(counts.values())} item windows; max_item_windows is {max_item_windows}")
    named = windows.groupBy("words").agg(F.collect_set("item").alias("items"), F.first("n").alias("n"))
    named = named.withColumn("hash", F.xxhash64("words"))
    places = F.sequence(F.lit(1), F.lit(WINDOW - BLOCK + 1))
    inside = F.transform(places, lambda at: F.xxhash64(F.slice("words", at, F.lit(BLOCK))))
    head = F.when(F.col("n") == WINDOW, inside).otherwise(F.array(F.xxhash64(F.slice("words", 1, 1))))
    own = docs.sparkSession.range(1).select(F.lit(OWN).cast("bigint").alias("piece"))
    heads = named.select(F.explode(head).alias("piece")).unionByName(own).distinct()

    cut = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), words_in(F.col(text)).alias("words"))
    size = F.size("words")
    whole = F.floor(size / BLOCK).cast("int")
    none = F.array().cast("array<bigint>")
    pieces = F.transform(
        F.sequence(F.lit(0), whole - 1), lambda i: F.xxhash64(F.slice("words", i * BLOCK + 1, F.lit(BLOCK)))
    )
    pieces = F.when(whole > 0, pieces).otherwise(none)
    shorter = sorted(n for n in counts if n < WINDOW)
    if shorter:
        pieces = F.concat(pieces, F.transform("words", lambda w: F.xxhash64(F.array(w))))
    own_piece = F.array(F.lit(OWN).cast("bigint"))
    # an outer explode: the filter that Spark infers for an inner one would cut every text a second time
    each = cut.select("row", "key", "words", F.posexplode_outer(F.concat(own_piece, pieces)).alias("at", "piece"))
    near = each.join(F.broadcast(heads), "piece").withColumn("at", F.col("at") - 1)

    begin = F.greatest((F.col("at") - 1) * BLOCK + 1, F.lit(0))
    end = F.least(F.col("at") * BLOCK, size - WINDOW)
    around = F.transform(F.sequence(begin, end), lambda s: _try(s, F.lit(WINDOW)))
    no_try = F.array().cast("array<struct<place:int,n:int,words:array<string>>>")
    tries = F.when((F.col("at") >= 0) & (F.col("at") < whole) & (begin <= end), around)
    if shorter:
        place = F.col("at") - whole
        starting = F.transform(F.array(*map(F.lit, shorter)), lambda n: _try(place, n))
        starting = F.filter(starting, lambda t: t["place"] + t["n"] <= size)
        tries = F.when(F.col("at") >= whole, starting).otherwise(tries)
    tried = near.select(
        "row", "key", size.cast("bigint").alias("n_words"), F.explode_outer(F.coalesce(tries, no_try)).alias("try")
    )
    same = (F.xxhash64("try.words") == F.col("hash")) & (F.col("try.words") == F.col("words"))
    found = tried.join(F.broadcast(named.select("hash", "words", "items")), same, "left")
    hit = F.col("items").isNotNull()
    return found.select(
        "row", "key", "n_words", F.when(hit, F.col("try.place")).alias("place"), F.when(hit, F.col("try.n")).alias("n"), "items"
    )


def _try(place: Column, n: Column) -> Column:
    return F.struct(place.cast("int").alias("place"), n.alias("n"), F.slice("words", place + 1, n).alias("words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, n_words, n_hit, items, contaminated) of every row; items are sorted as strings."""
    found = searched_words(docs, benchmark, key, text, **options)
    span = F.when(F.col("place").isNotNull(), F.struct("place", (F.col("place") + F.col("n")).alias("end")))
    rows = found.groupBy("row").agg(
        F.first("key").alias("key"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.col("items").cast("array<string>"))))).alias("items"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("hit"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "spans",
        start,
        lambda s, x: F.struct(
            (s.hit + F.greatest(x.end - F.greatest(x.place, s.end), F.lit(0))).alias("hit"),
            F.greatest(s.end, x.end).alias("end"),
        ),
        lambda s: s.hit,
    )
    return rows.select(F.col("key").alias(key), "n_words", covered.alias("n_hit"), "items", (F.size("spans") > 0).alias("contaminated"))


def without_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose ``key`` has no row with a hit, with all their columns."""
    hit = searched_words(docs, benchmark, key, text, **options).where("place is not null")
    keys = hit.select(F.col("key").alias("hit_key")).distinct().alias("hits")
    return docs.alias("docs").join(keys, F.col(f"docs.`{key}`").eqNullSafe(F.col("hits.hit_key")), "left_anti")
