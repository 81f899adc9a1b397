"""Benchmark decontamination: a broadcast hash set of benchmark n-grams against every token window of the documents.

Words are maximal runs of characters other than ASCII punctuation, space and control characters, with A-Z in
lower case. A benchmark window is ``window`` consecutive words of an item; an item with fewer words is one window.
A document word is hit if it lies inside any occurrence of a window.

Defined cases: a null or word-free text has no words, no hits and is clean; an item without words has no window; an
item without an id hits words but is neither counted nor listed; an item id that comes twice counts once; empty
tables give no hits; very long texts are split whole, in one task each; overlapping windows hit a word once; rows equal in
doc_id and text share their result; other columns pass through untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicemill.llm.common import keyed, same_document, without, written

WINDOW = 13
BROADCAST_BYTES = 48 << 20
HASH_BYTES = 64  # of one window's hash and size in a broadcast
MARKS = 1024     # values that mark documents; several, so that none is a hot key where hashes are shuffled
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words(text: Column) -> Column:
    """Words of a text; only A-Z are lowered, so words with other letters take the slower way."""
    def lowered(w):
        return F.when(F.length(w) == F.octet_length(w), F.lower(w)).otherwise(F.translate(w, UPPER, LOWER))
    return F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), BREAK + "+"), lambda w: w != ""), lowered)


def with_gram_hashes(df: DataFrame, sizes: list[int]) -> DataFrame:
    """Adds g1, g2, ... with the hashes of all n-grams of ``words``, each made of two shorter ones.

    Hashes of 1, 2, 4, 8 ... words are doubled; other sizes are sums of those. Each is a column of its own layer,
    so that no array is computed twice.
    """
    have = {1}
    df = df.withColumn("g1", F.transform("words", lambda w: F.xxhash64(w)))

    def add(df, a, b):
        if a + b in have:
            return df
        have.add(a + b)
        n = F.greatest(F.size("g1") - (a + b - 1), F.lit(0))
        return df.withColumn(f"g{a + b}", F.zip_with(F.slice(f"g{a}", F.lit(1), n), F.slice(f"g{b}", F.lit(a + 1), n), lambda x, y: F.xxhash64(x, y)))

    for size in sizes:
        got = 0
        for bit in reversed([1 << i for i in range(size.bit_length()) if size >> i & 1]):
            for i in range(bit.bit_length() - 1):
                df = add(df, 1 << i, 1 << i)
            df, got = (add(df, got, bit), got + bit) if got else (df, bit)
    return df


def benchmark_windows(benchmark: DataFrame, window: int) -> tuple[DataFrame, list[int]]:
    """Distinct windows as (hash, n, win, items), and the sizes that occur (at most ``window`` of them)."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("n", F.least(F.size("words"), F.lit(window)))
    sizes = sorted(r.n for r in items.select("n").distinct().collect())
    parts = []
    for n in sizes:
        own = with_gram_hashes(items.where(F.col("n") == n), [n])
        own = own.select("item_id", "n", "words", F.posexplode(f"g{n}").alias("at", "hash"))
        parts.append(own.select("item_id", "n", "hash", F.slice("words", F.col("at") + 1, F.lit(n)).alias("win")))
    if not parts:
        return None, []
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("hash", "n", "win").agg(F.collect_set("item_id").alias("items")), sizes


def sized(df: DataFrame, weight: int) -> DataFrame:
    return F.broadcast(df) if weight <= BROADCAST_BYTES else df


def met_hashes(docs: DataFrame, hashes: DataFrame, sizes: list[int]) -> DataFrame:
    """doc_id, th, n_words and met (start, n, hash of n-grams that some window has) of every document, stored.

    Every text is split once. A mark of its own, of one of ``MARKS`` values, stands behind the n-grams of a document and meets
    those among ``hashes``, with a size of 0, so that a document without hits has a row as well, with its number of words.
    """
    own = with_gram_hashes(keyed(docs).select("doc_id", "th", words(F.col("text")).alias("words")), sizes)
    mark = F.pmod("th", F.lit(MARKS))
    grams = own.select("doc_id", "th", F.size("words").alias("n_words"), F.posexplode(F.concat(*[F.col(f"g{n}") for n in sizes], F.array(mark))).alias("at", "hash"))
    # the arrays of all sizes stand behind each other: where the one of this window begins
    first, before = F.lit(None).cast("int"), F.lit(0)
    for n in sizes:
        first = F.when(F.col("n") == n, before).otherwise(first)
        before = before + F.greatest(F.col("n_words") - (n - 1), F.lit(0))
    start = F.col("at") - first
    met = grams.join(hashes, "hash")
    there = (F.col("n") > 0) & (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    met = met.where(there | (F.col("n") == 0) & (F.col("at") == before))
    return written(met.groupBy("doc_id", "th").agg(F.first("n_words").alias("n_words"), F.collect_set(F.when(there, F.struct(start.alias("start"), "n", "hash"))).alias("met")), "met")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame] | None:
    """doc_id, th and n_words of every document, and of those with hits doc_id, th, n_words, spans (sorted (start, end) in
    words) and items (ids). None without windows.

    N-grams meet the windows by hash alone, and only documents with such hits are read again to compare their words; a
    shuffled n-gram is five numbers, whatever the length of its text. Hashes, hits and windows are sized first and
    broadcast up to BROADCAST_BYTES, else shuffled. What is gathered per document is bounded by its own words and the items.
    """
    wins, sizes = benchmark_windows(benchmark, window)
    if not sizes:
        return None
    wins = written(wins, "windows")
    weight = F.sum(F.octet_length(F.concat_ws("  ", "win")) + 16 * F.size("items") + 64 + 8 * F.col("n"))
    weight, n_wins = wins.agg(weight, F.count("*")).first()
    marks = wins.sparkSession.range(MARKS).select(F.col("id").alias("hash"), F.lit(0).alias("n"))
    hashes = wins.select("hash", "n").distinct().unionByName(marks)
    every = met_hashes(docs, sized(hashes, HASH_BYTES * (n_wins + MARKS)), sizes)
    met = every.where(F.size("met") > 0)
    met = sized(met, met.agg(F.coalesce(F.sum(16 * F.size("met") + 64), F.lit(0))).first()[0])
    texts = keyed(docs)
    # texts are split behind the join
    found = texts.join(met, same_document(texts, met)).select(texts["doc_id"], texts["th"], "n_words", "text", "met").withColumn("words", words(F.col("text")))
    found = found.select("doc_id", "th", "n_words", "words", F.explode("met").alias("m"))
    found = found.select("doc_id", "th", "n_words", F.col("m.start").alias("start"), F.col("m.n").alias("n"), F.col("m.hash").alias("hash"),
                         F.slice("words", F.col("m.start") + 1, F.col("m.n")).alias("win"))
    found = found.join(sized(wins, weight), ["hash", "n", "win"])
    found = found.select("doc_id", "th", "n_words", F.struct("start", (F.col("start") + F.col("n")).alias("end")).alias("span"), "items")
    found = found.groupBy("doc_id", "th").agg(
        F.first("n_words").alias("n_words"), F.array_sort(F.collect_set("span")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    return every.select("doc_id", "th", "n_words"), found


def covered(spans: Column) -> Column:
    """Number of words inside sorted spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("words"))
    return F.aggregate(spans, zero, lambda a, s: F.struct(
        F.greatest(a["end"], s["end"]).alias("end"),
        (a["words"] + F.greatest(s["end"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("words")), lambda a: a["words"])


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (sorted texts), contaminated (a 20th of the words)."""
    own = keyed(docs).select("doc_id", "th")
    both = hits(docs, benchmark, window)
    if both is None:
        own = keyed(docs).select("doc_id", F.size(words(F.col("text"))).alias("n_words"))
        joined = own.withColumn("spans", F.lit(None).cast("array<struct<start:int,end:int>>")).withColumn("items", F.lit(None).cast("array<string>"))
    else:
        sizes, found = both
        found = found.select(F.col("doc_id").alias("hit_id"), F.col("th").alias("hit_th"), "spans", "items")
        known = sizes.join(found, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("th") == F.col("hit_th")), "left").drop("hit_id", "hit_th")
        joined = own.join(known, same_document(own, known)).select(own["doc_id"], "n_words", "spans", F.col("items").cast("array<string>").alias("items"))
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0)).cast("long")
    items = F.coalesce(F.array_sort("items"), F.array().cast("array<string>"))
    joined = joined.select("doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), items.alias("items"))
    return joined.withColumn("n_items", F.size("items").cast("long")).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated documents."""
    both = hits(docs, benchmark, window)
    if both is None:
        return docs
    return without(docs, both[1].where(20 * covered(F.col("spans")) >= F.col("n_words")))


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with hit words, and what separates them from the next word, cut from ``text``."""
    both = hits(docs, benchmark, window)
    if both is None:
        return docs
    found = both[1]
    d = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"], F.xxhash64(docs["text"]).alias("th"), docs["text"].alias("whole"))
    j = d.join(found, same_document(d, found), "left").select("row", "whole", "spans")
    pieces = F.regexp_extract_all("whole", F.lit(f"(?:[^{BREAK[1:-1]}]+){BREAK}*"), 0)
    lead = F.regexp_extract("whole", f"^{BREAK}*", 0)
    kept = F.filter(pieces, lambda p, i: ~F.exists("spans", lambda s: (i >= s["start"]) & (i < s["end"])))
    text = F.when(F.col("spans").isNull(), F.col("whole")).otherwise(F.concat(lead, F.array_join(kept, "")))
    return j.withColumn("cut", text).select(*[F.col("cut").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
