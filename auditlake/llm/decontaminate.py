"""Benchmark decontamination: documents that hold a near copy of a benchmark item.

A document is matched with an item of n words when one of its windows of n words (the
whole document, if it has fewer) has a weighted five-word-shingle similarity (multiset
Jaccard, weights are multiplicities) of at least `percent` hundredths with it. DataFrame
functions only:

1. Document shingles meet item shingles in an equi-join. An item of m and a window of w
   shingles reach similarity t only with c >= t(m + w) / (1 + t) shared shingles, so a
   document needs that many places that hold a shingle of the item, and a window
   that reaches t holds that many. Windows that hold fewer such places are left out (one
   pass over the sorted places of a document and item); none that could match is.
2. The remaining windows and all items get 64-bit SimHash fingerprints.
3. Multi-index Hamming search among items of the size that the window was cut for: `radius` + 1
   blocks, so fingerprints within `radius` agree in at least one block; an equi-join on
   (size, block number, block) finds them all, the distance is then checked.
   Similarity 0.8 means a cosine of 8/9 and a distance of 9.7 +- 2.9 bits: the
   default radius of 22 is over four standard deviations above that (over three, at
   12 +- 3.1 bits, for a document with four of an item's five shingles).
4. Candidates are verified by the exact similarity of their shingle texts.

Words are runs without ASCII white space, lower-cased as Unicode has it. Items with fewer than five words
are one shingle of all their words. Defined cases: null or empty items and
texts match nothing, nor do documents without a shingle of the item's size; items that repeat an id
count under it together (best similarity); null item ids are left out; an empty
benchmark or table gives no rows. Repeated or null document ids as in
`common.run_keyed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm.common import ID, TEXT, of_row, read, run_keyed
from auditlake.operators.lookup import fits_broadcast, materialize

SHINGLE = 5
PERCENT = 80
RADIUS = 22
BITS = 64
BLANK = " \t\n\x0b\x0c\r"


def words(text: str) -> Column:
    trimmed = F.lower(F.btrim(F.col(text), F.lit(BLANK)))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+"))


def placed_shingles(df: DataFrame, keep: list[str], size: int) -> DataFrame:
    """`keep`, `pos` (from 0) and `h` of every shingle of `size` words of column w."""
    shifted = [F.slice("w", k + 1, F.size("w")).alias(f"w{k}") for k in range(size)]
    rows = df.where(F.size("w") >= size).select(*keep, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "z"))
    rows = rows.where(F.col(f"z.w{size - 1}").isNotNull())
    return rows.select(*keep, "pos", F.xxhash64(*[F.col(f"z.w{k}") for k in range(size)]).alias("h"))


def shingle_texts(array: Column, size: Column) -> Column:
    """Shingles of an array of words as texts (words hold no blanks, so the text is exact)."""
    return F.transform(F.sequence(F.lit(1), F.size(array) - size + 1), lambda i: F.array_join(F.slice(array, i, size), " "))


def simhash(hashes: Column) -> Column:
    """64-bit fingerprint: bit b is set when most shingles' hashes set it."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def votes(b: Column) -> Column:
        return F.aggregate(hashes, none, lambda acc, h: acc + F.call_function("shiftrightunsigned", h, b).bitwiseAND(one) * 2 - 1)

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), none, lambda out, b: out.bitwiseOR(
        F.when(votes(b) > 0, F.call_function("shiftleft", one, b)).otherwise(none)))


def blocks(fingerprint: str, radius: int) -> Column:
    """(block number, block) of radius + 1 disjoint runs of bits."""
    count = radius + 1
    edges = [k * BITS // count for k in range(count + 1)]
    return F.array(*[F.struct(F.lit(k).alias("k"), F.shiftrightunsigned(F.col(fingerprint), lo).bitwiseAND(
        F.lit((1 << hi - lo) - 1).cast("long")).alias("v")) for k, (lo, hi) in enumerate(zip(edges, edges[1:]))])


def shared(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two arrays."""
    def least(x: Column) -> Column:
        return F.least(F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x)))
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda acc, x: acc + least(x))


def matches(docs: DataFrame, items: DataFrame, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """(rid, item_id, similarity, start) of (rid, body) rows and (item_id, text) items."""
    worded = items.where(F.col("item_id").isNotNull()).select("item_id", words("text").alias("w")).where(F.col("w").isNotNull())
    sized = (worded.distinct().withColumn("n", F.size("w")).withColumn("k", F.least(F.col("n"), F.lit(SHINGLE)))
             .withColumn("item", F.monotonically_increasing_id()).withColumn("m", F.col("n") - F.col("k") + 1))
    bench, seen = materialize(sized, "benchmark", rows=F.count(F.lit(1)), sizes=F.collect_set("k"), shingles=F.sum("m"))
    if not seen["rows"]:
        return docs.select(ID, F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("similarity"), F.lit(0).alias("start")).limit(0)
    texts = docs.select(ID, words(TEXT).alias("w")).withColumn("long", F.size("w"))
    hits = None
    for k in sorted(seen["sizes"]):
        keys = placed_shingles(bench.where(F.col("k") == k), ["item"], k).select("item", "h").distinct()
        if fits_broadcast(docs.sparkSession, keys.schema, seen["shingles"]):
            keys = F.broadcast(keys)
        found = placed_shingles(texts, [ID, "long"], k).join(keys, "h").select(ID, "long", "item", "pos")
        hits = found if hits is None else hits.union(found)
    facts = bench.select("item", "n", F.col("m").alias("item_m"), "k")
    per_pair = hits.groupBy(ID, "item").agg(F.sort_array(F.collect_list("pos")).alias("places"), F.max("long").alias("long")).join(facts, "item")
    # a window has n words and m shingles; a shorter document is its own window
    per_pair = per_pair.withColumn("m", F.least("n", "long") - F.col("k") + 1)
    # c * (100 + percent) >= percent * (item_m + m)
    per_pair = per_pair.withColumn("need", F.ceil(percent * (F.col("item_m") + F.col("m")) / F.lit(100 + percent) - F.lit(1e-9)).cast("int"))
    enough = per_pair.where(F.size("places") >= F.col("need"))
    # a window from s holds `need` places when, for some i, it starts at or before place i and ends after place
    # i + need - 1; starts up to place i - 1 belong to an earlier i, so no start comes twice
    last = F.col("long") - F.least("n", "long")
    runs = F.transform(F.slice("places", F.lit(1), F.size("places") - F.col("need") + 1), lambda p, i: F.struct(
        F.greatest(F.element_at("places", i + F.col("need")) - F.col("m") + 1,
                   F.when(i > 0, F.get("places", i - 1) + 1).otherwise(0), F.lit(0)).alias("lo"),
        F.least(p, last).alias("hi")))
    starts = enough.select(ID, "n", "m", F.explode(F.filter(runs, lambda r: r["lo"] <= r["hi"])).alias("r"))
    windows = starts.select(ID, "n", "m", F.explode(F.sequence("r.lo", "r.hi")).alias("s")).distinct()
    wanted, many = materialize(windows.groupBy(ID).agg(F.collect_list(F.struct("n", "m", "s")).alias("wanted")), "windows", rows=F.count(F.lit(1)))
    if not many["rows"]:
        return docs.select(ID, F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("similarity"), F.lit(0).alias("start")).limit(0)
    held = texts.join(wanted, ID).select(ID, "w", F.explode("wanted").alias("x"))
    held = held.select(ID, F.col("x.n").alias("n"), F.col("x.m").alias("m"), F.col("x.s").alias("s"),
                       F.slice("w", F.col("x.s") + 1, F.col("x.n")).alias("w"))
    # of equal windows of a document the first stands for all
    held = fingerprinted(held.groupBy(ID, "n", "m", "w").agg(F.min("s").alias("s")))
    window, _ = materialize(held, "fingerprints")
    near = window.withColumn("b", F.explode(blocks("fp", radius))).select(ID, "s", "n", "fp", "b")
    listed, _ = materialize(fingerprinted(bench.select("item", "item_id", "n", "m", "w")), "item-fingerprints")
    index = listed.select("item", "n", F.col("fp").alias("item_fp"), F.explode(blocks("fp", radius)).alias("b"))
    close = near.join(index, ["n", "b"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    pairs = close.select(ID, "s", "n", "item").distinct()
    both = (pairs.join(window.select(ID, "s", "n", "w", "m"), [ID, "s", "n"])
            .join(listed.select("item", "item_id", F.col("m").alias("item_m"), F.col("w").alias("item_w")), "item"))
    size = F.least(F.col("n"), F.lit(SHINGLE))
    both = both.withColumns({"a": shingle_texts(F.col("w"), size), "b": shingle_texts(F.col("item_w"), size)})
    both = both.withColumn("c", shared(F.col("a"), F.col("b")))
    total = F.col("item_m") + F.col("m")
    good = both.where(F.col("c") * (100 + percent) >= percent * total)
    best = F.max(F.struct((F.col("c") / (total - F.col("c"))).alias("similarity"), (-F.col("s")).alias("back")))
    return good.groupBy(ID, "item_id").agg(best.alias("best")).select(
        ID, "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("start"))


def fingerprinted(df: DataFrame) -> DataFrame:
    """`df` with `fp`, the fingerprint of the m shingles of its words `w` (for an item of n words)."""
    df = df.withColumn("k", F.least(F.col("n"), F.lit(SHINGLE)))
    hashes = F.transform(F.sequence(F.lit(1), F.col("m")), lambda i: F.xxhash64(F.slice("w", i, F.col("k"))))
    return df.withColumn("hs", hashes).withColumn("fp", simhash(F.col("hs"))).drop("hs", "k")


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = PERCENT, radius: int = RADIUS,
                  id_col: str = "doc_id", text_col: str = "text", digest: str | None = None) -> DataFrame:
    """(id, item_id, similarity, start): the items that a document holds, with the
    best similarity and the first word of the first such window."""
    named = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return run_keyed(docs, lambda rows: matches(rows, named, percent, radius), id_col, text_col, digest)


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` without the documents that hold an item."""
    found = decontaminate(docs, items, digest="text_of")
    bad, _ = materialize(found.select(F.col("doc_id").alias("bad_id"), "text_of").distinct(), "contaminated")
    return docs.join(bad, of_row(docs, bad, "doc_id", "bad_id", "text_of"), "left_anti")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
