"""Threat feeds of any size: addresses and address ranges matched without a broadcast of the feed.

A feed lists IPv4 addresses, IPv4 networks (`a.b.c.d/length`) and any other texts, such as host
names, IPv6 addresses or malformed entries, which match as they are. A range becomes the key
(length, leading bits), and an address has one such key for each length the feed holds (33 at
most), so a range match is an equality join. Only distinct addresses meet the feed, so an
address with a third of all events is one row there, and only the addresses that matched come
back to the events, by a size-checked join.

Defined cases: a null address and an empty text match nothing; a null or empty feed row is left out;
host bits of a network are ignored (`10.0.0.9/24` is `10.0.0.0/24`); repeated rows count once;
of several matches the longest network wins; an empty feed matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.operators.lookup import attach, broadcast_or_shuffle, materialize

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"^{_OCTET}(\.{_OCTET}){{3}}\z"      # `$` would also match before a last line feed
_LENGTH = r"^(3[0-2]|[12]?[0-9])\z"


def address_number(address: Column) -> Column:
    """IPv4 text as a number; null for any other text."""
    part = F.split(address, r"\.")
    number = sum((F.get(part, i).cast("bigint") * (256 ** (3 - i)) for i in range(4)), F.lit(0).cast("bigint"))
    return F.when(address.rlike(_IPV4), number)


def dotted(number: Column) -> Column:
    """A number as IPv4 text."""
    return F.concat_ws(".", *[F.shiftright(number, s).bitwiseAND(255) for s in (24, 16, 8, 0)])


def feed_keys(feed: DataFrame, entry: str) -> DataFrame:
    """(network, length, bits): `network` in its canonical form; bits and length null for texts
    that match as they are."""
    base, length = F.substring_index(entry, "/", 1), F.substring_index(entry, "/", -1)
    whole = ~F.col(entry).contains("/")
    known = feed.where(F.col(entry) != "").select(
        F.col(entry).alias("_text"), address_number(base).alias("_base"),
        F.when(whole, F.lit(32)).when(length.rlike(_LENGTH), length.try_cast("int")).alias("length"))
    ranged = F.col("_base").isNotNull() & F.col("length").isNotNull() & (F.size(F.split("_text", "/")) <= 2)
    bits = F.when(ranged, F.expr("shiftright(_base, 32 - length)"))
    network = F.when(ranged, F.concat(dotted(F.expr("shiftleft(shiftright(_base, 32 - length), 32 - length)")),
                                      F.lit("/"), F.col("length").cast("string")))
    return (known.select(F.coalesce(network, "_text").alias("network"), F.when(ranged, F.col("length")).alias("length"),
                         bits.alias("bits")).distinct())


def match_feed(events: DataFrame, feed: DataFrame, entry: str, address: str = "source_ip") -> DataFrame:
    """`events` with `feed_network`, the longest feed entry that holds the address (null: none)."""
    keys, known = materialize(feed_keys(feed, entry), "feed", n=F.count(F.lit(1)))
    rows = int(known["n"] or 0)
    lengths = sorted(r["length"] for r in keys.where("length IS NOT NULL").select("length").distinct().collect())
    met = (events.where(F.col(address) != "").select(F.col(address).alias("_address")).distinct()
           .withColumn("_number", address_number(F.col("_address"))))
    ranges = broadcast_or_shuffle(keys.where("length IS NOT NULL"), rows)
    texts = broadcast_or_shuffle(keys.where("length IS NULL").select("network"), rows)
    probes = (met.where("_number IS NOT NULL")
              .withColumn("length", F.explode(F.array(*map(F.lit, lengths)).cast("array<int>")))
              .withColumn("bits", F.expr("shiftright(_number, 32 - length)")))
    by_range = probes.join(ranges, ["length", "bits"]).groupBy("_address").agg(F.max_by("network", "length").alias("feed_network"))
    by_text = met.where("_number IS NULL").join(texts, F.col("_address") == F.col("network")).select(
        "_address", F.col("network").alias("feed_network"))
    hits, found = materialize(by_range.unionByName(by_text).withColumnRenamed("_address", address),
                              "feed-hits", n=F.count(F.lit(1)))
    return attach(events, hits, int(found["n"] or 0), [address])
