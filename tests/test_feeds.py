"""Feed matching against Python's own network arithmetic, without a broadcast of the feed."""

import ipaddress
import random

from pyspark.sql import functions as F

from auditlake.operators.feeds import match_feed
from auditlake.operators.lookup import BROADCAST_CONF

ODD = [None, "", "ec2.amazonaws.com", "::1", "256.1.1.1", "1.2.3", "01.2.3.4", "1.2.3.4\n"]


def longest(address, networks, texts):
    if not address:
        return None
    try:
        number = ipaddress.ip_address(address)
    except ValueError:
        return address if address in texts else None
    if number.version == 6:
        return address if address in texts else None
    found = [n for n in networks if number in n]
    return str(max(found, key=lambda n: n.prefixlen)) if found else None


def test_ranges_equal_network_arithmetic(spark):
    rng = random.Random(5)
    some = lambda: ".".join(str(rng.choice([0, 1, 10, 127, 128, 192, 255])) for _ in range(4))
    addresses = [some() for _ in range(400)] + ODD
    networks = [ipaddress.ip_network(f"{some()}/{rng.randint(3, 32)}", strict=False) for _ in range(60)]
    texts = ["ec2.amazonaws.com", "::1", "256.1.1.1", "10.0.0.0/33", "10.0.0.0/x", "1.2.3.4/5/6"]
    entries = [str(n) for n in networks] + texts + [None, "", str(networks[0]), "10.1.1.1"]
    networks.append(ipaddress.ip_network("10.1.1.1/32"))
    events = spark.createDataFrame(list(enumerate(addresses)), "event_id int, source_ip string").repartition(5)
    feed = spark.createDataFrame([(e,) for e in entries], "entry string")
    got = {r.event_id: r.feed_network for r in match_feed(events, feed, "entry").collect()}
    assert got == {i: longest(a, networks, texts) for i, a in enumerate(addresses)}
    assert sum(v is not None for v in got.values()) > 20


def test_whole_address_space_and_host_bits(spark):
    events = spark.createDataFrame([(1, "10.9.8.7"), (2, "200.1.1.1"), (3, None)], "event_id int, source_ip string")
    feed = spark.createDataFrame([("9.9.9.9/0",), ("10.9.8.99/24",)], "entry string")
    got = {r.event_id: r.feed_network for r in match_feed(events, feed, "entry").collect()}
    assert got == {1: "10.9.8.0/24", 2: "0.0.0.0/0", 3: None}


def test_empty_feed_and_empty_events(spark):
    events = spark.createDataFrame([(1, "10.9.8.7"), (2, None)], "event_id int, source_ip string")
    feed = spark.createDataFrame([("10.0.0.0/8",)], "entry string")
    assert {r.feed_network for r in match_feed(events, feed.limit(0), "entry").collect()} == {None}
    assert match_feed(events.limit(0), feed, "entry").collect() == []


def test_large_feed_is_not_broadcast(spark):
    events = spark.range(3000).select(F.col("id").alias("event_id"), F.concat_ws(".", F.lit("10.0"), F.col("id") % 9, F.col("id") % 251).alias("source_ip"))
    feed = spark.createDataFrame([("10.0.3.0/24",), ("10.0.3.5",)], "entry string")
    spark.conf.set(BROADCAST_CONF, "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = match_feed(events, feed, "entry")
        rows = out.where("feed_network IS NOT NULL").collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(BROADCAST_CONF)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert len(rows) == sum(1 for i in range(3000) if i % 9 == 3)
