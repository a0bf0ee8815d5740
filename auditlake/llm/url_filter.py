"""URL filter: listed rules first, then word segmentation of hosts and naive Bayes.

A rule is `host/path`; it fits its host and all subdomains where the url's path
starts with the rule's, and the longest fitting rule decides. For the other urls:

* Host parts (between `.`, `-` and `_`) are split into words by unigram Viterbi. Word
  counts come from the text of all pages; the counts of a part's substrings
  arrive by one join of distinct substrings with the counts.
* Multinomial naive Bayes over the host words and path tokens, trained on all urls
  that a rule judged, gives log odds of block; a positive sum blocks.

Hosts and paths are scored once per distinct string, from pre-aggregated
counts, and joined back, so a host with a third of all rows costs what any other
does. Log odds are whole millionths, so sums don't depend on their order.

Defined cases: a null url, or one without `://`, has an empty host and path, which no
rule fits and the class odds judge; null html has no words; repeated
and null ids keep one result per input row; without urls judged both ways the
method allows; a sum of 0 allows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm.common import arrow_map, read
from auditlake.operators.lookup import materialize
from auditlake.session import prepare

# the rules of the contract (fixed values)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
LONGEST_WORD = 24
UNSEEN = 10.0        # an unseen word of n letters counts as UNSEEN / 10^n
MILLION = 1_000_000


def split_url(url: str) -> tuple[Column, Column]:
    """(host, path) expressions of a url column."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.col(url).substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        of, slash, start = text.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def parts(column: Column) -> Column:
    return F.filter(F.split(column, r"[._\-]+"), lambda p: p != "")


def path_tokens(column: Column) -> Column:
    """Lower-case runs of letters and digits; a run of digits alone is `0`."""
    runs = F.filter(F.split(F.lower(column), r"[^\p{L}\p{N}]+"), lambda p: p != "")
    return F.transform(runs, lambda p: F.concat(F.lit("/"), F.when(p.rlike(r"\A\p{N}+\z"), F.lit("0")).otherwise(p)))


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(word, count) over the text of all pages, tags left out, lower-cased."""
    text = F.lower(F.regexp_replace(F.col(html_col), r"<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, r"[^\p{L}\p{N}]+")).alias("word")).where("word != ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def segment(part: str, found: dict[tuple[int, int], int], total: float) -> list[str]:
    """Words of the likeliest split; a tie goes to the longer last word. `found` has
    the count of the substring from start to stop, where it is a word."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for stop in range(1, len(part) + 1):
        options = []
        for start in range(max(0, stop - LONGEST_WORD), stop):
            n = found.get((start, stop))
            cost = math.log(total / n) if n else math.log(total / UNSEEN) + (stop - start) * math.log(10)
            options.append((best[start][0] + cost, start))
        best.append(min(options))
    out, stop = [], len(part)
    while stop:
        out.append(part[best[stop][1]:stop])
        stop = best[stop][1]
    return out[::-1]


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words) of distinct hosts."""
    split = hosts.select("host", F.posexplode(parts(F.col("host"))).alias("place", "part"))
    distinct = split.select("part").distinct()
    spans = distinct.select("part", F.length("part").alias("n"), F.explode(F.sequence(F.lit(1), F.length("part"))).alias("start"))
    spans = spans.select("part", "start", F.explode(F.sequence("start", F.least(F.col("start") + LONGEST_WORD - 1, F.col("n")))).alias("stop"))
    spans = spans.withColumn("word", F.col("part").substr(F.col("start"), F.col("stop") - F.col("start") + 1))
    total = float(counts.agg(F.sum("count")).head()[0] or 0) + UNSEEN
    known = (spans.join(counts, "word").groupBy("part")
             .agg(F.collect_list(F.struct((F.col("start") - 1).alias("a"), F.col("stop").alias("b"), "count")).alias("found")))

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        names = batch.column("part").to_pylist()
        words = [segment(p, {(x["a"], x["b"]): x["count"] for x in f or ()}, total)
                 for p, f in zip(names, batch.column("found").to_pylist())]
        yield {"part": names, "words": words}

    cut = arrow_map(distinct.join(known, "part", "left"), rows, "part string, words array<string>")
    per_host = (split.join(cut, "part").groupBy("host")
                .agg(F.sort_array(F.collect_list(F.struct("place", "words"))).alias("all")))
    return per_host.select("host", F.flatten(F.transform("all", lambda x: x["words"])).alias("words"))


def log_odds(tokens: DataFrame) -> DataFrame:
    """(token, odds) in millionths from (token, blocked, allowed) rows, Laplace-smoothed."""
    summed, _ = materialize(tokens.groupBy("token").agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed")), "tokens")
    whole = summed.agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"), F.count(F.lit(1)).alias("v")).head()
    b, a = float((whole["b"] or 0) + whole["v"]), float((whole["a"] or 0) + whole["v"])
    odds = F.log((F.col("blocked") + 1) / F.lit(b)) - F.log((F.col("allowed") + 1) / F.lit(a))
    return summed.select("token", F.round(odds * MILLION).cast("long").alias("odds"))


def url_filter(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, host, path, rule, verdict) of every row."""
    prepare(pages.sparkSession)
    host, path = split_url(url_col)
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    urls = urls.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    tally = [F.count_if(F.col("by_rule") == "block").alias("blocked"), F.count_if(F.col("by_rule") == "allow").alias("allowed")]
    hosts, seen = materialize(urls.groupBy("host").agg(*tally), "hosts", blocked=F.sum("blocked"), allowed=F.sum("allowed"))
    paths, _ = materialize(urls.groupBy("path").agg(*tally), "paths")
    counts, _ = materialize(word_counts(pages, html_col), "words")
    worded, _ = materialize(hosts.join(host_words(hosts, counts), "host", "left"), "host-words")
    by_host = worded.select("host", "blocked", "allowed", F.explode("words").alias("token"))
    by_path = paths.select("path", "blocked", "allowed", F.explode(path_tokens(F.col("path"))).alias("token"))
    odds = log_odds(by_host.drop("host").unionByName(by_path.drop("path")))
    both = bool(seen["blocked"]) and bool(seen["allowed"])
    prior = round(MILLION * math.log(seen["blocked"] / seen["allowed"])) if both else 0
    host_odds, _ = materialize(by_host.join(odds, "token").groupBy("host").agg(F.sum("odds").alias("host_odds")), "host-odds")
    path_odds, _ = materialize(by_path.join(odds, "token").groupBy("path").agg(F.sum("odds").alias("path_odds")), "path-odds")
    judged = urls.join(host_odds, "host", "left").join(path_odds, "path", "left")
    score = F.coalesce("host_odds", F.lit(0)) + F.coalesce("path_odds", F.lit(0)) + F.lit(prior)
    by_method = F.when((score > 0) & F.lit(both), "block").otherwise("allow")
    return judged.select(id_col, "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(read(spark, sf_dir, "pages"))
