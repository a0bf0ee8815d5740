"""Near duplicates among embeddings: links by cosine, groups of links, one row kept of each.

Only vectors of equal, non-null label and equal length are compared. Equal vectors of a label
are one point with a count, so copies never make pairs. Spherical k-means
(fitted on a bounded sample) gives every point a home cell; a point near the border
is also copied to the cells of lower number in which a partner may be at home.
A cell's points are cut into blocks of about `block` by a hash, every two
blocks of a cell meet in one task, and a task compares them by matrix products in
double precision, a strip at a time. It returns no pairs: only the number of
links of each point and a spanning forest of the block's links. The forests are written and
joined up by connected components.

Which cells. A partner within the angle d of a point v of home c can be at home in c' only
if v lies within sin d of the plane between both centres, that is if
(v.c - v.c') / |c - c'| <= sin d. With `spread=None` this bound is used as it is and no link can
be lost, at the price of many copies in many dimensions. By default it is
narrowed to `spread` / sqrt(dimensions) of itself (never widened): a partner differs in some
direction, and only that direction's part across the plane, which for `spread`
= 4 is 4 deviations of a random direction, can carry it over. In up to 16 dimensions the
default is the full bound.

The number of cells grows with the root of the number of points, up to `most_cells`; cells grow
beyond that, and their blocks meet one task at a time.

Defined cases: rows without a label, or whose vector is null, empty, zero, or holds null or
non-finite entries, link with nothing and are their own group. Rows that share an id are
vectors of their own; a null id counts as larger than any other, and a row whose group has null
ids only is kept. Columns beyond id, vector and label are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm.common import pieces, read
from auditlake.llm.components import components
from auditlake.operators.lookup import broadcast_or_shuffle, materialize
from auditlake.session import prepare

STRIP = 512     # rows of a matrix product


@dataclass(frozen=True)
class Settings:
    least: float = 0.93
    spread: float | None = 4.0
    sample: int = 16_384         # vectors that the centres are fitted on, at most
    most_cells: int = 4_096
    rounds: int = 10
    block: int = 2_048


def unit(entries: list | None) -> np.ndarray | None:
    """The vector scaled to length 1 in double precision, or None where it links with nothing."""
    if not entries or None in entries:
        return None
    v = np.array(entries, np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    v = v / np.abs(v).max()                 # so that squares neither overflow nor vanish
    return v / math.sqrt(float(v @ v)) + 0.0


def points(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec, label, dims, digest, unit) of every row; digest and unit are null where the row links with nothing. The
    digest is the SHA-256 of the vector as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for small in pieces(batch):
                dims, digests, units = [], [], []
                for entries, label in zip(small.column("entries").to_pylist(), small.column("label").to_pylist()):
                    u = None if label is None else unit(entries)
                    dims.append(0 if u is None else len(u))
                    units.append(None if u is None else u.tobytes())
                    digests.append(None if u is None else hashlib.sha256((np.array(entries, np.float64) + 0.0).tobytes()).digest())
                yield pa.RecordBatch.from_arrays(
                    [small.column("vec"), small.column("label"), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()),
                     pa.array(units, pa.binary())], names=["vec", "label", "dims", "digest", "unit"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("entries"))
    return rows.mapInArrow(run, "vec long, label string, dims int, digest binary, unit binary")


def spherical_means(units: np.ndarray, cells: int, rounds: int) -> np.ndarray:
    """Centres of length 1: each round gives a vector to the centre of largest cosine and moves centres to
    the direction of their vectors' sum. An empty cell starts again at the vector farthest
    from its centre."""
    centres = units[np.linspace(0, len(units) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        home, best = np.empty(len(units), int), np.empty(len(units))
        for at in range(0, len(units), STRIP):
            near = units[at:at + STRIP] @ centres.T
            home[at:at + STRIP] = near.argmax(1)
            best[at:at + STRIP] = near.max(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, units)
        sizes = np.linalg.norm(sums, axis=1)
        far = iter(np.argsort(best))
        for k in np.flatnonzero(sizes < 1e-9):
            sums[k] = units[next(far)]
            sizes[k] = 1.0
        centres = sums / sizes[:, None]
    return centres


def fit_cells(reps: DataFrame, n: int, s: Settings) -> dict[int, np.ndarray]:
    """Centres by vector length, fitted on at most `sample` points. The points of least
    hash are taken; a threshold leaves about 1.2 * `sample` of them before they are ranked."""
    key = F.xxhash64("digest", F.lit(1))
    rate = min(1.0, 1.2 * s.sample / max(n, 1))
    drawn = reps.where(F.pmod(key, F.lit(1 << 40)) <= int(rate * (1 << 40))).orderBy(key, "rid").limit(s.sample)
    by_dims: dict[int, list] = {}
    for r in drawn.select("dims", "unit").collect():
        by_dims.setdefault(r["dims"], []).append(np.frombuffer(r["unit"]))
    cells = max(1, min(s.most_cells, round(math.sqrt(n) / 8)))
    return {d: spherical_means(np.stack(u), min(cells, max(1, len(u) // 4)), s.rounds) for d, u in by_dims.items()}


def margins(centres: np.ndarray, s: Settings) -> np.ndarray:
    """For each two centres, how much less than its home cosine a point's cosine with the other may be for a
    copy to go there."""
    narrow = 1.0 if s.spread is None else min(1.0, s.spread / math.sqrt(centres.shape[1]))
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    return apart * math.sqrt(max(0.0, 1 - s.least * abs(s.least))) * narrow + 1e-9


def placed(reps: DataFrame, centres: dict[int, np.ndarray], s: Settings) -> DataFrame:
    """(label, dims, cell, home, rid, copies, unit): each point at home, and as a copy in the cells
    of lower number that it may have a partner in."""
    shared = reps.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = {d: margins(c, s) for d, c in shared.value.items()}
        for batch in batches:
            for small in pieces(batch):
                dims = np.array(small.column("dims").to_pylist())
                rows, cells, homes = [], [], []
                for d in np.unique(dims):
                    own = np.flatnonzero(dims == d)
                    centre = shared.value.get(int(d))
                    if centre is None:                       # a length that the sample lacks is one cell
                        here, there, home = own, np.zeros(len(own), int), np.ones(len(own), bool)
                    else:
                        units = small.column("unit").take(pa.array(own)).to_pylist()
                        near = np.frombuffer(b"".join(units)).reshape(len(own), d) @ centre.T
                        at = near.argmax(1)
                        gap = near[np.arange(len(own)), at][:, None] - near
                        may = (gap <= limits[int(d)][at]) & (np.arange(len(centre)) <= at[:, None])
                        may[np.arange(len(own)), at] = True
                        k, there = np.nonzero(may)
                        here, home = own[k], there == at[k]
                    rows.append(here), cells.append(there), homes.append(home)
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [*(small.column(c).take(take) for c in ("label", "dims")), pa.array(np.concatenate(cells), pa.int32()),
                     pa.array(np.concatenate(homes)), *(small.column(c).take(take) for c in ("rid", "copies", "unit"))],
                    names=["label", "dims", "cell", "home", "rid", "copies", "unit"])

    return reps.select("label", "dims", "rid", "copies", "unit").mapInArrow(
        run, "label string, dims int, cell int, home boolean, rid long, copies long, unit binary")


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric link matrix: each node is opened once."""
    left = linked.any(1)
    edges = []
    for root in np.flatnonzero(left).tolist():
        if not left[root]:
            continue
        left[root] = False
        front = np.array([root])
        while len(front):
            reached = np.flatnonzero(linked[front].any(0) & left)
            left[reached] = False
            edges += [(root, k) for k in reached.tolist()]
            front = reached
    return edges


def meet(units: np.ndarray, home: np.ndarray, side: np.ndarray, least: float) -> np.ndarray:
    """Which points are linked: pairs of which at least one is at home here, across both sides of a
    task (all pairs where there is one side only)."""
    n = len(units)
    linked = np.zeros((n, n), bool)
    one = bool(side.all() or not side.any())
    for at in range(0, n, STRIP):
        strip = slice(at, at + STRIP)
        hit = units[strip] @ units.T >= least
        hit &= home[strip, None] | home
        if not one:
            hit &= side[strip, None] != side
        linked[strip] = hit
    linked |= linked.T             # both halves of a product may round apart
    np.fill_diagonal(linked, False)
    return linked


def block_links(items: DataFrame, s: Settings) -> DataFrame:
    """Per task: (a, null, n) the links of point a, counted with copies, and (a, b, null) the edges of a
    spanning forest."""
    key = ["label", "dims", "cell"]
    sizes = items.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > s.block).withColumn(
        "blocks", F.ceil(F.col("size") / s.block).cast("int")).drop("size")
    sizes, seen = materialize(sizes, "near-sizes", n=F.count(F.lit(1)))
    n_blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("rid"), n_blocks.cast("long")).cast("int")
    cut = (items.join(broadcast_or_shuffle(sizes, int(seen["n"] or 0)), key, "left").withColumn("own", own)
           .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
           .select(*key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                   (F.col("own") <= F.col("other")).alias("side"), "home", "rid", "copies", "unit"))
    least = s.least

    def run(table: pa.Table) -> pa.Table:
        rid = table.column("rid").to_numpy()
        order = np.argsort(rid)
        rid, copies = rid[order], table.column("copies").to_numpy()[order]
        home, side = (np.array(table.column(c).to_pylist())[order] for c in ("home", "side"))
        units = np.frombuffer(b"".join(table.column("unit").to_pylist())).reshape(len(rid), -1)[order]
        linked = meet(units, home, side, least) if home.any() else np.zeros((len(rid), len(rid)), bool)
        some = np.flatnonzero(linked.any(1))
        n = linked[some].astype(np.int64) @ copies
        edges = forest(linked)
        a = np.concatenate([rid[some], rid[[x for x, _ in edges]]]) if len(some) else np.zeros(0, np.int64)
        b = [None] * len(some) + [int(rid[y]) for _, y in edges]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                         "n": pa.array([*n.tolist(), *[None] * len(edges)], pa.int64())})

    return cut.groupBy(*key, "i", "j").applyInArrow(run, "a long, b long, n long")


def near_groups(vectors: DataFrame, s: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding",
                label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    prepare(vectors.sparkSession)
    rows = points(vectors, id_col, vector_col, label_col)
    reps, seen = materialize(
        rows.where(F.col("digest").isNotNull()).groupBy("label", "dims", "digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec").alias("first_vec"), F.min("unit").alias("unit"))
        .withColumn("rid", F.monotonically_increasing_id()), "near-points", n=F.count(F.lit(1)))
    n = int(seen["n"] or 0)
    items, _ = materialize(placed(reps, fit_cells(reps, n, s), s), "near-cells")
    found, _ = materialize(block_links(items, s), "near-links")
    links = found.where("b is null").groupBy(F.col("a").alias("rid")).agg(F.sum("n").alias("others"))
    groups, _ = materialize(components(found.where("b is not null").select("a", "b")), "near-components")
    least = (groups.join(reps.select(F.col("rid").alias("node"), "first_vec"), "node")
             .groupBy("component").agg(F.min("first_vec").alias("least_vec")))
    member = groups.join(least, "component").select(F.col("node").alias("rid"), "least_vec")
    judged, _ = materialize(
        reps.select("rid", "label", "dims", "digest", "copies", "first_vec").join(links, "rid", "left").join(member, "rid", "left")
        .select("label", "digest", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("least_vec", "first_vec").alias("component_id")), "near-judged")
    out = rows.select("vec", "label", "digest").join(broadcast_or_shuffle(judged, n), ["label", "digest"], "left")
    component = F.when(F.col("digest").isNull(), F.col("vec")).otherwise(F.col("component_id"))
    return out.select(F.col("vec").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec").eqNullSafe(component).alias("kept"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read(spark, sf_dir, "embeddings"))
