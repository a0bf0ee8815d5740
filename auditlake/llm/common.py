"""Helpers shared by the training-data operators of this subpackage."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.operators.lookup import materialize
from auditlake.session import prepare

# the word rule of the contracts: runs of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

ID, TEXT = "rid", "body"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, body) with the caller's other columns left behind, so no name can
    clash. `rid` is the caller's id; see `run_keyed` for null or repeated ids."""
    return docs.select(F.col(id_col).cast("long").alias(ID), F.col(text_col).alias(TEXT))


def odd_ids(docs: DataFrame, id_col: str) -> bool:
    """Whether some id is null or repeated (one aggregate over the id column)."""
    counts = docs.groupBy(F.col(id_col).alias(ID)).agg(F.count(F.lit(1)).alias("n"))
    return bool(counts.where((F.col("n") > 1) | F.col(ID).isNull()).limit(1).count())


def run_keyed(docs: DataFrame, work: Callable[[DataFrame], DataFrame], id_col: str = "doc_id",
              text_col: str = "text", digest: str | None = None) -> DataFrame:
    """Apply `work`, which needs one row per non-null id, to (rid, body) rows and
    return its columns with `id_col` in place of `rid`, one row per input row.

    The usual table (ids unique and not null, checked by one aggregate over the
    id column) goes straight through. Otherwise rows that agree in id and text
    are one document, rows that share only the id are separate ones, ordered by
    id (null first), then text; such documents get order-preserving new ids in
    a written table, and every input row takes the result of its document.

    With `digest`, a column of that name tells such rows of one id apart: the
    SHA-256 of the text (null where ids are unique), see `of_row`.
    """
    prepare(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    if not odd_ids(docs, id_col):
        made = work(rows).withColumnRenamed(ID, id_col)
        return made.withColumn(digest, F.lit(None).cast("string")) if digest else made
    ordered = (rows.dropDuplicates([ID, TEXT]).repartitionByRange(F.col(ID).asc_nulls_first(), F.col(TEXT).asc_nulls_first())
               .sortWithinPartitions(F.col(ID).asc_nulls_first(), F.col(TEXT).asc_nulls_first())
               .withColumn("new_id", F.monotonically_increasing_id()))
    named, _ = materialize(ordered, "llm-ids")
    made = work(named.select(F.col("new_id").alias(ID), TEXT))
    if "component_id" in made.columns:
        back = named.select(F.col("new_id").alias("component_id"), F.col(ID).alias("old_component"))
        made = made.join(back, "component_id", "left").drop("component_id").withColumnRenamed(
            "old_component", "component_id")
    sha = F.sha2(F.col(TEXT), 256)
    names = named.select(F.col("new_id").alias("new_id"), F.col(ID).alias("old_id"), sha.alias("old_sha"))
    made = made.withColumnRenamed(ID, "new_id").join(names, "new_id").drop("new_id")
    rows = rows.select(F.col(ID).alias("row_id"), sha.alias("row_sha"))
    out = rows.join(made, F.col("row_id").eqNullSafe(F.col("old_id")) & F.col("row_sha").eqNullSafe(F.col("old_sha")))
    if digest:
        out = out.withColumn(digest, F.coalesce("row_sha", F.lit("null")))
    return out.drop("old_id", "old_sha", "row_sha").withColumnRenamed("row_id", id_col)


def of_row(docs: DataFrame, made: DataFrame, id_col: str, made_id: str, digest: str, text_col: str = "text"):
    """Join condition between rows and results of `run_keyed(..., digest=)`."""
    own = F.coalesce(F.sha2(docs[text_col], 256), F.lit("null"))
    return docs[id_col].eqNullSafe(made[made_id]) & (made[digest].isNull() | (made[digest] == own))


def texts_of(batch: pa.RecordBatch, column: str = TEXT) -> list[bytes]:
    """UTF-8 bytes of a string column of an Arrow batch (null: empty)."""
    return [b"" if v is None else v for v in batch.column(column).cast(pa.binary()).to_pylist()]


_HELD: dict = {}


def held(name: str, make: Callable):
    """What this Python worker keeps under a name from task to task; one thing is kept at a time."""
    if name not in _HELD:
        release()
        _HELD[name] = make()
    return _HELD[name]


def release() -> None:
    """Let go of what a worker keeps: it serves the tasks of all operators, one of which needs it."""
    if _HELD:
        _HELD.clear()
        gc.collect()            # a memo and its owner name each other
        pa.default_memory_pool().release_unused()


def arrow_map(df: DataFrame, rows: Callable[[pa.RecordBatch], Iterator[dict]], schema: str | T.StructType,
              keeps: bool = False) -> DataFrame:
    """`mapInArrow` over batches: `rows` yields dicts of column arrays. `keeps`: it uses what the
    worker `held` for it; other tasks release that first."""
    from pyspark.sql.pandas.types import to_arrow_schema
    struct = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            release()
        for batch in batches:
            for small in pieces(batch):
                for out in rows(small):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) if not isinstance(out[f.name], pa.Array) else out[f.name].cast(f.type)
                         for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


def pieces(batch: pa.RecordBatch, max_rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Bounded slices of a batch, so that per-batch arrays stay small."""
    for at in range(0, batch.num_rows, max_rows):
        yield batch.slice(at, max_rows)


def id_remainder(id_col: str, parts: int):
    """crc32 of the id's decimal text, modulo `parts` (null id: null)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))


def sample_texts(rows: DataFrame, label: DataFrame, per_class: int, least: int, most: int, cut: int,
                 id_col: str = "doc_id", text_col: str = "text") -> list[tuple[object, str]]:
    """A bounded training sample: of each label value the `per_class` distinct texts that
    hash lowest, those of `least` to `most` characters first; other texts with a letter
    fill what is left, with their first `cut` characters. As (label, text), sorted by
    label, wanted length and hash. `label` has (label_id, label). Copies of a text are one narrow
    row, summed up per task before a shuffle; the ranking reads these rows
    and keeps `per_class` of a label per task (a window group limit) before it
    shuffles them; only the sample's texts come to the driver."""
    from pyspark.sql import Window
    size, key = F.length(text_col), F.xxhash64(text_col)
    near = size.between(least, most)
    narrow = rows.where(near | F.col(text_col).rlike(r"\p{L}")).select(F.col(id_col).alias("label_id"), key.alias("key"), (~near).alias("far"))
    picked = narrow.join(label, "label_id").groupBy("label", "key").agg(F.min("label_id").alias("label_id"), F.min("far").alias("far"))
    for groups in (["label", F.pmod(F.col("key"), F.lit(64))], ["label"]):   # so the last task reads 64 * per_class rows at most
        order = Window.partitionBy(*groups).orderBy("far", "key", "label_id")
        picked = picked.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_class)
    picked = picked.select("label_id", "label", "key", "far")
    chosen = picked.collect()       # at most per_class rows of each label
    if not chosen:
        return []
    spark = rows.sparkSession
    ids = spark.createDataFrame([(r["label_id"],) for r in chosen], "label_id long").distinct()
    texts = {(r["i"], r["key"]): r["t"] for r in rows.join(F.broadcast(ids), F.col(id_col) == F.col("label_id"))
             .select(F.col(id_col).alias("i"), key.alias("key"), F.when(near, F.col(text_col)).otherwise(F.substring(text_col, 1, cut)).alias("t")).collect()}
    return [(r["label"], texts[r["label_id"], r["key"]])
            for r in sorted(chosen, key=lambda r: (str(r["label"]), r["far"], r["key"], r["label_id"]))]


class Memo:
    """A function's values by key, of bounded size: what was not used for a
    generation goes. `young.get(key)` is the quick look-up; `add` does the rest."""

    def __init__(self, make: Callable, most: int, longest: int = 64):
        self.make, self.most, self.longest = make, most, longest
        self.young: dict = {}
        self.old: dict = {}

    def add(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
            self.young[key] = value
        return value
