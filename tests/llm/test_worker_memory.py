"""What a Python worker keeps from task to task (pipeline, round 3)."""

import weakref

import pyarrow as pa

from auditlake.llm import bpe, common, toxicity


def codec():
    return bpe.worker_codec("tiny", lambda: ({b"a": 0, b"b": 1}, r"\S+"))


def test_scoring_frees_the_codec_that_encoding_kept():
    """The memos of `encoding` lay in each worker while the next `toxicity` ran."""
    kept = codec()
    assert codec() is kept and kept.encode("ab") == b"\0\0\0\0\1\0\0\0"
    gone = weakref.ref(kept)
    del kept
    s = toxicity.Settings(buckets=16)
    got = list(toxicity.score_batches(iter([pa.array(["ab", None])]), (toxicity.np.zeros(16), 0.0), s))
    assert [x.to_pylist() for x in got] == [[0.5, 0.5]] and not common._HELD
    assert gone() is None


def test_other_maps_free_it_and_its_own_keeps_it(spark):
    def holds(batch):
        codec()
        yield {"n": [len(common._HELD)] * batch.num_rows}

    rows = spark.range(4).coalesce(1)
    assert {r.n for r in common.arrow_map(rows, holds, "n long", keeps=True).collect()} == {1}
    seen = common.arrow_map(rows, lambda b: iter([{"n": [len(common._HELD)] * b.num_rows}]), "n long")
    assert {r.n for r in seen.collect()} == {0}
