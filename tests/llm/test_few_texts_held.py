import pyarrow as pa

from auditlake.llm import toxicity


class Watched:
    """An Arrow array that notes how many of its values become Python's at a time."""

    def __init__(self, array, sizes):
        self.array, self.sizes = array, sizes

    def __len__(self):
        return len(self.array)

    def slice(self, at, size):
        return Watched(self.array.slice(at, size), self.sizes)

    def to_pylist(self):
        self.sizes.append(len(self.array))
        return self.array.to_pylist()


def test_few_texts_of_a_batch_are_held_at_a_time():
    texts = [None, "", *(f"w{k % 7} w{k % 5} v" for k in range(1000))]
    memo = toxicity.Memo(lambda w: len(w) + ord(w[-1]) / 100, 4)
    sizes = []
    got = toxicity.scores_of(Watched(pa.array(texts), sizes), -3.0, memo, 2)
    assert len(got) == len(texts) and sum(sizes) == len(texts) and max(sizes) <= 256
    fresh = toxicity.Memo(memo.make, 1 << 10)
    assert got == [toxicity.sigmoid(-3.0 + toxicity.strongest(toxicity.words_of(t or ""), fresh, 2)) for t in texts]
