"""Hashing a batch of texts in slices: bounded memory, the same signatures."""

import pyarrow as pa

from paceline.llm import near_dup


def test_large_batch_is_sliced_and_signed_alike():
    texts = [("word%d " % (i % 97)) * 20_000 for i in range(8)] + ["", "a b c"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["id", "text"])
    slices = list(near_dup._batches(batch))
    assert len(slices) > 1 and all(s.num_rows for s in slices)
    assert max(sum(len(t) for t in s.column("text").to_pylist()) for s in slices) <= 2 * 500_000
    sign = near_dup._sign(5, near_dup.trees_for(80))
    sliced = pa.Table.from_batches(list(sign([batch])))
    one = pa.Table.from_batches(list(sign([b for t in texts for b in [pa.RecordBatch.from_arrays(
        [pa.array([texts.index(t)], pa.int64()), pa.array([t])], ["id", "text"])]])))
    assert sliced.sort_by("id").equals(one.sort_by("id"))
