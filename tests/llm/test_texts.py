import pyarrow as pa

from tidegate.llm.texts import slices


def test_slices_keep_all_rows_and_bound_their_texts():
    texts = ["a" * n for n in (3, 9, 0, 1, 20, 2, 2)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["k", "t"])
    parts = list(slices(iter([batch, batch.slice(0, 0)]), 1, 10))
    assert [k for p in parts for k in p.column(0).to_pylist()] == list(range(len(texts)))
    sizes = [sum(len(t or "") for t in p.column(1).to_pylist()) for p in parts]
    assert all(s <= 10 or p.num_rows == 1 for s, p in zip(sizes, parts))
