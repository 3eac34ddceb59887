import pyarrow as pa
import pytest

from tidemark.llm.common import slices


@pytest.mark.parametrize("texts", [[], [None, ""], ["ab"] * 10, ["x" * 50, "a", "b", None, "y" * 50, "z" * 7, "", "w" * 8]])
def test_slices_cover_a_batch_within_bounds(texts):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "n": pa.array(range(len(texts)))})
    parts = list(slices(batch, rows=4, size=10))
    assert [n for p in parts for n in p.column("n").to_pylist()] == list(range(len(texts)))
    for p in parts:
        total = sum(len(t or "") for t in p.column("text").to_pylist())
        assert 0 < p.num_rows <= 4 and (total <= 10 or p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()[1:]) == 0)


def test_slices_of_a_batch_without_texts():
    batch = pa.RecordBatch.from_pydict({"n": list(range(10))})
    assert [p.num_rows for p in slices(batch, rows=4)] == [4, 4, 2]
