import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm.chunks import SLICE_BYTES, slices
from tidemark.llm.text import Words, lay


@pytest.mark.parametrize("texts", [[], [None], [""], ["a b", None, "", "é\n x"], ["x"] * 3])
def test_a_column_is_laid_like_a_list(texts):
    data, starts = lay(texts)
    for column in (pa.array(texts, pa.string()), pa.chunked_array([pa.array(texts, pa.string())], pa.string())):
        other, places = lay(column)
        assert other.tobytes() == data.tobytes() and places.tolist() == starts.tolist()


def test_windows_stay_within_their_text():
    words = Words(*lay(["a b c", None, "d e", "b c d e"]))
    hashes, start = words.windows(3)
    assert start.tolist() == [0, 5, 6] and len(np.unique(hashes)) == 3
    assert len(Words(*lay([])).windows(3)[0]) == 0


@pytest.mark.parametrize("sizes", [[], [0], [None, 0, 3], [SLICE_BYTES + 5, 1, 1], [1, 2 * SLICE_BYTES, None, 7], [SLICE_BYTES // 2] * 5])
def test_slices_hold_every_row_once_and_few_bytes(sizes):
    texts = pa.array([None if n is None else "x" * n for n in sizes], pa.string())
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes)), pa.int64()), texts], names=["id", "text"])
    parts = list(slices(batch, "text"))
    assert [i for p in parts for i in p.column("id").to_pylist()] == list(range(len(sizes)))
    for p in parts:
        assert p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= SLICE_BYTES
