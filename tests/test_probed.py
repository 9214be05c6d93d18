"""Queries by lists are handed on in bounded batches."""

import numpy as np
import pyarrow as pa

from feedloom.operators import search


def test_probed_rows_come_in_bounded_batches():
    n, dim, lists = 5000, 4, 8
    x = np.random.default_rng(1).normal(size=(n, dim))
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(n)]), pa.array(list(x), pa.list_(pa.float64()))], ["rid", "xs"])
    out = list(search._probed(x[:lists], lists)(iter([batch])))
    assert max(b.num_rows for b in out) <= search.LISTED_ROWS
    assert {(r, c) for b in out for r, c in zip(b.column("rid").to_pylist(), b.column("list_id").to_pylist())} == {(str(i), c) for i in range(n) for c in range(lists)}
