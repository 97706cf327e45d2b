"""What the quality rules hold at once does not grow with the rows of a batch."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tidemark.llm import quality_rules as q


def measured(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tracemalloc.start()
    out = [row for b in q._measured(8, "text", "m")([batch]) for row in b.column(1).to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak


def test_memory_is_that_of_a_small_chunk():
    r = np.random.default_rng(7)
    texts = [" ".join(f"w{k}" for k in r.integers(0, 500, 200)) + " again and again the same nine words of it" * (n % 3) for n in range(4000)]
    texts[5:7] = [None, ""]
    out, peak = measured(texts)
    assert sum(len(t or "") for t in texts) > 3 << 20 and peak < 80e6
    for n in (0, 1, 2, 5, 6, 1700, 3999):
        assert out[n] == measured([texts[n]])[0][0]
