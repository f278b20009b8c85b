"""Memory of the array helpers in a task."""

import tracemalloc

import numpy as np
import pyarrow as pa

from msgtriage.llm import arrays


def test_slices_bound_a_workers_memory(monkeypatch):
    monkeypatch.setattr(arrays, "_powers", (np.empty(0, np.uint64), np.empty(0, np.uint64)))
    texts = pa.array([f"word{i} of a text {i * 7919} " * 40 for i in range(5000)])
    whole, table = arrays.string_buffers(texts), arrays.alnum_words()
    assert len(whole[0]) > 4 << 20
    tracemalloc.start()
    found = []
    for _, _, data, starts, ends in arrays.doc_slices(texts):
        found.append(arrays.word_hashes(data, starts, ends, table)[0][:1000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) > 1 and peak < 60 << 20
    # the same words whatever the slices are
    all_at_once = arrays.word_hashes(*whole, table)[0]
    assert np.array_equal(found[0], all_at_once[:1000])
