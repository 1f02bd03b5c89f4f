import tracemalloc

import pyarrow as pa

from lakesync.llm.common import PLAIN_WORDS, text_slices, words


def test_memory_of_a_slice():
    """A task's arrays for the words of a batch stay small however large the batch is."""
    column = pa.array(["some words of a text that is not long " * 100] * 2000)
    tracemalloc.start()
    count = 0
    for _, _, data, offsets in text_slices(column):
        count += len(words(data, offsets, PLAIN_WORDS)[0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == 900 * 2000
    assert peak < 40e6
