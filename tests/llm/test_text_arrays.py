import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.llm.text_arrays import sequence_hashes, sliding_argmin, text_slices, word_hashes

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n\x0b 中", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_and_hashes(texts, limit):
    seen, by_word = [], {}
    for low, high, data, offsets in text_slices(pa.array(texts, pa.string()), limit):
        hashes, starts, ends, first = word_hashes(data, offsets)
        raw = data.tobytes()
        for i in range(high - low):
            own = [raw[s:e].decode() for s, e in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
            seen.append(own)
            for w, h in zip(own, hashes[first[i] : first[i + 1]]):
                assert by_word.setdefault(w, h) == h
    assert seen == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert len(set(by_word.values())) == len(by_word)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 12))
def test_sliding_argmin(values, width):
    got = sliding_argmin(np.array(values), width).tolist()
    assert got == [min(range(i, i + width), key=lambda j: (values[j], j)) for i in range(len(values) - width + 1)]


def test_sequences():
    w = np.array([1, 2, 3, 1, 2, 3, 4], np.uint64)
    h = sequence_hashes(w, np.array([0, 3, 1]), np.array([3, 6, 4]))
    assert h[0] == h[1] != h[2]
