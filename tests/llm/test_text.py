"""Word splitting and hashing against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.common import FOLD, alnum_words, blank_words
from tickloom.llm.textwords import ALNUM, FOLDED, RAW, chunks, rolling, split_words, window_starts

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("aB zé9.\t\n\x0b\x1c\x01ſK世 ")), max_size=30)), max_size=8)


def listed(words):
    out = [words.dictionary[int(c)].as_py() for c in words.codes]
    return [out[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words(texts):
    column = pa.array(texts, pa.string())
    assert listed(split_words(column, RAW)) == [blank_words(t) for t in texts]
    assert listed(split_words(column, FOLDED)) == [blank_words((t or "").translate(FOLD)) for t in texts]
    assert listed(split_words(column, ALNUM)) == [alnum_words(t) for t in texts]
    assert listed(split_words(column.slice(1), RAW)) == [blank_words(t) for t in texts[1:]]


def test_rolling_hashes_are_those_of_the_words():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 5, 3000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    hashes = rolling(words, 4)
    names = [tuple(words[i : i + 4].tolist()) for i in range(len(hashes))]
    assert len(set(names)) == len(set(hashes.tolist())) == len(set(zip(names, hashes.tolist(), strict=True)))
    assert len(rolling(words[:3], 4)) == 0


def test_window_starts_stay_inside_texts():
    assert window_starts(np.array([0, 2, 2, 6]), 3).tolist() == [2, 3]


def test_chunks_cut_by_bytes():
    batch = pa.record_batch({"text": pa.array(["a" * 10, None, "b" * 50, "c"])})
    assert [c.num_rows for c in chunks(iter([batch]), limit=12)] == [2, 1, 1]
