import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm.common import load_arrays, save_arrays
from stratum.llm.eliasfano import EliasFano


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 40) | st.integers(0, 300), max_size=300), st.lists(st.integers(0, 1 << 41), max_size=20))
def test_like_a_sorted_list(values, more):
    values.sort()
    ef = EliasFano.of(np.array(values, np.uint64))
    assert ef.access(np.arange(len(values))).tolist() == values
    ask = np.array(values + [v + 1 for v in values] + more + [0], np.uint64)
    at, same = ef.successor(ask)
    assert at.tolist() == np.searchsorted(np.array(values, np.uint64), ask).tolist()
    assert same.tolist() == [int(x) in set(values) for x in ask]


@pytest.mark.parametrize("top", [1 << 20, 1 << 62])
def test_large_and_compact(tmp_path, top):
    v = np.sort(np.random.default_rng(3).integers(0, top, 200_000).astype(np.uint64))
    ef = EliasFano.of(v)
    save_arrays(f"{tmp_path}/ef", ef.arrays("x"))
    arrays = load_arrays(f"{tmp_path}/ef")
    back = EliasFano.load(arrays, "x")
    assert np.array_equal(back.access(np.arange(len(v))), v)
    at, same = back.successor(v)
    assert same.all() and np.array_equal(v[at], v)
    bits = 8 * sum(a.nbytes for a in arrays.values()) / len(v)
    assert bits < 3.6 + max(0, np.log2(top / len(v)))
