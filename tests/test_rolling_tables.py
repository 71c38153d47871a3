"""Range tables against a plain loop."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from eventmill.operators.rolling import combined, numbered, passed, range_table

sizes = st.lists(st.integers(0, 30), min_size=1, max_size=60)


def loop(values, used, limit):
    files = 0
    for value in values:
        used += value
        if used >= limit:
            files, used = files + 1, 0
    return files, used


@settings(max_examples=200, deadline=None)
@given(sizes, sizes, sizes, st.integers(1, 70))
def test_tables(a, b, c, limit):
    parts = [np.array(p) for p in (a, b, c)]
    first, second, third = (range_table(p, limit) for p in parts)
    left = combined(combined(first, second, limit), third, limit)
    right = combined(first, combined(second, third, limit), limit)
    for used in range(limit):
        want = loop([*a, *b, *c], used, limit)
        assert passed(left, used, limit) == want == passed(right, used, limit)


@settings(max_examples=200, deadline=None)
@given(sizes, st.integers(1, 70), st.data())
def test_numbers(a, limit, data):
    used = data.draw(st.integers(0, limit - 1))
    want, held, number = [], used, 5
    for value in a:
        want.append(number)
        held += value
        if held >= limit:
            held, number = 0, number + 1
    assert numbered(np.array(a), used, 5, limit).tolist() == want
