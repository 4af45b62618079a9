"""Property test: for random nested documents (depth 3: struct > array of
structs > array), both flatten variants return exactly the estimated
number of rows, and good + bad rows equal the input."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flatgate.operators.flatten import explode_estimate, flatten
from flatgate.operators.quality import split_good_bad

SCHEMA = "id int, x struct<p array<struct<v int, w array<int>>>, q int>, y array<int>"

ints = st.one_of(st.none(), st.integers(-5, 5))
arr = st.one_of(st.none(), st.lists(ints, max_size=3))
elem = st.fixed_dictionaries({"v": ints, "w": arr})
doc = st.fixed_dictionaries(
    {
        "id": st.integers(0, 100),
        "x": st.one_of(st.none(), st.fixed_dictionaries({"p": st.one_of(st.none(), st.lists(elem, max_size=3)), "q": ints})),
        "y": arr,
    }
)


def count(v):
    """Rows one value turns into after a full outer explode."""
    if isinstance(v, dict):
        out = 1
        for x in v.values():
            out *= count(x)
        return out
    if isinstance(v, list):
        return max(1, sum(count(x) for x in v))
    return 1


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(doc, min_size=1, max_size=6))
def test_flatten_row_count_matches_estimate(spark, docs):
    df = spark.read.schema(SCHEMA).json(spark.sparkContext.parallelize([json.dumps(d) for d in docs]))
    want = sum(count(d) for d in docs)
    assert explode_estimate(df) == want
    flat = flatten(df, prefix=True)
    assert flat.count() == want
    assert flatten(df, prefix=False).count() == want
    good, bad = split_good_bad(flat, ["y"])
    assert good.count() + bad.count() == want
