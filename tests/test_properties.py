"""Property tests: the merge core against a plain-Python model."""
from hypothesis import HealthCheck, given, settings, strategies as st

from tickvault.sinks.merge import merge_frames

ROW = st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 3), st.integers(-5, 5))
SCHEMA = "k string, v int, x int"


def model(stored, batch):
    """Batch beats stored; within a side the greatest (v, x) wins."""
    out = {}
    for src, rows in ((0, stored), (1, batch)):
        for k, v, x in rows:
            cand = (src, v, x)
            if k not in out or cand > out[k]:
                out[k] = cand
    return sorted((k, v, x) for k, (_, v, x) in out.items())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(stored=st.lists(ROW, max_size=8), batch=st.lists(ROW, max_size=8))
def test_merge_matches_model_and_is_idempotent(spark, stored, batch):
    s = spark.createDataFrame(stored, SCHEMA)
    b = spark.createDataFrame(batch, SCHEMA)
    once = merge_frames(s, b, ["k"], ["v"])
    got = sorted(map(tuple, once.collect()))
    assert got == model(stored, batch)
    twice = sorted(map(tuple, merge_frames(once, b, ["k"], ["v"]).collect()))
    assert twice == got
