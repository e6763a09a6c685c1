"""Property tests: the movement classifier against a plain-Python statement of
the same rules, on random series (one Spark job per example batch)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from monthwise.operators.movement import movement_classify
from monthwise.params import CORRECTED, EXACT


def py_classify(v, prior, mode):
    if mode == CORRECTED:
        if prior is None and v > 0:
            return "new"
        if prior is None or (prior == 0 and v == 0):
            return "inactive"
        if prior == 0 and v > 0:
            return "reactivation"
        if v > prior:
            return "expansion"
        if v == 0 and prior > 0:
            return "churn"
        if v < prior:
            return "contraction"
        return "retained"
    if prior is None or prior == 0:
        return "new"
    if v > prior:
        return "expansion"
    if v < prior and v > 0:
        return "contraction"
    if v == 0 and prior > 0:
        return "churn"
    if prior == 0 and v > 0:
        return "reactivation"
    return "retained"


series = st.lists(st.lists(st.sampled_from([0, 0, 5, 7, 7, 12]), min_size=1, max_size=8), min_size=1, max_size=6)


@settings(max_examples=15, deadline=None)
@given(series)
def test_movement_matches_python_rules(spark, data):
    rows = [(k, m, v) for k, s in enumerate(data) for m, v in enumerate(s)]
    df = spark.createDataFrame(rows, "k int, m int, v int")
    for mode in (EXACT, CORRECTED):
        got = {(r.k, r.m): (r.prior_value, r.value_change, r.movement)
               for r in movement_classify(df, ["k"], "m", "v", mode=mode).collect()}
        want = {}
        for k, s in enumerate(data):
            for m, v in enumerate(s):
                prior = s[m - 1] if m else None
                t = py_classify(v, prior, mode)
                if t != "inactive":
                    want[(k, m)] = (prior, v - (prior or 0), t)
        assert got == want
