"""Property tests: upsert and insert-if-absent against a plain-Python model."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from voxlens.operators import sinks

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
VALS = st.one_of(st.none(), st.integers(-3, 3))
ROWS = st.lists(st.tuples(KEYS, VALS, VALS), max_size=6)
SCHEMA = "k string, a long, b long"
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _model_upsert(old, new):
    """ON CONFLICT (k) DO UPDATE SET a = EXCLUDED.a; duplicate new keys -> the max row."""
    table = {}
    nulls = []
    for k, a, b in old:
        (nulls.append((k, a, b)) if k is None else table.__setitem__(k, (k, a, b)))
    latest = {}
    for k, a, b in new:
        if k is None:
            nulls.append((k, a, b))
            continue
        cand = (a, b)
        key = lambda t: tuple((x is not None, x if x is not None else 0) for x in t)  # NULL sorts first
        if k not in latest or key(cand) > key(latest[k]):
            latest[k] = cand
    for k, (a, b) in latest.items():
        table[k] = (k, a, table[k][2]) if k in table else (k, a, b)
    return sorted(list(table.values()) + nulls, key=repr)


@SETTINGS
@given(old=ROWS, new=ROWS)
def test_upsert_matches_model(spark, old, new):
    # the stored table has unique non-NULL keys
    seen, uniq = set(), []
    for r in old:
        if r[0] is None or r[0] not in seen:
            uniq.append(r)
            seen.add(r[0])
    got = sinks.upsert(spark.createDataFrame(uniq, SCHEMA), spark.createDataFrame(new, SCHEMA), ["k"], ["a"])
    assert sorted([tuple(r) for r in got.collect()], key=repr) == _model_upsert(uniq, new)


@SETTINGS
@given(old=ROWS, new=ROWS)
def test_insert_if_absent_matches_model(spark, old, new):
    got = sinks.insert_if_absent(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), "k")
    existing = {k for k, _, _ in old if k is not None}
    want_keys = sorted({k for k, _, _ in new if k is not None and k not in existing})
    got_rows = [tuple(r) for r in got.collect()]
    assert sorted(r[0] for r in got_rows if r[0] is not None) == want_keys
    assert sum(1 for r in got_rows if r[0] is None) == sum(1 for r in new if r[0] is None)
