"""Property test: ``upsert`` equals a plain-Python model of INSERT ... ON DUPLICATE KEY UPDATE."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows

from pitlane.operators.upsert import upsert

KEY = st.one_of(st.none(), st.integers(0, 3))
BASE_ROW = st.tuples(st.integers(0, 3), KEY, st.one_of(st.none(), st.integers(0, 9)), st.integers(0, 9))
UPD_ROW = st.tuples(KEY, KEY, st.one_of(st.none(), st.integers(0, 9)), st.integers(0, 5))


def model(base, updates):
    """Keys (a, b); ``v`` is updated, ``w`` kept; the last update (greatest order, then greatest row) wins."""
    out = {}
    loose = []
    for a, b, v, w in base:
        (loose.append((a, b, v, w)) if a is None or b is None else out.__setitem__((a, b), (a, b, v, w)))
    latest = {}
    for a, b, v, o in updates:
        if a is None or b is None:
            loose.append((a, b, v, None))
            continue
        cur = latest.get((a, b))
        cand = (o, v)
        if cur is None or (cand[0], -1 if cand[1] is None else cand[1]) > (cur[0], -1 if cur[1] is None else cur[1]):
            latest[(a, b)] = cand
    for (a, b), (_, v) in latest.items():
        old = out.get((a, b))
        out[(a, b)] = (a, b, v, old[3] if old else None)
    return sorted(list(out.values()) + loose, key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(BASE_ROW, max_size=6, unique_by=lambda r: (r[0], r[1])), st.lists(UPD_ROW, max_size=8))
def test_upsert_matches_model(spark, base_rows, upd_rows):
    base = spark.createDataFrame(base_rows, "a int, b int, v int, w int")
    upd = spark.createDataFrame(upd_rows, "a int, b int, v int, o int")
    want = model(base_rows, upd_rows)
    for bound in (1 << 20, 0):   # broadcast merge and full outer join
        got = rows(upsert(base, upd, ["a", "b"], ["v"], order="o", max_broadcast_bytes=bound))
        assert got == want, (bound, base_rows, upd_rows)
