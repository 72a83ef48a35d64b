"""Eager aggregation (drivers too big to broadcast) gives exactly the broadcast-join result."""

import pytest
from conftest import rows
from tables import tables

from pitlane.plans import views
from pitlane.sources.fixtures import warehouse

STAR_VIEWS = [
    views.avg_gap_to_leader, views.best_laps, views.driver_avg_by_compound, views.driver_avg_laptime,
    views.stint_summary, views.tyre_degradation, views.v_driver_avg_by_compound, views.v_driver_avg_laptime,
    views.v_stint_summary, views.v_tyre_degradation, views.v_avg_gap_to_leader, views.v_session_summary,
]


@pytest.mark.parametrize("fn", STAR_VIEWS, ids=lambda f: f.__name__)
def test_eager_path_equals_broadcast_path(spark, fn):
    for laps, drivers, sessions in (tables(spark), _wh(spark)):
        a = fn(laps, drivers, sessions)
        b = fn(laps, drivers, sessions, max_dim_bytes=0)
        assert a.columns == b.columns
        assert rows(a) == rows(b)


def _wh(spark):
    wh = warehouse(spark, "/root/testdata/sf0.001")
    return wh.laps, wh.drivers, wh.sessions
