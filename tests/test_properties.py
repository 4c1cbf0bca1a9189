"""Invariants and the region rule against a brute-force check."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.functions import geo
from contrail.operators import merge, realtime, reports
from contrail.plans import warehouse
from tests.conftest import SMALL


def _region_brute(lat, lon):
    if lat is None or lon is None:
        return geo.REGION_UNKNOWN
    for name, la_lo, la_hi, lo_lo, lo_hi in geo.REGION_BOXES:
        ok = all(b is None or v >= b for v, b in ((lat, la_lo), (lon, lo_lo))) and \
            all(b is None or v <= b for v, b in ((lat, la_hi), (lon, lo_hi)))
        if ok:
            return name
    return geo.REGION_OTHER


coord = st.one_of(st.none(), st.integers(-200, 200).map(lambda v: v / 2),
                  st.floats(-95, 95, allow_nan=False))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(coord, coord), min_size=1, max_size=60))
def test_region_rule_matches_brute_force(spark, pts):
    df = spark.createDataFrame(pts, "latitude double, longitude double")
    got = [r[0] for r in df.select(geo.classify_region()).collect()]
    assert got == [_region_brute(a, b) for a, b in pts]


def test_group_totals_and_score_range(spark):
    f = warehouse.scheduled_flights(spark, SMALL)
    total = f.count()
    assert reports.hourly_patterns(f).agg(F.sum("flight_count")).first()[0] == total
    assert reports.aircraft_usage(f).agg(F.sum("flight_count")).first()[0] == total
    assert reports.airline_performance(f).agg(F.sum("total_flights")).first()[0] == total
    snap = warehouse.realtime_snapshot(spark, SMALL)
    assert realtime.rt_region_distribution(snap).agg(F.sum("flight_count")).first()[0] == snap.count()
    hist = warehouse.realtime_history(spark, SMALL)
    lo, hi = hist.agg(F.min("data_quality_score"), F.max("data_quality_score")).first()
    assert 0 <= lo <= hi <= 100


def test_dedupe_idempotent_and_one_per_key(spark):
    hist = warehouse.realtime_history(spark, SMALL)
    once = merge.dedupe_first(hist, "icao24", ("source_rank", "seq"))
    twice = merge.dedupe_first(once, "icao24", ("source_rank", "seq"))
    assert once.count() == hist.select("icao24").distinct().count()
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_approx_distinct_option_close_to_exact(spark):
    f = warehouse.scheduled_flights(spark, SMALL)
    exact = {r.departure_hour: r.airlines_operating for r in reports.hourly_patterns(f).collect()}
    approx_df = reports.hourly_patterns(f, approx_distinct=True)
    approx = {r.departure_hour: r.airlines_operating for r in approx_df.collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[h] - exact[h]) <= max(2, 0.05 * exact[h]) for h in exact)
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        approx_df.explain()
    assert "Expand" not in buf.getvalue()
