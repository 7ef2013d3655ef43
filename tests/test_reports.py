from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from headway.operators.filters import filter_trains
from headway.operators import quality
from headway.plans import marts, preview, serving
from headway.plans.build import build_marts, build_staging, check_models
from headway.sources.feeds import FEEDS, resolve_feeds, select_feeds
from tests.builders import alert, at, fetch, raw, stop, train


def test_resolve_feeds():
    assert list(resolve_feeds()) == ["1234567S"]
    assert list(resolve_feeds("  ")) == ["1234567S"]
    assert resolve_feeds("ALL") == FEEDS and len(FEEDS) == 8
    assert list(resolve_feeds(" ACE , L,")) == ["ACE", "L"]
    with pytest.raises(ValueError, match="XYZ"):
        resolve_feeds("ACE,XYZ")


def test_select_feeds(spark):
    vehicles = raw(spark, trains=[train("1", feed_key="ACE"), train("2", feed_key="L")]).vehicles
    assert [r.entity_id for r in select_feeds(vehicles, "L").collect()] == ["2"]


@pytest.fixture(scope="module")
def served(spark):
    tables = raw(
        spark,
        trains=[
            train("1", "a", direction="N"), train("2", "b", direction="S", route_id="2"),
            train("3", "c", direction="N", route_id="2"), train("4", "d", route_id=None),
        ],
        stops=[stop("u", trip_id="c")],
        alerts=[alert("x", trip_id="c")],
    )
    return serving.current_trains(marts.fct_current_trains(tables)).cache()


@pytest.mark.parametrize(
    "options, trips",
    [
        ({}, "abcd"),
        ({"lines": ["2"]}, "bc"),
        ({"direction": "Northbound"}, "ac"),
        ({"direction": "Southbound"}, "b"),
        ({"only_delayed": True}, "c"),
        ({"lines": ["1", "2"], "direction": "Northbound", "only_delayed": True}, "c"),
    ],
)
def test_filter_trains(served, options, trips):
    assert "".join(sorted(r.trip_id for r in filter_trains(served, **options).collect())) == trips


def test_unknown_direction_is_refused(served):
    with pytest.raises(KeyError):
        filter_trains(served, direction="Up")


def test_trains_are_served_in_order_nulls_last(served):
    assert [r.trip_id for r in served.collect()] == ["a", "c", "b", "d"]
    assert [r.line for r in serving.lines_available(served).collect()] == ["1", "2"]


def drift(spark, *rows):
    schema = (
        "route_id string, trip_key string, trip_id string, direction string,"
        " trip_stops_observed long, trip_median_drift_minutes double"
    )
    return spark.createDataFrame(list(rows), schema)


def test_long_trips_do_not_outvote_short_ones(spark):
    long_trip = [("1", "x", "x", "N", 30, 5.0)] * 30
    rows = drift(
        spark, *long_trip, ("1", "y", "y", "N", 1, -3.0), ("1", "z", "z", "N", 1, 2.0),
        (None, "w", "w", "N", 1, 9.0),
    )
    (line,) = serving.drift_by_line(rows).collect()
    assert tuple(line) == ("1", 3, 2.0, 1, 1)
    assert [r.trip_id for r in serving.drift_leaders(rows, 2).collect()] == ["w", "x"]
    sides = {r.side: r for r in serving.drift_sides(serving.drift_by_line(rows)).collect()}
    assert sides["Losing time"].trips == 1 and sides["Making up time"].trips == -1
    assert sides["Making up time"].trips_abs == 1 and sides["Losing time"].axis_limit == 2.0


def test_axis_limit_reaches_past_the_longest_bar(spark):
    rows = drift(spark, *[("1", f"k{i}", f"t{i}", "S", 1, -9.0) for i in range(8)])
    sides = serving.drift_sides(serving.drift_by_line(rows))
    assert {r.axis_limit for r in sides.collect()} == {10.0}
    assert [r.trips for r in serving.drift_sides_labelled(sides).collect()] == [-8]


def error(seconds):
    row = {"occurred_at": at(seconds), "feed_key": "A", "error_type": "E"}
    return row | {"error_message": str(seconds)}


def test_freshness(spark):
    tables = raw(
        spark,
        fetches=[fetch(), fetch(fetch_id="f2", feed_key="B", published=100)],
        errors=[error(-900), error(-700), error(0), error(130)],
    )
    as_of = at(160)
    row = serving.freshness(tables, as_of).first()
    assert (row.total_snapshots, row.feeds, row.age_seconds, row.recent_errors) == (2, 2, 60.0, 3)
    stale = serving.model_staleness(tables.fetches, _trains_at(spark, -200))
    assert stale.first().lag_seconds == 300.0
    verdict = serving.freshness_verdict(serving.freshness(tables, as_of), stale).first()
    assert tuple(verdict) == ("OK", "60s", 2, 3, "5m")
    status = serving.store_status(tables, as_of).first()
    assert (status.snapshots, status.age_seconds, status.ingest_errors) == (2, 60, 4)
    newest = [r.error_message for r in serving.recent_errors(tables.errors, 2).collect()]
    assert newest == ["130", "0"]


def _trains_at(spark, seconds):
    return spark.createDataFrame([(at(seconds),)], "snapshot_at timestamp")


def test_freshness_of_nothing(spark):
    tables = raw(spark)
    fresh = serving.freshness(tables, at(0))
    assert fresh.first().age_seconds is None and fresh.first().total_snapshots == 0
    trains = _trains_at(spark, 0).limit(0)
    verdict = serving.freshness_verdict(fresh, serving.model_staleness(tables.fetches, trains))
    assert tuple(verdict.first()) == ("NO DATA", "unknown", 0, 0, None)


def test_headline_of_nothing_is_zeros(spark):
    tables = raw(spark)
    lines = marts.fct_line_activity(marts.fct_current_trains(tables))
    row = serving.headline_numbers(lines, serving.drift_by_line(drift(spark)))
    assert tuple(row.first()) == (0, 0, 0, 0, 0)


def test_preview_skips_what_has_no_name(spark):
    tables = raw(
        spark,
        trains=[train("1"), train("2", route_id=None), train("3", direction="S")],
        stops=[stop("u", arrival=None)],
        alerts=[alert("a", "x"), alert("b", "x"), alert("c", None), alert("d", "w")],
    )
    assert [tuple(r) for r in preview.trains_per_route(tables.vehicles).collect()] == [("1", 2)]
    assert [tuple(r) for r in preview.top_alerts(tables.alerts, 1).collect()] == [("x", 2)]
    assert [tuple(r) for r in preview.status_mix(tables.vehicles).collect()] == [("STOPPED_AT", 3)]
    assert preview.first_vehicles(tables.vehicles, 2).first().direction == "?"
    assert preview.first_arrivals(tables.stops).first().arrival == "none"


# Data checks


def values(spark, *items, kind="string"):
    return spark.createDataFrame([(item,) for item in items], f"c {kind}")


def failing(df):
    return sorted((r.c for r in df.collect()), key=lambda c: (c is not None, c))


def test_column_checks(spark):
    assert failing(quality.unique(values(spark, "a", "a", "b", None, None), "c")) == ["a"]
    assert failing(quality.unique(values(spark, "a", "a", "b", "b"), "c", "c <> 'a'")) == ["b"]
    assert failing(quality.not_null(values(spark, "a", None), "c")) == [None]
    assert failing(quality.accepted_values(values(spark, "a", "z", None), "c", ["a"])) == ["z"]
    numbers = values(spark, 1, 0, -1, None, kind="int")
    assert failing(quality.positive_value(numbers, "c")) == [None, -1, 0]
    assert failing(quality.at_most(numbers, "c", 0)) == [1]
    orphans = quality.relationships(values(spark, "a", "z", None), "c", values(spark, "a"), "c")
    assert failing(orphans) == ["z"]


def test_source_freshness(spark):
    tables = raw(
        spark, trains=[train("1", fetched_at=at(0))], stops=[stop("u", fetched_at=at(-1600))],
        fetches=[fetch(fetched_at=at(199))],
    )
    rows = quality.source_freshness(tables, at(400)).collect()
    assert {r.source: r.status for r in rows} == {
        "raw_feed_fetches": "pass", "raw_vehicle_positions": "warn",
        "raw_trip_stop_updates": "error", "raw_alerts": "error",
    }


@pytest.mark.parametrize("running, fails", [(0, True), (1, False), (150, False), (151, True)])
def test_plausible_counts(spark, running, fails):
    lines = spark.createDataFrame([("1", running)], "route_id string, trains_running long")
    assert quality.plausible_train_counts(lines).count() == fails
    assert quality.plausible_train_counts(lines, 10**6).count() == (1 if running < 1 else 0)


@pytest.mark.parametrize("found, fails", [(0, True), (7, True), (8, False), (10, False)])
def test_prediction_coverage(spark, found, fails):
    trains = values(spark, *["x" if i < found else None for i in range(10)])
    renamed = trains.withColumnRenamed("c", "next_stop_id")
    assert quality.prediction_coverage(renamed).count() == fails
    assert quality.prediction_coverage(renamed.limit(0)).count() == 0


def test_report_counts_each_check_once(spark):
    tables = raw(spark, trains=[train("1", status="7"), train("1", route_id=None)], fetches=[fetch(vehicle_rows=2)])
    models = build_staging(tables) | build_marts(tables)
    rows = check_models(tables, models).collect()
    sources = {"raw_feed_fetches": tables.fetches, "raw_vehicle_positions": tables.vehicles}
    assert sorted(quality.run_checks(models | sources).collect()) == sorted(rows)
    assert len(rows) == len(quality.CHECKS) == len({r.check_name for r in rows}) == 41
    bad = {r.check_name: (r.failures, r.status) for r in rows if r.failures}
    assert bad == {
        "unique_stg_vehicle_positions_snapshot_train_key": (1, "error"),
        "unique_fct_current_trains_snapshot_train_key": (1, "error"),
        "unique_stg_vehicle_positions_trip_id": (1, "warn"),
        "not_null_stg_vehicle_positions_route_id": (1, "error"),
        "not_null_fct_current_trains_route_id": (1, "error"),
        "accepted_values_stg_vehicle_positions_current_status": (1, "error"),
        "prediction_coverage_fct_current_trains": (1, "warn"),
    }


def test_report_looks_at_the_models_it_names(spark):
    tables = raw(spark, trains=[train("1"), train("2", "t")], fetches=[fetch(vehicle_rows=2)])
    models = build_staging(tables) | build_marts(tables)
    staged = models["stg_vehicle_positions"]

    def failures(positions):
        rows = check_models(tables, models | {"stg_vehicle_positions": positions}).collect()
        return {r.check_name: r.failures for r in rows}["unique_stg_vehicle_positions_snapshot_train_key"]

    assert failures(staged) == 0
    assert failures(staged.union(staged)) == 2
