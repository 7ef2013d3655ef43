from __future__ import annotations

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from headway.operators.snapshots import snapshot_recency, with_gaps
from headway.plans import marts, staging
from headway.plans.build import MARTS, build_marts, build_staging, rebuild
from headway.operators.landing import land_next
from headway.sources.tables import check_ready, missing_models, read_raw, ModelsNotBuilt
from tests.builders import (
    HEADER, alert, at, default_payload, fetch, payloads, raw, snapshot, stop, train,
)

POSITIONS = """snapshot_train_key trip_key fetch_id feed_key entity_id trip_id start_date route_id
    direction trip_path stop_id current_status current_stop_sequence header_timestamp fetched_at
    vehicle_timestamp ingest_lag_seconds position_age_seconds origin_departure_seconds
    has_reused_trip_id is_unparsed_trip_id snapshot_recency_rank""".split()


def by_entity(df, *columns):
    return {row.entity_id: tuple(row[c] for c in columns) for row in df.collect()}


def test_every_model_builds_on_empty_tables(spark):
    tables = raw(spark)
    for model in (build_staging(tables) | build_marts(tables)).values():
        assert model.count() == 0


def test_position_columns(spark):
    rows = staging.stg_vehicle_positions(
        raw(spark, trains=[train("1", vehicle_timestamp=at(-9), start_date=None, direction="N")]).vehicles,
        raw(spark, fetches=[fetch(vehicle_rows=1)]).fetches,
    )
    assert rows.columns == POSITIONS
    (row,) = rows.collect()
    assert row.snapshot_train_key == "f1|1" and row.trip_key == "041300_5..N07R|unknown"
    assert row.ingest_lag_seconds == 5 and row.position_age_seconds == 9
    assert not row.has_reused_trip_id and not row.is_unparsed_trip_id


def test_reused_trip_ids_are_flagged_within_a_snapshot_only(spark):
    trains = [
        train("1", "t"), train("2", "t", "102N"), train("3", "u"),
        train("4", None), train("5", None), train("6", "u", fetch_id="f2", published=30),
        train("7", None, fetch_id="f2", published=30),
    ]
    got = by_entity(staging.positions(raw(spark, trains=trains).vehicles), "has_reused_trip_id")
    assert got == {"1": (True,), "2": (True,), "3": (False,), "4": (True,), "5": (True,),
                   "6": (False,), "7": (False,)}


def test_recency_runs_over_days_and_feeds(spark):
    day = 86_400
    times = {"A": [0, 30, day, 3 * day, None], "B": [5 * day]}
    trains = [
        train(f"{feed}{i}{copy}") | snapshot(f"{feed}{i}", feed, seconds)
        for feed, published in times.items()
        for i, seconds in enumerate(published)
        for copy in "xy"
    ]
    fetches = [
        fetch(fetch_id=f"{feed}{i}", feed_key=feed, published=seconds, vehicle_rows=2)
        for feed, published in times.items()
        for i, seconds in enumerate(published)
    ]
    # A snapshot without trains has no rank and moves none.
    fetches.append(fetch(fetch_id="empty", feed_key="A", published=9 * day, vehicle_rows=0))
    tables = raw(spark, trains=trains, fetches=fetches)
    vehicles = tables.vehicles
    got = by_entity(staging.stg_vehicle_positions(vehicles, tables.fetches), "snapshot_recency_rank")
    ranks = {"A0": 4, "A1": 3, "A2": 2, "A3": 1, "A4": 5, "B0": 1}
    assert got == {f"{k}{copy}": (rank,) for k, rank in ranks.items() for copy in "xy"}
    assert snapshot_recency(vehicles).count() == 6


def test_stops_without_arrival_are_dropped(spark):
    stops = raw(spark, stops=[stop("u", 0, arrival=None), stop("u", 1, arrival=60)]).stops
    (row,) = staging.stg_trip_stop_updates(stops).collect()
    assert row.snapshot_stop_key == "f1|u|1" and row.seconds_to_arrival == 60
    assert row.is_next_stop is False


def test_alert_flags(spark):
    alerts = [alert("1", "Trains are DELAYED"), alert("2", None), alert("3", "x", trip_id=None)]
    got = by_entity(staging.stg_alerts(raw(spark, alerts=alerts).alerts),
                    "is_delay_alert", "is_trip_level", "trip_key")
    assert got["1"] == (True, True, "041300_5..N07R|20250314")
    assert got["2"][:2] == (False, True)
    assert got["3"] == (False, False, "unknown|20250314")


def test_trains_sharing_a_trip_id_do_not_multiply(spark):
    tables = raw(
        spark,
        trains=[train("v1", "t", "310S"), train("v2", "t", "402S")],
        stops=[
            stop("u1", 0, "310S", 60, "t"), stop("u1", 1, "311S", 120, "t"),
            stop("u2", 0, "402S", 90, "t"), stop("u2", 1, "403S", 180, "t"),
        ],
        alerts=[alert("a", "Delay one", "t"), alert("b", "Another", "t"), alert("c", "Another", "t")],
    )
    got = by_entity(
        marts.fct_current_trains(tables),
        "next_stop_id", "minutes_to_next_stop", "following_stop_id", "alert_text", "status_label",
        "has_reused_trip_id",
    )
    both = ("Another; Delay one", "Delayed (MTA alert)", True)
    assert got == {"v1": ("310S", 1.0, "311S", *both), "v2": ("402S", 1.5, "403S", *both)}


def test_predictions_meet_positions_by_trip_date_and_stop(spark):
    tables = raw(
        spark,
        trains=[
            train("dateless", "a", start_date=None), train("other stop", "b", "999N"),
            train("other date", "c", start_date="20250315"), train("no trip", None),
            train("no stop", "d", None),
        ],
        stops=[
            stop("dateless", 0, trip_id="a", start_date=None), stop("x", 0, trip_id="b"),
            stop("y", 0, trip_id="c"), stop("no trip", 0, trip_id=None),
            stop("z", 0, None, trip_id="d"),
        ],
        alerts=[alert("a", "Train delayed", None)],
    )
    got = by_entity(marts.fct_current_trains(tables), "next_stop_id", "has_delay_alert", "alert_text")
    missing = (None, False, None)
    assert got.pop("dateless") == ("101N", False, None)
    assert set(got.values()) == {missing} and len(got) == 4


def test_two_predictions_for_one_train_keep_the_smaller_entity(spark):
    tables = raw(
        spark, trains=[train("v")],
        stops=[stop("u2", arrival=60), stop("u1", arrival=90), stop("u1", 1, "103N", 150)],
    )
    (row,) = marts.fct_current_trains(tables).collect()
    assert row.seconds_to_next_stop == 90 and row.following_stop_id == "103N"


def test_alert_without_text_still_counts(spark):
    tables = raw(spark, trains=[train("v")], alerts=[alert("a", None)])
    (row,) = marts.fct_current_trains(tables).collect()
    assert row.alert_text is None and row.has_delay_alert is False


def test_alert_without_start_date_misses_a_dated_train(spark):
    tables = raw(spark, trains=[train("v")], alerts=[alert("a", start_date=None)])
    assert marts.fct_current_trains(tables).first().alert_text is None


def test_current_trains_take_the_newest_snapshot_of_each_feed(spark):
    trains = [
        train("old"), train("new") | snapshot("f2", "A", 30),
        train("b") | snapshot("f3", "B", 10), train("undated") | snapshot("f4", "C", None),
    ]
    got = marts.fct_current_trains(raw(spark, trains=trains))
    assert {row.entity_id for row in got.collect()} == {"new", "b", "undated"}


def test_landed_tables_give_the_same_current_trains(spark, tmp_path):
    root = str(tmp_path / "lake")
    polls = [(default_payload(), 0, "A"), (default_payload(HEADER + 90_000), 90_000, "A"),
             (default_payload(HEADER + 30), 30, "B"),
             (default_payload(HEADER + 180_000, []), 180_000, "B"), (default_payload(0), 9, "C")]
    land_next(payloads(spark, *polls), root)
    tables = read_raw(spark, root)
    plain = type(tables)(
        *[getattr(tables, n).drop("snapshot_date", "landing_batch_id")
          for n in ("fetches", "vehicles", "stops", "alerts", "errors")]
    )
    pruned = marts.fct_current_trains(tables)
    assert "dynamicpruning" in pruned._jdf.queryExecution().toString()
    assert sorted(pruned.collect()) == sorted(marts.fct_current_trains(plain).collect())
    assert {row.feed_key for row in pruned.collect()} == {"A", "B", "C"}


def test_line_activity(spark):
    tables = raw(
        spark,
        trains=[
            train("1", "a", direction="N"), train("2", "b", direction="S", status="IN_TRANSIT_TO"),
            train("3", "c", status="INCOMING_AT"), train("4", "d", route_id=None),
        ],
        stops=[stop("u", trip_id="a", arrival=60), stop("w", trip_id="b", arrival=150)],
        alerts=[alert("x", trip_id="b")],
    )
    (row,) = marts.fct_line_activity(marts.fct_current_trains(tables)).collect()
    assert row.asDict() | {"snapshot_at": None} == {
        "feed_key": "A", "route_id": "1", "snapshot_at": None, "trains_running": 3,
        "trains_northbound": 1, "trains_southbound": 1, "trains_at_station": 1,
        "trains_in_transit": 1, "trains_arriving": 1, "trains_delayed": 1,
        "median_minutes_to_next_stop": 1.8, "max_minutes_to_next_stop": 2.5,
        "trains_with_reused_trip_id": 0, "trains_missing_prediction": 1,
        "pct_delayed": 33.3, "pct_missing_prediction": 33.3,
    }


def seen(stop_id, *predictions, trip_id="t"):
    """Predictions of one stop in successive snapshots 30 seconds apart."""
    return [
        stop(f"u{i}", 0, stop_id, arrival, trip_id) | snapshot(f"f{i}", "A", 30 * i)
        for i, arrival in enumerate(predictions)
    ]


def test_drift(spark):
    stops = [
        *seen("late", 600, 700, 721), *seen("early", 600, 479), *seen("steady", 600, 720),
        *seen("once", 600), *seen("passing", 60, 900), *seen("ahead", 61, 61),
    ]
    rows = marts.fct_prediction_drift(raw(spark, stops=stops)).collect()
    got = {row.stop_id: row for row in rows}
    assert {k: (r.drift_seconds, r.drift_label) for k, r in got.items()} == {
        "late": (121, "Losing time"), "early": (-121, "Making up time"),
        "steady": (120, "On plan"), "ahead": (0, "On plan"),
    }
    assert got["late"].observation_count == 3 and got["late"].drift_minutes == 2.0
    assert got["late"].observation_window_seconds == 60
    assert {r.trip_stops_observed for r in rows} == {4}
    assert {r.trip_median_drift_minutes for r in rows} == {1.0}


def test_trains_sharing_a_trip_id_do_not_drift_apart(spark):
    """At both ends the sooner arrival of those published together counts."""
    stops = [
        stop("b", 0, "s", 600, "t"), stop("a", 0, "s", 700, "t"),
        stop("a", 0, "s", 800, "t") | snapshot("f2", "A", 30),
        stop("b", 0, "s", 650, "t") | snapshot("f2", "A", 30),
    ]
    (row,) = marts.fct_prediction_drift(raw(spark, stops=stops)).collect()
    assert row.drift_seconds == 50 and row.observation_count == 4


@pytest.mark.parametrize("days", [-400, -200, 200, 300])
def test_ties_far_from_the_snapshot_go_to_the_sooner_arrival(spark, days):
    far = [
        stop(entity, 0, "s", days * 86_400 + more, "t") for entity, more in (("a", 0), ("b", 86_400))
    ]
    for stops in (far, far[::-1]):
        observed = marts.drift_observations(
            staging.stg_trip_stop_updates(raw(spark, stops=stops).stops.coalesce(1))
        )
        plan = observed._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan
        (row,) = observed.collect()
        sooner = at(days * 86_400).replace(tzinfo=None)
        assert (row.first_predicted_arrival, row.last_predicted_arrival) == (sooner, sooner)


def test_drift_of_extreme_times(spark):
    """Times at the ends of the calendar neither overflow nor win by it."""
    ends = [datetime(2, 1, 1, tzinfo=UTC), datetime(9999, 12, 31, 23, 59, 59, tzinfo=UTC)]
    stops = [
        stop("a", 0, "s", 600, "t"),
        stop("a", 0, "s", 600, "t") | {"header_timestamp": ends[1], "arrival_time": ends[0]},
        stop("a", 0, "s", 600, "t") | {"header_timestamp": None, "arrival_time": ends[1]},
        stop("a", 0, "s", 600, "u") | {"header_timestamp": ends[0], "arrival_time": ends[1]},
    ]
    observed = marts.drift_observations(
        staging.stg_trip_stop_updates(raw(spark, stops=stops).stops)
    )
    got = {
        r.trip_id: (r.observation_count, r.first_predicted_arrival, r.last_predicted_arrival)
        for r in observed.collect()
    }
    first, last = (end.replace(tzinfo=None) for end in ends)
    assert got == {"t": (3, at(600).replace(tzinfo=None), first), "u": (1, last, last)}


def test_drift_names_come_from_any_row_that_has_them(spark):
    stops = [
        stop("a", 0, "s", 600, "t", route_id=None), stop("a", 1, "s", 600, "t", route_id="5"),
        stop("a", 2, "s", 660, "t", route_id="4") | snapshot("f2", "A", 30),
    ]
    (row,) = marts.fct_prediction_drift(raw(spark, stops=stops)).collect()
    assert (row.route_id, row.observation_count, row.drift_seconds) == ("4", 3, 60)


def test_gaps(spark):
    day = 86_400
    published = [0, 300, 601, day + 601, None, None]
    fetches = [fetch(fetch_id=f"f{i}", feed_key="A", published=p) for i, p in enumerate(published)]
    fetches.append(fetch(fetch_id="other", feed_key="B", published=5 * day))
    rows = with_gaps(raw(spark, fetches=fetches).fetches).collect()
    got = {r.fetch_id: (r.seconds_since_previous_snapshot, r.is_after_ingestion_gap) for r in rows}
    assert got == {
        "f0": (None, False), "f1": (300, False), "f2": (301, True), "f3": (day, True),
        "f4": (None, False), "f5": (None, False), "other": (None, False),
    }


def test_health_counts(spark):
    tables = raw(
        spark,
        trains=[
            train("1", "t", direction="N", vehicle_timestamp=at(-10)), train("2", "t", direction="N"),
            train("3", "u", None, route_id=None, vehicle_timestamp=at(-21)), train("4", None),
        ],
        alerts=[alert("a"), alert("b", "x")],
        fetches=[fetch(trip_stop_rows=7), fetch(fetch_id="f2", published=600)],
    )
    full, empty = sorted(marts.dq_ingestion_health(tables).collect(), key=lambda r: r.fetch_id)
    assert (full.vehicle_rows, full.distinct_trip_ids, full.rows_with_reused_trip_id) == (4, 2, 2)
    assert (full.rows_with_unparsed_trip_id, full.rows_missing_route, full.rows_missing_stop) == (2, 1, 1)
    assert (full.alert_rows, full.delay_alert_rows, full.trip_stop_rows) == (2, 1, 7)
    assert (full.avg_position_age_seconds, full.avg_ingest_lag_seconds) == (15.5, 5.0)
    assert (full.pct_rows_with_reused_trip_id, full.pct_rows_with_unparsed_trip_id) == (50.0, 50.0)
    assert (empty.vehicle_rows, empty.alert_rows, empty.distinct_trip_ids) == (0, 0, 0)
    assert empty.avg_ingest_lag_seconds is None and empty.pct_rows_with_reused_trip_id is None
    assert empty.seconds_since_previous_snapshot == 600 and empty.is_after_ingestion_gap


def test_a_failed_rebuild_leaves_the_marts_as_they_were(spark, tmp_path, monkeypatch):
    from headway.plans import build
    from headway.sources.tables import read_models

    root = str(tmp_path / "m")
    rebuild(spark, raw(spark, trains=[train("v")], fetches=[fetch()]), root)
    write = build.write_models

    def crash(models, folder):
        if "dq_ingestion_health" in models:
            raise OSError("lost")
        write(models, folder)

    monkeypatch.setattr(build, "write_models", crash)
    with pytest.raises(OSError):
        rebuild(spark, raw(spark, trains=[train("v"), train("w", "t")], fetches=[fetch()]), root)
    assert read_models(spark, root, MARTS)["fct_line_activity"].first().trains_running == 1
    monkeypatch.undo()
    rebuild(spark, raw(spark, trains=[train("v"), train("w", "t")], fetches=[fetch()]), root)
    assert read_models(spark, root, MARTS)["fct_line_activity"].first().trains_running == 2
    assert len(list((tmp_path / "m" / "versions").iterdir())) == 2
    for name in build.MARTS + ("stg_vehicle_positions", "stg_trip_stop_updates", "stg_alerts"):
        spark.catalog.dropTempView(name)


def test_rebuild_registers_every_model(spark, tmp_path):
    for name in MARTS:
        spark.catalog.dropTempView(name)
    assert missing_models(spark, MARTS) == list(MARTS)
    with pytest.raises(ModelsNotBuilt, match="fct_current_trains"):
        check_ready(spark, MARTS)
    models = rebuild(spark, raw(spark, trains=[train("v")], fetches=[fetch()]), str(tmp_path / "m"))
    check_ready(spark, models)
    assert spark.table("fct_line_activity").first().trains_running == 1
    assert spark.table("stg_vehicle_positions").filter(F.col("entity_id") == "v").count() == 1
    for name in models:
        spark.catalog.dropTempView(name)
