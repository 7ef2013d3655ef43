from __future__ import annotations

from pathlib import Path

import pytest

from headway.operators.landing import land_next
from headway.plans import check_store, drift_store, marts, staging
from headway.plans.build import check_models, rebuild
from headway.schemas import REUSED_IDS
from headway.sources.tables import compact_day, read_models, read_raw
from tests.builders import HEADER, default_payload, payloads

DAY = 86_400


def rows(df):
    columns = sorted(df.columns)
    return sorted(map(str, df.select(columns).collect()))


def trip(service, seconds, arrival):
    """An update of one trip of a service day, published ``seconds`` after the first header."""
    entity = {
        "id": "u",
        "trip_update": {
            "trip": {"trip_id": "041300_5..N07R", "route_id": "5", "start_date": service},
            "stop_time_update": [{"stop_id": s, "arrival": HEADER + arrival + n} for n, s in enumerate(("101N", "103N"))],
        },
    }
    return default_payload(HEADER + seconds, entities=[entity]), seconds


@pytest.fixture
def roots(tmp_path):
    return str(tmp_path / "lake"), str(tmp_path / "models")


def test_only_new_days_are_read(spark, roots, monkeypatch):
    lake, models = roots
    read: list[list[str]] = []
    refresh = drift_store.refresh
    monkeypatch.setattr(drift_store, "refresh", lambda *args: read.append(refresh(*args)))

    def rebuilt():
        built = rebuild(spark, read_raw(spark, lake), models, landed_root=lake)["fct_prediction_drift"]
        assert rows(built) == rows(marts.fct_prediction_drift(read_raw(spark, lake)))
        return built

    land_next(payloads(spark, trip("20250314", 0, 4000), trip("20250314", 600, 4700), trip("", 900, 4700)), lake)
    assert rebuilt().count() == 2
    # Nothing new: nothing is read.
    before = sorted(Path(models, "drift").rglob("*.parquet"))
    assert rebuilt().count() == 2 and sorted(Path(models, "drift").rglob("*.parquet")) == before
    # A day later: that trip is still seen, and one of the next service day.
    land_next(payloads(spark, trip("20250314", DAY, DAY + 9000), trip("20250315", DAY + 60, DAY + 4000), trip("20250315", DAY + 90, DAY + 4200)), lake)
    assert rebuilt().count() == 4
    compact_day(spark, lake, "raw_trip_stop_updates", "2025-03-14")
    # A late snapshot of the first day changes a trip of that service day only.
    land_next(payloads(spark, trip("20250314", 300, 4500)), lake)
    assert rebuilt().count() == 4
    assert read == [["2025-03-14"], [], ["2025-03-15"], ["2025-03-14"]]
    # The folders that no version of the last two names are gone.
    assert len(list(Path(models, "drift", "rows").iterdir())) <= 4
    assert read_models(spark, models, ["fct_prediction_drift"])["fct_prediction_drift"].count() == 4


def test_a_refresh_that_fails_changes_nothing(spark, roots, monkeypatch):
    lake, models = roots
    land_next(payloads(spark, trip("20250314", 0, 4000), trip("20250314", 600, 4700)), lake)
    rebuild(spark, read_raw(spark, lake), models, landed_root=lake)
    land_next(payloads(spark, trip("20250315", DAY, DAY + 4000), trip("20250315", DAY + 60, DAY + 4400)), lake)

    def crash(*args):
        raise OSError("disk full")

    with monkeypatch.context() as patched:
        patched.setattr(drift_store, "_rebuild", crash)
        with pytest.raises(OSError):
            rebuild(spark, read_raw(spark, lake), models, landed_root=lake)
    name = "fct_prediction_drift"
    assert read_models(spark, models, [name])[name].count() == 2
    assert rebuild(spark, read_raw(spark, lake), models, landed_root=lake)[name].count() == 4


def test_drift_of_nothing(spark, roots):
    lake, models = roots
    built = rebuild(spark, read_raw(spark, lake), models, landed_root=lake)["fct_prediction_drift"]
    assert built.count() == 0
    assert set(marts.fct_prediction_drift(read_raw(spark, lake)).columns) <= set(built.columns)


def test_checks_look_at_new_days_only(spark, roots):
    lake, models = roots

    def report():
        raw = read_raw(spark, lake)
        built = rebuild(spark, raw, models, landed_root=lake)
        days = check_store.count_days(spark, lake, models)[1]
        got = rows(check_store.check_landed(spark, lake, models, raw, built))
        assert got == rows(check_models(raw, built))
        return days, got

    land_next(payloads(spark, (default_payload(), 0), trip("20250314", 600, 4700)), lake)
    first, clean = report()
    # A train without a route, and one trip twice in the newest snapshot.
    twins = [{"id": f"v{i}", "vehicle": {"trip": {"trip_id": "t"}, "stop_id": "101N", "current_status": 1}} for i in (1, 2, 2)]
    land_next(payloads(spark, (default_payload(HEADER + DAY, entities=twins), DAY)), lake)
    second, broken = report()
    assert (first, second) == (["2025-03-14"], ["2025-03-15"]) and broken != clean
    assert report()[0] == []


def test_landed_staging_equals_that_of_any_tables(spark, roots):
    lake, _ = roots
    twins = [{"id": f"v{i}", "vehicle": {"trip": {"trip_id": t}, "stop_id": "101N"}} for i, t in enumerate(("a", "", "b", "a", "", "c"))]
    land_next(payloads(spark, (default_payload(entities=twins), 0), (default_payload(HEADER + DAY), DAY), (default_payload(0), 5)), lake)
    raw = read_raw(spark, lake)
    landed = staging.stg_vehicle_positions(raw.vehicles, raw.audit)
    plain = staging.stg_vehicle_positions(raw.vehicles, raw.fetches.drop(REUSED_IDS))
    assert landed.columns == plain.columns and rows(landed) == rows(plain)
    assert landed.filter("has_reused_trip_id").count() == 4
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3 and plan.count("Exchange hashpartitioning") <= 3
