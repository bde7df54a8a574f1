"""Clipping, duplicates and enrichment."""

from conftest import at

from motorlytics.operators.quality import clip_readings, dedupe_readings, enrich_fleet
from motorlytics.sources.fleet import COMMERCIAL_MODELS, MODEL_CLASSES, load_fleet_config


def test_clip(bronze_rows):
    rows = bronze_rows([
        ("A", 0), ("A", 1, dict(rpm=7000.0, coolant_temp=20.0, battery_voltage=9.0, maf=-1.0, fuel_level=101.0)),
        ("A", 2, dict(vehicle_class="COMMERCIAL", rpm=7000.0, speed=120.0, battery_voltage=50.0)), ("A", 3, dict(rpm=None))])
    got = clip_readings(rows).orderBy("timestamp").collect()
    assert got[0]["out_of_bounds"] == 0 and got[0]["rpm"] == 800.0
    assert [got[1][c] for c in ("rpm", "coolant_temp", "battery_voltage", "maf", "fuel_level")] == [6500, 40, 10.5, 0, 100]
    assert got[1]["out_of_bounds"] == 5
    assert [got[2][c] for c in ("rpm", "speed", "battery_voltage")] == [4000, 100, 50] and got[2]["out_of_bounds"] == 2
    assert got[3]["rpm"] is None and got[3]["out_of_bounds"] == 0


def test_dedupe(bronze_rows):
    rows = bronze_rows([("A", 0, dict(rpm=1.0), 5), ("A", 0, dict(rpm=2.0), 3), ("A", 1, {}, 4), ("B", 0, {}, 1)])
    last = {(r["vehicle_id"], r["timestamp"]): r["rpm"] for r in dedupe_readings(rows).collect()}
    assert len(last) == 3 and last["A", at(0).replace(tzinfo=None)] == 1.0
    first = dedupe_readings(rows, keep="first").filter("vehicle_id = 'A'").orderBy("timestamp").first()
    assert first["rpm"] == 2.0 and first["seq"] == 3
    assert dedupe_readings(rows).columns == rows.columns


def test_enrich(bronze_rows):
    rows = bronze_rows([("A", 0, dict(vehicle_model="Tata Ace")), ("B", 0, dict(vehicle_model="Other"))])
    got = {r["vehicle_id"]: r for r in enrich_fleet(rows).collect()}
    assert (got["A"]["fleet_class"], got["A"]["max_rpm"]) == ("COMMERCIAL", 4000.0)
    assert (got["B"]["fleet_class"], got["B"]["max_rpm"]) == ("PASSENGER", 6500.0)


def test_fleet_config(tmp_path):
    assert len(MODEL_CLASSES) == 26 and len(COMMERCIAL_MODELS) == 6
    assert load_fleet_config()[1] is MODEL_CLASSES
    try:
        import yaml  # noqa: F401
    except ImportError:
        return
    path = tmp_path / "fleet.yaml"
    path.write_text("profiles:\n  PASSENGER: {max_rpm: 6000}\nmodels:\n  X: PASSENGER\n")
    assert load_fleet_config(str(path)) == ({"PASSENGER": {"max_rpm": 6000}}, {"X": "PASSENGER"})
