"""Plain-Python silver for small fixtures: one loop per vehicle, no Spark."""

from __future__ import annotations

MEANS = ["coolant_temp", "rpm", "battery_voltage", "maf", "throttle_position"]


def silver(rows, zero_base=False):
    """``rows``: dicts with bronze columns and ``seq``. Returns {seq: features}."""
    out, by_vehicle = {}, {}
    for row in rows:
        by_vehicle.setdefault(row["vehicle_id"], []).append(row)
    for history in by_vehicle.values():
        history.sort(key=lambda r: (r["timestamp"], r["seq"]))
        session = 0
        for i, row in enumerate(history):
            previous = history[i - 1] if i else None
            gap = None if previous is None else row["timestamp"] - previous["timestamp"]
            start = int(gap is None or gap.total_seconds() * 1e6 > 300e6)
            session += start
            last10, last20 = history[max(0, i - 9): i + 1], history[max(0, i - 19): i + 1]
            features = {"is_session_start": start, "session_id": session,
                        "rolling_anomaly_count": sum(r["anomaly_flag"] for r in last20)}
            for name in MEANS:
                values = [r[name] for r in last10 if r[name] is not None]
                features[f"rolling_avg_{name}"] = sum(values) / len(values) if values else None
            base = previous["coolant_temp"] if previous else (0.0 if zero_base else None)
            now = row["coolant_temp"]
            features["coolant_temp_delta"] = None if base is None or now is None else now - base
            out[row["seq"]] = features
    return out


def same(df, expected):
    """Compare a silver DataFrame with ``silver`` above, value by value."""
    got = {r["seq"]: r.asDict() for r in df.collect()}
    assert got.keys() == expected.keys()
    for seq, features in expected.items():
        for name, value in features.items():
            actual = got[seq][name]
            assert (actual == value) or abs(actual - value) < 1e-9, (seq, name, actual, value)
