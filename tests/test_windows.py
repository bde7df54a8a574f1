"""Silver features: frames, sessions, first rows, and histories cut into runs."""

import random
from collections import Counter

import pytest
from brute import same, silver as brute_silver
from conftest import at
from pyspark.sql import functions as F

from motorlytics.operators.runs import RUN, in_runs
from motorlytics.operators.windows import latest_state, sessions, silver_telemetry
from motorlytics.schemas import SILVER_COLUMNS


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


def fleet(seed, vehicles=6, rows=400, hot_share=0.5, ties=True):
    """Random readings; vehicle V0 holds ``hot_share`` of them, and some times repeat."""
    rng = random.Random(seed)
    out, clock = [], {}
    for _ in range(rows):
        vehicle = "V0" if rng.random() < hot_share else f"V{rng.randrange(1, vehicles)}"
        step = rng.choice([0.0 if ties else 1.0, 1.0, 10.0, 299.999, 300.0, 300.001, 900.0])
        clock[vehicle] = clock.get(vehicle, 0.0) + step
        changes = dict(
            coolant_temp=rng.choice([None, 80.5, 90.25, 121.5]), rpm=float(rng.randrange(600, 7000)),
            battery_voltage=rng.choice([12.5, 14.0]), maf=rng.choice([0.5, 5.0]), anomaly_flag=rng.randrange(2))
        out.append((vehicle, clock[vehicle], changes))
    numbers = list(range(len(out)))
    rng.shuffle(numbers)  # the tiebreaker is not the arrival order
    return [(*row, number) for row, number in zip(out, numbers)]


def test_session_gap_is_strict(bronze_rows):
    rows = bronze_rows([("A", 0), ("A", 299.999), ("A", 599.999), ("A", 900.0)])
    got = [r["session_id"] for r in silver_telemetry(rows).orderBy("timestamp").collect()]
    assert got == [1, 1, 1, 2]


def test_first_row(bronze_rows):
    rows = bronze_rows([("A", 0), ("A", 1)])
    first = silver_telemetry(rows).orderBy("timestamp").first()
    assert (first["is_session_start"], first["session_id"], first["coolant_temp_delta"]) == (1, 1, None)
    based = silver_telemetry(rows, first_delta="zero_base").orderBy("timestamp").collect()
    assert [r["coolant_temp_delta"] for r in based] == [90.0, 0.0]
    with pytest.raises(ValueError):
        silver_telemetry(rows, first_delta="zero")


def test_frames(bronze_rows):
    rows = bronze_rows([("A", i, dict(rpm=float(i), anomaly_flag=1)) for i in range(25)])
    got = silver_telemetry(rows).orderBy("timestamp").collect()
    assert got[4]["rolling_avg_rpm"] == 2.0 and got[24]["rolling_avg_rpm"] == 19.5
    assert [got[i]["rolling_anomaly_count"] for i in (0, 18, 19, 24)] == [1, 19, 20, 20]
    assert tuple(got[0].asDict()) == SILVER_COLUMNS


@pytest.mark.parametrize("zero_base", [False, True])
@pytest.mark.parametrize("limit", [None, 60, 7])
def test_equals_plain_loop(bronze_rows, limit, zero_base):
    rows = bronze_rows(fleet(seed=limit or 0))
    expected = brute_silver(as_dicts(rows), zero_base)
    got = silver_telemetry(rows, keep=("seq",), rows_per_task=limit, first_delta="zero_base" if zero_base else "null")
    same(got, expected)


@pytest.mark.parametrize("limit", [None, 9])
def test_continues_from_seeds(bronze_rows, limit):
    rows = bronze_rows(fleet(seed=3, ties=False))
    full = silver_telemetry(rows, keep=("seq",)).cache()
    split = rows.agg(F.percentile(F.unix_micros("timestamp"), 0.4)).first()[0]
    is_old = F.unix_micros("timestamp") <= split
    seeds = latest_state(full.filter(is_old))
    assert seeds.agg(F.max(F.size("tail"))).first()[0] == 19
    got = silver_telemetry(rows.filter(~is_old), seeds=seeds, keep=("seq",), rows_per_task=limit)
    assert sorted(map(str, got.collect())) == sorted(map(str, full.filter(~is_old).collect()))


def test_copies_of_one_row_spread_over_runs(bronze_rows, spark):
    """A third and more of the rows are one reading, repeated; no sequence number tells them apart."""
    rows = bronze_rows([("A", i) for i in range(50)] + [("B", i) for i in range(40)], with_seq=False)
    copies = bronze_rows([("A", 25)], with_seq=False).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(100)))).drop("n")
    rows = rows.unionByName(copies)
    plain = silver_telemetry(rows, rows_per_task=None)
    split = silver_telemetry(rows, rows_per_task=20)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
    assert split.count() == 190


def test_input_order_does_not_matter(bronze_rows):
    data = fleet(seed=11)
    shuffled = data[:]
    random.Random(1).shuffle(shuffled)
    one, two = (silver_telemetry(bronze_rows(d), keep=("seq",)) for d in (data, shuffled))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_trips(bronze_rows):
    rows = bronze_rows([("A", 0), ("A", 100, dict(anomaly_flag=1)), ("A", 1000), ("B", 5)])
    got = {(r["vehicle_id"], r["session_id"]): r for r in sessions(silver_telemetry(rows)).collect()}
    assert set(got) == {("A", 1), ("A", 2), ("B", 1)}
    assert (got["A", 1]["readings"], got["A", 1]["anomalies"]) == (2, 1)
    assert got["A", 1]["ended_at"] == at(100).replace(tzinfo=None)


def test_short_runs_share_partitions(spark, bronze_rows):
    """Three hundred runs of ten rows: files follow the rows, and runs are whole, bounded and in order of (vehicle, time)."""
    data = [("AB"[k % 2], 60.0 * (k // 4), {}, k) for k in range(3000)]
    stored = in_runs(bronze_rows(data[::-1]).repartition(5), ["vehicle_id"], ["timestamp", "seq"], 3000, 10)
    assert len(stored.inputFiles()) <= spark.sparkContext.defaultParallelism
    rows = sorted((r["vehicle_id"], r["timestamp"], r["seq"], r[RUN]) for r in stored.collect())
    assert len(rows) == 3000 and [r[3] for r in rows] == sorted(r[3] for r in rows)
    sizes = Counter(r[3] for r in rows)
    assert max(sizes.values()) <= 10 and 300 <= len(sizes) <= 300 + spark.sparkContext.defaultParallelism


def test_copies_of_one_row_spread_over_runs(spark, bronze_rows):
    stored = in_runs(bronze_rows([("A", 0, {}, 1)] * 500), ["vehicle_id"], ["timestamp", "seq"], 500, 20)
    assert max(r["count"] for r in stored.groupBy(RUN).count().collect()) <= 20
