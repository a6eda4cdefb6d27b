"""Joined histories, snapshots, offset audits, profiles and clustered files, against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import rows_of, same
from pyspark.sql import functions as F

from tidemark.config import scratch_dir
from tidemark.operators import joins, offsets, profiles
from tidemark.operators.latest import state_at
from tidemark.sources import clustering, snapshots


def random_history(rng, keys, most=60, gap=0.3, end=400):
    """Versions (key, value, start, end) that do not overlap within a key; some stay open."""
    out = []
    for key in keys:
        at = rng.randrange(60)
        for _ in range(rng.randrange(1, most)):
            stop = at + rng.randrange(1, 30)
            if stop > end:
                out.append((key, rng.choice("pqr"), at, None))
                break
            out.append((key, rng.choice("pqr"), at, stop))
            at = stop + (rng.randrange(1, 20) if rng.random() < gap else 0)
    return out


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize(("max_versions", "rows_per_task"), [(32, None), (0, None), (0, 10)])
def test_history_join_equals_brute_force(spark, seed, max_versions, rows_per_task):
    """Overlaps, gaps on both sides, and left keys whose reference changes over time."""
    rng = random.Random(seed)
    left = [(k, rng.choice([0, 0, 1, 2, None]), v, s, e) for k, v, s, e in random_history(rng, range(12))]
    right = random_history(rng, range(3))
    expected = [
        (k, ref, v, w, max(s, t), min((x for x in (e, f) if x is not None), default=None))
        for k, ref, v, s, e in left
        for c, w, t, f in right
        if c == ref and (f is None or s < f) and (e is None or t < e)
    ]
    result = joins.history_join(
        spark.createDataFrame(left, "account INT, ref INT, v STRING, __START_AT INT, __END_AT INT"),
        spark.createDataFrame(right, "customer INT, w STRING, __START_AT INT, __END_AT INT"),
        ["account"],
        {"ref": "customer"},
        ["w"],
        rows_per_task,
        max_versions,
    )
    assert rows_of(result, "account", "ref", "v", "w", "__START_AT", "__END_AT") == sorted(expected, key=repr)


def test_history_join_refuses_clashing_columns(spark):
    one = spark.createDataFrame([(1, "a", 0, 1)], "k INT, v STRING, __START_AT INT, __END_AT INT")
    with pytest.raises(ValueError, match="both sides"):
        joins.history_join(one, one, ["k"], {"k": "k"}, ["v"])


LOG = (
    "k INT, v INT, operation_type STRING, operation_timestamp_ms BIGINT, kafka_partition INT, "
    "kafka_offset BIGINT, event_time TIMESTAMP, processing_timestamp TIMESTAMP"
)
START = datetime(2024, 1, 1)


def random_log(spark, seed, n=300, first=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        ms = rng.randrange(20 * 86_400_000)
        time = START + timedelta(milliseconds=ms)
        rows.append((rng.randrange(25), i, rng.choice("cuuud"), ms, 0, first + i, time, START))
    return spark.createDataFrame(rows, LOG)


def test_states_from_snapshots_equal_those_of_the_whole_log(spark):
    root = scratch_dir(spark, "snap")
    log = random_log(spark, 1)
    snapshots.store_by_day(log, f"{root}/log")
    stored = snapshots.Snapshots(spark, f"{root}/snap", f"{root}/log", "k")
    assert stored.moments() == [] and stored.outdated() == []
    for day in (4, 8, 12):
        stored.take(START + timedelta(days=day))
    for hours in (1, 95, 96, 97, 24 * 8, 24 * 12 + 5, 24 * 19, 24 * 30):
        moment = START + timedelta(hours=hours)
        expected = state_at(log, "k", F.lit(moment.isoformat(" ")).cast("timestamp"))
        assert same(stored.state_at(moment), expected), hours


def test_a_state_reads_the_days_after_its_snapshot_only(spark):
    root = scratch_dir(spark, "snap")
    snapshots.store_by_day(random_log(spark, 2), f"{root}/log")
    stored = snapshots.Snapshots(spark, f"{root}/snap", f"{root}/log", "k")
    stored.take(START + timedelta(days=10))
    state = stored.state_at(START + timedelta(days=12, hours=1))
    state.collect()
    plan = state._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters: [isnotnull(event_day" in line]
    assert filters and all(">= 2024-01-11" in f and "<= 2024-01-13" in f for f in filters)
    assert spark.read.parquet(f"{root}/log").select("event_day").distinct().count() == 20


def test_snapshots_that_late_events_outdate(spark):
    root = scratch_dir(spark, "snap")
    log = random_log(spark, 3)
    snapshots.store_by_day(log, f"{root}/log")
    stored = snapshots.Snapshots(spark, f"{root}/snap", f"{root}/log", "k")
    for day in (5, 15):
        stored.take(START + timedelta(days=day))
    assert stored.outdated() == []
    late = random_log(spark, 4, n=10, first=1000).withColumns(
        {
            "event_time": F.lit("2024-01-10 00:00:00").cast("timestamp"),
            "operation_timestamp_ms": F.lit(9 * 86_400_000).cast("bigint"),
            "processing_timestamp": F.lit("2999-01-01").cast("timestamp"),
        }
    )
    snapshots.store_by_day(late, f"{root}/log")
    (behind,) = stored.outdated()
    assert behind == stored.moments()[1]
    stored.take(START + timedelta(days=15))
    moment = START + timedelta(days=16)
    whole = state_at(log.unionByName(late), "k", F.lit(moment.isoformat(" ")).cast("timestamp"))
    assert same(stored.state_at(moment), whole)


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_offset_audit_equals_brute_force(spark, span):
    rng = random.Random(9)
    rows, expected, gaps = [], [], []
    for topic, part, many in (("a", 0, 400), ("a", 1, 30), (None, None, 20), ("b", 0, 1)):
        kept = sorted(rng.sample(range(-5 if topic == "b" else 0, 900), many))
        copies = {o: rng.choice([1, 1, 1, 3]) for o in kept}
        times = {o: START + timedelta(seconds=o + rng.choice([0, 0, 0, -50])) for o in kept}
        rows += [(topic, part, o, times[o]) for o in kept for _ in range(copies[o])]
        steps = list(zip(kept, kept[1:]))
        gaps += [(topic, part, x + 1, y - 1, y - x - 1) for x, y in steps if y > x + 1]
        behind = sum(times[o] < max(times[p] for p in kept[:i]) for i, o in enumerate(kept) if i)
        missing = kept[-1] - kept[0] + 1 - many
        expected.append((topic, part, kept[0], kept[-1], many, missing, sum(copies.values()) - many, behind))
    rng.shuffle(rows)
    schema = "kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, kafka_timestamp TIMESTAMP"
    log = spark.createDataFrame([*rows, ("a", 0, None, START)], schema)
    assert rows_of(offsets.offset_audit(log, span)) == sorted(expected, key=repr)
    assert rows_of(offsets.offset_gaps(log, span)) == sorted(gaps, key=repr)


def values(spark, days=6, rows=3000):
    return spark.range(days * rows).selectExpr(
        f"date_add(date'2024-03-01', cast(id div {rows} as int)) AS day",
        "CASE WHEN id % 10 > 0 THEN xxhash64(id) % 500 END AS n",
        f"cast(id % {rows} as double) + (id div {rows}) * 300 AS x",
        "cast(NULL as string) AS nothing",
    )


def test_daily_sketches_merge_to_the_months(spark):
    frame = values(spark)
    names = ["n", "x", "nothing"]
    daily = profiles.daily_profile(frame, F.col("day"), names)
    month = F.trunc("day", "month")
    merged = profiles.read_profile(profiles.merged_profile(daily, month))
    whole = profiles.read_profile(profiles.daily_profile(frame, month, names))
    assert rows_of(merged, "day", "column_name", "rows", "filled") == rows_of(whole, "day", "column_name", "rows", "filled")
    got = {r.column_name: r for r in merged.collect()}
    assert got["n"].distinct_values == pytest.approx(999, rel=0.05)
    assert got["n"].filled == 16_200 and got["nothing"].filled == got["nothing"].distinct_values == 0
    assert got["nothing"].quantiles is None
    exact = frame.agg(F.percentile("x", [0.05, 0.5, 0.95])).first()[0]
    assert got["x"].quantiles == pytest.approx(exact, abs=0.02 * 4500)


def test_drift_against_earlier_days(spark):
    frame = values(spark).withColumn("n", F.when(F.col("day") < F.lit("2024-03-06").cast("date"), F.col("n")))
    daily = profiles.daily_profile(frame, F.col("day"), ["n", "x"])
    found = {(r.day.day, r.column_name): r for r in profiles.drift(daily, days=3).collect()}
    assert found[1, "x"].median_rank is None and found[1, "n"].filled_change is None
    assert found[2, "x"].median_rank == pytest.approx(0.6, abs=0.03)  # numbers grow by a tenth a day
    assert found[2, "n"].filled_change == pytest.approx(0, abs=0.01)
    assert found[6, "n"].filled_change == pytest.approx(-0.9, abs=0.01) and found[6, "n"].distinct_ratio == 0


def groups_read(spark, path, condition):
    """Rows that a filtered scan hands on after leaving out row groups by their footers."""
    frame = spark.read.parquet(path).filter(condition)
    result = frame.collect()
    node = frame._jdf.queryExecution().executedPlan()
    while not node.nodeName().startswith("Scan parquet"):
        node = node.children().apply(0)
    return len(result), node.metrics().apply("numOutputRows").value()


def test_lookups_leave_out_most_of_clustered_files(spark):
    path = scratch_dir(spark, "clustered")
    rows = spark.range(200_000).selectExpr(
        "xxhash64(id) % 5000 AS k",
        "timestamp_seconds(1700000000 + (id * 7919) % 5000000) AS t",
        "id AS v",
    )
    clustering.write_clustered(rows, path, ["k", "t"], files=64, bloom=["k"])
    assert same(spark.read.parquet(path), rows)
    for condition in ("k = 77", "t between timestamp_seconds(1700000000) and timestamp_seconds(1700100000)"):
        found, read = groups_read(spark, path, condition)
        assert found == rows.filter(condition).count() and read < 60_000, condition
    both = "k between 100 and 150 and t < timestamp_seconds(1700200000)"
    found, read = groups_read(spark, path, both)
    assert found == rows.filter(both).count() and read < 15_000


def test_clustering_takes_nulls_ties_and_nothing(spark):
    rows = spark.createDataFrame([(1, START), (1, START), (None, None), (2, None)], "k BIGINT, t TIMESTAMP")
    for frame in (rows, rows.limit(0), rows.filter("k IS NULL")):
        path = scratch_dir(spark, "clustered")
        clustering.write_clustered(frame, path, ["k", "t"], files=3)
        assert same(spark.read.schema(rows.schema).parquet(path), frame)
    with pytest.raises(TypeError):
        clustering.with_place(rows.withColumn("k", F.lit("x")), ["k"])


def test_places_follow_the_steps_of_each_column(spark):
    rows = spark.range(1000).selectExpr("id AS k", "id % 10 AS t")
    placed = clustering.with_place(rows, ["k"]).orderBy("k").collect()
    steps = [r._place for r in placed]
    assert steps == sorted(steps) and steps[0] == 0 and steps[-1] == 255
    assert max(steps.count(s) for s in set(steps)) <= 8


def moved(spark, build):
    """Rows that all shuffles of a result's plan wrote, by the plan's own counters."""
    result = build()
    result.write.format("noop").mode("overwrite").save()
    plan = result._jdf.queryExecution().executedPlan()
    result.collect()
    total, waiting = 0, [plan]
    while waiting:
        node = waiting.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            waiting.append(node.plan())
            continue
        if name == "Exchange":
            written = node.metrics().get("shuffleRecordsWritten")
            total += written.get().value() if written.isDefined() else 0
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("max_versions", [32, 0])
def test_history_join_moves_versions_not_overlaps(spark, max_versions):
    """20 accounts of one customer, whose 1,000 versions each meet all of them: 20,000 overlaps and more."""
    left = [(k, 0, v, 50 * v + k, 50 * v + k + 50) for k in range(20) for v in range(20)]
    right = [(0, i, i, i + 1) for i in range(1000)]
    accounts = spark.createDataFrame(left, "account INT, ref INT, v INT, __START_AT INT, __END_AT INT")
    customers = spark.createDataFrame(right, "customer INT, w INT, __START_AT INT, __END_AT INT")

    def build():
        return joins.history_join(
            accounts, customers, ["account"], {"ref": "customer"}, ["w"], max_versions=max_versions
        )

    expected = sum(s < f and t < e for _, _, _, s, e in left for _, _, t, f in right)
    assert build().count() == expected > 19_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert moved(spark, build) < expected / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
