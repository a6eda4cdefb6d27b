"""Latest rows, type 1 and type 2 dimensions, against rules and brute force."""

import random
from datetime import datetime

import pytest
from helpers import rows_of, same
from pyspark.sql import functions as F

from tidemark.operators import scd
from tidemark.operators.latest import latest_per_key, state_at
from tidemark.operators.skew import OVERSPLIT, fill_from_earlier, split_hot_keys

COLUMNS = "k INT, seq BIGINT, off BIGINT, op STRING, city STRING, note STRING"
OPTIONS = dict(
    keys=["k"],
    sequence_by="seq",
    tracked=["city"],
    delete_when="op = 'd'",
    except_cols=["op", "off", "seq"],
    tie_break=["off"],
)


def history(spark, rows, **more):
    return scd.scd2_apply(spark.createDataFrame(rows, COLUMNS), **{**OPTIONS, **more})


def versions(df):
    return rows_of(df, "k", "city", "note", "__START_AT", "__END_AT")


def brute_force(rows):
    """Walks each key's changes in order."""
    out = []
    for k in sorted({r[0] for r in rows}):
        newest = {}
        for r in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])):
            newest[r[1]] = r
        open_version = None
        for seq in sorted(newest):
            _, _, _, op, city, note = newest[seq]
            if open_version and op != "d" and open_version[1] == city:
                open_version[2] = note
                continue
            if open_version:
                open_version[4] = seq
                out.append(tuple(open_version))
            open_version = None if op == "d" else [k, city, note, seq, None]
        if open_version:
            out.append(tuple(open_version))
    return sorted(out, key=repr)


def test_delete_closes_and_reinsert_opens(spark):
    rows = [
        (1, 10, 0, "c", "A", "x"),
        (1, 20, 1, "d", None, None),
        (1, 30, 2, "c", "A", "y"),
    ]
    assert versions(history(spark, rows)) == [(1, "A", "x", 10, 20), (1, "A", "y", 30, None)]


def test_untracked_change_updates_in_place(spark):
    rows = [(1, 10, 0, "c", "A", "x"), (1, 20, 1, "u", "A", "y"), (1, 30, 2, "u", "B", "z")]
    assert versions(history(spark, rows)) == [(1, "A", "y", 10, 30), (1, "B", "z", 30, None)]


def test_null_is_a_value(spark):
    rows = [(1, 10, 0, "c", None, "x"), (1, 20, 1, "u", None, "y"), (1, 30, 2, "u", "B", "z")]
    assert versions(history(spark, rows)) == [(1, "B", "z", 30, None), (1, None, "y", 10, 30)]


def test_tie_goes_to_the_greater_offset(spark):
    rows = [(1, 10, 0, "c", "A", "x"), (1, 10, 1, "u", "B", "y")]
    assert versions(history(spark, rows)) == [(1, "B", "y", 10, None)]


def test_delete_first_and_repeated_deletes(spark):
    rows = [(1, 5, 0, "d", None, None), (1, 10, 1, "c", "A", "x"), (1, 20, 2, "d", None, None),
            (1, 25, 3, "d", None, None)]
    assert versions(history(spark, rows)) == [(1, "A", "x", 10, 20)]


def test_rows_without_key_or_sequence_are_left_out(spark):
    rows = [(None, 10, 0, "c", "A", "x"), (1, None, 1, "c", "A", "x"), (1, 7, 2, "c", "A", "x")]
    assert versions(history(spark, rows)) == [(1, "A", "x", 7, None)]


def test_without_tie_break_the_result_does_not_depend_on_row_order(spark):
    rows = [(1, 10, 0, "c", "A", "x"), (1, 10, 0, "c", "B", "y"), (1, 20, 1, "u", "C", "z")]
    first = versions(history(spark, rows, tie_break=()))
    assert first == versions(history(spark, rows[::-1], tie_break=()))
    assert len(first) == 2


def random_rows(seed, n=400, keys=12, hot=False):
    rng = random.Random(seed)
    rows = []
    for off in range(n):
        k = 0 if hot and rng.random() < 0.4 else rng.randrange(keys)
        op = rng.choice("cuuud")
        city = None if op == "d" else rng.choice(["A", "B", None])
        # bunched times: most lie close together, one lies far off
        seq = 0 if off == 0 else 10_000_000 + rng.randrange(n)
        rows.append((k, seq, off, op, city, f"n{off}"))
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("rows_per_task", [None, 2_000_000, 30, 2])
def test_history_equals_brute_force(spark, seed, rows_per_task):
    rows = random_rows(seed, hot=True)
    result = history(spark, rows + rows[::3], rows_per_task=rows_per_task)
    assert versions(result) == brute_force(rows)


@pytest.mark.parametrize("others", [0, 40])
def test_a_pile_of_copies_counts_once(spark, others):
    pile = [(0, 7, off, "u", "A", f"n{off}") for off in range(100)]
    rest = [(0, 8 + i, 100 + i, "u", "AB"[i % 2], "m") for i in range(others)]
    result = history(spark, pile + rest, rows_per_task=10)
    assert versions(result) == brute_force(pile + rest)


def test_interval_properties(spark):
    result = history(spark, random_rows(99, n=600))
    w = "PARTITION BY k ORDER BY __START_AT"
    checked = result.selectExpr(
        "*",
        f"lead(__START_AT) OVER ({w}) AS next_start",
        f"lead(city) OVER ({w}) AS next_city",
    )
    overlap = checked.filter("next_start IS NOT NULL AND (__END_AT IS NULL OR __END_AT > next_start)")
    assert overlap.isEmpty()
    assert checked.filter("__END_AT = next_start AND city <=> next_city").isEmpty()
    assert scd.current(result).groupBy("k").count().filter("count > 1").isEmpty()


def test_as_of_and_current(spark):
    rows = [(1, 10, 0, "c", "A", "x"), (1, 20, 1, "u", "B", "y")]
    result = history(spark, rows)
    assert rows_of(scd.as_of(result, F.lit(19)), "city") == [("A",)]
    assert rows_of(scd.as_of(result, F.lit(20)), "city") == [("B",)]
    assert scd.as_of(result, F.lit(9)).isEmpty()
    assert rows_of(scd.current(result), "city") == [("B",)]


def test_slices_follow_the_order_whatever_the_times(spark):
    rows = [(0, 0)] + [(0, 1_000_000 + i) for i in range(300)] + [(k, 5) for k in range(1, 9)]
    rows += [(9, 10**15), (9, -(10**15)), *[(9, i % 50) for i in range(200)]]
    df = spark.createDataFrame(rows, "k INT, t BIGINT")
    sliced, part, piled = split_hot_keys(df, ["k"], "t", rows_per_task=20)
    assert not piled and part == ["k", "_slice"]
    sizes = sliced.filter("_slice IS NOT NULL").groupBy(*part).count().agg(F.max("count")).first()[0]
    assert sizes <= 20
    for key in (0, 9):
        found = sliced.filter(F.col("k") == key).orderBy("t").select("t", "_slice").collect()
        assert [r[1] for r in found] == sorted(r[1] for r in found)
        assert len({r[1] for r in found}) > 5
        assert len({tuple(r) for r in found}) == len({r[0] for r in found})  # one slice per time
    assert sliced.filter("k between 1 and 8").select("_slice").distinct().collect() == [(None,)]
    assert sliced.count() == len(rows)


def test_any_number_of_heavy_keys_stays_a_table(spark):
    df = spark.range(3000).selectExpr("id % 1000 AS k", "id AS t")
    sliced, part, _ = split_hot_keys(df, ["k"], "t", rows_per_task=2)
    assert len(part) == 2 and sliced.filter("_slice IS NULL").isEmpty() and sliced.count() == 3000
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan and "TakeOrdered" not in plan and "GlobalLimit" not in plan


def test_slices_stay_within_the_sessions_tasks(spark):
    """However small the wanted slices, tasks and files follow the session, and keys are still cut."""
    df = spark.range(20_000).selectExpr("id % 7 AS k", "id AS t")
    sliced, part, _ = split_hot_keys(df, ["k"], "t", rows_per_task=2)
    bound = OVERSPLIT * max(8, spark.sparkContext.defaultParallelism)
    assert 20 < sliced.select("_slice").distinct().count() <= bound
    assert len(sliced.filter("_slice IS NOT NULL").inputFiles()) <= bound
    assert sliced.select(*part).distinct().groupBy("k").count().agg(F.min("count")).first()[0] > 2


def test_no_heavy_key_leaves_the_frame_alone(spark):
    df = spark.createDataFrame([(1, 1)], "k INT, t BIGINT")
    same_df, part, piled = split_hot_keys(df, ["k"], "t")
    assert same_df is df and part == ["k"] and not piled
    with pytest.raises(TypeError):
        split_hot_keys(df.withColumn("t", F.lit("x")), ["k"], "t")


@pytest.mark.parametrize("include_current", [True, False])
def test_fill_from_earlier_across_slices(spark, include_current):
    rng = random.Random(5)
    rows = [
        (0 if i % 3 else i % 7, i * 1000 if i % 11 else i, i, rng.choice([None, None, f"v{i}"]))
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "k INT, t BIGINT, id INT, v STRING")
    whole = fill_from_earlier(df, ["k"], ["k"], ["t", "id"], "v", "f", include_current)
    cut, part, _ = split_hot_keys(df, ["k"], "t", rows_per_task=15)
    assert len(part) > 1
    pieces = fill_from_earlier(cut, ["k"], part, ["t", "id"], "v", "f", include_current)
    assert same(whole.select("id", "f"), pieces.select("id", "f"))


LOG = "k INT, operation_timestamp_ms BIGINT, kafka_partition INT, kafka_offset BIGINT, " \
      "operation_type STRING, event_time TIMESTAMP"


def test_latest_and_state_at(spark):
    at = [datetime(2024, 1, d) for d in range(1, 6)]
    rows = [
        (1, 1, 0, 0, "c", at[0]),
        (1, 2, 0, 1, "u", at[1]),
        (1, 2, 0, 2, "d", at[1]),
        (2, 9, 0, 3, "r", at[4]),
        (3, None, 0, 4, "c", None),
        (3, 1, 0, 5, "u", at[0]),
    ]
    log = spark.createDataFrame(rows, LOG)
    doubled = log.unionByName(log).orderBy(F.rand(1))
    assert rows_of(latest_per_key(doubled, "k"), "k", "kafka_offset") == [(1, 2), (2, 3), (3, 5)]
    assert rows_of(latest_per_key(log, "k", live=True), "k") == [(2,), (3,)]
    then = F.lit(datetime(2024, 1, 1, 12)).cast("timestamp")
    assert rows_of(state_at(log, "k", then), "k", "kafka_offset") == [(1, 0), (3, 5)]


def test_scd1_drops_deleted_keys(spark):
    log = spark.createDataFrame(
        [(1, 1, 0, 0, "c", None), (1, 2, 0, 1, "d", None), (2, 1, 0, 2, "c", None)], LOG
    )
    assert rows_of(scd.scd1_apply(log, "k"), "k") == [(2,)]
