import pytest
from awkward import awkward, nothing
from pyspark.sql import functions as F

from tidemark.llm import mixing


def plain_targets(sizes, weights, share=1.0, epochs=3):
    """Targets by clamping one round after another."""
    total, clamped = sum(sizes.values()) * share, set()
    while True:
        used = sum(epochs * sizes[s] for s in clamped)
        free = sum(weights[s] for s in sizes if s not in clamped)
        level = (total - used) / free if free else 0
        more = {s for s in sizes if s not in clamped and level * weights[s] > epochs * sizes[s]}
        if not more:
            return {s: epochs * sizes[s] if s in clamped else level * weights[s] for s in sizes}
        clamped |= more


def table(spark, sizes, each=7):
    rows, doc = [], 0
    for source, size in sizes.items():
        while size > 0:
            n = min(size, 1 + doc % each)
            rows.append((doc, "w " * n, source))
            size, doc = size - n, doc + 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 3000, "b": 10, "c": 20, None: 40, "": 500},
        {"a": 100, "b": 100, "c": 100},
        {"only": 77},
        {f"s{i:02}": 10 * (i + 1) ** 2 for i in range(11)},
    ],
)
def test_targets_and_taken(spark, sizes):
    mixed = mixing.mix(table(spark, sizes)).collect()
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = plain_targets(sizes, {s: 1 + i % 3 for i, s in enumerate(ordered)})
    for source in sizes:
        rows = [r for r in mixed if r.source == source]
        taken = sum(r.size * r.repetitions for r in rows)
        assert {r.source_size for r in rows} == {sizes[source]}
        assert rows[0].target == pytest.approx(expected[source])
        assert abs(taken - expected[source]) <= 3.5  # half of the largest document
        assert max(r.repetitions for r in rows) <= 3
    assert sum({r.source: r.target for r in mixed}.values()) == pytest.approx(sum(sizes.values()))


def test_reruns_and_partitions_agree(spark, documents):
    once = mixing.mix(documents).select("doc_id", "repetitions")
    again = mixing.mix(documents.repartition(5, "text")).select("doc_id", "repetitions")
    assert once.exceptAll(again).isEmpty()
    other = mixing.mix(documents, seed=1).select("doc_id", "repetitions")
    assert not once.exceptAll(other).isEmpty()


def test_given_weights_share_and_epochs(spark):
    documents = table(spark, {"a": 1000, "b": 1000, "c": 50})
    weights = spark.createDataFrame([("a", 1.0), ("b", 4.0), ("d", 9.0)], "source string, weight double")
    rows = mixing.mix(documents, weights, share=0.5, max_epochs=1).collect()
    targets = {r.source: r.target for r in rows}
    assert targets == {"a": 205.0, "b": 820.0, "c": 0.0}
    assert {r.repetitions for r in rows if r.source == "c"} == {0}
    more = mixing.mix(documents, weights, share=9.0, max_epochs=2).collect()
    assert {r.source: r.target for r in more} == {"a": 2000.0, "b": 2000.0, "c": 0.0}


def test_weights_repeat_by_code_point(spark):
    names = ["b", "A", "ä", "a", "Z", None, "", "ｚ", "\U0001f600"]
    rows = spark.createDataFrame([(n,) for n in names], "source string")
    found = {r.source: r.weight for r in mixing.repeating_weights(rows).collect()}
    ordered = sorted((n for n in names if n is not None)) + [None]
    assert found == {n: 1 + i % 3 for i, n in enumerate(ordered)}


def test_repetitions_become_rows(spark):
    documents = table(spark, {"a": 300, "b": 10})
    mixed = mixing.mix(documents)
    rows = mixing.repeated(mixed)
    assert rows.count() == mixed.agg(F.sum("repetitions")).first()[0]
    assert rows.agg(F.max("repetition")).first()[0] == 3


def test_spark_expressions_only(spark, documents):
    plan = mixing.mix(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_awkward_rows(spark):
    documents = awkward(spark)
    mixed = mixing.mix(documents)
    rows = mixed.collect()
    assert len(rows) == 12
    assert {r.size for r in rows if r.text is None} == {0}
    taken = [r.repetitions for r in rows if r.doc_id == 4]  # equal rows are taken singly
    assert max(taken) - min(taken) <= 1
    assert set(documents.columns) <= set(mixed.columns)
    assert mixing.mix(nothing(spark)).count() == 0
    assert mixing.mix(documents.where("doc_id < 4")).agg(F.sum("target")).first()[0] == 0


@pytest.mark.parametrize("equal", [False, True])
def test_rows_without_id_are_dealt_out_singly(spark, equal):
    """A third of a source without ids, with different texts or all with the same one."""
    rows = [(i if i % 3 else None, "w " * (7 if equal and i % 3 == 0 else 1 + i % 9), "a") for i in range(600)]
    rows += [(1000 + i, "w " * 50, "b") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    mixed = mixing.mix(frame).where("source = 'a'")
    row = mixed.selectExpr("sum(size * repetitions) AS taken", "max(target) AS target", "max(size) AS largest").first()
    assert 0 < row.target % 1000 and abs(row.taken - row.target) <= row.largest / 2
    assert mixed.count() == 600
    again = mixing.mix(frame).where("source = 'a'")
    columns = ["doc_id", "size", "repetitions"]
    assert mixed.select(columns).exceptAll(again.select(columns)).isEmpty()


def test_some_of_equal_rows(spark):
    """All rows of a source are equal: as many as the target has room for are taken once more."""
    rows = [(None, "w " * 4, None)] * 90 + [(5, "w " * 30, "b")] * 4
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    for row in mixing.mix(frame).groupBy("source").agg({"target": "max", "size": "max", "repetitions": "sum"}).collect():
        assert abs(row["sum(repetitions)"] * row["max(size)"] - row["max(target)"]) <= row["max(size)"] / 2
