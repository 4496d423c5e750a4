"""Distributed positions and running totals against plain Python."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from passagemill.operators.ordering import number_rows, running_totals


def table(n, seed=5):
    rng = random.Random(seed)
    return [(rng.choice(["hot", "hot", "hot", "a", "b", "c"]), rng.randrange(10 * n + 1), rng.choice([None, 1, 2, 7])) for _ in range(n)]


@pytest.mark.parametrize("n", [0, 1, 700])
@pytest.mark.parametrize("within", [(), ("g",)])
def test_positions(spark, n, within):
    df = spark.createDataFrame(table(n), "g string, k long, v long").repartition(5)
    rows = [r.asDict() for r in number_rows(df, ["k"], within).collect()]
    assert sorted((r["g"], r["k"], r["v"] or 0) for r in rows) == sorted((g, k, v or 0) for g, k, v in table(n))
    key = (lambda r: r["g"]) if within else (lambda r: 0)
    for _, group in groupby(sorted(rows, key=key), key):
        group = sorted(group, key=lambda r: r["position"])
        assert [r["position"] for r in group] == list(range(len(group)))
        assert [r["k"] for r in group] == sorted(r["k"] for r in group)


@pytest.mark.parametrize("n", [0, 1, 700])
def test_running_totals(spark, n):
    rows = [(g, i, v) for i, (g, _, v) in enumerate(table(n))]
    found = running_totals(spark.createDataFrame(rows, "g string, k long, v long").repartition(4), ["k"], ["v"], ["g"])
    want, sums = [], {}
    for g, k, v in rows:
        want.append((g, k, v, sums.get(g, 0)))
        sums[g] = sums.get(g, 0) + (v or 0)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == want


def test_no_window_over_all_rows_and_a_hot_group_in_many_tasks(spark):
    df = spark.range(4000).select(F.lit("hot").alias("g"), F.col("id").alias("k"), F.lit(1).alias("v"))
    plan = running_totals(df, ["k"], ["v"], ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_part" in plan and "windowspecdefinition(k" not in plan
