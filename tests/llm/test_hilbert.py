import random
from collections import Counter

import numpy as np
import pytest

from passagemill.llm import hilbert


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_curve_visits_neighbours(dimensions, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
    index = hilbert.hilbert_index(grid, bits)
    assert sorted(index) == list(range(len(grid)))
    assert set(np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(axis=1)) == {1}


def rows(n=1000):
    rng = random.Random(11)
    return [(i, rng.choice(["en", "de", None]), "hot" if i % 3 else f"s{rng.randrange(30)}", rng.choice([None, 5, rng.randrange(9999)]), 1, 2) for i in range(n)]


SCHEMA = "doc_id long, lang string, source string, n_chars long, shard int, place int"


@pytest.mark.parametrize("n", [1000, 1001, 1007, 5, 1])
def test_shards_are_runs_of_the_curve(spark, n):
    table = spark.createDataFrame(rows(n), SCHEMA).repartition(6)
    found = sorted(hilbert.shard_rows(table, ["lang", "source", "n_chars"], 8, "doc_id").collect(), key=lambda r: (r.shard, r.slot))
    assert sorted(r.doc_id for r in found) == list(range(n))
    counts = Counter(r.shard for r in found)
    assert set(counts) <= set(range(8)) and max(counts.values()) - min(counts.get(s, 0) for s in range(8)) <= 1
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(c)) for s, c in counts.items())
    order = [(r.curve_index, r.doc_id) for r in found]
    assert order == sorted(order)


def test_index_follows_the_cells(spark):
    table = spark.createDataFrame(rows(), SCHEMA)
    for r in hilbert.shard_rows(table, ["n_chars"], 3, "doc_id", bits=4).where("n_chars IS NULL").collect():
        assert r.curve_index == 0
    found = hilbert.shard_rows(table, ["n_chars"], 3, "doc_id", bits=4).where("n_chars IS NOT NULL").collect()
    pairs = sorted((r.n_chars, r.curve_index) for r in found)
    assert [i for _, i in pairs] == sorted(i for _, i in pairs)


def test_shards_can_be_pruned(spark, tmp_path):
    table = spark.createDataFrame([(i, f"l{i % 16:02d}", f"common_crawl_20{i // 16 % 16:02d}", i // 256, 0, 0) for i in range(4096)], SCHEMA)
    sharded = hilbert.shard_rows(table, ["lang", "source", "n_chars"], 64, "doc_id", bits=4)
    for column in ("lang", "source", "n_chars"):
        spans = sharded.groupBy("shard").agg({column: "min"}).join(sharded.groupBy("shard").agg({column: "max"}), "shard").collect()
        values = sorted({r[column] for r in table.select(column).distinct().collect()})
        touched = sum(lo <= values[5] <= hi for _, lo, hi in spans)
        assert touched <= 20, column  # 16 of 64 with three dimensions of 16 values
    hilbert.write_shards(sharded, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).where("shard = 3").count() == 64


def test_repeated_rows_and_empty_table(spark):
    table = spark.createDataFrame([(1, "a", "s", 1, 0, 0)] * 5 + [(None, None, None, None, 0, 0)], SCHEMA)
    assert sorted((r.shard, r.slot) for r in hilbert.shard_rows(table, ["lang", "n_chars"], 3, "doc_id").collect()) == [(s, k) for s in range(3) for k in range(2)]
    assert hilbert.shard_rows(table.where("doc_id > 5"), ["lang"], 3, "doc_id").collect() == []
    with pytest.raises(ValueError):
        hilbert.shard_rows(table, ["lang"] * 8, 3, "doc_id")


def test_index_of_a_table_equals_plain_cells(spark):
    table = [(i, rng.choice(["a" * 9 + c for c in "bcdé"] + [None]), "s", rng.choice([None, 3, rng.randrange(50)]), 0, 0) for rng in [random.Random(2)] for i in range(400)]
    found = {r.doc_id: r.curve_index for r in hilbert.shard_rows(spark.createDataFrame(table, SCHEMA).repartition(3), ["lang", "n_chars"], 4, "doc_id", bits=3).collect()}

    def cells(values):
        known = sorted(v for v in values if v is not None)
        below = {v: known.index(v) for v in set(known)}
        return known, below

    known, below = cells([r[1] for r in table])
    text = {v: n * 8 // len(known) for v, n in below.items()}
    numbers = sorted(float(r[3]) for r in table if r[3] is not None)
    cuts = [numbers[max(0, -(-k * len(numbers) // 8) - 1)] for k in range(1, 8)]
    for doc_id, lang, _, n, _, _ in table:
        pair = [0 if lang is None else text[lang], 0 if n is None else sum(c <= n for c in cuts)]
        assert found[doc_id] == hilbert.hilbert_index(np.array([pair]), 3)[0], (lang, n)
