"""Parsing, join, split and record formatting."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from passagemill import schemas
from passagemill.operators.conversations import format_conversations
from passagemill.operators.parse import marker_lines, parse_lines, parse_sources, source_rejects
from passagemill.operators.relate import (
    attach_sources, fits_broadcast, hot_in_sketches, id_sketch, number_copies, ordered_merge, pack_sources,
)
from passagemill.operators.split import exact_split, label_split, shuffle_key
from passagemill.plans.job import assemble
from passagemill.sinks import in_shuffled_order


def test_parse_lines(spark):
    values = ["@@1 one", "  @@2 two \n", "@@4", "@@ five", "@@@ 5 z", "@@3\tthree x", "no", "@ @7 x", "@@6  two blanks", "@@8 "]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    got = [tuple(r) for r in parse_lines(marker_lines(df)).select("id", "content").collect()]
    assert got == [("1", "one"), ("2", "two"), ("", "five"), ("@", "5 z"), ("3\tthree", "x"), ("6", " two blanks")]


def test_parse_sources(spark):
    values = ["1  100 FIC 1990 COCA Title pub info  here", "1\t2 3 4 5 6 7", "1 100 FIC 1990 SRC Title", "", " \t",
              " 1 2 3 4 5 6 7  x \n", "x" * 100]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert [tuple(r) for r in parse_sources(df).collect()] == [
        ("1", "100", "FIC", "1990", "COCA", "Title", "pub info  here"),
        ("1", "2", "3", "4", "5", "6", "7"),
        ("1", "2", "3", "4", "5", "6", "7  x"),
    ]
    assert [tuple(r) for r in source_rejects(df).collect()] == [("1 100 FIC 1990 SRC Title", 6), ("x" * 80, 1)]


CONTENT = "id string, content string, file string, file_order long, line_num long, sequence long"


def hot_tables(spark):
    """A third of the lines, and a third of the sources, share one id each."""
    content = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "warm").otherwise((F.col("id") % 40).cast("string")).alias("id"),
        F.concat(F.lit("text "), F.col("id")).alias("content"), F.lit("f").alias("file"), F.lit(0).cast("long").alias("file_order"),
        F.col("id").alias("line_num"), F.col("id").alias("sequence"),
    )
    names = ["hot", "hot"] + ["warm"] * 20 + [str(i) for i in range(0, 60, 2)] + ["none"]
    rows = [(n, str(i), "g", "1990", "s", "t", "p") for i, n in enumerate(names)]
    return content, spark.createDataFrame(rows + rows[:1], schemas.SOURCES)


def test_join_strategies_agree(spark):
    content, sources = hot_tables(spark)
    frames = {how: attach_sources(content, number_copies(sources), how, hot_share=0.01) for how in ("auto", "broadcast", "salted")}
    assert frames["auto"].columns == schemas.MERGED.fieldNames() + ["copy"]
    want = sorted(map(tuple, frames["auto"].collect()))
    by_id = {}
    for r in sources.collect():
        by_id[r.id] = by_id.get(r.id, 0) + 1
    assert len(want) == sum(by_id.get(r.id, 0) for r in content.collect())
    for how in ("broadcast", "salted"):
        assert sorted(map(tuple, frames[how].collect())) == want


def test_salted_join_cuts_hot_ids(spark):
    content, sources = hot_tables(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        def largest(how):
            joined = attach_sources(content, sources, how, hot_share=0.01)
            return max(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())

        assert largest("salted") < largest("auto") / 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_casts_ids(spark):
    content = spark.createDataFrame([(1, "a", "f", 0, 0, 1)], CONTENT.replace("id string", "id long"))
    sources = spark.createDataFrame([("1", "2", "3", "4", "5", "6", "7")], schemas.SOURCES)
    assert attach_sources(content, sources).first().id == "1"


def test_ordered_merge(spark):
    content, sources = hot_tables(spark)
    rows = [r.sequence for r in ordered_merge(attach_sources(content, sources)).collect()]
    assert rows == sorted(rows)


def test_number_copies(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), ("a",)], "x string")
    assert sorted(map(tuple, number_copies(df).collect())) == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]


def test_fits_broadcast(spark):
    df = spark.createDataFrame([("abc",)] * 10, "x string")
    assert fits_broadcast(df, 350) and not fits_broadcast(df, 349)
    assert fits_broadcast(schemas.empty(spark, schemas.SOURCES), 0)


@pytest.mark.parametrize("n, ratio", [(0, 0.8), (1, 0.8), (5, 0.8), (1000, 0.8), (1003, 0.37), (10, 0.0), (10, 1.0)])
def test_exact_split(spark, n, ratio):
    df = spark.range(n, numPartitions=3).withColumnRenamed("id", "sequence")
    train, rest = (sorted((r.shuffle_key, r.sequence) for r in side.collect()) for side in exact_split(df, ratio))
    ranked = sorted((hashlib.md5(f"42:{len(str(i))}:{i}".encode()).hexdigest(), i) for i in range(n))
    cut = int(n * ratio)
    assert train == ranked[:cut] and rest == ranked[cut:]


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "sequence")
    a, b = (label_split(df.repartition(k)) for k in (2, 7))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_copies_are_split_exactly(spark):
    """Half of the rows are one row repeated."""
    df = spark.range(600).select(F.when(F.col("id") < 300, -1).otherwise(F.col("id")).alias("sequence"))
    train, rest = exact_split(number_copies(df), by=["sequence", "copy"])
    assert (train.count(), rest.count()) == (480, 120)


def test_shuffled_order(spark):
    df = label_split(spark.range(1000).withColumnRenamed("id", "sequence")).drop("split")
    want = [r.sequence for r in df.orderBy("shuffle_key").collect()]
    out = in_shuffled_order(df, 7)
    assert out.columns == ["sequence"] and [r.sequence for r in out.collect()] == want
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 7 and max(sizes) < 2 * min(sizes)


def test_records(spark):
    rows = [("1", "text", "1990"), ("2", "text", "c1990."), ("3", "text", None), ("4", "text", ""), ("5", "text", "nan")]
    df = spark.createDataFrame(rows, "id string, content string, year string").select(
        "*", F.lit("SRC").alias("source"), F.lit("T").alias("title")
    )
    out = format_conversations(df, keep=["id"]).orderBy("id").collect()
    assert [r.conversations[1].value for r in out] == [
        "The sample you provided appears to be from 1990.",
        "The sample you provided appears to be from c1990.",
    ] + ["The sample you provided ."] * 3
    assert out[0].conversations[0].asDict() == {
        "from": "human",
        "value": "Given the following example text, use dialectal markers to identify the country of origin: text",
    }
    assert (out[0].source, out[0].score) == ("SRC", 0)
    custom = format_conversations(df, prompt="Say: ", reply=F.col("title")).first()
    assert [m.value for m in custom.conversations] == ["Say: text", "T"]
    with pytest.raises(ValueError, match="year"):
        format_conversations(df.drop("year"))


def test_shuffle_key_tells_rows_apart(spark):
    rows = [("a b:c", "d"), ("a b", "c:d"), (None, "d"), ("", "d"), ("-", "d"), ("d", None), ("1:d", "")]
    keys = spark.createDataFrame(rows, "title string, pubInfo string").select(shuffle_key(["title", "pubInfo"])).collect()
    assert len({k[0] for k in keys}) == len(rows)


def test_copies_are_unfolded_in_runs(spark):
    df = spark.createDataFrame([("a", None)] * 95 + [("b", "x")] * 10 + [("c", "x")] * 11, "id string, copies string").repartition(3)
    found = number_copies(df, run=10).collect()
    assert sorted((r.id, r.copy) for r in found) == [("a", i) for i in range(1, 96)] + [("b", i) for i in range(1, 11)] + [("c", i) for i in range(1, 12)]


def test_packed_sources(spark):
    """Every source is in one packed row of its id, a hot id's in several of about the same size."""
    sources = number_copies(hot_tables(spark)[1])
    packed = pack_sources(sources, run=5).select("id", F.size("members").alias("n"), "members")
    single = packed.select("id", F.inline("members")).select(*sources.columns)
    assert single.exceptAll(sources).isEmpty() and sources.exceptAll(single).isEmpty()
    sizes = [r.n for r in packed.where("id = 'warm'").collect()]
    assert sum(sizes) == 20 and 2 <= len(sizes) <= 4
    assert packed.where("id NOT IN ('hot', 'warm')").groupBy("id").count().where("count > 1").isEmpty()
    nothing = pack_sources(number_copies(schemas.empty(spark, schemas.SOURCES)))
    assert nothing.collect() == []


def test_hot_ids_from_sketches(spark, tmp_path):
    """Merged sketches of many blocks name the ids that counting finds, with as many parts; null ids count nowhere."""
    rows = spark.range(40000).select(
        (F.col("id") % 60).alias("block"),
        F.when(F.col("id") % 4 == 0, "hot").when(F.col("id") % 50 == 1, "warm").when(F.col("id") % 9 == 0, None)
        .otherwise(F.col("id").cast("string")).alias("id"),
    )
    rows.groupBy("block").agg(F.count("id").alias("n"), id_sketch("id").alias("sketch")).write.parquet(f"{tmp_path}/blocks")
    found = hot_in_sketches(spark.read.parquet(f"{tmp_path}/blocks"), "n", share=0.01)
    counts = {r.id: r["count"] for r in rows.where("id IS NOT NULL").groupBy("id").count().collect()}
    limit = 0.01 * sum(counts.values())
    assert {r.id: r.content_parts for r in found.collect()} == {i: math.ceil(n / limit) for i, n in counts.items() if n > limit}


def test_salted_join_reads_and_cleans_the_content_once(spark, tmp_path):
    """With hot ids known the plan has one scan of the lines, and their cleaning is below the unpacking of sources."""
    content, sources = hot_tables(spark)
    numbered = number_copies(sources)
    content.select(F.concat(F.lit("@@"), "id", F.lit(" "), "content").alias("line"), "file", "file_order", "line_num", "sequence").write.parquet(f"{tmp_path}/lines")
    pack_sources(numbered).write.parquet(f"{tmp_path}/packed")
    lines, packed = spark.read.parquet(f"{tmp_path}/lines"), spark.read.parquet(f"{tmp_path}/packed")
    hot = spark.createDataFrame([("hot", 7), ("warm", 7)], "id string, content_parts int")
    merged = assemble(lines, packed, "salted", content_hot=hot)
    want = assemble(lines, numbered, "broadcast")
    assert sorted(merged.columns) == sorted(want.columns) and merged.count() == want.count()
    merged = merged.select(*want.columns)
    assert merged.exceptAll(want).isEmpty() and want.exceptAll(merged).isEmpty()
    plan = assemble(lines, packed, "salted", content_hot=hot)._jdf.queryExecution().optimizedPlan().toString()
    steps = plan.splitlines()
    assert sum("[line#" in s and "Relation" in s for s in steps) == 1
    unpacked = next(i for i, s in enumerate(steps) if "inline(members" in s)
    cleaned = [i for i, s in enumerate(steps) if "ArrowEvalPython" in s or "_parse_markup" in s]
    assert cleaned and all(i > unpacked for i in cleaned)
