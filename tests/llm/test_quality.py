import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagemill.llm import quality

SF = "/root/testdata/sf0.1"
WORDS = [a + b for a in ("ba", "ke", "lo", "mi", "nu") for b in ("r", "s", "t", "v", "zen", "dor")]


def corpus():
    rng = random.Random(6)
    texts, labels = [], []
    for i in range(600):
        words = rng.choices(WORDS, k=rng.randrange(60, 200))
        kind = "toxic" if i % 6 == 0 else "low" if i % 6 == 1 else "good"
        if kind == "toxic":
            for _ in range(6):
                words[rng.randrange(len(words))] = rng.choice(["vile", "scum"])
        if kind == "low":
            words = [w + "###" for w in words]
        texts.append((i, " ".join(words), kind))
        if i % 2 or i % 12 == 0:
            labels.append((i, int(kind != "low"), int(kind == "toxic")))
    return texts, labels


@pytest.fixture(scope="module")
def sampled(spark):
    texts, labels = corpus()
    extra = [(9001, None, "empty"), (9002, "", "empty"), (None, texts[2][1], "good"), (None, texts[1][1], "low"), texts[8], texts[8]]
    rows = spark.createDataFrame([(i, t, k, 1.0, True) for i, t, k in texts + extra], "doc_id long, text string, kind string, key double, kept boolean")
    labelled = spark.createDataFrame([*labels, (None, 1, 0), (8, None, None)], "doc_id long, quality int, toxic int")
    return rows, labelled, quality.resample(rows, labelled).cache()


def test_rejects_go_and_clean_documents_stay(spark, sampled):
    rows, _, found = sampled
    kinds = rows.where("doc_id < 9000").select("doc_id", "kind").distinct()
    shares = {r.kind: r.share for r in found.join(kinds, "doc_id").groupBy("kind").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert shares["good"] > 0.9 and shares["low"] < 0.05 and shares["toxic"] < 0.15


def test_one_row_each_and_equal_rows_together(sampled):
    rows, _, found = sampled
    assert found.count() == rows.count() and found.columns == ["doc_id", "log_weight", "sample_key", "kept"]
    assert len({(r.sample_key, r.kept) for r in found.where("doc_id = 8").collect()}) == 1
    empty = found.where("doc_id > 9000").collect()
    assert len(empty) == 2 and all(abs(r.log_weight) < 1e-9 for r in empty)


def test_kept_are_the_largest_keys(sampled):
    found = sampled[2].collect()
    n = sum(r.kept for r in found)
    assert min(r.sample_key for r in found if r.kept) >= max(r.sample_key for r in found if not r.kept) and 0 < n < len(found)


def test_whole_rows_are_kept_unchanged(sampled):
    rows, labelled, found = sampled
    kept = quality.keep_resampled(rows, labelled)
    assert kept.columns == rows.columns and kept.count() == found.where("kept").count()


def test_scores_equal_plain_sums(spark, sampled):
    rows, labelled, _ = sampled
    ratios = quality.fit(rows, labelled)
    for r in quality.score_documents(rows, labelled).where("doc_id < 20").collect():
        text = dict((i, t) for i, t, _ in corpus()[0])[r.doc_id]
        every, once = map(np.concatenate, zip(*quality.ngram_buckets(text)))
        assert np.isclose(r.low, sum(float(ratios[0, b]) for b in every)) and np.isclose(r.toxic, sum(float(ratios[1, b]) for b in set(once.tolist())), atol=1e-4)


def test_without_labels_everything_stays(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.kept for r in quality.resample(docs, none).collect()] == [True, True]
    assert quality.resample(docs.where("doc_id > 5"), none).collect() == []


def test_label_sample_is_bounded_and_one_per_id(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(50)] + [(3, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r["class"] for r in quality.label_sample(labels).collect()}
    assert len(found) == 50 and found[3] == 3 and found[5] == 1 and found[4] == 2
    assert quality.label_sample(labels, 7).count() == 15


def test_kth_largest(spark):
    rng = random.Random(2)
    values = [rng.choice([rng.randrange(-9, 9), rng.randrange(-(1 << 62), 1 << 62)]) for _ in range(300)]
    keys = spark.createDataFrame([(v,) for v in values], "key long")
    for k in (1, 2, 150, 300):
        assert quality.kth_largest(keys, k) == sorted(values)[-k]
    assert quality.kth_largest(keys, 0) is None and quality.kth_largest(keys, 301) is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = quality.resample(spark.read.parquet(f"{SF}/documents.parquet"), labels.where("doc_id % 5 <> 1"))
    held = found.join(labels.where("doc_id % 5 = 1"), "doc_id")
    keep = held.groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int")).alias("share"))
    share = {(r.quality, r.toxic): r.share for r in keep.collect()}
    assert share[1, 0] > 0.96 and share[0, 0] < 0.15 and share[1, 1] < 0.3


def test_toxic_words_that_are_rare_one_by_one(spark):
    rng = random.Random(8)
    rare = lambda: "bomente" + "".join(rng.choices("abcdefghij", k=4))
    texts = []
    for i in range(600):
        words = rng.choices(WORDS, k=rng.randrange(60, 120))
        for _ in range(6 if i % 6 == 0 else 0):
            words[rng.randrange(len(words))] = rare()
        texts.append((i, " ".join(words)))
    labels = [(i, 1, int(i % 6 == 0)) for i in range(600) if i % 4 < 2]
    found = quality.resample(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    kept = {r.doc_id: r.kept for r in found.collect()}
    toxic = [kept[i] for i in range(600) if i % 6 == 0 and i % 4 >= 2]
    clean = [kept[i] for i in range(600) if i % 6]
    assert sum(toxic) < 0.1 * len(toxic) and sum(clean) > 0.9 * len(clean)


def test_nothing_stays_if_no_target_document_is_expected(spark):
    scored = spark.createDataFrame([(i, 0.5, 100.0, -100.0) for i in range(5)], "doc_id long, noise double, low double, toxic double")
    assert [r.kept for r in quality._sampled(scored).collect()] == [False] * 5


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_toxic_documents_go_in_every_language(spark):
    labels, docs = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/documents.parquet")
    found = quality.resample(docs, labels.where("doc_id % 5 <> 1"))
    held = found.join(labels.where("doc_id % 5 = 1 AND toxic = 1"), "doc_id").join(docs.select("doc_id", "lang").distinct(), "doc_id")
    share = {r.lang: (r.kept, r.n) for r in held.groupBy("lang").agg(F.sum(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    print(share)
    assert sum(k for k, _ in share.values()) < 0.08 * sum(n for _, n in share.values()) and all(k < 0.4 * n for k, n in share.values())


@pytest.mark.parametrize("size", [1, 50, 1 << 20])
def test_parts_of_a_long_text_say_the_same(monkeypatch, size):
    text = " ".join(f"word{i % 37}longer, Other{i % 5}\n x{i}" for i in range(300))
    (want,) = quality.ngram_buckets(text)
    monkeypatch.setattr(quality, "_SLICE", size)
    parts = list(quality.ngram_buckets(text))
    assert len(parts) == 1 or size < len(text)
    for k in (0, 1):
        assert sorted(np.concatenate([p[k] for p in parts]).tolist()) == sorted(want[k].tolist())


def test_kept_rows_equal_a_plain_draw(spark, sampled):
    """The kept set from the scores alone: the expected number of target documents, by their sample keys."""
    rows, labelled, found = sampled
    scored = quality.score_documents(rows, labelled)
    s = quality.fit_shares(scored)
    keys, expected = {}, 0.0
    for r in scored.collect():
        log_weight = -np.log(s[0] + s[1] * np.exp(r.low) + s[2] * np.exp(r.toxic))
        expected += min(1.0, np.exp(log_weight + np.log(s[0])))
        keys.setdefault(r.doc_id, []).append(float(np.rint((log_weight - np.log(-np.log(r.noise))) * quality.KEY_STEPS)))
    cut = sorted((k for ks in keys.values() for k in ks), reverse=True)[round(expected) - 1]
    near = [(i, k) for i, ks in keys.items() for k in ks if abs(k - cut) > 2]  # keys are rounded from doubles
    kept = {}
    for r in found.collect():
        kept.setdefault(r.doc_id, []).append(r.kept)
    assert all((k >= cut) in kept[i] for i, k in near) and len(near) > 0.9 * len(keys)
