"""Each stage of the pipeline against a plain restatement on its own input."""

import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest

import corpus_pipeline as P
from passagemill.llm import quality, simhash, token_files
from passagemill.llm.queries import END_ID, default_tokenizer
from test_quality import corpus

ITEM = "which river runs through the old town of seven bridges and how long is it in km?"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    texts, labels = corpus()
    good = [t for _, t, kind in texts if kind == "good"]
    rows = [(i, t, "en", f"s{i % 7 // 4}", len(t)) for i, t, _ in texts]
    rows += [(1000 + i, good[i % 3], "en", "s0", 1) for i in range(40)]  # copies
    rows += [(2000 + i, good[20 + i] + " " + ITEM, "en", "s1", 1) for i in range(5)]
    rows += [(3000, None, None, None, None), (3001, "", "en", "s0", 0), (None, good[50] + " more of it", "en", "s1", 1), rows[2], rows[2]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = [docs]
    for name, stage in P.STAGES:
        found.append(P.store(stage(spark, found[-1], folder), name))
    return found


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_classifier_keeps_what_the_operator_keeps(spark, folder, stages):
    before, after = stages[0], stages[1]
    kept = quality.resample(before, spark.read.parquet(f"{folder}/labels.parquet")).where("kept")
    assert after.columns == before.columns and Counter(r.doc_id for r in after.collect()) == Counter(r.doc_id for r in kept.collect())
    kinds = {i: kind for i, _, kind in corpus()[0]}
    left = Counter(kinds.get(r.doc_id) for r in after.collect())
    assert left["good"] >= 0.9 * sum(k == "good" for k in kinds.values()) and left["low"] <= 5


def components(texts):
    """The group of each text, by fingerprints at most two bits apart."""
    prints = [simhash.simhash64(t) % (1 << 64) for t in texts]
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}
    moved = True
    while moved:
        moved = False
        for p in distinct:
            for q in distinct:
                if (p ^ q).bit_count() <= 2 and root[q] < root[p]:
                    root[p], moved = root[q], True
    return [root[p] for p in prints]


def test_one_row_of_each_group_stays(stages):
    before, after = list(rows_of(stages[1]).elements()), rows_of(stages[2])
    groups = dict(zip(before, components([r[1] for r in before])))
    assert Counter(groups[r] for r in after.elements()) == Counter(set(groups.values()))
    for group in set(groups.values()):
        (kept,) = (r for r in after if groups[r] == group)
        ids = [r[0] for r in before if groups[r] == group and r[0] is not None]
        assert kept[0] == min(ids, default=None)
    assert len(before) > sum(after.values())


def test_rows_are_told_apart_by_what_they_hold(spark, folder):
    t = "the same words of a text that comes again and again"
    u = "nothing like it, a text of another kind about something else"
    rows = [(7, t, "en", "s", 1)] * 3 + [(None, t, "en", "s", 1)] * 2 + [(9, t, "en", "s", 1), (9, u, "en", "s", 1), (None, None, None, None, None)]
    rows += [(None, ITEM + " " + u, "en", "s", 1), (11, "now " + ITEM, "en", "s", 1), (11, u + " more", None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    left = P.deduplicate(spark, docs, folder)
    assert left.columns == docs.columns
    assert rows_of(left) == Counter({rows[0]: 1, (9, u, "en", "s", 1): 1, (None, None, None, None, None): 1} | {r: 1 for r in rows[-3:]})
    assert rows_of(P.decontaminated(spark, docs, folder)) == Counter(r for r in rows if ITEM not in (r[1] or ""))


def test_benchmark_passages_go_and_the_rest_stays(stages):
    before, after = rows_of(stages[2]), rows_of(stages[3])
    assert after == Counter({r: n for r, n in before.items() if ITEM not in (r[1] or "")}) and before != after


def test_mixture_repeats_whole_documents(stages):
    before, after = rows_of(stages[3]), rows_of(stages[4])
    assert set(before) == set(after) and all(after[r] >= n and after[r] % n == 0 for r, n in before.items())


def test_tokens_of_the_mixture(stages):
    tokenizer = token_files.Encoder(default_tokenizer()).tokenizer
    want = sorted(
        ((r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [END_ID]) for r in stages[4].collect()),
        key=lambda x: (x[0] is not None, x[0] or 0),
    )
    found = sorted(stages[5].collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [i for i, _ in want]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter((i, len(t), zlib.crc32(np.array(t, "<u4").tobytes())) for i, t in want)
    assert [r.start for r in found] == [0, *accumulate(r.n_tokens for r in found)][:-1]


def test_run_gives_the_last_stage(spark, folder, stages):
    assert rows_of(P.run(spark, folder)) == rows_of(stages[5])


def test_empty_tables(spark, folder, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
