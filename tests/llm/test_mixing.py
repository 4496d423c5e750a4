import math
import random
from collections import Counter, defaultdict

import pytest

from passagemill.llm import mixing

SIZES = {"big": 400, "b": 90, "c": 40, "d": 11, "e": 3}


def rows():
    rng = random.Random(12)
    out, i = [], 0
    for source, n in SIZES.items():
        for _ in range(n):
            out.append((i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(1, 60))), source, 1.0, 2))
            i += 1
    return out + [(9000, None, "big", 1.0, 2), (9001, "", None, 1.0, 2), (9002, "of no source", None, 1.0, 2), (None, "no id", "c", 1.0, 2), out[500], out[500]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), "doc_id long, text string, source string, weight double, cut int").repartition(5)


def tokens():
    total = defaultdict(int)
    for _, text, source, *_ in rows():
        total[source] += len((text or "").split())
    return total


def entropy(alpha, total):
    w = [t**alpha for t in total.values() if t]
    return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)


@pytest.mark.parametrize("share, most, budget", [(0.95, 1e9, None), (0.9, 1e9, None), (1.0, 3.0, None), (0.95, 2.0, None), (0.95, 2.5, 9000)])
def test_exponent_equals_scan_of_the_grid(spark, docs, share, most, budget):
    own = mixing._own(docs)
    totals = own.groupBy("source_key").agg({"n_tokens": "sum"}).toDF("source_key", "tokens").where("tokens > 0")
    found = mixing.find_exponent(totals, share, most, budget)
    total = tokens()

    def passes(alpha):
        w = {s: t**alpha for s, t in total.items() if t}
        rate = [w[s] / total[s] for s in w]
        return max(rate) / min(rate) if budget is None else max(rate) * budget / sum(w.values())

    top = max([a for a in range(0, mixing.GRID + 1, 64) if entropy(a / mixing.GRID, total) >= share * entropy(0, total) - 1e-9], default=0)
    few = min([a for a in range(0, mixing.GRID + 1, 64) if passes(a / mixing.GRID) <= most + 1e-9], default=mixing.GRID)
    assert abs(found - max(top, few) / mixing.GRID) <= 65 / mixing.GRID


def test_every_document_once_and_rare_sources_again(spark, docs):
    limits = dict(entropy_share=0.95, max_passes=2.5, block_tokens=64)
    plan = {r.source_key: r for r in mixing.plan_sources(mixing._own(docs), **limits).collect()}
    found = mixing.mix(docs, **limits).collect()
    times = Counter((r.doc_id, r.n_tokens) for r in found)
    assert {k for k, _ in times} == {r[0] for r in rows()}
    assert abs(sum(p.weight for p in plan.values()) - 1) < 1e-9 and min(p.passes for p in plan.values()) == pytest.approx(1)
    assert max(p.passes for p in plan.values()) <= 2.5 + 1e-6
    used, blocks = defaultdict(int), defaultdict(int)
    for r in found:
        key = "null" if r.source is None else "=" + r.source
        used[key] += r.n_tokens
        blocks[key, r.block] += r.n_tokens * (r.epoch == 0)
    for key, p in plan.items():
        largest = max(v for (k, _), v in blocks.items() if k == key)
        assert p.passes * p.tokens - largest - 1 <= used[key] <= p.passes * p.tokens + 1, key
    # a block is in a pass as a whole
    whole = defaultdict(set)
    for r in found:
        whole[r.source, r.block, r.epoch].add((r.doc_id, r.n_tokens))
    assert all(whole[s, b, e] == whole[s, b, 0] for s, b, e in whole)


def test_permutations_differ_and_places_spread(spark, docs):
    found = [r for r in mixing.mix(docs, entropy_share=1.0, max_passes=3.0, block_tokens=32).collect() if r.source == "c"]
    assert all(0 <= r.place < 1 for r in found)
    order = lambda e: [b for _, b in sorted({(r.place, r.block) for r in found if r.epoch == e})]
    again = order(1)
    assert len(again) > 2 and set(again) <= set(order(0)) and again != [b for b in order(0) if b in again]


def test_smaller_budget_takes_part_of_a_source(spark, docs):
    found = mixing.mix(docs, budget=1500, block_tokens=32).collect()
    assert 1100 <= sum(r.n_tokens for r in found) <= 1500


def test_documents_keep_their_columns(spark, docs):
    found = mixing.repeat_documents(docs, max_passes=2.5, block_tokens=64)
    assert found.columns == docs.columns
    assert Counter(r.doc_id for r in found.collect()) == Counter(r.doc_id for r in mixing.mix(docs, max_passes=2.5, block_tokens=64).collect())


def test_without_tokens_or_rows(spark, docs):
    silent = docs.where("text IS NULL OR text = ''")
    assert sorted((r.doc_id, r.epoch) for r in mixing.mix(silent).collect()) == [(9000, 0), (9001, 0)]
    assert mixing.mix(docs.where("doc_id < 0")).collect() == []


def test_no_python_in_the_plan(spark, docs):
    assert "Python" not in mixing.repeat_documents(docs)._jdf.queryExecution().executedPlan().toString()
