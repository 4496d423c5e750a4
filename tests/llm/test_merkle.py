"""Trees, proofs and tampering against a plain Python tree."""

import random
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from passagemill.llm import merkle

SCHEMA = "doc_id long, lang string, text string, n_chars long, tree string, node string"
FIELDS = ["doc_id", "lang", "n_chars", "text"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_proofs(nodes, fanout):
    """(root, [(before, after), ...] for each leaf)."""
    paths, level, owners = [[] for _ in nodes], nodes, [[i] for i in range(len(nodes))]
    while len(level) > 1:
        runs = [range(i, min(i + fanout, len(level))) for i in range(0, len(level), fanout)]
        for run in runs:
            for i in run:
                step = ("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i))
                for leaf in owners[i]:
                    paths[leaf].append(step)
        level, owners = [h(*(level[i] for i in run)) for run in runs], [[x for i in run for x in owners[i]] for run in runs]
    return level[0], paths


def plain_manifest(rows, fanout):
    found, trees = [], {}
    for r in rows:
        leaf = h(*(field(v) for v in (r[0], r[1], r[3], r[2])))
        bad = r[0] is not None and r[0] % 5 == 0
        claimed = h(*(field(v) for v in (r[0], r[1], None if r[3] is None else r[3] + 1, r[2]))) if bad else leaf
        trees.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf, claimed))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    lower = {}
    for t in names:
        trees[t].sort()
        lower[t] = plain_proofs([x[2] for x in trees[t]], fanout)
    root, upper = plain_proofs([lower[t][0] for t in names], fanout)
    for t, up in zip(names, upper):
        for (known, doc_id, leaf, claimed), path in zip(trees[t], lower[t][1]):
            node = claimed
            for before, after in path + up:
                node = h(before, node, after)
            found.append((doc_id if known else None, t, leaf, lower[t][0], root, h(*(b + a for b, a in path + up)), node))
    return found


def tables(n):
    rng = random.Random(n)
    rows = [(i, rng.choice(["en", "en", "en", "de", "é", None]), rng.choice(["", None, f"text {i}"]), rng.choice([None, i]), "x", "y") for i in range(n)]
    return rows + ([rows[0], rows[0], (None, "en", None, None, "", ""), (3, "zz", "q", 1, "", "")] if n else [])


@pytest.mark.parametrize("n, fanout", [(0, 2), (1, 2), (300, 2), (75, 3), (40, 40)])
def test_manifest_equals_a_plain_tree(spark, n, fanout):
    df = spark.createDataFrame(tables(n), SCHEMA).repartition(3)
    found = merkle.manifest(df, FIELDS, "lang", "doc_id", F.col("doc_id") % 5 == 0, {"n_chars": F.col("n_chars") + 1}, fanout)
    assert found.columns == ["doc_id", "lang", "leaf", "subroot", "root", "path", "claimed"]
    path = F.col("path")
    told = found.select("doc_id", "lang", "leaf", "subroot", "root", merkle.proof_digest(path), merkle.fold(F.col("claimed"), path))
    want = plain_manifest(tables(n), fanout) if n else []
    assert Counter(map(tuple, told.collect())) == Counter(want)


def test_one_leaf_is_the_root(spark):
    df = spark.createDataFrame([(1, None, "long " * 400_000, 2, "", "")], SCHEMA)
    row = merkle.manifest(df, FIELDS, "lang", "doc_id", F.lit(False), {}).first()
    assert row.leaf == row.subroot == row.root == row.claimed == h("1:1", "-", "1:2", f"{2_000_000}:" + "long " * 400_000) and row.path == []


def test_one_child_at_least_two(spark):
    with pytest.raises(ValueError):
        merkle.build_trees(spark.createDataFrame([], "tree string, at long, node string"), 1)
