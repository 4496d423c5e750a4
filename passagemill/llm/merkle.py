"""Merkle manifest of a table: which rows it holds, with a proof for each.

A row's leaf is the digest of its fields. The leaves of a tree stand in order; ``fanout`` consecutive nodes have the digest of
their concatenation as parent, until one is left. The subroots of all trees, in order of their names, are the leaves of one
more tree, whose root stands for the whole table.

Slot pivot: a pass groups the nodes by the ancestor that is ``LEVELS`` levels up; conditional aggregates spread them into one
column per slot. Concatenating the columns of a run hashes its parent, and so level by level inside the row, up to the
ancestor. Leaving out a node's own column gives its siblings. So a pass shuffles each node once (combined before the shuffle,
as nodes of one ancestor stand together), and a tree of n nodes takes log n / (LEVELS log fanout) passes. Proofs are unfolded
downwards from the pivoted rows; what a row inherits from above is joined once per ancestor, not per leaf.

Nodes get their positions by a distributed sort, so a tree with most of the rows is many partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill.llm.shared import store
from passagemill.operators.ordering import number_rows
from passagemill.operators.relate import union_batches

FANOUT = 2
#: Levels that one pivot spans with the default fanout; at most 32 slots otherwise.
LEVELS = 4

_PATH = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """A value as it goes into a leaf: UTF-8 byte count, a colon and the value; null: ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenation; nulls are left out."""
    return F.sha2(F.concat_ws("", *parts).cast("binary"), 256)


def tree_key(name: Column) -> Column:
    """A tree's name for joins and ordering: null before all others, which keep their bytewise order."""
    return F.coalesce(F.concat(F.lit("="), name.cast("string")), F.lit(""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def _levels(fanout: int) -> int:
    if fanout < 2:
        raise ValueError("a node has at least two children")
    levels = 1
    while fanout ** (levels + 1) <= max(fanout, 1 << LEVELS):
        levels += 1
    return levels


def _pivot(nodes: DataFrame, sizes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One row per tree and ancestor ``levels`` up: tree, at, last, height, slots s0 ... and the digests of each level above.

    A slot holds all columns of its node but tree and at. A tree with no more nodes than slots ends in this row: ``last``, with
    ``height`` levels. n{h}_{i} is node i of level h; null past the end of the tree.
    """
    width = fanout**levels
    held = ", ".join(c for c in nodes.columns if c not in ("tree", "at"))
    spread = [F.expr(f"max(CASE WHEN at % {width} = {k} THEN struct({held}) END) AS s{k}") for k in range(width)]
    rows = nodes.groupBy("tree", F.expr(f"at div {width}").alias("at")).agg(*spread)
    height = " ".join(f"WHEN n <= {fanout**h} THEN {h}" for h in range(levels))
    rows = rows.join(sizes, "tree").selectExpr(
        *rows.columns, f"CASE {height} ELSE {levels} END AS height", f"n <= {width} AS last"
    )
    for h in range(1, levels + 1):
        runs = []
        for i in range(fanout ** (levels - h)):
            children = [_node(h - 1, k) for k in range(i * fanout, (i + 1) * fanout)]
            hashed = f"sha2(CAST(concat_ws('', {', '.join(children)}) AS BINARY), 256)"
            runs.append(f"CASE WHEN height >= {h} AND {children[0]} IS NOT NULL THEN {hashed} END AS n{h}_{i}")
        rows = rows.selectExpr("*", *runs)
    return rows


def _node(level: int, i: int) -> str:
    return f"s{i}.node" if level == 0 else f"n{level}_{i}"


def _top(levels: int) -> str:
    """The node at a pivoted row's own height: the ancestor."""
    return "CASE height " + " ".join(f"WHEN {h} THEN {_node(h, 0)}" for h in range(levels + 1)) + " END AS node"


def _path(k: int, fanout: int, levels: int) -> str:
    """The siblings of slot k on each level up to the ancestor: the columns of a run without the node's own."""
    steps = []
    for h in range(levels):
        own = k // fanout**h
        first = own - own % fanout
        before, after = (", ".join(f"coalesce({_node(h, i)}, '')" for i in run) for run in (range(first, own), range(own + 1, first + fanout)))
        steps.append(f"named_struct('before', concat({before}), 'after', concat({after}))")
    return f"slice(array({', '.join(steps)}), 1, height)"


def build_trees(leaves: DataFrame, fanout: int = FANOUT) -> tuple[DataFrame, list[DataFrame]]:
    """(subroots, passes) of the trees in ``leaves``: tree (not null), at (from 0 in each tree), node (hex), whatever else.

    ``subroots``: tree, node. ``passes``: the pivoted rows of each pass, stored, for :func:`unfold_proofs`.
    """
    levels = _levels(fanout)
    width = fanout**levels
    sizes = store(leaves.groupBy("tree").agg(F.count("*").alias("n")), "tree_sizes")
    passes, nodes = [], leaves
    while True:
        rows = store(_pivot(nodes, sizes, fanout, levels), "pivot")
        passes.append(rows)
        sizes = store(sizes.where(F.col("n") > width).select("tree", F.ceil(F.col("n") / width).alias("n")), "tree_sizes")
        if sizes.isEmpty():
            break
        nodes = rows.where("NOT last").selectExpr("tree", "at", _top(levels))
    tops = [rows.where("last").selectExpr("tree", _top(levels)) for rows in passes]
    return store(union_batches(tops), "subroots"), passes


def unfold_proofs(passes: list[DataFrame], above: DataFrame | None = None, fanout: int = FANOUT) -> DataFrame:
    """tree, at, path and all that a leaf holds; ``above``: tree, path of its subroot further up (None: there is nothing)."""
    levels = _levels(fanout)
    width = fanout**levels
    slots = ", ".join(f"named_struct('k', {k}, 's', s{k}, 'path', {_path(k, fanout, levels)})" for k in range(width))
    unfolded = f"explode(filter(array({slots}), x -> x.s IS NOT NULL)) AS x"
    paths = None
    for i in reversed(range(len(passes))):
        last = passes[i].where("last")
        last = last.withColumn("rest", F.array().cast(_PATH)) if above is None else last.join(above.select("tree", F.col("path").alias("rest")), "tree")
        rows = last
        if paths is not None:
            rows = last.unionByName(passes[i].where("NOT last").join(paths.withColumnRenamed("path", "rest"), ["tree", "at"]))
        one = rows.selectExpr("tree", "at", "rest", unfolded)
        found = one.selectExpr("tree", f"at * {width} + x.k AS at", "concat(x.path, rest) AS path", "x.s.*")
        if i:
            paths = store(found.select("tree", "at", "path"), "paths")
    return found


def manifest(df: DataFrame, fields: list[str], tree: str, order: str, tampered: Column, changed: dict[str, Column], fanout: int = FANOUT) -> DataFrame:
    """A row per row of ``df``: ``order``, tree name, leaf, subroot, root, path, claimed (the leaf of the row as tampered with).

    ``fields`` make the leaf, ``tree`` names the tree, leaves stand by ``order`` (nulls first). Where ``tampered`` is true, the
    claimed leaf has the values ``changed`` for the fields named there. Rows with equal ``order`` stand by their leaves, so
    repeated rows are leaves of their own with equal digests. A null ``tree`` is a tree of its own, the first. Empty texts are
    fields of length 0, unlike nulls. No rows: no rows. Other columns do not matter.
    """
    leaf = digest(*(field(F.col(f)) for f in fields))
    claimed = F.when(tampered, digest(*(field(changed.get(f, F.col(f))) for f in fields)))
    rows = df.select(F.col(order).alias("key"), tree_key(F.col(tree)).alias("tree"), leaf.alias("node"), claimed.alias("claimed"))
    subroots, passes = build_trees(number_rows(rows, ["key", "node"], ["tree"], "at", store), fanout)
    tops = number_rows(subroots.withColumnRenamed("tree", "of"), ["of"], (), "at", store).withColumn("tree", F.lit(""))
    roots, upper_passes = build_trees(tops, fanout)
    root = roots.first()  # the only row, if there is any
    upper = store(unfold_proofs(upper_passes, None, fanout).select(F.col("of").alias("tree"), F.col("node").alias("subroot"), "path"), "subroot_paths")
    proofs = unfold_proofs(passes, upper, fanout).join(upper.select("tree", "subroot"), "tree")
    name = F.when(F.col("tree") != "", F.substring("tree", 2, 2**31 - 1))
    return proofs.select(
        F.col("key").alias(order), name.alias(tree), F.col("node").alias("leaf"), "subroot", F.lit(root and root["node"]).alias("root"), "path",
        F.coalesce("claimed", "node").alias("claimed"),
    )
