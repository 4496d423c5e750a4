import random

import numpy as np
import xxhash

from passagemill.llm import simhash
from passagemill.llm.components import connected_components
from passagemill.llm.simhash import near_duplicates, simhash64, spanning_links


def plain_fingerprint(text, k=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids, edges):
    """Smallest member of each id's component, by plain union."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def sample_texts():
    rng = random.Random(1)
    vocabulary = [w + rng.choice(["", ".", ","]) for w in "la Le un é ÉTÉ of the And to a in it that was".split()]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 40))) for _ in range(300)]
    return texts + ["", None, " \t\n", "one", "one two", "A b\x0bc\x85d e", "a b c d", " ".join(["w"] * 3000)] + texts[:40]


def test_fingerprint_equals_plain_statement():
    for text in sample_texts():
        assert simhash64(text) % (1 << 64) == plain_fingerprint(text), text


def test_slices_of_long_texts(monkeypatch):
    text = " ".join(random.Random(3).choices("abcdefgh", k=500))
    monkeypatch.setattr(simhash, "_SLICE", 7)
    assert simhash64(text) % (1 << 64) == plain_fingerprint(text)


def test_links_of_tiles_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = [c ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 4)))) for c in centres for _ in range(8)]
    prints = np.unique(np.array([*flips, 0, 1, 3, (1 << 64) - 1], np.uint64)).view(np.int64)
    near = [(int(a), int(b)) for i, a in enumerate(prints) for b in prints[i + 1 :] if ((int(a) ^ int(b)) % (1 << 64)).bit_count() <= 2]
    rows = spark.createDataFrame([(int(p),) for p in prints], "fingerprint long")
    found = connected_components(simhash.links(rows)).collect()
    want = classes([int(p) for p in prints], near)
    assert {r.node: r.component for r in found} == {n: c for n, c in want.items() if n in {x for e in near for x in e}}


def test_spanning_links_are_few_and_enough():
    rng = np.random.default_rng(2)
    tile = np.unique(np.uint64(77) ^ np.array([1 << int(b) for b in rng.integers(0, 64, 200)], np.uint64)).view(np.int64)
    a, b = spanning_links(tile, tile, True, 2)
    assert len(a) == len(tile) - 1 and len(set(classes(tile.tolist(), zip(a.tolist(), b.tolist())).values())) == 1


def test_near_duplicates_equal_brute_force(spark):
    texts = sample_texts()
    rows = [(i, t, "x", i) for i, t in enumerate(texts)] + [(3, texts[3], "x", 3), (None, texts[5], "x", 0), (None, "alone at last", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fingerprint long")
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    distinct = sorted({p for _, p in prints})
    near = [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if (a ^ b).bit_count() <= 2]
    group = classes(distinct, near)
    first = {}
    for i, p in prints:
        if i is not None:
            first[group[p]] = min(i, first.get(group[p], i))
    want = sorted([(i, p, first.get(group[p])) for i, p in prints], key=str)
    got = [(r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in near_duplicates(docs).collect()]
    assert sorted(got, key=str) == want


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_chains_hubs_and_loops(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(1000, 1120)]
    hub = [(5, i) for i in range(2000, 2400)]
    rest = [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(150)]
    edges = chain + [(b, a) for a, b in hub] + hub[:20] + rest + [(7, 7)]
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    rows = spark.createDataFrame(edges + [(None, 4), (9, None)], "a long, b long")
    assert {r.node: r.component for r in connected_components(rows).collect()} == classes(nodes, [e for e in edges if e[0] != e[1]])
    assert connected_components(rows.where("a < 0")).collect() == []
