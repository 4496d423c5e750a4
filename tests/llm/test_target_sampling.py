"""Tables of n-grams, gains and draws against plain Python."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from passagemill.llm import target_sampling as T

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def features(text, order):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def texts(n, seed=3):
    rng = random.Random(seed)
    alphabet = ["Aa", "b", "ünï", "3", "日本", "-", "\n", " ", " ", " ", "x" * 40, "\x7f", "_", "É"]
    return [None, "", " ", "a", "A,a"] + ["".join(rng.choices(alphabet, k=rng.randrange(200))) for _ in range(n)]


@pytest.mark.parametrize("length", [0, 1, 3, 4, 7, 8, 11, 15, 16, 23, 31])
def test_hash_is_xxhash64(length):
    rows = np.random.default_rng(length).integers(0, 256, (50, length), dtype=np.uint8)
    assert T._xxhash64_equal_lengths(rows).tolist() == [xxhash.xxh64_intdigest(r.tobytes()) for r in rows]


@pytest.mark.parametrize("mask", [(1 << 64) - 1, 7, 0])
@pytest.mark.parametrize("order", [1, 3])
def test_table_holds_each_ngram_once_even_if_keys_agree(order, mask):
    ((data, start, length, document, fresh),) = T._slices(pa.array(texts(12)), order)
    data, start, length, _ = T._features(data, start, length, document, fresh, order)
    found = T.Ngrams(data, start, length, mask)
    spelled = [data[s : s + n].tobytes() for s, n in zip(start, length)]
    slots = {}
    for word, slot in zip(spelled, found.slot.tolist()):
        assert slots.setdefault(slot, word) == word
    assert len(slots) == len(set(spelled)) and found.count.sum() == len(spelled)
    assert {word: (found.bucket[s], found.count[s]) for s, word in slots.items()} == {w: (zlib.crc32(w) % T.BUCKETS, c) for w, c in Counter(spelled).items()}


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("size", [5, 64, 1 << 20])
def test_slices_lose_and_repeat_nothing(monkeypatch, order, size):
    monkeypatch.setattr(T, "SLICE", size)
    rows = texts(30)
    batch = pa.array(["cut off", *rows, "x"]).slice(1, len(rows))
    found, n_words = [Counter() for _ in rows], [0] * len(rows)
    for ngrams, document, fresh in T._interned(batch, order):
        for s, n, d in zip(ngrams.start, ngrams.length, document):
            found[d][ngrams.data[s : s + n].tobytes().decode()] += 1
        for d in fresh:
            n_words[d] += 1
    assert found == [Counter(features(t, order)) for t in rows] and n_words == [len(words(t)) for t in rows]


def plain(docs, target, order, percent, least):
    bucket = lambda f: zlib.crc32(f.encode()) % T.BUCKETS
    s, t = (Counter(bucket(f) for x in side for f in features(x, order)) for side in ([d[1] for d in docs], target))
    n, s_all, t_all = T.BUCKETS, sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + n) / ((s[b] + 1) * (t_all + n)))) for b in s}
    out = []
    for doc_id, text in docs:
        f = features(text, order)
        h = int(sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(x)] for x in f)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(f), weight, score, None, len(words(text))])
    eligible = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(eligible[: len(eligible) * percent // 100], 1):
        r[4] = rank
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("order, percent", [(1, 10), (2, 50)])
def test_draw_equals_plain_python(spark, order, percent):
    docs = list(enumerate(texts(200))) + [(None, "a b c " * 30), (7, "seven " * 40), (8, "many words " * 300_000)]
    docs += [docs[100]] * 4
    target = texts(9, seed=8) + [None]
    df = spark.createDataFrame([(i, t, "x", 1.5) for i, t in docs], "doc_id long, text string, tie string, score double").repartition(4)
    found = T.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), order, percent, 10)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, found.collect())) == plain(docs, target, order, percent, 10)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert T.resample(docs.limit(0), docs).collect() == []
    assert {r.doc_id: (r.n_features, r["rank"]) for r in T.resample(docs, docs.limit(0), min_words=0, percent=100).collect()}.keys() == {1, 2}
