"""Importance resampling towards the distribution of a target set: hashed n-gram features, gains per bucket, seeded draw.

Every run of 1 to ``order`` consecutive words is a feature; its bucket is the crc32 of its bytes modulo ``BUCKETS``. A bucket's
gain is a thousand times the log of its share in the target over its share in the raw text, both smoothed by one. A document's
weight is the sum of its features' gains; Gumbel noise from a hash of its id makes the largest scores a weighted sample.

Words are found, hashed and counted in numpy, a slice of text at a time. An open-addressed table interns the slice's n-grams:
the xxhash64 of the bytes says where to probe, equal keys are verified byte by byte, others probe on. The slots hold each
different n-gram's bucket and count, so crc32 runs once per different n-gram; sums per bucket come from slots, and the
occurrences' slot ids gather the gains. A slice has about ``SLICE`` bytes, or one long word: memory does not grow with a text.

Counts are dense per task and summed by Spark; scores are ranked by a distributed sort.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill.llm.shared import BATCH_BYTES, settings, store, store_from_python
from passagemill.operators.ordering import number_rows

BUCKETS = 10_000
ORDER = 1
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
SLICE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
for _low, _high in ((48, 57), (97, 122), (128, 255)):  # digits, a-z, all of UTF-8 beyond ASCII
    _IN_WORD[_low : _high + 1] = True

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)  # fixed values: the primes of xxhash64


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _xxhash64_equal_lengths(rows: np.ndarray) -> np.ndarray:
    """xxhash64 with seed 0 of each row of a byte matrix with fewer than 32 columns."""
    n, length = rows.shape
    value = np.full(n, _P5 + np.uint64(length), np.uint64)
    at = 0
    while at + 8 <= length:
        lane = np.ascontiguousarray(rows[:, at : at + 8]).view("<u8").ravel()
        value = _rotl(value ^ (_rotl(lane * _P2, 31) * _P1), 27) * _P1 + _P4
        at += 8
    if at + 4 <= length:
        lane = np.ascontiguousarray(rows[:, at : at + 4]).view("<u4").ravel().astype(np.uint64)
        value = _rotl(value ^ (lane * _P1), 23) * _P2 + _P3
        at += 4
    for k in range(at, length):
        value = _rotl(value ^ (rows[:, k].astype(np.uint64) * _P5), 11) * _P1
    value = (value ^ (value >> np.uint64(33))) * _P2
    value = (value ^ (value >> np.uint64(29))) * _P3
    return value ^ (value >> np.uint64(32))


class Ngrams:
    """The n-grams that occur in a buffer, interned.

    ``slot`` is each occurrence's slot; ``bucket`` and ``count`` are held by the slots, 0 where a slot is empty.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, mask: int = (1 << 64) - 1):
        """``mask`` keeps some bits of the keys only (for tests of what happens when keys agree)."""
        self.data, self.start, self.length = data, start, length
        size = 1 << max(4, (2 * len(start)).bit_length())
        self.bucket, self.count = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.slot = self._intern(self._keys() & np.uint64(mask), size)
        self.count += np.bincount(self.slot, minlength=size)
        raw = data.tobytes()
        for s, i in zip(self._used.tolist(), self._owner[self._used].tolist()):
            self.bucket[s] = zlib.crc32(raw[start[i] : start[i] + length[i]]) % BUCKETS

    def _keys(self) -> np.ndarray:
        keys = np.empty(len(self.start), np.uint64)
        order = np.argsort(self.length, kind="stable")
        lengths, firsts = np.unique(self.length[order], return_index=True)
        for length, first, last in zip(lengths.tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(order)]):
            same = order[first:last]
            if length < 32:
                keys[same] = _xxhash64_equal_lengths(self.data[self.start[same, None] + np.arange(length)])
            else:
                at = self.start[same].tolist()
                keys[same] = [xxhash.xxh64_intdigest(self.data[s : s + length].tobytes()) for s in at]
        return keys

    def _intern(self, keys: np.ndarray, size: int) -> np.ndarray:
        """Linear probing, all occurrences at once: whoever finds an empty slot claims it, equal n-grams share it, others go on."""
        self._owner = np.full(size, -1, np.int64)
        slot = (keys & np.uint64(size - 1)).astype(np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            at = slot[open_]
            empty = self._owner[at] < 0
            self._owner[at[empty][::-1]] = open_[empty][::-1]  # the first of several claims stands
            owner = self._owner[at]
            same = (keys[owner] == keys[open_]) & (self.length[owner] == self.length[open_])
            same[same] = self._equal_bytes(open_[same], owner[same])
            open_ = open_[~same]
            slot[open_] = (slot[open_] + 1) & (size - 1)
        self._used = np.flatnonzero(self._owner >= 0)
        return slot

    def _equal_bytes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether occurrences of equal lengths hold the same bytes, eight at a time; the buffer ends in eight zeros."""
        equal = np.ones(len(a), bool)
        todo = np.flatnonzero(a != b)
        x, y, left = self.start[a[todo]], self.start[b[todo]], self.length[a[todo]]
        eight = np.lib.stride_tricks.sliding_window_view(self.data, 8)
        while len(todo):
            compared = np.arange(8) < left[:, None]
            differ = ((eight[x] != eight[y]) & compared).any(axis=1)
            equal[todo[differ]] = False
            more = ~differ & (left > 8)
            todo, x, y, left = todo[more], x[more] + 8, y[more] + 8, left[more] - 8
        return equal


def _slices(texts: pa.Array, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(data, start, length, document, n) of slices of a batch: the words' places in ``data`` and the row that each is in.

    A slice is some documents or a part of one; of a part, the last order - 1 words come again at the head of the next, and only
    n-grams that end in one of the words from ``fresh`` on are new.
    """
    offsets, buffer = _utf8(texts)
    row = 0
    while row < len(texts):
        last = int(np.searchsorted(offsets, offsets[row] + SLICE, side="right")) - 1
        last = min(max(last, row + 1), len(texts))
        begin, stop = int(offsets[row]), int(offsets[last])
        if stop - begin <= 2 * SLICE:
            yield _words(buffer[begin:stop], offsets[row : last + 1] - begin, row) + (0,)
        else:  # one long text
            yield from _long_text(buffer[begin:stop], row, order)
        row = last


def _utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def _words(raw: np.ndarray, offsets: np.ndarray, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words as runs of word bytes that end where a document ends, in a lower-cased copy with eight zeros behind it."""
    data = np.concatenate([_LOWER[raw], np.zeros(8, np.uint8)])
    inside = _IN_WORD[data[: len(raw)]]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True  # documents follow each other without a gap
    before = np.concatenate([[False], inside[:-1]]) if len(raw) else inside
    after = np.concatenate([inside[1:], [False]]) if len(raw) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    # a null or empty text has no bytes: the last row that starts at or before a word is the word's
    return data, start, end - start, row + np.searchsorted(offsets, start, side="right") - 1


def _long_text(raw: np.ndarray, row: int, order: int) -> Iterator[tuple]:
    begin, stop, fresh = 0, 0, 0
    while stop < len(raw):
        stop = min(stop + SLICE, len(raw))
        while stop < len(raw) and _IN_WORD[_LOWER[raw[stop - 1]]] and _IN_WORD[_LOWER[raw[stop]]]:
            stop += 1  # a word is never cut
        data, start, length, document = _words(raw[begin:stop], np.array([0, stop - begin]), row)
        yield data, start, length, document, fresh
        fresh = min(order - 1, len(start))
        begin = begin + int(start[-fresh]) if fresh else stop


def _features(data, start, length, document, fresh, order) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, start, length, document) of all runs of 1 to ``order`` words; runs of several are written out behind the words."""
    parts, starts, lengths, documents = [data[:-8]], [start[fresh:]], [length[fresh:]], [document[fresh:]]
    base = len(data) - 8
    for n in range(2, order + 1):
        first = np.arange(max(fresh - n + 1, 0), max(len(start) - n + 1, 0))
        first = first[document[first] == document[first + n - 1]]
        size = sum((length[first + k] for k in range(n)), np.full(len(first), n - 1))
        at = np.cumsum(size) - size
        joined = np.full(int(size.sum()), 32, np.uint8)
        place = at.copy()
        for k in range(n):
            word = first + k
            within = np.arange(int(length[word].sum())) - np.repeat(np.cumsum(length[word]) - length[word], length[word])
            joined[np.repeat(place, length[word]) + within] = data[np.repeat(start[word], length[word]) + within]
            place = place + length[word] + 1
        parts.append(joined)
        starts.append(base + at)
        lengths.append(size)
        documents.append(document[first])
        base += len(joined)
    parts.append(np.zeros(8, np.uint8))
    return tuple(map(np.concatenate, (parts, starts, lengths, documents)))


def _interned(batch: pa.Array, order: int) -> Iterator[tuple[Ngrams, np.ndarray, int, np.ndarray]]:
    """(n-grams, the row of each occurrence, words in a row that are new to it) for each slice of a batch."""
    for data, start, length, document, fresh in _slices(batch, order):
        words = document[fresh:]
        if order > 1:
            data, start, length, document = _features(data, start, length, document, fresh, order)
        yield Ngrams(data, start, length), document, words


def _count(order: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for ngrams, _, _ in _interned(batch["text"], order):
                sums += np.bincount(ngrams.bucket, ngrams.count, BUCKETS).astype(np.int64)
        bucket = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(sums[bucket])], ["bucket", "n"])

    return count


def bucket_counts(texts: DataFrame, order: int = ORDER) -> np.ndarray:
    """How many features of the column ``text`` each bucket holds. Null and empty texts hold none."""
    with settings(texts.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        counted = texts.select("text").mapInArrow(_count(order), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
        sums = counted.toArrow()  # at most BUCKETS rows
    counts = np.zeros(BUCKETS, np.int64)
    counts[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return counts


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln ((t + 1) (S + n) / ((s + 1) (T + n)))) of each of the n buckets."""
    n, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    pairs = zip(raw.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in pairs], np.int64)


def _weigh(gains: np.ndarray, order: int):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, words, weights = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for ngrams, document, fresh_words in _interned(batch["text"], order):
                held = gains[ngrams.bucket]
                for row, found in ((features, None), (weights, held[ngrams.slot].astype(np.float64))):
                    row += np.bincount(document, found, batch.num_rows).astype(np.int64)  # sums far below 2^53
                words += np.bincount(fresh_words, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["tie"], *map(pa.array, (features, words, weights))], ["doc_id", "tie", "n_features", "n_words", "weight"]
            )

    return weigh


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) of a uniform number from the SHA-256 of seed and id; a missing id counts as empty."""
    spelled = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(spelled.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, order: int = ORDER, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score, rank (1, 2, ... of the drawn, else null) for each row of ``docs``.

    ``docs``: doc_id, text; ``target``: text; whatever else there is. Of the N rows with at least ``min_words`` words,
    floor(percent N / 100) are drawn: the highest scores, ties to the smaller doc_id, then by a hash of the text; rows without doc_id
    come last among equals. Null and empty texts have no features and weight 0. Repeated rows are scored and drawn each for itself.
    An empty target says that all features are as likely as before smoothing; no documents: no rows.
    """
    gains = bucket_gains(bucket_counts(docs, order), bucket_counts(target, order))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    weighed = own.mapInArrow(_weigh(gains, order), "doc_id long, tie long, n_features long, n_words long, weight long")
    scored = store_from_python(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scores")
    eligible, rest = scored.where(F.col("n_words") >= min_words), scored.where(F.col("n_words") < min_words)
    drawn = eligible.count() * percent // 100
    ranked = number_rows(eligible.drop("n_words"), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "tie"], (), "place", store)
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, rank).union(rest.select(*columns, F.lit(None).cast("long").alias("rank")))
