"""Importance resampling of documents towards a target: hashed n-gram generative models, sampled by Gumbel top-k.

A document's weight is the ratio of its likelihood under the target's model to that under the raw text's model. The raw text
is a mixture of the target's kind of text, low-quality text and toxic text, each with an n-gram model of its own, in shares
that expectation maximisation fits to all raw documents. Low quality shows in how often n-grams occur: its model counts
hashed unigrams and bigrams. Toxic text is ordinary but for a few words: its model counts which hashed unigrams a document
has at all, and the stems of its different longer words, once for each word, so that words which are rare one by one but
inflected alike count together. Only what is significantly more frequent in toxic text than in the raw text has a ratio other
than 1 in its model: what is rarer there tells a text's language or subject, not that it is clean. All frequencies are estimated against those of the whole raw text with a Gamma prior of mean 1, so what is rare says little.

Sampling without replacement takes the k largest of log weight + Gumbel noise. k is the number of target documents that the
mixture expects among the raw ones, so it follows from all of the text. The k-th largest key is found by counting keys
digit by digit, never by sorting or collecting them.

Labelled rows serve as training texts up to ``LABELLED`` per class, those with the smallest hashes of their ids: that bounds
what is broadcast. Everything else is counted and scored over all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from passagemill.llm.shared import BATCH_BYTES, row_key, settings, store, store_from_python

LABELLED = 50_000
BUCKETS = 1 << 18
#: Shapes of the Gamma priors of the two models' ratios.
COUNT_PRIOR, PRESENCE_PRIOR = 5.0, 1.0
#: A unigram of the presence model counts if twice its log likelihood ratio is above this: four standard deviations.
SIGNIFICANT = 16.0
SEED = 23
CLASSES = ("raw", "target", "low", "toxic")
#: Sample keys are compared in steps of 1 / KEY_STEPS; keys that agree on that are taken or left together.
KEY_STEPS = 1 << 20
_TOKEN = re.compile(rb"[a-z0-9_\x80-\xff]+|[^a-z0-9_\x80-\xff\s]+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)  # odd multipliers
_WORDS_REMEMBERED = 200_000
#: Bytes of text that are cut into tokens at once, and rows of counts that leave a task at once.
_SLICE, _ROWS = 1 << 20, 1 << 16
#: Bytes of a word's stem.
STEM = 7


class _Hashes(dict):
    """The 64-bit hash of each word met, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word, SEED)
        return value


_hashes = _Hashes()


def _slices(raw: bytes) -> Iterator[bytes]:
    """The text in parts of about ``_SLICE`` bytes that end before a blank or a line break, so that no token is cut."""
    start = 0
    while start < len(raw):
        ends = [at for at in (raw.find(sep, start + _SLICE) for sep in (b" ", b"\n")) if at >= 0]
        end = min(ends, default=len(raw))
        yield raw[start:end]
        start = end


def ngram_buckets(text: str | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The buckets of all unigrams and bigrams of a text; those of its different unigrams, and of the stem of each longer one.

    Tokens are runs of word characters or of signs, in lower case. A stem is repeated for each different word that has it. A long
    text comes in several parts that together say this, so that memory is bounded by what differs in it.
    """
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    raw = (text or "").encode().lower()
    several = len(raw) > _SLICE
    last, seen, stemmed = np.empty(0, np.uint64), np.zeros(BUCKETS if several else 0, bool), set()
    for part in _slices(raw):
        tokens = _TOKEN.findall(part)
        one = np.concatenate([last, np.fromiter(map(_hashes.__getitem__, tokens), np.uint64, len(tokens))])
        two = one[:-1] * _MIX[1] + one[1:] * _MIX[2]
        new = one[len(last) :]
        found = ((np.concatenate([new, two]) * _MIX[0]) >> shift).astype(np.int64)
        different = np.unique(found[: len(new)])
        longer = {t for t in set(tokens) if len(t) > STEM}
        if several:
            different = different[~seen[different]]
            seen[different] = True
            longer = {t for t in longer if _hashes[t] not in stemmed}
            stemmed.update(map(_hashes.__getitem__, longer))
            last = one[-1:]
        stems = [b" " + t[:STEM] for t in longer]  # no token holds a blank
        stem = np.fromiter(map(_hashes.__getitem__, stems), np.uint64, len(stems))
        yield found, np.concatenate([different, ((stem * _MIX[0]) >> shift).astype(np.int64)])


def label_sample(labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """doc_id, class (index in CLASSES): up to ``most`` labelled ids per class. Toxic goes before low, one label per id."""
    one = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.min("quality").alias("quality")
    )
    kind = F.when(F.col("toxic") == 1, 3).when(F.col("quality") == 0, 2).when(F.col("quality") == 1, 1)
    known = one.select("doc_id", kind.alias("class"))
    picks = [
        known.where(F.col("class") == c).orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(most) for c in (1, 2, 3)
    ]
    return picks[0].union(picks[1]).union(picks[2])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, len(CLASSES), BUCKETS), np.int64)  # model, class
    held: dict[tuple[int, int], list[np.ndarray]] = {}

    def add() -> None:
        for (model, kind), parts in held.items():
            counts[model, kind] += np.bincount(np.concatenate(parts), minlength=BUCKETS)
        held.clear()

    n_held = 0
    for batch in batches:
        for kind, text in zip(batch["class"].to_pylist(), batch["text"]):
            for found in ngram_buckets(text.as_py()):
                for model in (0, 1):
                    held.setdefault((model, kind or 0), []).append(found[model])
                n_held += len(found[0])
                if n_held > _SLICE:
                    add()
                    n_held = 0
    add()
    _hashes.clear()  # the process serves later stages too
    counts[:, 0] = counts.sum(axis=1)
    model, kind, bucket = np.nonzero(counts)
    for i in range(0, len(bucket), _ROWS):
        place = model[i : i + _ROWS], kind[i : i + _ROWS], bucket[i : i + _ROWS]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*place, counts[place])], ["model", "class", "bucket", "n"])


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratios to the target's model: 2 x BUCKETS, of low text (for all n-grams) and toxic text (for different unigrams and their stems).

    Those of a class without labelled texts, and both if the target has none, are -inf.
    """
    marked = docs.select("doc_id", "text").join(F.broadcast(label_sample(labels)), "doc_id", "left").select("text", "class")
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        counted = marked.mapInArrow(_count, "model long, class long, bucket long, n long")
        sums = counted.groupBy("model", "class", "bucket").agg(F.sum("n").alias("n")).toArrow()  # at most 8 x BUCKETS rows
    counts = np.zeros((2, len(CLASSES), BUCKETS))
    counts[tuple(sums[c].to_numpy() for c in ("model", "class", "bucket"))] = sums["n"].to_numpy()
    ratios = np.full((2, BUCKETS), -np.inf, np.float32)
    for model, kind, prior, least in ((0, 2, COUNT_PRIOR, 0.0), (1, 3, PRESENCE_PRIOR, SIGNIFICANT)):
        if counts[model, 1].any() and counts[model, kind].any():
            ratios[model] = _log_model(counts[model], kind, prior, least, kind == 3) - _log_model(counts[model], 1, prior, least)
    return ratios


def _log_model(counts: np.ndarray, kind: int, prior: float, least: float, excess: bool = False) -> np.ndarray:
    """Log of a class's bucket probabilities over those of the raw text; with ``excess`` only what is frequent departs from 1."""
    raw = counts[0] / counts[0].sum()
    n, expected = counts[kind], counts[kind].sum() * raw
    ratio = (prior + n) / (prior + expected)
    surprise = 2 * (n * np.log(np.where(n > 0, n, 1) / np.where(n > 0, expected, 1)) - (n - expected))
    ratio[(surprise < least) | (excess & (ratio < 1))] = 1.0
    return np.log(ratio / (ratio * raw).sum())


def _scores(text: Column, ratios: np.ndarray) -> Column:
    present = np.isfinite(ratios).all(axis=1)

    @pandas_udf("low double, toxic double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sums = np.where(present, np.zeros((len(texts), 2)), -np.inf)
            for i, t in enumerate(texts):
                for found in ngram_buckets(t):
                    for model in np.flatnonzero(present):
                        sums[i, model] += ratios[model, found[model]].sum(dtype=np.float64)
            yield pd.DataFrame({"low": sums[:, 0], "toxic": sums[:, 1]})
        _hashes.clear()

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, row_key, noise (unit), low, toxic (log likelihood of each other class minus the target's), stored."""
    ratios = fit(docs, labels)
    bits = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(SEED)), 11)
    noise = ((bits + 0.5) / F.lit(float(1 << 53))).alias("noise")
    scored = docs.select("doc_id", row_key("doc_id", "text"), noise, _scores(F.col("text"), ratios).alias("s"))
    return store_from_python(scored.select("doc_id", "row_key", "noise", "s.low", "s.toxic"), "scores")


def fit_shares(scored: DataFrame, tolerance: float = 1e-4, most: int = 30) -> tuple[float, float, float]:
    """The shares of target, low and toxic in the raw text, by expectation maximisation; one aggregation per step."""
    shares = (1 / 3, 1 / 3, 1 / 3)
    for _ in range(most):
        total, *parts = _joint(shares)
        means = scored.agg(*(F.avg(F.exp(p - total)) for p in parts)).first()
        if means[0] is None:
            return 1.0, 0.0, 0.0
        moved = max(abs(a - b) for a, b in zip(means, shares))
        shares = tuple(means)
        if moved < tolerance:
            break
    return shares


def _joint(shares: tuple[float, float, float]) -> list[Column]:
    """log of the mixture's likelihood over the target's, and of its three parts."""
    logs = [F.lit(float(np.log(s)) if s > 0 else float("-inf")) for s in shares]
    parts = [logs[0], logs[1] + F.col("low"), logs[2] + F.col("toxic")]
    top = F.greatest(*parts)
    return [top + F.ln(sum((F.exp(p - top) for p in parts[1:]), F.exp(parts[0] - top))), *parts]


def kth_largest(keys: DataFrame, k: int) -> int | None:
    """The k-th largest value of the long column ``key``, 16 bits per round; null for k < 1 or fewer than k rows."""
    if k < 1:
        return None
    found, left = 0, k  # the bits so far, as an offset from the smallest long; how many of those above are still to come
    offset = F.shiftrightunsigned("key", 0).bitwiseXOR(F.lit(-(1 << 63)))
    within = keys.select(offset.alias("offset"))
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned("offset", shift).bitwiseAND(F.lit(0xFFFF)).alias("digit")
        counts = within.groupBy(digit).count().collect()  # at most 65,536 rows
        for row in sorted(counts, key=lambda r: -r["digit"]):
            if row["count"] >= left:
                break
            left -= row["count"]
        else:
            return None
        found = (found << 16) | row["digit"]
        within = within.where(digit == row["digit"])
    return found - (1 << 63)


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, log_weight, sample_key and kept for each row of ``docs`` (doc_id, text, whatever else there is).

    ``labels``: doc_id, quality (1 good), toxic (1 toxic); nulls there are no label, several rows of an id count as one. Null and
    empty texts say nothing: their log weight is 0. Rows without doc_id are sampled like others. Repeated rows have equal keys:
    they stay or go together. Without target labels every weight is 0 in the log and all documents are kept; with them, and no
    target document expected, none is. Empty input: no rows.
    """
    return _sampled(score_documents(docs, labels)).select("doc_id", "log_weight", "sample_key", "kept")


def keep_resampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`resample` keeps, columns unchanged. Rows are judged one by one, also those without doc_id.

    Only keys and scores go through Python and are stored; the rows that go are left out by an anti join on their keys.
    """
    gone = store(_sampled(score_documents(docs, labels)).where("NOT kept").select("row_key").distinct(), "rejected")
    return docs.select(F.struct("*").alias("row"), row_key("doc_id", "text")).join(gone, "row_key", "left_anti").select("row.*")


def _sampled(scored: DataFrame) -> DataFrame:
    shares = fit_shares(scored)
    weight = -_joint(shares)[0]
    gumbel = -F.ln(-F.ln("noise"))
    keyed = scored.withColumn("log_weight", weight).withColumn("sample_key", F.col("log_weight") + gumbel)
    keyed = keyed.withColumn("key", F.round(F.col("sample_key") * KEY_STEPS).cast("long"))
    posterior = F.exp(F.least(F.col("log_weight") + F.lit(float(np.log(shares[0]))), F.lit(0.0)))
    expected = keyed.agg(F.sum(posterior)).first()[0]
    k = round(expected or 0)
    cut = kth_largest(keyed.select("key"), k)
    return keyed.withColumn("kept", F.lit(k > 0) if cut is None else F.col("key") >= cut)
