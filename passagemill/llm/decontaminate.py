"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders; windows of ``WINDOW`` template tokens are hashed and joined with those of
the benchmark. A text has three readings, each with windows of its own: a capital at the start of a sentence is a word, or it
is a name, or nothing is a placeholder and case does not matter. So a question may begin with a name, and a copy in capitals
is a copy (in capitals with other names it is found only by windows without names). Matching windows of one document and item on one diagonal are an alignment. Its slots must be consistent: an item's
value always stands for the same document value (different values may stand for one). Windows that contradict the value which
most windows tell are dropped. Alignments that cover enough of an item's tokens, or ``MIN_RUN`` of them in a row, make the document
contaminated, whether it repeats the item or asks it with other numbers and names.

The benchmark's windows set bits in a bitmap of fixed size that every task gets; document windows that miss it never leave
their task. Those that hit it, by right or by chance, are joined by hash, so the bitmap only saves work. A long text is cut into
parts that overlap by a window. An alignment has at most one window for each token of the item, so it fits one row.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill.llm.shared import row_key, store, store_from_python

WINDOW = 8
#: Items with fewer tokens say too little to be looked for; those with fewer than WINDOW are one window.
MIN_TOKENS = 5
MIN_COVERAGE = 0.5
#: Tokens of an item in a row that are enough, however long the item is.
MIN_RUN = 16
BITMAP_BITS = 24
SEED = 7
# Fixed value: units, after a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz ml cl l litre litres liter liters "
    "gal s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years hz khz mhz ghz "
    "b kb mb gb tb w kw mw v kv a ma j kj cal kcal n pa kpa bar c f k degrees percent % ° $ € £ dollar dollars euro euros "
    "pound pounds cent cents mph kph".split()
)
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+(?:[.,:/]\d+)*|[%°$€£]|[.!?:\n]")
_WORD, _CAPITAL, _NUMBER, _UNIT, _END = range(5)
_PLACEHOLDER = {_NUMBER: np.uint64(0x9E3779B97F4A7C15), _CAPITAL: np.uint64(0xC2B2AE3D27D4EB4F), _UNIT: np.uint64(0x165667B19E3779F9)}
_STEP = np.uint64(0xD6E8FEB86659FD93)
_KIND_BITS = np.uint64(7)
_WORDS_REMEMBERED = 300_000
_SLICE = 1 << 20  # characters
_READINGS = (np.uint64(0), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


class _Codes(dict):
    """The hash of a token's lower-case form, its kind in the lowest three bits; forgotten when there are too many."""

    def __missing__(self, token: str) -> int:
        if len(self) >= _WORDS_REMEMBERED:
            self.clear()
        low = token.lower()
        if token[0] in ".!?:\n":
            kind = _END
        elif token[0].isdigit():
            kind = _NUMBER
        elif low in UNITS:
            kind = _UNIT
        else:
            kind = _CAPITAL if len(token) > 1 and token[0].isupper() and token[1:] == low[1:] else _WORD
        self[token] = value = xxhash.xxh3_64_intdigest(low, SEED) & ~7 | kind
        return value


_codes = _Codes()


class Template:
    """Tokens of a text, or of a part of one, in the three readings.

    ``codes[r]`` are their codes in reading r, those of placeholders alike by type; ``slot[r]`` says which are placeholders.
    """

    def __init__(self, tokens: list[str]):
        codes = np.fromiter(map(_codes.__getitem__, tokens), np.uint64, len(tokens))
        kinds = (codes & _KIND_BITS).astype(np.int8)
        self.at = np.flatnonzero(kinds != _END)  # indices into tokens
        after_end = np.concatenate([[True], kinds[:-1] == _END])[self.at] if len(tokens) else np.empty(0, bool)
        codes, kinds = codes[self.at], kinds[self.at]
        after_number = np.concatenate([[False], kinds[:-1] == _NUMBER])[: len(kinds)]
        kinds = np.where((kinds == _UNIT) & ~after_number, _WORD, kinds)
        words = codes & ~_KIND_BITS
        named = words.copy()
        for kind, code in _PLACEHOLDER.items():
            named[kinds == kind] = code
        first = (kinds == _CAPITAL) & after_end
        self.codes = [np.where(first, words, named), named, words]
        self.slot = [(kinds != _WORD) & ~first, kinds != _WORD, np.zeros(len(kinds), bool)]
        self.tells = [None, first, kinds != _WORD]  # where a reading differs from the first
        self.tokens = tokens

    def windows(self, length: int, reading: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of each window, in order; of the second and third reading those that differ from the first."""
        codes = self.codes[reading]
        n = len(codes) - length + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        start = np.arange(n)
        if reading:
            told = np.concatenate([[0], np.cumsum(self.tells[reading])])
            start = np.flatnonzero(told[length:] > told[:-length])
        hashes = np.full(len(start), _READINGS[reading])
        for k in range(length):
            hashes = hashes * _STEP + codes[start + k]
        return start, (hashes ^ (hashes >> np.uint64(29))) * _STEP

    def slots(self, start: int, length: int, reading: int = 0) -> list[str]:
        """What stands in the placeholders of a window."""
        part = self.at[start : start + length][self.slot[reading][start : start + length]]
        return [self.tokens[i].lower() for i in part]


def templates(text: str | None) -> Iterator[tuple[Template, int, int]]:
    """(template, first, again) of each part of a text: the place of its first token in the text, and how many of its tokens
    the part before had too."""
    text, start, carried, first, again = text or "", 0, [], 0, 0
    while True:
        ends = [at for at in (text.find(sep, start + _SLICE) for sep in (" ", "\n")) if at >= 0]
        end = min(ends, default=len(text))  # no token is cut
        part = Template(carried + _TOKEN.findall(text[start:end]))
        yield part, first, again
        if end == len(text):
            return
        again = min(WINDOW + 1, len(part.at))  # one more than a window: what the first is depends on what stood before it
        first += len(part.at) - again
        carried = part.tokens[part.at[-again] :] if again else []
        start = end


_ITEM = "item_id long, n_tokens long, length long, item_at long, window long, item_slots array<string>"
_HIT = "doc_id long, row_key string, length long, doc_at long, window long, doc_slots array<string>"
_ALIGNED = "doc_id long, row_key string, item_id long, n_tokens long, n long, slots long, same boolean, run long, tokens array<long>"


def _columns(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for item_id, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist()):
            item = Template(_TOKEN.findall(text or ""))
            n = len(item.at)
            length = min(n, WINDOW)
            for reading in range(len(_READINGS) if n >= MIN_TOKENS else 0):
                start, hashes = item.windows(length, reading)
                found = zip(start.tolist(), hashes.view(np.int64).tolist())
                rows += [(item_id, n, length, i, h, item.slots(i, length, reading)) for i, h in found]
        yield _columns(_ITEM, rows)


def _document_windows(bitmap: np.ndarray, lengths: list[int]):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, key, text in zip(batch["doc_id"].to_pylist(), batch["row_key"].to_pylist(), batch["text"]):
                for doc, first, again in templates(text.as_py()):
                    for length in lengths:
                        for reading in range(len(_READINGS)):
                            start, hashes = doc.windows(length, reading)
                            place = hashes >> np.uint64(64 - BITMAP_BITS)
                            told = bitmap[place >> np.uint64(3)] >> (place & _KIND_BITS).astype(np.uint8) & 1
                            for i in np.flatnonzero(told & (start + length > again)).tolist():
                                at = int(start[i])
                                rows.append((doc_id, key, length, first + at, int(hashes[i].view(np.int64)), doc.slots(at, length, reading)))
            yield _columns(_HIT, rows)
        _codes.clear()  # the process serves later stages too

    return windows


def consistent(windows: list[dict], length: int) -> tuple[int, int, bool, int, list[int]]:
    """(windows, slot pairs, same values, longest run, tokens covered) of an alignment without the windows that contradict it.

    An item's value stands for the document value that most windows give it, of equally many for the smallest.
    """
    seen: dict[str, Counter] = defaultdict(Counter)
    pairs = [list(zip(w["item_slots"], w["doc_slots"])) for w in windows]
    for a, b in (pair for window in pairs for pair in set(window)):
        seen[a][b] += 1
    stands_for = {a: min(found, key=lambda b: (-found[b], b)) for a, found in seen.items()}
    kept = [(w["item_at"], p) for w, p in zip(windows, pairs) if all(stands_for[a] == b for a, b in p)]
    tokens = sorted({at + k for at, _ in kept for k in range(length)})
    run = longest = 0
    for before, token in zip([None, *tokens], tokens):
        run = run + 1 if before == token - 1 else 1
        longest = max(longest, run)
    told = {pair for _, p in kept for pair in p}
    return len({at for at, _ in kept}), len(told), all(a == b for a, b in told), longest, tokens


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            found = consistent(r["windows"], r["length"])
            if found[0]:
                rows.append((r["doc_id"], r["row_key"], r["item_id"], r["n_tokens"], *found))
        yield _columns(_ALIGNED, rows)


def _bitmap(items: DataFrame) -> np.ndarray:
    """The items' windows as bits, by their highest bits: at most 2^BITMAP_BITS / 32,768 rows of 4 KB reach the driver."""
    place = F.shiftrightunsigned("window", 64 - BITMAP_BITS) + 1  # counted from 1
    bits = items.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    bitmap = np.zeros(1 << BITMAP_BITS >> 3, np.uint8)
    for row in bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        start = (row["bucket"] - 1) * 4096
        bitmap[start : start + 4096] = np.frombuffer(row["bits"], np.uint8)
    return bitmap


def contaminated(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE, min_run: int = MIN_RUN) -> DataFrame:
    """doc_id, item_id, coverage, longest_run, n_windows, n_slots, verbatim, row_key: a row per document and item it holds, stored.

    ``docs``: doc_id, text; ``benchmark``: item_id, text; whatever else there is. ``coverage`` is the share of the item's tokens in
    consistent alignments, ``longest_run`` the most in a row, ``row_key`` is :func:`shared.row_key` of doc_id and text, ``n_slots`` their placeholder pairs, ``verbatim`` whether all of these hold the same values. Null and
    empty texts match nothing, rows without item_id are not looked for. Rows without doc_id are reported with a null doc_id, those of
    different texts apart. Repeated rows of a document are reported once, items with equal texts each. No rows in, no rows out.
    """
    known = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = store_from_python(known.mapInArrow(_item_windows, _ITEM), "item_windows")
    lengths = [r[0] for r in items.select("length").distinct().collect()]  # at most WINDOW of them
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text"), "text")
    hits = store_from_python(own.mapInArrow(_document_windows(_bitmap(items), lengths), _HIT), "document_windows")
    hits = hits.dropDuplicates(["row_key", "length", "doc_at", "window"])  # of repeated rows one
    matches = hits.join(items, ["window", "length"]).where("size(doc_slots) = size(item_slots)")
    told = (2 * F.size("item_slots") <= F.col("length")) | (F.col("item_slots") == F.col("doc_slots"))
    alignment = ["row_key", "doc_id", "item_id", "n_tokens", "length", (F.col("doc_at") - F.col("item_at")).alias("diagonal")]
    aligned = matches.where(told).groupBy(*alignment).agg(F.collect_list(F.struct("item_at", "item_slots", "doc_slots")).alias("windows"))
    spread = store_from_python(aligned.mapInArrow(_align, _ALIGNED), "alignments")
    # a document may hold an item many times: unite token by token, combining before the shuffle
    pair = ["row_key", "doc_id", "item_id", "n_tokens"]
    by_token = spread.select("*", F.explode("tokens").alias("token")).groupBy(*pair, "token").agg(F.min("same").alias("same"))
    covered = by_token.groupBy(*pair).agg(F.count("*").alias("covered"), F.min("same").alias("verbatim"))
    sizes = spread.groupBy("row_key", "item_id").agg(F.sum("n").alias("n_windows"), F.sum("slots").alias("n_slots"), F.max("run").alias("longest_run"))
    share = F.col("covered") / F.col("n_tokens")
    found = covered.join(sizes, ["row_key", "item_id"]).where((share >= min_coverage) | (F.col("longest_run") >= min_run))
    return store(found.select("doc_id", "item_id", share.alias("coverage"), "longest_run", "n_windows", "n_slots", "verbatim", "row_key"), "contaminated")
