"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

Documents are range-partitioned by doc_id once; each partition is tokenised in order and becomes one file, so the files
in order hold all documents in ascending doc_id order. A file is the magic followed by self-contained segments:

    n_docs, n_ids, n_ranks, n_data   u32 each
    doc_ids i64, known u8 (0: doc_id was null), lengths u32   one per document
    ids u32   one per rank: the id of rank 0, 1, ... (most frequent in the segment first, ties by id)
    control   a byte for four ids: two bits each, the number of data bytes of the id's rank less one
    data      the ranks, little-endian, one to four bytes each

All little-endian. A segment ends with the first document that fills ``SEGMENT_IDS``: memory is bounded by that and the
longest document. Frequencies are the segment's own, so no counting pass over the corpus is needed. Decoding looks the
lengths of four ids up by their control byte. A file is written under a name of its own and renamed when it is complete,
so a repeated or abandoned task leaves no partial file; files hold the same bytes whichever attempt wrote them.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill.llm.shared import file_system, new_folder, store_from_python

SEGMENT_IDS = 1 << 21
MAGIC = b"PMTOKEN1"
#: Distinct pieces whose ids a Python worker remembers: twice as many at most, those of the last two generations.
PIECES = 300_000
#: Bytes of text that one file, and so one task, is meant for.
FILE_BYTES = 32 << 20
_AT_ONCE = 4 << 20  # bytes of text encoded together
_GATHERED = 1 << 18  # pieces put in their places together
#: What is split from a letter before it. The apostrophe is not among them: 's and the like are pieces of their own.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

_LEADS = np.zeros(256, bool)  # blank and line feed
_LEADS[[0x20, 0x0A]] = True
_BLANKS = [c.encode() for c in map(chr, range(0x3001)) if c.isspace()]
_NO_BLANK = np.ones(256, bool)  # bytes that no blank character starts with
_NO_BLANK[[b[0] for b in _BLANKS]] = False
_WIDE_BLANKS = np.array([int.from_bytes(b.ljust(3, b"\0"), "big") for b in _BLANKS if len(b) > 1])


def _piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of texts that lie behind each other start: at each text, and at a blank or line feed before a non-blank."""
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    lead = np.flatnonzero(_LEADS[data])
    behind = padded[lead + 1]
    cut = _NO_BLANK[behind]
    wide = np.flatnonzero(~cut & (behind > 0x7F))
    first, second, third = (padded[lead[wide] + k].astype(np.int64) for k in (1, 2, 3))
    cut[wide] = ~np.isin(first << 16 | second << 8 | np.where(first < 0xE0, 0, third), _WIDE_BLANKS)
    at = np.zeros(len(data) + 1, bool)
    at[offsets] = True
    cut &= ~at[lead + 1]  # the last character of a text leads nothing
    at[lead[cut]] = True
    return np.flatnonzero(at[:-1])


class Encoder:
    """Ids of texts by a file of the tokenizers library; special strings in a text are special, or ordinary with ``plain``.

    A byte-level BPE that splits by its own pattern always splits before a blank or line feed that a non-blank follows. Its texts
    are cut there, and pieces met before are not encoded again; the ids are those of the whole text. Other tokenizers get whole
    texts, and so do texts that hold a special string.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_piece = self._splits_before_blanks(spec)
        self.special = [] if plain else [t["content"] for t in spec.get("added_tokens") or []]
        if self.by_piece:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # a character stands for a byte
            for token, i in vocabulary.items():
                self.n_bytes[i] = len(token)
        self.known: dict[str, bytes] = {}  # pieces met since the last change of generations
        self.before: dict[str, bytes] = {}  # those of the generation before

    @staticmethod
    def _splits_before_blanks(spec: dict) -> bool:
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = spec.get("normalizer") is None and all(t["special"] and not {" ", "\n"} & set(t["content"]) for t in spec.get("added_tokens") or [])
        splits = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        return bool(plain and splits and model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges"))

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_piece:
            return [np.array(ids, np.uint32) for ids in self._ids(texts)]
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        if whole:
            apart = dict(zip(whole, self._ids([texts[i] for i in whole])))
            rest = iter(self.encode([t for i, t in enumerate(texts) if i not in apart]))
            return [np.array(apart[i], np.uint32) if i in apart else next(rest) for i in range(len(texts))]
        if len(self.known) > PIECES:
            self.known, self.before = {}, self.known
        held = pa.array(texts, pa.large_string())
        offsets = np.frombuffer(held.buffers()[1], np.int64, len(texts) + 1)
        data = held.buffers()[2] or pa.py_buffer(b"")
        start = _piece_starts(np.frombuffer(data, np.uint8, offsets[-1]), offsets)
        bounds = pa.py_buffer(np.append(start, offsets[-1]))
        pieces = pa.LargeStringArray.from_buffers(len(start), bounds, data).dictionary_encode()
        return self._spelled(pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy(), np.searchsorted(start, offsets))

    def _spelled(self, pieces: list[str], which: np.ndarray, firsts: np.ndarray) -> list[np.ndarray]:
        """The ids of texts, of which each has the pieces ``which`` from its first to that of the next."""
        self._meet(pieces)
        found = [self.known[piece] for piece in pieces]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin = np.cumsum(size) - size
        held = np.frombuffer(b"".join(found), np.uint32)
        ends = np.concatenate([[0], np.cumsum(size[which])])
        ids = np.empty(ends[-1], np.uint32)
        for i in range(0, len(which), _GATHERED):
            part = which[i : i + _GATHERED]
            first, last = ends[i], ends[i + len(part)]
            ids[first:last] = held[np.arange(first, last) + np.repeat(begin[part] - ends[i : i + len(part)], size[part])]
        return [ids[a:b] for a, b in zip(ends[firsts].tolist(), ends[firsts[1:]].tolist())]

    def _meet(self, pieces: list[str]) -> None:
        """See that all pieces are known. A letter and a sign are always split: what ends in signs is put together from its parts."""
        known, before = self.known, self.before
        ends = {}
        todo: dict[str, None] = {}
        for piece in pieces:
            if piece in known:
                continue
            if piece in before:
                known[piece] = before[piece]
                continue
            stem = piece.rstrip(_SIGNS)
            if stem != piece and stem[-1:].isalpha():
                ends[piece] = stem
                if stem in before:
                    known[stem] = before[stem]
                if stem not in known:
                    todo[stem] = None
            else:
                todo[piece] = None
        self._learn(list(todo))
        tails = sorted({piece[len(stem) :] for piece, stem in ends.items()})
        tail_ids = {tail: np.array(ids, np.uint32).tobytes() for tail, ids in zip(tails, self._ids(tails))}
        known.update((piece, known[stem] + tail_ids[piece[len(stem) :]]) for piece, stem in ends.items())

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of pieces; many that were cut off are encoded as one text and told apart by their bytes."""
        alone, led = [], []
        for piece in pieces:  # the first of a text need not start as the others do
            (led if piece[0] in " \n" and not piece[1:2].isspace() and len(piece) > 1 else alone).append(piece)
        self.known.update((piece, np.array(ids, np.uint32).tobytes()) for piece, ids in zip(alone, self._ids(alone)))
        n_bytes = np.diff(np.frombuffer(pa.array(led, pa.large_string()).buffers()[1], np.int64, len(led) + 1))
        groups = [led[i : i + 256] for i in range(0, len(led), 256)]
        for i, (group, ids) in enumerate(zip(groups, self._ids(["".join(g) for g in groups]))):
            ids = np.array(ids, np.uint32)
            ends = np.cumsum(n_bytes[256 * i : 256 * i + len(group)])
            cuts = (4 * np.searchsorted(np.cumsum(self.n_bytes[ids]), ends, side="right")).tolist()
            raw = ids.tobytes()
            self.known.update((piece, raw[start:end]) for piece, start, end in zip(group, [0, *cuts], cuts))


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, plain: bool = False) -> Encoder:
    """The process's encoder for a file; building one takes a moment."""
    if (path, plain) not in _encoders:
        _encoders[path, plain] = Encoder(path, plain)
    return _encoders[path, plain]


_FOUR = np.array([[(control >> 2 * k & 3) + 1 for k in range(4)] for control in range(256)], np.uint8)
_MASK = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of u32 ranks."""
    n_bytes = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) < n_bytes[:, None]]
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = n_bytes - 1
    control = codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    return np.bitwise_or.reduce(control, axis=1).astype(np.uint8).tobytes(), data.tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    n_bytes = _FOUR[control].ravel()[:n]
    start = np.cumsum(n_bytes, dtype=np.int64) - n_bytes
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    value = padded[start].astype(np.uint32)
    for k in (1, 2, 3):
        value |= padded[start + k].astype(np.uint32) << np.uint32(8 * k)
    return value & _MASK[n_bytes]


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    counts = np.bincount(ids)  # as long as the tokenizer's vocabulary at most
    order = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    rank = np.zeros(len(counts), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    control, data = encode_ranks(rank[ids])
    known = np.array([d is not None for d in doc_ids], np.uint8)
    head = np.array([len(doc_ids), len(ids), len(order), len(data)], "<u4")
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    parts = (head, numbers, known, np.array(lengths, "<u4"), order.astype("<u4"))
    return b"".join(p.tobytes() for p in parts) + control + data


def read_segments(stream) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(doc_ids, lengths, ids) of each segment of an open file."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")

    def take(n: int, kind: str) -> np.ndarray:
        raw = stream.read(n * np.dtype(kind).itemsize)
        if len(raw) != n * np.dtype(kind).itemsize:
            raise ValueError("the token file ends inside a segment")
        return np.frombuffer(raw, kind)

    while head := stream.read(16):
        n_docs, n_ids, n_ranks, n_data = np.frombuffer(head, "<u4").tolist()
        numbers, known, lengths, ids = take(n_docs, "<i8"), take(n_docs, "u1"), take(n_docs, "<u4"), take(n_ranks, "<u4")
        ranks = decode_ranks(take(-(-n_ids // 4), "u1"), take(n_data, "u1"), n_ids)
        yield [n if k else None for n, k in zip(numbers.tolist(), known)], lengths, ids[ranks]


def _write(folder: str, path: str, end_id: int, plain: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        files, root = file_system(folder)
        name, hidden = f"{root}/{shard:06d}.tok", f"{root}/.{shard:06d}-{uuid.uuid4().hex}"
        encode, n_docs, n_ids = encoder(path, plain).encode, 0, 0
        doc_ids, parts, waiting, stream = [], [], 0, None
        for doc_id, ids in _encoded(batches, encode, end_id):
            if stream is None:
                files.create_dir(root, recursive=True)
                stream = files.open_output_stream(hidden)
                stream.write(MAGIC)
            doc_ids.append(doc_id)
            parts.append(ids)
            n_docs, n_ids, waiting = n_docs + 1, n_ids + len(ids), waiting + len(ids)
            if waiting >= SEGMENT_IDS:
                stream.write(pack_segment(doc_ids, [len(p) for p in parts], np.concatenate(parts)))
                doc_ids, parts, waiting = [], [], 0
        if stream is None:
            return
        if parts:
            stream.write(pack_segment(doc_ids, [len(p) for p in parts], np.concatenate(parts)))
        stream.close()
        files.move(hidden, name)
        row = {"shard": [shard], "path": [f"{folder}/{shard:06d}.tok"], "n_docs": [n_docs], "n_ids": [n_ids]}
        yield pa.RecordBatch.from_pydict(row)

    return write


def _encoded(batches: Iterator[pa.RecordBatch], encode, end_id: int) -> Iterator[tuple[int | None, np.ndarray]]:
    end = np.array([end_id], np.uint32)
    for batch in batches:
        ids, texts = batch["doc_id"].to_pylist(), batch["text"]
        start, size, lengths = 0, 0, pc.binary_length(texts).to_pylist()
        for stop in range(1, len(ids) + 1):
            size += lengths[stop - 1] or 0
            if size >= _AT_ONCE or stop == len(ids):
                group = encode([t or "" for t in texts[start:stop].to_pylist()])
                yield from ((d, np.concatenate([g, end])) for d, g in zip(ids[start:stop], group))
                start, size = stop, 0


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, files: int | None = None, plain: bool = False) -> DataFrame:
    """Write token files into the shared folder; returns the stored list of them: shard, path, n_docs, n_ids, start.

    Needs doc_id (long) and text, whatever else there is. ``files`` (default: one for ``FILE_BYTES`` of text, and no fewer than
    the session's default parallelism) is the number of ranges; a range without rows has no file. Null and empty texts are ``end_id`` alone. Rows without doc_id come first, rows of
    equal doc_id follow each other, all are kept. ``start`` counts the ids of the shards before. Special strings in a text get
    the library's special ids, with ``plain`` those of ordinary text. Empty input: no files.
    """
    spark = docs.sparkSession
    if files is None:
        size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        files = max(spark.sparkContext.defaultParallelism, -(-size // FILE_BYTES))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    placed = own.repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    written = placed.mapInArrow(
        _write(new_folder(spark, "token_files"), tokenizer, end_id, plain), "shard long, path string, n_docs long, n_ids long"
    )
    shards = sorted(store_from_python(written, "token_shards").collect(), key=lambda r: r.shard)  # one row per file
    before = accumulate((r.n_ids for r in shards), initial=0)
    rows = [(*r, start) for r, start in zip(shards, before)]
    return spark.createDataFrame(rows, "shard long, path string, n_docs long, n_ids long, start long")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist()):
            files, name = file_system(path)
            with files.open_input_stream(name) as stream:
                for doc_ids, lengths, ids in read_segments(stream):
                    cuts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
                    raw = ids.astype("<u4").tobytes()
                    for i in range(0, len(doc_ids), 256):
                        part = range(i, min(i + 256, len(doc_ids)))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([doc_ids[k] for k in part], pa.int64()),
                                pa.array(cuts[part.start : part.stop] + start),
                                pa.array([raw[4 * cuts[k] : 4 * cuts[k + 1]] for k in part], pa.binary()),
                            ],
                            ["doc_id", "start", "ids"],
                        )
                    start += int(cuts[-1])


def read_tokens(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (binary, u32 little-endian), read back from the files."""
    tasks = max(1, shards.count())
    return shards.select("path", "start").repartition(tasks).mapInArrow(_read, "doc_id long, start long, ids binary")


def token_digest(docs: DataFrame, tokenizer: str, end_id: int, plain: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from files written and read back (cases: :func:`write_tokens`)."""
    ids = read_tokens(write_tokens(docs, tokenizer, end_id, plain=plain))
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return ids.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))
