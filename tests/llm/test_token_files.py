import random
import zlib
from itertools import accumulate

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from passagemill.llm import token_files as T

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = T.Encoder(PATH)


def whole(text):
    return PLAIN.tokenizer.encode(text, add_special_tokens=False).ids


LETTERS = list("ab Z9éß日ひ \n\r\t\x0b\x00\x1c\x7f\x85\xa0\u1680\u2003\u200b\u2028\u3000«»“—_-$ '.,😀") + ["'s", "<|endoftext|>", "  ", "\n\n", " \n", "ab", " the"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(LETTERS), max_size=30).map("".join), max_size=4))
def test_pieces_give_the_ids_of_the_whole_text(texts):
    assert [ids.tolist() for ids in T.encoder(PATH).encode(texts)] == [whole(text) for text in texts]


@settings(deadline=None)
@given(st.lists(st.integers(0, (1 << 32) - 1) | st.integers(0, 300), max_size=50))
def test_ranks_round_trip(values):
    ranks = np.array(values, np.uint32)
    control, data = T.encode_ranks(ranks)
    assert len(control) == -(-len(values) // 4) and len(data) == sum(max(1, (v.bit_length() + 7) // 8) for v in values)
    assert T.decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values)).tolist() == values


def test_frequent_ids_take_one_byte():
    ids = np.array([70000] * 9 + list(range(300)), np.uint32)
    packed = T.pack_segment([1], [len(ids)], ids)
    n_docs, n_ids, n_ranks, n_data = np.frombuffer(packed[:16], "<u4")
    assert (n_docs, n_ids, n_ranks) == (1, 309, 301) and n_data == 309 + 45  # 45 ranks above 255


def rows():
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["the", "Zähl", "x.", "\n", "  "], k=rng.randrange(60))) for _ in range(200)]
    return [(1000 - 3 * i, t, b"x", 5) for i, t in enumerate(texts)] + [(-5, None, b"", 1), (7, "", b"", 1), (None, "no id", b"", 1), (40, "twice", b"", 1), (40, "twice", b"", 1), (41, "long " * 5000, b"", 1)]


@pytest.mark.parametrize("segment", [1 << 21, 50])
def test_files_equal_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(T, "SEGMENT_IDS", segment)
    docs = spark.createDataFrame(rows(), "doc_id long, text string, ids binary, start int").repartition(4)
    found = sorted(T.token_digest(docs, PATH, 2).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows()), key=lambda i: (i is not None, i))
    want = sorted(((i, whole(t or "") + [2]) for i, t, *_ in rows()), key=lambda r: (r[0] is not None, r[0]))
    assert [r.n_tokens for r in found] == [len(ids) for _, ids in want]
    assert [r.start for r in found] == [0, *accumulate(len(ids) for _, ids in want)][:-1]
    assert [r.ids_crc32 for r in found] == [zlib.crc32(np.array(ids, "<u4").tobytes()) for _, ids in want]


def test_every_file_is_complete_and_in_order(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, ids binary, start int")
    shards = T.write_tokens(docs, PATH, 2, files=3).collect()
    assert len(shards) == 3 and sum(s.n_docs for s in shards) == len(rows())
    for s in shards:
        files, name = T.file_system(s.path)
        with files.open_input_stream(name) as stream:
            assert sum(len(ids) for _, _, ids in T.read_segments(stream)) == s.n_ids
        with files.open_input_stream(name) as stream:
            raw = stream.read()
        with pytest.raises(ValueError):
            list(T.read_segments(T.pa.BufferReader(raw[:-1])))


def test_empty_table(spark):
    assert T.token_digest(spark.createDataFrame([], "doc_id long, text string"), PATH, 2).collect() == []


def test_other_tokenizers_get_whole_texts():
    other = T.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.by_piece
    assert other.encode(["Hello  you"])[0].tolist() == other.tokenizer.encode("Hello  you", add_special_tokens=False).ids


def test_special_strings_get_the_ids_of_a_fresh_tokenizer(spark):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "no such thing", "<|endoftext|>", " <|endoftext|>  x y<|endoftext|>z", "<|endoftext|", "", "b  a"]
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275] and [i.tolist() for i in T.Encoder(PATH).encode(texts)] == want
    assert T.Encoder(PATH, plain=True).encode(texts[:1])[0].tolist() == [64, 1279, 91, 437, 1659, 5239, 91, 29, 275]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.ids_crc32 for r in T.token_digest(docs, PATH, 2).collect()}
    assert found == {i: zlib.crc32(np.array([*ids, 2], "<u4").tobytes()) for i, ids in enumerate(want)}
