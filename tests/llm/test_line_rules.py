import random
import re
from collections import Counter

import pytest

from passagemill.llm.line_rules import clean_documents

WS = " \t\n\x0b\x0c\r"


def plain(text):
    text = text or ""
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    lines = [line for line in text.split("\n") if line.strip(WS)]
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed)


def sample():
    rng = random.Random(8)
    texts = [None, "", " \n\t", "a b c a b c", "a a a a", "x", "a b", "Ünï cödé 😀 | # <b>\r\nx\r\n x\r\n"]
    for n in (5, 40, 120, 700):
        for size in (2, 6, 40, 4000):
            for _ in range(6):
                texts.append("".join(rng.choice([f"w{rng.randrange(size)}", "é", "#"]) + rng.choice([" ", " ", " ", "\n", "\t ", "\x0b"]) for _ in range(n)))
    return texts


def test_measures_equal_plain_statement(spark):
    texts = sample()
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)] + [(None, "a b", "k", 2)] * 2, "doc_id long, text string, kept string, bits int")
    found = clean_documents(docs).collect()
    assert len(found) == len(texts) + 2 and sum(r.doc_id is None for r in found) == 2
    for r in found:
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(texts[r.doc_id]), texts[r.doc_id]
            assert not (r.base_failed and r.kept)


PROSE = [" ".join(f"w{i}x{j}" for j in range(12)) + "." for i in range(8)]


@pytest.mark.parametrize(
    "lines, kept, removed",
    [
        (PROSE, True, []),
        (PROSE + ["Home | News | Sport | About us"], True, ["Home | News | Sport | About us"]),
        (PROSE + ["Licensed under the Apache License, Version 2.0."], True, ["Licensed under the Apache License, Version 2.0."]),
        (PROSE + ["no end"], True, ["no end"]),
        (PROSE[:6] + [" ".join(w + "###" for w in p.split()) for p in PROSE], False, [" ".join(w + "###" for w in p.split()) for p in PROSE]),
        ([p.replace(" ", " | ") for p in PROSE], False, [p.replace(" ", " | ") for p in PROSE]),
    ],
)
def test_verdict_follows_the_lines(spark, lines, kept, removed):
    docs = spark.createDataFrame([(1, "  \n".join(lines) + "\n\n")], "doc_id long, text string")
    row = clean_documents(docs).first()
    assert row.kept is kept and not row.base_failed
    assert row.cleaned_text == "\n".join(line for line in lines if line not in removed)


def test_empty_table_and_native_plan(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    found = clean_documents(docs)
    assert found.collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
