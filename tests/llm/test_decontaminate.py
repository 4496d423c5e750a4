import random
from itertools import groupby

import pytest

from passagemill.llm import decontaminate
from passagemill.llm.decontaminate import MIN_RUN, WINDOW, consistent, contaminated, templates

QUESTION = "If Anna buys 12 apples and 30 pears for 4 dollars, how much does Anna pay for 12 apples?"
OTHER = "If Maria buys 15 apples and 31 pears for 5 dollars, how much does Maria pay for 15 apples?"


def find(spark, docs, items, **more):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, item_id int, window string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in contaminated(docs, items, **more).collect()}


def template(text):
    (found,) = templates(text)
    return found[0]


def hashes(text, length, reading=0):
    return template(text).windows(length, reading)[1].tolist()


def test_placeholders():
    assert template("Anna met Bob at 5 km/h. The man saw 3,5 kg").slots(0, 99) == ["bob", "5", "km", "3,5", "kg"]
    assert template("Anna met Bob at 5 km/h. The man saw 3,5 kg").slots(0, 99, 1) == ["anna", "bob", "5", "km", "the", "3,5", "kg"]
    assert hashes("he met Bob at 7 kg", 6) == hashes("He met Carl at 9.5 km", 6)
    assert hashes("Tom met Bob", 3) != hashes("Eva met Bob", 3) and hashes("Tom met Bob", 3, 1) == hashes("Eva met Bob", 3, 1)
    assert hashes("THE 2 MEN", 3, 2) == hashes("the 2 Men", 3, 2) != hashes("the 3 Men", 3, 2)
    assert hashes("THE MAN", 2) == hashes("the man", 2) and not len(template(None).at) and not hashes("no slots", 2, 2)


@pytest.mark.parametrize("size", [1, 30, 1000])
def test_parts_of_a_long_text_say_the_same(monkeypatch, size):
    text = "\n".join(OTHER + f" Tom saw {i} kg. The end? yes" * (i % 3) for i in range(40))
    (want,) = templates(text)
    monkeypatch.setattr(decontaminate, "_SLICE", size)
    for reading in range(3):
        for length in (5, WINDOW):
            found = [
                (first + int(s), int(h), t.slots(int(s), length, reading))
                for t, first, again in templates(text) for s, h in zip(*t.windows(length, reading)) if s + length > again
            ]
            whole = [(int(s), int(h), want[0].slots(int(s), length, reading)) for s, h in zip(*want[0].windows(length, reading))]
            assert found == whole


def test_other_numbers_and_names_are_caught_if_consistent(spark):
    docs = [(1, "Some words here. " + OTHER + " And more."), (4, QUESTION.upper()), (5, "x " * 50), (6, QUESTION.lower())]
    found = find(spark, docs, [(1, QUESTION)])
    assert set(found) == {(1, 1), (4, 1), (6, 1)} and not found[1, 1].verbatim and found[1, 1].n_slots == 6  # with the first word, a name in one reading
    assert found[4, 1].verbatim and found[4, 1].coverage == found[6, 1].coverage == 1


def test_contradicting_windows_are_dropped():
    def window(at, *pairs):
        return {"item_at": at, "item_slots": [a for a, _ in pairs], "doc_slots": [b for _, b in pairs]}

    found = consistent([window(0, ("1", "5")), window(1, ("1", "5"), ("2", "5")), window(2, ("1", "6")), window(9)], 3)
    assert found == (3, 2, False, 4, [0, 1, 2, 3, 9, 10, 11])
    assert consistent([window(0, ("1", "5")), window(1, ("1", "4"))], 2) == (1, 1, False, 2, [1, 2])


def reparameterised(rng, numbers, names, text):
    """The text with all numbers and names drawn anew; equal ones stay equal."""
    new = {n: str(rng.randrange(1, 30)) for n in numbers} | {n: rng.choice(["Eva", "Max", "Li", "Noor", "Ada"]) for n in names}
    return " ".join(new.get(w.rstrip(".,?"), w.rstrip(".,?")) + w[len(w.rstrip(".,?")):] for w in text.split())


def test_recall_of_reparameterised_questions(spark):
    rng = random.Random(9)
    verbs, things = "buys sells finds paints counts loses".split(), "apples bricks lamps coins cards shells".split()
    items, docs, planted = [], [], set()
    for i in range(60):
        a, b = rng.sample(["Tom", "Ann", "Bob", "Kim"], 2)
        n = rng.sample([str(k) for k in range(100, 160)], 4)
        v, t = rng.choices(verbs, k=3), rng.choices(things, k=3)
        text = f"{a} {v[0]} {n[0]} {t[0]} and {v[1]} {n[1]} {t[1]} of kind{i}. {b} {v[2]} {n[2]} {t[2]}. {a} gives {n[3]} of them to {b} in shop{i}. How many {t[0]} does {a} have left in case{i}?"
        items.append((i, text))
        body = " ".join(rng.choices(things + verbs, k=60))
        asked = reparameterised(rng, n, [a, b], text)
        docs.append((i, f"{body}. {[asked, asked, text.upper(), text.lower()][i % 4]} {body}"))
        planted.add((i, i))
        docs.append((1000 + i, body))
    found = set(find(spark, docs, items))
    assert len(found & planted) >= 0.9 * len(planted), len(found & planted)
    assert not any(d >= 1000 for d, _ in found)


def test_a_long_quotation_is_enough(spark):
    words = ["".join("abcdefghij"[int(d)] for d in f"{i:03d}") for i in range(400)]
    docs = [(1, "before " + " ".join(words[100:116]) + " after"), (2, "before " + " ".join(words[100:115]) + " after")]
    assert set(find(spark, docs, [(1, " ".join(words))])) == {(1, 1)}


def test_many_equal_rows_count_once(spark):
    found = find(spark, [(3, OTHER)] * 2000, [(1, QUESTION)])
    assert found[3, 1].n_windows == find(spark, [(3, OTHER)], [(1, QUESTION)])[3, 1].n_windows


def test_verbatim_passages_equal_brute_force(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    items = [(i, " ".join(word() for _ in range(rng.randrange(5, 40))) + ".") for i in range(20)]
    docs = []
    for i in range(120):
        body = [word() for _ in range(rng.randrange(0, 200))]
        if i % 2:
            part = items[rng.randrange(20)][1].split()
            cut = rng.randrange(len(part))
            body[len(body) // 2 : len(body) // 2] = part[: max(cut, 3)] * rng.choice([1, 1, 3])
        docs.append((i, " ".join(body)))
    strip = lambda t: [w.strip(".") for w in t.split()]
    want = {}
    for d, text in docs:
        words = strip(text)
        for i, item in items:
            w = strip(item)
            k = min(WINDOW, len(w))
            where = {tuple(words[a : a + k]) for a in range(len(words) - k + 1)}
            hit = {a + b for a in range(len(w) - k + 1) if tuple(w[a : a + k]) in where for b in range(k)}
            runs = [sum(1 for _ in g) for on, g in groupby(range(len(w)), lambda at: at in hit) if on]
            if 2 * len(hit) >= len(w) or max(runs, default=0) >= MIN_RUN:
                want[d, i] = len(hit) / len(w)
    found = find(spark, docs, items)
    assert {k: r.coverage for k, r in found.items()} == pytest.approx(want) and all(r.verbatim for r in found.values())
    assert len(want) > 10


def test_windows_of_placeholders_alone_tell_nothing(spark):
    names = "the Ab Cd Ef Gh Ij Kl Mn Op"
    docs = [(1, "the Qr St Uv Wx Yz Za Bc De"), (2, names)]
    assert set(find(spark, docs, [(1, names)])) == {(2, 1)}


def test_nulls_short_items_and_repeated_rows(spark):
    docs = [(None, QUESTION), (1, None), (2, ""), (3, QUESTION), (3, QUESTION), (4, "tiny")]
    found = find(spark, docs, [(1, QUESTION), (None, QUESTION), (2, "tiny"), (3, None), (4, QUESTION)])
    assert set(found) == {(d, i) for d in (None, 3) for i in (1, 4)}
    assert find(spark, [], [(1, QUESTION)]) == {} and find(spark, docs, []) == {}
