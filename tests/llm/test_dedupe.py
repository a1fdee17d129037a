import random

import pytest

from subloom.llm import textdupes
from subloom.llm.textdupes import Hasher, copies, readable_texts, same_text


def key(t):
    return "".join(c.lower() for c in t if c.isalnum())


def brute(rows, least):
    groups = {}
    for i, t in rows:
        if t is not None and len(key(t)) >= least:
            groups.setdefault(key(t), []).append(i)
    return sorted((i, min(g), len(g)) for g in groups.values() if len(g) > 1 for i in g)


def test_hashes_follow_letters_and_digits():
    h = Hasher()
    texts = ["Hello, World 1!", "hello world1", "hello world2", "", "!!", "ÉÀ", "éà", "x" * 2_500_000, "X " * 2_500_000]
    a, b, n = h(texts)
    assert (a[0], b[0], n[0]) == (a[1], b[1], n[1]) and a[0] != a[2] and n[3] == n[4] == 0 and a[5] == a[6]
    assert (a[7], b[7], n[7]) == (a[8], b[8], n[8])
    assert same_text("A-b", "ab!") and not same_text("ab", "abc") and same_text("", "..")


@pytest.mark.parametrize("least", [1, 3])
def test_copies(spark, least):
    r = random.Random(5)
    texts = [r.choice(["Yes.", "yes", "No", "n o", "", None, "A b c", "abc!", "ABC", "x1", "..."]) for _ in range(400)] + ["hot line!"] * 300
    rows = [(i, t) for i, t in enumerate(texts)]
    d = spark.createDataFrame([(*x, 1) for x in rows], "record_id long, text string, h1 int")
    assert sorted(tuple(x) for x in copies(d, "record_id", "text", least).collect()) == brute(rows, least)
    assert copies(d.limit(0), "record_id", "text").count() == 0


def test_lines_that_stand_once(spark, monkeypatch):
    rows = [(1, "abc"), (2, "a b c"), (3, "xyz"), (4, "x-yz"), (5, "once"), (6, None), (7, "..."), (8, "mno")]
    d = spark.createDataFrame(rows, "record_id long, text string")
    want = [(1, 1, 2), (2, 1, 2), (3, 3, 2), (4, 3, 2), (5, 5, 1), (8, 8, 1)]
    assert sorted(tuple(x) for x in copies(d, "record_id", "text", single=True).collect()) == want

    class Weak(Hasher):
        def __call__(self, texts):
            a, b, n = super().__call__(texts)
            return a * 0, b * 0, n

    monkeypatch.setattr(textdupes, "Hasher", Weak)
    assert sorted(tuple(x) for x in copies(d, "record_id", "text", single=True).collect()) == want
    assert copies(d.limit(0), "record_id", "text", single=True).count() == 0


def test_hot_group(spark, monkeypatch):
    from subloom.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    monkeypatch.setattr(skew, "SHARE", 4)
    rows = [(i, t) for i, t in enumerate(["hot line!"] * 90 + ["Hot, line"] * 30 + ["a", "A", "b"])]
    d = spark.createDataFrame(rows, "record_id long, text string")
    assert sorted(tuple(x) for x in copies(d, "record_id", "text").collect()) == brute(rows, 1)


def test_equal_hashes_of_other_texts(spark, monkeypatch):
    rows = [(1, "abc"), (2, "a b c"), (3, "xyz"), (4, "x-yz"), (5, "xyz"), (6, "mno")]

    class Weak(Hasher):
        def __call__(self, texts):
            a, b, n = super().__call__(texts)
            return a * 0, b * 0, n

    monkeypatch.setattr(textdupes, "Hasher", Weak)
    d = spark.createDataFrame(rows, "record_id long, text string")
    assert sorted(tuple(x) for x in copies(d, "record_id", "text").collect()) == brute(rows, 1)


def test_readable_payloads(spark):
    d = spark.createDataFrame([(1, '{"text": "a\\u00e9", "z": 1}'), (2, ' {"z":1,"text":"b"} '), (3, '{"text": "cut'), (4, None), (5, '{"other": 1}')], "record_id long, payload string")
    assert sorted(tuple(x) for x in readable_texts(d, "record_id", "payload").collect()) == [(1, "aé"), (2, "b")]
