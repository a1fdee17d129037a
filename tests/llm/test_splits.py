import random
from itertools import combinations, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from subloom.llm import leaks
from subloom.llm.groups import components, grouped_splits, related, related_pairs, rendezvous_splits, show_key
from subloom.llm.leaks import cross_split_pairs
from subloom.llm.wordstream import Sequences, WordHashes, edit_distance
from subloom.operators import skew


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance():
    r = random.Random(1)
    for _ in range(400):
        a, b = ([r.choice("abcd") for _ in range(r.randint(0, 12))] for _ in range(2))
        want = plain_distance(a, b)
        for most in (0, 2, 5, 20):
            got = edit_distance(a, b, most)
            assert got == want if want <= most else got > most


def test_digest_is_the_same_wherever_it_stands():
    s = Sequences(["x a b c y", "a b c", "", "a, B! c"], WordHashes())
    assert s.digest(np.array([1]), np.array([4]))[0] == s.records()[1] == s.records()[3]


def words(x):
    return [w for w in ("".join(c for c in t.lower() if c.isalnum()) for t in " ".join(y or "" for y in x).split()) if w]


@pytest.mark.parametrize("seed", [1, 2])
def test_leaks_against_brute_force(spark, seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[r.choice(vocabulary) for _ in range(r.choice([3, 6, 9, 14, 20, 45]))] for _ in range(60)]
    rows = []
    for i in range(240):
        t = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 4])):
            k = r.randrange(len(t))
            t[k : k + 1] = r.choice([[], [r.choice(vocabulary)], [t[k], r.choice(vocabulary)]]) or [t[k]]
        a, b = sorted(r.randrange(len(t) + 1) for _ in range(2))
        parts = [" ".join(t[:a]) or None, " ".join(t[a:b]).upper(), " , ".join(t[b:])]
        rows.append((i, r.choice(["train", "validation", "test", None]), *parts))
    rows += [(900, "train", None, None, None), (901, "test", "", " ! ", None)]
    d = spark.createDataFrame([(*x, 1) for x in rows], "record_id long, split string, before string, text string, after string, cls int")
    got = {(x["eval_id"], x["train_id"]): x["edits"] for x in cross_split_pairs(d, "record_id", "split", ["before", "text", "after"]).collect()}
    want = {}
    for x, y in product(rows, rows):
        if x[1] in ("validation", "test") and y[1] == "train":
            p, q = words(x[2:]), words(y[2:])
            e = plain_distance(p, q) if p and q else 99
            if 5 * e <= max(len(p), len(q)):
                want[x[0], y[0]] = e
    assert got == want
    per = {x["eval_id"]: (x["n_pairs"], x["n_exact"]) for x in leaks.leaks_per_record(d, "record_id", "split", ["before", "text", "after"]).collect()}
    assert per == {i: (sum(k[0] == i for k in want), sum(k[0] == i and e == 0 for k, e in want.items())) for i, _ in want}
    assert cross_split_pairs(d.limit(0), "record_id", "split", ["before", "text", "after"]).count() == 0


def met(a, b):
    """Whether an evaluation record a and a training record b share a key at near places."""
    memo, longer = WordHashes(), max(len(a), len(b))
    keys = []
    for t, tiled in ((a, False), (b, True)):
        s = Sequences([" ".join(t)], memo)
        keys.append(leaks._table(s, s.records(), set(), tiled))
    both = keys[0].merge(keys[1], on="chunk")
    return bool((5 * (both["at_x"] // leaks._POS - both["at_y"] // leaks._POS).abs() <= longer).any())


@pytest.mark.parametrize("n", range(10, 61))
def test_pairs_at_one_fifth_share_a_key(n):
    r = random.Random(n)
    a = [f"w{i}" for i in range(n)]
    most = n // 5
    placements = [[5 * i + 4 for i in range(most)], [5 * i for i in range(most)], [4 * i for i in range(most)], [4 * i + 3 for i in range(most)]] + [r.sample(range(n), most) for _ in range(15)]
    for at in placements:
        for kind in ("replace", "drop", "mixed"):
            b = [[f"x{i}"] if kind == "replace" or kind == "mixed" and r.random() < 0.5 else [] for i in range(n)]
            b = [w for i in range(n) for w in (b[i] if i in at else [a[i]])]
            assert 5 * edit_distance(a, b, most) <= max(len(a), len(b))
            assert met(a, b) and met(b, a)


@pytest.mark.parametrize("n", range(10, 31))
def test_replaced_words_at_every_place(n):
    """Every way to replace a fifth of n words (a sample of them above 20 words)."""
    r = random.Random(n)
    places = list(combinations(range(n), n // 5)) if n <= 20 else [r.sample(range(n), n // 5) for _ in range(2000)]
    a = [f"w{i}" for i in range(n)]
    memo, texts = WordHashes(), [" ".join(f"x{i}" if i in at else w for i, w in enumerate(a)) for at in places]
    one, many = Sequences([" ".join(a)], memo), Sequences(texts, memo)
    for tiled in (False, True):
        keys, other = (leaks._table(s, s.records(), set(), k) for s, k in ((one, tiled), (many, not tiled)))
        both = keys.merge(other, on="chunk")
        off = (both["at_x"] // leaks._POS - both["at_y"] // leaks._POS).abs()
        turned = [int(x).bit_count() for x in (both["parity_x"] ^ both["parity_y"]).to_numpy().view(np.uint64)]
        assert both["cls_y"][5 * off <= n].nunique() == len(set(texts)) and max(turned) <= 2 * (n // 5)


def test_fifteen_words(spark):
    """Runs of three words are all that stays of fifteen with three replaced."""
    a = [f"w{i}" for i in range(15)]
    b = [f"x{i}" if i in (3, 7, 11) else w for i, w in enumerate(a)]
    short = [w for i, w in enumerate(a) if i not in (3, 7, 11)]
    rows = [(1, "test", " ".join(a)), (2, "train", " ".join(b)), (3, "train", " ".join(short)), (4, "test", " ".join(short)), (5, "train", " ".join(a))]
    d = spark.createDataFrame(rows, "record_id long, split string, text string")
    got = {(x["eval_id"], x["train_id"]) for x in cross_split_pairs(d, "record_id", "split", ["text"]).collect()}
    assert got == {(1, 2), (1, 3), (1, 5), (4, 2), (4, 3), (4, 5)}


def test_long_records_at_one_fifth(spark):
    """Every fifth word is another one: no stretch of more than four words is the same."""
    r = random.Random(4)
    rows = []
    for n in range(25, 61):
        t = [f"v{r.randrange(400)}" for _ in range(n)]
        other = [f"x{r.randrange(400)}" if i % 5 == 4 else w for i, w in enumerate(t)]
        rows += [(n, "test", " ".join(t)), (100 + n, "train", " ".join(other))]
    d = spark.createDataFrame(rows, "record_id long, split string, text string")
    got = {(x["eval_id"], x["train_id"]) for x in cross_split_pairs(d, "record_id", "split", ["text"]).collect()}
    assert got == {(n, 100 + n) for n in range(25, 61)}


def test_pairs_of_little_overlap(spark):
    """28 words put into 112 so that a single tile, 3 of 140 words, stands untouched; and a pair with 4 of 35 words alike."""
    t = [f"w{i}" for i in range(112)]
    spots = {*range(1, 100, 4), 100, 106, 109}
    longer = [x for i, w in enumerate(t) for x in ([w, f"y{i}"] if i in spots else [w])]
    other = [w if i in (0, 1, 2, 3) else f"z{i}" for i, w in enumerate(t[:35])]
    rows = [(1, "test", " ".join(longer)), (2, "train", " ".join(t)), (3, "test", " ".join(t[:35])), (4, "train", " ".join(other))]
    d = spark.createDataFrame(rows, "record_id long, split string, text string")
    got = {(x["eval_id"], x["train_id"], x["edits"]) for x in cross_split_pairs(d, "record_id", "split", ["text"]).collect()}
    assert got == {(1, 2, 28)}


def test_hot_chunks_stay(spark, monkeypatch):
    """A stock context in all records, and edits in the other half alone; short stock records beside longer ones."""
    monkeypatch.setattr(leaks, "HOT_ROWS", 5)
    stock = [f"s{i}" for i in range(14)]
    rows = []
    for i in range(12):
        own = [f"o{i}n{k}" for k in range(16)]
        other = [f"x{i}n{k}" if k in (0, 3, 5, 8, 11, 14) else w for k, w in enumerate(own)]
        rows += [(i, "test", " ".join(stock + own)), (100 + i, "train", " ".join(stock + other))]
    rows += [(200 + i, "test", " ".join([*stock[:12], f"a{i}", f"b{i}"])) for i in range(8)]
    rows += [(300 + i, "train", " ".join([*stock[:12], f"c{i}", f"d{i}", f"e{i}"])) for i in range(8)]
    d = spark.createDataFrame(rows, "record_id long, split string, text string")
    left, right = (d.filter(f"split {op} 'train'").select("text") for op in ("<>", "="))
    assert len(leaks.hot_chunks(left, right)) > 3
    got = {(x["eval_id"], x["train_id"]) for x in cross_split_pairs(d, "record_id", "split", ["text"]).collect()}
    split = {i: t.split() for i, _, t in rows}
    near = lambda p, q: 5 * plain_distance(p, q) <= max(len(p), len(q))
    want = {(x[0], y[0]) for x, y in product(rows, rows) if x[1] == "test" and y[1] == "train" and near(split[x[0]], split[y[0]])}
    assert got == want and len(want) == 76


def test_show_keys(spark):
    names = ["vutesone bottle season 1 episode 5", "[team]_Vutesone-Bottle-1x08_1080p", "Vutesone.Bottle.S01E07", "VutesoneBottle_S2E9", "VUTESONE_BOTTLE_Ep_03_final", "vutesone_bottle_clock_s01e01", "live", "", None, "s01e01"]
    got = [x["k"] for x in spark.createDataFrame([(n,) for n in names], "n string").select(show_key(F.col("n")).alias("k")).collect()]
    assert got == ["vutesonebottle"] * 5 + ["vutesonebottleclock", "live", None, None, None]


def test_components(spark, monkeypatch):
    links = [("a", "b"), ("b", "c"), ("x", "y"), ("d", "c"), *[(f"n{i:02d}", f"n{i + 1:02d}") for i in range(20)]]
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    monkeypatch.setattr(skew, "SHARE", 20)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {**dict.fromkeys("abcd", "a"), **dict.fromkeys("xy", "x"), **{f"n{i:02d}": "n00" for i in range(21)}}
    assert components(spark.createDataFrame(links, "a string, b string").limit(0)).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_related_against_brute_force(spark, monkeypatch, hot):
    """Texts of many movies and movies of many texts, salted or not; movies of one and two texts make stars."""
    if hot:
        monkeypatch.setattr(skew, "HOT_ROWS", 1)
        monkeypatch.setattr(skew, "SHARE", 40)
    r = random.Random(3)
    texts = {f"show{i}_s01e01": {f"line {r.randrange(60)}" for _ in range(r.randint(2, 12))} | {"Stock!"} for i in range(30)}
    texts |= {f"tiny{i}_s01e01": {f"line {r.randrange(900)}", f"rare {i % 3}"} for i in range(6)} | {"lone_s01e01": {"rare 1"}}
    rows = [(m, t.upper() if r.random() < 0.5 else t) for m, ts in texts.items() for t in ts] + [("show1_s01e02", "alone"), (None, "line 1"), ("show2_s01e01", None), ("show2_s01e01", "...")]
    texts["show1_s01e02"] = {"alone"}
    keys = {m: {"".join(c for c in t.lower() if c.isalnum()) for t in ts} for m, ts in texts.items()}
    parent = {m: m for m in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in product(texts, texts):
        if a < b and (a.split("_")[0] == b.split("_")[0] or 2 * len(keys[a] & keys[b]) >= min(len(keys[a]), len(keys[b]))):
            parent[find(a)] = find(b)
    want = sorted((a, b) for a in texts for b in texts if a < b and find(a) == find(b))
    d = spark.createDataFrame([(*x, 1) for x in rows], "movie_id string, text string, n int")
    assert sorted(tuple(x) for x in related_pairs(related(d, "movie_id", "text")).collect()) == want


def test_splits_meet_the_shares(spark):
    r = random.Random(7)
    sized = spark.createDataFrame([(f"c{i}", r.randint(1, 90)) for i in range(900)] + [("big", 20_000)], "component string, n long")
    shares = {"train": 0.8, "validation": 0.1, "test": 0.1}
    out = rendezvous_splits(sized, shares).join(sized, "component")
    total = {x["split"]: x["s"] for x in out.groupBy("split").agg({"n": "sum"}).withColumnRenamed("sum(n)", "s").collect()}
    assert all(abs(total[s] / sum(total.values()) - shares[s]) < 0.02 for s in shares)
    assert out.filter("component = 'big'").first()["split"] == "train"
    assert rendezvous_splits(sized.limit(0), shares).count() == 0
    d = spark.createDataFrame([(i, None if i == 5 else f"m{i % 40}_s01e01", f"t{i}") for i in range(400)], "record_id long, movie_id string, text string")
    rows = grouped_splits(d, "record_id", "movie_id", "text", shares)
    assert rows.count() == 400 and rows.groupBy("component").agg({"split": "count"}).count() == rows.select("component", "split").distinct().count()
