import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from subloom.llm.bpe import DEFAULT_DIR, encoder
from subloom.llm.tokens import encode_corpus, fill_containers, pack

pytestmark = pytest.mark.skipif(not Path(DEFAULT_DIR).exists(), reason="no vocabulary files")
ODD = ["", " ", "  a", "a  ", "a \n b", "it's we'll", "x" * 3000, "ab" * 500, "🙂🏽" * 50, " \x1c\x85a", "  b", "日本語 текст é", "\t\t\n", "don't  DON'T", "<|endoftext|>"]


def reference():
    tiktoken = pytest.importorskip("tiktoken")
    from subloom.llm.bpe import PATTERN

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=encoder().ranks, special_tokens={}).encode_ordinary


def test_encoder_gives_the_merges():
    want, e, r = reference(), encoder(), random.Random(4)
    made = ["".join(r.choice("abcdetheing  \n\t's lzöжш漢🙂0123!?—á") for _ in range(r.randint(0, 80))) for _ in range(1500)]
    for t in ODD + made:
        assert e.encode(t) == want(t), t
        assert e.count(t) == len(want(t))


def test_encode_corpus(spark):
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*ODD, None, "same", "same"])], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in encode_corpus(d, "doc_id", "text").collect()}
    want = reference()
    assert got == {i: want(t) if t else [] for i, t in enumerate([*ODD, None, "same", "same"])}
    assert encode_corpus(d.limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_pack_never_overfills_or_splits(seed):
    r = random.Random(seed)
    sizes = [(i, r.choice([0, r.randint(1, 100), r.randint(1, 40), r.randint(90, 260)])) for i in range(800)]
    bins = list(pack(iter(sizes), 100, 8))
    assert all(sum(s for *_, s in b) <= 100 for b in bins)
    pieces = defaultdict(list)
    for b in bins:
        for i, k, s in b:
            pieces[i].append((k, s))
    assert {i: sum(s for _, s in p) for i, p in pieces.items()} == dict(sizes)
    assert all(len(p) == 1 for i, p in pieces.items() if dict(sizes)[i] <= 100)
    assert all(sorted(k for k, _ in p) == list(range(len(p))) for p in pieces.values())
    assert len(bins) * 100 <= 1.08 * sum(s for _, s in sizes) + 100


def test_fill_containers(spark):
    texts = [None, "", *["word " * (40 * (i % 9 + 1)) for i in range(200)], "word " * 9000]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = fill_containers(d, "doc_id", "text").collect()
    fill = Counter()
    for r in rows:
        fill[r["container"]] += r["n_tokens"]
    assert {r["doc_id"] for r in rows} == set(range(len(texts))) and max(fill.values()) <= 2048
    assert sum(fill.values()) / (2048 * len(fill)) > 0.95
