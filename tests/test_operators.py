import random

import pytest
from pyspark.sql import functions as F

from subloom.operators import corpus, discover, reorder, rules, split, validate
from subloom.operators.intervals import carried, gaps, merged_periods


def classify(spark, texts, cfg=rules.CleanConfig()):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [(r["status"], r["reasons"]) for r in rules.with_classification(d, "text", cfg).orderBy("i").collect()]


def test_classification(spark):
    texts = ["Where are you going?", "", "   ", None, "...", "Би маргааш өглөө буцаж ирнэ.", "Hello th�re", "Сайн уу".encode().decode("latin-1"), "Hello\x07 there", r"{\i1}Hello{\i0}", r"Hello\Nthere", "<i>Hello</i>", "Subtitles by John", "Visit www.example.com now", "word " * 150, "(The long title)", "AROUND 10 YEARS AGO SOMEWHERE", "NO!", "Resyncing is fun", "a.community"]
    got = classify(spark, texts)
    names = [r for _, rs in got for r in rs]
    assert [s for s, _ in got] == ["clean"] + ["rejected"] * 13 + ["review"] * 3 + ["clean"] * 3
    assert got[1][1] == got[3][1] == ["empty_text"] and got[4][1] == ["punctuation_only"] and "cyrillic_text" in got[5][1]
    assert got[14][1] == ["very_long"] and got[15][1] == ["caption"]
    assert {"replacement_char", "mojibake", "control_chars", "residual_ass_tags", "html_tags", "credit_or_url"} <= set(names)
    assert classify(spark, ["(The long title)"], rules.CleanConfig(flag_captions=False)) == [("clean", [])]


def test_dedupe(spark):
    texts = ["Hello.", "Hello.", "hello!", "Goodbye.", "", None, " Hello. "]
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, text string, n string").drop("n")
    got = {r["i"]: (r["status"], r["reasons"]) for r in corpus.deduped(d, ["i"]).collect()}
    assert [got[i][0] for i in range(4)] == ["clean", "rejected", "rejected", "clean"]
    assert got[1][1] == ["duplicate_exact"] and got[2][1] == ["duplicate_near"] and got[6][1] == ["duplicate_exact"] and got[5][1] == ["empty_text"]
    assert corpus.deduped(d, ["i"], cfg=rules.CleanConfig(dedupe=False)).filter("status = 'clean'").count() == 5
    assert corpus.deduped(d, ["i"], cfg=rules.CleanConfig(near_dedupe=False)).filter("array_contains(reasons, 'duplicate_near')").count() == 0
    again = corpus.deduped(d, ["i"]).filter("status = 'clean'").select("i", "text")
    assert corpus.deduped(again, ["i"]).filter("status <> 'clean'").count() == 0
    assert corpus.deduped(d.limit(0), ["i"]).count() == 0


def test_dedupe_against_a_loop(spark):
    r = random.Random(2)
    texts = [r.choice(["a", "A", "a!", "b c", "B  c", "ok", "...", "(x)", ""]) for _ in range(300)]
    seen_exact, seen_near, want = set(), set(), []
    for status, t in zip([s for s, _ in classify(spark, texts)], texts, strict=True):
        near = "".join(c for c in t.lower() if c.isalnum())
        if status != "rejected" and t.strip() in seen_exact:
            want.append("duplicate_exact")
        elif status != "rejected" and near in seen_near:
            want.append("duplicate_near")
        else:
            want.append("")
            if status != "rejected":
                seen_exact.add(t.strip())
                seen_near.add(near)
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [next((x for x in row["reasons"] if x.startswith("dup")), "") for row in corpus.deduped(d, ["i"]).orderBy("i").collect()]
    assert got == want


def test_hot_keys_are_salted(spark, monkeypatch):
    from subloom.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    monkeypatch.setattr(skew, "SHARE", 4)
    texts = ["hot line"] * 60 + ["Hot line!"] * 20 + ["a b", "A b", "c", "...", "..."]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [r["reasons"] for r in corpus.deduped(d, ["i"]).orderBy("i").collect()]
    assert got[0] == [] and all(x == ["duplicate_exact"] for x in got[1:60]) and all(x == ["duplicate_near"] for x in got[60:80])
    assert got[80:] == [[], ["duplicate_near"], [], ["punctuation_only"], ["punctuation_only"]]
    counted = d.groupBy("text").agg(F.count("*").alias("n"))
    hot = skew.hot_keys(counted, ["text"], "n", len(texts))
    assert [r["text"] for r in hot.collect()] == ["hot line"]
    joined = skew.salted_join(d, counted, ["text"], hot, "i")
    assert sorted((r["i"], r["text"], r["n"]) for r in joined.collect()) == sorted((i, t, texts.count(t)) for i, t in enumerate(texts))


def events(spark, rows):
    full = [(1, i, i, "Dialogue", 0, s, e, st, n, "0", "0", "0", fx, t) for i, (s, e, t, st, n, fx) in enumerate(rows)]
    return spark.createDataFrame(full, "file_id long, line_no int, index int, kind string, layer int, start string, end string, style string, name string, margin_l string, margin_r string, margin_v string, effect string, text string").withColumn("extra", F.create_map().cast("map<string,string>"))


def test_extraction(spark):
    rows = [("0:00:05.00", "0:00:06.00", "Second.", "Default", "Bob", ""), ("0:00:01.00", "0:00:03.00", r"{\i1}First.{\i0}", "Default", "Anna", ""), ("0:00:07.00", "0:00:06.00", r"Third,\Nsplit.", "opera", " ", " "), ("0:00:01.00", "0:00:02.00", "BAKERY", "Sign", "", ""), ("0:00:01.00", "0:00:02.00", "x", "OP-EN", "", ""), ("0:00:01.00", "0:00:02.00", "x", "sign_generic", "", ""), ("0:00:01.00", "0:00:02.00", "Scroll", "Default", "", "Banner;1"), ("bad", "0:00:02.00", "x", "Default", "", ""), ("0:00:01.00", "0:00:02.00", "1234", "Default", "", ""), ("0:00:01.00", "0:00:02.00", r"{\k2}ka", "Default", "", "")]
    judged = rules.with_drop_reason(events(spark, rows))
    assert [r["drop_reason"] for r in judged.orderBy("index").collect()] == [None, None, None, "skipped_style", "skipped_style", "skipped_style", "skipped_effect", "bad_timestamp", "not_translatable", "not_translatable"]
    recs = corpus.to_records(judged.filter("drop_reason IS NULL").withColumn("movie_id", F.lit("m"))).orderBy("start").collect()
    assert [r["text"] for r in recs] == ["First.", "Second.", "Third, split."] and [r["speaker"] for r in recs] == ["Anna", "Bob", None]
    assert [r["context_before"] for r in recs] == ["", "First.", "Second."] and recs[0]["context_after"] == "Second." and recs[2]["context_after"] == ""
    assert recs[2]["start"] == recs[2]["end"] == 7.0 and recs[0]["has_tags"] and recs[0]["event_index"] == 1
    open_cfg = rules.ExtractConfig(skip_style="", skip_nonempty_effect=False)
    assert rules.with_drop_reason(events(spark, rows), open_cfg).filter("drop_reason IS NULL").count() == 7


def test_context_over_windows_of_time(spark):
    rows = [("m", float(i * 400), i, f"t{i}") for i in range(9)] + [("n", None, 1, "x"), ("n", 5.0, 2, "y")]
    d = spark.createDataFrame(rows, "movie_id string, start double, k int, text string")
    cols = ["movie_id", "start", "k", "context_before", "context_after"]
    a = sorted(map(str, corpus.with_context(d, "movie_id", ["start", "k"]).select(cols).collect()))
    assert a == sorted(map(str, corpus.with_context(d, "movie_id", ["start", "k"], "text", "start").select(cols).collect()))


def test_split_rules():
    r = random.Random(1)
    counts = {f"movie_{i:03d}": r.randint(200, 1500) for i in range(60)}
    a = split.assign(counts, seed=7)
    total = sum(counts.values())
    share = {s: sum(counts[m] for m in a if a[m] == s) / total for s in split.SPLITS}
    assert set(a) == set(counts) and abs(share["train"] - 0.8) < 0.05 and abs(share["validation"] - 0.1) < 0.04 and abs(share["test"] - 0.1) < 0.04
    assert split.assign(counts, seed=7) == a
    forced = split.assign({f"m{i}": 100 for i in range(20)}, seed=3, forced=["m1", "m5", "gone"])
    assert forced["m1"] == forced["m5"] == "test" and list(forced.values()).count("test") == 2
    assert set(split.assign({"a": 3, "b": 2, "c": 1}, (1, 0, 0)).values()) == set(split.SPLITS)
    with pytest.raises(ValueError):
        split.assign({}, (0.5, 0.1, 0.1))


def test_split_frames(spark):
    d = spark.createDataFrame([(m * 50 + k, None if m == 11 else f"mv{m}", k) for m in range(12) for k in range(50)], "i int, movie_id string, k int")
    out, a = split.with_split(d, ["i"], seed=1)
    assert out.count() == 600 and out.select("movie_id", "split").distinct().count() == 12 and "None" in a
    s = {r["split"]: r for r in split.split_summary(out).collect()}
    assert sum(r["lines"] for r in s.values()) == 600 and s["train"]["lines"] > s["test"]["lines"] > 0
    assert split.split_summary(out.limit(0)).count() == 0


def test_unique_ids(spark):
    want = ["ks", "ks_2", "ks", "ks", "ks_2"]
    assert discover.unique_ids(want) == ["ks", "ks_2", "ks_3", "ks_4", "ks_2_2"]
    d = spark.createDataFrame([(0, f"/{i}", w) for i, w in enumerate(want)], "root_no int, path string, wanted_id string")
    assert [r["id"] for r in discover.with_ids(d).orderBy("path").collect()] == discover.unique_ids(want)
    r = random.Random(9)
    want = [r.choice(["a", "a_2", "a_3", "a_2_2", "b", "c", "c_07", "d_9", "d", "e_100", "e"]) for _ in range(120)]
    d = spark.createDataFrame([(0, f"/{i:03d}", w) for i, w in enumerate(want)], "root_no int, path string, wanted_id string")
    assert [r["id"] for r in discover.with_ids(d).orderBy("path").collect()] == discover.unique_ids(want)
    assert discover.with_ids(d.limit(0)).count() == 0


def test_running_values_over_blocks(spark, monkeypatch):
    from subloom.operators import blocks

    monkeypatch.setattr(blocks, "BLOCK", 4)
    r = random.Random(3)
    rows = [("k" if i % 7 else "l", i * 2, r.choice([None, None, i]), r.choice([0, 1, None])) for i in range(60)]
    d = spark.createDataFrame(rows, "k string, at int, v int, s int")
    for strict in (False, True):
        want, state = {}, {}
        for k, at, v, s in rows:
            last, total = state.get(k, (None, 0))
            after = (last if v is None else v, total + (s or 0))
            want[at] = (last, total) if strict else after
            state[k] = after
        got = blocks.running(d, "k", "at", {"a": F.col("v")}, {"b": F.col("s")}, strict, {"t": F.col("s")}).collect()
        assert {x["at"]: (x["a"], x["b"]) for x in got} == want and all(x["t"] == state[x["k"]][1] for x in got)
    places = {at: sum(x[0] == k and x[1] <= at for x in rows) for k, at, _, _ in rows}
    assert {x["at"]: x["n"] for x in blocks.numbered(d, "k", "at", "n").collect()} == places == {x["at"]: x["n"] for x in blocks.ranked(d, "k", ["at"], "n").collect()}
    assert blocks.running(d.limit(0), "k", "at", {"a": F.col("v")}).count() == 0


def brute(rows):
    by = {}
    for m, s, e in rows:
        if m is not None and s is not None and e is not None and e > s:
            by.setdefault(m, []).append((s, e))
    periods, holes = [], []
    for m, xs in by.items():
        xs.sort()
        cur = list(xs[0])
        n = 1
        for s, e in xs[1:]:
            if s > cur[1]:
                periods.append((m, *cur, n))
                holes.append((m, cur[1], s))
                cur, n = [s, e], 1
            else:
                cur[1], n = max(cur[1], e), n + 1
        periods.append((m, *cur, n))
    return sorted(periods), sorted(holes)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_intervals_against_a_loop(spark, seed):
    r = random.Random(seed)
    rows = []
    for _ in range(600):
        s = r.randint(0, 4000)
        rows.append((r.choice(["hot", "hot", "a", "b", None]), r.choice([s, s, s, None]), s + r.choice([-3, 0, 1, 4, 9, 200 if r.random() < 0.02 else 2])))
    d = spark.createDataFrame([(*x, "extra") for x in rows], "entity string, start_ms long, e long, seen string")
    periods, holes = brute(rows)
    assert sorted(tuple(x) for x in merged_periods(d, "entity", "start_ms", "e").collect()) == periods
    assert sorted(tuple(x) for x in gaps(d, "entity", "start_ms", "e").collect()) == holes
    assert gaps(d.limit(0), "entity", "start_ms", "e").count() == 0


def test_carried_state_over_whole_partitions():
    s = [(0, "a", "a", 10, 0), (1, "a", "a", 8, 5), (2, "a", "b", 3, 1), (3, "b", "b", 9, 7)]
    assert carried(s) == {1: ("a", 10, 0), 2: ("a", 10, 0), 3: ("b", 3, 1)}


def test_structure_and_translation(spark):
    rows = [("0:00:01.00", "0:00:02.00", r"{\i1}Hello there friend{\i0}", "Default", "", ""), ("0:00:02.00", "0:00:03.00", "How are you today", "Default", "", ""), ("0:00:03.00", "0:00:04.00", "Tokyo", "Default", "", ""), ("0:00:04.00", "0:00:05.00", "One more line here", "Default", "", "")]
    a = events(spark, rows).withColumnRenamed("file_id", "doc").withColumnRenamed("line_no", "ordinal")
    assert validate.structure_issues(a, a).count() == 0
    b = a.withColumn("style", F.when(F.col("ordinal") == 1, "X").otherwise(F.col("style"))).withColumn("text", F.when(F.col("ordinal") == 0, r"{\i1}Сайн").otherwise(F.col("text"))).filter("ordinal < 3")
    issues = {(r["ordinal"], r["issue"]) for r in validate.structure_issues(a, b).collect()}
    assert issues == {(-1, "event count differs: 4 != 3"), (1, "Dialogue #1 [0:00:02.00 -> 0:00:03.00]: style changed ('Default' -> 'X')"), (0, r"Dialogue #0 [0:00:01.00 -> 0:00:02.00]: missing tag {\i0}")}
    texts = {0: "Сайн байна", 1: "Сайн байна", 2: "Tokyo", 3: ""}
    t = a.withColumn("text", F.element_at(F.create_map(*[F.lit(x) for kv in texts.items() for x in kv]), F.col("ordinal")))
    lines = validate.translation_lines(a, t)
    s = validate.translation_summary(lines).first()
    assert (s["translatable"], s["n_empty"], s["n_untranslated"], s["n_duplicated"]) == (4, 1, 0, 1)
    told = [r["issue"] for r in validate.translation_issues(lines).collect()]
    assert any("duplicated translation 'Сайн байна'" in x for x in told) and any("empty translation for 'One more line here'" in x for x in told)
    same = validate.translation_issues(validate.translation_lines(a, a)).collect()
    assert any(x["issue"].startswith("3/4 translatable lines identical to source (75.0% > 2.0%)") for x in same) and any("Latin-script ratio in output is 100.0%" in x["issue"] for x in same)


def test_sections(spark):
    from subloom.sources import ass, files

    def lines(text):
        return ass.with_sections(files.lines(spark.createDataFrame([("d", text)], "doc string, text string"), "doc"), "doc").filter("NOT is_header")

    a = lines("[Script Info]\nTitle: x\n[Events]\nFormat: A, B\n")
    assert validate.section_issues(a, a).count() == 0
    b = lines("[Script Info]\nTitle: y\n[V4+ Styles]\n\n[Events]\nFormat: A\n")
    got = {r["issue"] for r in validate.section_issues(a, b).collect()}
    assert got == {"section list differs: [Script Info, Events] != [Script Info, V4+ Styles, Events]", "[v4+ styles] present in only one file", "[script info] lines changed", "Events Format line differs"}


def test_collector(spark):
    head = b"\xef\xbb\xbf[Script Info]\r\n[Events]\r\nFormat: x\r\n"
    d1, d2, c = b"Dialogue: a\r\n", b"Dialogue: {\\i1\\an8}b\r\n", b"Comment: {\\an8}c\r\n"
    docs = {"plain": head + d1, "moved": head + d2 + d1 + c + b"\r\n[Fonts]\r\nDialogue: {\\an8}no\r\n", "none": b"x", "open": b"[Events]\n" + b"Dialogue: {\\an8}b\nDialogue: z", "kept": head + d1 + d2}
    d = spark.createDataFrame([(k, bytearray(v)) for k, v in docs.items()], "path string, content binary")
    got = {r["path"]: (r["n_top"], r["changed"], r["new_content"] and bytes(r["new_content"])) for r in reorder.collected(d).collect()}
    assert got["plain"][:2] == (0, False) and got["kept"][:2] == (1, False) and got["none"][2] is None
    assert got["moved"] == (2, True, head + d1 + d2 + c + b"\r\n[Fonts]\r\nDialogue: {\\an8}no\r\n")
    assert got["open"] == (1, True, b"[Events]\nDialogue: z\nDialogue: {\\an8}b")
    assert all(len(v[2]) == len(docs[k]) for k, v in got.items() if v[2] is not None)
