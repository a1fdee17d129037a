import pytest
from pyspark.sql import functions as F

from subloom.functions import chars, tags, text, timecode
from subloom.functions.restore import restore, restored


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("x")).first()["x"]


def many(spark, column, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").select("i", column(F.col("v")).alias("x")).collect()
    return [r["x"] for r in sorted(rows)]


def test_protect_cases(spark):
    texts = [r"{\pos(1,2)}Hello{\i1}there{\i0}\Nworld", r"{\p1}m 0 0 l 1 1{\p0}Label", r"{\i1{\b1}}x", r"{\i1 broken", "shut} then", r"a\nb\hc", r"{\p4}m 0{\p0}", "", None, r"{\fad(2,2)}{\k25}Ki{\kf3}mi", r"{\fsp2}la", r"{\p1\p0}x", "{Note: sign}{\\an8}Exit"]
    got = many(spark, tags.protect, texts)
    assert [g and g["plain"] for g in got] == ["Hellothere\nworld", "Label", "}x", r"{\i1 broken", "shut} then", "a\nb c", "", "", None, "Kimi", "la", "x", "Exit"]
    assert [(t["offset"], t["kind"], t["raw"]) for t in got[1]["template"]] == [(0, "tag", r"{\p1}"), (0, "draw", "m 0 0 l 1 1"), (0, "tag", r"{\p0}")]
    assert got[2]["tags"] == [r"{\i1{\b1}"] and got[3]["tags"] == []
    assert got[9]["karaoke"] and not got[10]["karaoke"] and got[1]["drawing"] and not got[0]["drawing"]


@pytest.mark.parametrize("value, kept", [("", False), ("  ", False), (r"\N\N", False), (r"{\i1}{\i0}", False), (r"{\p1}m 0{\p0}", False), ("2013", False), ("!?", False), (r"{\an8}Coming!", True), ("Сайн уу", True), (r"{\k20}Hel", False), ("a", True), ("½", True), (None, False)])
def test_translatable(spark, value, kept):
    assert one(spark, tags.is_translatable, value) is kept


def test_round_trip_identity(spark):
    texts = [r"{\i1}Well, Paula!{\i0}", r"{\pos(1,2)}Hello{\i1}there{\i0}\Nworld", "Plain, {braces}", r"{\p1}m 0 0 l 1 1{\p0}", r"a\Nb\Nc", r"{\p1}m 0{\p0}Label"]
    assert many(spark, lambda c: restore(c, tags.strip_tags(c)), texts) == texts


def test_restore_places():
    assert restored("Well, Paula!", [(0, "{a}"), (12, "{b}")], "Сайн уу\nта") == r"{a}Сайн уу\Nта{b}"
    out = restored("That's my seat.", [(7, "{1}"), (9, "{0}")], "Энэ бол миний суудал.")
    assert out.replace("{1}", "").replace("{0}", "") == "Энэ бол миний суудал." and out.index("{1}") < out.index("{0}")
    assert all(out[i - 1] == " " or out[i + 3 : i + 4] in (" ", "{") for i in (out.index("{1}"), out.index("{0}")))
    assert restored("", [(0, "{x}")], "") == "{x}"


def test_tag_issues(spark):
    pairs = [(r"{\i1}a{\i0}", r"{\i1}b"), ("a", r"{\i1}b"), (r"{\i1}a{\i0}", r"{\i1}b{\i0"), (r"{\i1}a{\i0}", r"{\i0}b{\i1}"), (r"{\i1}a{\i1}b{\i1}", r"{\i1}b"), (r"{\p1}m 1{\p0}", r"{\p1}m 2{\p0}"), (None, "x"), ("x", "y")]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").select("i", tags.tag_issues("a", "b").alias("x")).collect()
    got = [r["x"] for r in sorted(rows)]
    assert got == [[r"missing tag {\i0}"], [r"unexpected tag {\i1}"], ["unbalanced braces in translated text", r"missing tag {\i0}"], ["override tags reordered"], [r"missing tag {\i1} x2"], ["drawing commands changed or lost"], [], []]


def test_timecodes(spark):
    assert many(spark, timecode.to_seconds, ["0:01:23.40", " 1:02 ", "1:2:3:4", "x", "", None, "0:00:01.", "10:00:00.5"]) == [83.4, 62.0, None, None, None, None, 1.0, 36000.5]
    assert many(spark, timecode.to_stamp, [83.406, 3723.995, -1.0, None, 0.125], "double") == ["0:01:23.41", "1:02:04.00", "0:00:00.00", None, "0:00:00.12"]


def test_text_measures(spark):
    assert many(spark, text.latin_ratio, ["abЖ1", "", None, "½"]) == [2 / 3, 0.0, 0.0, 0.0]
    assert many(spark, text.word_count, ["it's a re-run, no?", "…", None]) == [4, 0, 0]
    assert many(spark, text.has_control_chars, ["a\x07", "a\n\t​", "﻿", None]) == [True, False, True, False]
    assert many(spark, text.bad_chars, ["a\x07�\x07", "ok\n", None]) == [["U+0007", "U+FFFD"], [], []]
    assert many(spark, text.is_caption, ["(a b)", "[x]", "NO!", "AROUND 10 YEARS AGO", "(", "", None]) == [True, True, False, True, False, False, False]
    assert many(spark, text.dedupe_key, ["Hello, World!", "hello world", None]) == ["helloworld", "helloworld", None]
    assert many(spark, text.name_or_symbol, ["Tokyo", "John Smith", "go home", "123", "A B C"]) == [True, True, False, True, False]
    assert many(spark, chars.one_line, ["  a 　 b\n", ""]) == ["a b", ""]


def test_file_names(spark):
    stems = ["english", "Movie_MN", "movie.en", "Movie (2020) mongolian", "Strength", "movie_en_mn"]
    assert many(spark, text.language_from_filename, stems) == ["en", "mn", "en", "mn", None, None]
    assert many(spark, text.base_key, ["Movie.2020.mn", "english", "a_a_b"]) == ["movie_2020", "", "a_a_b"]
    assert many(spark, text.language_from_folder, ["Raw/English/x", "MN/en", "", None]) == ["en", "mn", None, None]
    assert many(spark, text.group_dir, ["Raw/English/x", "", None]) == ["Raw/x", "", ""]
    assert one(spark, lambda c: text.make_id(c, F.lit("")), "") == "root" and one(spark, lambda c: text.make_id(c, F.lit("k ü")), "a/b") == "a_b_k"
