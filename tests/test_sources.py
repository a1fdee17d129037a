from pyspark.sql import functions as F

from subloom.sources import ass, files, records, srt



def stamp(ms):
    return f"{ms // 3600000:02d}:{ms // 60000 % 60:02d}:{ms // 1000 % 60:02d},{ms % 1000:03d}"


def cue(number, start, lines, seconds=2, blank=1, end="\r\n"):
    """A cue at `start` seconds; number None leaves out the line of the number, blank says how many empty lines close it."""
    rows = [] if number is None else [str(number)]
    return end.join([*rows, f"{stamp(int(start * 1000))} --> {stamp(int((start + seconds) * 1000))}", *lines]) + end * (1 + blank)


ASS = "; before\r\n[Script Info]\r\nTitle: x  \r\n\r\n[v4+ Styles]\r\nFormat: Name, Fontname\r\nStyle: Default, Arial\r\nStyle: Sign,B\r\nStyle: Default,C\r\n[EVENTS]\r\n; note\r\n\r\nDialogue: 2,0:00:01.00,0:00:02.00,Def,Ann,0000,0,0,fx,Hi, you, all  \r\nUnknown: y\r\nFormat: Marked, Start, End, Text, Layer\r\ncomment: Marked=0,0:00:03.00,0:00:04.00,T,x\r\nSound: 1,0:0:1\r\n[Other]\r\nDialogue: no\r\n"


def text_frame(spark, *texts):
    return spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "path string, text string")


def srt_texts(spark, *cues):
    return [(r["start"], r["text"]) for r in sorted(srt.parse_events(text_frame(spark, "".join(cues))).collect(), key=lambda r: r["index"])]


def test_srt_numbers_of_cues(spark):
    """Numbers may lack, be no numbers, or stand right below the text of the cue before."""
    given = [cue(1, 4, ["morning"]), cue(None, 8, ["no number"]), cue("##", 12, ["odd number"]), cue(40, 16, ["no gap"], blank=0), cue(41, 20, ["12"], blank=0), cue(None, 24, ["last"], blank=0)]
    assert [t for _, t in srt_texts(spark, *given)] == ["morning", "no number", "odd number", "no gap", "", "last"]


def test_srt_text_of_cues(spark):
    given = ["\ufeff", cue(1, 1, ["ends in blanks \t "]), cue(2, 5, ["<b>two</b>", "lines &lt; one"], blank=4), cue(3, 9, [r"{\pos(3,4)}placed"]), cue(4, 13, [], blank=1), "lost until the next\r\n\r\n", cue(5, 17, ["<font face='x'>plain</font>"])]
    assert srt_texts(spark, *given) == [("0:00:01.00", "ends in blanks"), ("0:00:05.00", r"{\b1}two{\b0}\Nlines < one"), ("0:00:09.00", r"{\pos(3,4)}placed"), ("0:00:13.00", ""), ("0:00:17.00", "plain")]


def test_srt_repeated_cues(spark):
    """Only cues with the same times and text are repetitions; overlaps stay."""
    given = [cue(1, 2, ["same"]), cue(2, 2, ["same"]), cue(3, 2, ["same"], seconds=3), cue(4, 3, ["over"]), cue(1, 2, ["same"])]
    assert [t for _, t in srt_texts(spark, *given)] == ["same", "same", "over"]


def test_srt_rounding_empty_and_junk(spark):
    given = cue(7, 83.406, ["x"], seconds=3640.589, end="\n").replace(",995", ",995 X1:1")
    out = srt.parse_events(text_frame(spark, given, "nothing timed", "")).collect()
    assert [(r["path"], r["start"], r["end"]) for r in out] == [("f0", "0:01:23.41", "1:02:04.00")]


def test_markup(spark):
    d = spark.createDataFrame([("<I>a</I><br>b &lt;i&gt; &quot;q&quot;",)], "t string")
    assert d.select(srt.convert_markup("t").alias("x")).first()["x"] == r'{\i1}a{\i0}\Nb <i> "q"'


def test_ass_document(spark):
    lines = files.lines(text_frame(spark, ASS))
    ev = sorted(ass.parse_events(lines).collect(), key=lambda r: r["line_no"])
    assert [(r["kind"], r["index"], r["layer"], r["text"]) for r in ev] == [("Dialogue", 2, 2, "Hi, you, all  "), ("Comment", 5, 0, "T"), ("Sound", 6, 0, "")]
    assert ev[0]["margin_l"] == "0000" and ev[0]["effect"] == "fx" and ev[0]["extra"] == {}
    assert ev[1]["extra"] == {"Marked": "Marked=0", "Layer": "x"} and ev[2]["style"] == "Default"
    sections = [r["section"] for r in ass.with_sections(lines).filter("is_header").orderBy("line_no").collect()]
    assert sections == ["Script Info", "v4+ Styles", "EVENTS", "Other"]
    styles = {r["name"]: r["fields"] for r in ass.parse_styles(lines).collect()}
    assert styles == {"Default": {"Name": "Default", "Fontname": "C"}, "Sign": {"Name": "Sign", "Fontname": "B"}}
    assert ass.parse_styles(files.lines(text_frame(spark, "[Script Info]\nTitle: x\n"))).count() == 0


def test_lines_keep_the_last_newline(spark):
    got = {r["path"]: r["n"] for r in files.lines(text_frame(spark, "a\nb\n", "a\r\nb", "")).groupBy("path").agg(F.count("*").alias("n")).collect()}
    assert got == {"f0": 3, "f1": 2, "f2": 1}


def test_encodings(spark):
    data = {"u8": b"\xef\xbb\xbfhi", "le": b"\xff\xfe" + "Привет".encode("utf-16-le"), "be": b"\xfe\xff" + "Привет".encode("utf-16-be"), "cp": "Привет Ё №".encode("cp1251"), "l1": b"caf\xe9 \x98", "u": "é".encode(), "bad": b"\xef\xbb\xbfa\xff", "e": b""}
    d = spark.createDataFrame([(k, bytearray(v)) for k, v in data.items()], "path string, content binary")
    got = {r["path"]: (r["codec"], r["bom"], r["text"]) for r in files.with_text(d).collect()}
    assert got == {"u8": ("utf-8", True, "hi"), "le": ("utf-16-le", True, "Привет"), "be": ("utf-16-be", True, "Привет"), "cp": ("cp1251", False, "Привет Ё №"), "l1": ("latin-1", False, "café \x98"), "u": ("utf-8", False, "é"), "bad": ("utf-8", True, "a�"), "e": ("utf-8", False, "")}


def test_json_lines(spark, tmp_path):
    d = spark.createDataFrame([("m", "é", None)], "movie_id string, text string, speaker string")
    records.write_jsonl(d, str(tmp_path / "x"))
    body = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "x").glob("*.json"))
    assert '"speaker":null' in body and "é" in body
    assert records.read_jsonl(spark, str(tmp_path / "x")).first()["text"] == "é"
    assert records.read_jsonl(spark, [str(tmp_path / "x")]).first()["file_seq"] == 0
    (tmp_path / "y").mkdir()
    for name, texts in (("b.jsonl", ["3", "4"]), ("a.jsonl", ["1", "2"])):
        (tmp_path / "y" / name).write_text("".join(f'{{"text": "{t}"}}\n' for t in texts))
    rows = records.read_jsonl(spark, str(tmp_path / "y"))
    assert [r["text"] for r in rows.orderBy(*records.LINE_ORDER).collect()] == ["1", "2", "3", "4"]
    assert records.read_jsonl(spark, []).columns == rows.columns
    p = spark.createDataFrame([(1, '{"text": "a", "start": 1.5, "x": 2}'), (2, '{"text": "a"'), (3, None)], "id int, payload string")
    assert [(r["id"], r["text"], r["start"], r["end"]) for r in records.from_payload(p, "payload", ["id"]).collect()] == [(1, "a", 1.5, None)]
