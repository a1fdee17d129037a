import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subloom.llm import language as L
from subloom.llm.encoding import CYRILLIC, Repairer, letter_pairs, repaired
from subloom.llm.reading import cuts_between, reading_levels
from subloom.llm.turns import turn_starts, turns
from subloom.operators import skew

RUSSIAN = "Старый рыбак вчера принёс картину возле станции пока почтальон забыл маленькую лодку вместе с другими"
FRENCH = "L'équipage a oublié la clé du grenier près de la gare où mon grand-père cherchait encore les fenêtres"
ENGLISH = "That’s why the bottle from Ann’s fence watched that “cold” blanket…"


def pairs(text):
    place = {c: i for i, c in enumerate(CYRILLIC)}
    out = np.zeros((len(CYRILLIC),) * 2)
    low = text.lower()
    for a, b in zip(low, low[1:]):
        if a in place and b in place:
            out[place[a], place[b]] += 1
    return out


@pytest.mark.parametrize("text, wrong", [(RUSSIAN, ("utf-8", "cp1252")), (RUSSIAN, ("cp1251", "latin-1")), (RUSSIAN, ("koi8-r", "cp1251")), (RUSSIAN, ("cp1251", "koi8-r")), (RUSSIAN, ("cp866", "cp1251")), (FRENCH, ("utf-8", "cp1252")), (FRENCH, ("utf-8", "latin-1")), (FRENCH, ("utf-8", "cp1251")), (FRENCH, ("utf-8", "mac-roman")), (FRENCH, ("cp1252", "cp1251")), (ENGLISH, ("utf-8", "cp1252")), (ENGLISH, ("utf-16-le", "utf-16-be"))])
def test_exact_round_trip(text, wrong):
    raw = text.encode(wrong[0])
    garbled = "".join(bytes([b]).decode(wrong[1], "ignore") or chr(b) for b in raw) if not wrong[0].startswith("utf-16") else raw.decode(wrong[1])
    r = Repairer(pairs((RUSSIAN + " ") * 400))
    got, found, way = r.text("{\\an8}" + garbled)
    assert found and way and got == "{\\an8}" + text


@pytest.mark.parametrize("times", [2, 3, 5])
@pytest.mark.parametrize("text", [FRENCH, RUSSIAN])
def test_garbled_several_times(text, times):
    garbled = text
    for _ in range(times):
        garbled = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in garbled.encode())
    assert Repairer(pairs((RUSSIAN + " ") * 400)).text(garbled)[:2] == (text, True)


def test_escaped_characters():
    """Character references are sound, unless they spell garbled characters."""
    r = Repairer()
    for raw, want in (("petit d&Atilde;&copy;jeuner", "petit déjeuner"), (r"caf\u00c3\u00a9 noir", "café noir"), ("&Ntilde;&#131;&#209;&#130;&#209;&#128;&#208;&#190;", "утро")):
        assert r.text(raw)[:2] == (want, True)
    for sound in ("caf&eacute; noir", r"caf\u00e9", "Tom &amp; Ann", "a &lt; b"):
        assert r.text(sound) == (sound, False, "")


WAYS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp1251"), ("utf-8", "cp866"), ("cp1251", "latin-1"), ("cp1251", "koi8-r"), ("cp1251", "cp866"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("koi8-r", "cp866")]


@pytest.mark.parametrize("right, wrong", WAYS)
def test_share_of_exact_restorations(right, wrong):
    """Short and long sentences, small words included."""
    r = random.Random(8)
    corpus = "старик вчера открыл окно перед дождём и принёс корзину на рынок а мы больше не видели тот корабль ты думаешь что сад был пуст когда она пришла домой с книгой но никто не знал где ключ от старой лодки возле моста".split()
    other = "ты знал что мост был у реки а книга и ключ дома где она открыла дверь".split()
    repairer = Repairer(pairs(" ".join(r.choice(corpus + other) for _ in range(30_000))))
    texts = [" ".join(r.choice(other) for _ in range(r.randint(6, 12))).capitalize() + "." for _ in range(200)]
    garbled = ["".join(bytes([b]).decode(wrong, "ignore") or chr(b) for b in t.encode(right)) for t in texts]
    assert sum(repairer.text(g)[0] == t for g, t in zip(garbled, texts, strict=True)) >= 0.98 * len(texts)


def test_lost_characters():
    r = Repairer()
    assert r.text("caf� noir")[1:] == (True, "") and r.text("a\x99b")[1]


@pytest.mark.parametrize("text", ["", "plain", ENGLISH, RUSSIAN, FRENCH, "РУССКИЙ ЧАЙ — так было", "ÂNCORA E MAÇÃ, SÃO DUAS", "Åsnäs, Łódka, Čmelák: three", "Ðagur and Þóra took the 4½ o'clock ferry.", "It's −12 °C — no!", "«À bientôt», disait l'île.", "♪ ♪", "¿Qué pasa?", "Да."])
def test_sound_text_stays(text):
    assert Repairer(pairs((RUSSIAN + " ") * 400)).text(text) == (text, False, "")


def test_repaired_frame(spark):
    rows = [(1, "cafÃ©", 0), (2, None, 0), (3, "", 0), (4, "fine", 0), (5, "cafÃ©", 0)]
    d = spark.createDataFrame(rows, "event_id long, text string, way int")
    got = sorted((x["event_id"], x["restored"]) for x in repaired(d, "event_id", "text").collect())
    assert got == [(1, "café"), (5, "café")] and repaired(d.limit(0), "event_id", "text").count() == 0
    assert letter_pairs(spark.createDataFrame([("аб аб",)], "text string"), "text").sum() == 2


def test_letters_with_nul(spark):
    """UTF-16 of ASCII letters read byte by byte: all of it is ASCII."""
    texts = [t.encode(e).decode("latin-1") for t in ("Hello there.", "Yes") for e in ("utf-16-le", "utf-16-be")]
    d = spark.createDataFrame([*enumerate(texts), (4, "{\\an8}H\0i\0"), (5, "fine"), (6, "a\0b c")], "event_id long, text string")
    got = {x["event_id"]: (x["restored"], x["way"]) for x in repaired(d, "event_id", "text").collect()}
    assert {k: v[0] for k, v in got.items() if k < 4} == {0: "Hello there.", 1: "Hello there.", 2: "Yes", 3: "Yes"} and got.keys() == {0, 1, 2, 3, 4, 6}


SENTENCES = {
    "en": ["The old man opened the window before the rain.", "Somebody carried the basket to the market.", "We never saw that ship again.", "I think the garden was empty."],
    "de": ["Der alte Mann hat gestern das Fenster geöffnet.", "Jemand wollte wieder den Schlüssel suchen.", "Wir haben das Schiff nie gesehen.", "Ich glaube der Garten war leer."],
    "fr": ["Le vieil homme a ouvert la fenêtre avant la pluie.", "Quelqu'un portait le panier au marché.", "Nous n'avons jamais revu ce bateau.", "Je crois que le jardin était vide."],
    "ru": ["Старик вчера открыл окно перед дождём.", "Кто-то принёс корзину на рынок.", "Мы больше не видели тот корабль.", "Я думаю что сад был пуст."],
}


@pytest.fixture(scope="module")
def prototypes():
    r = random.Random(1)
    labelled = [(lang, " ".join(r.choice(s) for _ in range(8))) for lang, s in SENTENCES.items() for _ in range(40)]
    labelled += [("fr", " ".join(SENTENCES["en"])), (None, "x"), ("xx", "y")]
    return L.train([(a, b) for a, b in labelled if a])


def test_stretches(prototypes):
    s = L.Scorer(prototypes)
    text = " ".join(SENTENCES["en"] * 2) + "\n" + " ".join(SENTENCES["de"] * 2) + " 12. " + " ".join(SENTENCES["ru"])
    seg = L.stretches(s.segments([text, "", "12 34", SENTENCES["fr"][2]]))
    assert [(r.owner, L.LANGUAGES[r.lang]) for r in seg.itertuples()] == [(0, "en"), (0, "de"), (0, "ru"), (3, "fr")]
    assert seg["words"].sum() == len(text.split()) + 6 and (seg["confidence"] > 0.3).all() and seg["first"].iloc[1] == len(" ".join(SENTENCES["en"] * 2).split())


@pytest.mark.parametrize("mark", ["", ",", " -"])
def test_stretches_within_a_sentence(prototypes, mark):
    """34 English words and 32 German ones with no stop between them; and German within English on both sides."""
    bare = {k: " ".join(v * 2).replace(".", "") for k, v in SENTENCES.items()}
    en, de = (" ".join((bare[k].split() * 2)[:n]) for k, n in (("en", 34), ("de", 32)))
    s = L.Scorer(prototypes)
    seg = L.stretches(s.segments([en + mark + " " + de, en + mark + " " + de + mark + " " + en, en + " " + en]))
    got = [(r.owner, L.LANGUAGES[r.lang], r.words) for r in seg.itertuples()]
    assert [x[:2] for x in got] == [(0, "en"), (0, "de"), (1, "en"), (1, "de"), (1, "en"), (2, "en")]
    assert all(abs(n - m) <= 3 for (_, _, n), m in zip(got, [34, 32, 34, 32, 34, 68], strict=True))


def test_documents_without_language(spark, prototypes):
    d = spark.createDataFrame([(1, None), (2, ""), (3, " 12 34 "), (4, SENTENCES["fr"][0]), (5, "x" * 100_000)], "doc_id long, text string")
    got = {x["doc_id"]: (x["language"], x["n_words"], x["confidence"]) for x in L.document_stretches(d, "doc_id", "text", prototypes).collect()}
    assert {k: got[k] for k in (1, 2, 3)} == {1: (None, 0, 0.0), 2: (None, 0, 0.0), 3: (None, 2, 0.0)} and got[4][0] == "fr" and got[5][1] == 1


def test_held_out_words(prototypes):
    s = L.Scorer(prototypes)
    for lang, text in (("en", "Nobody opened the empty basket near the ship."), ("de", "Der Mann hat nie wieder das Schiff geöffnet."), ("fr", "Le bateau était au marché avant la pluie."), ("ru", "Кто-то открыл пуст корзину на корабль.")):
        seg = s.segments([text])
        assert L.LANGUAGES[seg["lang"].iloc[0]] == lang


def test_runs_of_events(spark, monkeypatch):
    monkeypatch.setattr(L, "BUCKET", 4)
    r = random.Random(1)
    rows, want = [], {}
    for f in range(20):
        at = sorted(r.sample(range(60), r.randint(1, 40)))
        masks = [r.choice([0, 1, 1, 1, 2, 3]) for _ in at]
        rows += [(f, i, 64 * i + m) for i, m in zip(at, masks)]
        for k in range(2):
            longest = run = 0
            for m in masks:
                run = run + 1 if m >> k & 1 else 0
                longest = max(longest, run)
            if longest:
                want[f, L.LANGUAGES[k]] = (longest, sum(m >> k & 1 for m in masks), len(masks))
    got = {(x["file_id"], x["language"]): (x["longest"], x["events"], x["of_events"]) for x in L.file_runs(spark.createDataFrame(rows, "file_id long, index long, code long")).collect()}
    assert got == want


def test_events_of_a_file(spark, prototypes):
    texts = SENTENCES["en"] + [SENTENCES["de"][0] + "\\N" + SENTENCES["en"][1]] + SENTENCES["de"] + ["{\\k1}la", "{\\p1}m 0 0{\\p0}", "...", None]
    rows = [(i, 1, "Dialogue", t, i) for i, t in enumerate(texts)] + [(90, 1, "Comment", SENTENCES["fr"][0], 2), (91, 1, "Dialogue", texts[0], 0)]
    d = spark.createDataFrame(rows, "event_id long, file_id long, kind string, text string, index int")
    told = L.event_languages(d, prototypes, np.zeros(len(CYRILLIC) ** 2))
    got = {x["language"]: (x["longest"], x["of_events"]) for x in L.file_runs(told).collect()}
    assert got == {"en": (5, 9), "de": (5, 9)}


CAST = [(1, "m", "Anna Bergholt", "lead"), (2, "m", "Boris Kugowick", None), (3, "m", "Carl Kugowick", None), (9, "n", "Anna Bergholt", None)]


def lines_frame(spark, rows):
    return spark.createDataFrame([(i, "m", t, s, st, float(a), k, "x") for i, (a, k, s, t, st) in enumerate(rows)], "record_id long, movie_id string, text string, speaker string, style string, start double, event_index int, cast_id string")


@pytest.mark.parametrize("hot", [False, True])
def test_turns(spark, monkeypatch, hot):
    """Names that stand in a third of all lines, salted or not, give the same turns."""
    if hot:
        monkeypatch.setattr(skew, "HOT_ROWS", 1)
        monkeypatch.setattr(skew, "SHARE", 8)
    rows = [
        (0, 0, None, "Who is it?", "Default"),
        (1, 1, "ANNA BERGHOLT (on phone)", "Um, hello there.", "Default"),
        (2, 2, None, "(laughs) ♪", "Default"),
        (3, 3, "???", "uh - Still me at 6:40.", "Default"),
        (4, 4, "Boris", "SIGN", "sign_generic"),
        (5, 5, "Anna", "Bergholt, Anna: Yes. - CAPT. BORIS KUGOWICK: No [door slams] way.", "Main"),
        (5, 6, None, "[B. Kugowick] Go!\n>> Anna Bregholt: Wait.", "Default"),
        (7, 7, "Kugowick", "Which one?", "Default"),
        (8, 8, "Boris Kugowick", "[00:01:02] Er, hmm.", "Default"),
        (9, 9, "Carl", "Carl Kugowick: Me.", "Default"),
        (9, 9, "Carl", "Carl Kugowick: Me.", "Default"),
        (1300, 10, None, "Later.", "Default"),
        (1301, 11, "Anna", "Bye.", "Default"),
    ]
    d, cast = lines_frame(spark, rows), spark.createDataFrame(CAST, "cast_id long, movie_id string, full_name string, role string")
    want = [(1, 1), (5, 2), (6, 1), (9, 3), (11, 1)]
    assert sorted((x["event_index"], x["cast_id"]) for x in turn_starts(d, cast).collect()) == want
    got = {x["event_index"]: x for x in turns(d, cast).collect()}
    assert got[1]["text"] == "hello there. Still me at 6:40. Yes." and got[5]["text"] == "No way. Go!" and got[9]["text"] == "Me. Later." and got[6]["text"] == "Wait. Which one?"
    assert turn_starts(d.limit(0), cast).count() == 0 and turns(d, cast.limit(0)).count() == 0


def test_long_labels(spark):
    """A name longer than any limit that one might set for labels; and the same misspelt."""
    name = "Maximilian Alexander Ferdinand Bartholomew Montgomery of the Upper Valley"
    cast = spark.createDataFrame([(1, "m", name, None), (2, "m", "Ann Lee", None)], "cast_id long, movie_id string, full_name string, role string")
    rows = [(0, 0, None, f"{name}: Here.", "Default"), (1, 1, "Ann Lee", "There.", "Default"), (2, 2, name.replace("Upper", "Uper"), "Where?", "Default"), (3, 3, None, f"[{name.upper()}] Here.", "Default"), (4, 4, None, "Ann Lee: No.", "Default")]
    got = sorted((x["event_index"], x["cast_id"]) for x in turn_starts(lines_frame(spark, rows), cast).collect())
    assert got == [(0, 1), (1, 2), (2, 1), (4, 2)]


def test_reading_levels_of_held_out_documents(spark):
    r = random.Random(2)
    pools = [[f"{k}w{i}" for i in range(40)] for k in range(4)]
    rows = []
    for i in range(400):
        band = i % 4 + 1
        near = [p for k, p in enumerate(pools) if abs(k + 1 - band) <= 1]
        words = [r.choice(pools[band - 1] if r.random() < 0.6 else r.choice(near)) for _ in range(r.randint(40, 90))]
        rows.append((i, " ".join(x.translate(str.maketrans("0123456789", "abcdefghij")) for x in words), band))
    rows += [(900, None, 0), (901, "", 0), (902, "too short", 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, level int")
    rated = d.filter("level > 0 AND doc_id % 5 = 0").select("doc_id", F.col("level").alias("reading_band"))
    got = {x["doc_id"]: x["reading_band"] for x in reading_levels(d, "doc_id", "text", rated, 40).collect()}
    assert set(got) == set(range(400))
    held = [i for i in range(400) if i % 5]
    assert sum(got[i] == i % 4 + 1 for i in held) / len(held) > 0.9
    assert reading_levels(d.limit(0), "doc_id", "text", rated.limit(0)).count() == 0
    assert reading_levels(d, "doc_id", "text", rated.limit(0), 40).count() == 400


def test_cuts():
    assert cuts_between(np.array([0.0, 1, 2, 3]), np.array([1, 2, 3, 4])) == [0.5, 1.5, 2.5]
