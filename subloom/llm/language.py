"""Languages of texts and of their single-language stretches, by hyperdimensional profiles (problem 1).

Every letter has a fixed random vector of +1 and -1. A letter n-gram is the product of its letters' vectors, each
permuted by its place (bound); a text is the bundle of its n-grams and whole words, and a language prototype the bundle
of those of its sample, frequent ones damped. Texts are compared with the prototypes by cosine. The cosine's numerator is
a sum over n-grams, so the product of each n-gram with the prototypes is worked out once per worker, and stretches are
scored by adding up. Sentences and lines are scored first; one in which some run of words speaks for another language is
cut where the language changes, by the best path over its words with a price for each change.

The prototypes are trained on a bounded sample of labelled documents (SAMPLE a language), in two rounds: the second
leaves out the documents that the first finds to be in another language than their label says.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.llm.encoding import Repairer

LANGUAGES = ("en", "mn", "ru", "de", "fr", "es")
DIM, GRAM, SAMPLE, LONGEST = 16384, 3, 400, 100_000
#: A whole word counts as so many n-grams.
WHOLE = 2.0
MIN_WORDS, MIN_EVENTS = 25, 5
#: Words that a language needs within a sentence of others, how far the second language of so many words stays behind for
#: the sentence to be looked at, and the price of a change in mean scores of a word.
INNER, DOUBT, CHANGE = 12, 0.3, 5.0
#: Longer "words" count by their n-grams alone: no language has them.
WORD_LETTERS = 64
BUCKET = 2048
MEMO = 300_000
_LETTERS = re.compile(r"[^\W\d_]+")
_ENDS = tuple(".!?…")
#: Override tags, and the tags of drawings and karaoke.
_TAG, _DRAW, _KARAOKE = re.compile(r"\{[^}]*\}"), re.compile(r"\\p[1-9]"), re.compile(r"\\(?:kf|ko|K|k)(?=\d|\s|\\|\})")
_BREAK = "\x00"


@lru_cache(maxsize=2000)
def _letter(ch: str, place: int) -> np.ndarray:
    v = np.random.default_rng(ord(ch)).integers(0, 2, DIM, dtype=np.int8) * 2 - 1
    return np.roll(v, place)


def gram_vector(gram: str) -> np.ndarray:
    """The letters of an n-gram or a whole word, each permuted by its place, bound to one vector."""
    v = _letter(gram[0], 0)
    for place, ch in enumerate(gram[1:], 1):
        v = v * _letter(ch, place)
    return v


def grams(word: str) -> Iterator[tuple[str, float]]:
    """n-grams of a word with its edges, and the word itself, with their weights; none where it has no letters."""
    for part in _LETTERS.findall(word.lower()):
        padded = f" {part} "
        for i in range(len(padded) - GRAM + 1):
            yield padded[i : i + GRAM], 1.0
        if GRAM < len(padded) <= WORD_LETTERS + 2:
            yield padded, WHOLE


def _bundle(counts: list[Counter]) -> np.ndarray:
    """A prototype of each language from the numbers of its n-grams; those met once are left out."""
    out = np.zeros((len(LANGUAGES), DIM), np.float32)
    every = sorted({g for c in counts for g, n in c.items() if n > 1})
    for at in range(0, len(every), 512):  # in blocks, so that few vectors are held at a time
        block = every[at : at + 512]
        weights = np.log1p(np.array([[c.get(g, 0) for g in block] for c in counts], np.float32))
        out += weights @ np.array([gram_vector(g) for g in block], np.float32)
    there = np.linalg.norm(out, axis=1) > 0
    out[there] /= np.linalg.norm(out[there], axis=1, keepdims=True)
    if there.sum() > 1:  # what all languages share tells nothing
        out[there] -= out[there].mean(0)
        out[there] /= np.linalg.norm(out[there], axis=1, keepdims=True)
    return out


def _count(words: Counter) -> Counter:
    out: Counter = Counter()
    for word, n in words.items():
        for g, _ in grams(word):
            out[g] += n
    return out


def train(labelled: list[tuple[str, str]]) -> np.ndarray:
    """Prototypes (languages x DIM) from (language, text); a language without a text has a row of zeros.

    The first prototypes take the labels at their word; the second use of each text only the stretches that the first
    find to be in the language of its label.
    """
    labelled = [(LANGUAGES.index(lang), text) for lang, text in labelled if lang in LANGUAGES]
    words: list[Counter] = [Counter() for _ in LANGUAGES]
    for k, text in labelled:
        words[k].update(text.split())
    first = _bundle([_count(w) for w in words])
    seg = Scorer(first).segments([t for _, t in labelled])
    seg = seg.assign(lang=smoothed(seg))
    words = [Counter() for _ in LANGUAGES]
    for owner, part in seg.groupby("owner"):
        k, text = labelled[int(owner)]
        raw = text.split()
        for at, n in part.loc[part["lang"] == k, ["first", "words"]].itertuples(index=False):
            words[k].update(raw[at : at + n])
    second = _bundle([_count(w) for w in words])
    return np.where(np.linalg.norm(second, axis=1, keepdims=True) > 0, second, first)


class GramScores(dict):
    """Products of n-grams with the prototypes. Emptied when too large."""

    def __init__(self, prototypes: np.ndarray) -> None:
        super().__init__()
        self.prototypes = prototypes

    def __missing__(self, gram: str) -> np.ndarray:
        if len(self) >= MEMO:
            self.clear()
        found = self[gram] = self.prototypes @ gram_vector(gram).astype(np.float32)
        return found


class Scorer:
    """Scores of words against the prototypes, and the languages of stretches."""

    def __init__(self, prototypes: np.ndarray) -> None:
        self.gram = GramScores(prototypes)
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[str, int] = {}
        self.scores = np.zeros((1024, len(LANGUAGES)), np.float32)
        self.flags = np.zeros((1024, 2), bool)  # ends a sentence; is a word

    def _id(self, word: str) -> int:
        i = self.ids[word] = len(self.ids)
        if i == len(self.scores):
            self.scores, self.flags = np.concatenate([self.scores, np.zeros_like(self.scores)]), np.concatenate([self.flags, np.zeros_like(self.flags)])
        for g, weight in grams(word):
            self.scores[i] += weight * self.gram[g]
        self.flags[i] = (word == _BREAK or word.rstrip("\"'”’»)]}").endswith(_ENDS), word != _BREAK)
        return i

    def segments(self, texts: list[str]) -> pd.DataFrame:
        """owner, first (word), words, lang (index, -1 where nothing tells), confidence of each sentence, line or part of one."""
        if len(self.ids) > MEMO:
            self._reset()
        ids, known, make = [], self.ids, self._id
        counts = np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            words = t.replace("\n", f" {_BREAK} ").split()
            ids += [known[w] if w in known else make(w) for w in words]
            counts[k] = len(words)
        if not ids:
            return pd.DataFrame({"owner": [], "first": [], "words": [], "lang": [], "second": [], "confidence": []}, dtype=np.int64)
        at = np.array(ids)
        owner = np.repeat(np.arange(len(texts)), counts)
        begins = np.ones(len(at), bool)
        begins[1:] = self.flags[at[:-1], 0] | (owner[1:] != owner[:-1])
        start = inner_borders(self.scores[at], np.flatnonzero(begins))
        scores = np.add.reduceat(self.scores[at], start)
        is_word = self.flags[at, 1].astype(np.int64)
        words = np.add.reduceat(is_word, start)
        before = np.cumsum(is_word) - is_word
        own = owner[start]
        first = before[start] - before[np.searchsorted(owner, own)]
        lang, second, confidence = best(scores)
        keep = words > 0
        return pd.DataFrame({"owner": own, "first": first, "words": words, "lang": lang, "second": second, "confidence": confidence})[keep].reset_index(drop=True)


def best(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Languages of the largest and second cosine, and how far the second stays behind, from 0 to 1; -1 where none is."""
    order = np.argsort(scores, axis=1)
    top, second = (np.take_along_axis(scores, order[:, [-k]], 1)[:, 0] for k in (1, 2))
    sound = top > 0
    confidence = np.where(sound, np.clip((top - np.maximum(second, 0)) / np.where(sound, top, 1), 0, 1), 0.0)
    return np.where(sound, order[:, -1], -1), np.where(sound, order[:, -2], -1), confidence


def inner_borders(scores: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The starts of sentences, and of parts in another language within them, from the scores of all words."""
    ends = np.append(start[1:], len(scores))
    long = np.flatnonzero(ends - start >= 2 * INNER)
    if not len(long):
        return start
    more = []
    for a, b in zip(start[long].tolist(), ends[long].tolist(), strict=True):
        total = np.cumsum(scores[a:b], axis=0, dtype=np.float64)
        windows = total[INNER:] - total[:-INNER]
        main = int(np.argmax(total[-1]))
        top = windows.max(axis=1)
        if ((top - windows[:, main]) > DOUBT * np.maximum(top, 1e-9)).any():
            more += [a + x for x in changes(scores[a:b])]
    return np.sort(np.concatenate([start, np.array(more, np.int64)])) if more else start


def changes(scores: np.ndarray) -> list[int]:
    """Places at which the language changes: the path with the highest sum of scores less a price for each change, in which
    every stretch has INNER words or more."""
    price = CHANGE * float(np.maximum(scores.max(axis=1), 0).mean())
    best, back = scores[0].astype(np.float64), []
    for row in scores[1:]:
        top = int(np.argmax(best))
        change = best[top] - price > best
        back.append(np.where(change, top, -1))
        best = np.where(change, best[top] - price, best) + row
    state = int(np.argmax(best))
    path = [state]
    for b in reversed(back):
        state = state if b[state] < 0 else int(b[state])
        path.append(state)
    path.reverse()
    cut = [i for i in range(1, len(path)) if path[i] != path[i - 1]]
    out, last = [], 0
    for i in cut:  # a stretch that is too short goes with the one before it
        if i - last >= INNER and (not out or path[i] != path[last]):
            out.append(i)
            last = i
    return out if not out or len(path) - out[-1] >= INNER else out[:-1]


def smoothed(seg: pd.DataFrame) -> pd.Series:
    """Language of each sentence; one that tells nothing, or little, goes with the sentences around it."""
    unsure = (seg["lang"] < 0) | (seg["words"] <= 5) & (seg["confidence"] < 0.35) | (seg["confidence"] < 0.08)
    lang = seg["lang"].where(~unsure)
    lang = lang.groupby(seg["owner"]).ffill().groupby(seg["owner"]).bfill()
    return lang.fillna(seg["lang"]).astype(np.int64)


def stretches(seg: pd.DataFrame) -> pd.DataFrame:
    """owner, lang, first, words, confidence of consecutive sentences in one language."""
    if not len(seg):
        return seg[["owner", "lang", "first", "words", "confidence"]]
    lang = smoothed(seg)
    new = (lang != lang.shift()) | (seg["owner"] != seg["owner"].shift())
    weight = seg["confidence"] * seg["words"]
    out = pd.DataFrame({"owner": seg["owner"], "lang": lang, "first": seg["first"], "words": seg["words"], "weight": weight}).groupby(new.cumsum()).agg(owner=("owner", "first"), lang=("lang", "first"), first=("first", "first"), words=("words", "sum"), weight=("weight", "sum"))
    return out.assign(confidence=out["weight"] / out["words"]).drop(columns="weight").query("lang >= 0").reset_index(drop=True)


def labels(codes: DataFrame, code_col: str = "code", language_col: str = "language") -> dict[str, str]:
    """The notations of language labels: a fixed table of some dozens of rows."""
    return {r[0].strip().lower(): r[1].strip().lower()[:2] for r in codes.select(code_col, language_col).dropna().collect()}


def label_column(col: str, known: dict[str, str]):
    """The language that a label stands for; null for a null, empty or unknown one."""
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv]) if known else F.create_map().cast("map<string,string>")
    return F.try_element_at(table, F.lower(F.trim(F.col(col).cast("string"))))


def _sampled(rows: DataFrame, sample: int) -> list:
    """About `sample` rows of each label l, by the hash of their text t; n are kept at most."""
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.pmod(F.xxhash64("t"), F.lit(1_000_003)) / 1_000_003
    chosen = F.lit(False)
    for lang, n in counts.items():
        chosen = chosen | ((F.col("l") == lang) & (share <= min(1.0, sample / n)))
    return rows.filter(chosen).limit(3 * sample * len(LANGUAGES)).collect()


def fit(docs: DataFrame, text_col: str, label: str, events: DataFrame | None = None, sample: int = SAMPLE) -> np.ndarray:
    """Prototypes from about `sample` labelled documents of each language, and ten times as many labelled events.

    events: file_id, text, label. The rows are chosen by the hash of their text; texts of more than LONGEST characters
    aren't trained on, so that the sample stays small.
    """
    usable = F.col(label).isin(*LANGUAGES) & (F.length(text_col) <= LONGEST)
    pick = lambda df, *more: df.filter(usable).select(F.col(label).alias("l"), F.col(text_col).cast("string").alias("t"), *more)
    found = [(r["l"], r["t"]) for r in _sampled(pick(docs), sample)]
    if events is not None:
        files: dict[tuple[str, int], list[str]] = {}
        for r in _sampled(pick(events, "file_id"), 10 * sample):
            files.setdefault((r["l"], r["file_id"]), []).append(spoken(r["t"]))
        found += [(lang, "\n".join(texts)) for (lang, _), texts in sorted(files.items())]
    return train(found)


def document_stretches(docs: DataFrame, id_col: str, text_col: str, prototypes: np.ndarray) -> DataFrame:
    """id_col, language, first_word, n_words, confidence of each stretch of a text in one language.

    Words split at white space; texts of any length are read whole. Null, empty and letterless texts, and others in which
    nothing tells a language, have one row: all their words, no language and confidence 0.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(prototypes)
        names = np.array(LANGUAGES, object)
        for b in batches:
            texts, ids = b["text"].tolist(), b["id"].to_numpy()
            s = stretches(scorer.segments(texts))
            own = s["owner"].to_numpy(int)
            yield pd.DataFrame({id_col: ids[own], "language": names[s["lang"].to_numpy(int)], "first_word": s["first"].astype(int), "n_words": s["words"].astype(int), "confidence": s["confidence"].astype(float)})
            none = np.setdiff1d(np.arange(len(texts)), own)
            yield pd.DataFrame({id_col: ids[none], "language": None, "first_word": 0, "n_words": [len(texts[i].split()) for i in none], "confidence": 0.0})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInPandas(run, f"`{id_col}` long, language string, first_word int, n_words int, confidence double")


def spoken(text: str) -> str:
    """Text of an event for its language: empty for drawings and karaoke; tags dropped, line breaks as such."""
    if "{" in text:
        if _DRAW.search(text) or _KARAOKE.search(text):
            return ""
        text = _TAG.sub("", text)
    return text.replace("\\N", "\n").replace("\\n", "\n").replace("\\h", " ")


def event_languages(events: DataFrame, prototypes: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """file_id, index, code of each Dialogue event with letters: one row for events delivered again.

    code holds the event's id and a bit for each language that it is in, wholly or in part; garbled text is restored
    before it is judged.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, repairer = Scorer(prototypes), Repairer(pairs)
        for b in batches:
            texts = [spoken(repairer.text(t)[0]) for t in b["text"]]
            seg = scorer.segments(texts)
            seg = seg[seg["lang"] >= 0]
            # Where the second language is close, the event may be in either: neither ends its run.
            seg = pd.concat([seg, seg[seg["confidence"] < 0.15].assign(lang=lambda x: x["second"])]) if len(seg) else seg
            # In an event with several sentences, one of a few words and little confidence doesn't speak for itself.
            several = seg.groupby("owner")["lang"].transform("size") > 1
            sure = (seg["words"] > 3) | (seg["confidence"] >= 0.35)
            top = seg.groupby("owner")["words"].transform("max") == seg["words"]
            seg = seg[~several | sure | top]
            mask = np.zeros(len(b), np.int64)
            np.bitwise_or.at(mask, seg["owner"].to_numpy(int), 1 << seg["lang"].to_numpy(int))
            has = np.array([bool(_LETTERS.search(t)) for t in texts], bool)
            yield pd.DataFrame({"file_id": b["file_id"], "index": b["index"], "code": b["event_id"] * 64 + mask})[has]

    rows = events.filter((F.col("kind") == "Dialogue") & F.col("text").isNotNull() & F.col("file_id").isNotNull())
    rows = rows.select(F.col("file_id").cast("long"), F.coalesce(F.col("index").cast("long"), F.lit(-1)).alias("index"), F.col("event_id").cast("long"), F.col("text").cast("string"))
    told = rows.mapInPandas(run, "file_id long, index long, code long")
    return told.groupBy("file_id", "index").agg(F.min("code").alias("code"))


def _bucket_runs(masks: Column, k: int) -> Column:
    """struct(n, head, tail, longest, events) of one language in a bucket's masks in order: its runs at both ends, the
    longest, and its number of events."""
    zero = F.struct(*[F.lit(v).alias(c) for c, v in (("run", 0), ("longest", 0), ("head", -1), ("events", 0))])

    def step(acc: Column, m: Column) -> Column:
        on = F.shiftright(m, k).bitwiseAND(1).cast("int")
        run = F.when(on == 1, acc["run"] + 1).otherwise(0)
        head = F.when((acc["head"] < 0) & (on == 0), acc["run"]).otherwise(acc["head"])
        return F.struct(run.alias("run"), F.greatest(acc["longest"], run).alias("longest"), head.alias("head"), (acc["events"] + on).alias("events"))

    n = F.size(masks)
    return F.aggregate(masks, zero, step, lambda a: F.struct(n.alias("n"), F.when(a["head"] < 0, n).otherwise(a["head"]).alias("head"), a["run"].alias("tail"), a["longest"].alias("longest"), a["events"].alias("events")))


def _longest(buckets: Column) -> Column:
    """Longest run of a language over the buckets of a file in order."""
    zero = F.struct(F.lit(0).alias("tail"), F.lit(0).alias("longest"))

    def step(acc: Column, b: Column) -> Column:
        through = acc["tail"] + b["head"]
        return F.struct(F.when(b["head"] == b["n"], through).otherwise(b["tail"]).alias("tail"), F.greatest(acc["longest"], b["longest"], through).alias("longest"))

    return F.aggregate(buckets, zero, step, lambda a: a["longest"])


def file_runs(told: DataFrame) -> DataFrame:
    """file_id, language, longest (most consecutive events in it), events, of_events.

    Buckets of BUCKET index numbers are summed up each for itself, and the summaries of a file put together in order;
    no row holds more of a file than a bucket's events or its summaries.
    """
    rows = told.select("file_id", F.floor(F.col("index") / BUCKET).cast("long").alias("bucket"), F.struct("index", F.col("code").bitwiseAND(63).cast("int").alias("m")).alias("at"))
    masks = rows.groupBy("file_id", "bucket").agg(F.transform(F.array_sort(F.collect_list("at")), lambda x: x["m"]).alias("masks"))
    each = masks.select("file_id", "bucket", F.posexplode(F.array(*[_bucket_runs(F.col("masks"), k) for k in range(len(LANGUAGES))])).alias("lang", "s"))
    totals = each.groupBy("file_id", "lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "s"))), lambda x: x["s"]).alias("b"), F.sum("s.events").cast("int").alias("events"), F.sum("s.n").alias("of_events"))
    names = F.array(*map(F.lit, LANGUAGES))
    return totals.filter("events > 0").select("file_id", F.get(names, "lang").alias("language"), _longest(F.col("b")).alias("longest"), "events", "of_events")
