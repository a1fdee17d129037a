"""Text that was decoded with the wrong encoding: which it is, and what it was (problem 2).

A text is taken word by word (override tags, line breaks and spaces aside). Best-first search over re-encodings and
unescapings looks for the cheapest reachable form of a word; a visited set stops it from meeting a form twice. The cost
is the implausibility of the characters: control and replacement characters, symbols inside words, mixed scripts,
capitals after small letters, runs of accented letters, and letter pairs that the corpus's own text hardly has (counted
over the whole corpus beforehand). A word is garbled if its own cost is high and a much cheaper form can be reached, or
if it holds what no sound text holds. Words repeat, so every word is searched once per worker.
"""

from __future__ import annotations

import heapq
import html
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Single-byte encodings between which text is mistaken.
SINGLE = ("cp1252", "latin-1", "cp1251", "koi8-r", "cp866", "mac-roman", "cp437", "cp850", "iso8859-5", "mac-cyrillic", "iso8859-15")
#: Separators that garbling leaves alone: ASCII space and line ends, line breaks of the format, override tags.
_PARTS = re.compile(r"(\{[^}]*\}|\\[Nnh]|[ \t\r\n]+)")
_UTF8 = re.compile("[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
_ESCAPED = re.compile(r"&(?:#\d+|#x[0-9a-fA-F]+|\w+);|\\u[0-9a-fA-F]{4}|\\x[0-9a-fA-F]{2}")
#: Letters of Russian and Mongolian beyond ASCII order (fixed values).
CYRILLIC = "абвгдежзийклмнопрстуфхцчшщъыьэюяёөү"
#: Accented letters of German, French and Spanish (fixed values).
ACCENTED = "äöüßàâæçéèêëîïôœùûÿñáíóúì"
_CYR_SET, _ACC_SET = set(CYRILLIC + CYRILLIC.upper()), set(ACCENTED + ACCENTED.upper())
_IN_WORD, _EDGE = set("’‘-–—…'´`"), set("’‘“”„‚«»‹›…—–♪♫¿¡°€№−×·•†™®©")
_QUOTES = set("“”‘’„‚…—–«»‹›¿¡")
_SIZE = len(CYRILLIC)
SUSPECT, GAIN, SHARE = 1.55, 1.1, 0.55
MEMO = 500_000
#: What a step costs: least between the encodings that are mistaken for one another most.
_USUAL, _SEEN = ("cp1252", "cp1251", "utf-8"), ("latin-1", "koi8-r", "cp866", "mac-roman", "utf-16-le", "utf-16-be")
_PRICE = {f"{a}>{b}": 0.3 + 0.15 * ((a in _SEEN) + (b in _SEEN)) for a in _USUAL + _SEEN for b in _USUAL + _SEEN} | {"unescape": 0.3}


def _one(enc: str) -> list[str]:
    """The character of each byte; undefined bytes stand for themselves, as programs do it."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(enc))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


@cache
def _tables() -> tuple[dict[str, dict[int, str]], list[tuple[str, dict[int, str], frozenset[int]]]]:
    """For each encoding the way from its upper characters to byte values, and all ways from one encoding to another."""
    to_byte, ways, lacking = {}, [], {}
    chars = {e: _one(e) for e in SINGLE}
    for e in SINGLE:
        to_byte[e] = {ord(c): chr(b) for b, c in enumerate(chars[e]) if b >= 128}
        if e == "cp1252":  # a byte read as cp1252 and its control character are both seen
            to_byte[e] |= {b: chr(b) for b in range(128, 160)}
        if e != "latin-1":  # what the encoding lacks is no byte of it
            lacking[e] = {c: "\0" for c in range(160, 256) if c not in to_byte[e]}
    for e in SINGLE:
        for d in SINGLE:
            step = {ord(c): chars[d][b] for b, c in enumerate(chars[e]) if b >= 128 and c != chars[d][b]}
            if step and all(step != w[1] for w in ways):
                ways.append((f"{e}>{d}", step, frozenset(to_byte[e])))
    return {e: t | lacking.get(e, {}) for e, t in to_byte.items()}, ways


#: Names of the ways that exchange one single-byte table for another.
_TABLES = {f"{a}>{b}" for a in SINGLE for b in SINGLE}


class Repairer:
    """Finds and restores garbled words. pairs: how often each letter pair of CYRILLIC occurs in the corpus."""

    def __init__(self, pairs: np.ndarray | None = None) -> None:
        counts = np.zeros((_SIZE, _SIZE)) if pairs is None else np.asarray(pairs, float).reshape(_SIZE, _SIZE)
        bits = -np.log2(counts / max(counts.sum(), 1) + 1e-9)
        excess = np.clip((bits - 11) * 0.3, 0, 1.6) if counts.sum() > 1000 else np.zeros_like(bits)
        self.pair = {(a, b): float(excess[i, j]) for i, a in enumerate(CYRILLIC) for j, b in enumerate(CYRILLIC)}
        self.bits = {(a, b): float(bits[i, j]) for i, a in enumerate(CYRILLIC) for j, b in enumerate(CYRILLIC)} if counts.sum() > 1000 else {}
        self.kinds: dict[str, tuple[str, float]] = {}
        self.memo: dict[str, tuple[str, bool, str]] = {}
        self.applied: dict[tuple[str, str], str] = {}
        self.costs: dict[str, float] = {}
        self.tables = {name: (table, has) for name, table, has in _tables()[1]}

    def _kind(self, c: str) -> tuple[str, float]:
        """Kind (a ASCII letter, l accented, c Cyrillic, o other letter, d digit, p in-word mark, s symbol) and cost of a character."""
        n = ord(c)
        if n < 128:
            k = ("a", 0.0) if c.isalpha() else ("d", 0.0) if c.isdigit() else ("p" if c in "'-`" else "m", 0.0) if n >= 32 and n != 127 or c in "\n\t\r" else ("s", 8.0)
        elif c in _CYR_SET:
            k = ("c", 0.0)
        elif c in _ACC_SET:
            k = ("l", 0.05)
        elif c in _EDGE or c in _IN_WORD:
            k = ("p" if c in _IN_WORD else "e", 0.2)
        elif n < 160 or c == "�":
            k = ("s", 8.0)
        else:
            cat = unicodedata.category(c)
            if cat in ("Co", "Cn", "Cs", "Cc"):
                k = ("s", 8.0)
            elif cat == "Mn" and 0x300 <= n < 0x370:  # accents of the letter before
                k = ("l", 0.6)
            elif 0x200B <= n <= 0x200D:  # no width
                k = ("m", 0.6)
            elif cat[0] == "L":
                k = ("l", 0.6) if n < 0x180 and c.lower() != "ƒ" else ("o", 1.5) if n < 0x250 or 0x400 <= n < 0x530 else ("o", 1.0 if 0x3040 <= n < 0x3100 or 0x4E00 <= n < 0xA000 or 0xAC00 <= n < 0xD7B0 else 2.0)
            else:
                k = ("s", 1.0 if n == 0xA0 or cat == "Mn" else 3.0 if 0x2500 <= n < 0x25A0 else 1.5)
        self.kinds[c] = k
        return k

    def cost(self, word: str) -> float:
        total, before, last = 0.0, "", ""
        kinds, n = self.kinds, len(word)
        for i, c in enumerate(word):
            kind, price = kinds.get(c) or self._kind(c)
            total += price
            if kind == "c":
                if before == "c":
                    total += self.pair.get((last.lower(), c.lower()), 0.0)
                    if last.islower() and c.isupper():
                        total += 2.5
                elif before and before in "alo":
                    total += 2.5
            elif kind in "al":
                if before == "c" or before == "o":
                    total += 2.5
                elif kind == "l" and before == "l":
                    total += 1.5
                elif before and before in "al" and last.islower() and c.isupper():
                    total += 0.3 if kind == "a" else 2.0
            elif kind == "o":
                if before and before in "alc":
                    total += 1.5
            elif kind in "pes" and price:
                if before in ("p", "e", "s") and last > "\x7f" and not (c in _QUOTES and last in _QUOTES):
                    total += 0.2 if last == c else 2.0  # marks in a row
                if (kind != "p" or c == "…") and before and before in "aclo" and i + 1 < n and word[i + 1].isalpha():
                    total += 2.5  # a symbol inside a word
            before, last = kind, c
        return total

    @staticmethod
    def unescaped(word: str) -> str:
        return html.unescape(re.sub(r"\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})", lambda m: chr(int(m[1] or m[2], 16)), word))

    def _next(self, word: str) -> Iterator[tuple[str, str]]:
        to_byte, ways = _tables()
        if "&" in word or "\\" in word:
            if _ESCAPED.search(word):
                yield "unescape", self.unescaped(word)
        if word.isascii() and "\0" not in word:
            return
        if "\0" in word or any(ord(c) > 0x7FF for c in word):
            for a, b in (("utf-16-le", "utf-16-be"), ("latin-1", "utf-16-le"), ("latin-1", "utf-16-be")):
                try:
                    yield f"{a}>{b}", word.encode(a).decode(b)
                except (UnicodeEncodeError, UnicodeDecodeError):
                    continue
        for e, table in to_byte.items():
            b = word.translate(table) if e != "latin-1" else word
            if _UTF8.search(b):
                out, at = [], 0
                for m in _UTF8.finditer(b):
                    try:
                        c = m[0].encode("latin-1").decode("utf-8")
                    except UnicodeDecodeError:
                        continue
                    out += [word[at : m.start()], c]
                    at = m.end()
                if out:
                    yield f"{e}>utf-8", "".join(out) + word[at:]
        upper = {c for c in map(ord, word) if c > 127}
        for name, table, has in ways:
            if upper <= has:  # all that was read with an encoding is in it
                other = word.translate(table)
                if other != word:
                    yield name, other

    def search(self, word: str) -> tuple[str, float, str]:
        """The cheapest form within reach, its cost and the way to it.

        The forms within reach are finite, as decoding and unescaping shorten a word and tables are exchanged once. Ways
        are followed as long as what they cost by themselves leaves room for a form that would be taken.
        """
        start = self.cost(word)
        room = min(start - GAIN, SHARE * start)
        best = (start, 0.0, word, "")
        heap, seen = [(start, *best)], {word}
        while heap:
            _, price, spent, form, way = heapq.heappop(heap)
            for name, other in self._next(form):
                if other in seen or name in _TABLES and any(w in _TABLES for w in way.split(" ")):
                    continue  # two exchanges of tables would turn sound words into other words
                paid = spent + _PRICE.get(name, 0.9)
                if paid > room or paid >= best[0]:
                    continue
                seen.add(other)
                c = self.cost(other) + paid
                found = (c, paid, other, f"{way} {name}".strip())
                if c < best[0]:
                    best = found
                    if c - paid <= 0.4 + 0.03 * len(other):
                        return other, c, found[3]  # as plausible as sound text
                # Bytes that happen to be UTF-8 are rare: such a form is looked at early, dear as it may be itself.
                lead = 1.5 * (len(form) - len(other)) if name.endswith(">utf-8") else 0.0
                heapq.heappush(heap, (c - lead, *found))
        return best[2], best[0], best[3]

    def word(self, word: str) -> tuple[str, bool, str]:
        """The word as it was, whether it is garbled, and the way back."""
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            found = self.memo[word] = self._judge(word)
        return found

    def _judge(self, word: str) -> tuple[str, bool, str]:
        own = self.cost(word)
        if own < SUSPECT:
            whole = self.unescaped(word) if _ESCAPED.search(word) else word
            if whole == word:
                return self._spelt(word, own)
            best, bad, way = self._judge(whole)  # a character reference is sound, one to garbled characters isn't
            return (best, True, f"unescape {way}".strip()) if bad else (word, False, "")
        if word.replace("\ufffd", "").isascii():
            return word, True, ""  # nothing is left to restore it from
        best, price, way = self.search(word)
        if way and own - price >= GAIN and price <= SHARE * own and price <= 0.5 * len(best) + 2:
            return best, True, way
        bad = any(c in "�\0" or "\x80" <= c <= "\x9f" for c in word)
        return word, bad, ""

    def _spelt(self, word: str, own: float) -> tuple[str, bool, str]:
        """For a word that seems sound: whether all its characters beyond ASCII are bytes of UTF-8, three or more to one
        character, which no sound word is by chance, and spell something cheaper."""
        upper = sum(c > "\x7f" for c in word)
        if upper >= 3:
            for name, other in self._next(word):
                left = sum(c > "\x7f" for c in other)
                if name.endswith(">utf-8") and upper >= 3 * left > 0 and self.cost(other) < own:
                    best, _, way = self._judge(other)
                    return best, True, f"{name} {way}".strip()
        return word, False, ""

    def text(self, text: str) -> tuple[str, bool, str]:
        """The text as it was, whether any of it is garbled, and the ways back."""
        if text.isascii() and "\0" not in text and not _ESCAPED.search(text):
            return text, False, ""
        if "\0" in text:  # UTF-16 read byte by byte: words alone may begin inside a character
            for e in ("utf-16-le", "utf-16-be"):
                try:
                    whole = text.encode("latin-1").decode(e)
                except (UnicodeEncodeError, UnicodeDecodeError):
                    continue
                if "\0" not in whole and 2 * sum(c < "\x80" for c in whole) >= len(whole):
                    return whole, True, f"latin-1>{e}"
        parts, ways = _PARTS.split(text), []
        garbled, left, found = False, [], []
        for i in range(0, len(parts), 2):
            if parts[i] and (not parts[i].isascii() or "\0" in parts[i] or _ESCAPED.search(parts[i])):
                part, bad, way = self.word(parts[i])
                garbled = garbled or bad
                if way:
                    ways.append(way)
                    found.append((i, parts[i], way))
                elif not bad:
                    left.append(i)
                parts[i] = part
        if not garbled:
            return text, False, ""
        if ways:
            usual = self._usual(ways, [raw for _, raw, _ in found], [parts[i] for i in left])
            most = sum(len(raw) for _, raw, _ in found) >= sum(len(parts[i]) for i in left)
            # Words that tell nothing alone follow the others of their text; all of them do where it may be garbled throughout.
            others = {i: self.apply(usual, parts[i]) for i in left}
            whole = most and all(self.cost(x) <= self.cost(parts[i]) + 0.1 for i, x in others.items())
            for i, other in others.items():
                if other != parts[i] and (whole or self._follows(parts[i], other, most)):
                    parts[i] = other
            for i, raw, way in found:  # and so do words for which another way seemed as good
                if way != usual:
                    other = self.apply(usual, raw)
                    slack = 2.5 if ways.count(usual) > 1 else 0.3
                    if self.cost(other) <= min(self.cost(parts[i]) + slack, 0.6 * self.cost(raw)):
                        parts[i] = other
        return "".join(parts), True, ", ".join(sorted(set(ways)))

    def _usual(self, ways: list[str], garbled: list[str], left: list[str]) -> str:
        """The way of the text: of those that its words were restored by, and others to the same encoding that all its
        characters are in, the one that leaves the text the cheapest."""
        to_byte, tables = _tables()[0], self.tables.keys()
        upper = {c for x in [*garbled, *left] for c in map(ord, x) if c > 127}
        whole = [e for e in SINGLE if upper <= to_byte[e].keys()]
        each = sorted({*ways, *(f"{e}>{w.split('>')[1]}" for w in ways if w in tables for e in whole)} & {*ways, *tables})
        if len(each) == 1:
            return each[0]
        # A table that is the same for these characters bears another name only: ties go to the way of most words.
        price = lambda w: sum(self._known(self.apply(w, x)) for x in garbled) + sum(min(self._known(self.apply(w, x)), self._known(x)) for x in left)
        return min(each, key=lambda w: (round(price(w), 6), -ways.count(w), w))

    def _known(self, word: str) -> float:
        """The cost of a word, remembered."""
        found = self.costs.get(word)
        if found is None:
            if len(self.costs) >= MEMO:
                self.costs.clear()
            found = self.costs[word] = self.cost(word)
        return found

    def _follows(self, raw: str, other: str, most: bool) -> bool:
        """Whether a word that seems sound is taken for garbled like the rest of its text: where most of the text is garbled
        and the other form costs no more, where it is dear and the other form cheap, or where its letter pairs are rarer than
        those of the other form."""
        a, b = self.cost(raw), self.cost(other)
        if most and b <= a + 0.1 and not (raw.islower() and other.isupper()) or a >= SUSPECT and b <= SHARE * a:
            return True
        rare, usual = self._rarity(raw), self._rarity(other)
        return rare is not None and usual is not None and usual + 2.0 < rare and b <= a + 0.1

    def _rarity(self, word: str) -> float | None:
        """Mean bits of the Cyrillic letter pairs of a word; null where it has none."""
        low = word.lower()
        found = [self.bits[p] for p in zip(low, low[1:]) if p in self.bits]
        return sum(found) / len(found) if found else None

    def apply(self, way: str, word: str) -> str:
        """The form that a known way leads to; the word itself where the way is closed."""
        found = self.applied.get((way, word))
        if found is None:
            if len(self.applied) >= MEMO:
                self.applied.clear()
            found = self.applied[way, word] = self._apply(way, word)
        return found

    def _apply(self, way: str, word: str) -> str:
        if way in self.tables:
            table, has = self.tables[way]
            return word.translate(table) if all(c < 128 or c in has for c in map(ord, word)) else word
        form = word
        for step in way.split(" "):
            form = next((other for name, other in self._next(form) if name == step), None)
            if form is None:
                return word
        return form


def letter_pairs(df: DataFrame, text_col: str) -> np.ndarray:
    """How often each pair of letters of CYRILLIC stands in the whole corpus: a table of fixed size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = np.full(0x110000, -1, np.int16)
        for i, c in enumerate(CYRILLIC):
            place[ord(c)] = place[ord(c.upper())] = i
        counts = np.zeros(_SIZE * _SIZE, np.int64)
        for b in batches:
            codes = place[np.frombuffer("\n".join(b["text"]).encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int32)
            both = (codes[:-1] >= 0) & (codes[1:] >= 0)
            counts += np.bincount((codes[:-1] * _SIZE + codes[1:])[both], minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"pair": at.astype(np.int32), "n": counts[at]})

    rows = df.select(F.col(text_col).cast("string").alias("text")).filter(F.col("text").rlike("[\\u0400-\\u04FF]"))
    counts = np.zeros(_SIZE * _SIZE, np.int64)
    for r in rows.mapInPandas(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[r["pair"]] = r["n"]
    return counts


def repaired(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id_col, text, restored, way of every garbled row; restored is the text as far as it can be had, way how it was got.

    Null and empty texts aren't garbled. Repeated rows count like any other; an empty table gives an empty one; further
    columns are dropped. A garbled text that can't be restored keeps its form and has an empty way.
    """
    pairs = letter_pairs(df, text_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = Repairer(pairs)
        for b in batches:
            told = [r.text(t) for t in b["text"]]
            keep = np.array([x[1] for x in told], bool)
            out = b.assign(restored=[x[0] for x in told], way=[x[2] for x in told])
            yield out[keep]

    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter(F.col("text").rlike("[^\\x01-\\x7F]|&|\\\\[ux]"))
    return rows.mapInPandas(run, f"`{id_col}` long, text string, restored string, way string")
