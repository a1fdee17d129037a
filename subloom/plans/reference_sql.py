"""SQL (DuckDB) that gives the same rows as the reference queries.

Patterns and lists are stated here once more, from the rules in words, so that a slip in the library's shows.
"""

from __future__ import annotations

import unicodedata

#: White space: tab to carriage return, the four separators, blank, and the Unicode spaces (fixed values).
SPACE = r"\t\n\x{0b}\f\r\x{1c}\x{1d}\x{1e}\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LETTER = r"[\p{Lu}\p{Ll}\p{Lt}\p{Lm}\p{Lo}\p{Nl}\p{No}]"
LATIN, CYRILLIC = "[a-zA-ZÀ-ɏ]", r"[\x{0400}-\x{04ff}]"
#: A letter or number, then letters, marks, numbers, apostrophes and hyphens.
WORD = r"[\p{L}\p{N}][\p{N}\p{L}\p{M}’'\-]*"
#: Words that mean a language in names of files and folders (fixed values).
EN_TOKENS = ["english", "en", "eng", "engl"]
MN_TOKENS = ["mongolian", "mn", "mon", "mng", "mongol", "khalkha"]
#: Styles that aren't dialogue (fixed values), as words of Latin letters.
STYLES = "sign signs op ed opening ending karaoke title titles credit credits song songs lyric lyrics typeset typesetting ts note notes caption logo".split()
SKIP_STYLE = f"(^|[^a-z])({'|'.join(STYLES)})($|[^a-z])"
#: Tags that are left: a brace, a line break, or a backslash and the name of a tag (fixed values).
TAGS = "N n h a b i u s c K k p move fad fs fn".split()
RESIDUAL = r"[{}]|\\(" + "|".join(TAGS) + ")"
MARKUP = "<[/]?[a-zA-Z][^<>]*>"
NO_LETTERS = rf"^([{SPACE}]|\p{{P}}|\p{{S}})*$"
#: Addresses, and phrases of credits in English and Mongolian (fixed values).
_NOT_IN_WORD = r"($|[^\p{L}\p{M}\p{N}_])"
ADDRESS = r"http://|https://|www[.]|[.](com|net|org|mn)" + _NOT_IN_WORD
PHRASES = ["synced", "corrected by", "translated by", "resync", "opensubtitles", "subscene", "addic7ed", "encoded by", "ripped by"]
CREDIT = rf"(^|[^\p{{L}}\p{{M}}\p{{N}}_])((subtitle|subtitles|subs|sub)[{SPACE}]+by|{'|'.join(PHRASES)})" + _NOT_IN_WORD + rf"|орчуулсан|орчуулагч|орчуулга[{SPACE}]*[:：]|хадмал[{SPACE}]*[:：]|хадмалыг"
#: Latin letters that UTF-8 text turns into: D0 or D1 and a control sign or an early Cyrillic letter, C3 or C2 and a control sign, â€.
WRONG_DECODING = r"[ÐÑ][\x{80}-\x{bf}Ѐ-џ]|[ÃÂ][\x{80}-\x{bf}]|â€"


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _count(t: str, pattern: str) -> str:
    return f"len(regexp_extract_all({t}, {_q(pattern)}))"


def _strip(t: str) -> str:
    return f"regexp_replace({t}, {_q(f'^[{SPACE}]+|[{SPACE}]+$')}, '', 'g')"


def _one_line(t: str) -> str:
    return f"regexp_replace(regexp_replace({t}, {_q(f'[{SPACE}]+')}, ' ', 'g'), '^ | $', '', 'g')"


def _match(t: str, pattern: str, options: str = "") -> str:
    return f"regexp_matches({t}, {_q(pattern)}{', ' + _q(options) if options else ''})"


def _caption(t: str) -> str:
    wrapped = f"(left({t}, 1) = '(' AND right({t}, 1) = ')') OR (left({t}, 1) = '[' AND right({t}, 1) = ']')"
    p_l, p_u = _count(t, r"\p{L}"), _count(t, r"\p{Lu}")
    return f"({t} <> '' AND ({wrapped} OR ({p_l} > 0 AND {_count(t, WORD)} >= 3 AND {p_u}::DOUBLE / nullif({p_l}, 0) >= 0.8)))"


_CONTROL = r"[\x{00}-\x{08}\x{0b}-\x{1f}\x{7f}-\x{9f}\x{ad}\x{600}-\x{605}\x{61c}\x{6dd}\x{70f}\x{180e}\x{200c}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{2064}\x{2066}-\x{206f}\x{feff}\x{fff9}-\x{fffb}]"


def _classified(source: str, key: str, text: str) -> str:
    """CTE `classified` (key, raw, t, reject, review) over a source."""
    t = "t"
    rules = [
        ("punctuation_only", _match(t, NO_LETTERS)),
        ("replacement_char", f"contains({t}, '�')"),
        ("control_chars", _match(t, _CONTROL)),
        ("mojibake", _match(t, WRONG_DECODING)),
        ("residual_ass_tags", _match(t, RESIDUAL)),
        ("html_tags", _match(t, MARKUP)),
        ("credit_or_url", f"({_match(t, ADDRESS, 'i')} OR {_match(t, CREDIT, 'i')})"),
        ("cyrillic_text", f"coalesce({_count(t, CYRILLIC)}::DOUBLE / nullif({_count(t, LETTER)}, 0), 0) >= 0.5"),
    ]
    listed = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in rules)
    return f"""stripped AS (SELECT {key}, coalesce({text}, '') AS raw, {_strip(f"coalesce({text}, '')")} AS t FROM {source}),
classified AS (
  SELECT *, CASE WHEN t = '' THEN ['empty_text'] ELSE list_filter([{listed}], lambda x: x IS NOT NULL) END AS reject,
    list_filter([CASE WHEN length(t) > 600 THEN 'very_long' END, CASE WHEN {_caption(t)} THEN 'caption' END], lambda x: x IS NOT NULL) AS review
  FROM stripped
), judged AS (
  SELECT *, CASE WHEN len(reject) > 0 THEN 'rejected' WHEN len(review) > 0 THEN 'review' ELSE 'clean' END AS status,
    CASE WHEN len(reject) > 0 THEN reject ELSE review END AS reasons FROM classified
)"""


_LINES = "WITH " + _classified("line_records", "record_id", "text")
_KEY = f"regexp_replace(lower(raw), {_q(f'[{chr(92)}p{{P}}{chr(92)}p{{S}}{SPACE}]+')}, '', 'g')"
_DEDUPED = (
    _LINES
    + f""", keyed AS (SELECT *, CASE WHEN status <> 'rejected' THEN {_KEY} END AS k FROM judged
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY record_id) AS r, first_value(t) OVER (PARTITION BY k ORDER BY record_id) AS first_t FROM keyed
), final AS (
  SELECT record_id, CASE WHEN k IS NOT NULL AND r > 1 THEN 'rejected' ELSE status END AS status,
    CASE WHEN k IS NOT NULL AND r > 1 THEN [CASE WHEN t = first_t THEN 'duplicate_exact' ELSE 'duplicate_near' END] ELSE reasons END AS reasons FROM ranked
)"""
)

# Plain text of events: what stands after a block that turns drawing on goes, then the blocks go, then breaks are read.
_DRAWN = r"(\{[^}]*\\p[1-9][^}]*\})[^{]+"


def _plain(t: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({t}, " + _q(_DRAWN) + r", '\1', 'g'), '\{[^}]*\}', '', 'g'), '\\[Nn]', chr(10), 'g'), '\\h', ' ', 'g')"


_PLAIN = _plain("text")
_KARAOKE = r"regexp_matches(text, '\{[^}]*\\(?:kf|ko|K|k)(?:[0-9\s\\][^}]*)?\}')"
_EVENTS = f"""WITH parsed AS (
  SELECT *, {_PLAIN} AS plain_text, {_KARAOKE} AS karaoke FROM file_events
), told AS (
  SELECT *, coalesce(NOT karaoke AND {_match('plain_text', LETTER)}, false) AS translatable, {_one_line('plain_text')} AS one FROM parsed
)"""


def _seconds(c: str) -> str:
    s = f"regexp_replace({_strip(c)}, '[ ]*:[ ]*', ':', 'g')"
    whole = r"^(?:[+-]?\d+:)?[+-]?\d+:[+-]?(?:\d+\.?\d*|\.\d+)$"
    hours = f"CASE WHEN len(string_split({s}, ':')) = 3 THEN try_cast(string_split({s}, ':')[1] AS BIGINT) ELSE 0 END"
    return f"CASE WHEN {_match(s, whole)} THEN {hours} * 3600 + try_cast(string_split({s}, ':')[-2] AS BIGINT) * 60 + try_cast(string_split({s}, ':')[-1] AS DOUBLE) END"


_REASON = f"""CASE WHEN coalesce(kind <> 'Dialogue', true) OR NOT translatable OR one = '' THEN 'not_translatable'
  WHEN {_match("coalesce(style, '')", SKIP_STYLE, 'i')} THEN 'skipped_style'
  WHEN {_strip("coalesce(effect, '')")} <> '' THEN 'skipped_effect'
  WHEN {_seconds('"start"')} IS NULL OR {_seconds('"end"')} IS NULL THEN 'bad_timestamp' END"""


def _stamp(c: str) -> str:
    cs = f"CAST(round_even(greatest({c}, 0) * 100, 0) AS BIGINT)"
    return f"CASE WHEN {c} IS NOT NULL THEN printf('%d:%02d:%02d.%02d', {cs} // 360000, ({cs} // 6000) % 60, ({cs} // 100) % 60, {cs} % 100) END"


_SPLIT = "[" + SPACE + r"._\-()\[\]{}]+"
_TOKENS = f"list_filter(regexp_split_to_array(lower(stem), {_q(_SPLIT)}), lambda x: x <> '')"
_EN, _MN = str(EN_TOKENS), str(MN_TOKENS)
_BOTH = str(EN_TOKENS + MN_TOKENS)
_BY_NAME = f"CASE WHEN list_has_any({_TOKENS}, {_EN}) AND NOT list_has_any({_TOKENS}, {_MN}) THEN 'en' WHEN list_has_any({_TOKENS}, {_MN}) AND NOT list_has_any({_TOKENS}, {_EN}) THEN 'mn' END"
_FOLDERS = "list_filter(string_split(coalesce(rel_dir, ''), '/'), lambda x: x <> '')"
_FIRST = f"lower(list_filter({_FOLDERS}, lambda x: list_contains({_BOTH}, lower(x)))[1])"
_BY_FOLDER = f"CASE WHEN list_contains({_EN}, {_FIRST}) THEN 'en' WHEN list_contains({_MN}, {_FIRST}) THEN 'mn' END"
_GROUP = f"array_to_string(list_filter({_FOLDERS}, lambda x: NOT list_contains({_BOTH}, lower(x))), '/')"
_BASE = f"array_to_string(list_filter({_TOKENS}, lambda x: NOT list_contains({_BOTH}, x)), '_')"
_JOINED = f"concat_ws('_', nullif(replace({_GROUP}, '/', '_'), ''), nullif({_BASE}, ''))"
_SAFE = f"regexp_replace(regexp_replace(CASE WHEN {_JOINED} = '' THEN 'root' ELSE {_JOINED} END, '[^A-Za-z0-9_.\\-]+', '_', 'g'), '^_+|_+$', '', 'g')"

_SCRIPT = (
    _EVENTS
    + f""", numbered AS (
  SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY event_id) AS n FROM told WHERE kind = 'Dialogue'
), first AS (
  SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY event_id) AS k FROM numbered WHERE n <= 900 AND translatable
), sums AS (
  SELECT file_id, sum({_count('one', LETTER)}) AS letters, sum({_count('one', CYRILLIC)}) AS cyrillic, sum({_count('one', LATIN)}) AS latin FROM first WHERE k <= 300 GROUP BY file_id
), script AS (
  SELECT *, CASE WHEN cyrillic / nullif(letters, 0) >= 0.5 THEN 'mn' WHEN latin / nullif(letters, 0) >= 0.5 THEN 'en' END AS detected FROM sums
)"""
)
_STATS = (
    _EVENTS
    + f""", stats AS (
  SELECT file_id, count(*) AS dialogue_count, count(*) FILTER (translatable) AS translatable_count,
    CAST(sum(CASE WHEN translatable THEN {_count('one', WORD)} ELSE 0 END) AS BIGINT) AS words, CAST(sum(CASE WHEN translatable THEN length(one) ELSE 0 END) AS BIGINT) AS chars
  FROM told WHERE kind = 'Dialogue' GROUP BY file_id
)"""
)
_AVG = "round_even(coalesce({0}::DOUBLE / nullif(translatable_count, 0), 0), 2)"

_PAIRS = r"""WITH a AS (
  SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY event_id) AS n FROM file_events
)"""

_WRITTEN = r"""e AS (SELECT * REPLACE (regexp_replace(coalesce(text, ''), '[\r\n]+', '\\N', 'g') AS text) FROM file_events)"""
_LABEL = """kind || ' #' || "index" || ' [' || "start" || ' -> ' || "end" || ']'"""


def _unsound() -> str:
    """Ranges of the plane of common characters, by rule: replacement, control, format, private and unassigned ones."""
    codes = [c for c in range(0x10000) if c not in (9, 10) and (c == 0xFFFD or unicodedata.category(chr(c)) in ("Cc", "Cf", "Co", "Cn")) and not 0xD800 <= c < 0xE000]
    ends = [i for i, c in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != c + 1]
    return "".join(f"\\x{{{codes[a]:x}}}-\\x{{{codes[b]:x}}}" for a, b in zip([0, *[i + 1 for i in ends[:-1]]], ends, strict=True))


def _bad(t: str) -> str:
    return f"list_sort(list_distinct(list_transform(regexp_extract_all({t}, '[{_UNSOUND}]'), lambda c: printf('U+%04X', unicode(c)))))"


_UNSOUND = _unsound()
_TRANSLATED = (
    _EVENTS
    + f""", numbered AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY event_id) AS n FROM told
), changed AS (
  SELECT *, CASE WHEN n % 9 = 0 THEN '' WHEN n % 8 = 0 THEN text || chr(65533) || chr(7) WHEN n % 10 IN (4, 5) THEN 'Адилхан мөр' ELSE text END AS t, {_strip('plain_text')} AS src, {_LABEL} AS label
  FROM numbered WHERE translatable
), spoken AS (SELECT *, {_plain('t')} AS out, {_bad('t')} AS bad FROM changed
), words AS (SELECT *, {_strip('out')} AS dst, regexp_extract_all(src, {_q(LETTER + "+(['’-]" + LETTER + "+)*")}) AS ws FROM spoken
), pairs AS (
  SELECT *, dst = '' AS empty, dst <> '' AND src = dst AND NOT (NOT {_match('src', LETTER)} OR (len(ws) <= 2 AND len(list_filter(ws, lambda y: NOT regexp_matches(y, '^\\p{{Lu}}'))) = 0)) AS same FROM words
), prior AS (
  SELECT file_id, n, lag(src) OVER w AS src_b, lag(dst) OVER w AS dst_b FROM pairs WHERE kind = 'Dialogue' AND NOT empty WINDOW w AS (PARTITION BY file_id ORDER BY n)
), flagged AS (
  SELECT p.*, coalesce(dst = dst_b AND src <> src_b AND length(dst) > 3, false) AS again FROM pairs p LEFT JOIN prior USING (file_id, n)
), summed AS (
  SELECT file_id, count(*) AS translatable, count(*) FILTER (empty) AS n_empty, count(*) FILTER (len(bad) > 0) AS n_bad, count(*) FILTER (same) AS n_untranslated, count(*) FILTER (again) AS n_duplicated,
    CAST(sum({_count('out', LETTER)}) AS BIGINT) AS letters, CAST(sum({_count('out', LATIN)}) AS BIGINT) AS latin FROM flagged GROUP BY file_id
), judged AS (SELECT *, n_untranslated::DOUBLE / translatable AS u, coalesce(latin::DOUBLE / nullif(letters, 0), 0) AS la FROM summed)"""
)


def _greedy(ratios: tuple[float, float, float], forced: str = "false") -> str:
    """Episodes by size, each to the split with the lowest fill, the first of equal ones; forced ones are in test before."""
    fill = lambda c, r: f"{c}::DOUBLE / ({r}::DOUBLE * total)"
    a, b, c = (fill(x, r) for x, r in zip(("w.a", "w.b", "w.c"), ratios, strict=True))
    return f"""WITH RECURSIVE sizes AS (SELECT coalesce(movie_id, 'None') AS m, count(*) AS n FROM line_records GROUP BY 1
), ordered AS (SELECT n, row_number() OVER (ORDER BY n DESC, m) AS r FROM sizes WHERE NOT ({forced})
), begin AS (SELECT sum(n) AS total, coalesce(sum(n) FILTER ({forced}), 0) AS f, count(*) FILTER ({forced}) AS k FROM sizes
), w AS (
  SELECT 0 AS r, total, 0::BIGINT AS a, 0::BIGINT AS b, f::BIGINT AS c, 0 AS ka, 0 AS kb, k::INT AS kc FROM begin
  UNION ALL
  SELECT s.r + 1, total, a + CASE WHEN x = 1 THEN n ELSE 0 END, b + CASE WHEN x = 2 THEN n ELSE 0 END, c + CASE WHEN x = 3 THEN n ELSE 0 END,
    ka + (x = 1)::INT, kb + (x = 2)::INT, kc + (x = 3)::INT
  FROM (SELECT w.*, o.n, CASE WHEN {a} <= {b} AND {a} <= {c} THEN 1 WHEN {b} <= {c} THEN 2 ELSE 3 END AS x FROM w JOIN ordered o ON o.r = w.r + 1) s
), last AS (SELECT * FROM w ORDER BY r DESC LIMIT 1)
SELECT split, lines, movies::BIGINT AS movies, round_even(lines::DOUBLE / total, 4) AS line_share FROM (
  SELECT 'train' AS split, a AS lines, ka AS movies, total FROM last UNION ALL SELECT 'validation', b, kb, total FROM last UNION ALL SELECT 'test', c, kc, total FROM last
) WHERE movies > 0"""


_HEAD = [
    "[Script Info]", "Title: ", "ScriptType: v4.00+", "WrapStyle: 0", "ScaledBorderAndShadow: yes", "PlayResX: 1280", "PlayResY: 720", "", "[V4+ Styles]",
    "Format: Name, Fontname, Fontsize, PrimaryColour, SecondaryColour, OutlineColour, BackColour, Bold, Italic, Underline, StrikeOut, ScaleX, ScaleY, Spacing, Angle, BorderStyle, Outline, Shadow, Alignment, MarginL, MarginR, MarginV, Encoding",
]
_STYLE = "Style: ' || s || ',Arial,48,&H00FFFFFF,&H000000FF,&H00000000,&H00000000,0,0,0,0,100,100,0,0,1,2,2,2,10,10,10,1"
_TOP = r"kind IN ('Dialogue', 'Comment') AND regexp_matches(text, '\{[^}]*\\an8[^}]*\}')"

SQL: dict[str, str] = {
    "clean_repeats": "WITH three AS (SELECT r.* FROM line_records r, range(3)), "
    + _classified("three", "movie_id, \"start\", event_index", "text")
    + f""", keyed AS (SELECT *, CASE WHEN status <> 'rejected' THEN {_KEY} END AS k FROM judged
), ranked AS (
  SELECT *, row_number() OVER w AS r, first_value(t) OVER w AS first_t FROM keyed WINDOW w AS (PARTITION BY k ORDER BY movie_id NULLS FIRST, "start" NULLS FIRST, event_index NULLS FIRST, raw)
), final AS (
  SELECT raw AS text, CASE WHEN k IS NOT NULL AND r > 1 THEN 'rejected' ELSE status END AS status,
    CASE WHEN k IS NOT NULL AND r > 1 THEN [CASE WHEN t = first_t THEN 'duplicate_exact' ELSE 'duplicate_near' END] ELSE reasons END AS reasons FROM ranked
) SELECT text, status, array_to_string(reasons, ',') AS reasons, count(*) AS n_lines FROM final GROUP BY 1, 2, 3""",
    "extract_two_sections": _EVENTS
    + f""", kept AS (SELECT *, {_seconds('"start"')} AS s, CAST(event_id // 2 AS INTEGER) AS place FROM told WHERE ({_REASON}) IS NULL)
SELECT event_id, CAST(file_id AS VARCHAR) AS movie_id, one AS text, coalesce(lag(one) OVER w, '') AS context_before, coalesce(lead(one) OVER w, '') AS context_after, place AS event_index
FROM kept WINDOW w AS (PARTITION BY file_id ORDER BY s, place, event_id)""",
    "line_split": r"""WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '^\x{feff}', '') AS t FROM documents), l AS (SELECT doc_id, string_split(t, CASE WHEN contains(t, chr(13) || chr(10)) THEN chr(13) || chr(10) ELSE chr(10) END) AS l FROM t)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(list_filter(l, lambda x: x = '')) AS BIGINT) AS n_empty, CAST(list_sum(list_transform(l, lambda x: length(x))) AS BIGINT) AS chars FROM l""",
    "restore_around_changes": r"""SELECT event_id, regexp_extract(text, '^((?:\{[^}p]*\})+)([^{}\\\r\n]+)$', 1) || 'дөрөв{\b1}\Nтав{\i0}' AS restored FROM file_events WHERE kind = 'Dialogue'""",
    "grouped_split": _greedy((0.8, 0.1, 0.1)),
    "forced_split": _greedy((0.6, 0.2, 0.2), "m LIKE '%s01e01%'"),
    "split_rows": "SELECT CAST(0 AS BIGINT) AS n_torn, count(*) AS n_lines FROM line_records",
    "structure_messages": _PAIRS
    + r""", b AS (SELECT * REPLACE (CASE WHEN n % 11 = 0 THEN 'Changed' ELSE style END AS style, CASE WHEN n % 13 = 0 THEN layer + 1 ELSE layer END AS layer, CASE WHEN n % 17 = 0 THEN '{\blur9}{\blur9}' || text ELSE text END AS text)
  FROM a WHERE NOT (n % 50 = 0 AND file_id % 2 = 0)
), c AS (SELECT file_id, count(*) AS na FROM a GROUP BY file_id), d AS (SELECT file_id, count(*) AS nb FROM b GROUP BY file_id
), p AS (SELECT a.file_id, a.n, a."""
    + _LABEL.replace('"index"', 'a."index"').replace('"start"', 'a."start"').replace('"end"', 'a."end"')
    + r""" AS label, a.style AS s1, b.style AS s2, a.layer AS l1, b.layer AS l2, a.text AS t1, b.text AS t2 FROM a JOIN b USING (file_id, n)
)
SELECT file_id, -1 AS ordinal, 'event count differs: ' || na || ' != ' || coalesce(nb, 0) AS issue FROM c LEFT JOIN d USING (file_id) WHERE na <> coalesce(nb, 0)
UNION ALL SELECT file_id, CAST(n AS INTEGER), label || ': style changed (''' || s1 || ''' -> ''' || s2 || ''')' FROM p WHERE s1 <> s2
UNION ALL SELECT file_id, CAST(n AS INTEGER), label || ': layer changed (' || l1 || ' -> ' || l2 || ')' FROM p WHERE l1 <> l2
UNION ALL SELECT file_id, CAST(n AS INTEGER), label || ': unexpected tag {\blur9} x2' FROM p WHERE t1 <> t2
UNION ALL SELECT file_id, CAST(n AS INTEGER), label || ': unbalanced braces in translated text' FROM p WHERE length(replace(t2, '{', '')) <> length(replace(t2, '}', ''))""",
    "translation_messages": _TRANSLATED
    + f""", sampled AS (
  SELECT file_id, array_to_string(list(label || ': ''' || src || '''' ORDER BY n)[1:5], '; ') AS five FROM flagged WHERE same GROUP BY file_id
)
SELECT file_id, CAST(n AS BIGINT) AS ordinal, label || ': empty translation for ''' || src || '''' AS issue FROM flagged WHERE empty
UNION ALL SELECT file_id, CAST(n AS BIGINT), label || ': unexpected characters ' || array_to_string(bad, ', ') FROM flagged WHERE NOT empty AND len(bad) > 0
UNION ALL SELECT file_id, CAST(n AS BIGINT), label || ': duplicated translation ''' || dst || '''' FROM flagged WHERE kind = 'Dialogue' AND again
UNION ALL SELECT file_id, NULL, n_untranslated || '/' || translatable || ' translatable lines identical to source (' || printf('%.1f', round_even(u * 100, 1)) || '% > 2.0%): ' || five FROM judged JOIN sampled USING (file_id) WHERE u > 0.02
UNION ALL SELECT file_id, NULL, 'Latin-script ratio in output is ' || printf('%.1f', round_even(la * 100, 1)) || '% (> 25%)' FROM judged WHERE la > 0.25""",
    "line_classify": _LINES + " SELECT record_id, status, array_to_string(reasons, ',') AS reasons FROM judged",
    "document_line_classify": "WITH pieces AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), " + _classified("pieces", "doc_id", "line") + " SELECT doc_id, status, count(*) AS n_lines, CAST(sum(len(reasons)) AS BIGINT) AS n_reasons FROM judged GROUP BY doc_id, status",
    "status_counts": _LINES + " SELECT status, count(*) AS n FROM judged GROUP BY status",
    "dedupe_exact_near": _DEDUPED + " SELECT record_id, status, array_to_string(reasons, ',') AS reasons FROM final",
    "reason_histogram": _DEDUPED + ", each AS (SELECT record_id, unnest(reasons) AS reason FROM final) SELECT reason, count(*) AS n, min(record_id) AS first_record FROM each GROUP BY reason",
    "context_lines": """SELECT record_id, coalesce(lag(text) OVER w, '') AS context_before, coalesce(lead(text) OVER w, '') AS context_after
FROM line_records WINDOW w AS (PARTITION BY movie_id ORDER BY start NULLS FIRST, event_index NULLS FIRST, record_id)""",
    "text_measures": f"""SELECT record_id, {_count('text', LETTER)} AS letters, {_count('text', LATIN)} AS latin, {_count('text', CYRILLIC)} AS cyrillic,
round(coalesce({_count('text', LATIN)}::DOUBLE / nullif({_count('text', LETTER)}, 0), 0), 9) AS latin_ratio, round(coalesce({_count('text', CYRILLIC)}::DOUBLE / nullif({_count('text', LETTER)}, 0), 0), 9) AS cyrillic_ratio,
{_count('text', WORD)} AS words, {_match('text', _CONTROL)} AS control, {_caption(_strip('text'))} AS caption, {_KEY.replace('raw', 'text')} AS key, {_one_line('text')} AS one_line FROM line_records""",
    "bad_characters": f"""WITH found AS (SELECT event_id, {_bad('text')} AS b FROM file_events) SELECT event_id, array_to_string(b, ',') AS bad FROM found WHERE len(b) > 0""",
    "name_or_symbol": f"""WITH w AS (SELECT record_id, {_strip('text')} AS t FROM line_records), x AS (SELECT *, regexp_extract_all(t, {_q(LETTER + "+(?:['" + chr(92) + "x{2019}-]" + LETTER + "+)*")}) AS ws FROM w)
SELECT record_id, NOT {_match('t', LETTER)} OR len(ws) = 0 OR (len(ws) <= 2 AND len(list_filter(ws, lambda y: NOT regexp_matches(y, '^\\p{{Lu}}'))) = 0) AS keeps FROM x""".replace("\\\\p", "\\p"),
    "word_stats_by_source": f"SELECT source, lang, count(*) AS n_docs, CAST(sum(coalesce({_count('text', WORD)}, 0)) AS BIGINT) AS words, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY source, lang",
    "event_drop_reasons": _EVENTS + f", judged AS (SELECT *, {_REASON} AS drop_reason FROM told) SELECT event_id, drop_reason, CASE WHEN drop_reason IS NULL THEN one END AS plain, coalesce(regexp_matches(text, '\\{{[^}}]*\\}}'), false) AS has_tags FROM judged",
    "drop_reason_counts": _EVENTS + f", judged AS (SELECT *, coalesce({_REASON}, 'extracted') AS drop_reason FROM told WHERE kind = 'Dialogue') SELECT file_id, drop_reason, count(*) AS n FROM judged GROUP BY GROUPING SETS ((file_id, drop_reason), (drop_reason))",
    "timestamps": f"""WITH s AS (SELECT event_id, {_seconds('"start"')} AS start_s, {_seconds('"end"')} AS end_s FROM file_events) SELECT event_id, start_s, end_s, round(end_s - start_s, 6) AS duration, {_stamp('start_s')} AS stamp FROM s""",
    "tag_summary": _EVENTS
    + r""" SELECT event_id, len(regexp_extract_all(text, '\{[^}]*\}')) AS n_tags, karaoke, regexp_matches(text, """
    + _q(_DRAWN)
    + r""") AS drawing, translatable, coalesce(regexp_matches(text, '\{[^}]*\}'), false) AS has_tags, plain_text AS plain FROM told""",
    "extracted_records": _EVENTS
    + f""", once AS (SELECT *, row_number() OVER (PARTITION BY file_id, "index" ORDER BY event_id) AS r FROM told
), kept AS (SELECT *, {_seconds('"start"')} AS s, {_seconds('"end"')} AS e FROM once WHERE r = 1 AND ({_REASON}) IS NULL)
SELECT CAST(file_id AS VARCHAR) AS movie_id, one AS text, coalesce(lag(one) OVER w, '') AS context_before, coalesce(lead(one) OVER w, '') AS context_after,
CASE WHEN {_strip('name')} <> '' THEN name END AS speaker, style, round_even(s, 3) AS "start", round_even(greatest(s, e), 3) AS "end", "index" AS event_index, coalesce(regexp_matches(text, '\\{{[^}}]*\\}}'), false) AS has_tags
FROM kept WINDOW w AS (PARTITION BY file_id ORDER BY s, "index")""".replace("\\\\", "\\"),
    "restore_identity": r"""SELECT event_id, regexp_replace(regexp_replace(text, '\\n', '\\N', 'g'), '\\h', ' ', 'g') AS restored FROM file_events""",
    "stable_partition": r"""SELECT file_id, event_id, row_number() OVER (PARTITION BY file_id ORDER BY CASE WHEN kind IN ('Dialogue', 'Comment') AND regexp_matches(text, '\{[^}]*\\an8[^}]*\}') THEN 1 ELSE 0 END, event_id) - 1 AS new_pos FROM file_events""",
    "ass_render_parse": f"""WITH {_WRITTEN} SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY event_id) - 1 AS ordinal, kind, layer, "start", "end", style, name, margin_l, margin_r, margin_v, effect, text FROM e""",
    "srt_render_parse": f"""WITH src AS (
  SELECT *, {_stamp('start')} AS a, {_stamp('"end"')} AS b, list_filter(list_transform(regexp_split_to_array(translate(text, '<&', '(+'), '[\\r\\n]+'), lambda x: {_strip('x')}), lambda x: x <> '') AS l FROM line_records
  WHERE movie_id IS NOT NULL AND start IS NOT NULL AND "end" IS NOT NULL AND start < 360000 AND "end" < 360000
), told AS (
  SELECT *, array_to_string(l, '\\N') AS t, CASE WHEN record_id % 5 = 0 THEN 1 WHEN record_id % 7 = 0 THEN 2 ELSE 0 END AS way FROM src
), once AS (
  SELECT *, row_number() OVER (PARTITION BY movie_id, a, b, t, way ORDER BY record_id) AS again FROM told
) SELECT movie_id, row_number() OVER (PARTITION BY movie_id ORDER BY record_id) - 1 AS ordinal, a AS "start", CASE WHEN "end" < start THEN a ELSE b END AS "end",
CASE way WHEN 1 THEN '{{\\i1}}' || t || '{{\\i0}}' WHEN 2 THEN '"' || t || '"' ELSE t END AS text FROM once WHERE again = 1""".replace("\\\\", "\\"),
    "markup_conversion": r"""SELECT record_id, '{\i1}' || translate(text, '<&', '(+') || '{\i0}\Nx <b>' AS converted FROM line_records""",
    "encoding_detection": r"""WITH t AS (SELECT doc_id, doc_id % 6 AS k, coalesce(text, '') AS text FROM documents
), w AS (SELECT doc_id, k, text AS given, CASE k WHEN 4 THEN 'Ж ' || regexp_replace(text, '[^\x{00}-\x{7f}А-яЁё]', '?', 'g') WHEN 5 THEN 'é ' || regexp_replace(text, '[^\x{00}-\x{7f}\x{a0}-\x{ff}]', '?', 'g') || chr(152) ELSE text END AS text FROM t)
SELECT doc_id, ['utf-8', 'utf-8', 'utf-16-le', 'utf-16-be', 'cp1251', 'latin-1'][k + 1] AS codec, k BETWEEN 1 AND 3 AS bom, ['utf-8', 'utf-8-sig', 'utf-16-le', 'utf-16-be', 'cp1251', 'latin-1'][k + 1] AS encoding, text,
CASE k WHEN 0 THEN sha1(encode(text)) WHEN 1 THEN sha1('\xEF\xBB\xBF'::BLOB || encode(text)) END AS sha1, CASE WHEN contains(text, chr(13) || chr(10)) THEN 'crlf' ELSE 'lf' END AS newline FROM w""",
    "collected_top_lines": f"""WITH {_WRITTEN}, marked AS (
  SELECT file_id, event_id, style, {_TOP} AS top, kind || ': ' || concat_ws(',', layer, "start", "end", style, name, margin_l, margin_r, margin_v, effect, text) AS line FROM e
), styles AS (SELECT file_id, string_agg('{_STYLE}', chr(10) ORDER BY s) AS styles FROM (SELECT DISTINCT file_id, style AS s FROM marked) GROUP BY file_id
), bodies AS (
  SELECT file_id, count(*) FILTER (top) AS n_top, coalesce(min(event_id) FILTER (top) < max(event_id) FILTER (NOT top), false) AS changed, string_agg(line, chr(10) ORDER BY top, event_id) AS body FROM marked GROUP BY file_id
)
SELECT file_id, CAST(n_top AS INTEGER) AS n_top, changed, md5(array_to_string({_HEAD}, chr(10)) || chr(10) || styles || chr(10) || chr(10) || '[Events]' || chr(10) || 'Format: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text' || chr(10) || body || chr(10)) AS new_md5 FROM bodies JOIN styles USING (file_id)""",
    "filename_parts": f"SELECT file_id, array_to_string({_TOKENS}, ' ') AS tokens, {_BY_NAME} AS by_name, {_BY_FOLDER} AS by_folder, {_BASE} AS key, {_GROUP} AS folder, CASE WHEN {_SAFE} = '' THEN 'root' ELSE {_SAFE} END AS id FROM subtitle_files",
    "script_language": _SCRIPT + " SELECT file_id, CAST(letters AS BIGINT) AS letters, CAST(cyrillic AS BIGINT) AS cyrillic, CAST(latin AS BIGINT) AS latin, detected FROM script",
    "file_dispositions": _SCRIPT
    + f""", named AS (
  SELECT f.file_id, f.path, f.sha1, s.detected, {_BY_NAME} AS by_name, {_BY_FOLDER} AS by_folder FROM subtitle_files f LEFT JOIN script s ON s.file_id = f.file_id
), spoken AS (
  SELECT *, coalesce(by_name, by_folder) AS prior, detected IS NOT NULL AND detected IS DISTINCT FROM coalesce(by_name, by_folder) AS outvoted FROM named
), lang AS (
  SELECT *, CASE WHEN outvoted THEN detected ELSE prior END AS language, CASE WHEN outvoted THEN 'content' WHEN by_name IS NOT NULL THEN 'filename' WHEN by_folder IS NOT NULL THEN 'folder' ELSE 'unknown' END AS language_source FROM spoken
), firsts AS (SELECT sha1, min_by(path, lower(path) || chr(1) || path) AS p FROM lang WHERE language = 'en' GROUP BY sha1)
SELECT file_id, language, language_source, CASE WHEN language IS DISTINCT FROM 'en' THEN 'skipped' WHEN p <> path THEN 'duplicate' ELSE 'kept' END AS disposition,
CASE WHEN language IS NULL THEN 'language_unknown' WHEN language <> 'en' THEN 'not_english' END AS reason, CASE WHEN language = 'en' AND p <> path THEN p END AS duplicate_of FROM lang LEFT JOIN firsts USING (sha1)""",
    "content_copies": "WITH f AS (SELECT sha1, min_by(path, lower(path) || chr(1) || path) AS p FROM subtitle_files GROUP BY sha1) SELECT file_id, p AS duplicate_of FROM subtitle_files JOIN f USING (sha1) WHERE p <> path",
    "file_statistics": _STATS + f" SELECT *, {_AVG.format('chars')} AS avg_chars, {_AVG.format('words')} AS avg_words FROM stats",
    "corpus_statistics": _STATS
    + f""", totals AS (SELECT lower(regexp_extract(path, '(\\.[^./]*)$', 1)) AS extension, count(*) AS files, CAST(coalesce(sum(dialogue_count), 0) AS BIGINT) AS dialogue_count, CAST(coalesce(sum(translatable_count), 0) AS BIGINT) AS translatable_count, CAST(coalesce(sum(words), 0) AS BIGINT) AS words, CAST(coalesce(sum(chars), 0) AS BIGINT) AS chars
FROM subtitle_files LEFT JOIN stats USING (file_id) GROUP BY 1) SELECT *, {_AVG.format('chars')} AS avg_chars, {_AVG.format('words')} AS avg_words FROM totals""".replace("\\\\", "\\"),
    "json_records": r"""SELECT record_id, payload ->> '$.movie_id' AS movie_id, payload ->> '$.text' AS text, payload ->> '$.context_before' AS context_before, payload ->> '$.context_after' AS context_after, payload ->> '$.speaker' AS speaker, payload ->> '$.style' AS style,
CAST(payload ->> '$.start' AS DOUBLE) AS "start", CAST(payload ->> '$.end' AS DOUBLE) AS "end", CAST(payload ->> '$.event_index' AS INTEGER) AS event_index, CAST(payload ->> '$.has_tags' AS BOOLEAN) AS has_tags FROM (SELECT * FROM raw_records WHERE json_valid(payload))""",
    "output_records": """SELECT record_id, coalesce(text, '') AS text, coalesce(context_before, '') AS context_before, coalesce(context_after, '') AS context_after, speaker, movie_id, "start", "end" FROM split_records""",
    "episode_lines": "SELECT coalesce(movie_id, 'None') AS movie_id, count(*) AS lines, min(record_id) AS first_record FROM line_records GROUP BY 1",
    "split_summary": """WITH m AS (SELECT split, coalesce(movie_id, 'None') AS m, count(*) AS n FROM split_records GROUP BY 1, 2), t AS (SELECT sum(n) AS t FROM m)
SELECT split, CAST(sum(n) AS BIGINT) AS lines, count(*) AS movies, array_to_string(list_sort(list(m)), ',') AS movie_list, round_even(sum(n)::DOUBLE / any_value(t), 4) AS line_share FROM m, t GROUP BY split""",
    "structure_validation": _PAIRS
    + r""", b AS (SELECT file_id, n, CASE WHEN n % 11 = 0 THEN 'Changed' ELSE style END AS style, CASE WHEN n % 7 = 0 THEN regexp_replace(text, '\{[^}]*\}', '', 'g') ELSE text END AS text FROM a WHERE NOT (n % 50 = 0 AND file_id % 2 = 0)
), c AS (SELECT a.file_id, (SELECT count(*) FROM a x WHERE x.file_id = a.file_id) AS na, (SELECT count(*) FROM b y WHERE y.file_id = a.file_id) AS nb FROM a GROUP BY a.file_id)
SELECT file_id, 'count' AS kind, 1 AS n_events FROM c WHERE na <> nb
UNION ALL SELECT a.file_id, 'style', count(*) FROM a JOIN b USING (file_id, n) WHERE a.style <> b.style GROUP BY a.file_id
UNION ALL SELECT a.file_id, 'tags', count(*) FROM a JOIN b USING (file_id, n) WHERE len(regexp_extract_all(a.text, '\{[^}]*\}')) > len(regexp_extract_all(b.text, '\{[^}]*\}')) GROUP BY a.file_id
UNION ALL SELECT a.file_id, 'other', count(*) FROM a JOIN b USING (file_id, n) WHERE a.text <> b.text AND regexp_matches(a.text, """
    + _q(_DRAWN)
    + ") GROUP BY a.file_id",
    "translation_validation": _TRANSLATED + " SELECT file_id, translatable, n_empty, n_bad, n_untranslated, n_duplicated, letters, latin, u > 0.02 AS too_many_untranslated, la > 0.25 AS too_much_latin FROM judged",
    "styles_render_parse": "SELECT DISTINCT file_id, style AS name, 'Arial' AS font, CAST(23 AS BIGINT) AS n_fields FROM file_events",
    "section_validation": """WITH f AS (SELECT DISTINCT file_id FROM file_events)
SELECT file_id, '[script info] lines changed' AS issue FROM f WHERE file_id % 3 = 0
UNION ALL SELECT file_id, 'section list differs: [Script Info, V4+ Styles, Events] != [Script Info, V4+ Styles, Events, Fonts]' FROM f WHERE file_id % 5 = 0""",
    "episode_ids": f"""WITH w AS (SELECT path, CASE WHEN {_SAFE} = '' THEN 'root' ELSE {_SAFE} END AS wanted_id FROM subtitle_files), n AS (SELECT *, row_number() OVER (PARTITION BY wanted_id ORDER BY lower(path), path) AS r FROM w)
SELECT path, wanted_id, CASE WHEN r = 1 THEN wanted_id ELSE wanted_id || '_' || r END AS id FROM n""",
}
