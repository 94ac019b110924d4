"""The queries' results in DuckDB's SQL, written apart from the Spark plans."""

from __future__ import annotations

from . import fixtures as X

_WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def norm(c: str) -> str:
    return f"trim(regexp_replace(replace(replace(coalesce({c}, ''), chr(8207), ' '), chr(8206), ' '), '{_WS}+', ' ', 'g'), ' ')"


def digits(c: str) -> str:
    return f"translate({c}, '٠١٢٣٤٥٦٧٨٩', '0123456789')"


def arabic(c: str) -> str:
    return f"regexp_matches({c}, '[؀-ۿ]')"


def latin(c: str) -> str:
    return f"regexp_matches({c}, '[A-Za-z]')"


def fold_case(c: str) -> str:
    return f"replace(lower({c}), 'ß', 'ss')"


#: Number words after folding the alef, written out apart from the Spark plans.
_NUMBER_WORDS = {
    1: ["الاول", "الاولى"],
    2: ["الثاني", "الثانية"],
    3: ["الثالث", "الثالثة"],
    4: ["الرابع", "الرابعة"],
    5: ["الخامس", "الخامسة"],
    6: ["السادس", "السادسة"],
    7: ["السابع", "السابعة"],
    8: ["الثامن", "الثامنة"],
    9: ["التاسع", "التاسعة"],
    10: ["العاشر", "العاشرة"],
    11: ["الحادي عشر", "الحادية عشرة"],
    12: ["الثاني عشر", "الثانية عشرة"],
    13: ["الثالث عشر", "الثالثة عشرة"],
    14: ["الرابع عشر", "الرابعة عشرة"],
    15: ["الخامس عشر", "الخامسة عشرة"],
    16: ["السادس عشر", "السادسة عشرة"],
    17: ["السابع عشر", "السابعة عشرة"],
    18: ["الثامن عشر", "الثامنة عشرة"],
    19: ["التاسع عشر", "التاسعة عشرة"],
    20: ["العشرون", "العشرين"],
    30: ["الثلاثون", "الثلاثين", "الثلائون", "الثلائين"],
    40: ["الاربعون", "الاربعين"],
    50: ["الخمسون", "الخمسين"],
    60: ["الستون", "الستين"],
}
_MAP = "MAP {" + ", ".join(f"'{w}': {n}" for n, words in _NUMBER_WORDS.items() for w in words) + "}"


def number(c: str) -> str:
    """The number of a phrase that is normalised."""
    text = f"translate({c}, 'إأآ', 'ااا')"
    parts = f"list_filter(list_transform(string_split({text}, ' و'), lambda q: trim(q)), lambda q: q <> '')"
    return f"coalesce({_MAP}[{text}], CASE WHEN len({parts}) = 2 THEN {_MAP}[{parts}[1]] + {_MAP}[{parts}[2]] END)"


def leading(c: str) -> tuple[str, str]:
    """(number, rest) of the longest phrase in the first four words of a normalised text."""
    tokens = f"string_split({c}, ' ')"
    tries = [number(f"array_to_string({tokens}[1:{k}], ' ')") for k in (4, 3, 2, 1)]
    found = "coalesce(" + ", ".join(tries) + ")"
    rest = "CASE " + " ".join(f"WHEN {t} IS NOT NULL THEN coalesce(array_to_string({tokens}[{k + 1}:], ' '), '')" for t, k in zip(tries, (4, 3, 2, 1))) + " END"
    return f"CAST({found} AS VARCHAR)", rest


def _one(pattern: str, group: int, c: str = "line") -> str:
    return f"regexp_extract({c}, '{pattern}', {group})"


#: The grammar of headings, written out apart from the Spark plans.
_TAIL = r"\s*[)\]]?\s*"
_PART = rf"(?i)^(?:Part\b|الجزء|الباب)\s*[(\[]?\s*([A-Za-z0-9٠-٩]+){_TAIL}[:.\-–—]?\s*(.*)$"
_CHAPTER = rf"(?i)^(?:Chapter\b|الفصل)\s*[(\[]?\s*([A-Za-z0-9٠-٩]+){_TAIL}[:.\-–—]?\s*(.*)$"
_BODY = rf"(?i)^(?:Article\b|المادة|مادة)\s*[(\[]?\s*([0-9٠-٩]+){_TAIL}[:\-–—]\s*(.*)$"
_ALONE = rf"(?i)^(?:Article\b|المادة|مادة)\s*[(\[]?\s*([0-9٠-٩]+){_TAIL}:?$"
_FINAL = r"(?i)^(?:(?:final|general|concluding)\s+provisions?|الأحكام\s+الختامية|احكام\s+ختامية)$"


def _source(table: str) -> str:
    """src(doc_id, pos, line): cleaned source lines."""
    line = rf"regexp_replace({norm('line')}, '^#{{1,6}}\s*', '')"
    return f"src0 AS (SELECT doc_id, pos, {line} AS line FROM {table}), src AS (SELECT * FROM src0 WHERE line <> '' AND NOT regexp_matches(line, '(?i)^<!--\\s*image\\s*-->$'))"


def _spelled(nouns: str, name: str) -> str:
    return f"regexp_extract(line, '^(?:{nouns})\\s+(.+)$', 1) AS {name}"


def events(table: str = "legal") -> str:
    """ev(doc_id, pos, line, kind, number, title, body) and st with the running state."""
    n = {k: leading(f"sp_{k}") for k in "pca"}
    spelled = ", ".join(f"CASE WHEN sp_{k} <> '' THEN {n[k][0]} END AS num_{k}, CASE WHEN sp_{k} <> '' THEN {n[k][1]} END AS rest_{k}" for k in "pca")
    title = lambda word, k: f"CASE WHEN {k}2 = '' THEN concat('{word} ', {digits(k + '1')}) ELSE concat('{word} ', {digits(k + '1')}, ': ', {k}2) END"
    w = "OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""{_source(table)},
ev0 AS (SELECT *, {_one(_PART, 1)} AS p1, trim({_one(_PART, 2)}) AS p2, {_one(_CHAPTER, 1)} AS c1, trim({_one(_CHAPTER, 2)}) AS c2,
  {_one(_BODY, 1)} AS b1, trim({_one(_BODY, 2)}) AS b2, {_one(_ALONE, 1)} AS a1,
  {_spelled('الباب|الجزء', 'sp_p')}, {_spelled('الفصل', 'sp_c')}, {_spelled('المادة|مادة', 'sp_a')} FROM src),
ev1 AS (SELECT *, {spelled} FROM ev0),
ev AS (SELECT doc_id, pos, line,
  CASE WHEN regexp_matches(line, '{_FINAL}') THEN 'F' WHEN p1 <> '' OR num_p IS NOT NULL THEN 'P' WHEN c1 <> '' OR num_c IS NOT NULL THEN 'C'
       WHEN b1 <> '' OR a1 <> '' OR num_a IS NOT NULL THEN 'A' END AS kind, * EXCLUDE (doc_id, pos, line) FROM ev1),
st AS (SELECT doc_id, pos, line, kind,
  CASE kind WHEN 'P' THEN CASE WHEN p1 <> '' THEN {digits('p1')} ELSE num_p END WHEN 'C' THEN CASE WHEN c1 <> '' THEN {digits('c1')} ELSE num_c END
    WHEN 'A' THEN CASE WHEN b1 <> '' THEN {digits('b1')} WHEN a1 <> '' THEN {digits('a1')} ELSE num_a END END AS number,
  CASE kind WHEN 'F' THEN line WHEN 'P' THEN CASE WHEN p1 <> '' THEN {title('Part', 'p')} ELSE line END WHEN 'C' THEN CASE WHEN c1 <> '' THEN {title('Chapter', 'c')} ELSE line END END AS title,
  CASE WHEN kind = 'A' THEN CASE WHEN b1 <> '' THEN b2 WHEN a1 <> '' THEN '' ELSE rest_a END END AS body,
  count(*) FILTER (kind = 'P') {w} AS part_seq, count(*) FILTER (kind IN ('C', 'F')) {w} AS chapter_seq, count(*) FILTER (kind = 'A') {w} AS order_index,
  last_value(kind IGNORE NULLS) {w} AS last_kind,
  coalesce(last_value(CASE WHEN kind IN ('F', 'P') THEN kind END IGNORE NULLS) {w} = 'P', false) AS in_part,
  coalesce(last_value(CASE WHEN kind IN ('F', 'P', 'C') THEN kind END IGNORE NULLS) {w} <> 'P', false) AS in_chapter,
  count(*) {w} AS n FROM ev)"""


_AR, _EN = "[؀-ۿ]", "[A-Za-z]"


def norm_lines(c: str) -> str:
    return f"array_to_string(list_filter(list_transform(string_split(replace(coalesce({c}, ''), chr(13), chr(10)), chr(10)), lambda z: {norm('z')}), lambda z: z <> ''), chr(10))"


def scripts(table: str, column: str, name: str) -> str:
    """CTEs that end with ``name``: table's columns, t_en and t_ar. Each step is a table of its own, so nothing is written out twice."""
    has = lambda script: f"list_transform(tok, lambda x: regexp_matches(x, '{script}'))"
    own = lambda mine, other, first: f"nullif(array_to_string(list_filter(tok, lambda x, i: {mine}[i] OR (NOT {other}[i] AND {first} > 0 AND i > {first})), ' '), '')"
    return f"""{name}0 AS MATERIALIZED (SELECT *, {norm_lines(column)} AS t FROM {table}),
{name}1 AS MATERIALIZED (SELECT *, string_split({norm('t')}, ' ') AS tok, {arabic('t')} AS t_a, {latin('t')} AS t_e FROM {name}0),
{name}2 AS MATERIALIZED (SELECT *, CASE WHEN t_a AND t_e THEN {has(_AR)} END AS ars, CASE WHEN t_a AND t_e THEN {has(_EN)} END AS ens FROM {name}1),
{name}3 AS MATERIALIZED (SELECT *, coalesce(list_position(ars, true), 0) AS ar1, coalesce(list_position(ens, true), 0) AS en1 FROM {name}2),
{name} AS (SELECT * EXCLUDE (t, tok, t_a, t_e, ars, ens, ar1, en1),
  CASE WHEN t = '' THEN NULL WHEN t_a AND t_e THEN {own('ens', 'ars', 'en1')} WHEN t_a THEN NULL ELSE t END AS t_en,
  CASE WHEN t = '' THEN NULL WHEN t_a AND t_e THEN {own('ars', 'ens', 'ar1')} WHEN t_a THEN t END AS t_ar FROM {name}3)"""


def noise(c: str) -> str:
    solid = f"length(replace({c}, ' ', ''))"
    return f"(length({c}) <= 2 OR NOT ({latin(c)} OR {arabic(c)}) OR length(regexp_replace({c}, '[^\\p{{L}}]', '', 'g')) / nullif({solid}, 0) < 0.35)"


def score(structure: str) -> str:
    low, words = fold_case("line"), "len(string_split(line, ' '))"
    any_of = lambda c, ws: "(" + " OR ".join(f"contains({c}, '{w}')" for w in ws) + ")"
    cased = r"NOT (regexp_matches(line, '^\p{Ll}') OR regexp_matches(line, '[^\p{Ll}\p{Lu}\p{Lt}]\p{Ll}') OR regexp_matches(line, '[\p{Ll}\p{Lu}\p{Lt}][\p{Lu}\p{Lt}]'))"
    points = [
        ("length(line) BETWEEN 8 AND 90", 8), (f"{words} <= 10", 3), ("NOT contains(line, ':')", 2), (f"ends_with({low}, 'law') OR contains({low}, ' law')", 20),
        (any_of(low, ["chambers", "commerce", "regulation", "rules"]), 6), (any_of("line", ["نظام", "قانون", "لائحة", "الأحكام"]), 20), (cased, 2), ("ends_with(line, ':')", -5), (f"{words} > 18", -8),
    ]
    return f"CASE WHEN {noise('line')} THEN -100 WHEN {structure} THEN -50 ELSE " + " + ".join(f"CASE WHEN {c} THEN {n} ELSE 0 END" for c, n in points) + " END"


_B = f"WITH {X.LEGAL}, {events()}"
_ARTICLES = """art AS (SELECT doc_id, order_index, max(CASE WHEN kind = 'A' THEN number END) AS article_number,
  max(CASE WHEN in_part THEN part_seq END) AS part_seq, max(CASE WHEN in_chapter THEN chapter_seq END) AS chapter_seq,
  coalesce(string_agg(CASE WHEN kind = 'A' THEN nullif(body, '') ELSE line END, chr(10) ORDER BY pos), '') AS text
  FROM st WHERE last_kind = 'A' GROUP BY doc_id, order_index)"""


_HEADS = scripts("(SELECT * FROM st WHERE kind IN ('P', 'C', 'F'))", "title", "heads")


def _titles(table: str) -> str:
    return f"""cand AS (SELECT doc_id, pos, line, last_kind IS NULL AS pre, {score('kind IS NOT NULL')} AS score FROM st WHERE last_kind IS NULL OR n <= 80),
best AS (SELECT doc_id, line FROM cand WHERE score >= 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pre DESC, pos) = 1),
flags AS (SELECT doc_id, bool_or({arabic('line')}) AS ar, bool_or({latin('line')}) AS en FROM {table} GROUP BY doc_id),
fb AS (SELECT f.doc_id, f.ar AND NOT f.en AS only_ar, b.line FROM flags f LEFT JOIN best b ON f.doc_id = b.doc_id), {scripts('fb', 'line', 'tt')},
titled AS (SELECT doc_id, CASE WHEN t_en IS NULL AND t_ar IS NULL AND NOT only_ar THEN 'Untitled Legal Document' ELSE t_en END AS title_en,
  CASE WHEN t_en IS NULL AND t_ar IS NULL AND only_ar THEN 'مستند قانوني بدون عنوان' ELSE t_ar END AS title_ar FROM tt)"""


_SCORED = f"CASE WHEN coalesce(text, '') <> '' THEN length(text) + {' + '.join(f'CASE WHEN contains({fold_case('text')}, {m!r}) THEN 200 ELSE 0 END' for m in ('article', 'chapter', 'part', 'المادة', 'الفصل', 'الباب', 'الجزء'))} END"
_CHOSEN = f"""sc AS (SELECT *, {_SCORED} AS score FROM candidates), chosen AS (SELECT doc_id, CASE WHEN score IS NULL THEN '' ELSE source END AS source, CASE WHEN score IS NULL THEN 'none' ELSE text END AS text
 FROM sc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC NULLS LAST, priority) = 1)"""

_DEDUP = f"""dd AS (SELECT * FROM recognised_lines QUALIFY row_number() OVER (PARTITION BY doc_id, page_number, round_even(y / 12, 0), {fold_case(norm('text'))} ORDER BY y, x, engine_seq, idx) = 1)"""

_KEPT = f"kw AS (SELECT * REPLACE (trim(text) AS text) FROM words WHERE trim(text) <> '' AND confidence >= 0)"
_LINE_AGG = """ln AS (SELECT doc_id, page_number, block_num, par_num, line_num, string_agg(text, ' ' ORDER BY idx) AS text, round_even(avg(confidence), 1) AS average_confidence,
 min(x) AS x, min(y) AS y, max(x + width) - min(x) AS width, max(y + height) - min(y) AS height, count(*) AS n_words FROM kw GROUP BY ALL)"""
_PAR_AGG = "pa AS (SELECT doc_id, page_number, block_num, par_num, string_agg(text, ' ' ORDER BY line_num) AS text, count(*) AS n_lines FROM ln GROUP BY ALL)"
_BLOCK_AGG = "bl AS (SELECT doc_id, page_number, block_num, string_agg(text, chr(10) ORDER BY par_num) AS text, count(*) AS n_paragraphs FROM pa GROUP BY ALL)"


def cleaned(c: str) -> str:
    plain = rf"regexp_replace({c}, '[\x00-\x08\x0b-\x1f\x7f-\x9f]|\p{{Cf}}|\p{{Co}}', '', 'g')"
    return rf"regexp_replace(regexp_replace(regexp_replace({plain}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^{_WS}+|{_WS}+$', '', 'g')"


_PAGES = f"""pt AS (SELECT doc_id, page_number, string_agg(text, chr(10) ORDER BY block_num) AS text FROM bl GROUP BY ALL),
pc AS (SELECT doc_id, page_number, {cleaned('text')} AS t FROM pt),
ws AS (SELECT doc_id, page_number, count(*) AS word_count, round_even(avg(confidence), 1) AS page_confidence FROM kw GROUP BY ALL),
ps AS (SELECT pc.doc_id, pc.page_number, CAST(length(t) AS BIGINT) AS character_count, {arabic('t')} AS contains_arabic, {latin('t')} AS contains_english, coalesce(word_count, 0) AS word_count, coalesce(page_confidence, 0.0) AS page_confidence
 FROM pc LEFT JOIN ws ON pc.doc_id = ws.doc_id AND pc.page_number = ws.page_number)"""
_WORDS = f"WITH {X.WORDS}, {_KEPT}"

_W = "OVER (PARTITION BY doc_id ORDER BY page_number, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def page_events(table: str) -> str:
    c, s, a = (_one(p, 1, "l") for p in (r"(?i)(?:chapter|الفصل)\s+(\p{Nd}+)", r"(?i)(?:section|القسم)\s+(\p{Nd}+)", r"(?i)(?:article|المادة)\s*[(\-–—]?\s*(\p{Nd}+)"))
    return f"""pe0 AS (SELECT doc_id, page_number, pos, trim(line) AS l FROM {table} WHERE trim(line) <> ''),
pe AS (SELECT *, CASE WHEN {c} <> '' THEN 'C' WHEN {s} <> '' THEN 'S' WHEN {a} <> '' THEN 'A' END AS kind, CASE WHEN {c} <> '' THEN {c} WHEN {s} <> '' THEN {s} WHEN {a} <> '' THEN {a} END AS number FROM pe0),
ch AS (SELECT *, count(*) FILTER (kind = 'C') {_W} AS chapter_seq, count(*) FILTER (kind = 'A') {_W} AS article_seq, last_value(kind IGNORE NULLS) {_W} AS last_kind FROM pe),
pst AS (SELECT *, count(*) FILTER (kind = 'S') OVER (PARTITION BY doc_id, chapter_seq ORDER BY page_number, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section_seq FROM ch)"""


_A = f"WITH {X.LEGAL_PAGES}, {page_events('legal_pages')}"
_TURNS = f"""WITH pg AS (SELECT conv_id AS doc_id, turn AS page_number, {cleaned("coalesce(text, '')")} AS t FROM conversations),
pl AS (SELECT doc_id, page_number, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS pos FROM pg), {page_events('pl')}"""
#: Nested chapters as JSON text, from pg (pages) and pst (lines with their state).
_STRUCTURE = """ac AS (SELECT doc_id, article_seq, list(l ORDER BY page_number, pos) AS clauses FROM pst WHERE kind IS NULL AND last_kind = 'A' GROUP BY ALL),
aa AS (SELECT p.doc_id, p.chapter_seq, p.section_seq, list(struct_pack(article_number := number, title := l, clauses := coalesce(clauses, [])) ORDER BY p.article_seq) AS articles
 FROM pst p LEFT JOIN ac ON p.doc_id = ac.doc_id AND p.article_seq = ac.article_seq WHERE kind = 'A' GROUP BY ALL),
sx AS (SELECT doc_id, chapter_seq, section_seq, number, l AS title FROM pst WHERE kind = 'S' UNION ALL SELECT DISTINCT doc_id, chapter_seq, 0, '0', 'General' FROM pst WHERE kind = 'A' AND section_seq = 0),
sl AS (SELECT s.doc_id, s.chapter_seq, list(struct_pack(section_number := number, title := title, articles := coalesce(articles, [])) ORDER BY s.section_seq) AS sections
 FROM sx s LEFT JOIN aa ON s.doc_id = aa.doc_id AND s.chapter_seq = aa.chapter_seq AND s.section_seq = aa.section_seq GROUP BY ALL),
hx AS (SELECT doc_id, chapter_seq, number, l AS title FROM pst WHERE kind = 'C' UNION ALL SELECT DISTINCT doc_id, 0, '0', 'Virtual Chapter' FROM pst WHERE chapter_seq = 0 AND kind IN ('S', 'A')),
hl AS (SELECT h.doc_id, list(struct_pack(chapter_number := number, title := title, sections := coalesce(sections, [])) ORDER BY h.chapter_seq) AS structure
 FROM hx h LEFT JOIN sl ON h.doc_id = sl.doc_id AND h.chapter_seq = sl.chapter_seq GROUP BY h.doc_id),
fl AS (SELECT doc_id, coalesce(list(t ORDER BY page_number) FILTER (t <> ''), []) AS clauses FROM pg GROUP BY doc_id)
SELECT f.doc_id, CAST(coalesce(to_json(structure), to_json([struct_pack(chapter_number := '0', title := 'Virtual Chapter', sections := [struct_pack(section_number := '0', title := 'General',
 articles := [struct_pack(article_number := '0', title := 'Full Text', clauses := clauses)])])])) AS VARCHAR) AS json FROM fl f LEFT JOIN hl ON f.doc_id = hl.doc_id"""
_LIST = r"(?i:)^(?:\p{Nd}+[.)]|[A-Za-z][.)]|[اأإآبتثجحخدذرزسشصضطظعغفقكلمنهويى][.)]?)[\s\p{Z}]+".replace("(?i:)", "")

ORACLES = {
    "b_articles": f"{_B}, {_ARTICLES} SELECT doc_id, order_index, article_number, part_seq, chapter_seq, text FROM art",
    "b_article_texts": f"{_B}, {_ARTICLES}, {scripts('art', 'text', 'sided')} SELECT doc_id, order_index, article_number, part_seq, chapter_seq, t_en AS text_en, t_ar AS text_ar FROM sided",
    "b_parts": f"{_B}, {_HEADS} SELECT doc_id, part_seq, number AS part_number, t_en AS title_en, t_ar AS title_ar FROM heads WHERE kind = 'P'",
    "b_chapters": f"{_B}, {_HEADS} SELECT doc_id, chapter_seq, CASE WHEN kind = 'C' AND in_part THEN part_seq END AS part_seq, number AS chapter_number, t_en AS title_en, t_ar AS title_ar FROM heads WHERE kind IN ('C', 'F')",
    "b_preamble": f"{_B} SELECT doc_id, CAST(pos AS INT) AS pos, line FROM st WHERE last_kind IS NULL",
    "b_dropped_lines": f"{_B} SELECT doc_id, CAST(pos AS INT) AS pos, line FROM st WHERE kind IS NULL AND last_kind IN ('F', 'P', 'C')",
    "b_number_words": f"WITH {X.NUMBER_PHRASES}, np AS (SELECT item_id, k, {norm('phrase')} AS p FROM phrases) SELECT item_id, CAST(k AS INT) AS k, {leading('p')[0]} AS number, {leading('p')[1]} AS rest FROM np",
    "b_titles": f"{_B}, {_titles('legal')} SELECT * FROM titled",
    "b_title_scores": f"{_B} SELECT doc_id, CAST(pos AS INT) AS pos, {score('kind IS NOT NULL')} AS score FROM st",
    "b_noise": f"WITH {X.MIXED}, t AS (SELECT doc_id, pos, {norm('padded')} AS line FROM mixed) SELECT doc_id, CAST(pos AS INT) AS pos, {noise('line')} AS noise FROM t",
    "b_list_items": f"WITH {X.LINES}, t AS (SELECT doc_id, pos, {norm(X.LIST_LINE)} AS line FROM lines) SELECT doc_id, CAST(pos AS INT) AS pos, regexp_matches(line, '{_LIST}') AS list_item FROM t",
    "b_bilingual": f"WITH {X.MIXED}, {scripts('mixed', 'padded', 'sided')} SELECT doc_id, CAST(pos AS INT) AS pos, t_en AS text_en, t_ar AS text_ar FROM sided",
    "b_choose_text": f"WITH {X.CANDIDATES}, {_CHOSEN} SELECT doc_id, source, CAST(length(text) AS INT) AS n_chars FROM chosen",
    "b_fallback": f"""WITH {X.LEGAL}, {X.RECOGNISED_TEXTS}, {X.CANDIDATES}, {_CHOSEN}, cl AS (SELECT doc_id, unnest(w) AS line, generate_subscripts(w, 1) - 1 AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS w FROM chosen)),
{events('cl')}, good AS (SELECT DISTINCT doc_id FROM st WHERE kind = 'A')
SELECT c.doc_id, CASE WHEN g.doc_id IS NOT NULL THEN c.source WHEN coalesce(r.text, '') <> '' THEN 'paddleocr' ELSE '' END AS source,
 CAST(length(CASE WHEN g.doc_id IS NOT NULL THEN c.text WHEN coalesce(r.text, '') <> '' THEN r.text ELSE 'none' END) AS INT) AS n_chars
FROM chosen c LEFT JOIN good g ON c.doc_id = g.doc_id LEFT JOIN recognised r ON c.doc_id = r.doc_id""",
    "b_article_counts": f"{_B} SELECT l.doc_id, coalesce(n, 0) AS n_articles FROM (SELECT DISTINCT doc_id FROM legal) l LEFT JOIN (SELECT doc_id, count(*) AS n FROM st WHERE kind = 'A' GROUP BY doc_id) a ON l.doc_id = a.doc_id",
    "b_no_structure": f"WITH {X.LINES}, {events('lines')}, {_titles('lines')}, hn AS (SELECT doc_id, count(kind) AS n FROM st GROUP BY doc_id) SELECT t.doc_id, title_en, title_ar, coalesce(n, 0) AS n_headings FROM titled t LEFT JOIN hn ON t.doc_id = hn.doc_id",
    "b_json": f"""{_B}, {_ARTICLES}, {_HEADS}, {_titles('legal')}, {scripts('art', 'text', 'sided')},
ax AS (SELECT doc_id, order_index, part_seq, chapter_seq, struct_pack(article_number := article_number, text_en := t_en, text_ar := t_ar, order_index := order_index) AS a FROM sided),
al AS (SELECT doc_id, CASE WHEN chapter_seq IS NULL THEN part_seq END AS part_seq, chapter_seq, list(a ORDER BY order_index) AS articles FROM ax GROUP BY ALL),
cx AS (SELECT h.doc_id, h.chapter_seq, CASE WHEN kind = 'C' AND in_part THEN h.part_seq END AS part_seq, struct_pack(title_en := t_en, title_ar := t_ar, chapter_number := number, articles := coalesce(articles, [])) AS c
 FROM heads h LEFT JOIN al ON h.doc_id = al.doc_id AND h.chapter_seq = al.chapter_seq WHERE kind IN ('C', 'F')),
cl AS (SELECT doc_id, part_seq, list(c ORDER BY chapter_seq) AS chapters FROM cx GROUP BY ALL),
px AS (SELECT h.doc_id, h.part_seq, struct_pack(title_en := t_en, title_ar := t_ar, part_number := number, articles := coalesce(articles, []), chapters := coalesce(chapters, [])) AS p
 FROM heads h LEFT JOIN al ON h.doc_id = al.doc_id AND al.chapter_seq IS NULL AND h.part_seq = al.part_seq LEFT JOIN cl ON h.doc_id = cl.doc_id AND h.part_seq = cl.part_seq WHERE kind = 'P'),
pl AS (SELECT doc_id, list(p ORDER BY part_seq) AS parts FROM px GROUP BY ALL)
SELECT t.doc_id, CAST(to_json(struct_pack(title_en := title_en, title_ar := title_ar, document_type := 'law', articles := coalesce(articles, []), chapters := coalesce(chapters, []), parts := coalesce(parts, []))) AS VARCHAR) AS json
FROM titled t LEFT JOIN al ON t.doc_id = al.doc_id AND al.chapter_seq IS NULL AND al.part_seq IS NULL LEFT JOIN cl ON t.doc_id = cl.doc_id AND cl.part_seq IS NULL LEFT JOIN pl ON t.doc_id = pl.doc_id""",
    "ocr_dedup": f"WITH {X.RECOGNISED}, {_DEDUP} SELECT doc_id, engine_seq, CAST(idx AS INT) AS idx, page_number, text, x, y FROM dd",
    "ocr_lines_to_text": f"WITH {X.RECOGNISED}, {_DEDUP} SELECT doc_id, string_agg(text, chr(10) ORDER BY page_number, y, x, engine_seq, idx) AS text, count(*) AS n_lines FROM dd WHERE {norm('text')} <> '' GROUP BY doc_id",
    "a_word_filter": f"{_WORDS} SELECT doc_id, CAST(idx AS INT) AS idx, text, confidence FROM kw",
    "a_lines": f"{_WORDS}, {_LINE_AGG} SELECT * FROM ln",
    "a_paragraphs": f"{_WORDS}, {_LINE_AGG}, {_PAR_AGG} SELECT * FROM pa",
    "a_blocks": f"{_WORDS}, {_LINE_AGG}, {_PAR_AGG}, {_BLOCK_AGG} SELECT * FROM bl",
    "a_page_stats": f"{_WORDS}, {_LINE_AGG}, {_PAR_AGG}, {_BLOCK_AGG}, {_PAGES} SELECT * FROM ps",
    "a_summary": f"""{_WORDS}, {_LINE_AGG}, {_PAR_AGG}, {_BLOCK_AGG}, {_PAGES} SELECT doc_id, count(*) AS total_pages, CAST(sum(word_count) AS BIGINT) AS total_words, CAST(sum(character_count) AS BIGINT) AS total_characters,
 round_even(CAST(sum(CAST(round(page_confidence * 10) AS BIGINT)) AS BIGINT) / (10.0::DOUBLE * count(*)), 1) AS average_confidence, CASE WHEN bool_or(contains_arabic) AND bool_or(contains_english) THEN 'Arabic,English' WHEN bool_or(contains_arabic) THEN 'Arabic' WHEN bool_or(contains_english) THEN 'English' ELSE 'Unknown' END AS detected_languages FROM ps GROUP BY doc_id""",
    "a_clean_text": f"WITH {X.DIRTY} SELECT doc_id, {cleaned('text')} AS cleaned_text FROM dirty",
    "a_clean_nfkc": f"WITH {X.DIRTY}, c AS (SELECT doc_id, replace(replace({cleaned('text')}, chr(65275), 'لا'), chr(64257), 'fi') AS t FROM dirty) SELECT doc_id, t AS cleaned_text, CAST(length(t) AS INT) AS character_count, {arabic('t')} AS contains_arabic, {latin('t')} AS contains_english FROM c",
    "a_chapters": f"{_A} SELECT doc_id, chapter_seq, number AS chapter_number, l AS title FROM pst WHERE kind = 'C' UNION ALL SELECT DISTINCT doc_id, 0, '0', 'Virtual Chapter' FROM pst WHERE chapter_seq = 0 AND kind IN ('S', 'A')",
    "a_sections": f"{_A} SELECT doc_id, chapter_seq, section_seq, number AS section_number, l AS title FROM pst WHERE kind = 'S' UNION ALL SELECT DISTINCT doc_id, chapter_seq, 0, '0', 'General' FROM pst WHERE kind = 'A' AND section_seq = 0",
    "a_articles": f"{_A} SELECT doc_id, article_seq, chapter_seq, section_seq, number AS article_number, l AS title FROM pst WHERE kind = 'A'",
    "a_clauses": f"{_A} SELECT doc_id, article_seq, page_number, CAST(pos AS INT) AS pos, l AS clause FROM pst WHERE kind IS NULL AND last_kind = 'A'",
    "a_fallback": f"""{_TURNS} SELECT doc_id, page_number, t AS clause FROM pg WHERE t <> '' AND doc_id NOT IN (SELECT doc_id FROM pst WHERE kind IS NOT NULL)""",
    "a_json": f"{_TURNS}, {_STRUCTURE}",
    "a_structures": f"{_A}, pg AS (SELECT doc_id, page_number, string_agg(line, chr(10) ORDER BY pos) AS t FROM legal_pages GROUP BY ALL), {_STRUCTURE}",
    "a_lang_map": "SELECT lang, CASE WHEN lang = 'ar' THEN 'ara' WHEN lang IN ('en', 'en-US', 'en-GB') THEN 'eng' ELSE 'ara+eng' END AS engine_language, count(*) AS n FROM documents GROUP BY ALL",
    "t_source_lines": f"WITH {X.HTML_LINES}, {_source('html_lines')} SELECT doc_id, CAST(pos AS INT) AS pos, line FROM src",
    "t_digits": f"WITH {X.MIXED} SELECT doc_id, CAST(pos AS INT) AS pos, {digits('mixed')} AS text FROM mixed",
    "t_normalize": f"WITH {X.MIXED} SELECT doc_id, CAST(pos AS INT) AS pos, {norm('padded')} AS text FROM mixed",
    "meta_files": """WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS path FROM pages), q AS (SELECT page_id, path, concat(regexp_extract(path, '([^/]*)$', 1), CASE page_id % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN '.png' WHEN 2 THEN '.Tiff' ELSE '.txt' END) AS file_name FROM p)
SELECT page_id, file_name, CASE WHEN page_id % 4 = 0 THEN 'pdf' WHEN page_id % 4 = 3 THEN NULL ELSE 'image' END AS file_type, page_id % 4 <> 3 AS supported, 'PaddleOCR' AS ocr_engine, 'Docling' AS layout_engine, CASE WHEN page_id % 4 IN (1, 2) THEN 1 END AS total_pages FROM q""",
    "i_deskew_rule": """WITH a AS (SELECT user_id AS doc_id, value % 60 - 15 AS angle FROM events), m AS (SELECT doc_id, quantile_cont(angle, 0.5) AS angle FROM a WHERE abs(angle) < 45 GROUP BY doc_id)
SELECT doc_id, round(angle, 6) AS angle, abs(angle) >= 0.3 AND abs(angle) <= 10 AS applied FROM m""",
}
