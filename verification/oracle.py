"""The same queries as SQL for DuckDB, written against the definitions and not the Spark code."""

from __future__ import annotations

WS = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NWS = "[^" + WS[1:]


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(expr: str, pattern: str, replacement: str, flags: str = "g") -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(replacement)}, '{flags}')"


def strip(expr: str) -> str:
    return sub(expr, rf"\A{WS}+|{WS}+\z", "")


def collapse(expr: str) -> str:
    return sub(expr, f"{WS}+", " ")


def apply_rules(expr: str) -> str:
    for pattern, replacement in (
        (r" \?", "?"), (" !", "!"), (r" \.", "."), (" ,", ","), (" ;", ";"), (" :", ":"), (" --", ""),
        (r" \.\. \.", "..."), (" n't", "n't"), (" &", "&"), (rf"\({WS}+", "("), (rf"{WS}+\)", ")"),
        (f"'{WS}+", "'"), (f"{WS}+'", "'"), ("&;", ""), (rf"\*\*{NWS}*?(?:;{NWS}*?)+", ""),
    ):
        expr = sub(expr, pattern, replacement)
    return expr


def finish(expr: str) -> str:
    return strip(collapse(apply_rules(expr)))


def clean(table: str, key: str, column: str) -> str:
    """The cleaner for text without markup, where dropping the redaction marks is all a parser does."""
    return f"""
        WITH stripped AS (SELECT {key}, {strip(column)} AS t FROM {table}),
        unmarked AS (SELECT {key}, t, {sub('t', f'(@{WS}*)+', '')} AS m FROM stripped),
        kept AS (
            SELECT {key}, CASE WHEN position('@' IN t) = 0 THEN t WHEN m = '' THEN '<unk>'
                ELSE {strip(collapse('m'))} END AS c FROM unmarked)
        SELECT {key}, {finish('c')} AS content FROM kept"""


LINES = """
    (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS value,
        CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS pos FROM documents)"""
TAGGED = f"""
    (SELECT doc_id, pos, CASE WHEN pos % 5 = 4 THEN value
        ELSE ' ' || chr(9) || '@@' || doc_id || ' ' || value END AS value FROM {LINES})"""
MARKED = f"(SELECT doc_id, pos, line FROM (SELECT doc_id, pos, {strip('value')} AS line FROM {TAGGED}) WHERE line LIKE '@@%')"


def parsed(columns: str, source: str) -> str:
    end = "position(' ' IN substr(line, 3))"
    return f"""SELECT substr(line, 3, {end} - 1) AS id, substr(line, 3 + {end}) AS content, {columns}
        FROM {source} WHERE {end} > 0"""


PLACED = f"""
    (SELECT CAST(doc_id AS VARCHAR) AS file, doc_id AS file_order, pos AS line_num,
        doc_id * 2000000 + row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS sequence, line FROM {MARKED})"""
CONTENT = f"({parsed('file, file_order, line_num, sequence', PLACED)})"
SOURCE_LINES = """
    (SELECT '   ' || doc_id || '  ' || n_chars || '  ' || lang || '  ' || (1990 + doc_id % 30) || chr(9) ||
        CASE WHEN lang = 'es' THEN '' ELSE source || chr(9) || 'T' || doc_id || chr(9) || 'about  ' || source END
        || ' ' AS value FROM documents)"""
_FIELDS = ["id", "words", "genre", "year", "source", "title", "pubInfo"]
SOURCE_PARTS = f"""
    (SELECT {strip('value')} AS line, len(regexp_split_to_array({strip('value')}, {q(WS + '+')})) AS fields
        FROM {SOURCE_LINES})"""
_FIELD_PATTERN = r"\A" + f"{WS}+".join([f"({NWS}+)"] * 6) + rf"{WS}+((?s:.+))\z"
SOURCES = f"""
    (SELECT {', '.join(f'p.{f} AS {f}' for f in _FIELDS)} FROM
        (SELECT regexp_extract(line, {q(_FIELD_PATTERN)}, {_FIELDS}) AS p FROM {SOURCE_PARTS} WHERE fields >= 7))"""
LABEL_SOURCES = """
    (SELECT CAST(doc_id AS VARCHAR) AS id, CAST(quality AS VARCHAR) AS words, 'quality' AS genre, '2000' AS year,
        's' AS source, 't:u' AS title, 'p' AS pubInfo FROM labels
     UNION ALL SELECT CAST(doc_id AS VARCHAR), CAST(toxic AS VARCHAR), 'toxic', NULL, 's', 't', 'u:p' FROM labels)"""
SOURCE_COLUMNS = "s.words, s.genre, s.year, s.source, s.title, s.pubInfo"
TOKENISED = (
    "(SELECT doc_id, "
    + sub(sub("text", "([.,;:!?()'&*])", r" \1 "), " (the|und|le|la) ", " @ @ ")
    + " AS text FROM documents)"
)

# Tags become chr(1), so that a reference cut short by a tag stays apart from the text after it.
_HIDDEN = "|".join(rf"<{n}\b[^>]*>.*?</{n}\s*>" for n in ("script", "style", "template", "rt", "rp"))
_TAGS = rf"(?is)<!--.*?-->|{_HIDDEN}|<[!?][^>]*>|</?[a-z][^>]*>"


def references(expr: str) -> str:
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"')):
        expr = f"replace({expr}, '&{name};', '{char}')"
    return sub(f"replace({expr}, '&amp;', '&')", r"&amp([\x01<])", r"&\1")


PAGE_TEXT = f"(SELECT page_id, replace({references(sub('html', _TAGS, chr(1)))}, chr(1), '') AS text FROM pages)"


def attach(content: str, sources: str) -> str:
    return f"SELECT c.*, {SOURCE_COLUMNS} FROM {content} c JOIN {sources} s ON c.id = s.id"


PROMPT = "Given the following example text, use dialectal markers to identify the country of origin: "


def reply(year: str) -> str:
    text = (
        f"('The sample you provided ' || CASE WHEN {year} IS NULL OR {year} IN ('', 'nan') THEN '' "
        f"ELSE 'appears to be from ' || {year} END)"
    )
    return f"CASE WHEN {text} LIKE '%.' THEN {text} ELSE {text} || '.' END"


RECORDS = f"""
    (SELECT id, source, CAST(0 AS BIGINT) AS score, {q(PROMPT)} || content AS human, {reply('y')} AS gpt FROM
        (SELECT CAST(d.doc_id AS VARCHAR) AS id, d.text AS content, s.source,
            CASE s.genre WHEN 'fr' THEN NULL WHEN 'de' THEN 'c.' ELSE s.year END AS y
         FROM documents d JOIN {SOURCES} s ON CAST(d.doc_id AS VARCHAR) = s.id))"""
FLAT = "'human' AS from1, human AS value1, 'gpt' AS from2, gpt AS value2, CAST(2 AS BIGINT) AS messages"

_CLEAN_CONTENT = clean("joined", "sequence", "content")
SPLIT_FIELDS = ["file_order", "line_num", "words", "genre", "year", "source", "title", "pubInfo", "copy"]
SPLIT_KEY = "md5('42:' || " + " || ".join(f"coalesce(length(CAST(j.{f} AS VARCHAR)) || ':' || j.{f}, '-')" for f in SPLIT_FIELDS) + ")"
# One source per id here, so every copy number is 1 and ``sequence`` identifies a merged row.
def sides(content: str) -> str:
    """Every record with its side, its place there and its key."""
    return f"""
    WITH joined AS (SELECT c.*, {SOURCE_COLUMNS}, 1 AS copy FROM {content} c JOIN {SOURCES} s ON c.id = s.id),
    cleaned AS ({_CLEAN_CONTENT}),
    ranked AS (SELECT j.sequence, j.year, j.source, k.content, {SPLIT_KEY} AS shuffle_key, row_number() OVER (ORDER BY {SPLIT_KEY}) AS r,
        floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) AS cut FROM joined j JOIN cleaned k ON j.sequence = k.sequence)
    SELECT CASE WHEN r <= cut THEN 'train' ELSE 'eval' END AS split, source, CAST(0 AS BIGINT) AS score, {FLAT}, shuffle_key,
        CAST(CASE WHEN r <= cut THEN r - 1 ELSE r - 1 - cut END AS BIGINT) AS place
    FROM (SELECT *, {q(PROMPT)} || content AS human, {reply('year')} AS gpt FROM ranked)"""


CORPUS_TO_DATASETS = f"SELECT * EXCLUDE (place, shuffle_key) FROM ({sides(CONTENT)})"

# The tree of files that some queries write: a file per language and bucket, documents in order.
TREE_FILES = """
    (SELECT DISTINCT lang, lpad(CAST(doc_id % 40 AS VARCHAR), 2, '0') AS bucket, dense_rank() OVER (ORDER BY lang, lpad(CAST(doc_id % 40 AS VARCHAR), 2, '0')) - 1
        AS file_order FROM documents)"""
TREE_TAGGED = f"""
    (SELECT file_order, row_number() OVER (PARTITION BY file_order ORDER BY doc_id, pos) - 1 AS line_num, 'lang=' || lang || '/bucket=' || bucket AS folder,
        {strip("CASE WHEN pos % 5 = 4 THEN value ELSE ' ' || chr(9) || '@@' || doc_id || ' ' || value END")} AS line
     FROM (SELECT *, lpad(CAST(doc_id % 40 AS VARCHAR), 2, '0') AS bucket FROM {LINES}) JOIN {TREE_FILES} USING (lang, bucket))"""
TREE_PLACED = f"""
    (SELECT folder AS file, file_order, line_num, file_order * 2000000 + row_number() OVER (PARTITION BY file_order ORDER BY line_num) AS sequence, line
        FROM {TREE_TAGGED} WHERE line LIKE '@@%')"""
TREE_CONTENT = f"({parsed('file, file_order, line_num, sequence', TREE_PLACED)})"

_JOINED_COUNT = f"(SELECT count(*) FROM {CONTENT} c JOIN {SOURCES} s ON c.id = s.id)"
_TRAIN_COUNT = f"CAST(floor({_JOINED_COUNT} * CAST(0.8 AS DOUBLE)) AS BIGINT)"
AUDIT = " UNION ALL ".join(
    f"SELECT '{name}' AS metric, {value} AS value"
    for name, value in (
        ("lines_collected", f"(SELECT count(*) FROM {MARKED})"),
        ("sources_loaded", f"(SELECT count(*) FROM {SOURCES})"),
        ("sources_rejected", f"(SELECT count(*) FROM {SOURCE_PARTS} WHERE line <> '' AND fields < 7)"),
        ("rows_before_join", f"(SELECT count(*) FROM {CONTENT})"),
        ("rows_after_join", _JOINED_COUNT),
        ("train_rows", _TRAIN_COUNT),
        ("eval_rows", f"{_JOINED_COUNT} - {_TRAIN_COUNT}"),
    )
)

_WRAPPED = "(chr(32) || chr(8195) || chr(10) || text || chr(160) || chr(9))"
ORACLE = {
    "marker_filter": f"SELECT * FROM {MARKED}",
    "parse_lines": parsed("doc_id, pos", MARKED),
    "parse_sources": f"SELECT * FROM {SOURCES}",
    "source_rejects": f"""SELECT left(line, 80) AS line, CAST(fields AS BIGINT) AS fields FROM {SOURCE_PARTS}
        WHERE line <> '' AND fields < 7""",
    "strip_collapse": f"SELECT doc_id, {strip(_WRAPPED)} AS stripped, {collapse(_WRAPPED)} AS collapsed FROM documents",
    "mask_redactions": f"SELECT doc_id, {sub('text', f'(@{WS}*)+', '<unk>')} AS masked FROM {TOKENISED}",
    "apply_rules": f"SELECT doc_id, {apply_rules('text')} AS text FROM {TOKENISED}",
    "clean_text": clean("documents", "doc_id", "text"),
    "clean_tokenised": clean(TOKENISED, "doc_id", "text"),
    "clean_pages": f"""
        WITH masked AS (SELECT page_id, {sub(strip('html'), f'(@{WS}*)+', '<unk>')} AS html FROM pages),
        parsed AS (SELECT page_id, html, replace({references(sub('html', _TAGS, chr(1)))}, chr(1), '') AS m FROM masked),
        kept AS (SELECT page_id, CASE WHEN m <> '' AND m <> html THEN {strip(collapse('m'))} ELSE html END AS c FROM parsed)
        SELECT page_id, {finish('c')} AS content FROM kept""",
    "strip_markup": f"SELECT page_id, text FROM {PAGE_TEXT}",
    "strip_markup_native": f"SELECT page_id, text FROM {PAGE_TEXT}",
    "html_unescape": f"SELECT page_id, {references('html')} AS text FROM pages",
    "number_lines": f"SELECT file, file_order, line_num, sequence, line FROM {PLACED}",
    "decode_fallback": f"SELECT doc_id, pos, value AS line FROM {LINES}",
    "scan_corpus": f"""SELECT id, content, line_num - min(line_num) OVER (PARTITION BY id) AS line_num,
        sequence - min(sequence) OVER (PARTITION BY id) AS sequence FROM {CONTENT}""",
    "attach_sources": attach(CONTENT, SOURCES),
    "attach_duplicates": attach(CONTENT, LABEL_SOURCES),
    "attach_duplicates_salted": attach(CONTENT, LABEL_SOURCES),
    "ordered_merge": f"""SELECT sequence, id, genre, words FROM ({attach(CONTENT, LABEL_SOURCES)})
        ORDER BY sequence, words, genre""",
    "exact_split": f"""SELECT * EXCLUDE (r, n), CASE WHEN r <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'eval' END AS split
        FROM (SELECT *, row_number() OVER (ORDER BY shuffle_key) AS r, count(*) OVER () AS n FROM
            (SELECT j.*, {SPLIT_KEY} AS shuffle_key FROM (SELECT *, CAST(1 AS BIGINT) AS copy FROM ({attach(CONTENT, LABEL_SOURCES)})) j))""",
    "format_conversations": f"""SELECT id, source, score,
        [{{'from': 'human', 'value': human}}, {{'from': 'gpt', 'value': gpt}}] AS conversations FROM {RECORDS}""",
    "format_conversations_flat": f"SELECT id, source, score, {FLAT} FROM {RECORDS}",
    "union_batches": """SELECT doc_id, lang, n_chars, source, text FROM documents
        UNION ALL SELECT doc_id, lang, n_chars, source, text FROM documents
        UNION ALL SELECT doc_id, 'label', CAST(quality AS BIGINT), CAST(toxic AS VARCHAR), '' FROM labels""",
    "preview": f"""SELECT source, '[2 messages]' AS conversations FROM {RECORDS} ORDER BY CAST(id AS BIGINT) LIMIT 5""",
    "audit_counts": AUDIT,
    "corpus_to_datasets": CORPUS_TO_DATASETS,
    "run_job": f"SELECT * EXCLUDE (shuffle_key) FROM ({sides(TREE_CONTENT)})",
    "build_datasets": f"SELECT * EXCLUDE (place, shuffle_key) FROM ({sides(TREE_CONTENT)})",
    "list_files": f"SELECT 'lang=' || lang || '/bucket=' || bucket AS folder, file_order FROM {TREE_FILES}",
    "scan_tree": f"SELECT * FROM {TREE_PLACED}",
    "skip_bad_files": f"""SELECT file AS folder, file_order, line_num, line, 'first' AS left_out FROM {TREE_PLACED} WHERE file_order <> 0""",
}
