"""Oracle SQL (DuckDB dialect) for the registered queries.

Each query's fixture derivation and operator is written again in plain SQL
over the driver's views, independently of the Spark code: windows, joins
and regular expressions that DuckDB runs on its own.  Small helpers build
the repeated expressions.
"""

from __future__ import annotations

from decimal import Decimal
from html.entities import name2codepoint

from scanpress.plans.fixtures import AUTHORS, CATEGORIES, METADATA_FORMS, UNKNOWN_MODEL, image_files
from scanpress.plans.queries import PROMPT, REQUEST_MODELS, SAMPLE_N, SAMPLE_SEED, SYSTEM
from scanpress.schemas import MODELS, PRICES_PER_MILLION

NL = "chr(10)"
WS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
BLOCK_TAGS = "p|br|div|h[1-6]|li|ul|ol|article|main|header|footer|nav|section|body|html|head|title"
ARTICLE_STEM = r"^[^_]*_([^_-]*)-([0-9]+)_"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def lst(values: list[str]) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def pick(values: list[str], index: str) -> str:
    return f"{lst(values)}[({index}) + 1]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace({strip(x)}, '{WS}+', ' ', 'g')"


def decode(x: str, nbsp: str = "' '") -> str:
    """Entity decoding; ``nbsp`` is the SQL expression ``&nbsp;`` becomes."""
    out = x
    for a, b in (("&lt;", lit("<")), ("&gt;", lit(">")), ("&quot;", lit('"')), ("&#39;", lit("'")), ("&nbsp;", nbsp)):
        out = f"replace({out}, {lit(a)}, {b})"
    return f"replace({out}, '&amp;', '&')"


def decode_references(x: str) -> str:
    """All HTML 4 names and decimal references, piece by piece; U+00A0 becomes a space."""
    names = ", ".join(f"'&{n};': chr({32 if c == 160 else c})" for n, c in name2codepoint.items())
    piece = f"""CASE WHEN regexp_full_match(e, '&#[0-9]{{1,6}};')
        THEN replace(chr(CAST(regexp_extract(e, '[0-9]+') AS INTEGER)), chr(160), ' ')
        ELSE coalesce(map_extract(MAP {{{names}}}, e)[1], e) END"""
    return f"""array_to_string(list_transform(regexp_extract_all({x}, '&#?[0-9A-Za-z]+;|[^&]+|&'),
        lambda e: CASE WHEN e[1] <> '&' THEN e ELSE {piece} END), '')"""


def esc_attr(x: str) -> str:
    out = f"replace({x}, '&', '&amp;')"
    for a, b in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = f"replace({out}, {lit(a)}, {lit(b)})"
    return out


def esc_text(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def element_text(x: str, v: str = "t") -> str:
    cleaned = f"list_transform(string_split_regex({x}, '<[^>]*>'), lambda {v}: {strip(decode(v, 'chr(160)'))})"
    return f"array_to_string(list_filter({cleaned}, lambda {v}: {v} <> ''), '')"


def shorten(x: str) -> str:
    c = collapse(x)
    head = f"regexp_extract({c}, '^(.{{1,54}}) ', 1)"
    return f"(CASE WHEN length({c}) <= 60 THEN {c} WHEN {head} <> '' THEN {head} || ' [...]' ELSE '[...]' END)"


def slug(x: str) -> str:
    ascii_only = f"regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')"
    return f"trim(regexp_replace(lower({ascii_only}), '[^a-z0-9]+', '-', 'g'), '-')"


def headline_slug(x: str) -> str:
    return slug(shorten(x))


def html_to_text(x: str) -> str:
    out = f"regexp_replace({x}, '(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', '', 'g')"
    out = f"regexp_replace({out}, '(?i)</?({BLOCK_TAGS})\\b[^>]*>', {NL}, 'g')"
    out = f"regexp_replace({out}, '<[^>]*>', '', 'g')"
    out = decode_references(out)
    out = f"regexp_replace({out}, '[ \\t]+', ' ', 'g')"
    out = f"regexp_replace({out}, '[ \\t\\r]*\\n[ \\t\\r\\n]*', {NL} || {NL}, 'g')"
    return f"regexp_replace({out}, '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g')"


def scan_stem(n: str) -> str:
    return f"('gazette_' || CAST(1000 + {n} // 8 AS VARCHAR) || '-' || lpad(CAST({n} % 8 AS VARCHAR), 3, '0'))"


def file_stem(x: str) -> str:
    return f"regexp_extract({x}, '^(.+?)(\\.[^.]*)?$', 1)"


def meta_tag(name: str, v: str) -> str:
    return f"CASE WHEN {v} IS NOT NULL AND {v} <> '' THEN '<meta name=\"{name}\" content=\"' || {esc_attr(v)} || '\"/>' END"


def article_html(headline: str, strap: str, author: str, slug_col: str, cat: str, body: str) -> str:
    metas = ", ".join([
        meta_tag("title", f"replace({headline}, {NL}, ' ')"),
        meta_tag("subtitle", strap),
        meta_tag("author", author),
        meta_tag("slug", slug_col),
        meta_tag("category", cat),
    ])
    return (
        f"'<html><head>' || concat_ws('', {metas}) || '</head><body>' || "
        f"coalesce('<main>' || {body} || '</main>', '') || '</body></html>'"
    )


def meta_value(html: str, name: str) -> str:
    pattern = f'<meta\\s+name="{name}"\\s+content="([^"]*)"'
    value = decode(f"regexp_extract({html}, {lit(pattern)}, 1)", "chr(160)")
    return f"CASE WHEN regexp_matches({html}, {lit(pattern)}) THEN {value} END"


def natural_key(x: str) -> str:
    digits = "regexp_replace(r, '^0+', '')"
    enc = f"CASE WHEN regexp_matches(r, '^[0-9]') THEN chr(1) || lpad(CAST(length({digits}) AS VARCHAR), 10, '0') || {digits} ELSE r END"
    return f"array_to_string(list_transform(regexp_extract_all({x}, '([0-9]+|[^0-9]+)', 1), lambda r: {enc}), '')"


# ---------------------------------------------------------------- fixture CTEs


def _arts_expr() -> str:
    strap = (
        "CASE page_id % 3 WHEN 0 THEN '<strapline></strapline>' "
        "WHEN 1 THEN '<strapline>Issue ' || CAST(1000 + page_id // 8 AS VARCHAR) || ', page ' || "
        "CAST(page_id % 8 + 1 AS VARCHAR) || '</strapline>' ELSE '' END"
    )
    author = (
        "CASE WHEN page_id % 7 = 0 THEN '' ELSE '<author_name>' || "
        f"regexp_replace({pick(AUTHORS, 'page_id % 7')}, '[<>&]', '', 'g') || '</author_name>' END"
    )
    cat = f"CASE WHEN page_id % 5 = 4 THEN '' ELSE '<category>' || {pick(CATEGORIES, 'page_id % 4')} || '</category>' END"
    second = (
        "CASE WHEN page_id % 2 = 0 THEN '<article><header><headline></headline></header><main><p>Continued from page ' || "
        "CAST(page_id % 8 AS VARCHAR) || '.</p></main></article>' ELSE '' END"
    )
    return (
        "'<article><header><headline>' || regexp_extract(html, '(?s)<title>(.*?)</title>', 1) || '</headline>' || "
        f"{strap} || {author} || {cat} || '</header><main>' || "
        "regexp_extract(html, '(?s)<article>(.*?)</article>', 1) || '</main></article>' || " + second
    )


XML_DECL = '<?xml version="1.0" encoding="UTF-8"?>'

RESP = f"""resp AS (
  SELECT {scan_stem('page_id')} AS page_id,
    {pick(MODELS, 'page_id % 6')} AS model,
    0 AS attempt,
    CASE WHEN page_id % 13 = 12 THEN 2 ELSE 1 END AS n_generations,
    CASE WHEN page_id % 17 = 16 THEN 'human' ELSE 'ai' END AS message_type,
    CASE WHEN page_id % 29 = 28 THEN NULL
      WHEN page_id % 19 = 18 THEN 'I could not find any articles on this page.'
      WHEN page_id % 4 = 0 THEN 'Here:' || {NL} || '```html' || {NL} || arts || {NL} || '```'
      WHEN page_id % 4 = 1 THEN '```xml' || {NL} || {lit(XML_DECL)} || {NL} || arts || {NL} || '```'
      WHEN page_id % 4 = 2 THEN 'Here are the articles.' || {NL} || '```' || {NL} || arts || {NL} || '```' || {NL} || 'Done.'
      ELSE {lit(XML_DECL)} || {NL} || arts END AS content,
    {pick(METADATA_FORMS, 'page_id % 10')} AS response_metadata,
    CASE WHEN page_id % 23 = 22 THEN NULL ELSE CAST(258 + length(html) // 4 AS BIGINT) END AS input_tokens,
    CASE WHEN page_id % 23 = 22 THEN NULL ELSE CAST(length(arts) // 4 AS BIGINT) END AS output_tokens
  FROM (SELECT page_id, html, {_arts_expr()} AS arts FROM pages)
)"""


def _truthy_json(path: str) -> str:
    v = f"json_extract_string(response_metadata, '{path}')"
    return f"CASE WHEN {v} NOT IN ('', '0', 'false', '0.0', '[]', '{{}}') THEN {v} END"


FINISH = (
    f"coalesce({_truthy_json('$.finish_reason')}, {_truthy_json('$.stop_reason')}, "
    f"{_truthy_json('$.prompt_feedback.block_reason')}, 'missing')"
)
STRIP_FENCES = (
    "regexp_replace(regexp_replace(regexp_replace(content, '(?s)^.*?```(?:html|xml)?(.*)```.*$', '\\1'), "
    "'(?s)^.*?<[^>]*encoding[^>]*>\\n', ''), '^[ \\t\\n\\r\\f\\x0B]+|[ \\t\\n\\r\\f\\x0B]+$', '', 'g')"
)

STATUS = f"""st1 AS (
  SELECT *, {FINISH} AS finish_reason,
    regexp_replace({STRIP_FENCES}, '(?s)<!--.*?-->', '', 'g') AS markup
  FROM resp
), st2 AS (
  SELECT *, CAST(len(regexp_extract_all(markup, '(?i)<article[\\s/>]')) AS INTEGER) AS n_articles FROM st1
), st AS (
  SELECT *, CASE WHEN coalesce(n_generations, 1) <> 1 THEN 'MULTI_GENERATION'
    WHEN coalesce(message_type, '') <> 'ai' THEN 'NOT_AI_MESSAGE'
    WHEN finish_reason NOT IN ('STOP', 'end_turn', 'stop') THEN 'BAD_FINISH:' || finish_reason
    WHEN content IS NULL THEN 'NON_STRING'
    WHEN n_articles = 0 THEN 'NO_ARTICLES' ELSE 'OK' END AS status
  FROM st2
)"""


def _field(tag: str) -> str:
    inner = f"regexp_extract(block, '(?s)<{tag}>(.*?)</{tag}>', 1)"
    return f"CASE WHEN contains(block, '<{tag}>') THEN {element_text(inner)} END"


ARTS = f"""blk AS (
  SELECT page_id, model, attempt, regexp_extract_all(markup, '(?s)<article>(.*?)</article>', 1) AS blocks
  FROM st WHERE status = 'OK'
), ex AS (
  SELECT page_id, model, attempt, CAST(unnest(range(len(blocks))) AS INTEGER) AS ordinal, unnest(blocks) AS block FROM blk
), arts AS (
  SELECT page_id, model, attempt, ordinal,
    coalesce(nullif({_field('headline')}, ''), 'Untitled') AS headline,
    {_field('strapline')} AS strapline,
    {_field('author_name')} AS author_name,
    {_field('category')} AS category,
    CASE WHEN contains(block, '<main>') THEN regexp_extract(block, '(?s)<main>(.*?)(?:</main>|$)', 1) END AS body_html
  FROM ex
)"""

SCANS = f"""scans AS (
  SELECT page_id AS scan_id, 'scans/' || stem || '.jpg' AS path, stem, html FROM (
    SELECT page_id, html, CASE
      WHEN page_id % 11 = 10 THEN 'gazette-daily-2011_' || CAST(page_id // 8 AS VARCHAR) || '-' || CAST(page_id % 8 AS VARCHAR)
      WHEN page_id % 13 = 12 THEN 'gazette_' || CAST(page_id AS VARCHAR) || '-x'
      ELSE {scan_stem('page_id')} END AS stem
    FROM pages)
)"""

FILES = f"""files AS (
  SELECT page_id AS file_id, CASE
    WHEN page_id % 11 = 10 THEN 'gazette_' || CAST(1000 + page_id // 8 AS VARCHAR) || '.html'
    WHEN page_id % 11 = 9 THEN 'gazette_' || CAST(page_id AS VARCHAR) || '-1-2_x.html'
    WHEN page_id % 11 = 8 THEN 'gazette-daily-2011_' || CAST(page_id // 8 AS VARCHAR) || '-' || CAST(page_id % 8 AS VARCHAR) || '_x.html'
    WHEN page_id % 11 = 7 THEN 'a_' || CAST(page_id AS VARCHAR) || '.html'
    ELSE {scan_stem('page_id')} || '_article-' || CAST(page_id % 5 AS VARCHAR) || '.html' END AS file_name
  FROM pages
)"""

SCAN_JOB = f"""job AS (
  SELECT *, {headline_slug('headline')} AS slug FROM (
    SELECT page_id AS pid, CASE WHEN page_id % 2 = 0 THEN 'left' ELSE 'right' END AS folder, {scan_stem('(page_id // 2)')} AS page_id,
      length(html) AS html_chars, page_id % 10 = 9 AS bad, page_id % 10 <> 9 AND page_id % 8 <> 1 AS ok,
      CASE WHEN page_id % 10 = 9 THEN 0 WHEN page_id % 4 IN (1, 2) THEN 2 ELSE 1 END AS calls,
      CASE WHEN page_id % 4 IN (0, 3) THEN 'gemini-2.0' ELSE 'claude-3.7' END AS model,
      CAST(CASE WHEN page_id % 4 IN (0, 3) THEN 0 ELSE 1 END AS INTEGER) AS attempt,
      coalesce(nullif({element_text("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}, ''), 'Untitled') AS headline
    FROM pages)
)"""

EXISTING = f"""existing AS (
  SELECT CASE WHEN doc_id % 9 = 8 THEN 'a_' || CAST(doc_id AS VARCHAR) || '.html'
    ELSE {scan_stem('doc_id')} || '_x' || CAST(quality AS VARCHAR) || '.html' END AS file_name
  FROM labels
)"""

_FIRST = f"split_part(text, {NL}, 1)"
DOCS = f"""da AS (
  SELECT 'gazette_' || CAST(1000 + CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS VARCHAR) || '-' ||
      lpad(CAST(doc_id % 8 AS VARCHAR), 3, '0') AS page_id,
    CAST(doc_id AS INTEGER) AS ordinal,
    coalesce(nullif({_FIRST}, ''), 'Untitled') AS headline,
    CASE WHEN doc_id % 3 = 1 THEN '' WHEN doc_id % 3 = 2 THEN lang || ' edition' END AS strapline,
    CASE WHEN doc_id % 4 <> 0 THEN {pick(AUTHORS[1:], 'doc_id % 6')} END AS author_name,
    CASE WHEN doc_id % 5 <> 4 THEN {pick(CATEGORIES, 'doc_id % 4')} END AS category,
    '<p>' || replace({esc_text(f'substr(text, length({_FIRST}) + 2)')}, {NL}, '</p><p>') || '</p>' AS body_html
  FROM documents
), ds AS (
  SELECT *, {headline_slug('headline')} AS slug FROM da
), dn AS (
  SELECT *, page_id || '_' || slug || CASE WHEN rn > 0 THEN '_' || CAST(rn AS VARCHAR) ELSE '' END || '.html' AS file_name
  FROM (SELECT *, row_number() OVER (PARTITION BY page_id, slug ORDER BY ordinal) - 1 AS rn FROM ds)
), docs AS (
  SELECT page_id, ordinal, file_name, slug,
    {article_html('headline', 'strapline', 'author_name', 'slug', 'category', 'body_html')} AS html
  FROM dn
)"""


def _price_rows() -> str:
    rows = []
    for model, (i, o) in PRICES_PER_MILLION.items():
        pi = format(i / Decimal(1_000_000), "f")
        po = format(o / Decimal(1_000_000), "f")
        rows.append(f"({lit(model)}, CAST('{pi}' AS DECIMAL(18,12)), CAST('{po}' AS DECIMAL(18,12)))")
    return ", ".join(rows)


PRICES = f"prices AS (SELECT * FROM (VALUES {_price_rows()}) t(model, input_cost_per_token, output_cost_per_token))"

USAGE = f"""usage AS (
  SELECT conv_id, turn,
    CASE WHEN conv_id % 37 = 36 THEN {lit(UNKNOWN_MODEL)} ELSE {pick(MODELS, 'conv_id % 6')} END AS model,
    CAST(CASE WHEN (conv_id + turn) % 31 = 30 THEN NULL WHEN role = 'assistant' THEN 0 ELSE length(text) END AS BIGINT) AS input_tokens,
    CAST(CASE WHEN (conv_id + turn) % 31 = 30 THEN NULL WHEN role = 'assistant' THEN length(text) ELSE 0 END AS BIGINT) AS output_tokens
  FROM conversations
)"""

COST = f"""cost AS (
  SELECT s.model, replies, input_tokens, output_tokens, replies_without_usage,
    CASE WHEN p.model IS NULL THEN 'UNKNOWN_MODEL' ELSE 'OK' END AS price_status,
    CAST(CAST(input_tokens AS DECIMAL(18,0)) * p.input_cost_per_token AS DECIMAL(38,12)) AS input_cost,
    CAST(CAST(output_tokens AS DECIMAL(18,0)) * p.output_cost_per_token AS DECIMAL(38,12)) AS output_cost,
    CAST(CAST(input_tokens AS DECIMAL(18,0)) * p.input_cost_per_token
       + CAST(output_tokens AS DECIMAL(18,0)) * p.output_cost_per_token AS DECIMAL(38,12)) AS total_cost
  FROM (SELECT model, count(*) AS replies,
      CAST(sum(coalesce(input_tokens, 0)) AS BIGINT) AS input_tokens,
      CAST(sum(coalesce(output_tokens, 0)) AS BIGINT) AS output_tokens,
      count(*) FILTER (WHERE input_tokens IS NULL OR output_tokens IS NULL) AS replies_without_usage
    FROM usage GROUP BY model) s
  LEFT JOIN prices p ON p.model = s.model
)"""

ATTEMPTS = f"""attempts AS (
  SELECT {scan_stem('doc_id')} AS page_id, 0 AS attempt, 'gemini-2.0' AS model, quality = 1 AS ok,
    CASE WHEN quality = 1 THEN 'OK' ELSE 'BAD_FINISH:MAX_TOKENS' END AS status FROM labels
  UNION ALL
  SELECT {scan_stem('doc_id')}, 1, 'claude-3.7', toxic = 0, CASE WHEN toxic = 0 THEN 'OK' ELSE 'NO_ARTICLES' END FROM labels
)"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_SC_STEM = "'^(.*)-([0-9]+)$'"
_H1 = "regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"
_NAME_OK = f"regexp_matches({file_stem('file_name')}, '{ARTICLE_STEM}')"


def _article_fields(html: str) -> str:
    return (
        f"coalesce({meta_value(html, 'title')}, 'Untitled') AS headline, {meta_value(html, 'subtitle')} AS strapline, "
        f"{meta_value(html, 'author')} AS author, {meta_value(html, 'category')} AS category"
    )


_DOC_NAMED = f"""an AS (
  SELECT *, page_id || '_' || slug || CASE WHEN rn > 0 THEN '_' || CAST(rn AS VARCHAR) ELSE '' END || '.html' AS file_name
  FROM (SELECT *, row_number() OVER (PARTITION BY page_id, slug ORDER BY ordinal, model, attempt) - 1 AS rn
        FROM (SELECT *, {headline_slug('headline')} AS slug FROM arts))
)"""

_USED = r"""used AS (
  SELECT DISTINCT base, counter FROM (
    SELECT regexp_extract(file_name, '^(.*)_([1-9][0-9]*)\.html$', 1) AS base,
      CAST(regexp_extract(file_name, '^(.*)_([1-9][0-9]*)\.html$', 2) AS BIGINT) AS counter
    FROM written WHERE regexp_matches(file_name, '^(.*)_([1-9][0-9]*)\.html$')
    UNION ALL
    SELECT regexp_extract(file_name, '^(.*)\.html$', 1), 0 FROM written WHERE regexp_matches(file_name, '^(.*)\.html$'))
)"""

SQL: dict[str, str] = {
    "scan_names": w(SCANS) + f"""SELECT path, stem,
        CASE WHEN regexp_matches(stem, {_SC_STEM}) THEN regexp_extract(stem, {_SC_STEM}, 1) END AS issue,
        TRY_CAST(CASE WHEN regexp_matches(stem, {_SC_STEM}) THEN regexp_extract(stem, {_SC_STEM}, 2) END AS INTEGER) AS scan_page
        FROM scans""",
    "article_names": w(FILES) + f"""SELECT file_name,
        regexp_extract({file_stem('file_name')}, '{ARTICLE_STEM}', 1) AS issue,
        TRY_CAST(TRY_CAST(regexp_extract({file_stem('file_name')}, '{ARTICLE_STEM}', 2) AS BIGINT) + 1 AS INTEGER) AS page
        FROM files WHERE {_NAME_OK}""",
    "scan_keys": w(FILES) + "SELECT file_name, array_to_string(string_split(file_name, '_')[1:2], '_') AS scan_key FROM files",
    "bad_names": w(FILES) + f"SELECT file_name FROM files WHERE NOT {_NAME_OK}",
    "shorten": f"SELECT doc_id, {shorten(_FIRST)} AS short FROM documents",
    "slugify": f"SELECT doc_id, {headline_slug(_FIRST)} AS slug FROM documents",
    "html_meta": w(DOCS) + f"""SELECT file_name, {_article_fields('html')},
        CAST(len(list_distinct(regexp_extract_all(html, '<meta\\s+name="([^"]*)"\\s+content="[^"]*"\\s*/?>', 1))) AS BIGINT) AS n_meta
        FROM docs""",
    "html_to_text": f"SELECT page_id, {html_to_text('html')} AS txt FROM pages",
    "article_text": w(RESP, STATUS, ARTS) + f"""SELECT page_id, ordinal,
        concat_ws({NL} || {NL}, headline, nullif(strapline, ''), 'Author: ' || nullif(author_name, ''),
                  coalesce({html_to_text('body_html')}, '')) AS txt FROM arts""",
    "article_markdown": w(DOCS) + f"""SELECT file_name, concat_ws({NL} || {NL}, '# ' || nullif(headline, ''),
        '**' || nullif(strapline, '') || '**', nullif(author, ''), coalesce({html_to_text('html')}, '')) AS markdown
        FROM (SELECT file_name, html, {_article_fields('html')} FROM docs)""",
    "article_html": w(RESP, STATUS, ARTS, _DOC_NAMED) + f"""SELECT file_name,
        {article_html('headline', 'strapline', 'author_name', 'slug', 'category', 'body_html')} AS html FROM an""",
    "strip_fences": w(RESP) + f"SELECT page_id, {STRIP_FENCES} AS markup FROM resp",
    "finish_reason": w(RESP) + f"SELECT page_id, response_metadata, {FINISH} AS finish_reason FROM resp",
    "response_status": w(RESP, STATUS) + "SELECT page_id, model, n_articles, status FROM st",
    "element_text": f"SELECT page_id, {element_text(_H1)} AS heading FROM pages",
    "image_base64": w(SCANS) + """SELECT path, 'data:' || CASE
        WHEN starts_with(hex(encode(html)), 'FFD8FF') THEN 'image/jpeg'
        WHEN starts_with(hex(encode(html)), '89504E470D0A1A0A') THEN 'image/png'
        WHEN starts_with(hex(encode(html)), '47494638') THEN 'image/gif'
        ELSE 'application/octet-stream' END || ';base64,' || to_base64(encode(html)) AS data_url FROM scans""",
    "build_requests": w(SCANS) + f"""SELECT stem AS page_id, model,
        '{{"model":"' || model || '","messages":[{{"role":"system","content":"{SYSTEM}"}},' ||
        '{{"role":"user","content":[{{"type":"image_url","image_url":{{"url":"data:application/octet-stream;base64,' ||
        to_base64(encode(html)) || '"}}}},{{"type":"text","text":"{PROMPT}"}}]}}]}}' AS request_json
        FROM scans, (SELECT unnest({lst(REQUEST_MODELS)}) AS model)""",
    "extract_articles": w(RESP, STATUS, ARTS) + "SELECT * FROM arts",
    # Same articles as the regular form: the parser path must agree with the regex path.
    "extract_articles_irregular": w(RESP, STATUS, ARTS) + "SELECT * FROM arts",
    # Stray markup changes nothing; pages 5, 11, 17... hold articles nested too deep to be written out.
    "malformed_articles": w(RESP, STATUS, ARTS) + f"""SELECT * FROM arts
        WHERE page_id NOT IN (SELECT {scan_stem('page_id')} FROM pages WHERE page_id % 6 = 5)""",
    "malformed_status": w(RESP, STATUS) + f"""SELECT page_id, model, attempt,
        CASE WHEN deep AND n_articles > 0 THEN NULL ELSE n_articles END AS n_articles,
        CASE WHEN status <> 'OK' THEN status WHEN deep THEN 'PARSE_ERROR:ExpansionError' END AS reason
        FROM (SELECT *, page_id IN (SELECT {scan_stem('page_id')} FROM pages WHERE page_id % 6 = 5) AS deep FROM st)""",
    "malformed_meta": w(DOCS) + f"SELECT file_name, {_article_fields('html')} FROM docs",
    "accepted_replies": w(RESP, STATUS) + "SELECT page_id, finish_reason FROM st WHERE finish_reason IN ('STOP', 'end_turn', 'stop')",
    "quarantine": w(RESP, STATUS) + "SELECT page_id, model, attempt, finish_reason, status AS reason FROM st WHERE status <> 'OK'",
    "valid_scans": w(SCANS) + """SELECT path, CASE
        WHEN starts_with(hex(encode(html)), 'FFD8FF') THEN 'jpeg'
        WHEN starts_with(hex(encode(html)), '89504E470D0A1A0A') THEN 'png'
        WHEN starts_with(hex(encode(html)), '47494638') THEN 'gif'
        ELSE 'unknown' END AS image_kind,
        starts_with(hex(encode(html)), 'FFD8FF') OR starts_with(hex(encode(html)), '89504E470D0A1A0A')
        OR starts_with(hex(encode(html)), '47494638') AS valid FROM scans""",
    "missing_scans": w(SCANS, EXISTING) + f"""SELECT path, stem, {natural_key('path')} AS natural_key FROM scans s
        WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE array_to_string(string_split(e.file_name, '_')[1:2], '_') = s.stem)""",
    "distinct_keys": w(EXISTING) + "SELECT DISTINCT array_to_string(string_split(file_name, '_')[1:2], '_') AS scan_key FROM existing",
    "price_usage": w(USAGE, PRICES) + """SELECT u.conv_id, u.turn, u.model,
        CASE WHEN p.model IS NULL THEN 'UNKNOWN_MODEL' ELSE 'OK' END AS price_status,
        CAST(CAST(coalesce(u.input_tokens, 0) AS DECIMAL(18,0)) * p.input_cost_per_token AS DECIMAL(38,12)) AS input_cost,
        CAST(CAST(coalesce(u.output_tokens, 0) AS DECIMAL(18,0)) * p.output_cost_per_token AS DECIMAL(38,12)) AS output_cost
        FROM usage u LEFT JOIN prices p ON p.model = u.model""",
    "name_offset": w(DOCS) + ", " + ",\n".join([
        "written AS (SELECT file_name FROM dn WHERE ordinal IN (SELECT doc_id FROM labels WHERE quality = 1))",
        _USED,
        "newr AS (SELECT *, page_id || '_' || slug AS base, row_number() OVER (PARTITION BY page_id || '_' || slug ORDER BY ordinal) AS r FROM ds)",
        "k AS (SELECT base, count(*) AS k FROM newr GROUP BY base)",
        "uc AS (SELECT base, count(*) AS u FROM used GROUP BY base)",
        "cand AS (SELECT k.base, unnest(range(0, k.k + coalesce(uc.u, 0) + 1)) AS c FROM k LEFT JOIN uc ON uc.base = k.base)",
        """free AS (SELECT base, c, row_number() OVER (PARTITION BY base ORDER BY c) AS fr FROM cand
           WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.base = cand.base AND u.counter = cand.c))""",
    ]) + """
        SELECT n.page_id, n.ordinal, n.slug,
          n.base || CASE WHEN f.c > 0 THEN '_' || CAST(f.c AS VARCHAR) ELSE '' END || '.html' AS file_name
        FROM newr n JOIN free f ON f.base = n.base AND f.fr = n.r""",
    "union_attempts": w(ATTEMPTS) + "SELECT * FROM attempts",
    "cost_by_model": w(USAGE, PRICES, COST) + "SELECT * FROM cost",
    "total_cost": w(USAGE, PRICES, COST) + """SELECT CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
        CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
        count(*) FILTER (WHERE price_status <> 'OK') AS unpriced_models,
        CAST(coalesce(sum(total_cost), 0) AS DECIMAL(38,12)) AS total_cost,
        '$' || format('{:,.2f}', round_even(CAST(coalesce(sum(total_cost), 0) AS DECIMAL(38,12)), 2)) AS total_usd
        FROM cost""",
    "first_success": w(ATTEMPTS) + """SELECT page_id, count(*) AS attempts,
        min(attempt) FILTER (WHERE ok) AS chosen_attempt,
        min_by(model, attempt) FILTER (WHERE ok) AS chosen_model,
        CASE WHEN min(attempt) FILTER (WHERE ok) IS NOT NULL THEN 'OK' ELSE min_by(status, attempt) END AS status
        FROM attempts GROUP BY page_id""",
    "run_summary": w(RESP, STATUS) + """SELECT count(DISTINCT page_id) AS pages_done, count(*) AS replies,
        count(*) FILTER (WHERE status = 'OK') AS ok_replies, count(*) FILTER (WHERE status <> 'OK') AS failed_replies,
        CAST(coalesce(sum(CASE WHEN status = 'OK' THEN n_articles END), 0) AS BIGINT) AS articles,
        count(*) FILTER (WHERE input_tokens IS NULL OR output_tokens IS NULL) AS replies_without_usage FROM st""",
    "failure_reasons": w(RESP, STATUS) + "SELECT status AS reason, count(*) AS replies FROM st WHERE status <> 'OK' GROUP BY status",
    "unique_names": w(DOCS) + "SELECT page_id, ordinal, slug, file_name FROM dn",
    "natural_sort": w(FILES) + f"SELECT file_name, {natural_key('file_name')} AS natural_key FROM files",
    "sample_n": f"""SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR) || '{SAMPLE_SEED}') AS sample_key FROM documents
        ORDER BY sample_key, doc_id LIMIT {SAMPLE_N}""",
    "article_files": w(DOCS) + f"""SELECT file_name AS filename,
        regexp_extract({file_stem('file_name')}, '{ARTICLE_STEM}', 1) AS issue,
        TRY_CAST(TRY_CAST(regexp_extract({file_stem('file_name')}, '{ARTICLE_STEM}', 2) AS BIGINT) + 1 AS INTEGER) AS page,
        coalesce({meta_value('html', 'title')}, 'Untitled') AS headline,
        {html_to_text('html')} AS txt, html,
        {meta_value('html', 'subtitle')} AS strapline, {meta_value('html', 'author')} AS author,
        {meta_value('html', 'category')} AS category
        FROM docs WHERE {_NAME_OK}""",
    "scan_listing": w(SCANS) + """SELECT stem, CAST(octet_length(encode(html)) AS BIGINT) AS length,
        stem || '.jpg' AS listed_name FROM scans""",
    "read_responses": w(RESP) + "SELECT * FROM resp",
    "reader_meta": w(DOCS) + f"""SELECT file_name, {_article_fields('html')},
        CASE WHEN regexp_matches(html, '(?i)<head\\b') AND regexp_matches(html, '(?i)<body\\b') THEN 'OK'
             ELSE 'DEFORMED' END AS status FROM docs""",
    # Streaming results, over four micro-batches, must equal the batch results.
    "stream_articles": w(RESP, STATUS, ARTS) + f"SELECT *, {headline_slug('headline')} AS slug FROM arts",
    "stream_cost": w(USAGE, PRICES, COST) + "SELECT * FROM cost",
    # One micro-batch over all replies names exactly like the batch job.
    "stream_named_articles": w(RESP, STATUS, ARTS, _DOC_NAMED) + "SELECT file_name, page_id, ordinal, slug FROM an",
    "scans_to_documents": w(SCAN_JOB) + f"""SELECT folder, page_id, model, attempt, CAST(0 AS INTEGER) AS ordinal,
        page_id || '_' || slug || CASE WHEN rn > 0 THEN '_' || CAST(rn AS VARCHAR) ELSE '' END || '.html' AS file_name,
        {article_html('headline', 'NULL', 'NULL', 'slug', 'NULL', 'body')} AS html FROM (
          SELECT *, '<p>' || CAST(pid AS VARCHAR) || '</p>' AS body,
            row_number() OVER (PARTITION BY page_id, slug ORDER BY folder) - 1 AS rn FROM job WHERE ok)""",
    "scan_job_report": w(SCAN_JOB, PRICES) + """, t AS (
          SELECT count(*) AS pages_done, count(*) FILTER (WHERE NOT ok) AS pages_failed, CAST(sum(calls) AS BIGINT) AS calls,
            CAST(sum(CASE WHEN bad THEN 0 ELSE calls END) AS BIGINT) AS replies,
            count(*) FILTER (WHERE ok) AS pages_with_documents, count(*) FILTER (WHERE ok) AS documents, count(*) FILTER (WHERE ok) AS articles
          FROM job),
        c AS (
          SELECT CAST(sum(CAST(i AS DECIMAL(18,0)) * input_cost_per_token + CAST(o AS DECIMAL(18,0)) * output_cost_per_token) AS DECIMAL(38,12)) AS total_cost
          FROM (SELECT 'gemini-2.0' AS model, html_chars AS i, pid AS o FROM job WHERE NOT bad AND pid % 4 <> 1
                UNION ALL SELECT 'claude-3.7', html_chars, pid FROM job WHERE NOT bad AND (pid % 4 = 2 OR pid % 8 = 5)) u
          JOIN prices USING (model))
        SELECT r.*, t.*, c.total_cost FROM (
          SELECT CASE WHEN bad THEN 'INVALID_SCAN:truncated' ELSE 'MODEL_ERROR:RuntimeError' END AS reason,
            count(*) AS pages, CAST(sum(CASE WHEN bad THEN 1 ELSE 2 END) AS BIGINT) AS attempts FROM job WHERE NOT ok GROUP BY 1) r, t, c""",
    "image_scans": f"""SELECT 'images/' || CAST(page_id AS VARCHAR) AS path, kind AS image_kind,
        kind <> 'unknown' AND (page_id % 4 IN (0, 1) OR page_id % 4 = 3 AND kind NOT IN ('png', 'webp')) AS valid,
        CASE page_id % 4 WHEN 1 THEN n + octet_length(encode(html)) WHEN 2 THEN n - 1 - page_id % 3 ELSE n END AS bytes
        FROM (SELECT page_id, html, {pick(list(image_files()), 'page_id % 7')} AS kind,
                [{', '.join(str(len(x)) for x in image_files().values())}][page_id % 7 + 1] AS n FROM pages)""",
    # Every page comes once in each of four batches; a base's repeats go on from batch to batch.
    "stream_named_batches": w(RESP, STATUS, ARTS) + f""", b AS (
          SELECT *, {headline_slug('headline')} AS slug FROM (SELECT page_id, ordinal, headline, CAST(unnest(range(4)) AS INTEGER) AS attempt FROM arts)),
        n AS (SELECT *, row_number() OVER (PARTITION BY page_id, slug ORDER BY attempt, ordinal) - 1 AS rn FROM b)
        SELECT page_id || '_' || slug || CASE WHEN rn > 0 THEN '_' || CAST(rn AS VARCHAR) ELSE '' END || '.html' AS file_name,
          page_id, attempt, ordinal, slug, attempt AS batch_id FROM n""",
    # Windows of 25 x 25 pixels over mirrored borders as two sums, one along each axis, and the comparison in whole numbers.
    "binarize_scans": w(SCANS) + """, b AS (
          SELECT path, ceil(octet_length(encode(html)) / 64)::INT AS h0, regexp_extract_all(hex(encode(html)), '..') AS pairs FROM scans),
        i AS (SELECT path, greatest(h0, 1) AS h, pairs FROM b),
        g AS (
          SELECT path, h, x, y, CASE WHEN 64 * y + x < len(pairs) THEN ('0x' || pairs[64 * y + x + 1])::INT ELSE 32 END::BIGINT AS v
          FROM (SELECT *, unnest(range(64))::INT AS x FROM (SELECT *, unnest(range(h))::INT AS y FROM i))),
        px AS (SELECT unnest(range(-12, 76))::INT AS px),
        mx AS (SELECT px, CASE WHEN (px + 126) % 126 < 64 THEN (px + 126) % 126 ELSE 126 - (px + 126) % 126 END AS x FROM px),
        sx AS (
          SELECT path, h, y, px, sum(v) OVER r AS s, sum(v * v) OVER r AS q FROM g JOIN mx USING (x)
          WINDOW r AS (PARTITION BY path, y ORDER BY px ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)),
        hs AS (SELECT DISTINCT h FROM i),
        my AS (
          SELECT h, py, CASE WHEN h = 1 THEN 0 WHEN m < h THEN m ELSE 2 * h - 2 - m END AS y
          FROM (SELECT h, py, CASE WHEN h > 1 THEN ((py % (2 * h - 2)) + 2 * h - 2) % (2 * h - 2) END AS m
                FROM (SELECT h, unnest(range(-12, h + 12))::INT AS py FROM hs))),
        sy AS (
          SELECT path, h, py, px, sum(s) OVER r AS s, sum(q) OVER r AS q FROM sx JOIN my USING (h, y) WHERE px BETWEEN 0 AND 63
          WINDOW r AS (PARTITION BY path, px ORDER BY py ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)),
        l AS (
          SELECT g.path, g.h, 255::HUGEINT * 625 * (5 * 625 * g.v - 4 * sy.s) AS l, sy.s::HUGEINT AS s, 625::HUGEINT * sy.q - sy.s::HUGEINT * sy.s AS d
          FROM g JOIN sy ON sy.path = g.path AND sy.px = g.x AND sy.py = g.y)
        SELECT path AS image_id, h AS height, CAST(64 AS INTEGER) AS width,
          count(*) FILTER (WHERE NOT (l > 0 AND l * l > 4 * s * s * d)) AS black_pixels FROM l GROUP BY path, h""",
    "progress_counts": w(RESP, STATUS) + """SELECT count(*) AS pages_done,
        count(*) FILTER (WHERE status <> 'OK') AS pages_failed FROM st""",
    # The stand-in model is a pure function of the page bytes in the request.
    "transcribe_pages": w(SCANS) + """SELECT stem AS page_id, 'gemini-2.0' AS model, CAST(0 AS INTEGER) AS attempt,
        CAST(1 AS INTEGER) AS n_generations, 'ai' AS message_type, content,
        '{"finish_reason":"STOP"}' AS response_metadata,
        CAST(length(html) // 4 AS BIGINT) AS input_tokens, CAST(length(content) // 4 AS BIGINT) AS output_tokens,
        CAST(NULL AS VARCHAR) AS error
        FROM (SELECT stem, html, '```html' || chr(10) || '<article><header><headline>' ||
          regexp_extract(html, '(?s)<title>(.*?)</title>', 1) || '</headline></header><main>' ||
          regexp_extract(html, '(?s)<article>(.*?)</article>', 1) || '</main></article>' || chr(10) || '```' AS content
          FROM scans)""",
    "corpus": w(DOCS) + f"""SELECT file_name AS filename,
        regexp_extract({file_stem('file_name')}, '{ARTICLE_STEM}', 1) AS issue,
        TRY_CAST(TRY_CAST(regexp_extract({file_stem('file_name')}, '{ARTICLE_STEM}', 2) AS BIGINT) + 1 AS INTEGER) AS page,
        coalesce({meta_value('html', 'title')}, 'Untitled') AS headline,
        {html_to_text('html')} AS txt, html,
        {meta_value('html', 'subtitle')} AS strapline, {meta_value('html', 'author')} AS author,
        {meta_value('html', 'category')} AS category
        FROM docs WHERE {_NAME_OK}""",
}
