"""Input tables derived from the driver's tables (FIXTURES.md §2).

The driver ships generic tables (``pages``, ``documents``, ``conversations``,
``labels``); these functions derive, with plain column expressions only,
the scan, reply, usage, attempt and article-document tables our operators
work on.  Every row of the source becomes a row here, so the work grows with
the tables.  ``scanpress.plans.oracle`` derives the same tables in SQL.
"""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanpress.functions.markup import article_html
from scanpress.functions.text import escape_text, with_headline_slug
from scanpress.operators.naming import unique_names
from scanpress.schemas import MODELS
from scanpress.session import spread

# Fixed fixture values (ours): reply metadata forms, authors, categories.
METADATA_FORMS = [
    '{"finish_reason":"STOP"}',
    '{"stop_reason":"end_turn"}',
    '{"finish_reason":"","stop_reason":"stop"}',
    '{"finish_reason":"STOP","safety_ratings":[]}',
    '{"finish_reason":"MAX_TOKENS"}',
    '{"stop_reason":"end_turn","stop_sequence":null}',
    '{"prompt_feedback":{"block_reason":"SAFETY"}}',
    '{"finish_reason":"stop"}',
    '{"prompt_feedback":{"block_reason":0}}',
    "{}",
]
AUTHORS = ["", "Ada Byron", "Alan Turing", 'Smith & "Jones"', "José Núñez", "Grace <Hopper>", "Émile Zola"]
CATEGORIES = ["News", "Comment", "Science", "Sport"]
UNKNOWN_MODEL = "gemini-9"


# Tables whose rows carry long text that per-row regex work follows (conversations only feed text lengths).
TEXT_TABLES = frozenset({"pages", "documents"})


# more rows than the small test files hold); copies get ids offset by this.
REPLICATE_CONF = "scanpress.bench.replicate"
ID_COLUMNS = ("page_id", "doc_id", "conv_id")
COPY_OFFSET = 10_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; text tables are spread over the cores when the file gives too few splits."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name in TEXT_TABLES:
        df = spread(df)
    copies = int(spark.conf.get(REPLICATE_CONF, "1"))
    if copies > 1:
        df = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        for col in ID_COLUMNS:
            if col in df.columns:
                df = df.withColumn(col, F.col(col) + F.col("_copy").cast("long") * F.lit(COPY_OFFSET))
        df = df.drop("_copy")
    return df


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def scan_stem(n: Column | str) -> Column:
    """``gazette_<1000 + n div 8>-<n mod 8, 3 digits>``: eight pages per issue."""
    n = F.col(n) if isinstance(n, str) else n
    return F.concat(
        F.lit("gazette_"),
        (F.lit(1000) + F.floor(n / 8)).cast("string"),
        F.lit("-"),
        F.lpad((n % 8).cast("string"), 3, "0"),
    )


# ---------------------------------------------------------------- F1 / F2 replies


def responses(pages: DataFrame) -> DataFrame:
    """one model reply per page, in the shapes models return."""
    pid = F.col("page_id")
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    body = F.regexp_extract("html", r"(?s)<article>(.*?)</article>", 1)
    strapline = (
        F.when(pid % 3 == 0, F.lit("<strapline></strapline>"))
        .when(
            pid % 3 == 1,
            F.concat(
                F.lit("<strapline>Issue "),
                (F.lit(1000) + F.floor(pid / 8)).cast("string"),
                F.lit(", page "),
                (pid % 8 + 1).cast("string"),
                F.lit("</strapline>"),
            ),
        )
        .otherwise(F.lit(""))
    )
    author = F.when(pid % 7 == 0, F.lit("")).otherwise(
        F.concat(F.lit("<author_name>"), F.regexp_replace(_pick(AUTHORS, pid % 7), "[<>&]", ""), F.lit("</author_name>"))
    )
    category = F.when(pid % 5 == 4, F.lit("")).otherwise(
        F.concat(F.lit("<category>"), _pick(CATEGORIES, pid % 4), F.lit("</category>"))
    )
    first = F.concat(
        F.lit("<article><header><headline>"), title, F.lit("</headline>"), strapline, author, category,
        F.lit("</header><main>"), body, F.lit("</main></article>"),
    )
    second = F.when(
        pid % 2 == 0,
        F.concat(
            F.lit("<article><header><headline></headline></header><main><p>Continued from page "),
            (pid % 8).cast("string"),
            F.lit(".</p></main></article>"),
        ),
    ).otherwise(F.lit(""))
    articles = F.concat(first, second)
    content = (
        F.when(pid % 29 == 28, F.lit(None).cast("string"))
        .when(pid % 19 == 18, F.lit("I could not find any articles on this page."))
        .when(pid % 4 == 0, F.concat(F.lit("Here:\n```html\n"), articles, F.lit("\n```")))
        .when(
            pid % 4 == 1,
            F.concat(F.lit('```xml\n<?xml version="1.0" encoding="UTF-8"?>\n'), articles, F.lit("\n```")),
        )
        .when(pid % 4 == 2, F.concat(F.lit("Here are the articles.\n```\n"), articles, F.lit("\n```\nDone.")))
        .otherwise(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n'), articles))
    )
    no_usage = pid % 23 == 22
    return pages.select(
        scan_stem(pid).alias("page_id"),
        _pick(MODELS, pid % 6).alias("model"),
        F.lit(0).alias("attempt"),
        F.when(pid % 13 == 12, F.lit(2)).otherwise(F.lit(1)).alias("n_generations"),
        F.when(pid % 17 == 16, F.lit("human")).otherwise(F.lit("ai")).alias("message_type"),
        content.alias("content"),
        _pick(METADATA_FORMS, pid % 10).alias("response_metadata"),
        F.when(~no_usage, F.lit(258) + F.floor(F.length("html") / 4)).cast("long").alias("input_tokens"),
        F.when(~no_usage, F.floor(F.length(articles) / 4)).cast("long").alias("output_tokens"),
    )


def irregular_responses(pages: DataFrame) -> DataFrame:
    """F1 with its article tags written in capitals and with attributes, as some models answer.

    Regular expressions cannot read these safely, so extraction takes the
    parser path; its articles must equal those of :func:`responses`.
    """
    replies = responses(pages)
    content = F.replace(
        F.replace(F.col("content"), F.lit("<article>"), F.lit('<Article data-kind="news">')),
        F.lit("</article>"),
        F.lit("</ARTICLE>"),
    )
    return replies.withColumn("content", content)


# Markup that no declaration, comment or tag explains, in front of an article.
STRAY_MARKUP = ["<![1]>", "<![ x]]>", "<![foo[>", "<!>", "</ >"]
NESTED = 3000


def malformed_responses(pages: DataFrame) -> DataFrame:
    """F1 with stray markup before every article, and articles nested thousands deep on every sixth page.

    The stray markup changes no article.  The nested articles' bodies would be far longer than the reply together, so
    those replies are set aside as ``PARSE_ERROR``.
    """
    replies = responses(pages).withColumn("_n", F.regexp_extract("page_id", r"_([0-9]+)-", 1).cast("int") * 8)
    pid = F.col("_n") - 8000 + F.right("page_id", F.lit(3)).cast("int")
    before = F.when(pid % 6 == 5, F.repeat(F.lit("<article><main>"), NESTED)).otherwise(_pick(STRAY_MARKUP, pid % 5))
    content = F.replace(F.col("content"), F.lit("<article>"), F.concat(before, F.lit("<article>")))
    return replies.withColumn("content", content).drop("_n")


# ---------------------------------------------------------------- scans and names


def scans(pages: DataFrame) -> DataFrame:
    """Scan files, one per page: ``path``, ``stem``, ``content`` (the page bytes)."""
    pid = F.col("page_id")
    stem = (
        F.when(
            pid % 11 == 10,
            F.concat(
                F.lit("gazette-daily-2011_"), F.floor(pid / 8).cast("string"), F.lit("-"), (pid % 8).cast("string")
            ),
        )
        .when(pid % 13 == 12, F.concat(F.lit("gazette_"), pid.cast("string"), F.lit("-x")))
        .otherwise(scan_stem(pid))
    )
    return pages.select(
        pid.alias("scan_id"),
        F.concat(F.lit("scans/"), stem, F.lit(".jpg")).alias("path"),
        stem.alias("stem"),
        F.col("html").cast("binary").alias("content"),
    )


def _png_chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


PNG_HEAD = b"\x89PNG\r\n\x1a\n" + _png_chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0))
PNG_TAIL = _png_chunk(b"IDAT", zlib.compress(b"\x00\x80")) + _png_chunk(b"IEND", b"")


def scan_images(pages: DataFrame) -> DataFrame:
    """Scan files in two folders that share names: PNG images that carry their page as a text chunk, every tenth cut short."""
    pid = F.col("page_id")
    text = F.concat(F.lit(b"tEXt"), F.concat(F.lit("page="), pid.cast("string"), F.lit("\n"), F.col("html")).cast("binary"))

    def word(x: Column) -> Column:
        return F.unhex(F.lpad(F.hex(x), 8, "0"))

    whole = F.concat(F.lit(PNG_HEAD), word(F.octet_length(text) - 4), text, word(F.crc32(text)), F.lit(PNG_TAIL))
    cut = F.substring(whole, F.lit(1), F.octet_length(whole) - 6)
    return pages.select(
        F.when(pid % 2 == 0, F.lit("left")).otherwise(F.lit("right")).alias("folder"),
        F.concat(scan_stem(F.floor(pid / 2)), F.lit(".png")).alias("name"),
        F.when(pid % 10 == 9, cut).otherwise(whole).alias("content"),
    )


def image_files() -> dict[str, bytes]:
    """A whole file of each format, as small as its container allows."""
    jpeg = (
        b"\xff\xd8\xff\xe0\x00\x10JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00\xff\xc0\x00\x0b\x08\x00\x01\x00\x01\x01\x01\x11\x00"
        b"\xff\xda\x00\x08\x01\x01\x00\x00\x3f\x00\x12\xff\x00\x34\xff\xd0\x56\xff\xd9"
    )
    gif = b"GIF89a\x01\x00\x01\x00\x80\x00\x00\x00\x00\x00\xff\xff\xff!\xfe\x02hi\x00,\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02D\x01\x00;"
    vp8l = b"VP8L" + struct.pack("<I", 5) + b"\x2f\x00\x00\x00\x00\x00"
    webp = b"RIFF" + struct.pack("<I", 4 + len(vp8l)) + b"WEBP" + vp8l
    entries = [(256, 3, 1, 1), (257, 3, 1, 1), (273, 4, 1, 8), (279, 4, 1, 1)]
    tiff = b"II*\x00" + struct.pack("<I", 10) + b"\x80\x00" + struct.pack("<H", len(entries))
    tiff += b"".join(struct.pack("<HHII", *e) for e in entries) + struct.pack("<I", 0)
    bmp = b"BM" + struct.pack("<IHHI", 58, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + b"\x00" * 4
    return {"png": PNG_HEAD + PNG_TAIL, "jpeg": jpeg, "gif": gif, "webp": webp, "tiff": tiff, "bmp": bmp, "unknown": b"<html>none</html>"}


def image_scans(pages: DataFrame) -> DataFrame:
    """Images of all seven kinds, one per page: whole, followed by the page's bytes, cut short, or with a changed byte."""
    pid = F.col("page_id")
    files = list(image_files().values())
    whole = F.element_at(F.array(*[F.lit(x) for x in files]), (pid % len(files) + 1).cast("int"))
    short = F.substring(whole, F.lit(1), F.octet_length(whole) - 1 - (pid % 3).cast("int"))
    n = F.octet_length(whole)
    changed = F.concat(F.substring(whole, F.lit(1), n - 13), F.unhex(F.lit("00")), F.substring(whole, n - 11, F.lit(12)))
    content = (
        F.when(pid % 4 == 0, whole)
        .when(pid % 4 == 1, F.concat(whole, F.col("html").cast("binary")))
        .when(pid % 4 == 2, short)
        .otherwise(changed)
    )
    return pages.select(F.concat(F.lit("images/"), pid.cast("string")).alias("path"), content.alias("content"))


def article_file_names(pages: DataFrame) -> DataFrame:
    """article file names, some not following the naming contract."""
    pid = F.col("page_id")
    issue = (F.lit(1000) + F.floor(pid / 8)).cast("string")
    name = (
        F.when(pid % 11 == 10, F.concat(F.lit("gazette_"), issue, F.lit(".html")))
        .when(pid % 11 == 9, F.concat(F.lit("gazette_"), pid.cast("string"), F.lit("-1-2_x.html")))
        .when(
            pid % 11 == 8,
            F.concat(
                F.lit("gazette-daily-2011_"), F.floor(pid / 8).cast("string"), F.lit("-"),
                (pid % 8).cast("string"), F.lit("_x.html"),
            ),
        )
        .when(pid % 11 == 7, F.concat(F.lit("a_"), pid.cast("string"), F.lit(".html")))
        .otherwise(F.concat(scan_stem(pid), F.lit("_article-"), (pid % 5).cast("string"), F.lit(".html")))
    )
    return pages.select(pid.alias("file_id"), name.alias("file_name"))


def existing_article_names(labels: DataFrame) -> DataFrame:
    """names of articles already written, one per labelled document id."""
    did = F.col("doc_id")
    name = F.when(did % 9 == 8, F.concat(F.lit("a_"), did.cast("string"), F.lit(".html"))).otherwise(
        F.concat(scan_stem(did), F.lit("_x"), F.col("quality").cast("string"), F.lit(".html"))
    )
    return labels.select(name.alias("file_name"))


# ---------------------------------------------------------------- F5 usage / F6 attempts


def usage(conversations: DataFrame) -> DataFrame:
    """one usage record per conversation turn (input = user/system text, output = assistant text)."""
    cid, turn = F.col("conv_id"), F.col("turn")
    size = F.length("text").cast("long")
    is_out = F.col("role") == "assistant"
    no_usage = (cid + turn) % 31 == 30
    model = F.when(cid % 37 == 36, F.lit(UNKNOWN_MODEL)).otherwise(_pick(MODELS, cid % 6))
    return conversations.select(
        cid.alias("conv_id"),
        turn.alias("turn"),
        model.alias("model"),
        F.when(~no_usage, F.when(is_out, F.lit(0)).otherwise(size)).cast("long").alias("input_tokens"),
        F.when(~no_usage, F.when(is_out, size).otherwise(F.lit(0))).cast("long").alias("output_tokens"),
    )


def attempts_primary(labels: DataFrame) -> DataFrame:
    """F6, attempt 0: the primary model; ``quality = 1`` means it succeeded."""
    ok = F.col("quality") == 1
    return labels.select(
        scan_stem("doc_id").alias("page_id"),
        F.lit(0).alias("attempt"),
        F.lit("gemini-2.0").alias("model"),
        ok.alias("ok"),
        F.when(ok, F.lit("OK")).otherwise(F.lit("BAD_FINISH:MAX_TOKENS")).alias("status"),
    )


def attempts_fallback(labels: DataFrame) -> DataFrame:
    """F6, attempt 1: the fallback model; ``toxic = 0`` means it succeeded."""
    ok = F.col("toxic") == 0
    return labels.select(
        scan_stem("doc_id").alias("page_id"),
        F.lit(1).alias("attempt"),
        F.lit("claude-3.7").alias("model"),
        ok.alias("ok"),
        F.when(ok, F.lit("OK")).otherwise(F.lit("NO_ARTICLES")).alias("status"),
    )


# ---------------------------------------------------------------- F7 article documents


def doc_articles(documents: DataFrame) -> DataFrame:
    """one article per document: headline = first line, body = the other lines as paragraphs."""
    did = F.col("doc_id")
    first_line = F.substring_index("text", "\n", 1)
    rest = F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)")
    body = F.concat(F.lit("<p>"), F.replace(escape_text(rest), F.lit("\n"), F.lit("</p><p>")), F.lit("</p>"))
    page_no = (F.lit(1000) + F.regexp_extract("source", r"([0-9]+)$", 1).try_cast("int")).cast("string")
    return documents.select(
        F.concat(F.lit("gazette_"), page_no, F.lit("-"), F.lpad((did % 8).cast("string"), 3, "0")).alias("page_id"),
        did.cast("int").alias("ordinal"),
        F.coalesce(F.when(first_line != "", first_line), F.lit("Untitled")).alias("headline"),
        F.when(did % 3 == 1, F.lit("")).when(did % 3 == 2, F.concat("lang", F.lit(" edition"))).alias("strapline"),
        F.when(did % 4 != 0, _pick(AUTHORS[1:], did % 6)).alias("author_name"),
        F.when(did % 5 != 4, _pick(CATEGORIES, did % 4)).alias("category"),
        body.alias("body_html"),
    )


def article_docs(articles: DataFrame) -> DataFrame:
    """Articles to named HTML documents: slug, unique name (WN-1), document (SC-11)."""
    named = unique_names(with_headline_slug(articles))
    return named.select(
        "page_id",
        "ordinal",
        "file_name",
        "slug",
        article_html("headline", "strapline", "author_name", "slug", "category", "body_html").alias("html"),
    )
