"""Registered queries: one per operator of the survey, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the fixture derivations in
:mod:`scanpress.plans.fixtures`) over their whole extent.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanpress.functions import images as img
from scanpress.functions import names as nm
from scanpress.functions import text as tx
from scanpress.functions.markup import article_fields, document_status, strip_fences, with_html_meta
from scanpress.functions.replies import finish_reason
from scanpress.operators import attempts as att
from scanpress.operators import audit, cost, filters
from scanpress.operators.binarize import binarize_scans, bytes_as_images
from scanpress.operators.extract import extract_articles, with_reply_status
from scanpress.operators.naming import name_offset, unique_names
from scanpress.operators.ranking import materialize
from scanpress.operators.requests import build_requests, observe_progress, transcribe_pages
from scanpress.plans import fixtures as fx
from scanpress.plans.articles import articles_from_replies, article_documents
from scanpress.plans.corpus import corpus_rows
from scanpress.session import scratch_path
from scanpress.sources.files import list_article_names, read_article_html, read_responses, read_scans
from scanpress.sources.sinks import write_article_docs, write_corpus, write_files

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the registered queries (ours): prompt, model order, sample.
PROMPT = "Transcribe every article on this newspaper page as HTML."
SYSTEM = "You transcribe scanned newspaper pages."
REQUEST_MODELS = ["gemini-2.0", "claude-3.7"]
SAMPLE_N, SAMPLE_SEED = 16, 7


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fx.read_table(spark, sf_dir, name)


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_reply_status(fx.responses(_t(spark, sf_dir, "pages")))


def _doc_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.doc_articles(_t(spark, sf_dir, "documents"))


def _first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias("line"))


# ---------------------------------------------------------------- names


def q_scan_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.scans(_t(spark, sf_dir, "pages"))
    return s.select("path", "stem", nm.scan_issue("stem").alias("issue"), nm.scan_page("stem").alias("scan_page"))


def q_article_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.article_file_names(_t(spark, sf_dir, "pages"))
    return filters.parse_article_names(f).select("file_name", "issue", "page")


def q_scan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.article_file_names(_t(spark, sf_dir, "pages"))
    return f.select("file_name", nm.scan_key("file_name").alias("scan_key"))


def q_bad_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.bad_names(fx.article_file_names(_t(spark, sf_dir, "pages"))).select("file_name")


# ---------------------------------------------------------------- text


def q_shorten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_lines(spark, sf_dir).select("doc_id", tx.shorten_text("line").alias("short"))


def q_slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.with_headline_slug(_first_lines(spark, sf_dir), "line").select("doc_id", "slug")


def q_html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "pages").select("page_id", tx.html_to_text("html").alias("txt"))


def q_element_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _t(spark, sf_dir, "pages")
    h1 = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    return pages.select("page_id", tx.element_text(h1).alias("heading"))


def q_article_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    arts = extract_articles(_replies(spark, sf_dir))
    return arts.select(
        "page_id", "ordinal", tx.article_text("headline", "strapline", "author_name", "body_html").alias("txt")
    )


# ---------------------------------------------------------------- markup


def _article_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.article_docs(_doc_articles(spark, sf_dir))


def q_html_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_html_meta(_article_docs(spark, sf_dir), "html", "_meta")
    return docs.select("file_name", *article_fields("_meta"), F.size("_meta").cast("long").alias("n_meta"))


def q_article_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_html_meta(_article_docs(spark, sf_dir), "html", "_meta")
    f = article_fields("_meta")
    md = tx.article_markdown(f[0], f[1], f[2], tx.html_to_text("html"))
    return docs.select("file_name", md.alias("markdown"))


def q_article_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = article_documents(articles_from_replies(fx.responses(_t(spark, sf_dir, "pages"))))
    return docs.select("file_name", "html")


def q_strip_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fx.responses(_t(spark, sf_dir, "pages"))
    return r.select("page_id", strip_fences("content").alias("markup"))


def q_finish_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fx.responses(_t(spark, sf_dir, "pages"))
    return r.select("page_id", "response_metadata", finish_reason("response_metadata").alias("finish_reason"))


def q_response_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replies(spark, sf_dir).select("page_id", "model", "n_articles", "status")


def q_image_base64(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.scans(_t(spark, sf_dir, "pages"))
    return s.select("path", img.image_data_url("content").alias("data_url"))


def q_build_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.scans(_t(spark, sf_dir, "pages")).withColumnRenamed("stem", "page_id")
    return build_requests(s, PROMPT, REQUEST_MODELS, SYSTEM)


# ---------------------------------------------------------------- generator, filters


def q_extract_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_articles(_replies(spark, sf_dir))


def q_extract_articles_irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_articles(with_reply_status(fx.irregular_responses(_t(spark, sf_dir, "pages"))))


def q_malformed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_articles(with_reply_status(fx.malformed_responses(_t(spark, sf_dir, "pages"))))


def q_malformed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-14 and FLT-2 over replies with stray markup and replies whose articles cannot be read."""
    checked = with_reply_status(fx.malformed_responses(_t(spark, sf_dir, "pages")))
    # Read twice below, parsed once.
    replies = materialize(checked.select("page_id", "model", "attempt", "finish_reason", "status", "n_articles"), "checked-replies")
    aside = filters.quarantine(replies).select("page_id", "model", "attempt", "reason")
    return replies.select("page_id", "model", "attempt", "n_articles").join(aside, ["page_id", "model", "attempt"], "left")


def q_accepted_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.accepted(_replies(spark, sf_dir)).select("page_id", "finish_reason")


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.quarantine(_replies(spark, sf_dir))


def q_valid_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.valid_scans(fx.scans(_t(spark, sf_dir, "pages"))).select("path", "image_kind", "valid")


# ---------------------------------------------------------------- joins and sets


def _existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.existing_article_names(_t(spark, sf_dir, "labels"))


def q_missing_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.scans(_t(spark, sf_dir, "pages")).select("path", "stem")
    return audit.natural_sort(audit.missing_scans(s, _existing(spark, sf_dir)), "path")


def q_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distinct_keys(_existing(spark, sf_dir))


def q_price_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = fx.usage(_t(spark, sf_dir, "conversations"))
    priced = cost.price_usage(u, cost.prices_frame(spark))
    return priced.select(
        "conv_id",
        "turn",
        "model",
        "price_status",
        (F.coalesce("input_tokens", F.lit(0)).cast("decimal(18,0)") * F.col("input_cost_per_token"))
        .cast(cost.MONEY_TYPE)
        .alias("input_cost"),
        (F.coalesce("output_tokens", F.lit(0)).cast("decimal(18,0)") * F.col("output_cost_per_token"))
        .cast(cost.MONEY_TYPE)
        .alias("output_cost"),
    )


def _slugged_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.with_headline_slug(_doc_articles(spark, sf_dir))


def q_unique_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Project before naming: the ranking writes its input once, so keep it narrow.
    return unique_names(_slugged_docs(spark, sf_dir).select("page_id", "ordinal", "slug")).select(
        "page_id", "ordinal", "slug", "file_name"
    )


def q_name_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _slugged_docs(spark, sf_dir).select("page_id", "ordinal", "slug")
    labels = _t(spark, sf_dir, "labels").filter(F.col("quality") == 1).select(F.col("doc_id").cast("int").alias("ordinal"))
    # Names a previous run wrote: the plain names of the documents labelled good.
    written = unique_names(docs).join(labels, "ordinal", "left_semi")
    return name_offset(docs, written.select("file_name")).select("page_id", "ordinal", "slug", "file_name")


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _t(spark, sf_dir, "labels")
    return att.union_attempts(fx.attempts_primary(labels), fx.attempts_fallback(labels))


def q_union_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attempts(spark, sf_dir)


# ---------------------------------------------------------------- aggregates


def _usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.usage(_t(spark, sf_dir, "conversations"))


def q_cost_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost.cost_by_model(_usage(spark, sf_dir), cost.prices_frame(spark))


def q_total_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost.total_cost(cost.cost_by_model(_usage(spark, sf_dir), cost.prices_frame(spark)))


def q_first_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return att.first_success(_attempts(spark, sf_dir))


def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.run_summary(_replies(spark, sf_dir))


def q_failure_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.failure_reasons(_replies(spark, sf_dir))


# ---------------------------------------------------------------- sort, sample


def q_natural_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fx.article_file_names(_t(spark, sf_dir, "pages")).select("file_name")
    return audit.natural_sort(f, "file_name")


def q_sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id", "source")
    return audit.sample_n(docs, SAMPLE_N, SAMPLE_SEED, "doc_id")


# ---------------------------------------------------------------- sinks, sources, hooks


def q_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2 then SNK-1: article documents written, read back, turned into the corpus table."""
    docs_path = scratch_path(spark, "article-docs")
    write_article_docs(_article_docs(spark, sf_dir), docs_path)
    corpus_path = scratch_path(spark, "corpus")
    write_corpus(corpus_rows(spark.read.parquet(docs_path)), corpus_path)
    return spark.read.parquet(corpus_path)


def q_article_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2 as one file per article, SRC-1 reading them back, then the corpus table."""
    folder = scratch_path(spark, "article-files")
    docs = _article_docs(spark, sf_dir).withColumn("_shard", F.regexp_extract("page_id", r"_([0-9]+)-", 1))
    write_files(docs, folder, "file_name", "html", subdir="_shard").write.format("noop").mode("overwrite").save()
    return corpus_rows(read_article_html(spark, folder).select("file_name", "html"))


def q_scan_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2 (flat scan listing, bytes) and SRC-3 (recursive name listing) over files Spark wrote."""
    folder = scratch_path(spark, "scan-files")
    s = fx.scans(_t(spark, sf_dir, "pages")).withColumn("_name", F.concat("stem", F.lit(".jpg")))
    write_files(s, f"{folder}/scans", "_name", "content").write.format("noop").mode("overwrite").save()
    listed = read_scans(spark, f"{folder}/scans").select("stem", "length")
    names = list_article_names(spark, folder).select(F.col("file_name").alias("listed_name"))
    return listed.join(names, F.concat(listed["stem"], F.lit(".jpg")) == names["listed_name"], "left")


def q_read_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-4: reply records written as JSON lines and read back with the declared schema."""
    folder = scratch_path(spark, "reply-json")
    fx.responses(_t(spark, sf_dir, "pages")).write.json(folder)
    return read_responses(spark, folder, fmt="json")


def q_reader_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-6 reader form (names as written, ``<head>`` only) with SC-7 fields."""
    docs = with_html_meta(_article_docs(spark, sf_dir), "html", "_meta", lower_names=False, head_only=True)
    return docs.select("file_name", *article_fields("_meta"), document_status("html").alias("status"))


def q_malformed_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC-6 over documents whose head holds stray markup."""
    stray = F.concat(F.lit("<head>"), *[F.lit(x) for x in fx.STRAY_MARKUP])
    docs = _article_docs(spark, sf_dir).withColumn("html", F.replace("html", F.lit("<head>"), stray))
    docs = with_html_meta(docs, "html", "_meta", lower_names=False, head_only=True)
    return docs.select("file_name", *article_fields("_meta"))


def _stub_model(record: dict) -> dict:
    """Deterministic stand-in for a vision model: it 'reads' the page bytes in the request."""
    request = json.loads(record["request_json"])
    url = request["messages"][-1]["content"][0]["image_url"]["url"]
    import base64

    page = base64.b64decode(url.split(",", 1)[1]).decode("utf-8", "replace")
    title = re.search(r"<title>(.*?)</title>", page, re.S)
    if title is None:
        msg = "no title on page"
        raise ValueError(msg)
    body = re.search(r"<article>(.*?)</article>", page, re.S)
    content = (
        f"```html\n<article><header><headline>{title.group(1)}</headline></header>"
        f"<main>{body.group(1) if body else ''}</main></article>\n```"
    )
    return {
        "n_generations": 1,
        "message_type": "ai",
        "content": content,
        "response_metadata": '{"finish_reason":"STOP"}',
        "input_tokens": len(page) // 4,
        "output_tokens": len(content) // 4,
    }


def q_transcribe_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.scans(_t(spark, sf_dir, "pages")).withColumnRenamed("stem", "page_id")
    requests = build_requests(s, PROMPT, REQUEST_MODELS[:1], SYSTEM)
    return transcribe_pages(requests, _stub_model, parallelism=8)


def _page_of_scan(record: dict) -> tuple[int, str]:
    """(number, html) of the page a scan image of the fixture carries."""
    import base64
    import struct

    url = json.loads(record["request_json"])["messages"][-1]["content"][0]["image_url"]["url"]
    image = base64.b64decode(url.split(",", 1)[1])
    at = image.index(b"tEXt")
    (size,) = struct.unpack_from(">I", image, at - 4)
    first, html = image[at + 4 : at + 4 + size].decode().split("\n", 1)
    return int(first.removeprefix("page=")), html


def _stub_models(record: dict) -> dict:
    """Two stand-in models: the first fails on half the pages (an error, or a cut reply), the second on an eighth."""
    page, html = _page_of_scan(record)
    first = record["model"] == REQUEST_MODELS[0]
    if page % 8 == 1 or first and page % 4 == 1:
        msg = "rate limited"
        raise RuntimeError(msg)
    title = re.search(r"<title>(.*?)</title>", html, re.S)
    return {
        "n_generations": 1,
        "message_type": "ai",
        "content": f"```html\n<article><headline>{title.group(1) if title else ''}</headline><main><p>{page}</p></main></article>\n```",
        "response_metadata": json.dumps({"finish_reason": "MAX_TOKENS" if first and page % 4 == 2 else "STOP"}),
        "input_tokens": len(html),
        "output_tokens": page,
    }


def _scan_job(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    from scanpress.plans.transcription import scans_to_documents

    folder, out = scratch_path(spark, "scan-images"), scratch_path(spark, "scan-job")
    images = fx.scan_images(_t(spark, sf_dir, "pages"))
    write_files(images, folder, "name", "content", subdir="folder").write.format("noop").mode("overwrite").save()
    return scans_to_documents(
        spark, [f"{folder}/left", f"{folder}/right"], out, _stub_models, REQUEST_MODELS, PROMPT, SYSTEM, parallelism=8, calls_per_task=64
    )


def q_scans_to_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2, FLT-3, SC-17, UDF-1, AG-3, GEN-1, JN-3, SNK-2: scan files to committed documents, in rounds of models."""
    docs = _scan_job(spark, sf_dir)["documents"]
    return docs.select(F.element_at(F.split("path", "/"), -2).alias("folder"), "page_id", "model", "attempt", "ordinal", "file_name", "html")


def q_scan_job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-4, UDF-2, FLT-2, AG-2 of the same job: one row per reason of failure, with the totals of the job."""
    job = _scan_job(spark, sf_dir)
    reasons = job["failed"].groupBy("reason").agg(F.count(F.lit(1)).alias("pages"), F.sum("attempts").alias("attempts"))
    totals = []
    for frame in (job["progress"], job["total_cost"].select("total_cost"), job["summary"].select("articles", "replies")):
        row = frame.first()  # one row each
        totals += [F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in frame.schema.fields]
    return reasons.select("*", *totals)


def q_image_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = filters.valid_scans(fx.image_scans(_t(spark, sf_dir, "pages")))
    return checked.select("path", "image_kind", "valid", F.octet_length("content").cast("long").alias("bytes"))


def q_progress_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed, observation = observe_progress(_replies(spark, sf_dir))
    observed.write.format("noop").mode("overwrite").save()
    counts = observation.get
    return spark.createDataFrame([(int(counts["pages_done"]), int(counts["pages_failed"]))], "pages_done long, pages_failed long")


def q_binarize_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.scans(_t(spark, sf_dir, "pages"))
    return binarize_scans(bytes_as_images(s, "path", "content")).select("image_id", "height", "width", "black_pixels")


def q_stream_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scanpress.streaming.replies import stream_articles

    source = scratch_path(spark, "reply-files")
    fx.responses(_t(spark, sf_dir, "pages")).repartition(4).write.parquet(source)
    out, ckpt = scratch_path(spark, "stream-articles"), scratch_path(spark, "stream-articles-ckpt")
    stream_articles(spark, source, out, ckpt, max_files_per_trigger=1)
    return spark.read.parquet(out)


def q_stream_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scanpress.streaming.replies import latest_costs, stream_cost

    source = scratch_path(spark, "usage-files")
    _usage(spark, sf_dir).select("model", "input_tokens", "output_tokens").repartition(4).write.parquet(source)
    out, ckpt = scratch_path(spark, "stream-cost"), scratch_path(spark, "stream-cost-ckpt")
    stream_cost(spark, source, out, ckpt, max_files_per_trigger=1)
    return latest_costs(spark, out, cost.prices_frame(spark))


def q_stream_named_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from scanpress.streaming.replies import stream_named_articles

    source = scratch_path(spark, "named-reply-files")
    fx.responses(_t(spark, sf_dir, "pages")).repartition(4).write.parquet(source)
    out, ckpt = scratch_path(spark, "stream-named"), scratch_path(spark, "stream-named-ckpt")
    stream_named_articles(spark, source, out, ckpt)
    return spark.read.parquet(out).select("file_name", "page_id", "ordinal", "slug")


def q_stream_named_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-1 with names over four micro-batches, each holding every page again: names go on where the last batch ended."""
    from scanpress.streaming.replies import stream_named_articles

    source = scratch_path(spark, "named-batches")
    replies = fx.responses(_t(spark, sf_dir, "pages"))
    for attempt in range(4):
        replies.withColumn("attempt", F.lit(attempt)).repartition(1).write.mode("append").parquet(source)
    out, ckpt = scratch_path(spark, "stream-batches"), scratch_path(spark, "stream-batches-ckpt")
    stream_named_articles(spark, source, out, ckpt, max_files_per_trigger=1)
    return spark.read.parquet(out).select("file_name", "page_id", "attempt", "ordinal", "slug", "batch_id")


QUERIES: dict[str, Query] = {
    "scan_names": q_scan_names,
    "article_names": q_article_names,
    "scan_keys": q_scan_keys,
    "bad_names": q_bad_names,
    "shorten": q_shorten,
    "slugify": q_slugify,
    "html_meta": q_html_meta,
    "html_to_text": q_html_to_text,
    "article_text": q_article_text,
    "article_markdown": q_article_markdown,
    "article_html": q_article_html,
    "strip_fences": q_strip_fences,
    "finish_reason": q_finish_reason,
    "response_status": q_response_status,
    "element_text": q_element_text,
    "image_base64": q_image_base64,
    "build_requests": q_build_requests,
    "extract_articles": q_extract_articles,
    "extract_articles_irregular": q_extract_articles_irregular,
    "malformed_articles": q_malformed_articles,
    "malformed_status": q_malformed_status,
    "malformed_meta": q_malformed_meta,
    "accepted_replies": q_accepted_replies,
    "quarantine": q_quarantine,
    "valid_scans": q_valid_scans,
    "missing_scans": q_missing_scans,
    "price_usage": q_price_usage,
    "name_offset": q_name_offset,
    "distinct_keys": q_distinct_keys,
    "union_attempts": q_union_attempts,
    "cost_by_model": q_cost_by_model,
    "total_cost": q_total_cost,
    "first_success": q_first_success,
    "run_summary": q_run_summary,
    "failure_reasons": q_failure_reasons,
    "unique_names": q_unique_names,
    "natural_sort": q_natural_sort,
    "sample_n": q_sample_n,
    "corpus": q_corpus,
    "article_files": q_article_files,
    "scan_listing": q_scan_listing,
    "read_responses": q_read_responses,
    "reader_meta": q_reader_meta,
    "transcribe_pages": q_transcribe_pages,
    "scans_to_documents": q_scans_to_documents,
    "scan_job_report": q_scan_job_report,
    "image_scans": q_image_scans,
    "progress_counts": q_progress_counts,
    "binarize_scans": q_binarize_scans,
    "stream_articles": q_stream_articles,
    "stream_cost": q_stream_cost,
    "stream_named_articles": q_stream_named_articles,
    "stream_named_batches": q_stream_named_batches,
}
