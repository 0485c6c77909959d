"""Article documents to the corpus table (SC-2, FLT-4, SC-6, SC-7, SC-8, SNK-1).

One narrow stage: no shuffle and no gather.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanpress.functions.markup import article_fields, with_html_meta
from scanpress.functions.names import article_issue, article_name_ok, article_page
from scanpress.functions.text import html_to_text


def corpus_rows(docs: DataFrame, name: str = "file_name", html: str = "html") -> DataFrame:
    """Corpus columns for documents whose names follow the contract (the rest: ``bad_names``)."""
    good = with_html_meta(docs.filter(article_name_ok(name)), html, "_meta")
    fields = article_fields("_meta")
    return good.select(
        F.col(name).alias("filename"),
        article_issue(name).alias("issue"),
        article_page(name).alias("page"),
        fields[0],
        html_to_text(html).alias("txt"),
        F.col(html).alias("html"),
        *fields[1:],
    )


def build_corpus(
    spark,  # noqa: ANN001
    html_dir: str,
    out_path: str,
    sample_size: int = 0,
    seed: int = 0,
    bad_names_path: str | None = None,
    partition_by: str | None = None,
) -> None:
    """Folder of article HTML files -> corpus Parquet (the reference's corpus script, as one Spark job).

    ``sample_size`` > 0 keeps a deterministic sample of that many files
    (0, or a size at least the number of files, keeps all).  Names that
    break the contract go to ``bad_names_path`` instead of stopping the job.
    """
    from scanpress.operators.audit import sample_n
    from scanpress.operators.filters import bad_names
    from scanpress.sources.files import read_article_html
    from scanpress.sources.sinks import write_corpus

    files = read_article_html(spark, html_dir)
    if files.isEmpty():
        # A missing folder already raised; an empty one is reported and nothing is written.
        warnings.warn(f"no *.html files below {html_dir}; corpus not written", stacklevel=2)
        return
    if sample_size:
        files = sample_n(files, sample_size, seed, "path").drop("sample_key")
    if bad_names_path:
        bad_names(files).select("file_name", "path").write.mode("overwrite").parquet(bad_names_path)
    write_corpus(corpus_rows(files), out_path, partition_by=partition_by)
