"""Model requests, the transcription hook and progress counts (SC-17, UDF-1, UDF-2)."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.functions.images import image_data_url
from scanpress.schemas import RESPONSES


def build_requests(
    scans: DataFrame, prompt: str, models: list[str], system: str | None = None, keys: tuple[str, ...] = ("page_id",)
) -> DataFrame:
    """SC-17: one chat request per scan and model: system text, then the image and the prompt; ``keys`` name the scan.

    Models come from a literal array exploded per row, so no join is
    planned; the image bytes are encoded once per scan and never shuffled.
    """
    url = image_data_url("content")
    image_part = F.to_json(
        F.named_struct(
            F.lit("type"), F.lit("image_url"), F.lit("image_url"), F.named_struct(F.lit("url"), url)
        )
    )
    text_part = F.to_json(F.named_struct(F.lit("type"), F.lit("text"), F.lit("text"), F.lit(prompt)))
    user = F.concat(
        F.lit('{"role":"user","content":['), image_part, F.lit(","), text_part, F.lit("]}")
    )
    messages = [user]
    if system is not None:
        messages.insert(
            0, F.to_json(F.named_struct(F.lit("role"), F.lit("system"), F.lit("content"), F.lit(system)))
        )
    body = F.concat(F.lit("["), F.concat_ws(",", *messages), F.lit("]"))
    with_models = scans.select(
        *keys, body.alias("_messages"), F.explode(F.array(*[F.lit(m) for m in models])).alias("model")
    )
    model_json = F.to_json(F.struct("model"))
    head = F.expr("substring(_model_json, 1, length(_model_json) - 1)")
    return with_models.withColumn("_model_json", model_json).select(
        *keys,
        "model",
        F.concat(head, F.lit(',"messages":'), F.col("_messages"), F.lit("}")).alias("request_json"),
    )


REPLY_FIELDS = ("n_generations", "message_type", "content", "response_metadata", "input_tokens", "output_tokens")
TRANSCRIPTS = T.StructType([*RESPONSES.fields, T.StructField("error", T.StringType())])


def transcribe_pages(
    requests: DataFrame,
    model_call: Callable[[dict[str, Any]], dict[str, Any]],
    parallelism: int | None = 12,
    attempt: int = 0,
    keys: tuple[str, ...] = ("page_id",),
) -> DataFrame:
    """UDF-1: call ``model_call`` once per request, at most ``parallelism`` calls at a time.

    ``model_call`` receives the request row as a dict and returns the reply
    fields (``content``, ``response_metadata``, token counts, ...).  An
    exception is captured as the row's ``error``: one failed page never
    stops the batch.  ``keys`` are the columns that name the page.

    At most ``parallelism`` tasks call the model at once: partitions are
    merged, which moves no data (requests carry whole images); with None, the
    caller runs no more of its partitions at once.  For many pages
    use :func:`scanpress.plans.transcription.transcribe_scans`, which commits
    the replies of a few calls per task before it asks for more.
    """
    schema = T.StructType([*[requests.schema[k] for k in keys], *[f for f in TRANSCRIPTS.fields if f.name != "page_id"]])

    def run(batches):  # noqa: ANN001, ANN202
        for pdf in batches:
            out = []
            for rec in pdf.to_dict("records"):
                row: dict[str, Any] = {**{k: rec[k] for k in keys}, "model": rec["model"], "attempt": attempt}
                try:
                    reply = model_call(rec)
                    row.update({f: reply.get(f) for f in REPLY_FIELDS})
                    row["error"] = None
                except Exception as exc:  # noqa: BLE001 - the failure is the row's value
                    row.update(dict.fromkeys(REPLY_FIELDS))
                    row["error"] = f"{type(exc).__name__}: {exc}"
                out.append(row)
            frame = pd.DataFrame(out, columns=schema.fieldNames())
            for col in ("n_generations", "attempt"):
                frame[col] = frame[col].astype("Int32")
            for col in ("input_tokens", "output_tokens"):
                frame[col] = frame[col].astype("Int64")
            yield frame

    return (requests if parallelism is None else requests.coalesce(parallelism)).mapInPandas(run, schema)


def observe_progress(df: DataFrame, name: str = "progress") -> tuple[DataFrame, Observation]:
    """UDF-2: counts gathered while the job runs: pages done (failed ones too) and failures.

    Read them with ``observation.get`` after an action on the returned frame.
    """
    observation = Observation(name)
    observed = df.observe(
        observation,
        F.count(F.lit(1)).alias("pages_done"),
        F.count_if(F.col("status") != "OK").alias("pages_failed"),
    )
    return observed, observation
