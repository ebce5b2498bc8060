"""User-function hooks: a text encoder (V01) and a pair scorer (V09), run as Arrow-batched Python.

The encoder sees texts already cleaned and truncated by built-in expressions and receives them in batches
packed to a token budget, as the reference sends them to its embedding service; it is created once per
Python worker (e.g. a model loaded from a file), not once per batch or per group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.text import CHARS_PER_TOKEN, MAX_BATCH_TOKENS, clean_for_embedding, truncate_for_model
from tidings.operators.ranking import prefix_row_number

Encoder = Callable[[list[str]], Sequence[Sequence[float]]]
Scorer = Callable[[list[str], list[str]], Sequence[float]]


def _token_batches(texts: list[str], budget: int, cpt: float) -> Iterator[list[int]]:
    """Row indices grouped by the token-budget rule (a new batch when the sum would exceed the budget)."""
    batch, cur = [], 0
    for i, t in enumerate(texts):
        tok = max(1, int(math.ceil(len(t) / cpt)))
        if batch and cur + tok > budget:
            yield batch
            batch, cur = [], 0
        batch.append(i)
        cur += tok
    if batch:
        yield batch


def embed(items: DataFrame, make_encoder: Callable[[], Encoder], *, text_col: str = "text",
          max_batch_tokens: int = MAX_BATCH_TOKENS, max_item_chars: int | None = None,
          chars_per_token: float = CHARS_PER_TOKEN) -> DataFrame:
    """Adds ``embedding array<float>`` computed by the user's encoder. ``make_encoder`` is called once per
    Python worker; texts are cleaned JVM-side, then packed into token-budget batches. An encoder with a length
    limit says so in ``max_item_chars``; without, it gets whole texts."""
    cleaned = clean_for_embedding(F.col(text_col))
    if max_item_chars is not None:
        cleaned = truncate_for_model(cleaned, max_item_chars, max_batch_tokens, chars_per_token)
    prepared = items.withColumn("_etext", cleaned)
    schema = T.StructType(prepared.schema.fields + [T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = make_encoder()
        for pdf in batches:
            texts = pdf["_etext"].fillna("").tolist()
            out: list = [None] * len(texts)
            for idx in _token_batches(texts, max(1, max_batch_tokens), max(0.1, chars_per_token)):
                vecs = enc([texts[i] for i in idx])
                for i, v in zip(idx, vecs):
                    out[i] = [float(x) for x in v]
            pdf = pdf.copy()
            pdf["embedding"] = out
            yield pdf

    return prepared.mapInPandas(run, schema=schema).drop("_etext")


def rerank_with(cands: DataFrame, make_scorer: Callable[[], Scorer], *, key_cols: Sequence[str] = ("cluster_id",),
                id_col: str = "id", query_col: str = "query_text", text_col: str = "text") -> DataFrame:
    """Scores every (query text, candidate text) pair with the user's scorer and ranks candidates per
    cluster by score descending (ties by id). ``cands`` carries the cluster's query text on each row."""
    schema = T.StructType(cands.schema.fields + [T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for pdf in batches:
            pdf = pdf.copy()
            pdf["score"] = [float(x) for x in scorer(pdf[query_col].fillna("").tolist(), pdf[text_col].fillna("").tolist())]
            yield pdf

    scored = cands.mapInPandas(run, schema=schema)
    # ranks come from range partitions, so no task holds a hot cluster; the scores are written once with them
    return prefix_row_number(scored.withColumn("_down", -F.col("score")), list(key_cols), ["_down", id_col], "rank").drop("_down")
