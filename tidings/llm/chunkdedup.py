"""Exact deduplication by content-defined chunk recipes, as DataFrame functions.

A text without its ASCII whitespace is cut where the content says so (a short character pattern), between
a smallest and a largest chunk length. Distinct chunks travel once, to verify that a chunk identifier stands
for one chunk only; after that a text is its ordered list of identifiers, and only these short lists are
grouped and joined. Long texts are never moved again.

Defined results: a null text counts as empty; empty texts are equal to each other; among equal texts the row
with the most code points in the original text stays, then the smallest id (a null id last); rows that also
share the id are all marked as kept; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.session import cut_lineage

MIN_CHUNK, MAX_CHUNK = 128, 2048
CUT_AFTER = "[a-dA-D0-4à-é][^a-mA-M]"  # content trigger: one pair in about ten
SALTS = 16


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", "")


def chunks_of(norm: Column) -> Column:
    """Whole text as consecutive chunks: up to a trigger after MIN_CHUNK characters, MAX_CHUNK at most."""
    pattern = f"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?<={CUT_AFTER})|.{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))


def chunk_id(c: Column) -> Column:
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit("second"), c).alias("b"))


def ambiguous_ids(chunks: DataFrame) -> DataFrame:
    """Identifiers (a, b) that stand for more than one chunk, found by grouping on the chunks' bytes."""
    distinct = chunks.groupBy("a", "b", "chunk").agg(F.count(F.lit(1)).alias("_n"))
    return distinct.groupBy("a", "b").count().filter("count > 1").select("a", "b")


def recipes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """_id, n_code_points, text_sha256 (normalised), recipe (ordered verified identifiers), as a stage table."""
    base = df.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    chunk = base.select(F.explode(chunks_of(normalised(F.col("_text")))).alias("chunk"))
    chunk = chunk.select(F.xxhash64("chunk").alias("a"), F.xxhash64(F.lit("second"), F.col("chunk")).alias("b"), "chunk")
    verified = ambiguous_ids(chunk).isEmpty()
    norm = base.select("_id", F.length(F.coalesce(F.col("_text"), F.lit(""))).cast("long").alias("n_code_points"),
                       normalised(F.col("_text")).alias("_norm"))
    made = chunks_of(F.col("_norm"))
    # identifiers verified: hash pairs; otherwise the chunks themselves are the identifiers
    recipe = F.transform(made, chunk_id) if verified else made
    return cut_lineage(norm.select("_id", "n_code_points", F.sha2("_norm", 256).alias("text_sha256"), recipe.alias("recipe")))


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, text_sha256."""
    r = recipes(df, key, text)
    best = F.struct((-F.col("n_code_points")).alias("n"), F.col("_id").isNull().alias("z"), F.col("_id").alias("i"))
    groups = r.groupBy("recipe").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("n"))
    # only groups of two or more are joined back; they are dealt over SALTS so that a hot group spreads
    shared = groups.filter("n > 1").select(
        "recipe", F.col("best.i").alias("_keep"), F.col("n").alias("_n"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = r.withColumn("_salt", F.pmod(F.xxhash64("_id", "n_code_points"), F.lit(SALTS)).cast("int"))
    joined = salted.join(shared, ["recipe", "_salt"], "left")
    keep = F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return joined.select(
        F.col("_id").alias(key), keep.alias("keep_id"), F.coalesce(F.col("_n"), F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"), "text_sha256")
