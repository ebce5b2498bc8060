"""Text to dense unit vectors of a fixed width by the hashing trick: no vocabulary, no model, no outside service."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.operators.textvec import TOKEN_SEPARATOR

DIM = 256


def slot_counts(docs: DataFrame, dim: int = DIM, *, id_col: str = "id", text_col: str = "text", group_cols: Sequence[str] = ()) -> DataFrame:
    """``group_cols, id, slot, x``: signed token counts of every slot that does not cancel out.

    A token's md5 gives its slot (first 32 bits modulo ``dim``) and its sign (the next hex digit below 8 or not), so
    the sign makes clashes cancel on average. Counts are combined inside the tasks.
    """
    g = list(group_cols)
    toks = docs.select(*g, id_col, F.explode(F.split(F.lower(F.col(text_col)), TOKEN_SEPARATOR)).alias("_t")).filter("_t <> ''")
    toks = toks.withColumn("_t", F.md5(F.col("_t").cast("binary")))
    slot = F.pmod(F.conv(F.substring("_t", 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int")
    sign = F.when(F.substring("_t", 9, 1) < "8", 1).otherwise(-1).cast("long")
    return toks.groupBy(*g, id_col, slot.alias("slot")).agg(F.sum(sign).alias("x")).filter("x <> 0")


def embed_hashed(docs: DataFrame, dim: int = DIM, *, id_col: str = "id", text_col: str = "text", group_cols: Sequence[str] = ()) -> DataFrame:
    """``group_cols, id, embedding`` (``dim`` doubles of norm 1) of every row; rows that share a group and id are one text.

    A text without tokens (null, empty) has the zero vector, which is similar to nothing. A document moves as at most
    ``dim`` counts, whatever its length.
    """
    g = list(group_cols)
    held = slot_counts(docs, dim, id_col=id_col, text_col=text_col, group_cols=g).groupBy(*g, id_col).agg(
        F.collect_list("slot").alias("_slots"), F.collect_list("x").alias("_x"))
    kept = [f for f in held.schema.fields if f.name not in ("_slots", "_x")]

    def dense(batches):
        for batch in batches:
            slots, x = batch.column("_slots"), batch.column("_x")
            row = np.repeat(np.arange(batch.num_rows), np.diff(slots.offsets.to_numpy()))
            out = np.zeros((batch.num_rows, dim))
            out[row, slots.flatten().to_numpy()] = x.flatten().to_numpy()
            out /= np.sqrt((out * out).sum(1, keepdims=True))
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, dim, dtype=np.int32)), pa.array(out.ravel()))
            yield batch.drop_columns(["_slots", "_x"]).append_column("embedding", values)

    found = held.mapInArrow(dense, T.StructType([*kept, T.StructField("embedding", T.ArrayType(T.DoubleType()))]))
    same = None
    for c in [*g, id_col]:
        one = F.col(f"d.{c}").eqNullSafe(F.col(f"v.{c}"))
        same = one if same is None else same & one
    ids = docs.select(*g, id_col).distinct()
    return ids.alias("d").join(found.alias("v"), same, "left").select(
        *[F.col(f"d.{c}").alias(c) for c in [*g, id_col]], F.coalesce("v.embedding", F.array_repeat(F.lit(0.0), dim)).alias("embedding"))
