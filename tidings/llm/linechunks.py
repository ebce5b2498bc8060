"""Line deduplication by content-defined line chunks, as DataFrame functions.

Every line is hashed; a rolling window over the line hashes picks the chunk ends, so an inserted or deleted
line moves only the chunks around it. With ``lowest`` (as op9 runs) a chunk begins at every line whose hash is lower
than its neighbours': only these three lines decide, and every chunk of a longer text has two lines or more (three
on average). Multi-line chunks that occur more than once in the table are compared
as bytes; all but the first occurrence (smallest id, then position) are removed and the other lines stay.

Defined results: a null text counts as empty (one empty line, nothing removed); chunks of one line, and
chunks without any visible character, are left alone; rows that share an id are told apart by a 128-bit hash of
their texts, which also orders equal chunks at equal positions of them (rows equal in id and text are one document
and treated alike); a null id sorts last; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.session import cut_lineage

WINDOW = 2  # line hashes under the rolling window
DIVISOR = 3  # one chunk end in so many lines
SALTS = 16
_LAST_ID = 2**63 - 1


def let(value: Column, body) -> Column:
    """Bind a value once inside a row expression (a lambda variable is evaluated once)."""
    return F.transform(F.array(value), body)[0]


def line_chunks(text: Column, window: int = WINDOW, divisor: int = DIVISOR, lowest: bool = False) -> Column:
    """array<struct<pos, lines:array<string>>> covering all lines of the text in order."""

    def ends(h: Column) -> Column:
        n = F.size(h)
        rolling = lambda i: F.xxhash64(F.slice(h, i - window + 1, window))
        is_end = lambda i: (i == n) | ((i >= window) & (F.pmod(F.when(i >= window, rolling(i)), F.lit(divisor)) == 0))
        # before a lowest line, but not so that the first or last line would be alone
        low = lambda i: (F.get(h, i) < F.get(h, i - 1)) & (F.get(h, i) <= F.get(h, i + 1))
        is_low = lambda i: (i == n) | ((i > 1) & (i < n - 1) & low(i))
        return F.filter(F.sequence(F.lit(1), n), is_low if lowest else is_end)

    def cut(lines: Column) -> Column:
        def spans(e: Column) -> Column:
            begin = lambda i: F.when(i == 0, F.lit(1)).otherwise(F.element_at(e, F.greatest(i, F.lit(1))) + 1)
            return F.transform(e, lambda stop, i: F.struct(
                i.alias("pos"), F.slice(lines, begin(i), stop - begin(i) + 1).alias("lines")))
        return let(ends(F.transform(lines, lambda x: F.xxhash64(x))), spans)

    return let(F.split(F.coalesce(text, F.lit("")), "\n", -1), cut)


def _hashed(c: Column) -> list[Column]:
    return [F.xxhash64(c).alias("a"), F.xxhash64(F.lit("second"), c).alias("b")]


def dedup_line_chunks(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                      divisor: int = DIVISOR, lowest: bool = False) -> DataFrame:
    """key, text (what is left), n_lines, n_removed_lines, n_removed_chunks for every row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    base = df.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"),
                     *(h.alias(n) for h, n in zip(_hashed(whole), ("_ta", "_tb"), strict=True)))
    chunked = base.select("_id", "_ta", "_tb", F.explode(line_chunks(F.col("_text"), window, divisor, lowest)).alias("c"))
    chunk = chunked.filter(F.size("c.lines") > 1).select(
        F.coalesce(F.col("_id"), F.lit(_LAST_ID)).alias("_id"), "_ta", "_tb", F.col("c.pos").alias("pos"),
        F.array_join("c.lines", "\n").alias("chunk")).filter(F.col("chunk").rlike(r"\S"))
    order = F.struct("_id", "pos", "_ta", "_tb")
    chunk = chunk.select("_id", "_ta", "_tb", "pos", *_hashed(F.col("chunk")), "chunk")
    # byte comparison: the chunks themselves are the grouping key (hashes only speed it up)
    groups = chunk.groupBy("a", "b", "chunk").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = cut_lineage(groups.filter("n > 1").select("a", "b", F.sha2("chunk", 256).alias("sha"), "first"))
    clash = repeated.groupBy("a", "b").count().filter("count > 1").isEmpty()
    on = ["a", "b"] if clash else ["a", "b", "sha"]
    spread = repeated.select(*on, "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    placed = chunk.select("_id", "_ta", "_tb", "pos", "a", "b", *([] if clash else [F.sha2("chunk", 256).alias("sha")]), order.alias("_order"),
                          F.pmod(F.xxhash64("_id", "_ta"), F.lit(SALTS)).cast("int").alias("_salt"))
    removed = (
        placed.join(spread, [*on, "_salt"]).filter(F.col("_order") != F.col("first"))
        .groupBy("_id", "_ta", "_tb").agg(F.collect_set("pos").alias("_gone")).withColumnRenamed("_id", "_gid"))
    joined = base.withColumn("_gid", F.coalesce(F.col("_id"), F.lit(_LAST_ID))).join(removed, ["_gid", "_ta", "_tb"], "left")
    gone = F.coalesce(F.col("_gone"), F.array().cast("array<int>"))
    kept = let(gone, lambda g: F.filter(line_chunks(F.col("_text"), window, divisor, lowest), lambda c: ~F.array_contains(g, c["pos"])))
    left = joined.select(
        "_id", F.size(F.split(F.coalesce(F.col("_text"), F.lit("")), "\n", -1)).alias("n_lines"),
        F.size(gone).alias("n_removed_chunks"),
        F.when(F.col("_gone").isNull(), F.split(F.coalesce(F.col("_text"), F.lit("")), "\n", -1))
        .otherwise(F.flatten(F.transform(kept, lambda c: c["lines"]))).alias("_lines"))
    return left.select(
        F.col("_id").alias(key), F.array_join("_lines", "\n").alias(text), F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("n_lines") - F.size("_lines")).cast("long").alias("n_removed_lines"),
        F.col("n_removed_chunks").cast("long").alias("n_removed_chunks"))
