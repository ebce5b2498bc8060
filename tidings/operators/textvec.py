"""Sparse text vectors in long form and the operators over them.

A document vector is the rows ``(doc, token, tf, w)`` with ``w = tf / |tf|``. Tokens are maximal runs of
letters, digits and underscore after lower-casing (the same in Java regex and RE2).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.operators.greedy import greedy_keep_first
from tidings.operators.ranking import prefix_row_number
from tidings.operators.similarity import meet
from tidings.session import cut_lineage, release

# Token pattern and BM25 parameters.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+"
TOKEN_SEPARATOR = r"[^\p{L}\p{N}_]+"
BM25_K1 = 1.2
BM25_B = 0.75
# Block pairs: commonest tokens that travel as two bytes, copies of a document, rows of a block, tokens compared first.
COMMON_TOKENS = 1 << 15
COPIES = 8
MAX_BLOCK_ROWS = 1 << 15
LEAD_TOKENS = 128
REST_CLASSES = 192
# Where more than DENSE of a tile's pairs pass, more tokens and classes are compared before any pair is multiplied whole.
ROWS_AT_ONCE = 256
COLUMNS_AT_ONCE = 1024
WIDE_TOKENS = 512
WIDE_CLASSES = 1536
DENSE = 0.01
SLACK = 2e-4  # more than the rounding of a product in single precision
TOKENS_AT_ONCE = 1 << 18
# Near-duplicate scan: rows of a group that are listed in pairs at first, and how the next slices grow.
SLICE_ROWS = 1 << 13
SLICE_GROWTH = 4
# Medoids: means of the commonest tokens of clusters that are sent to every task.
COMMON_MEANS = 1 << 17


def embed_tf(docs: DataFrame, *, id_col: str = "id", text_col: str = "text", group_cols: Sequence[str] = (), norm_col: str | None = None) -> DataFrame:
    """Term-frequency unit vectors in long form: ``group_cols, id, token, tf, w``.

    Texts are dealt by (group, id) once; counting tokens and lengths then needs no other shuffle, so what moves is the
    text and not its tokens. ``norm_col`` names a column for the norm, which then comes in place of ``w``.
    """
    g = list(group_cols)
    dealt = docs.select(*g, id_col, text_col).repartition(*g, id_col)
    # maximal runs of letters, digits and underscore == the pieces between runs of anything else
    toks = dealt.select(*g, id_col, F.explode(F.split(F.lower(F.col(text_col)), TOKEN_SEPARATOR)).alias("token")) \
        .filter(F.col("token") != "")
    tf = toks.groupBy(*g, id_col, "token").agg(F.count(F.lit(1)).alias("tf"))
    norm = F.sqrt(F.sum(F.col("tf") * F.col("tf")).over(Window.partitionBy(*g, id_col)))
    return tf.withColumn(norm_col, norm) if norm_col else tf.withColumn("w", F.col("tf") / norm)


def token_numbers(vec: DataFrame) -> DataFrame:
    """(token, tid): distinct tokens numbered from the rarest to the commonest, written once as a table, so every
    task reads the same numbers."""
    df = vec.groupBy("token").agg(F.count(F.lit(1)).alias("_df"))
    return cut_lineage(prefix_row_number(df, [], ["_df", "token"], "tid").select("token", F.col("tid").cast("long").alias("tid")))


def hashed_tokens(vec: DataFrame) -> DataFrame:
    """``vec`` with ``tid``: 0 to ``COMMON_TOKENS`` - 1 for the commonest tokens, a 64-bit hash for the others; where two tokens
    of ``vec`` would share one, numbers by count instead, rarest last."""
    counts = cut_lineage(vec.groupBy("token").agg(F.count(F.lit(1)).alias("_df")).withColumn("_hash", F.xxhash64("token")))
    clash = counts.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col("_hash").between(0, COMMON_TOKENS - 1))
    if not clash.isEmpty():
        numbers = prefix_row_number(counts.withColumn("_down", -F.col("_df")), [], ["_down", "token"], "tid")
        return vec.join(cut_lineage(numbers.select("token", (F.col("tid") - 1).cast("long").alias("tid"))), "token")
    top = counts.orderBy(F.col("_df").desc(), "token").limit(COMMON_TOKENS)
    top = prefix_row_number(top.withColumn("_down", -F.col("_df")), [], ["_down", "token"], "_place")
    common = cut_lineage(top.select("token", (F.col("_place") - 1).cast("long").alias("_common")))
    held = vec.join(F.broadcast(common), "token", "left")
    return held.withColumn("tid", F.coalesce("_common", F.xxhash64("token"))).drop("_common")


def _prefixes(t: float, keys: Sequence[str], id_col: str):
    """Pandas mapper: the leading (rarest) tokens of every document, up to where what is left has norm below ``t``."""

    def run(batches):
        for pdf in batches:
            out_id, out_tid = [], []
            for tids, ws in zip(pdf["_t"], pdf["_w"], strict=True):
                ws = np.asarray(ws, dtype=np.float64)
                rest = np.cumsum((ws * ws)[::-1])[::-1]
                n = int(np.count_nonzero(rest >= t * t - 1e-9))
                out_id.append(n)
                out_tid.append(np.asarray(tids, dtype=np.int64)[:n])
            at = np.repeat(np.arange(len(pdf)), out_id)
            res = pdf[[*keys, id_col]].iloc[at].copy()
            res["tid"] = np.concatenate(out_tid) if out_tid else np.zeros(0, np.int64)
            yield res

    return run


def _exact_cosines(t: float):
    """Pandas mapper over candidate pairs with both vectors: exact cosines of a whole batch at once."""

    def run(batches):
        for pdf in batches:
            n = len(pdf)
            if not n:
                continue

            def flat(tokens, weights):
                size = pdf[tokens].map(len).to_numpy()
                pair = np.repeat(np.arange(n, dtype=np.int64), size)
                return pair, np.concatenate(pdf[tokens].to_numpy()).astype(np.int64), np.concatenate(pdf[weights].to_numpy()).astype(np.float64)

            (pa_, ta, wa), (pb, tb, wb) = flat("_ta", "_wa"), flat("_tb", "_wb")
            tokens, place = np.unique(np.concatenate([ta, tb]), return_inverse=True)  # token numbers may be hashes
            ta, tb, top = place[: len(ta)], place[len(ta):], len(tokens)
            _, ia, ib = np.intersect1d(pa_ * top + ta, pb * top + tb, assume_unique=True, return_indices=True)
            score = np.bincount(pa_[ia], weights=wa[ia] * wb[ib], minlength=n)
            res = pdf.drop(columns=["_ta", "_wa", "_tb", "_wb"]).copy()
            res["cos"] = score
            yield res[score >= t]

    return run


def text_cosine_pairs(vec: DataFrame, t: float, *, id_col: str = "id", group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact pairs ``a < b`` (same group) with cosine ``>= t`` over long-form unit vectors.

    Prefix filter (Bayardo, Ma, Srikant 2007): tokens are ordered from rare to common; a document's prefix is
    its leading tokens up to the point where the remaining weight has norm < t. Two unit vectors with cosine
    >= t share a prefix token, so only prefix postings are joined (a common token in many prefixes is split by
    the adaptive skew join). The distinct candidates are verified on whole vectors, a batch at a time.
    Output: ``group_cols, a, b, cos``.
    """
    g = list(group_cols)
    numbered = vec.join(token_numbers(vec), "token")
    docs = numbered.groupBy(*g, id_col).agg(F.array_sort(F.collect_list(F.struct("tid", "w"))).alias("_v"))
    docs = cut_lineage(docs.select(*g, id_col, F.col("_v.tid").alias("_t"), F.col("_v.w").alias("_w")))
    kept = [f for f in docs.schema.fields if f.name in [*g, id_col]]
    prefix = cut_lineage(docs.mapInPandas(_prefixes(t, g, id_col), schema=T.StructType([*kept, T.StructField("tid", T.LongType())])))
    a = prefix.withColumnRenamed(id_col, "a")
    b = prefix.withColumnRenamed(id_col, "b")
    cand = a.join(b, [*g, "tid"]).filter(F.col("a") < F.col("b")).select(*g, "a", "b").distinct()
    left = docs.select(*g, F.col(id_col).alias("a"), F.col("_t").alias("_ta"), F.col("_w").alias("_wa"))
    right = docs.select(*g, F.col(id_col).alias("b"), F.col("_t").alias("_tb"), F.col("_w").alias("_wb"))
    both = cand.join(left, [*g, "a"]).join(right, [*g, "b"]).select(*g, "a", "b", "_ta", "_wa", "_tb", "_wb")
    out = T.StructType([*[f for f in both.schema.fields if f.name in [*g, "a", "b"]], T.StructField("cos", T.DoubleType())])
    return both.mapInPandas(_exact_cosines(t), schema=out)


class _Side:
    """Documents of one block, from the shortest to the longest: tokens (numbered within the task) and weights, row after row."""

    def __init__(self, table: pa.Table, rows: np.ndarray):
        size = lambda c: np.diff(c.combine_chunks().offsets.to_numpy()).astype(np.int64)
        long = sum(pa.compute.list_value_length(table.column(c)).to_numpy() for c in ("_c", "_t"))
        self.at = rows[np.argsort(long[rows], kind="stable")]
        table = table.select(["_c", "_cf", "_t", "_tf"]).take(pa.array(self.at))
        flat = lambda c: table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.n, two = len(rows), (size(table.column("_c")), size(table.column("_t")))
        self.size = two[0] + two[1]
        row = np.concatenate([np.repeat(np.arange(self.n), x) for x in two])
        order = np.argsort(row, kind="stable")
        self.row, self.token = row[order].astype(np.int32), np.concatenate([flat("_c"), flat("_t")])[order]
        tf = np.concatenate([flat("_cf"), flat("_tf")])[order].astype(np.float64)
        self.weight = tf / np.sqrt(np.bincount(self.row, tf * tf, self.n))[self.row]
        self.start = np.concatenate(([0], np.cumsum(self.size)))

    def lead(self, place: np.ndarray, lead: int, classes: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Weights of the leading tokens of some rows, and the norms of what is left by class: a product of two such rows is
        never below the cosine."""
        last = self.n if last is None else min(last, self.n)
        own, n = slice(self.start[first], self.start[last]), last - first
        out = np.zeros((n, lead + classes), dtype=np.float32)
        at, row, weight = place[self.token[own]], self.row[own] - first, self.weight[own]
        head = at < lead
        out[row[head], at[head]] = weight[head]
        rest = np.bincount(row[~head] * np.int64(classes) + at[~head] % classes, weight[~head] ** 2, n * classes)
        out[:, lead:] = np.sqrt(rest).reshape(n, classes)
        return out


def _scores(left: _Side, right: _Side, r: np.ndarray, c: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """Exact cosines of the pairs (r, c), which come in order of r, then c."""
    out = np.zeros(len(r))
    for lo, hi in zip(*_runs(r), strict=True):
        own = slice(left.start[r[lo]], left.start[r[lo] + 1])
        scratch[left.token[own]] = left.weight[own]
        step = max(TOKENS_AT_ONCE // max(int(right.size[c[hi - 1]]), 1), 1)
        for i in range(lo, hi, step):
            other = c[i: min(i + step, hi)]
            a, z = other[0], other[-1] + 1
            begin, end = right.start[a], right.start[z]
            size = right.size[other]
            if 3 * size.sum() > end - begin:  # most of what lies between: read it as it lies
                x = scratch[right.token[begin:end]] * right.weight[begin:end]
                out[i: i + len(other)] = np.add.reduceat(x, right.start[a:z] - begin)[other - a]
                continue
            begin = np.cumsum(size) - size
            at = np.arange(size.sum()) + np.repeat(right.start[other] - begin, size)
            out[i: i + len(other)] = np.add.reduceat(scratch[right.token[at]] * right.weight[at], begin)
        scratch[left.token[own]] = 0.0
    return out


def _runs(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1]))) if len(r) else np.zeros(0, np.int64)
    return begin, np.concatenate((begin[1:], [len(r)])).astype(np.int64) if len(r) else begin


class _Blocks:
    """Two blocks of documents and the pairs of them with cosine >= t.

    A float32 product over the tokens of most weight, with the norms of the other tokens by class, bounds every cosine from
    above; where many pairs of a tile pass, which is where documents are long, a product over more tokens follows. It bounds
    cosines from below, too. What is left is multiplied whole.
    """

    def __init__(self, left: _Side, right: _Side, t: float):
        self.left, self.right, self.t = left, right, t
        rare = [np.flatnonzero((x.token < 0) | (x.token >= COMMON_TOKENS)) for x in (left, right)]  # these are numbered anew
        rares, number = np.unique(np.concatenate([x.token[at] for x, at in zip((left, right), rare, strict=True)]), return_inverse=True)
        left.token[rare[0]], right.token[rare[1]] = COMMON_TOKENS + number[: len(rare[0])], COMMON_TOKENS + number[len(rare[0]):]
        left.token, right.token = left.token.astype(np.int32), right.token.astype(np.int32)
        self.tokens = COMMON_TOKENS + len(rares)
        self.scratch = np.zeros(self.tokens)
        mass = np.bincount(left.token, left.weight**2, self.tokens) + np.bincount(right.token, right.weight**2, self.tokens)
        self.place = np.empty(self.tokens, dtype=np.int32)
        self.place[np.argsort(-mass, kind="stable")] = np.arange(self.tokens)
        lead = min(LEAD_TOKENS, self.tokens)
        self.a, self.b = (x.lead(self.place, lead, REST_CLASSES) for x in (left, right))

    def passing(self, same: bool, scored: bool = True, open_: np.ndarray | None = None):
        """(row, column, score) by tiles; of one block with itself row before column. Without ``scored`` the score is None.
        Columns that are not ``open_`` (which may change between tiles) are left out."""
        wide = min(WIDE_TOKENS, self.tokens)
        for i in range(0, self.left.n, ROWS_AT_ONCE):
            many = None
            for j in range(i if same else 0, self.right.n, COLUMNS_AT_ONCE):
                if open_ is not None and not open_[j: j + COLUMNS_AT_ONCE].any():
                    continue
                g = self.a[i: i + ROWS_AT_ONCE] @ self.b[j: j + COLUMNS_AT_ONCE].T
                r, c = np.divmod(np.flatnonzero(g >= self.t - SLACK), g.shape[1])
                if open_ is not None:
                    r, c = (x[open_[c + j]] for x in (r, c))
                if same:
                    r, c = (x[r + i < c + j] for x in (r, c))
                sure = np.zeros(len(r), dtype=bool)
                if len(r) > DENSE * g.size:
                    if many is None:
                        many = self.left.lead(self.place, wide, WIDE_CLASSES, i, i + ROWS_AT_ONCE)
                    other = self.right.lead(self.place, wide, WIDE_CLASSES, j, j + COLUMNS_AT_ONCE)
                    least = (many[:, :wide] @ other[:, :wide].T)[r, c]
                    most = least + (many[:, wide:] @ other[:, wide:].T)[r, c]
                    stay = most >= self.t - SLACK
                    r, c, sure = r[stay], c[stay], least[stay] >= self.t + SLACK
                r, c = r + i, c + j
                if scored:
                    score = _scores(self.left, self.right, r, c, self.scratch)
                    sure = score >= self.t
                    yield r[sure], c[sure], score[sure]
                else:
                    ask = np.flatnonzero(~sure)
                    sure[ask] = _scores(self.left, self.right, r[ask], c[ask], self.scratch) >= self.t
                    yield r[sure], c[sure], None


def _block_pairs(keys: Sequence[str], id_col: str, t: float):
    """Arrow group kernel over two blocks of documents: pairs with cosine >= t."""

    def kernel(table: pa.Table) -> pa.Table:
        bi, bj = table.column("_bi")[0].as_py(), table.column("_bj")[0].as_py()
        blk = table.column("_blk").to_numpy()
        left, right = _Side(table, np.flatnonzero(blk == bi)), _Side(table, np.flatnonzero(blk == bj))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), *_Blocks(left, right, t).passing(same=bi == bj)]
        r, c, score = (np.concatenate(x) for x in zip(*found, strict=True))
        rows, cols = left.at[r], right.at[c]
        one, two = table.column(id_col).take(pa.array(rows)), table.column(id_col).take(pa.array(cols))
        swap = pa.compute.greater(one, two)
        out = {k: table.column(k).take(pa.array(rows)) for k in keys}
        out["a"], out["b"] = pa.compute.if_else(swap, two, one), pa.compute.if_else(swap, one, two)
        return pa.table({**out, "cos": pa.array(score)})

    return kernel


def _block_hits(keys: Sequence[str], id_col: str, t: float):
    """Arrow group kernel over a home block and a visitor block: visitors with cosine >= t to a document at home."""

    def kernel(table: pa.Table) -> pa.Table:
        guest = table.column("_guest").to_numpy(zero_copy_only=False).astype(bool)
        home, away = _Side(table, np.flatnonzero(~guest)), _Side(table, np.flatnonzero(guest))
        free = np.ones(away.n, dtype=bool)  # a document that has been hit is not asked for again
        for _, c, _ in _Blocks(home, away, t).passing(same=False, scored=False, open_=free):
            free[c] = False
        return table.select([*keys, id_col]).take(pa.array(away.at[~free]))

    return kernel


def document_rows(vec: DataFrame, *, id_col: str = "id", group_cols: Sequence[str] = ()) -> DataFrame:
    """A row per document, written once: ``group_cols, id``, its common tokens (``_c``, two bytes each) and others (``_t``) with
    their counts (``_cf``, ``_tf``), and a key of its content (``_n``, ``_k1``, ``_k2``)."""
    g = list(group_cols)
    common = F.col("tid").between(0, COMMON_TOKENS - 1)
    tf = F.col("tf").cast("int")
    key = [F.sum(F.xxhash64("token", "tf", F.lit(s)).cast("decimal(20,0)")).alias(f"_k{s}") for s in (1, 2)]
    return cut_lineage(hashed_tokens(vec).groupBy(*g, id_col).agg(
        F.collect_list(F.when(common, F.col("tid").cast("smallint"))).alias("_c"), F.collect_list(F.when(common, tf)).alias("_cf"),
        F.collect_list(F.when(~common, F.col("tid"))).alias("_t"), F.collect_list(F.when(~common, tf)).alias("_tf"),
        F.count(F.lit(1)).alias("_n"), *key))


def text_block_pairs(vec: DataFrame, t: float, *, id_col: str = "id", group_cols: Sequence[str] = (), block_rows: int = 1024) -> DataFrame:
    """Exact pairs ``a < b`` (same group) with cosine ``>= t`` over long-form vectors (``token``, ``tf``), by block pairs.

    A document is copied to ``COPIES`` block pairs of its group, whatever the group's size, until a block would hold more
    than ``MAX_BLOCK_ROWS`` rows; each block pair is one task. The work is quadratic in a group, with a small constant: see
    :class:`_Blocks`, and :func:`text_cosine_pairs` for text with rare words.
    Output: ``group_cols, a, b, cos``.
    """
    return _pairs_of_rows(document_rows(vec, id_col=id_col, group_cols=group_cols), t, id_col, list(group_cols), block_rows)


def _pairs_of_rows(docs: DataFrame, t: float, id_col: str, g: list[str], block_rows: int = 1024) -> DataFrame:
    docs = docs.select(*g, id_col, "_c", "_cf", "_t", "_tf")
    sizes = docs.groupBy(*g).agg(F.count(F.lit(1)).alias("_rows"))
    docs = docs.join(sizes, g) if g else docs.withColumn("_rows", F.lit(docs.count()))
    blocks = F.greatest(F.least(F.ceil(F.col("_rows") / float(block_rows)), F.lit(COPIES)), F.ceil(F.col("_rows") / float(MAX_BLOCK_ROWS)), F.lit(1))
    docs = docs.withColumn("_g", blocks.cast("int"))
    docs = docs.withColumn("_blk", F.pmod(F.xxhash64(F.col(id_col)), F.col("_g")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("_g") - 1),
                        lambda x: F.struct(F.least(F.col("_blk"), x).alias("bi"), F.greatest(F.col("_blk"), x).alias("bj")))
    rep = docs.withColumn("_p", F.explode(pairs)).select(*g, id_col, "_c", "_cf", "_t", "_tf", "_blk", F.col("_p.bi").alias("_bi"), F.col("_p.bj").alias("_bj"))
    kind = {f.name: f.dataType for f in docs.schema.fields}
    out = T.StructType([*[T.StructField(c, kind[c]) for c in g], T.StructField("a", kind[id_col]), T.StructField("b", kind[id_col]),
                        T.StructField("cos", T.DoubleType())])
    # explicit partition count so AQE does not pack the CPU-heavy block pairs into a few tasks
    rep = rep.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *g, "_bi", "_bj")
    return rep.groupBy(*g, "_bi", "_bj").applyInArrow(_block_pairs(g, id_col, t), schema=out)


def text_near_duplicates(vec: DataFrame, t: float, *, id_col: str = "id", group_cols: Sequence[str] = ()) -> DataFrame:
    """Documents (``group_cols, id``) dropped by the keep-first scan in id order at cosine ``t``, exact copies
    first: of equal vectors only the first is compared, the others are dropped with it or by it. Groups of more than
    ``SLICE_ROWS`` documents are scanned by slices (:func:`_lost_by_slices`)."""
    g = list(group_cols)
    docs = document_rows(vec, id_col=id_col, group_cols=g)
    same = [*g, "_n", "_k1", "_k2"]
    first = docs.groupBy(*same).agg(F.min(id_col).alias("_first"))
    copies = cut_lineage(docs.select(*same, id_col).join(first, same).select(*g, id_col, "_first"))
    reps = docs.join(copies.filter(F.col(id_col) == F.col("_first")).select(*g, id_col), [*g, id_col], "left_semi")
    lost = _lost_by_slices(reps, t, id_col, g)
    return lost.unionByName(copies.filter(F.col(id_col) != F.col("_first")).select(*g, id_col))


def _lost_by_slices(docs: DataFrame, t: float, id_col: str, g: list[str]) -> DataFrame:
    """Documents dropped by the scan, by slices of the order that grow ``SLICE_GROWTH`` times.

    A slice is scanned whole; what it keeps is kept, and drops its neighbours from all later slices. So pairs are listed only
    among documents of a slice that no earlier slice drops.
    """
    docs = docs.select(*g, id_col, "_c", "_cf", "_t", "_tf")
    scan = lambda rows: greedy_keep_first(
        _pairs_of_rows(rows, t, id_col, g).select(*g, F.col("a").alias("early"), F.col("b").alias("late")), g).withColumnRenamed("node", id_col)
    largest = docs.groupBy(*g).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    if largest <= SLICE_ROWS:
        return scan(docs)
    left, end, lost = cut_lineage(prefix_row_number(docs, g, [id_col], "_place")), SLICE_ROWS, []
    while True:
        part = left.filter(F.col("_place") <= end).drop("_place")
        lost.append(cut_lineage(scan(part)))
        if end >= largest:
            return reduce(DataFrame.unionByName, lost)
        rest = left.filter(F.col("_place") > end)
        homes = cut_lineage(part.join(lost[-1], [*g, id_col], "left_anti"))
        lost.append(cut_lineage(_rows_near(rest.drop("_place"), homes, t, id_col, g)))
        before, left = left, cut_lineage(rest.join(lost[-1], [*g, id_col], "left_anti"))
        release(homes)
        release(before)
        end *= SLICE_GROWTH


def _rows_near(guests: DataFrame, homes: DataFrame, t: float, id_col: str, g: list[str], block_rows: int = 1024) -> DataFrame:
    """``group_cols, id`` of the guests with cosine >= t to a document at home in their group; pairs are not listed."""
    rows = max(homes.count(), guests.count())
    block_rows = max(block_rows, min(-(-rows // COPIES), MAX_BLOCK_ROWS))
    kind = {f.name: f.dataType.simpleString() for f in guests.schema.fields}
    keys = g or ["_all"]
    homes, guests = (x if g else x.withColumn("_all", F.lit(0)) for x in (homes, guests))
    return meet(homes, guests, keys, id_col, _block_hits(g, id_col, t), ", ".join(f"`{c}` {kind[c]}" for c in [*g, id_col]), block_rows).distinct()


def tf_medoid_scores(vec: DataFrame, *, id_col: str = "id", key_cols: Sequence[str] = ("cluster_id",)) -> DataFrame:
    """Mean cosine of each member to all members (self included) = w · mean(w), linear in the data.

    The means of the ``COMMON_MEANS`` commonest (key, token) go to every task, so most rows of the vectors are multiplied where they
    lie; only the rows of the other tokens meet their means by a shuffle.
    Output: ``key_cols, id, score``."""
    k = list(key_cols)
    on = [*k, "token"]
    n = vec.select(*k, id_col).distinct().groupBy(*k).agg(F.count(F.lit(1)).alias("_n"))
    sums = vec.groupBy(*on).agg(F.sum("w").alias("_s"), F.count(F.lit(1)).alias("_rows"))
    mean = cut_lineage(sums.join(n, k).select(*on, (F.col("_s") / F.col("_n")).alias("_m"), "_rows"))
    common = cut_lineage(mean.orderBy(F.col("_rows").desc(), *on).limit(COMMON_MEANS).select(*on, "_m"))
    rows = vec.select(*k, id_col, "token", "w")
    near = rows.join(F.broadcast(common), on)
    far = rows.join(F.broadcast(common.select(*on)), on, "left_anti").join(mean.drop("_rows"), on)
    part = lambda df: df.select(*k, id_col, (F.col("w") * F.col("_m")).alias("_x"))
    # rounded to 1e-9 so that exact ties (e.g. a two-member cluster) break on the id, not on float noise
    return part(near).union(part(far)).groupBy(*k, id_col).agg(F.round(F.sum("_x"), 9).alias("score"))


def rerank_bm25(vec: DataFrame, queries: DataFrame, *, id_col: str = "id", key_cols: Sequence[str] = ("cluster_id",),
                k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """BM25 of every candidate against its cluster's query document, statistics within the cluster.

    ``vec``: candidates in long form (``key_cols, id, token, tf``); ``queries``: ``key_cols, qid``.
    idf = ln(1 + (N - df + 0.5) / (df + 0.5)). Output ``key_cols, id, score, rank`` (rank 1 = best;
    ties by id).

    The query's tokens come first: only their postings are joined and counted. Queries and their tokens are written as tables of
    known size, so few of them are sent to the vectors instead of shuffling those. Lengths are one partial aggregate, ranks come from
    range partitions; no task holds a cluster.
    """
    k = list(key_cols)
    queries = cut_lineage(queries.select(*k, F.col("qid").alias(id_col)))
    asked = cut_lineage(vec.join(queries, [*k, id_col], "left_semi").select(*k, "token").distinct())
    postings = cut_lineage(vec.select(*k, id_col, "token", "tf").join(asked, [*k, "token"]))
    length = cut_lineage(vec.groupBy(*k, id_col).agg(F.sum("tf").alias("_dl")))
    stats = length.groupBy(*k).agg(F.count(F.lit(1)).alias("_N"), F.avg("_dl").alias("_avg"))
    idf = postings.groupBy(*k, "token").agg(F.count(F.lit(1)).alias("_df")).join(stats, k).select(
        *k, "token", "_avg", F.log(1.0 + (F.col("_N") - F.col("_df") + 0.5) / (F.col("_df") + 0.5)).alias("_idf"))
    term = F.col("_idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("_dl") / F.col("_avg")))
    found = postings.join(idf, [*k, "token"]).join(length, [*k, id_col]).groupBy(*k, id_col).agg(F.sum(term).alias("_s"))
    # rounded to 1e-9 so that equal scores (copies) rank by id, not by float summation order
    scored = length.join(found, [*k, id_col], "left").select(*k, id_col, F.round(F.coalesce("_s", F.lit(0.0)), 9).alias("score"))
    ranked = prefix_row_number(scored.withColumn("_down", -F.col("score")), k, ["_down", id_col], "rank")
    return ranked.select(*k, id_col, "score", F.col("rank").cast("int").alias("rank"))


def pack_batches(items: DataFrame, budget: int, *, group_cols: Sequence[str] = ("source", "shard"), order_col: str = "id",
                 tokens_col: str = "tokens", num_partitions: int | None = None) -> DataFrame:
    """Token-budget batch numbers: in order within each group, a new batch opens when the running sum
    would exceed ``budget`` (the sum resets; it is not a plain cumulative sum).

    The fold is sequential by definition, so a hot source is cut into shards by the caller (say, ranges of the
    order column) and every (source, shard) packs on its own. Groups are hash-partitioned and sorted, and a
    streaming ``mapInPandas`` carries O(1) state across Arrow batches: no group is ever collected into memory.
    Output adds ``batch_no`` (int, from 0).
    """
    spark = items.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*items.schema.fields, T.StructField("batch_no", T.IntegerType())])
    keys = list(group_cols)

    def fold(batches):
        group, batch_no, room = None, 0, budget
        for pdf in batches:
            toks = pdf[tokens_col].to_numpy(dtype=np.int64)
            total = np.concatenate(([0], np.cumsum(toks)))
            rows = list(pdf[keys].itertuples(index=False, name=None))
            starts = [i for i in range(len(rows)) if i == 0 or rows[i] != rows[i - 1]]
            out = np.empty(len(rows), dtype=np.int32)
            for first, last in zip(starts, [*starts[1:], len(rows)], strict=True):
                if rows[first] != group:
                    group, batch_no, room = rows[first], 0, None
                i = first
                while i < last:
                    # rows that fit into what is left of the batch; a batch takes its first row in any case
                    fits = int(np.searchsorted(total, total[i] + (budget if room is None else room), side="right")) - 1
                    j = min(max(fits, i + (room is None)), last)
                    out[i:j] = batch_no
                    if j < last:
                        batch_no, room = batch_no + 1, None
                    else:
                        room = (budget if room is None else room) - int(total[j] - total[i])
                    i = j
            res = pdf.copy()
            res["batch_no"] = out
            yield res

    sorted_items = items.repartition(n, *keys).sortWithinPartitions(*keys, order_col)
    return sorted_items.mapInPandas(fold, schema=schema)
