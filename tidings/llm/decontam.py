"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A test item is short, a document may be long, so the sketch is taken from the item alone: its signature is
the k smallest hashes among its shingles, with k set by the item's size class. Among k = (missing shingles
allowed at the top of the class) + 1 smallest hashes at least one must occur in any document that contains
enough of the item, so the search misses nothing. Documents are scanned once; a Bloom filter of fixed size
drops shingles that no item has, the rest are joined, and containment is counted on the shingles' words.

Defined results: null or empty items and texts match nothing; an item with fewer words than a shingle is one
shingle, its whole sequence, and is looked for as that run of words; rows that share an id are counted
together; empty tables give an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm import bloom, kernels
from tidings.session import cut_lineage

SHINGLE = 5
CONTAINMENT = 0.8
SALTS = 16
_SCHEMA = "id long, size int, h long, words string"


def size_class(n: int) -> int:
    """Largest item size of the class of ``n`` shingles (classes grow by a quarter)."""
    top = 4
    while top < n:
        top += max(1, top // 4)
    return top


def signature_length(n: int, containment: float) -> int:
    """Signature size of an item of ``n`` shingles: pigeonhole bound of the top of its size class."""
    top = size_class(n)
    return min(n, int(top - np.ceil(containment * top - 1e-9)) + 1)


def _runs(words: kernels.Words, hashes: np.ndarray, size: int):
    """(owner, first word, hash) of every run of ``size`` words inside one text."""
    count = words.count
    n = np.maximum(count - size + 1, 0)
    owner = np.repeat(np.arange(len(count)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + words.first[:-1][owner]
    acc = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + hashes[at + k]
    return owner, at, kernels.mix(acc + np.uint64(size))


def item_shingles(containment: float):
    """Arrow mapper: distinct shingles of each item, with its count and whether they belong to its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, text in zip(ids, texts, strict=True):
                ws = (text or "").encode().lower().split()
                size = min(SHINGLE, len(ws))
                if not size:
                    continue
                w = kernels.Words(np.frombuffer(text.encode(), dtype=np.uint8), np.array([0, len(text.encode())]))
                _, at, h = _runs(w, w.hashes(), size)
                mine = {}
                for a, x in zip(at.tolist(), h.view(np.int64).tolist(), strict=True):
                    mine[b" ".join(ws[a: a + size]).decode()] = x
                ranked = sorted((x & (2**64 - 1), s) for s, x in mine.items())
                k = signature_length(len(mine), containment)
                rows += [(i, size, mine[s], s, len(mine), at < k) for at, (_, s) in enumerate(ranked)]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.string()),
                pa.array([r[4] for r in rows], pa.int32()), pa.array([r[5] for r in rows], pa.bool_())],
                names=["item_id", "size", "h", "words", "n", "signs"])

    return run


def document_hits(sizes: tuple[int, ...], all_bits: np.ndarray, sign_bits: np.ndarray):
    """Arrow mapper: of each document with a possible signature hit, its distinct shingles that an item may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            known = np.asarray(batch.column(0).is_valid())
            for i, j, raw, off in kernels.chunked(batch.column(1)):
                w = kernels.Words(raw, off)
                hashes = w.hashes()
                for size in sizes:
                    owner, at, h = _runs(w, hashes, size)
                    signed = np.zeros(j - i, dtype=bool)
                    signed[owner[bloom.test(sign_bits, h)]] = True
                    keep = np.flatnonzero(signed[owner] & known[i:j][owner])
                    keep = keep[bloom.test(all_bits, h[keep])]
                    if not len(keep):
                        continue
                    _, one = np.unique(np.stack([owner[keep].astype(np.uint64), h[keep]]), axis=1, return_index=True)
                    keep = keep[one]
                    owner, at, h = owner[keep], at[keep], h[keep]
                    said = [b" ".join(w.low[w.start[a + k]: w.end[a + k]].tobytes() for k in range(size)).decode("utf-8", "replace")
                            for a in at]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[i:j][owner].astype(np.int64), pa.int64()), pa.array(np.full(len(at), size, np.int32)),
                        pa.array(h.view(np.int64)), pa.array(said, pa.string())], names=["id", "size", "h", "words"])

    return run


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
               item_text: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """(key, item_key, n_item_shingles, n_shared, containment) of every pair at or above ``containment``."""
    parts = items.select(F.col(item_key).cast("long").alias("_i"), F.col(item_text).cast("string").alias("_t")).filter("_i IS NOT NULL")
    signs = cut_lineage(parts.mapInArrow(
        item_shingles(containment), "item_id long, size int, h long, words string, n int, signs boolean"))
    sizes = tuple(sorted(r[0] for r in signs.select("size").distinct().collect()))  # at most SHINGLE values
    if not sizes:
        sizes = (SHINGLE,)
    spread = signs.select("item_id", "size", "h", "words", "n", "signs",
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    found = docs.select(F.col(key).cast("long").alias("_d"), F.col(text).cast("string").alias("_t")).mapInArrow(
        document_hits(sizes, bloom.build(signs, "h"), bloom.build(signs.filter("signs"), "h")), _SCHEMA)
    found = found.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    hits = found.join(spread, ["size", "h", "words", "_salt"]).groupBy("id", "item_id").agg(
        F.countDistinct("words").alias("n_shared"), F.max("n").alias("n"), F.max("signs").alias("signed"))
    share = F.col("n_shared") / F.col("n")
    return hits.filter(F.col("signed") & (share >= containment)).select(
        F.col("id").alias(key), F.col("item_id").alias(item_key), F.col("n").cast("long").alias("n_item_shingles"),
        F.col("n_shared").cast("long").alias("n_shared"), share.alias("containment"))


def drop_leaked(docs: DataFrame, leaks: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents that hold no test item (a null id is never dropped)."""
    return docs.join(leaks.select(key).distinct(), key, "left_anti")
