"""Removal of repeated word windows by difference-cover anchors.

A difference cover of a period holds, for every shift, two residues that far apart. Short windows (anchors) are
hashed only at positions whose residue is in the cover, 4 of 13 for windows of 20 words. Wherever two equal windows
of ``size`` words begin, there is an offset below the period at which both have an anchor, so equal windows share an
aligned anchor that lies whole inside them: a window without a repeated anchor is not repeated.

1. Every anchor's hash goes to a bucket, with the part its document belongs to; the bucket tells the parts which of
   their anchors occur more than once.
2. The parts extend the repeated anchors: every window of ``size`` words around one is a candidate; of equal
   candidates in a part the earliest goes to a bucket of its hash, the others are repeated.
3. The buckets order the candidates by (hash, document, start): all but the earliest of equal ones are repeated.
4. The parts cut out the words that repeated windows cover.

Documents of the same word sequence as a smaller one need no search: all their windows are repeated, and none is the
earliest. They are found first, by their sha256, and keep out of steps 2 and 3, so large groups of copies cost one
anchor pass. Tasks combine what they send: an anchor goes once per part and chunk. Hashes of candidates have 96 bits
beside the bucket.

Defined results: a null text has no words; rows that share an id count as one document whose starts are ordered
by the number of the word in its row (equal starts do not remove each other); null ids are one id, larger than any;
texts shorter than a window keep all words; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm import bloom, kernels
from tidings.llm.pfp import NULL_ID, _by_document, _groups, _home, _pack, _pack_spans, _row_of, _unpack, part_ids, with_home
from tidings.session import cut_lineage

SIZE = 20
PERIOD = 13  # anchors have SIZE - PERIOD + 1 words
PER_BUCKET = 32 << 20  # bytes of text whose anchors or candidates one sorting task holds
PER_PART = 4 << 20  # bytes of text of one part
SALTS = 16

_U = np.uint64
_MORE = np.uint32(1 << 31)  # the chunk holds the anchor more than once
_STEP_A, _STEP_B = 0xD6E8FEB86659FD93, 0x9FB21C651E98DF25


def difference_cover(period: int) -> list[int]:
    """Residues such that every number is the difference of two of them modulo ``period`` (greedy)."""
    cover, left = [0], set(range(1, period))
    while left:
        gain = lambda x: len({d for c in cover for d in ((x - c) % period, (c - x) % period)} & left)  # noqa: E731,B023
        best = max(range(1, period), key=lambda x: (gain(x), -x))
        left -= {d for c in cover for d in ((best - c) % period, (c - best) % period)}
        cover.append(best)
    return sorted(cover)


class Sequence:
    """Words of a chunk of texts: bounds, owner, number in the text and hash; hashes of runs of words."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        n, self.docs = len(raw), len(off) - 1
        p, q = kernels.powers(n + 1)
        prefix = np.zeros(n + 1, dtype=_U)
        np.cumsum(kernels.BYTE_HASH[raw] * p[:n], out=prefix[1:])
        span = lambda a, b: kernels.mix((prefix[b] - prefix[a]) * q[a] + (b - a).astype(_U))
        self.check = (span(off[:-1], off[1:]) >> _U(32)).astype(np.uint32)
        solid = np.zeros(n + 2, dtype=bool)
        solid[1:-1] = ~kernels._SPACE[raw]
        edge = np.zeros(n + 1, dtype=bool)
        edge[off] = True
        start = np.flatnonzero(solid[1:] & (~solid[:-1] | edge))
        self.start = start[start < n]
        self.end = np.flatnonzero(solid[:-1] & (~solid[1:] | edge))
        self.doc = np.searchsorted(off, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=self.docs)
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        self.place = np.arange(len(self.start)) - self.first[self.doc]
        self.word = span(self.start, self.end)

    def runs(self, size: int, step: int) -> np.ndarray:
        """Hash of the ``size`` words from every word on (meaningless where they leave the text)."""
        out, done = np.zeros(len(self.word), dtype=_U), 0
        power, width = self.word * _U(step | 1) ^ (self.word >> _U(29)), 1
        factor = pow(step, 1, 1 << 64)
        while True:
            if size & width:  # the next ``width`` words follow those that are done
                shifted = np.zeros_like(out)
                shifted[: len(out) - done] = power[done:] if done < len(out) else 0
                out = out * _U(pow(step, width, 1 << 64)) + shifted
                done += width
            if done == size:
                return kernels.mix(out + _U(size))
            wide = np.zeros_like(power)
            if width < len(power):
                wide[: len(power) - width] = power[width:]
            power = power * _U(factor) + wide
            factor = factor * factor % (1 << 64)
            width *= 2

    def anchors(self, size: int, period: int) -> tuple[np.ndarray, np.ndarray]:
        """Words that begin an anchor of a text of ``size`` words or more, and the anchors' hashes."""
        width = size - period + 1
        at_cover = np.zeros(period, dtype=bool)
        at_cover[difference_cover(period)] = True
        ok = at_cover[self.place % period] & (self.place + width <= self.count[self.doc]) & (self.count[self.doc] >= size)
        at = np.flatnonzero(ok)
        return at, self.runs(width, _STEP_A)[at]


def _ids(column: pa.Array) -> np.ndarray:
    return np.asarray(column.fill_null(NULL_ID).to_numpy(zero_copy_only=False), dtype=np.int64)


def _named(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of an anchor's hash and the 32 bits that name it there."""
    return ((key >> _U(32)) % _U(buckets)).astype(np.int64), key.astype(np.uint32)


def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow mapper over (id, text): number of words, sha256 of the words joined by one space, and check of a row."""
    for batch in batches:
        for i, j, raw, off in kernels.chunked(batch.column(1)):
            s = Sequence(raw, off)
            sha = [hashlib.sha256(b" ".join(raw[a:b].tobytes().split())).digest() for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(s.count.astype(np.int64)), pa.array(sha, pa.binary()),
                                              pa.array(s.check.astype(np.int64))], names=["id", "n", "sha", "check"])


def send_anchors(buckets: int, parts: int, size: int, period: int):
    """Arrow mapper over (id, text): the anchors of a chunk by bucket, one for each part that has it."""

    def run(batches):
        for batch in batches:
            ids = _ids(batch.column(0))
            for i, j, raw, off in kernels.chunked(batch.column(1)):
                s = Sequence(raw, off)
                at, key = s.anchors(size, period)
                if not len(at):
                    continue
                part = _home(ids[i:j], parts)[s.doc[at]]
                order = np.lexsort((part, key))
                key, part = key[order], part[order]
                group = _groups(key)
                new = np.concatenate(([True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])))
                more = (np.bincount(group) > 1)[group[new]]
                bucket, name = _named(key[new], buckets)
                made = _pack(bucket, buckets, {"keys": name, "parts": part[new].astype(np.uint32) | np.where(more, _MORE, np.uint32(0))})
                yield pa.RecordBatch.from_arrays([pa.array(made["part"], pa.int32()), pa.array(made["keys"], pa.binary()),
                                                  pa.array(made["parts"], pa.binary())], names=["bucket", "keys", "parts"])

    return run


_TOLD = "part int, bucket int, keys binary, ids binary, checks binary"


def repeated_anchors(parts: int):
    """Arrow group mapper over a bucket: to every part, those of its anchors that occur more than once."""

    def run(table: pa.Table) -> pa.Table:
        key, part = _unpack(table, "keys", np.uint32), _unpack(table, "parts", np.uint32)
        more, part = part >= _MORE, (part & ~_MORE).astype(np.int64)
        order = np.lexsort((part, key))
        key, part, more = key[order], part[order], more[order]
        group = _groups(key)
        live = (np.bincount(group) > 1)[group] | (np.bincount(group, weights=more) > 0)[group]
        live[1:] &= (key[1:] != key[:-1]) | (part[1:] != part[:-1])  # a part is told once
        made = _pack(part[live], parts, {"keys": key[live]})
        n = len(made["part"])
        return pa.table({"part": pa.array(made["part"], pa.int32()), "bucket": pa.array([table.column("bucket")[0].as_py()] * n, pa.int32()),
                         "keys": pa.array(made["keys"], pa.binary()), "ids": pa.nulls(n, pa.binary()), "checks": pa.nulls(n, pa.binary())})

    return run


def tell_copies(parts: int):
    """Arrow mapper over (id, check): the rows that need no search, by home part."""

    def run(batches):
        for batch in batches:
            ids = _ids(batch.column(0))
            made = _pack(_home(ids, parts), parts, {"ids": ids, "checks": batch.column(1).to_numpy().astype(np.uint32)})
            n = len(made["part"])
            yield pa.RecordBatch.from_arrays([pa.array(made["part"], pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                                              pa.array(made["ids"], pa.binary()), pa.array(made["checks"], pa.binary())],
                                             names=["part", "bucket", "keys", "ids", "checks"])

    return run


def _later(*keys_then_order: np.ndarray, keys: int) -> np.ndarray:
    """Whether an earlier row (by the columns after the first ``keys``) has the same keys."""
    order = np.lexsort(keys_then_order[::-1])
    out = np.zeros(len(order), dtype=bool)
    if len(order):
        group = _groups(*[k[order] for k in keys_then_order[:keys]])
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))[group]
        out[order] = np.any([o[order] != o[order][first] for o in keys_then_order[keys:]], axis=0)
    return out


_ASKED = "bucket int, his binary, los binary, ids binary, checks binary, starts binary, s_part int, s_ids binary, s_checks binary, s_starts binary, s_ends binary"


def candidate_windows(buckets: int, parts: int, size: int, period: int):
    """Arrow cogroup mapper (what the part was told, its texts): the windows around repeated anchors, by bucket of their
    hash, and the spans that are known to go."""

    def run(told: pa.Table, texts: pa.Table) -> pa.Table:
        known = [np.frombuffer(k.as_buffer(), dtype=np.uint32).astype(_U) | (_U(b.as_py()) << _U(32))
                 for b, k in zip(told.column("bucket"), told.column("keys"), strict=True) if k.is_valid]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, _U)
        skip = set(zip(_unpack(told, "ids", np.int64).tolist(), _unpack(told, "checks", np.uint32).tolist(), strict=True))
        found = [(np.zeros(0, _U),) * 2 + (np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64))]
        for batch in texts.combine_chunks().to_batches():
            ids = _ids(batch.column("id"))
            for i, j, raw, off in kernels.chunked(batch.column("text")):
                s = Sequence(raw, off)
                own = ids[i:j]
                use = np.zeros(s.docs, dtype=bool)
                for d, name in enumerate(zip(own.tolist(), s.check.tolist(), strict=True)):
                    if name not in skip:  # equal rows are searched once
                        use[d] = True
                        skip.add(name)
                at, key = s.anchors(size, period)
                bucket, low = _named(key, buckets)
                wide = low.astype(_U) | (bucket.astype(_U) << _U(32))
                place = np.searchsorted(known, wide)
                hit = np.zeros(len(at), dtype=bool)
                inside = place < len(known)
                hit[inside] = known[place[inside]] == wide[inside]
                total = np.zeros(len(s.word) + period + 1, dtype=np.int64)
                total[at[hit] + 1] = 1
                total = np.cumsum(total)
                w = np.flatnonzero(use[s.doc] & (s.place + size <= s.count[s.doc]))
                w = w[total[w + period] > total[w]]
                found.append((s.runs(size, _STEP_A)[w], s.runs(size, _STEP_B)[w], own[s.doc[w]], s.check[s.doc[w]], s.place[w]))
        hi, lo, ids, checks, start = (np.concatenate(x) for x in zip(*found, strict=True))
        again = _later(hi, lo, ids, start, keys=2)
        known_spans = _pack_spans(ids[again], checks[again], start[again], start[again] + size, parts)
        send = ~again
        bucket = (hi[send] % _U(buckets)).astype(np.int64)
        made = _pack(bucket, buckets, {"his": (hi[send] >> _U(32)).astype(np.uint32), "los": lo[send], "ids": ids[send],
                                       "checks": checks[send], "starts": start[send].astype(np.uint32)})
        n, m = len(made["part"]), len(known_spans["part"])
        return pa.table({
            "bucket": pa.array(made["part"] + [p % buckets for p in known_spans["part"]], pa.int32()),
            **{k: pa.array(made[k] + [None] * m, pa.binary()) for k in ("his", "los", "ids", "checks", "starts")},
            "s_part": pa.array([None] * n + known_spans["part"], pa.int32()),
            **{f"s_{k}": pa.array([None] * n + known_spans[k], pa.binary()) for k in ("ids", "checks", "starts", "ends")}})

    return run


def order_windows(parts: int, size: int):
    """Arrow group mapper over a bucket of candidates: the spans of all but the earliest of equal windows, and the known ones."""

    def run(table: pa.Table) -> pa.Table:
        hi, lo, ids = _unpack(table, "his", np.uint32), _unpack(table, "los", _U), _unpack(table, "ids", np.int64)
        checks, start = _unpack(table, "checks", np.uint32), _unpack(table, "starts", np.uint32).astype(np.int64)
        gone = _later(hi, lo, ids, start, keys=2)
        made = _pack_spans(ids[gone], checks[gone], start[gone], start[gone] + size, parts)
        known = table.filter(pa.compute.is_valid(table.column("s_part")))
        return pa.table({"part": pa.array(made["part"] + known.column("s_part").to_pylist(), pa.int32()),
                         **{k: pa.array(made[k] + known.column(f"s_{k}").to_pylist(), pa.binary()) for k in ("ids", "checks", "starts", "ends")}})

    return run


def cut_words(digest: bool):
    """Arrow cogroup mapper (spans of a part, its texts): the words that stay, joined by one space, or their sha256 in hex."""

    def run(spans: pa.Table, texts: pa.Table) -> pa.Table:
        v_ids, v_checks, bounds, (start, end) = _by_document(
            _unpack(spans, "ids", np.int64), _unpack(spans, "checks", np.uint32), _unpack(spans, "starts", np.uint32), _unpack(spans, "ends", np.uint32))
        out = []
        for batch in texts.combine_chunks().to_batches():
            ids = _ids(batch.column("id"))
            for i, j, raw, off in kernels.chunked(batch.column("text")):
                s = Sequence(raw, off)
                row = _row_of(v_ids, v_checks, ids[i:j], s.check)
                for doc in np.flatnonzero(row >= 0):
                    a, b = bounds[row[doc]], bounds[row[doc] + 1]
                    depth = np.zeros(int(s.count[doc]) + 1, dtype=np.int32)
                    np.add.at(depth, start[a:b].astype(np.int64), 1)
                    np.add.at(depth, end[a:b].astype(np.int64), -1)
                    stays = np.cumsum(depth[:-1]) == 0
                    kept = b" ".join(compress(raw[off[doc]: off[doc + 1]].tobytes().split(), stays.tolist()))
                    out.append((int(ids[i + doc]), int(s.check[doc]), int((~stays).sum()), hashlib.sha256(kept).hexdigest() if digest else kept.decode()))
        kinds = {"id": pa.int64(), "check": pa.int64(), "n_removed": pa.int64(), "kept": pa.string()}
        return pa.table({k: pa.array([r[i] for r in out], kind) for i, (k, kind) in enumerate(kinds.items())})

    return run


def remove_repeated_windows(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, period: int = PERIOD,
                            digest: bool = False) -> DataFrame:
    """key, n_words, n_removed and kept (the words that stay, joined by one space; with ``digest`` their sha256) of every row."""
    spark = df.sparkSession
    base = df.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, parts = (max(int(spark.sparkContext.defaultParallelism), -(-total // per)) for per in (PER_BUCKET, PER_PART))
    # copies: all rows of a word sequence but those of its smallest id
    order = F.coalesce("id", F.lit(NULL_ID))
    rows = cut_lineage(base.mapInArrow(profiles, "id long, n long, sha binary, check long").withColumn(
        "salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")))
    classes = rows.filter(F.col("n") >= size).groupBy("sha").agg(F.min(order).alias("rep"), F.max(order).alias("top")).filter("top > rep")
    salted = classes.select("sha", "rep", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = cut_lineage(rows.join(salted, ["sha", "salt"], "left").select(
        "id", "n", "sha", "check", (order > F.coalesce("rep", F.lit(NULL_ID))).alias("copy")))
    copies = rows.filter("copy").select("id", "check").mapInArrow(tell_copies(parts), _TOLD)
    told = base.mapInArrow(send_anchors(buckets, parts, size, period), "bucket int, keys binary, parts binary").groupBy("bucket").applyInArrow(
        repeated_anchors(parts), _TOLD)
    told = cut_lineage(told.union(copies))
    texts = lambda bitmap=None: base.mapInArrow(with_home(parts, bitmap), "part int, id long, text string").groupBy("part")
    asked = told.groupBy("part").cogroup(texts()).applyInArrow(candidate_windows(buckets, parts, size, period), _ASKED)
    spans = cut_lineage(asked.groupBy("bucket").applyInArrow(
        order_windows(parts, size), "part int, ids binary, checks binary, starts binary, ends binary"))
    touched = bloom.build(spans.groupBy("part").applyInArrow(part_ids, "id long"), "id")
    cut = spans.groupBy("part").cogroup(texts(touched)).applyInArrow(cut_words(digest), "id long, check long, n_removed long, kept string")
    cut = cut.dropDuplicates(["id", "check"]).withColumnsRenamed({"id": "_i", "check": "_c"})
    joined = rows.withColumn("_id", order).join(cut, (F.col("_id") == F.col("_i")) & (F.col("check") == F.col("_c")), "left")
    if not digest:
        whole = base.mapInArrow(whole_texts, "id long, check long, whole string").dropDuplicates(["id", "check"])
        joined = joined.join(whole.withColumnsRenamed({"id": "_wi", "check": "_wc"}),
                             F.col("id").eqNullSafe(F.col("_wi")) & (F.col("check") == F.col("_wc")), "left")
    nothing = F.sha2(F.lit(""), 256) if digest else F.lit("")
    same = F.lower(F.hex("sha")) if digest else F.col("whole")
    return joined.select(
        F.col("id").alias(key), F.col("n").alias("n_words"),
        F.when(F.col("copy"), F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), nothing).when(F.col("_i").isNotNull(), F.col("kept")).otherwise(same).alias("kept"))


def whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow mapper over (id, text): check and words joined by one space of a row."""
    for batch in batches:
        for i, j, raw, off in kernels.chunked(batch.column(1)):
            whole = [b" ".join(raw[a:b].tobytes().split()).decode() for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(Sequence(raw, off).check.astype(np.int64)), pa.array(whole, pa.string())],
                                             names=["id", "check", "whole"])
