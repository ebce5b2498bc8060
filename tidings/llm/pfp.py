"""Removal of repeated 50-byte strings by prefix-free parsing.

A rolling hash over ``GRAM`` bytes picks triggers: in every 50-byte string the trigger is the gram of smallest
hash (the leftmost of equal ones), so equal strings have the same trigger at the same place, and every string
has one. The triggers parse a text into phrases; a phrase is the trigger with all bytes of the 50-byte strings
that it stands for, so neighbouring phrases overlap and the order of the suffixes up to 50 bytes is settled
inside the dictionary of phrases.

1. Parse: every phrase goes to a bucket of its trigger. There the dictionary is sorted by (trigger, phrase,
   document): a phrase that a smaller document has too is repeated as a whole; phrases that share only the
   trigger stay in question.
2. The phrases in question go, as bytes, to buckets of their trigger; there their 50-byte suffixes are sorted by
   (string, document), and all but those of the smallest document are repeated.
3. The bytes of all repeated strings are cut out.

Copies are settled in step 1, phrase by phrase; only edges of repeated passages reach step 2. Both steps combine
inside the map task first (a string that a smaller document of the same task has is repeated, whatever others
say), so a passage of a third of all documents is sent once per task, not once per document. Strings are
compared by 64-bit fingerprints inside buckets that an independent hash chooses.

Defined results: a null text is empty; matches never cross documents; rows that share an id never remove from
each other; a null id counts as larger than any; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm import bloom, kernels
from tidings.session import cut_lineage

LENGTH = 50
GRAM = 16
PER_BUCKET = 32 << 20  # bytes of text whose phrases one sorting task holds
PER_PASS = 1 << 20  # phrases or strings that one sort inside a task holds
PER_PART = 4 << 20  # bytes of text that one parsing or cutting task holds
HOT = 16  # phrases of one trigger in one task; of more, only the smallest document's is sent, marked if others stay
NULL_ID = 2**63 - 1

_U = np.uint64


class Parse:
    """Phrases of a chunk of texts: owner, first and last start of the 50-byte strings, trigger and phrase hashes."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, length: int = LENGTH, phrases: bool = True):
        n = len(raw)
        self.length = length
        p, self._q = kernels.powers(n + 1)
        self._prefix = np.zeros(n + 1, dtype=_U)
        np.cumsum(kernels.BYTE_HASH[raw] * p[:n], out=self._prefix[1:])
        empty = np.zeros(0, dtype=np.int64)
        self.owner = self.lo = self.hi = self.at = empty
        self.order = empty
        if n < length or not phrases:
            return
        ends = np.arange(GRAM, n + 1)
        gram = kernels.mix((self._prefix[ends] - self._prefix[: n - GRAM + 1]) * self._q[: n - GRAM + 1])
        rank = (gram >> _U(32)).astype(np.uint32)
        span = length - GRAM + 1
        best = np.arange(len(rank), dtype=np.int32)
        wide = 1
        while wide < span:  # leftmost smallest of 2, 4, ... then ``span`` grams
            step = min(wide, span - wide)
            later = rank[step:] < rank[: len(rank) - step]
            best = np.where(later, best[step:], best[: len(best) - step])
            rank = np.where(later, rank[step:], rank[: len(rank) - step])
            wide += step
        doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(best)]
        ok = np.flatnonzero(np.arange(len(best)) + length <= off[1:][doc])
        if not len(ok):
            return
        best, doc = best[ok], doc[ok]
        cut = np.ones(len(ok), dtype=bool)
        cut[1:] = (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(cut)
        self.lo, self.hi = ok[first], ok[np.append(first[1:], len(ok)) - 1]
        self.at, self.owner = best[first].astype(np.int64), doc[first]
        runs = np.bincount(self.owner, minlength=len(off) - 1)
        self.order = np.arange(len(first)) - (np.cumsum(runs) - runs)[self.owner]
        self._gram = gram

    def triggers(self) -> np.ndarray:
        return self._gram[self.at] if len(self.at) else np.zeros(0, dtype=_U)

    def strings(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return kernels.mix((self._prefix[end] - self._prefix[start]) * self._q[start] + (end - start).astype(_U) * _U(0x9E3779B97F4A7C15))

    def phrases(self) -> np.ndarray:
        return kernels.mix(self.strings(self.lo, self.hi + self.length) + (self.at - self.lo).astype(_U))


def _texts(batch: pa.RecordBatch, phrases: bool = True):
    """Chunks of (ids, checks, Parse, bytes, offsets); a check is 32 bits of the text's own hash."""
    ids = np.asarray(batch.column("id").fill_null(NULL_ID).to_numpy(zero_copy_only=False), dtype=np.int64)
    for i, j, raw, off in kernels.chunked(batch.column("text")):
        p = Parse(raw, off, phrases=phrases)
        yield ids[i:j], (p.strings(off[:-1], off[1:]) >> _U(32)).astype(np.uint32), p, raw, off


def _pack(where: np.ndarray, parts: int, columns: dict[str, np.ndarray]) -> dict[str, list]:
    """Rows of ``columns`` as one blob per used part, in part order."""
    order = np.argsort(where, kind="stable")
    edge = np.searchsorted(where[order], np.arange(parts + 1))
    used = np.flatnonzero(np.diff(edge))
    out: dict[str, list] = {"part": used.tolist()}
    for name, values in columns.items():
        values = values[order]
        out[name] = [values[edge[b]: edge[b + 1]].tobytes() for b in used]
    return out


def _home(ids: np.ndarray, parts: int) -> np.ndarray:
    return (kernels.mix(ids.view(_U) + _U(77)) % _U(parts)).astype(np.int64)


def _unpack(table: pa.Table, name: str, kind) -> np.ndarray:
    got = [np.frombuffer(x.as_buffer(), dtype=kind) for x in table.column(name) if x.is_valid]
    return np.concatenate(got) if got else np.zeros(0, dtype=kind)


def _smallest(group: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For rows sorted by group (0, 1, ...): the smallest id of the row's group."""
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, int)
    return np.minimum.reduceat(ids, starts)[group] if len(group) else ids


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Group numbers of rows sorted by ``keys``."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new) - 1


WHOLE, OPEN = 0, 1  # verdicts on a phrase: repeated as a whole; in question
_PHRASES = "bucket int, triggers binary, phrases binary, ids binary, checks binary, orders binary, v_ids binary, v_checks binary, v_orders binary"
_VERDICTS = "part int, ids binary, checks binary, orders binary"


def parse_phrases(buckets: int):
    """Arrow mapper over (id, text): the phrases by bucket of their trigger, and what the task can tell itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, checks, p, _, _ in _texts(batch):
                if not len(p.at):
                    continue
                t, c, d = p.triggers(), p.phrases(), ids[p.owner]
                whole, held, send, more = _settled(t, c, d)
                v = np.flatnonzero(whole | held)
                verdict = np.where(whole[v], WHOLE, OPEN).astype(np.uint32)
                # rows stay in text order inside a bucket, so ids, checks and orders compress in the shuffle
                made = _pack(((t[send] >> _U(20)) % _U(buckets)).astype(np.int64), buckets, {
                    "triggers": (t[send] & _U(0xFFFFFFFF)).astype(np.uint32), "phrases": (c[send] >> _U(32)).astype(np.uint32),
                    "ids": d[send], "checks": checks[p.owner[send]], "orders": (p.order[send].astype(np.uint32) << np.uint32(1)) | more[send].astype(np.uint32)})
                n = len(made["part"])
                row = int(t[0] % _U(n))  # the chunk's own verdicts ride with any bucket, not all chunks' with the first
                extra = lambda x: pa.array([None] * row + [x.tobytes()] + [None] * (n - 1 - row), pa.binary())  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made["part"], pa.int32()), *(pa.array(made[k], pa.binary()) for k in ("triggers", "phrases", "ids", "checks", "orders")),
                     extra(d[v]), extra(checks[p.owner[v]]), extra((p.order[v].astype(np.uint32) << np.uint32(1)) | verdict)],
                    names=[x.split()[0] for x in _PHRASES.split(", ")])

    return run


def _settled(t: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What a task can tell of its phrases (trigger, phrase, id), in their order: repeated as a whole; of a hot
    trigger and so in question at once; to be sent to the trigger's bucket; of a trigger with phrases not sent."""
    order = np.lexsort((d, c, t))
    t, c, d = t[order], c[order], d[order]
    same, trig = _groups(t, c), _groups(t)
    whole = d > _smallest(same, d)  # a smaller document of the task has the phrase
    hot = np.bincount(trig)[trig] > HOT
    send = ~whole & (~hot | (d == _smallest(trig, d)))
    more = (np.bincount(trig, weights=~whole & ~send) > 0)[trig]
    out = np.zeros((4, len(t)), dtype=bool)
    out[:, order] = whole, hot & ~whole, send, more
    return out[0], out[1], out[2], out[3]


def sort_dictionary(parts: int, per_pass: int = PER_PASS):
    """Arrow group mapper over a bucket: verdicts on its phrases, by home part of the document."""

    def run(table: pa.Table) -> pa.Table:
        t, c, d = _unpack(table, "triggers", np.uint32), _unpack(table, "phrases", np.uint32), _unpack(table, "ids", np.int64)
        checks, nth = _unpack(table, "checks", np.uint32), _unpack(table, "orders", np.uint32)
        more, nth = (nth & np.uint32(1)) > 0, nth >> np.uint32(1)
        whole, open_ = np.zeros(len(t), dtype=bool), np.zeros(len(t), dtype=bool)
        passes = 1 + len(t) // per_pass
        for k in range(passes):  # triggers apart, so that a sort holds about ``per_pass`` phrases
            at = np.flatnonzero(t % np.uint32(passes) == k) if passes > 1 else np.arange(len(t))
            at = at[np.lexsort((d[at], c[at], t[at]))]
            if not len(at):
                continue
            same, trig, ids = _groups(t[at], c[at]), _groups(t[at]), d[at]
            again = ids > _smallest(same, ids)
            # in question: the trigger has several phrases, and not all in one document, or a task kept some back
            last = np.append(np.flatnonzero(trig[1:] != trig[:-1]), len(trig) - 1)
            first = np.concatenate(([0], last[:-1] + 1))
            many = (same[last] > same[first]) & (np.maximum.reduceat(ids, first) > np.minimum.reduceat(ids, first))
            many |= np.maximum.reduceat(more[at], first)
            whole[at], open_[at] = again, ~again & many[trig]
        v = np.flatnonzero(whole | open_)
        ids = np.concatenate([d[v], _unpack(table, "v_ids", np.int64)])
        checks = np.concatenate([checks[v], _unpack(table, "v_checks", np.uint32)])
        orders = np.concatenate([(nth[v] << np.uint32(1)) | np.where(whole[v], WHOLE, OPEN).astype(np.uint32),
                                 _unpack(table, "v_orders", np.uint32)])
        made = _pack(_home(ids, parts), parts, {"ids": ids, "checks": checks, "orders": orders})
        return pa.table({"part": pa.array(made["part"], pa.int32()), **{k: pa.array(made[k], pa.binary()) for k in ("ids", "checks", "orders")}})

    return run


def part_ids(table: pa.Table) -> pa.Table:
    """Arrow group mapper: the distinct ids of a part."""
    return pa.table({"id": pa.array(np.unique(_unpack(table, "ids", np.int64)))})


def with_home(parts: int, bitmap: np.ndarray | None = None):
    """Arrow mapper over (id, text): the texts (with ``bitmap``, those whose id may be in it) and their home part."""

    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column("id").fill_null(NULL_ID).to_numpy(zero_copy_only=False), dtype=np.int64)
            hit = np.ones(len(ids), dtype=bool) if bitmap is None else bloom.test(bitmap, ids)
            got = batch.filter(pa.array(hit))
            yield pa.RecordBatch.from_arrays([pa.array(_home(ids[hit], parts).astype(np.int32)), pa.array(ids[hit]), got.column("text")],
                                             names=["part", "id", "text"])

    return run


def _row_of(ids: np.ndarray, checks: np.ndarray, want_ids: np.ndarray, want_checks: np.ndarray) -> np.ndarray:
    """Row number in (ids, checks) for every wanted pair, -1 where there is none."""
    at = {k: r for r, k in enumerate(zip(ids.tolist(), checks.tolist(), strict=True))}
    return np.array([at.get(k, -1) for k in zip(want_ids.tolist(), want_checks.tolist(), strict=True)], dtype=np.int64)


def _by_document(ids: np.ndarray, checks: np.ndarray, *values: np.ndarray):
    """Rows sorted by (id, check): the distinct pairs, their bounds, and the sorted values."""
    order = np.lexsort((checks, ids))
    ids, checks = ids[order], checks[order]
    g = _groups(ids, checks) if len(ids) else np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else np.zeros(0, np.int64)
    return ids[first], checks[first], np.append(first, len(ids)), [v[order] for v in values]


_OPEN = ("bucket int, lengths binary, bytes binary, ids binary, checks binary, starts binary, "
         "s_part int, s_ids binary, s_checks binary, s_starts binary, s_ends binary")


def open_strings(buckets: int, parts: int):
    """Arrow cogroup mapper (verdicts, texts of a part): the phrases in question, as bytes, by bucket of their
    trigger, and the spans that are known to go (in rows of any bucket)."""

    def run(verdicts: pa.Table, texts: pa.Table) -> pa.Table:
        v_ids, v_checks, bounds, (orders,) = _by_document(
            _unpack(verdicts, "ids", np.int64), _unpack(verdicts, "checks", np.uint32), _unpack(verdicts, "orders", np.uint32))
        spans, asked = [], []
        for batch in texts.combine_chunks().to_batches():
            for ids, checks, p, raw, off in _texts(batch):
                row = _row_of(v_ids, v_checks, ids, checks)
                flag = np.full(len(p.at), 9, dtype=np.int8)
                starts = np.searchsorted(p.owner, np.arange(len(ids)))
                for doc in np.flatnonzero(row >= 0):
                    o = orders[bounds[row[doc]]: bounds[row[doc] + 1]]
                    np.minimum.at(flag, starts[doc] + (o >> np.uint32(1)).astype(np.int64), (o & np.uint32(1)).astype(np.int8))
                w = np.flatnonzero(flag == WHOLE)
                own = p.owner[w]
                spans.append((ids[own], checks[own], p.lo[w] - off[own], p.hi[w] + LENGTH - off[own]))
                q = np.flatnonzero(flag == OPEN)
                n = p.hi[q] - p.lo[q] + 1
                which = np.repeat(np.arange(len(q)), n)
                s = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + p.lo[q][which]
                own = p.owner[q][which]
                again = _repeated(p.strings(s, s + LENGTH), ids[own])
                spans.append((ids[own][again], checks[own][again], (s - off[own])[again], (s - off[own])[again] + LENGTH))
                # of a phrase, what lies between its first and last string that no smaller document here has
                rest = np.flatnonzero(~again)
                lo = np.full(len(q), np.iinfo(np.int64).max)
                hi = np.full(len(q), -1)
                np.minimum.at(lo, which[rest], s[rest])
                np.maximum.at(hi, which[rest], s[rest])
                some = np.flatnonzero(hi >= 0)
                lo, size, own = lo[some], hi[some] + LENGTH - lo[some], p.owner[q][some]
                byte = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
                asked.append((p.triggers()[q][some], size.astype(np.uint16), raw[byte], ids[own], checks[own], (lo - off[own]).astype(np.uint32)))
        trig, size, raw, ids, checks, s = (np.concatenate(x) for x in zip(*asked, strict=True)) if asked else (np.zeros(0, _U),) * 6
        where = ((trig >> _U(7)) % _U(buckets)).astype(np.int64)
        made = _pack(where, buckets, {"lengths": size.astype(np.uint16), "ids": ids.astype(np.int64), "checks": checks.astype(np.uint32),
                                      "starts": s.astype(np.uint32)})
        made["bytes"] = _pack(np.repeat(where, size.astype(np.int64)), buckets, {"bytes": raw.astype(np.uint8)})["bytes"]
        told = _pack_spans(*(np.concatenate(x) for x in zip(*spans, strict=True)), parts) if spans else {"part": []}
        n, m = len(made["part"]), len(told["part"])
        first = [None] * m
        return pa.table({
            "bucket": pa.array(made["part"] + [p % buckets for p in told["part"]], pa.int32()),
            **{k: pa.array(made[k] + first, pa.binary()) for k in ("lengths", "bytes", "ids", "checks", "starts")},
            "s_part": pa.array([None] * n + told["part"], pa.int32()),
            **{f"s_{k}": pa.array([None] * n + told.get(k, []), pa.binary()) for k in ("ids", "checks", "starts", "ends")}})

    return run


def _repeated(key: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether a smaller id has the same key, in the rows' order."""
    order = np.lexsort((ids, key))
    out = np.zeros(len(key), dtype=bool)
    if len(key):
        out[order] = ids[order] > _smallest(_groups(key[order]), ids[order])
    return out


def _pack_spans(ids, checks, start, end, parts: int) -> dict[str, list]:
    """Spans merged where they touch inside a document, as blobs by home part."""
    ids, checks, start, end = ids.astype(np.int64), checks.astype(np.uint32), start.astype(np.int64), end.astype(np.int64)
    order = np.lexsort((start, checks, ids))
    ids, checks, start, end = ids[order], checks[order], start[order], end[order]
    if len(ids):
        doc = _groups(ids, checks)
        reach = np.maximum.accumulate(end + doc * (int(end.max()) + 1)) - doc * (int(end.max()) + 1)
        new = np.ones(len(ids), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(ids)) - 1
        ids, checks, start, end = ids[first], checks[first], start[first], reach[last]
    return _pack(_home(ids, parts), parts, {
        "ids": ids, "checks": checks, "starts": start.astype(np.uint32), "ends": end.astype(np.uint32)})


def sort_strings(parts: int, per_pass: int = PER_PASS):
    """Arrow group mapper over a bucket of phrases in question: their 50-byte suffixes sorted by (string, document);
    the spans of all but the smallest document's go, with the spans that were known before."""

    def run(table: pa.Table) -> pa.Table:
        size = _unpack(table, "lengths", np.uint16).astype(np.int64)
        raw, ids = _unpack(table, "bytes", np.uint8), _unpack(table, "ids", np.int64)
        checks, start = _unpack(table, "checks", np.uint32), _unpack(table, "starts", np.uint32)
        first = np.cumsum(size) - size
        n = size - LENGTH + 1
        passes = 1 + int(n.sum()) // per_pass
        gone = [_again(raw, first, n, ids, passes, k) for k in range(passes)]
        which, inside = (np.concatenate(x) for x in zip(*gone, strict=True))
        at = start[which] + inside
        made = _pack_spans(ids[which], checks[which], at, at + LENGTH, parts)
        known = table.filter(pa.compute.is_valid(table.column("s_part")))
        return pa.table({"part": pa.array(made["part"] + known.column("s_part").to_pylist(), pa.int32()),
                         **{k: pa.array(made[k] + known.column(f"s_{k}").to_pylist(), pa.binary()) for k in ("ids", "checks", "starts", "ends")}})

    return run


def _again(raw, first, n, ids, passes: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, offset) of the 50-byte strings, of those whose hash is ``k`` modulo ``passes``, that a smaller id has."""
    keys, phrase, inside = [], [], []
    i = 0
    bytes_to = np.append(first, len(raw))
    while i < len(n):
        j = max(int(np.searchsorted(bytes_to, bytes_to[i] + kernels.CHUNK_BYTES, side="right")) - 1, i + 1)
        base, top = int(bytes_to[i]), int(bytes_to[j])
        p, q = kernels.powers(top - base + 1)
        prefix = np.zeros(top - base + 1, dtype=_U)
        np.cumsum(kernels.BYTE_HASH[raw[base:top]] * p[:-1], out=prefix[1:])
        which = np.repeat(np.arange(i, j, dtype=np.int32), n[i:j])
        at = np.arange(len(which)) - np.repeat(np.cumsum(n[i:j]) - n[i:j], n[i:j])
        s = first[which] - base + at
        key = kernels.mix((prefix[s + LENGTH] - prefix[s]) * q[s])
        mine = np.flatnonzero(key % _U(passes) == k) if passes > 1 else np.arange(len(key))
        keys.append(key[mine])
        phrase.append(which[mine])
        inside.append(at[mine].astype(np.uint16))
        i = j
    if not keys:
        return np.zeros(0, np.int32), np.zeros(0, np.uint16)
    phrase, inside = np.concatenate(phrase), np.concatenate(inside)
    again = _repeated(np.concatenate(keys), ids[phrase])
    return phrase[again], inside[again]


def cut_out(digest: bool):
    """Arrow cogroup mapper (spans, texts of a part): what is left of the texts, or its sha256 in hex."""

    def run(spans: pa.Table, texts: pa.Table) -> pa.Table:
        return _cut_out(spans, texts, digest)

    return run


def _cut_out(spans: pa.Table, texts: pa.Table, digest: bool) -> pa.Table:
    v_ids, v_checks, bounds, (start, end) = _by_document(
        _unpack(spans, "ids", np.int64), _unpack(spans, "checks", np.uint32), _unpack(spans, "starts", np.uint32), _unpack(spans, "ends", np.uint32))
    out = []
    for batch in texts.combine_chunks().to_batches():
        for ids, checks, _, raw, off in _texts(batch, phrases=False):
            row = _row_of(v_ids, v_checks, ids, checks)
            for doc in np.flatnonzero(row >= 0):
                a, b = bounds[row[doc]], bounds[row[doc] + 1]
                n = int(off[doc + 1] - off[doc])
                depth = np.zeros(n + 1, dtype=np.int32)
                np.add.at(depth, start[a:b].astype(np.int64), 1)
                np.add.at(depth, end[a:b].astype(np.int64), -1)
                gone = np.cumsum(depth[:n]) > 0
                text = raw[off[doc]: off[doc + 1]]
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((int(ids[doc]), hashlib.sha256(text.tobytes()).hexdigest(), int(gone.sum()), runs,
                            hashlib.sha256(text[~gone].tobytes()).hexdigest() if digest else text[~gone].tobytes()))
    kinds = {"id": pa.int64(), "sha": pa.string(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept": pa.string() if digest else pa.binary()}
    return pa.table({k: pa.array([r[i] for r in out], kind) for i, (k, kind) in enumerate(kinds.items())})


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", digest: bool = False,
                   per_pass: int = PER_PASS) -> DataFrame:
    """key, n_bytes, n_removed, n_spans and kept (the bytes that are left; with ``digest`` their sha256) for every row."""
    spark = df.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = df.select(F.col(key).cast("long").alias("id"), body.alias("text"))
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, parts = (max(int(spark.sparkContext.defaultParallelism), -(-total // per)) for per in (PER_BUCKET, PER_PART))
    verdicts = cut_lineage(base.mapInArrow(parse_phrases(buckets), _PHRASES).groupBy("bucket").applyInArrow(
        sort_dictionary(parts, per_pass), _VERDICTS))
    texts = lambda bitmap=None: base.mapInArrow(with_home(parts, bitmap), "part int, id long, text string").groupBy("part")
    told = verdicts.groupBy("part").cogroup(texts()).applyInArrow(open_strings(buckets, parts), _OPEN)
    spans = cut_lineage(told.groupBy("bucket").applyInArrow(
        sort_strings(parts, per_pass), "part int, ids binary, checks binary, starts binary, ends binary"))
    touched = bloom.build(spans.groupBy("part").applyInArrow(part_ids, "id long"), "id")
    cut = spans.groupBy("part").cogroup(texts(touched)).applyInArrow(
        cut_out(digest), f"id long, sha string, n_removed long, n_spans long, kept {'string' if digest else 'binary'}")
    cut = cut.dropDuplicates(["id", "sha"]).withColumnsRenamed({"id": "_i", "sha": "_h"})
    sha = F.sha2(F.col("text").cast("binary"), 256)
    rows = base.select("id", F.coalesce("id", F.lit(NULL_ID)).alias("_id"), sha.alias("_sha"), F.octet_length("text").cast("long").alias("n_bytes"),
                       (sha if digest else F.col("text").cast("binary")).alias("_whole"))
    joined = rows.join(cut, (F.col("_id") == F.col("_i")) & (F.col("_sha") == F.col("_h")), "left")
    return joined.select(
        F.col("id").alias(key), "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.when(F.col("_i").isNull(), F.col("_whole")).otherwise(F.col("kept")).alias("kept"))
