"""Grouping of spelling variants by pivotal grams.

Two words that differ by one inserted, deleted or replaced code point share all bigrams that the edit does not
touch, and one edit touches at most one of two disjoint bigrams. Bigrams are ordered by their number in the
vocabulary, rare ones first. A word's gram prefix is its three rarest bigrams (and all its occurrences of bigrams no
commoner than the third); its pivots are the two disjoint bigrams of the prefix of least total number, chosen by
dynamic programming. Of two near words let the first be the one whose prefix ends at the rarer bigram: one of its
pivots survives and so lies in the prefix of the other. So pivots are looked up among the gram prefixes.

Positions limit the search: the edit lies wholly before or wholly after a surviving bigram, so the bigram keeps its
place from the end or from the start, and the text from it to that end is equal. The index key is the hash of the
side, that text and the word's length; a pivot looks for its own length and one more or less. An edit that spares the
second pivot lies before it, any other lies after the first, so the first looks to its left and the second to its
right only. With a key go two 64-bit maps of the word, which bigrams it has and which letters it has an odd number of
times; one edit changes four bits of the one and two of the other at most, and pairs that differ in more never leave
the join.

Some keys are common all the same (two letters at the start, say). Where index rows and look-ups of a key would make
more than ``HOT`` pairs, its rows are keyed anew: what lies on the other side of the key, where the edit is, is one
edit apart, so the two share that text or the text less one code point. The number of rows grows by the length of a
word there, and the pairs stay in proportion to the words. Candidates are verified on the words themselves (edit
distance 1), so a clash of hashes only adds candidates.

The number of different bigrams is bounded by the square of the alphabet of ``LETTERS`` (90 letters after
lower-casing, 8,100 bigrams), so their numbers are the one thing the driver holds. The vocabulary never leaves the cluster.

Defined results: a null text has no words; a run of a row whose id is null keeps all its letters; rows that repeat
count as often as they occur; an empty table gives an empty result; other columns are ignored. A word of
any length is handled: keys are hashes, rows name words by number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm import kernels
from tidings.session import cut_lineage, stage_scope

LETTERS = "[A-Za-zÀ-ÿ]+"
SHORTEST, FEWEST = 5, 3  # code points and occurrences of a word
DELETE_ONE_IN = 97
TIMES = 2  # a form occurs at least so many times as often as the word
GRAM, EDITS = 2, 1
HOT = 256  # pairs of a key that are listed; the rows of a key with more are keyed anew

_U = np.uint64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def thinned(run: Column, key: Column, one_in: int = DELETE_ONE_IN) -> Column:
    """``run`` without one code point where the crc32 of ``key:run`` is a multiple of ``one_in``."""
    h = F.crc32(F.concat(key.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % one_in == 0, cut).otherwise(run)


def vocabulary(df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """(word, n) of the words of ``df``; counts are combined inside the tasks before they move."""
    runs = F.regexp_extract_all(F.translate(F.col(text).cast("string"), _UPPER, _LOWER), F.lit(LETTERS), F.lit(0))
    each = df.select(F.col(key).alias("k"), F.explode(runs).alias("run"))
    words = each.select(thinned(F.col("run"), F.col("k")).alias("word")).filter(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= fewest)


def gram_order(words: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the vocabulary's bigrams in ascending order, their ranks (rarest first) and their numbers."""
    starts = F.sequence(F.lit(1), F.char_length("word") - (GRAM - 1))
    grams = words.filter(F.char_length("word") >= GRAM).select(F.explode(F.transform(starts, lambda i: F.substr(F.col("word"), i, F.lit(GRAM)))).alias("g"))
    got = grams.groupBy("g").agg(F.count(F.lit(1)).alias("c")).toArrow()
    code = np.array([(ord(g[0]) << 21) | ord(g[1]) for g in got.column("g").to_pylist()], dtype=np.int64)
    count = got.column("c").to_numpy()
    order = np.argsort(code)
    code, count = code[order], count[order]
    rank = np.empty(len(code), dtype=np.int64)
    rank[np.lexsort((code, count))] = np.arange(len(code))
    return code, rank, count


def rare_disjoint(places: list[int], costs: list[int], take: int, width: int) -> list[int]:
    """Places of the ``take`` grams of least total cost that do not overlap (dynamic programming over ascending places)."""
    none = (float("inf"), ())
    best = [[(0, ())] + [none] * take]  # best[i][k]: cost and choice of k among the first i grams
    free = 0  # number of grams that end before the current one
    for i, (at, cost) in enumerate(zip(places, costs, strict=True)):
        while places[free] + width <= at:
            free += 1
        row = [best[i][0]]
        for k in range(1, take + 1):
            before, chosen = best[free][k - 1]
            with_it = (before + cost, (chosen, at))
            row.append(with_it if with_it[0] < best[i][k][0] else best[i][k])
        best.append(row)
    out, chosen = [], best[-1][take][1]
    while chosen:
        chosen, at = chosen
        out.append(at)
    return out[::-1]


def _spans(words: list[str]):
    """Code points of the words put together, lengths, firsts, and hashes of spans: whole, and less one of their places."""
    point = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    length = np.array([len(w) for w in words], dtype=np.int64)
    p, q = kernels.powers(len(point) + 2)
    prefix = np.zeros(len(point) + 1, dtype=_U)
    np.cumsum(kernels.mix(point.astype(_U) + _U(1)) * p[: len(point)], out=prefix[1:])
    span = lambda a, b: kernels.mix((prefix[b] - prefix[a]) * q[a])
    less = lambda a, b, at: kernels.mix((prefix[at] - prefix[a]) * q[a] + (prefix[b] - prefix[at + 1]) * q[a + 1])
    return point, length, np.cumsum(length) - length, span, less


def _runs(words: list[str], most: int = 1 << 18):
    """(first, end) of runs of words with about ``most`` code points."""
    i = 0
    while i < len(words):
        j, size = i, 0
        while j < len(words) and (j == i or size + len(words[j]) <= most):
            size += len(words[j])
            j += 1
        yield i, j
        i = j


def pivot_rows(code: np.ndarray, rank: np.ndarray, count: np.ndarray):
    """Arrow mapper over (id, word): index rows of the gram prefix and look-up rows of the pivots."""
    take = EDITS + 1
    need = GRAM * EDITS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for i, j in _runs(words):
                yield rows_of(batch.column("id").slice(i, j - i).to_numpy(), words[i:j])

    def rows_of(ids: np.ndarray, words: list[str]) -> pa.RecordBatch:
        point, length, first, span, _ = _spans(words)
        n = length - GRAM + 1
        word = np.repeat(np.arange(len(words)), n)
        at = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n) + first[word]
        which = np.searchsorted(code, (point[at] << 21) | point[at + 1])
        order = np.lexsort((at, rank[which], word))
        start = np.cumsum(n) - n
        last = rank[which][order][start + need - 1]  # rank of the word's last gram of the prefix
        held = np.flatnonzero(rank[which] <= last[word])  # places ascend inside a word
        edge = np.searchsorted(word[held], np.arange(len(words) + 1))
        places, costs = at[held].tolist(), count[which[held]].tolist()
        pivots = np.array([x for k in range(len(words)) for x in rare_disjoint(places[edge[k]: edge[k + 1]], costs[edge[k]: edge[k + 1]], take, GRAM)],
                          dtype=np.int64)
        odd = np.bitwise_xor.reduceat(_U(1) << (kernels.mix(point.astype(_U)) & _U(63)), first) if len(words) else np.zeros(0, _U)
        bits = np.bitwise_or.reduceat(_U(1) << (kernels.mix((point[at] << 21 | point[at + 1]).astype(_U)) & _U(63)), start) if len(words) else np.zeros(0, _U)
        keys, owners, roles, cuts = [], [], [], []

        def put(at, word, left, more, role):
            key = span(first[word], at + GRAM) if left else span(at, first[word] + length[word]) + _U(0x9E3779B97F4A7C15)
            keys.append(kernels.mix(key ^ kernels.mix((length[word] + more).astype(_U) + _U(0x1000))))
            owners.append(word)
            roles.append(np.full(len(word), role))
            cuts.append(at + GRAM - first[word] if left else -1 - (at - first[word]))

        own = np.arange(len(words))
        for left, pivot in ((True, pivots[::take]), (False, pivots[take - 1:: take])):
            put(at[held], word[held], left, 0, False)
            for more in range(-EDITS, EDITS + 1):
                put(pivot, own, left, more, True)
        owner = np.concatenate(owners)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(ids[owner]), pa.array(bits[owner].view(np.int64)),
                                           pa.array(odd[owner].view(np.int64)), pa.array(np.concatenate(cuts).astype(np.int32)),
                                           pa.array(np.concatenate(roles).astype(bool))], names=["key", "id", "bits", "odd", "cut", "pivot"])

    return run


def keyed_anew(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow mapper over (key, id, bits, odd, cut, pivot, word): rows by the text on the edit's side, whole and less one code point."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        for i, j in _runs(words, 1 << 16):
            part = batch.slice(i, j - i)
            _, length, first, span, less = _spans(words[i:j])
            cut = part.column("cut").to_numpy().astype(np.int64)
            a = first + np.where(cut > 0, cut, 0)
            b = first + np.where(cut > 0, length, -1 - cut)
            row = np.repeat(np.arange(len(a)), b - a)
            at = np.arange(len(row)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[row]
            key = part.column("key").to_numpy().view(_U)
            row = np.concatenate([np.arange(len(a)), row])
            new = kernels.mix(key[row] ^ np.concatenate([span(a, b), less(a[row[len(a):]], b[row[len(a):]], at)]))
            order = np.lexsort((new, row))
            keep = np.ones(len(order), dtype=bool)
            keep[1:] = (new[order][1:] != new[order][:-1]) | (row[order][1:] != row[order][:-1])
            row, new = row[order][keep], new[order][keep]
            own = part.select(["id", "bits", "odd", "pivot"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(new.view(np.int64)), *own.columns], names=["key", "id", "bits", "odd", "pivot"])


_ROWS = "key long, id long, bits long, odd long"


def _found(rows: DataFrame) -> DataFrame:
    """(a, b) of look-ups and index rows of equal key whose maps allow one edit."""
    index = rows.filter("not pivot").select("key", F.col("id").alias("b"), F.col("bits").alias("bb"), F.col("odd").alias("ob"))
    asked = rows.filter("pivot").select("key", F.col("id").alias("a"), F.col("bits").alias("ba"), F.col("odd").alias("oa"))
    both = asked.join(index, "key").filter(
        f"a <> b AND bit_count(oa ^ ob) <= {2 * EDITS} AND bit_count(ba ^ bb) <= {2 * GRAM * EDITS}")
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_words(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b) both ways: numbers of the words of ``words`` (id, word) that are one edit apart."""
    code, rank, count = gram_order(words)
    rows = cut_lineage(words.select("id", "word").mapInArrow(pivot_rows(code, rank, count), f"{_ROWS}, cut int, pivot boolean"))
    pairs = rows.groupBy("key").agg((F.count_if(F.col("pivot")) * F.count_if(~F.col("pivot"))).alias("pairs"))
    pairs = cut_lineage(pairs.filter("pairs > 0"))  # a key with one side only finds nothing
    common = rows.join(pairs.filter(F.col("pairs") > hot).select("key"), "key").join(words.select("id", "word"), "id")
    anew = common.select("key", "id", "bits", "odd", "cut", "pivot", "word").mapInArrow(keyed_anew, f"{_ROWS}, pivot boolean")
    few = rows.join(pairs.filter(F.col("pairs") <= hot).select("key"), "key")
    found = _found(few).union(_found(cut_lineage(anew))).distinct()
    named = lambda c: words.select(F.col("id").alias(c), F.col("word").alias(f"w{c}"))
    near = found.join(named("a"), "a").join(named("b"), "b").filter(F.levenshtein("wa", "wb", EDITS) == EDITS)
    return cut_lineage(near.select("a", "b").union(near.select("b", "a")))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) from (id, up): every ``up`` followed to the last, by doubling until nothing changes."""
    state = forms
    while True:
        above = state.select(F.col("id").alias("_i"), F.col("up").alias("_up"))
        step = cut_lineage(state.join(above, F.col("up") == F.col("_i"), "left").select(
            "id", F.coalesce("_up", "up").alias("up"), (F.col("_up") != F.col("up")).alias("moved")))
        if step.filter("moved").isEmpty():
            return step.select("id", F.col("up").alias("root"))
        state = step.select("id", "up")


def group_variants(counts: DataFrame, times: int = TIMES, hot: int = HOT) -> DataFrame:
    """word, form, root, n, n_near and form_n for every word of ``counts`` (word, n), words of at least four code points.

    A word's form is its near word of largest n (of equal ones the smallest in code-point order) if that is at least
    ``times`` the word's own; its root is the last of the chain of forms, the word itself where it has none.
    """
    words = cut_lineage(counts.select("word", "n").withColumn("id", F.monotonically_increasing_id()))
    with stage_scope(counts.sparkSession) as keep:
        links = near_words(words, hot)
        other = words.select(F.col("id").alias("b"), F.col("word").alias("form"), F.col("n").alias("form_n"))
        best = links.join(other, "b").groupBy("a").agg(
            F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("m"), "form", "b", "form_n")).alias("x"))
        judged = words.join(best, words["id"] == best["a"], "left").withColumn("ok", F.col("x.form_n") >= times * F.col("n"))
        judged = keep(cut_lineage(judged.select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), *[
            F.when(F.col("ok"), F.col(f"x.{c}")).alias(a) for c, a in (("form", "form"), ("form_n", "form_n"), ("b", "up"))])))
        ends = roots(judged.select("id", F.coalesce("up", "id").alias("up")))
        moved = keep(cut_lineage(ends.filter("root <> id").join(words.select(F.col("id").alias("root"), F.col("word").alias("r")), "root")
                                 .select(F.col("id").alias("i"), "r")))
    return judged.join(moved, F.col("id") == F.col("i"), "left").select(
        "word", "form", F.coalesce("r", "word").alias("root"), "n", "n_near", "form_n")
