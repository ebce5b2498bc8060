import random

from tidings.operators.render import split_messages
from tidings.operators.textvec import pack_batches


def run_split(spark, texts, limit):
    df = spark.createDataFrame(list(enumerate(texts)), "msg_id long, text string")
    out = {}
    for r in split_messages(df, "text", limit).collect():
        out.setdefault(r.msg_id, []).append((r.part, r.text))
    return [[t for _, t in sorted(out.get(i, []))] for i in range(len(texts))]


def test_split_is_linear_in_the_text():
    import time

    from tidings.operators.render import part_bounds

    text = ("word " * 150 + "\n\n") * 13_000  # 10 MB in one message
    began = time.perf_counter()
    bounds = part_bounds(text, 4096)
    assert time.perf_counter() - began < 5
    assert "".join("".join(text[a:b] for a, b in bounds).split()) == "".join(text.split())
    assert all(b - a <= 4096 for a, b in bounds)


def test_split_properties(spark):
    """Every part fits, nothing but whitespace at the cuts is lost, and a cut inside the limit is a boundary at 70 % or later."""
    rng = random.Random(11)
    words = ["alpha", "beta", "\n\n", "</pre>", "</blockquote>", "  ", "gamma\n", "é"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(0, 400))) for _ in range(40)]
    for limit in (50, 120):
        for text, parts in zip(texts, run_split(spark, texts, limit), strict=True):
            assert "".join("".join(parts).split()) == "".join(text.split())
            at = 0
            for i, part in enumerate(parts):
                assert text.startswith(part, at) and part
                end = at + len(part)
                rest = text[end:].lstrip()
                if i < len(parts) - 1:
                    window = text[at: at + limit]
                    marks = [window.rfind(m) for m in ("\n\n", "</pre>", "</blockquote>")]
                    late = [m for m in marks if m >= int(limit * 0.7)]
                    if late:  # cut at the last of them; a closing tag stays with the left part
                        assert len(part) == max(late) + len({0: "", 1: "</pre>", 2: "</blockquote>"}[marks.index(max(late))])
                    else:
                        assert len(part) == limit
                else:
                    assert not rest and len(part) <= limit
                at = len(text) - len(rest)


def test_split_by_hand(spark):
    (parts,) = run_split(spark, ["a" * 40 + "\n\n" + "b" * 20], 50)
    assert parts == ["a" * 40, "b" * 20]
    (parts,) = run_split(spark, ["a" * 20 + "\n\n" + "b" * 40], 50)  # the blank line is too early
    assert parts == ["a" * 20 + "\n\n" + "b" * 28, "b" * 12]
    assert run_split(spark, ["", "x" * 50], 50) == [[], ["x" * 50]]


def test_pack_batches_small_case(spark):
    df = spark.createDataFrame([("s", 0, 100), ("s", 1, 100), ("s", 2, 60)], "source string, id long, tokens int")
    got = [r.batch_no for r in pack_batches(df, 100, group_cols=["source"]).orderBy("id").collect()]
    assert got == [0, 1, 2]


def test_pack_batches_properties(spark):
    """Batches are runs of the order, within the budget unless of one row, and closed only when the next row did not fit."""
    rng = random.Random(5)
    rows = [(f"g{rng.randint(0, 3)}", rng.randint(0, 1), i, rng.choice([1, 5, 20, 63, 64, 65, 200])) for i in range(600)]
    df = spark.createDataFrame(rows, "source string, shard int, id long, tokens int")
    for size in ("10000", "7"):  # the state crosses Arrow batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        got = sorted((r.source, r.shard, r.id, r.tokens, r.batch_no) for r in pack_batches(df, 64).collect())
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert len(got) == len(rows)
        for key in {(g[0], g[1]) for g in got}:
            mine = [(g[3], g[4]) for g in got if (g[0], g[1]) == key]
            numbers = [n for _, n in mine]
            assert numbers == sorted(numbers) and set(numbers) == set(range(max(numbers) + 1))
            for n in range(max(numbers) + 1):
                batch = [t for t, m in mine if m == n]
                assert sum(batch) <= 64 or len(batch) == 1
                if n < max(numbers):
                    assert sum(batch) + next(t for t, m in mine if m == n + 1) > 64
