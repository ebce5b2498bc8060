"""DuckDB statements of the spelling, window and manifest queries."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: CRC-32 of every byte value, by the polynomial 0xEDB88320
CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t)"""


def lowered(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def crc32(text: str) -> str:
    """Unsigned crc32 of a text in UTF-8; the statement joins ``crc_table``."""
    byte = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce({byte}, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295)"


def spelling() -> str:
    return f"""
WITH RECURSIVE {CRC_TABLE},
r AS (SELECT doc_id, unnest(regexp_extract_all({lowered('text')}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
c AS (SELECT doc_id, run, count(*) AS c FROM r GROUP BY ALL),
h AS (SELECT run, c, {crc32("(doc_id || ':' || run)")} AS h FROM c, crc_table),
w AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c FROM h),
v AS (SELECT word, sum(c)::BIGINT AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
x AS (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM p),
near AS (SELECT DISTINCT * FROM (
    SELECT k.word AS w1, m.word AS w2 FROM x k JOIN x m ON k.i = m.i AND k.a = m.a AND k.b = m.b AND k.word <> m.word
    UNION ALL SELECT x.word, v.word FROM x JOIN v ON v.word = x.a || x.b
    UNION ALL SELECT v.word, x.word FROM x JOIN v ON v.word = x.a || x.b)),
f AS (SELECT w1, w2 AS form, v.n AS form_n, count(*) OVER (PARTITION BY w1) AS n_near FROM near JOIN v ON v.word = w2
      QUALIFY row_number() OVER (PARTITION BY w1 ORDER BY v.n DESC, w2) = 1),
g AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * v.n THEN form END AS form,
             CASE WHEN form_n >= 2 * v.n THEN form_n END AS form_n FROM v LEFT JOIN f ON w1 = word),
up(word, last) AS (SELECT word, word FROM g UNION ALL SELECT up.word, g.form FROM up JOIN g ON g.word = up.last WHERE g.form IS NOT NULL)
SELECT g.word, g.form, up.last AS root, g.n, g.n_near, g.form_n FROM g JOIN up ON up.word = g.word
JOIN g z ON z.word = up.last AND z.form IS NULL"""


def windows() -> str:
    return """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) < 20 THEN [] ELSE list_transform(range(1, len(ws) - 18), lambda i: array_to_string(ws[i:i+19], ' ')) END AS l FROM d),
w AS (SELECT doc_id, unnest(l) AS win, generate_subscripts(l, 1) AS p FROM s),
g AS (SELECT doc_id, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) > 1 AS gone FROM w),
t AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM d),
k AS (SELECT doc_id, p, word, coalesce(bool_or(gone) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
      FROM t LEFT JOIN g USING (doc_id, p)),
o AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept FROM k GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN o USING (doc_id)"""


def _tree(name: str, leaves: str, levels: int) -> str:
    """CTEs ``name``0.. of the nodes (g, n, r, h) of every level with the digests left and right of them in their run."""
    out, low = [], ""
    for k in range(levels):
        nodes = leaves if k == 0 else (
            f"SELECT g, n, r // 8 AS r, sha256(string_agg(h, '' ORDER BY r)) AS h FROM {name}{k - 1} WHERE n > {8 ** (k - 1)} GROUP BY g, n, r // 8")
        run = "(PARTITION BY g, r // 8 ORDER BY r ROWS BETWEEN"
        out.append(f"""{name}{k} AS (SELECT g, n, r, h, coalesce(string_agg(h, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lt,
    coalesce(string_agg(h, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rt FROM ({nodes}))""")
    return ",\n".join(out)


def _fold(name: str, start: str, levels: int) -> str:
    """CTEs that fold every row of ``start`` (g, r, f, proof, ...) up the levels of a tree."""
    out, last = [], start
    for k in range(levels - 1):
        here = f"{start}_{name}{k}"
        out.append(f"""{here} AS (SELECT b.* EXCLUDE (f, proof), CASE WHEN b.n > {8 ** k} THEN sha256(lt || f || rt) ELSE f END AS f,
    proof || CASE WHEN b.n > {8 ** k} THEN lt || rt ELSE '' END AS proof
    FROM {last} b LEFT JOIN {name}{k} t ON t.g = b.g AND t.r = b.r // {8 ** k})""")
        last = here
    return ",\n".join(out), last


def _ends(name: str, levels: int) -> str:
    return " UNION ALL ".join(f"SELECT g, h FROM {name}{k} WHERE n <= {8 ** k}" + (f" AND n > {8 ** (k - 1)}" if k else "") for k in range(levels))


def manifest(levels: int = 8, tops: int = 4) -> str:
    """``levels`` and ``tops`` bound the heights of a language's tree and of the tree of languages."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    leaf = lambda text: f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    up, folded = _fold("a", "b", levels)
    over, done = _fold("z", "e", tops)
    return f"""
WITH {CRC_TABLE},
q AS (SELECT doc_id, coalesce('x' || lang, '') AS g, {leaf('text')} AS h,
             CASE WHEN {crc32('doc_id::VARCHAR')} % 3 = 0 THEN {leaf(lowered('text'))} END AS bad FROM documents, crc_table),
b AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS r, count(*) OVER (PARTITION BY g) AS n,
             coalesce(bad, h) AS f, '' AS proof FROM q),
{_tree('a', 'SELECT g, n, r, h FROM b', levels)},
subroots AS ({_ends('a', levels)}),
y AS (SELECT 0 AS g, g AS lang, h, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS n FROM subroots),
{_tree('z', 'SELECT g, n, r, h FROM y', tops)},
{up},
e AS (SELECT doc_id, u.h AS leaf, y.h AS subroot, y.g, y.r, y.n, f, proof FROM {folded} u JOIN y ON y.lang = u.g),
{over}
SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = root.h AS verified
FROM {done} JOIN ({_ends('z', tops)}) root USING (g)"""
