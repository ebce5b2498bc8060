"""Url filter: host and path rules first, then a weighted vocabulary counted with an Aho-Corasick automaton.

A term counts only as a whole word (no ASCII letter or digit beside it). One strict term rejects; soft terms
reject when the weights of the distinct ones reach the threshold. The automaton reads each url once, whatever
the size of the vocabulary.

Defined results: a null url, or one without ``://``, has empty host and path, matches no rule, and its text (if
any) is still counted; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Default rules of the query: (verdict, host, path). Fixed values.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Default vocabulary, the usual terms of published lists by subject: strict terms reject alone, soft terms carry weights.
STRICT = (
    "porn", "porno", "pornhub", "xxx", "xxxx", "hentai", "sexcam", "sexcams", "sexchat", "escorts", "camgirl", "camgirls", "milf", "upskirt",
    "gangbang", "blowjob", "bukkake", "creampie", "cumshot", "shemale", "bestiality", "warez", "keygens", "nulled", "torrent-porn", "casino-bonus",
    "free-porn", "sex-video", "sex-videos", "buy-viagra", "buy-cialis", "carding", "cvv-shop", "ddos-for-hire", "phishing-kit",
)
_FULL = ("sex", "sexy", "nude", "nudes", "naked", "erotic", "erotica", "fetish", "escort", "swinger", "lingerie", "casino", "casinos", "betting",
         "sportsbook", "gambling", "roulette", "blackjack", "baccarat", "jackpot", "viagra", "cialis", "levitra", "tramadol", "xanax", "ambien",
         "pills", "pharmacy", "steroids", "keygen", "cracked", "torrent", "torrents", "payday", "spam", "malware", "phishing", "replica", "counterfeit")
_HALF = ("adult", "adults", "hot", "girls", "webcam", "cams", "dating", "hookup", "singles", "mature", "teen", "poker", "slots", "slot", "bet",
         "bets", "bingo", "lottery", "bonus", "win", "winner", "prize", "cheap", "cheapest", "discount", "free", "buy", "order", "deal", "deals",
         "offer", "loan", "loans", "credit", "cash", "money", "rich", "crypto", "crack", "serial", "hack", "hacks", "cheats", "download", "weight",
         "diet", "detox", "pill", "meds", "rx", "seo", "backlinks", "clicks", "traffic", "popup", "banner", "ads", "promo", "spin", "spins")
SOFT = {**dict.fromkeys(_FULL, 1.0), **dict.fromkeys(_HALF, 0.5)}
SOFT_THRESHOLD = 1.5
SOFT_DISTINCT = 2


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules) -> Column:
    """Longest fitting rule as struct<rule, verdict>, or null. Rules are a literal list, so no join is needed."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def vocabulary_hits(strict, soft):
    """Pandas UDF: struct<n_strict, n_soft, weight> of an url's vocabulary terms, each counted once."""
    strict, soft = tuple(strict), dict(soft)

    @F.pandas_udf("struct<n_strict:int,n_soft:int,weight:double>")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term in {*strict, *soft}:
            machine.add_word(term, (term, len(term)))
        if len(machine):
            machine.make_automaton()
        lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        word = set("abcdefghijklmnopqrstuvwxyz0123456789")
        strict_set = set(strict)
        for urls in batches:
            # one pass over all urls of a batch, a line break between them: no term holds one
            texts = [(u or "").translate(lower).replace("\n", " ") for u in urls]
            starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
            joined = "\n".join(texts)
            found = set()
            if len(machine):
                hits_at = [(end, term, n) for end, (term, n) in machine.iter(joined)
                           if not ((end + 1 < len(joined) and joined[end + 1] in word) or (end >= n and joined[end - n] in word))]
                owners = np.searchsorted(starts, [end for end, _, _ in hits_at], side="right") - 1
                found = set(zip(owners.tolist(), [term for _, term, _ in hits_at], strict=True))  # a term counts once per url
            n_strict, n_soft, weight = np.zeros(len(texts), np.int32), np.zeros(len(texts), np.int32), np.zeros(len(texts))
            for owner, term in found:
                if term in strict_set:
                    n_strict[owner] += 1
                else:
                    n_soft[owner] += 1
                    weight[owner] += soft[term]
            yield pd.DataFrame({"n_strict": n_strict, "n_soft": n_soft, "weight": weight})

    return hits


def filter_urls(df: DataFrame, key: str = "page_id", url: str = "url", rules=RULES, strict=STRICT, soft=None,
                threshold: float = SOFT_THRESHOLD, distinct: int = SOFT_DISTINCT) -> DataFrame:
    """key, host, path, rule, verdict (allow or block), n_strict, n_soft, weight for every row."""
    soft = SOFT if soft is None else soft
    base = df.select(F.col(key).alias("_id"), F.col(url).alias("_url"))
    base = base.select("_id", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"),
                       vocabulary_hits(strict, soft)(F.col("_url")).alias("_h"))
    base = base.withColumn("_r", matching_rule(F.col("host"), F.col("path"), rules))
    rejected = (F.col("_h.n_strict") > 0) | ((F.col("_h.n_soft") >= distinct) & (F.col("_h.weight") >= threshold))
    return base.select(
        F.col("_id").alias(key), "host", "path", F.col("_r.rule").alias("rule"),
        F.coalesce(F.col("_r.verdict"), F.when(rejected, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.col("_h.n_strict").alias("n_strict"), F.col("_h.n_soft").alias("n_soft"), F.col("_h.weight").alias("weight"))
