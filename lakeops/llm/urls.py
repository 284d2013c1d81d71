"""URL filter with a weighted vocabulary.

One Aho-Corasick automaton holds strict and soft terms.  It walks the whole URL
once; a hit counts where no letter or digit stands on either side.  One strict
term rejects, or ``soft_limit`` distinct soft terms.  Host rules go first: the
longest rule that fits decides.

Defined results: a null URL or one without ``://`` has an empty host and path,
fits no rule, and its whole text (if any) is still searched for terms; repeated
rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rule text to verdict.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
STRICT = (
    "porn", "porno", "xxx", "hentai", "escort", "escorts", "camgirl", "casino", "casinos", "viagra", "cialis", "warez",
    "keygen", "malware", "phishing",
)
SOFT = (
    "adult", "sex", "nude", "bet", "bets", "betting", "gambling", "poker", "slots", "jackpot", "win", "free", "cheap",
    "pills", "pharmacy", "loan", "loans", "crypto", "ads", "track", "tracker", "spam", "farm", "torrent", "crack",
    "dating", "bonus", "replica",
)
SOFT_LIMIT = 2


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits host or a parent of it and the start of the path; else null."""
    column = F
    for rule in sorted(rules, key=len, reverse=True):
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + start)
        column = column.when(fits, F.lit(rule))
    return column.otherwise(F.lit(None).cast("string"))


def term_counts(strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT):
    """Pandas function: URL to the numbers of distinct strict and soft terms in it."""
    weights = {**{t: 0 for t in soft}, **{t: 1 for t in strict}}

    def build():
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term, kind in weights.items():
            machine.add_word(term, (kind, len(term), term))
        machine.make_automaton()
        return machine

    @F.pandas_udf("strict long, soft long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = build()
        for urls in batches:
            out = []
            for url in urls:
                text = (url or "").lower()
                found = (set(), set())
                for end, (kind, length, term) in machine.iter(text):
                    start = end - length + 1
                    if (start == 0 or not text[start - 1].isalnum()) and (
                        end + 1 == len(text) or not text[end + 1].isalnum()
                    ):
                        found[kind].add(term)
                out.append((len(found[1]), len(found[0])))
            yield pd.DataFrame(out, columns=["strict", "soft"])

    return count


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: dict[str, str] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """Host, path, deciding rule, verdict, and the counts of strict and soft terms."""
    url = F.col("url")
    host, path = F.col("host"), F.col("path")
    parsed = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    counted = parsed.withColumn("hits", term_counts(strict, soft)(url)).select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), "hits.*"
    )
    ruled = counted.withColumn("rule", rule_of(host, path, rules))
    decided = F
    for rule, verdict in rules.items():
        decided = decided.when(F.col("rule") == rule, F.lit(verdict))
    by_terms = (F.col("strict") >= 1) | (F.col("soft") >= soft_limit)
    verdict = decided.otherwise(F.when(by_terms, F.lit("block")).otherwise(F.lit("allow")))
    return ruled.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "strict", "soft")
