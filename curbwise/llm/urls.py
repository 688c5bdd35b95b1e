"""Operator 8: URL filter with host rules and a weighted vocabulary.

A rule names a host and a path prefix; it fits the host and its subdomains, and
the longest fitting rule decides. All other URLs go through an Aho-Corasick
automaton over strict and soft terms: a hit counts when no letter or digit
touches it, and a URL is blocked by one strict hit or by ``SOFT_HITS`` distinct
soft terms.

Rules and vocabulary are short lists given by the caller, so they travel with
the tasks. Defined results: a null URL or one without ``://`` has an empty host
and path, and its text (if any) is still searched for terms; repeated rows each
get their own verdict.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbwise.llm.batches import arrow_pass, ship_package, texts

# The rules (host, path prefix, verdict) and the terms.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
STRICT = ("adult", "casino", "escort", "gambling", "malware", "phishing", "porn", "porno", "poker", "spam", "viagra", "warez", "xxx")
SOFT = ("ads", "bet", "bets", "bonus", "cheap", "crack", "download", "farm", "free", "loan", "pills", "sex", "track", "win")
SOFT_HITS = 2


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(
        F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _UPPER.lower()
    ), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as ``host/path`` and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Later tests win, so the longest comes last.
    for name, prefix, said in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        rule = F.when(fits, F.lit(name + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def automaton(strict=STRICT, soft=SOFT) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for term in terms:
            built.add_word(term, (term, kind))
    built.make_automaton()
    return built


def bounded_hits(url: str, built: ahocorasick.Automaton) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms that stand free in the URL."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in url)
    strict, soft = set(), set()
    edge = lambda c: not ("a" <= c <= "z" or "0" <= c <= "9")
    for last, (term, kind) in built.iter(lowered):
        first = last - len(term) + 1
        if (first == 0 or edge(lowered[first - 1])) and (last + 1 == len(lowered) or edge(lowered[last + 1])):
            (strict if kind == "strict" else soft).add(term)
    return strict, soft


def judge(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_hits: int = SOFT_HITS) -> DataFrame:
    """page_id, host, path, rule, verdict, and the distinct strict and soft terms found. No shuffle."""
    ship_package(pages.sparkSession)

    def make():
        built = automaton(strict, soft)

        def compute(part: pa.RecordBatch) -> list:
            found = [bounded_hits(url, built) for url in texts(part, "url")]
            kind = pa.list_(pa.string())
            return [pa.array([sorted(hits[i]) for hits in found], kind) for i in (0, 1)]

        return compute

    scanned = arrow_pass(pages.select("page_id", "url"), "strict_terms array<string>, soft_terms array<string>", make)
    placed = scanned.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    bad = (F.size("strict_terms") > 0) | (F.size("soft_terms") >= soft_hits)
    return placed.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(said, F.when(bad, "block").otherwise("allow")).alias("verdict"), "strict_terms", "soft_terms",
    )
