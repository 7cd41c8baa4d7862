"""URL filters: pattern rules, fetched by token.

A rule is stored under one literal token, the rarest of its tokens among the URLs at
hand. The tokens of a URL fetch the rules stored under them, and only those run their
regular expression. The rule whose text is longest decides; without one, allow.

Rules are a short list that the caller writes (bounded by MAX_RULES); URLs are a table
of any size. Distinct URLs are judged once, so a URL that fills a third of the table is
one row before tokens are drawn from it.

Defined results: a NULL URL, or one without ``://``, has an empty host and path, fits
no rule and is allowed. Repeated rows give repeated results. An empty table gives an
empty result; other columns of the input do not matter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[0-9A-Za-z]+"


@dataclass(frozen=True)
class Rule:
    """``text`` is a host with the start of a path, or with ``*`` as a pattern.

    ``net/`` fits the host, all its subdomains and paths that start with ``/``.
    ``*/login/*`` fits anywhere in host and path; ``*`` stands for any run of
    characters. A pattern needs a token between two other characters, as ``login``.
    """

    text: str
    verdict: str

    @property
    def regex(self) -> str:
        literal = ".*".join(re.escape(part) for part in self.text.split("*"))
        return f"^{literal}$" if "*" in self.text else rf"^(?:[^/]*\.)?{literal}"

    @property
    def tokens(self) -> list[str]:
        """Tokens that every matching URL holds as a whole token."""
        # A rule starts at a dot or the URL's start, and ends anywhere.
        if "*" not in self.text:
            return re.findall(rf"{TOKEN}(?=[^0-9A-Za-z])", self.text)
        return re.findall(rf"(?<=[^0-9A-Za-z*]){TOKEN}(?=[^0-9A-Za-z*])", self.text)


HOST_RULES = [
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
]
# Pages that hold no prose, whatever their host.
PATTERN_RULES = [
    Rule("*/login/*", "block"),
    Rule("*/signup/*", "block"),
    Rule("*/checkout/*", "block"),
    Rule("*/cart/*", "block"),
    Rule("*/ads/*", "block"),
]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def fitting_rules(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """url, matched (a rule's text) and matched_verdict of the URLs that fit a rule.

    Host rules go before patterns, longer rules before shorter ones.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    if untokened := [r.text for r in rules if not r.tokens]:
        raise ValueError(f"rules without a token: {untokened}")
    spark = urls.sparkSession
    subject = F.concat(*split_url(F.col("url"))).alias("subject")
    distinct = urls.select("url").distinct().select("url", subject)
    found = F.array_distinct(F.regexp_extract_all("subject", F.lit(f"({TOKEN})")))
    tokens = distinct.select("url", "subject", F.explode(found).alias("token"))

    # Of the tokens of each rule, the one that fewest URLs have. At most a few tokens
    # for each of MAX_RULES rules are broadcast.
    in_rules = spark.createDataFrame(
        [(i, token) for i, rule in enumerate(rules) for token in rule.tokens],
        "rule long, token string",
    )
    known = F.broadcast(in_rules.select("token").distinct())
    seen = tokens.join(known, "token").groupBy("token").agg(F.count("*").alias("seen"))
    rarity = F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "token")
    rarest = (
        in_rules.join(seen, "token", "left")
        .groupBy("rule")
        .agg(F.min(rarity)["token"].alias("token"))
    )
    texts = spark.createDataFrame(
        [(i, "*" not in r.text, r.text, r.verdict, r.regex) for i, r in enumerate(rules)],
        "rule long, host_rule boolean, matched string, matched_verdict string, regex string",
    )
    index = F.broadcast(rarest.join(texts, "rule"))
    order = F.struct("host_rule", F.length("matched"), "matched", "matched_verdict")
    return (
        tokens.join(index, "token")
        .filter(F.regexp_like("subject", F.col("regex")))
        .groupBy("url")
        .agg(F.max(order).alias("best"))
        .select("url", "best.matched", "best.matched_verdict")
    )


def judge_pages(
    pages: DataFrame,
    rules: list[Rule] = HOST_RULES + PATTERN_RULES,
    default: str = "allow",
) -> DataFrame:
    """page_id, host, path, matched and verdict of every row (page_id, url)."""
    host, path = split_url(F.col("url"))
    return (
        pages.select("page_id", "url")
        .join(fitting_rules(pages, rules), "url", "left")
        .select(
            "page_id",
            host.alias("host"),
            path.alias("path"),
            "matched",
            F.coalesce("matched_verdict", F.lit(default)).alias("verdict"),
        )
    )
