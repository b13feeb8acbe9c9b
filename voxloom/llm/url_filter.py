"""URL filters: pattern rules indexed by their rarest literal token.

Rules use a small pattern language. ``*`` stands for any characters, ``^`` for a separator or the end,
``|`` at either end anchors there, ``||`` at the start anchors at a host label; all else is literal.
Runs of letters and digits that a match must contain whole are a rule's tokens. How many rows' URLs
have each token is counted over the whole table; a rule stands in the index under its rarest one. A
URL's own tokens fetch the candidates, and only their regular expressions run. Rules without a token
are candidates for every URL.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TOKEN = re.compile("[a-z0-9]+")
_SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|$)"


@dataclass(frozen=True)
class SiteRule:
    """``host/path``: fits the host, its subdomains, and paths that begin with the path. The longest wins."""

    verdict: str
    rule: str

    def regex(self) -> str:
        host, slash, path = self.rule.partition("/")
        return r"(?:[^/]*\.)?" + re.escape(host) + re.escape(slash + path)

    def tokens(self) -> list[str]:
        host, slash, path = self.rule.partition("/")
        found = _TOKEN.findall(host)
        whole = [m for m in _TOKEN.finditer(path.lower()) if m.end() < len(path)]  # the last may go on in the URL
        ascii_ = lambda m: all(c < "\x80" for c in path[max(0, m.start() - 1) : m.end() + 1])
        return found + [m[0] for m in whole if ascii_(m)]


@dataclass(frozen=True)
class PatternRule:
    """A pattern over ``host/path?query`` in lower case; applies to URLs without a fitting site rule."""

    verdict: str
    pattern: str

    def regex(self) -> str:
        body, start, end = self.pattern.lower(), "", ""
        if body.startswith("||"):
            body, start = body[2:], r"^(?:[^/?#]*\.)?"
        elif body.startswith("|"):
            body, start = body[1:], "^"
        if body.endswith("|"):
            body, end = body[:-1], "$"
        return start + "".join({"*": ".*", "^": _SEPARATOR}.get(c, re.escape(c)) for c in body) + end

    def tokens(self) -> list[str]:
        body = self.pattern.lower()
        text = ("" if body.startswith("|") else "*") + body.strip("|") + ("" if body.endswith("|") else "*")
        # whole in any match: bounded by an anchor, a separator or a literal that no token holds
        return [m[0] for m in _TOKEN.finditer(text) if text[m.start() - 1 : m.start()] != "*" and text[m.end() : m.end() + 1] != "*"]


SITE_RULES = (SiteRule("block", "net/"), SiteRule("allow", "example.net/en/"), SiteRule("block", "example.com/de/"), SiteRule("allow", "org/fr/"))
#: Host labels and path words of spam, gambling, piracy, adult and advertising sites.
WORDS = ("spam", "casino", "bets", "betting", "poker", "pills", "viagra", "porn", "xxx", "warez", "torrent", "adserver", "clickbait", "doorway")
PATTERN_RULES = tuple(PatternRule("block", p) for w in WORDS for p in (f"||{w}.", f"^{w}^")) + (
    PatternRule("block", "||spam-farm."),
    PatternRule("block", "||free-bets."),
    PatternRule("allow", "||spam-archive.*/research/"),
)


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host (A-Z lower-cased), path, and the query with its ``?``; all empty without ``://``."""
    if url is None:
        return "", "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", "", ""
    at = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
    rest = rest[at:].partition("#")[0]
    path, mark, query = rest.partition("?")
    return host, path, mark + query


class Entry:
    """A rule in the index; its regular expression is compiled when it first runs."""

    def __init__(self, site: bool, n: int, rule: SiteRule | PatternRule):
        self.site, self.n, self.verdict, self.text, self._rule = site, n, rule.verdict, rule.rule if site else rule.pattern, rule

    @cached_property
    def regex(self) -> re.Pattern:
        return re.compile(self._rule.regex())


class RuleIndex:
    """Rules under their rarest token. ``rarity`` counts the URLs with a token; ties go to the first by code point."""

    def __init__(self, sites: Iterable[SiteRule], patterns: Iterable[PatternRule], rarity: dict[str, int]):
        self.by_token: dict[str, list] = {}
        self.always: list = []
        for site, rules in ((True, sites), (False, patterns)):
            for n, rule in enumerate(rules):
                tokens = rule.tokens()
                entry = Entry(site, n, rule)
                if tokens:
                    self.by_token.setdefault(min(tokens, key=lambda t: (rarity.get(t, 0), t)), []).append(entry)
                else:
                    self.always.append(entry)

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, str | None, int]:
        """Host, path, site rule, verdict, the pattern that decided, and how many rules were tried.

        Without a fitting site rule the first fitting allow pattern, else the first fitting block
        pattern decides; without either, and for URLs without a host, the verdict is allow.
        """
        host, path, query = split_url(url)
        if not host:
            return host, path, None, "allow", None, 0
        site = host + path
        whole = (site + query).lower()
        candidates = {id(e): e for t in dict.fromkeys(_TOKEN.findall(whole)) for e in self.by_token.get(t, ())}
        tried = [*candidates.values(), *self.always]
        best = min((e for e in tried if e.site and e.regex.match(site)), key=lambda e: (-len(e.text), e.n), default=None)
        if best:
            return host, path, best.text, best.verdict, None, len(tried)
        hit = min((e for e in tried if not e.site and e.regex.search(whole)), key=lambda e: (e.verdict != "allow", e.n), default=None)
        return host, path, None, hit.verdict if hit else "allow", hit.text if hit else None, len(tried)


def load_rules(spark: SparkSession, path: str) -> tuple[tuple[SiteRule, ...], tuple[PatternRule, ...]]:
    """Site and pattern rules of a text file, in its order: ``block`` or ``allow``, a blank and the rule on each line.

    A rule that begins with ``site:`` is a site rule (``host/path``), any other a pattern. Empty lines
    and those that begin with ``#`` are skipped; any other line is an error. The list comes to the
    driver, as rules are arguments of the filter.
    """
    sites, patterns = [], []
    for i, row in enumerate(spark.read.text(path, wholetext=True).collect()[0]["value"].split("\n"), 1):
        line = row.strip()
        verdict, _, rule = line.partition(" ")
        rule = rule.strip()
        if not line or line.startswith("#"):
            continue
        if verdict not in ("block", "allow") or not rule.removeprefix("site:"):
            raise ValueError(f"line {i} is no rule: {line[:80]!r}")
        if rule.startswith("site:"):
            sites.append(SiteRule(verdict, rule.removeprefix("site:")))
        else:
            patterns.append(PatternRule(verdict, rule))
    return tuple(sites), tuple(patterns)


def token_counts(urls: DataFrame, url_col: str, tokens: list[str]) -> dict[str, int]:
    """How many rows' URLs have each of the rules' tokens: one row a token comes to the driver."""
    if not tokens:
        return {}
    own = F.array_distinct(F.regexp_extract_all(F.lower(F.col(url_col)), F.lit("[a-z0-9]+"), F.lit(0)))
    known = urls.sparkSession.createDataFrame([(t,) for t in tokens], "token string")
    hits = urls.select(F.explode(own).alias("token")).join(F.broadcast(known), "token", "left_semi")  # as many as the rules have
    return {r["token"]: r["n"] for r in hits.groupBy("token").agg(F.count("*").alias("n")).collect()}


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", sites: tuple[SiteRule, ...] = SITE_RULES, patterns: tuple[PatternRule, ...] = PATTERN_RULES) -> DataFrame:
    """Per row: id, host, path, rule, verdict, pattern and n_tried.

    Null and empty URLs and those without ``://`` have empty host and path and are allowed, as are URLs
    that no rule fits. Of site rules the longest fitting one wins, the first of equals. Ids may be null
    or repeated; each row is judged by its own URL, however long. Other columns are not read. An empty
    table gives an empty result. The index has a size
    bounded by the rules, which are arguments of this call.
    """
    rows = pages.select(pages[f"`{id_col}`"].alias("id"), pages[f"`{url_col}`"].alias("url"))
    tokens = sorted({t for r in (*sites, *patterns) for t in r.tokens()})
    rarity = token_counts(rows, "url", tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex(sites, patterns, rarity)
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32())
        for batch in batches:
            out = [index.judge(u) for u in batch.column("url").to_pylist()]
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["id", "host", "path", "rule", "verdict", "pattern", "n_tried"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string, pattern string, n_tried int")
    return out.withColumnRenamed("id", id_col)


#: The same rows in DuckDB for the site rules. Site rules aside, the patterns are spelled as expressions.
_LABEL = "|".join(WORDS)
ORACLE = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*([?][^#]*)', 1) AS query FROM cut),
judged AS (
  SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, lower(coalesce(host, '') || coalesce(path, '') || coalesce(query, '')) AS whole,
    CASE WHEN host = '' OR host IS NULL THEN NULL
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN host = '' THEN 'allow'
    WHEN regexp_matches(whole, '^([^/?#]*\.)?spam-archive\..*/research/') THEN 'allow'
    WHEN regexp_matches(whole, '[^A-Za-z0-9_.%-]({_LABEL})([^A-Za-z0-9_.%-]|$)') THEN 'block'
    WHEN regexp_matches(whole, '^([^/?#]*\.)?({_LABEL}|spam-farm|free-bets)\.') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
