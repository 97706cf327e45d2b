"""URL filters indexed by their rarest literal token (operator 5).

A rule is a regular expression over ``host + path`` with the literal tokens (runs of ``[a-z0-9]``, lower case) that every url it matches
holds as whole tokens.  Tokens are counted over all urls of the table; each rule is
filed under its rarest one.  A url's own tokens fetch the rules filed under them, and only those run their regular expression.
Of the rules that match, the longest decides (by its name's length, then by its name); where none does, the default does.

The index holds the rules alone: it is broadcast behind a check of its size (``MAX_RULES``); more rules are split
into indexes of at most that size, each its own broadcast, and all are asked.

Cases: a null url has no host, no path and no tokens and gets the default; equal urls get equal verdicts; long urls are matched whole; an
empty table gives no rows; a rule without tokens is refused; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import named, python_map, schema_with, spare

#: Rules in one broadcast index.
MAX_RULES = 100_000
ALLOW, BLOCK = "allow", "block"
_TOKEN = re.compile(r"[a-z0-9]+")
_UPPER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host + path; ``tokens`` stand in every url it matches."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool = False  # a (host, path) rule, reported as the url's rule


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """The rule for a host and its subdomains, below a path."""
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(_TOKEN.findall((host + path).lower())), True)


#: The site rules of the contract.
SITE_RULES = [site_rule("com", "/", ALLOW), site_rule("example.com", "/en/", BLOCK), site_rule("www.example.com", "/en/", ALLOW),
              site_rule("net", "/es/", BLOCK), site_rule("net", "/fr/", BLOCK)]

#: Patterns of the default list, for urls that no site rule fits.
PATTERN_RULES = [
    Rule("spam farms", BLOCK, r"(?i)(?<![a-z0-9])spam[-_.]farm(?![a-z0-9])", ("spam", "farm")),
    Rule("cheap pills", BLOCK, r"(?i)(?<![a-z0-9])cheap[-_.](?:online[-_.])?pills(?![a-z0-9])", ("cheap", "pills")),
    Rule("casino", BLOCK, r"(?i)^[^/]*(?<![a-z0-9])casino(?![a-z0-9])", ("casino",)),
    Rule("adult", BLOCK, r"(?i)^[^/]*(?<![a-z0-9])(?:adult|xxx)[-_.]?(?![a-z0-9]).*(?<![a-z0-9])video(?![a-z0-9])", ("video",)),
    Rule("download traps", BLOCK, r"(?i)/(?:free[-_])?download[-_/]crack(?![a-z0-9])", ("download", "crack")),
]


def parts_of(url: str | None) -> tuple[str, str]:
    """(host, path): host after the first ``://`` with A-Z lower-cased, path from its end up to ``?`` or ``#``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    at = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[at:]
    end = next((k for k, c in enumerate(path) if c in "?#"), len(path))
    return rest[:at].translate(_UPPER), path[:end]


def tokens_of(host: str, path: str) -> set[str]:
    return set(_TOKEN.findall((host + path).translate(_UPPER)))


def token_counts(urls: DataFrame, url: str, rules: Iterable[Rule]) -> dict[str, int]:
    """How many urls hold each token of the rules (at most the rules' tokens reach the driver)."""
    spark = urls.sparkSession
    wanted = sorted({t for r in rules for t in r.tokens})
    known = spark.range(1).select(F.explode(F.array(*map(F.lit, wanted))).alias("token")) if wanted else None
    if known is None:
        return {}
    text = F.regexp_extract(F.translate(named(url), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"(?s)://([^?#]*)", 1)
    own = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit("([a-z0-9]+)"), 1))).alias("token"))
    return {r.token: r.n for r in own.join(known, "token").groupBy("token").agg(F.count("*").alias("n")).collect()}


def rule_index(rules: Iterable[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token (ties by spelling)."""
    out: dict[str, list[Rule]] = {}
    for r in rules:
        if not r.tokens or any(_TOKEN.fullmatch(t) is None for t in r.tokens):
            raise ValueError(f"rule {r.name!r} needs literal tokens of [a-z0-9]")
        out.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(r)
    return out


def judge(host: str, path: str, indexes: list[dict[str, list[Rule]]], default: str) -> tuple[str | None, str, str | None, int]:
    """(site rule, verdict, pattern rule, how many candidates ran)."""
    fetched = [r for index in indexes for t in tokens_of(host, path) if t in index for r in index[t]]
    fits = [r for r in fetched if re.search(r.pattern, host + path)]
    best = max(fits, key=lambda r: (r.site, len(r.name), r.name), default=None)
    if best is None:
        return None, default, None, len(fetched)
    return (best.name, best.verdict, None, len(fetched)) if best.site else (None, best.verdict, best.name, len(fetched))


_TYPE = "struct<host:string,path:string,rule:string,verdict:string,pattern:string,n_candidates:int>"


def url_verdicts(pages: DataFrame, rules: list[Rule] | None = None, url: str = "url", default: str = ALLOW, into: str = "filter") -> DataFrame:
    """``pages`` with a struct column ``into`` (``spare`` of it, if there is one): host, path, site rule, verdict, pattern rule, number of candidate rules."""
    into = spare(pages, into)
    rules = [*SITE_RULES, *PATTERN_RULES] if rules is None else rules
    counts = token_counts(pages, url, rules)
    context = pages.sparkSession.sparkContext
    indexes = [context.broadcast(rule_index(rules[k:k + MAX_RULES], counts)) for k in range(0, len(rules), MAX_RULES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [i.value for i in indexes]
        for batch in batches:
            found = []
            for u in batch.column(batch.schema.get_field_index(url)).to_pylist():
                host, path = parts_of(u)
                rule, verdict, pattern, n = judge(host, path, asked, default)
                found.append({"host": host, "path": path, "rule": rule, "verdict": verdict, "pattern": pattern, "n_candidates": n})
            kinds = [(k, pa.string()) for k in ("host", "path", "rule", "verdict", "pattern")] + [("n_candidates", pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.struct(kinds))], names=[*batch.schema.names, into])

    return python_map(pages, run, schema_with(pages, into, _TYPE))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_verdicts(pages).select("page_id", *(F.col(f"filter.{c}") for c in ("host", "path", "rule", "verdict", "pattern")))


#: The rules written out; lookarounds are replaced by explicit neighbours.
OP5_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
s AS (SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path FROM h),
r AS (SELECT *, '.' || host AS dotted, host || path AS whole FROM s),
j AS (SELECT *, CASE
    WHEN ends_with(dotted, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ends_with(dotted, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with(dotted, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with(dotted, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ends_with(dotted, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM r),
m AS (SELECT *, CASE WHEN rule IS NOT NULL THEN NULL
    WHEN regexp_matches(whole, '(?i)/(free[-_])?download[-_/]crack([^a-z0-9]|$)') THEN 'download traps'
    WHEN regexp_matches(whole, '(?i)(^|[^a-z0-9])cheap[-_.](online[-_.])?pills([^a-z0-9]|$)') THEN 'cheap pills'
    WHEN regexp_matches(whole, '(?i)(^|[^a-z0-9])spam[-_.]farm([^a-z0-9]|$)') THEN 'spam farms'
    WHEN regexp_matches(host, '(?i)(^|[^a-z0-9])casino([^a-z0-9]|$)') THEN 'casino'
    WHEN regexp_matches(whole, '(?i)^[^/]*?(^|[^a-z0-9])(adult|xxx)([^a-z0-9]|[^a-z0-9].*[^a-z0-9])video([^a-z0-9]|$)') THEN 'adult' END AS pattern FROM j)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL OR pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       pattern FROM m
"""
