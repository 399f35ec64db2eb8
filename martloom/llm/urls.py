"""URL filters over redirect equivalence.

Rules decide urls by host and path. Redirects and canonical links say which urls are the same page;
their connected components carry a block to the aliases that no rule names, and an explicit allow in
the component goes before a block.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Sequence
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.llm.components import components
from martloom.llm.runtime import Scratch, map_batches

WHOLE = re.compile(r"[a-z][a-z0-9+.-]*://", re.I)

#: Query parameters that do not name another page.
TRACKING = "(^|&)(utm_[^&=]*|ref|fbclid|gclid)=[^&]*"

RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """Host in lower case; empty for null and for a url without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """Path up to ``?`` or ``#``; empty for null and for a url without ``://``."""
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def redirect_target(url: Column) -> Column:
    """Where servers commonly send a url: https, no fragment, no tracking parameters, no slash at the end.

    Null for what is not a url.
    """
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), "^&+", "")
    page = F.concat(F.lit("https://"), host_of(url), F.regexp_replace(path_of(url), "/+$", ""))
    return F.when(after_scheme(url).isNotNull(), F.concat(page, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def canonical_href(html: Column) -> Column:
    """Target of the page's canonical link as it is written; empty without one."""
    tag = F.regexp_extract(html, r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", 0)
    return F.regexp_extract(tag, r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)


def canonical_link(html: Column) -> Column:
    """Target of the page's canonical link if it is a whole url, else null."""
    target = canonical_href(html)
    return F.when(F.instr(target, "://") > 0, target)


def resolve(url: str, href: str) -> str | None:
    """The whole url that a link names on the page ``url``; None where there is none."""
    href = entities.unescape(href).strip()
    if WHOLE.match(href):
        return href
    try:
        target = urljoin(url, href)
    except ValueError:
        return None
    return target if WHOLE.match(target) else None


def canonical_edges(pages: DataFrame) -> DataFrame:
    """Columns a and b: url of a page and the whole url of its canonical link."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        targets = [resolve(u, h) for u, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(targets, pa.string())], ["a", "b"])

    links = pages.select(F.col("url").alias("a"), canonical_href(F.col("html")).alias("href"))
    return map_batches(links.filter("a is not null and href != ''"), run, "a string, b string").na.drop()


def decide(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Columns url, host, path, rule and decision of distinct urls; the last two null where no rule fits.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains when the url's path
    starts with its own; the longest wins, of equally long ones an allow, then the first by name.
    """
    parsed = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    listed = rules.select(
        F.col("host").alias("suffix"), F.col("path").alias("start"), F.col("verdict").alias("decision"),
        F.concat("host", "path").alias("rule"),
    )
    deepest = listed.agg(F.max(F.size(F.split("suffix", r"\.")))).first()[0] or 0
    parts = F.slice(F.reverse(F.split("host", r"\.")), 1, max(deepest, 1))
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.reverse(F.slice(parts, F.lit(1), i)), "."))
    fits = (
        parsed.select("url", "path", F.explode(suffixes).alias("suffix"))
        .join(listed, "suffix")
        .filter(F.col("path").startswith(F.col("start")))
        .groupBy("url")
        .agg(F.min(F.struct(-F.length("rule"), F.col("decision") != "allow", "rule", "decision")).alias("best"))
        .select("url", "best.rule", "best.decision")
    )
    return parsed.join(fits, "url", "left")


def filter_urls(pages: DataFrame, rules: DataFrame, edges: DataFrame, scratch: Scratch, url_column: str = "url", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Verdict of every row: the columns of ``keep``, host, path, rule and verdict (allow or block).

    ``edges`` has columns a and b, urls that are the same page. A rule's verdict stands. Where no rule
    fits, an allow anywhere in the component gives allow, else a block there gives block, else the
    verdict is allow; a null url has no component. Rows with the same url get the same verdict each.
    """
    tied = scratch.keep(components(edges, scratch, "aliases"), "tied")
    urls = pages.select(F.col(url_column).alias("url")).union(tied.select("node")).na.drop().distinct()
    decided = scratch.keep(decide(urls, rules), "decided")
    whole = (
        tied.join(decided.filter("decision IS NOT NULL"), F.col("node") == F.col("url"))
        .groupBy("component")
        .agg(F.min("decision").alias("told"))  # allow sorts before block
    )
    told = tied.join(scratch.keep(whole, "told"), "component").select(F.col("node").alias("url"), "told")
    known = decided.join(told, "url", "left").select(
        F.col("url").alias("known_url"), "rule", F.coalesce("decision", "told").alias("verdict")
    )
    url = F.col(url_column)
    return pages.select(*keep, url_column).join(known, url == F.col("known_url"), "left").select(
        *keep, host_of(url).alias("host"), path_of(url).alias("path"), "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    scratch = Scratch(spark)
    redirects = pages.select(F.col("url").alias("a"), redirect_target(F.col("url")).alias("b"))
    links = scratch.keep(canonical_edges(pages), "links")
    onward = links.select(F.col("b").alias("a"), redirect_target(F.col("b")).alias("b"))
    edges = scratch.keep(redirects.union(links).union(onward).na.drop().distinct(), "edges")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(pages.select("page_id", "url"), rules, edges, scratch)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DECIDED = """
    SELECT *, CASE WHEN host = 'www.example.com' OR ends_with(host, '.www.example.com') THEN starts_with(path, '/en/') END AS r1,
           CASE WHEN host = 'example.com' OR ends_with(host, '.example.com') THEN starts_with(path, '/en/') END AS r2,
           CASE WHEN host = 'com' OR ends_with(host, '.com') THEN starts_with(path, '/') END AS r3,
           CASE WHEN host = 'net' OR ends_with(host, '.net') THEN starts_with(path, '/es/') END AS r4,
           CASE WHEN host = 'net' OR ends_with(host, '.net') THEN starts_with(path, '/fr/') END AS r5
"""
_RULE = "CASE WHEN r1 THEN 'www.example.com/en/' WHEN r2 THEN 'example.com/en/' WHEN r3 THEN 'com/' WHEN r4 THEN 'net/es/' WHEN r5 THEN 'net/fr/' END"
#: The supplied pages carry no canonical links, so a component is the urls with one redirect target.
ORACLE = f"""
WITH cut AS (
    SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parsed AS (
    SELECT page_id, coalesce({_LOWER.format("regexp_extract(rest, '^[^/?#]*')")}, '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, rest,
           regexp_replace(regexp_replace(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '{TRACKING}', '', 'g'), '^&+', '') AS query
    FROM cut
), targets AS (
    SELECT *, CASE WHEN rest IS NOT NULL THEN host || regexp_replace(path, '/+$', '') || '?' || query END AS target FROM parsed
), nodes AS (
    SELECT target, host, path FROM targets UNION ALL SELECT target, host, regexp_replace(path, '/+$', '') FROM targets
), judged AS ({_DECIDED} FROM nodes), told AS (
    SELECT target, min(CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' ELSE 'block' END) AS told
    FROM (SELECT target, {_RULE} AS rule FROM judged) WHERE rule IS NOT NULL AND target IS NOT NULL GROUP BY target
), own AS (SELECT *, {_RULE} AS rule FROM ({_DECIDED} FROM targets))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            ELSE coalesce(told, 'allow') END AS verdict
FROM own LEFT JOIN told USING (target)
"""
