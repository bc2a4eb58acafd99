"""URL filters: rules by host and path, and trust spread over the link graph for the rest.

Rules. A rule (host, path) fits its host and all subdomains if the url's path
starts with the rule's; the longest that fits decides.

Graph. An edge leads from the host of a page to another host that it links to,
weighted with the number of links. Hosts with allowed pages are trusted seeds,
hosts with blocked pages distrusted ones, by their numbers of such pages.
Trust is personalised PageRank along the edges, distrust the same against them:
who links to a blocked host is suspect. Each round sends ``damping`` of a host's value
on and returns the rest to the seeds. With a ``tolerance``, rounds go on until no
value reaches a new host and none changes by more than that share of itself,
however long the chains are; without one there are ``rounds`` of them. A host whose distrust is
over ``threshold`` of the sum of both is blocked, any other allowed.

All steps are DataFrame expressions. Edges and values are aggregated per host
before they are joined, so a host with a third of all pages is one row there;
values are written to the shared folder after each round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import forget, name, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\bhref\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


@dataclass(frozen=True)
class Settings:
    rounds: int = 12  # without a tolerance
    damping: float = 0.85
    threshold: float = 0.5
    tolerance: float | None = None


def _after(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(_after(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The rule that decides, as text, and its verdict; null if none fits. Of equal length the first in order."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts. Links without a host of their own stay within the page's."""
    links = F.regexp_extract_all(F.coalesce(name(html_col), F.lit("")), F.lit(LINK), F.lit(1))
    found = pages.select(host_of(name(url_col)).alias("src"), F.explode(links).alias("link"))
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    return found.select("src", host_of(full).alias("dst")).where("src != dst AND src != '' AND dst != ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def spread(links: DataFrame, seeds: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(host, trust, distrust) for hosts that have a seed or that values reach.

    ``seeds``: (host, allowed, blocked), numbers of pages. Values of a kind sum up to one
    over the seeds; a host without edges onwards sends nothing.
    """
    spark = links.sparkSession
    outward = links.groupBy("src").agg(F.sum("n").alias("total"))
    inward = links.groupBy("dst").agg(F.sum("n").alias("total"))
    along = links.join(outward, "src").select(F.col("src").alias("a"), F.col("dst").alias("b"), (F.col("n") / F.col("total")).alias("t"), F.lit(0.0).alias("d"))
    against = links.join(inward, "dst").select(F.col("dst").alias("a"), F.col("src").alias("b"), F.lit(0.0).alias("t"), (F.col("n") / F.col("total")).alias("d"))
    moves, moves_path = stored(along.unionAll(against), "url-moves")
    sums = seeds.agg(F.sum("allowed").alias("sa"), F.sum("blocked").alias("sb")).first()
    part = lambda c, total: (F.col(c) / F.lit(float(total or 0) or 1.0)).cast("double")
    start, start_path = stored(seeds.select("host", part("allowed", sums["sa"]).alias("trust"), part("blocked", sums["sb"]).alias("distrust")), "url-seeds")
    now, path = start, None
    done = 0
    while s.tolerance is not None or done < s.rounds:
        sent = now.join(moves, now["host"] == moves["a"]).select(
            F.col("b").alias("host"), (F.col("trust") * F.col("t") * s.damping).alias("trust"), (F.col("distrust") * F.col("d") * s.damping).alias("distrust")
        )
        back = start.select("host", (F.col("trust") * (1 - s.damping)).alias("trust"), (F.col("distrust") * (1 - s.damping)).alias("distrust"))
        both = sent.unionAll(back).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        old = path
        before = now
        now, path = stored(both, "url-values")
        settled = s.tolerance is not None and _settled(before, now, s.tolerance)
        if old:
            forget(spark, old)
        done += 1
        if settled:
            break
    forget(spark, moves_path)
    if path:
        forget(spark, start_path)
    return now


def _settled(before: DataFrame, now: DataFrame, tolerance: float) -> bool:
    """Whether a round gave no host a new value and changed none by more than ``tolerance`` of itself."""
    was = before.select(F.col("host").alias("b_host"), F.col("trust").alias("b_trust"), F.col("distrust").alias("b_distrust"))
    met = now.join(was, now["host"] == was["b_host"], "left")
    moved = lambda c: F.abs(F.col(c) - F.coalesce(f"b_{c}", F.lit(0.0))) > F.lit(tolerance) * F.col(c)
    return met.agg(F.count(F.when(moved("trust") | moved("distrust"), 1))).first()[0] == 0


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    rules: tuple[Rule, ...] = RULES,
    settings: Settings = Settings(),
) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) per row of ``pages``.

    The verdict is that of the longest rule, else of the host's values. A null
    url has an empty host, which no rule fits and no value reaches: it is
    allowed. Rows are judged by themselves, repeated ones alike.
    """
    s = settings
    host, path = host_of(name(url_col)), path_of(name(url_col))
    rows = pages.select(name(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = rows.withColumns({"rule": rule, "verdict": verdict})
    seeds = ruled.where("verdict IS NOT NULL").groupBy("host").agg(
        F.count(F.when(F.col("verdict") == "allow", 1)).alias("allowed"), F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked")
    )
    values = spread(edges(pages, url_col, html_col), seeds, s).select(F.col("host").alias("v_host"), "trust", "distrust")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    bad = distrust > F.lit(s.threshold) * (trust + distrust)
    met = ruled.join(values, ruled["host"] == values["v_host"], "left")
    own = F.when(bad, F.lit("block")).otherwise(F.lit("allow"))
    return met.select(id_col, "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
