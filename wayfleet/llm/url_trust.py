"""URL filter: host and path rules, and trust that spreads over the graph of hosts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.common import cut, filled, without


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, from a path on."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
#: Names below which anyone may register: hosts there have no more in common than those of a top-level domain.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "net.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.za", "co.in", "co.jp", "ne.jp", "or.jp",
    "co.kr", "com.br", "com.cn", "com.mx", "com.tr", "com.ar", "com.sg", "com.hk", "com.tw", "github.io", "blogspot.com", "wordpress.com",
)
#: Moves between hosts, or hosts, of a partition while trust spreads.
MOVES = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HREF = r"""(?i)\shref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'>\s]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(filled(url), "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def matching(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """``(a, b, w)``: hosts and the hosts they link to, by number of links, and each host tied both ways, with
    weight 1, to every domain above it that is a host too or that another host shares.

    Relative links stay on their host and are no edges. Domains go down to two labels, leave out ``suffixes`` and need
    no pages; addresses made of numbers, and names beyond the 253 characters of a host name, have none.
    """
    links = pages.select("host", F.explode(F.array_distinct(F.regexp_extract_all(filled(F.col("html")), F.lit(_HREF), F.lit(1)))).alias("link"))
    links = links.select("host", host_and_path(F.regexp_replace("link", r"^//", "http://"))[0].alias("to")).where("host <> to AND to <> ''")
    linked = cut(links.groupBy(F.col("host").alias("a"), F.col("to").alias("b")).agg(F.count(F.lit(1)).cast("double").alias("w")))
    hosts = cut(pages.select("host").union(linked.select("a")).union(linked.select("b")).distinct())
    named = hosts.where(~F.col("host").rlike(r"^[0-9.]+(:[0-9]*)?$") & (F.length("host") <= 253)).select("host", F.split("host", r"\.").alias("_labels"))
    ups = F.expr("transform(sequence(1, size(_labels) - 2), i -> array_join(slice(_labels, i + 1, size(_labels)), '.'))")
    above = cut(named.where("size(_labels) > 2").select("host", F.explode(ups).alias("up")).where(~F.col("up").isin(list(suffixes))))
    shared = above.groupBy("up").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("up")
    shared = shared.union(hosts.select(F.col("host").alias("up"))).distinct()
    ties = above.join(shared, "up")
    both = ties.select(F.explode(F.array(F.struct(F.col("host").alias("a"), F.col("up").alias("b")), F.struct(F.col("up").alias("a"), F.col("host").alias("b")))).alias("e"))
    edges = linked.union(both.select("e.a", "e.b", F.lit(1.0)))
    return edges.where("a <> ''").groupBy("a", "b").agg(F.sum("w").alias("w"))


def spread(seeds: DataFrame, edges: DataFrame, damping: float, rounds: int, close: float) -> DataFrame:
    """Trust and distrust of every host, each from 0 to 1: ``host, trust, distrust``.

    ``seeds`` holds the share of a host's pages that rules allow and block. Distrust is personalised PageRank against
    the links, held per host to the weight of its own links: the chance that a walk from the host, which goes on along a link
    with probability ``damping`` and else ends where it is, ends on a blocked page. Trust is the same along the links
    that lead to the host, read at allowed pages. A walk never ends on a domain without pages. A host with few ways in or
    out and one with many are thus on one scale. Ends after ``rounds`` or when no score moves by more than ``close``.
    """
    out = edges.groupBy("a").agg(F.sum("w").alias("out"))
    into = edges.groupBy("b").agg(F.sum("w").alias("into"))
    shares = cut(edges.join(out, "a").join(into, "b").select("a", "b", (F.col("w") / F.col("into")).alias("f"), (F.col("w") / F.col("out")).alias("g")))
    moves = cut(shares.select(F.explode(F.array(
        F.struct(F.col("a").alias("src"), F.col("b").alias("dst"), F.col("f").alias("t"), F.lit(0.0).alias("d")),
        F.struct(F.col("b").alias("src"), F.col("a").alias("dst"), F.lit(0.0).alias("t"), F.col("g").alias("d")),
    )).alias("m")).select("m.*"))
    # few partitions and one join a round: rounds are many and small
    known = moves.count()
    moves = moves.coalesce(max(1, -(-known // MOVES)))
    # what a host keeps of its own: all without a way on, nothing without pages
    ways = moves.groupBy(F.col("dst").alias("_dst")).agg(F.max(F.col("t") > 0).alias("_t"), F.max(F.col("d") > 0).alias("_d"))
    paged = seeds.select("host", "allowed", "blocked", F.lit(True).alias("paged"))
    others = ways.join(seeds, F.col("_dst") == F.col("host"), "left_anti").select(F.col("_dst"), F.lit(0.0), F.lit(0.0), F.lit(False))
    start = paged.union(others).join(ways, F.col("host") == F.col("_dst"), "left")

    def own(way: str) -> Column:
        return F.when(~F.coalesce(way, F.lit(False)), 1.0).when(F.col("paged"), 1 - damping).otherwise(0.0)

    now = cut(start.select("host", "allowed", "blocked", own("_t").alias("own_t"), own("_d").alias("own_d"),
                           F.col("allowed").alias("trust"), F.col("blocked").alias("distrust")))
    parts = max(1, -(-max(known, now.count()) // MOVES))
    now = now.coalesce(parts)
    for _ in range(rounds if known else 0):
        passed = moves.join(now.select(F.col("host").alias("src"), "trust", "distrust"), "src").groupBy("dst").agg(
            F.sum(F.col("t") * F.col("trust")).alias("t_in"), F.sum(F.col("d") * F.col("distrust")).alias("d_in")
        )
        trust = F.col("own_t") * F.col("allowed") + (1 - F.col("own_t")) * F.coalesce("t_in", F.lit(0.0))
        distrust = F.col("own_d") * F.col("blocked") + (1 - F.col("own_d")) * F.coalesce("d_in", F.lit(0.0))
        moved = F.greatest(F.abs(trust - F.col("trust")), F.abs(distrust - F.col("distrust")))
        step = now.join(passed, F.col("host") == F.col("dst"), "left")
        step = cut(step.select("host", "allowed", "blocked", "own_t", "own_d", trust.alias("trust"), distrust.alias("distrust"), moved.alias("moved")))
        step = step.coalesce(parts)
        now = step.drop("moved")
        if not step.where(F.col("moved") > F.lit(close)).take(1):
            break
    return now.select("host", "trust", "distrust")


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule] = RULES, damping: float = 0.5, rounds: int = 20, close: float = 1e-4, limit: float = 0.2,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """Every page without its ``html``, with ``host, path, rule, verdict, trust, distrust``.

    The longest rule that fits decides. Other pages follow their host: blocked when its distrust is at least
    ``limit`` (one walk in five from it ends on a blocked page) and above its trust. Seeds are the
    shares of a host's pages that rules allow or block. Null and malformed URLs have empty host and path
    and no edges; they are judged by the share of rules on pages like them, so they are allowed. Null ``html``
    has no links. Repeated rows count as often as they occur and are judged alike. Columns of the result's
    names are replaced, others stay.
    """
    pages = without(pages, ["host", "path", "rule", "verdict", "trust", "distrust", "_rule"])
    host, path = host_and_path(F.col("url"))
    ruled = pages.withColumns({"host": host, "path": path}).withColumn("_rule", matching(rules, F.col("host"), F.col("path")))
    seeds = ruled.groupBy("host").agg(
        F.avg(F.coalesce(F.col("_rule.verdict") == "allow", F.lit(False)).cast("double")).alias("allowed"),
        F.avg(F.coalesce(F.col("_rule.verdict") == "block", F.lit(False)).cast("double")).alias("blocked"),
    )
    scores = spread(cut(seeds), cut(host_edges(ruled.select("host", "html"), suffixes)), damping, rounds, close)
    scores = scores.withColumnRenamed("host", "_host")
    judged = ruled.drop("html").join(scores, F.col("host") == F.col("_host"), "left").drop("_host")
    bad = (F.col("distrust") >= F.lit(limit)) & (F.col("distrust") > F.col("trust"))
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(bad, "block").otherwise("allow"))
    return judged.withColumns({"rule": F.col("_rule.rule"), "verdict": verdict}).drop("_rule")
