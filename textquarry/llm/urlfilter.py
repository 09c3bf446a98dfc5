"""URL verdicts: literal rules first, else trust and distrust spread over the host graph (DataFrame functions only).

Hosts link to hosts by the links in their pages that name a host, with a scheme
or without (``//host/``); links are summed by host pair, so the graph has one
edge a pair whatever the number of pages.  Hosts that are linked to but have no
pages are part of it; the rules that fit the links to them stand for their pages.
Trust is a personalised PageRank from hosts whose pages allow rules cover, along
the links; distrust is one from hosts whose pages block rules cover, against
the links (who links to a blocked host is suspect).  A host is blocked when its
distrust exceeds its trust by more than ``margin`` times the uniform share of a
host with pages.  Every round is one join of edges with scores and one sum by host, both
open to partial aggregation and skew splitting, and is written to the shared
folder; rounds go on until no further ones could change a score by a thousandth
of that limit, so a host is reached over any number of links.

Edge cases: a null url, or one without ``://``, has empty host and path, fits no
rule and is allowed; null or empty html has no links; links inside a host are
left out, and a page's repeated links count once; html is read whole, however
long; of rules of equal length the smaller text wins, then the earlier rule;
repeated rows are judged alike; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.storage import forget, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A link in an attribute that names a host.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)


def _after_scheme(url: Column) -> Column:
    return F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/ ? #``, A-Z in lower case; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without a host part."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The text and the verdict of the longest fitting rule, else null.

    A rule fits its host and all subdomains, if the path starts with its path.
    The rules are a list on the driver (some hundreds at most) and become one
    CASE expression, longest first.
    """
    text = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, r.text) if text is None else text.when(fits, r.text)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    return (text, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def host_graph(pages: DataFrame, rules: tuple[Rule, ...] = ()) -> DataFrame:
    """``src, dst, links, allowed, blocked`` between different hosts, from the links in ``html`` and the rules that fit these."""
    found = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))).alias("link"))
    found = found.withColumn("link", F.when(F.col("link").startswith("//"), F.concat(F.lit(":"), "link")).otherwise(F.col("link")))
    found = found.select("src", host_of(F.col("link")).alias("dst"), path_of(F.col("link")).alias("path")).where("src <> dst and src <> '' and dst <> ''")
    verdict = longest_rule(F.col("dst"), F.col("path"), rules)[1]
    return found.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"), F.count_if(verdict == "allow").alias("allowed"), F.count_if(verdict == "block").alias("blocked"))


def propagate(hosts: DataFrame, graph: DataFrame, *, damping: float = 0.85, error: float = 1e-6) -> DataFrame:
    """``host, trust0, distrust0`` and the graph between these hosts -> ``host, trust, distrust``.

    The two walks run together: an edge carries trust from its source and
    distrust from its target.  A round moves on what the round before brought,
    until all that is still to come, by any number of rounds, sums to ``error``
    at most.  Mass at a host without a way on returns to the seeds: the sums of
    the rounds, in proportion, so that a walk's scores sum to its seeds.  One
    formula holds with and without edges, where the seeds are the scores.
    """
    if not 0 <= damping < 1 or error <= 0:
        raise ValueError("damping must be in [0, 1) and error above 0")
    ways = graph.select(F.lit(1).alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to"), "links").union(
        graph.select(F.lit(2).alias("kind"), F.col("dst").alias("from"), F.col("src").alias("to"), "links")
    )
    out = ways.groupBy("kind", "from").agg(F.sum("links").alias("all_links"))
    ways = written(ways.join(out, ["kind", "from"]).select("kind", "from", "to", (F.col("links") / F.col("all_links")).alias("part")), "ways")
    scores = written(hosts.select(F.col("host").alias("from"), F.explode(F.array(
        F.struct(F.lit(1).alias("kind"), F.col("trust0").alias("seed")), F.struct(F.lit(2).alias("kind"), F.col("distrust0").alias("seed"))
    )).alias("x")).select("x.kind", "from", F.col("x.seed").alias("score"), F.col("x.seed").alias("new")), "scores")
    seeded = dict(scores.groupBy("kind").agg(F.sum("new")).collect())
    total, moving = dict(seeded), bool(seeded)
    while moving:
        moved = ways.join(scores.where("new > 0"), ["kind", "from"]).groupBy("kind", F.col("to").alias("from")).agg((damping * F.sum(F.col("new") * F.col("part"))).alias("got"))
        got = F.coalesce("got", F.lit(0.0))
        following = written(scores.join(moved, ["kind", "from"], "left").select("kind", "from", (F.col("score") + got).alias("score"), got.alias("new")), "scores")
        forget(scores)
        scores, moving = following, False
        for k, new in scores.groupBy("kind").agg(F.sum("new")).collect():
            total[k] += new
            # each later round brings at most damping times the one before
            moving = moving or new * damping / (1 - damping) > error * total[k]
    walk = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)) * (seeded[kind] / total[kind] if total.get(kind) else 1.0)
    return scores.groupBy(F.col("from").alias("host")).agg(walk(1).alias("trust"), walk(2).alias("distrust"))


def judge(pages: DataFrame, *, rules: tuple[Rule, ...] = RULES, damping: float = 0.85, margin: float = 1.0) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for every row of ``page_id, url, html``."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    text, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    judged = urls.select("page_id", "host", "path", text.alias("rule"), verdict.alias("by_rule"))
    graph = written(host_graph(pages, rules), "host-graph")
    hosts = judged.groupBy("host").agg(
        F.lit(True).alias("own"), F.count(F.lit(1)).alias("pages"), F.count_if(F.col("by_rule") == "allow").alias("allowed"), F.count_if(F.col("by_rule") == "block").alias("blocked")
    )
    others = graph.groupBy(F.col("dst").alias("host")).agg(F.lit(False).alias("own"), F.sum("links").alias("pages"), F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
    hosts = hosts.unionByName(others.join(hosts.select("host"), "host", "left_anti"))
    lean = (F.col("allowed") - F.col("blocked")) / F.col("pages")
    hosts = written(hosts.select("host", "own", F.greatest(lean, F.lit(0.0)).alias("good"), F.greatest(-lean, F.lit(0.0)).alias("bad")), "hosts")
    sums = hosts.agg(F.count_if("own").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    share = lambda c: F.col(c) / F.lit(sums[c]) if sums[c] else F.lit(0.0)
    limit = margin / max(1, sums["n"])
    # scores stop changing far below the limit; a limit of 0 asks for all that doubles can tell
    scores = propagate(hosts.select("host", share("good").alias("trust0"), share("bad").alias("distrust0")), graph, damping=damping, error=max(abs(limit) / 1000, 1e-15))
    bad = F.col("distrust") - F.col("trust") > limit
    scores = written(scores.withColumn("host_verdict", F.when(bad & (F.col("host") != ""), "block").otherwise("allow")), "host-scores")
    return judged.join(scores, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("by_rule", "host_verdict", F.lit("allow")).alias("verdict"), "trust", "distrust")
