"""URL filters: host and path rules, and link-graph propagation for all else.

* A rule is a host and a path.  It fits its host and all subdomains where the
  url's path starts with the rule's; of the rules that fit, the longest wins.
* Pages that a rule judges are seeds: their hosts get trust or distrust by their
  numbers.  Trust spreads along host edges by personalised PageRank, distrust
  against them.  Edges are the hyperlinks between different hosts, counted, and
  one each way between a host and the domain it is a subdomain of.
* Rounds move mass along the edges until no more than ``TOLERANCE`` of it can
  still come, whatever the graph's depth: mass that has settled on a host stays.
* A page without a rule is blocked if its host's distrust is larger than
  ``ratio`` times its trust, by more than what the rounds left open.

The host graph is aggregated before anything is joined, and ranks are written to
the shared folder every few rounds.  One host may hold a third of all pages or
edges: hosts of more than ``HOT`` edges or pages, or a 256th of all pages, are
dealt over salts, as many as their counts fill.

Edge cases: a url that is null or lacks ``://`` has an empty host and path; no
rule fits and no link counts, so it is allowed.  Null html has no links.
Repeated rows are judged alike.  An empty table gives no rows; without rules all
is allowed; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.runtime import plain
from tickloom.storage import stored

HOT = 1_000_000
SHARES = 256
DAMPING = 0.85
TOLERANCE = 1e-3
#: Rounds between writes.
STRIDE = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\bhref\s*=\s*["']?((?:https?:)?//[^\s"'>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def with_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds the winning rule and its verdict to (host, path); rules: (rule, verdict), as ``host/path``."""
    cut = F.instr("rule", "/")
    rules = rules.select("rule", "verdict", F.when(cut > 0, F.expr("substr(rule, 1, instr(rule, '/') - 1)")).otherwise(F.col("rule")).alias("rule_host"), F.when(cut > 0, F.expr("substr(rule, instr(rule, '/'))")).otherwise(F.lit("")).alias("rule_path")).distinct()
    hosts = pages.select("host").where("host <> ''").distinct()
    # a host and every domain above it
    above = hosts.select("host", F.explode(F.expr("transform(sequence(1, size(split(host, '[.]'))), i -> array_join(slice(split(host, '[.]'), i, size(split(host, '[.]'))), '.'))")).alias("rule_host"))
    fits = above.join(rules, "rule_host").groupBy("host").agg(F.collect_list(F.struct(F.length("rule").alias("size"), "rule", "verdict", "rule_path")).alias("rules"))
    return salted(pages, fits, "host").withColumn("best", F.array_max(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])))).withColumns({"rule": F.col("best.rule"), "ruled": F.col("best.verdict")}).drop("rules", "best")


def salted(many: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """A left join with ``few``, one row a key, in which a hot key's rows go to several tasks."""
    counts = stored(many.groupBy(key).agg(F.count("*").alias("n_")), "key-counts")
    total = counts.agg(F.sum("n_")).first()[0] or 0
    # a task reads a 256th of all rows for one key at most, and HOT rows; so there are few hot keys, and whether they are broadcast is left to their size
    most = max(1, min(HOT, total // SHARES))
    hot = stored(counts.where(F.col("n_") > most).select(key, F.ceil(F.col("n_") / most).alias("salts_")), "hot-keys")
    if not hot.limit(1).count():
        return many.join(few, key, "left")
    columns = many.columns
    salts = F.coalesce("salts_", F.lit(1))
    many = many.join(hot, key, "left").withColumn("salt_", F.pmod(F.xxhash64(*columns), salts)).drop("salts_")
    few = few.join(hot, key, "left").withColumn("salt_", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("salts_")
    return many.join(few, [key, "salt_"], "left").drop("salt_")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) of (host, url, html)."""
    links = pages.select("host", F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1))).alias("link"))
    links = links.select(F.col("host").alias("src"), F.translate(F.regexp_extract("link", r"//([^/?#]*)", 1), UPPER, LOWER).alias("dst"))
    links = links.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    ends = pages.select("host").where("host <> ''").unionByName(links.select(F.col("dst").alias("host"))).distinct()
    # every host and the domains above it, down to two labels
    chain = ends.select(F.explode(F.expr("transform(sequence(1, greatest(1, size(split(host, '[.]')) - 1)), i -> array_join(slice(split(host, '[.]'), i, size(split(host, '[.]'))), '.'))")).alias("src")).distinct()
    up = chain.where(F.size(F.split("src", "[.]")) > 2).select("src", F.expr("substr(src, instr(src, '.') + 1)").alias("dst"))
    family = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("weight", F.lit(1.0))
    return links.unionByName(family).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) by personalised PageRank from seeds (host, trust, distrust)."""
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    out = both.groupBy("kind", "src").agg(F.sum("weight").alias("total"), F.ceil(F.count("*") / HOT).alias("parts"))
    part = F.pmod(F.xxhash64("dst"), F.col("parts"))
    moves = both.join(out, ["kind", "src"]).select("kind", "src", part.alias("part"), "parts", "dst", (damping * F.col("weight") / F.col("total")).alias("share"), F.lit(0).alias("keeps"))
    start = seeds.select(F.explode(F.array(F.struct(F.lit("trust").alias("kind"), "host", F.col("trust").alias("mass")), F.struct(F.lit("distrust").alias("kind"), "host", F.col("distrust").alias("mass")))).alias("s")).select("s.*").where("mass > 0")
    # every host has an edge to itself, over which what has settled stays: a round reads the ranks once
    hosts = both.select("kind", "src").unionByName(both.select("kind", F.col("dst").alias("src"))).unionByName(start.select("kind", F.col("host").alias("src"))).distinct()
    stays = hosts.select("kind", "src", F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"), F.col("src").alias("dst"), F.lit(0.0).alias("share"), F.lit(1).alias("keeps"))
    both = stored(moves.unionByName(stays), "host-edges")
    # hosts with more edges than one task takes
    hubs = stored(both.where("parts > 1").select("kind", F.col("src").alias("host"), "parts").distinct(), "host-hubs")
    hubs = hubs if hubs.limit(1).count() else None
    whole = start.groupBy("kind").agg(F.sum("mass").alias("whole"))
    rank = stored(start.join(F.broadcast(whole), "kind").select("kind", "host", F.lit(0.0).alias("settled"), ((1 - damping) * F.col("mass") / F.col("whole")).alias("moving")), "host-ranks")
    while True:
        # what moves now can bring this much in all the rounds to come
        left = rank.groupBy("kind").agg(F.sum("moving").alias("moving")).agg(F.max("moving")).first()[0]
        if left is None or left <= tolerance * (1 - damping):
            break
        for _ in range(STRIDE):
            part = F.lit(0).cast("long")
            if hubs is not None:
                rank = rank.join(hubs, ["kind", "host"], "left")
                part = F.explode(F.sequence(part, F.coalesce("parts", F.lit(1)) - 1))
            going = rank.select("kind", F.col("host").alias("src"), part.alias("part"), "settled", "moving")
            gone = going.join(both.drop("parts"), ["kind", "src", "part"])
            rank = gone.groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.when(F.col("keeps") == 1, F.col("settled") + F.col("moving")).otherwise(0.0)).alias("settled"), F.sum(F.col("moving") * F.col("share")).alias("moving"))
        rank = stored(rank, "host-ranks")
    mass = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("settled") + F.col("moving")).otherwise(0.0)).alias(kind)
    return rank.groupBy("host").agg(mass("trust"), mass("distrust"))


def judge(pages: DataFrame, rules: DataFrame, ratio: float = 1.0) -> DataFrame:
    """page_id, host, path, rule, verdict of (page_id, url, html)."""
    own = plain(pages, page_id="long", url="string", html="string")
    own = own.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    ruled = stored(with_rules(own.select("page_id", "host", "path"), rules), "ruled-pages")
    seeds = ruled.where("rule is not null").groupBy("host").agg(F.sum((F.col("ruled") == "allow").cast("double")).alias("trust"), F.sum((F.col("ruled") == "block").cast("double")).alias("distrust"))
    ranks = propagate(stored(host_edges(own.select("host", "html")), "host-links"), seeds)
    more = F.col("distrust") > ratio * (1 + 10 * TOLERANCE) * F.col("trust")
    hosts = ranks.select("host", F.when(more, "block").otherwise("allow").alias("spread"))
    out = salted(ruled, hosts, "host")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", "spread", F.lit("allow")).alias("verdict"))
