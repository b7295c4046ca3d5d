"""URL filters: host rules, and verdicts of path templates learned from labels and from the urls that rules judge. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import saved


@dataclass(frozen=True)
class Templates:
    """z: how far shares of blocked urls may lie apart for branches to be merged; bins: how finely shares are told apart.

    least: labelled urls that a branch must have before it is merged; so neither unlabelled branches nor those with
    hardly a label take over what others are. prior: urls of the share `neutral` that each template counts besides its own.
    purity: smoothed share of blocked urls at which a template is rejected.
    agree: branches with `least` labels that a node must have before templates without labels follow it.
    """

    z: float = 2.58
    bins: int = 20
    least: int = 5
    prior: float = 5.0
    neutral: float = 0.5
    purity: float = 0.9
    agree: int = 3


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if there is no ://."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(text, pattern, 2)


def _rule(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict."""
    by_length = sorted({r for _, r in rules}, key=lambda r: (-len(r), r))
    verdict = {r: v for v, r in rules}

    def fits(rule: str) -> Column:
        host, _, path = rule.partition("/")
        return ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(f"/{path}"))

    choose = lambda value: F.coalesce(*(F.when(fits(r), F.lit(value(r))) for r in by_length), F.lit(None).cast("string"))
    return choose(lambda r: r), choose(lambda r: verdict[r])


def _general(segment: Column) -> Column:
    """Numbers, hashes and other segments with digits as a wildcard, with the file's ending."""
    return F.when(segment.rlike(r"[0-9]|%|.{25,}"), F.concat(F.lit("*"), F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1))).otherwise(segment)


def _levels() -> Column:
    """For each segment of `segments`: its number, a hash of those before it, itself."""
    return F.transform("segments", lambda s, d: F.struct(d.alias("level"), F.xxhash64(F.slice("segments", F.lit(1), d)).alias("above"), s.alias("segment")))


def _alike(leaves: DataFrame, t: Templates) -> DataFrame:
    """(host, level, above, segment, alike) of branches that block as labelled siblings do; those of one number are merged.

    A node's branches are laid into `bins` by their share of blocked urls; neighbouring bins are one if their shares don't
    differ. So no more rows than bins come together for a node, however many branches it has.
    """
    node = ["host", "level", "above"]
    labelled = leaves.where("known > 0").select("host", F.explode(_levels()).alias("x"), "known", "blocked").select("host", "x.*", "known", "blocked")
    branch = labelled.groupBy(*node, "segment").agg(F.sum("known").alias("known"), F.sum("blocked").alias("blocked")).where(F.col("known") >= t.least)
    branch = branch.withColumn("bin", F.floor(F.col("blocked") / F.col("known") * t.bins + 0.5))
    bins = branch.groupBy(*node, "bin").agg(F.sum("known").alias("known"), F.sum("blocked").alias("blocked"), F.count("*").alias("branches"))
    order = Window.partitionBy(*node).orderBy("bin")
    known, blocked = F.lag("known").over(order), F.lag("blocked").over(order)
    pooled = (F.col("blocked") + blocked) / (F.col("known") + known)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("known") + 1 / known))
    gap = F.abs(F.col("blocked") / F.col("known") - blocked / known)
    bins = bins.withColumn("apart", F.coalesce(gap > t.z * spread, F.lit(True)).cast("int")).withColumn("alike", F.sum("apart").over(order))
    several = bins.groupBy(*node, "alike").agg(F.sum("branches").alias("n")).where("n > 1").drop("n")
    return branch.join(bins.select(*node, "bin", "alike").join(several, [*node, "alike"]), [*node, "bin"]).select(*node, "segment", "alike")


def _split(urls: DataFrame, rules: list[tuple[str, str]], *keep: str | Column) -> DataFrame:
    """host, path, rule, the rule's verdict and the path's general segments of urls(url, ...), after the columns to keep."""
    host, path = parts(F.col("url"))
    rule, verdict = _rule(rules)
    rows = urls.select(*keep, host.alias("host"), path.alias("path")).withColumns({"rule": rule, "ruled": verdict})
    return rows.withColumn("segments", F.transform(F.filter(F.split("path", "/+"), lambda s: s != ""), _general))


def _smoothed(blocked: Column, known: Column, t: Templates) -> Column:
    return (blocked + t.prior * t.neutral) / (known + t.prior)


def _agreed(shaped: DataFrame, t: Templates) -> DataFrame:
    """(host, template, agreed) of templates without labels below a labelled node: the purity of the nearest such node's
    branches if these agree to be rejected, else null."""
    levels = F.transform("names", lambda s, d: F.struct(d.alias("level"), F.xxhash64(F.slice("names", F.lit(1), d)).alias("above"), F.element_at("segments", d + 1).alias("branch")))
    node = ["host", "level", "above"]
    told = shaped.where("told > 0").select("host", "told", "bad", F.explode(levels).alias("x")).select("host", "told", "bad", "x.*")
    branch = told.groupBy(*node, "branch").agg(F.sum("told").alias("told"), F.sum("bad").alias("bad"))
    pooled = branch.groupBy(*node).agg(F.min(F.col("bad") / F.col("told")).alias("lowest"), F.count_if(F.col("told") >= t.least).alias("branches"), _smoothed(F.sum("bad"), F.sum("told"), t).alias("pooled"))
    agrees = (F.least("lowest", "pooled") >= t.purity) & (F.col("branches") >= t.agree)
    nodes = pooled.select(*node, F.when(agrees, F.col("pooled")).alias("agreed"))
    silent = shaped.groupBy("host", "template").agg(F.sum("known").alias("known"), F.first("names").alias("names"), F.first("segments").alias("segments")).where("known = 0")
    above = silent.select("host", "template", F.explode(levels).alias("x")).select("host", "template", "x.level", "x.above")
    return above.join(nodes, node).groupBy("host", "template").agg(F.max_by("agreed", "level").alias("agreed"))


def url_filters(pages: DataFrame, rules: list[tuple[str, str]], t: Templates = Templates(), labels: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every row of pages(page_id, url, ...).

    rules: (verdict, host and path) pairs, a parameter of at most some hundred; the longest that fits a url wins.
    labels(url, bad, ...): urls known to be bad or not, of pages or others. Labelled are urls that a rule judges, by the
    rule, and those of `labels` that none judges. Each host's paths form a tree of segments, of any depth; segments with
    digits are wildcards from the start, and of each node's branches, labelled ones whose share of blocked urls doesn't
    differ from that of labelled siblings become one numbered wildcard. Branches without labels stay themselves. A template
    is rejected if the share of blocked urls among its own labelled ones, smoothed towards `neutral`, is `purity` or more.
    A template without labelled urls is rejected, at the purity of all of the node's, if it lies below a node of which
    `agree` branches or more hold `least` labels, every labelled branch has a share of `purity` or more, and all together
    do when smoothed; of several labelled nodes above, the nearest decides. There, a rule's block says nothing (it is about
    its own path), its allow counts as a label. Branches that were merged are one node and share their labels, the rules'
    too. Urls without a rule get their template's verdict, allow where nothing is known.
    Null urls and those without :// have an empty host and path and are one template. Rows of both tables count as often
    as they occur; a label whose `bad` is null is none. Other columns are not read.
    """
    rows = _split(pages, rules, "page_id")
    seen = rows.select("host", "segments", "ruled", F.lit(None).cast("boolean").alias("bad"))
    if labels is not None:
        seen = seen.unionByName(_split(labels, rules, F.col("bad").cast("boolean").alias("bad")).where("ruled is null and bad is not null").select(*seen.columns))
    rejected, allowed, bad = F.count_if(F.col("ruled") == "block"), F.count_if(F.col("ruled") == "allow"), F.count_if("bad")
    leaves = seen.groupBy("host", "segments").agg((F.count("ruled") + F.count("bad")).alias("known"), (rejected + bad).alias("blocked"), (allowed + F.count("bad")).alias("told"), bad.alias("bad"))
    leaves = saved(leaves.withColumn("leaf", F.monotonically_increasing_id()))
    alike = saved(_alike(leaves, t))
    at = leaves.select("leaf", "host", F.explode(_levels()).alias("x")).select("leaf", "host", "x.*")
    stars = at.join(alike, ["host", "level", "above", "segment"]).groupBy("leaf").agg(F.map_from_entries(F.collect_list(F.struct("level", "alike"))).alias("stars"))
    named = F.transform("segments", lambda s, d: F.concat(F.lit("/"), F.coalesce(F.concat(F.lit("*"), F.try_element_at("stars", d)), s)))
    counts = ["known", "blocked", "told", "bad"]
    shaped = leaves.join(stars, "leaf", "left").select("host", "segments", *counts, named.alias("names"))
    shaped = saved(shaped.withColumn("template", F.array_join("names", "")))
    purity = shaped.groupBy("host", "template").agg(_smoothed(F.sum("blocked"), F.sum("known"), t).alias("purity"))
    if labels is not None:
        purity = purity.join(_agreed(shaped, t), ["host", "template"], "left").select("host", "template", F.coalesce("agreed", "purity").alias("purity"))
    judged = shaped.join(purity, ["host", "template"]).select("host", "segments", "template", "purity")
    own = F.when(F.col("purity") >= t.purity, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(judged, ["host", "segments"]).select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "template", "purity")
