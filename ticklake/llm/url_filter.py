"""URL filter: rules first, then a path-template tree of each host. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.shared import read_table, written

#: (host, path, verdict); the longest fitting rule wins.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: A node with more children than FAN turns those with less than SHARE of its pages into one wildcard, unless their own labels set them apart.
FAN, SHARE = 8, 0.05
#: Sibling branches with at least EVIDENCE labelled pages each are merged if their share of bad pages differs from the node's by less than Z standard errors.
EVIDENCE, Z = 5, 1.96
#: A branch is like its siblings if what follows it has a Bhattacharyya coefficient of SIMILAR or more with what follows all of them.
SIMILAR = 0.9
#: Weights, in branches and in pages, of what is known above a branch and above a template.
BRANCHES, PAGES = 2.0, 2.0
#: A template is rejected if its purity reaches this.
PURITY = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(url) -> tuple[F.Column, F.Column]:
    """Host and path of a url; both empty without ``://`` or if it is null."""
    split = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(F.col(url), F.lit(""))
    return F.translate(F.regexp_extract(url, split, 1), UPPER, LOWER), F.regexp_extract(url, split, 2)


def rule_of(host, path, rules=RULES) -> F.Column:
    """The longest rule that fits, as struct(rule, verdict), or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))[::-1]:
        fits = ((F.col(host) == name) | F.col(host).endswith("." + name)) & F.col(path).startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def domain_of(host) -> F.Column:
    """The last two labels of a host."""
    return F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1)


def raw_template(path) -> F.Column:
    """Segments of a path with numbers, hexadecimal names, dates and other mixed names as wildcards, file endings kept."""
    segments = F.filter(F.split(F.col(path), "/"), lambda s: s != "")

    def general(s):
        ending = F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1)
        stem = F.substring(s, F.lit(1), F.length(s) - F.length(ending))
        return F.when(stem.rlike(r"[0-9]|%[0-9A-Fa-f]{2}"), F.concat(F.lit("*"), ending)).otherwise(s)

    return F.transform(segments, general)


def shape(raw, level: int) -> F.Column:
    """What follows a level of a template: its wildcards, with ``w`` for every other segment."""
    rest = F.slice(raw, level + 2, F.greatest(F.size(raw), F.lit(1)))
    return F.array_join(F.transform(rest, lambda s: F.when(s.startswith("*"), s).otherwise("w")), "/")


def likeness(rows: DataFrame, node: list[str]) -> DataFrame:
    """``(*node, segment, usual)``: whether a branch is followed by the same shapes as all branches of its node, labelled or not."""
    each = rows.groupBy(*node, "segment", "shape").agg(F.sum("n").alias("n"))
    own = each.groupBy(*node, "segment").agg(F.sum("n").alias("own_n"))
    every = each.groupBy(*node, "shape").agg(F.sum("n").alias("every_n"))
    whole = each.groupBy(*node).agg(F.sum("n").alias("whole_n"))
    both = each.join(own, [*node, "segment"]).join(every, [*node, "shape"]).join(whole, node)
    alike = F.sum(F.sqrt(F.col("n") / F.col("own_n") * F.col("every_n") / F.col("whole_n")))
    return both.groupBy(*node, "segment").agg((alike >= SIMILAR).alias("usual"))


def template_tree(pages: DataFrame, key: str = "host") -> DataFrame:
    """``(key, raw, template, purity)`` from rows with key, raw (segments), bad (1, 0 or null: unlabelled) and base (what is known of the template elsewhere; null: 1/2).

    Works on sums for each key and raw template. Level by level, down to the
    deepest path, rare children of a wide node become ``*`` if they have too few
    labels for a test or their shares of bad pages don't differ; other labelled
    siblings whose shares don't differ become ``~``, unlabelled ones that look
    like their siblings ``?``. A branch inherits the mean of its like siblings'
    shares of bad pages, each labelled sibling counting once and what is known
    above as BRANCHES of them, so one bad section alone condemns no other. A
    template's purity is its share of bad pages, smoothed by PAGES pages of what
    its branch has inherited.
    """
    half = F.coalesce(F.avg("base"), F.lit(0.5))
    sums = [F.count("*").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count("bad").alias("labelled"), half.alias("prior")]
    tree = written(pages.groupBy(key, "raw").agg(*sums).withColumn("prefix", F.lit("")), "templates")
    ended = tree.filter(F.size("raw") == 0)
    node = [key, "prefix"]
    for level in range(tree.agg(F.max(F.size("raw"))).first()[0] or 0):
        tree = tree.filter(F.size("raw") > level).withColumns({"segment": F.get("raw", F.lit(level)), "shape": shape("raw", level)})
        prior = (F.sum(F.col("prior") * F.col("n")) / F.sum("n")).alias("prior")
        kids = tree.groupBy(*node, "segment").agg(*(F.sum(c).alias(c) for c in ("n", "bad", "labelled")), prior).join(likeness(tree, node), [*node, "segment"])
        kids = written(kids.withColumn("told", F.col("usual") & (F.col("labelled") >= EVIDENCE)).withColumn("share", F.when(F.col("told"), F.col("bad") / F.col("labelled")).otherwise(0.0)), "kids")
        all_ = kids.groupBy(*node).agg(F.count("*").alias("fan"), *(F.sum(c).alias("all_" + c) for c in ("n", "bad", "labelled", "share")), F.count_if("told").alias("all_told"))
        near = kids.join(all_, node)
        rate = F.col("all_bad") / F.col("all_labelled")
        error = F.sqrt(rate * (1 - rate) / F.col("labelled"))
        alike = (F.col("labelled") >= EVIDENCE) & (F.col("all_labelled") - F.col("labelled") >= EVIDENCE) & (F.abs(F.col("bad") / F.col("labelled") - rate) <= Z * error)
        rare = (F.col("fan") > FAN) & (F.col("n") < SHARE * F.col("all_n"))
        only_bad = F.col("all_bad") == F.col("all_labelled")
        vague = (F.col("labelled") < EVIDENCE) | (alike & ~only_bad)
        unknown = F.col("usual") & (F.col("labelled") == 0) & (F.col("fan") > 1)
        becomes = F.when(F.col("segment").startswith("*"), F.col("segment")).when(rare & vague, F.lit("*")).when(alike, F.lit("~")).when(unknown, F.lit("?")).otherwise(F.col("segment"))
        others = F.col("all_told") - F.col("told").cast("int")
        inherits = F.when(F.col("usual"), (F.col("all_share") - F.col("share") + BRANCHES * F.col("prior")) / (others + BRANCHES)).otherwise(F.col("prior"))
        near = written(near.select(*node, "segment", "n", becomes.alias("becomes"), inherits.alias("inherits")), "nodes")
        mean = near.groupBy(*node, "becomes").agg((F.sum(F.col("inherits") * F.col("n")) / F.sum("n")).alias("inherits"))
        near = near.drop("n", "inherits").join(mean, [*node, "becomes"])
        tree = tree.join(near, [*node, "segment"]).withColumn("prefix", F.concat("prefix", F.lit("/"), "becomes")).withColumn("prior", F.col("inherits"))
        tree = written(tree.drop("segment", "shape", "becomes", "inherits"), "templates")
        ended = ended.unionByName(tree.filter(F.size("raw") == level + 1))
    found = ended.groupBy(*node).agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"), (F.sum(F.col("prior") * F.col("n")) / F.sum("n")).alias("inherited"))
    found = found.select(*node, ((F.col("bad") + PAGES * F.col("inherited")) / (F.col("labelled") + PAGES)).alias("purity"))
    return ended.select(key, "raw", "prefix").join(found, node).select(key, "raw", F.col("prefix").alias("template"), "purity")


def judge_urls(pages: DataFrame, rules=RULES, labels: DataFrame | None = None) -> DataFrame:
    """Judge the url of every row of ``pages`` (page_id, url).

    ``labels``: page_id, bad (0 or 1; several for a page: the largest); without
    it the pages that a rule judges are the labelled ones. Templates are first
    found over all hosts of a domain, whose purities are what a host's own tree
    starts from (1/2 where a domain has one host). Returns page_id, host, path,
    rule, verdict, template and purity. A null url or one without ``://`` has an
    empty host and path and is judged as such; a template of which nothing is
    known has purity 1/2 and is allowed. Repeated rows are judged alike; other
    columns are ignored; an empty table gives no rows.
    """
    host, path = parsed("url")
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("hit", rule_of("host", "path", rules))
    rows = rows.withColumns({"raw": raw_template("path"), "domain": domain_of("host")})
    if labels is None:
        rows = rows.withColumn("bad", (F.col("hit.verdict") == "block").cast("int"))
    else:
        known = labels.groupBy("page_id").agg(F.max("bad").cast("int").alias("bad"))
        rows = rows.join(known, "page_id", "left")
    rows = written(rows, "urls")
    above = template_tree(rows.select("domain", "raw", "bad", F.lit(None).cast("double").alias("base")), "domain").select("domain", "raw", F.col("purity").alias("base"))
    many = rows.select("domain", "host").distinct().groupBy("domain").count().filter("count > 1").select("domain")
    above = written(above.join(many, "domain", "left_semi"), "above")
    tree = written(template_tree(rows.join(above, ["domain", "raw"], "left")), "tree")
    verdict = F.coalesce("hit.verdict", F.when(F.col("purity") >= PURITY, "block").otherwise("allow"))
    return rows.join(tree, ["host", "raw"]).select("page_id", "host", "path", F.col("hit.rule").alias("rule"), verdict.alias("verdict"), "template", "purity")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"))
