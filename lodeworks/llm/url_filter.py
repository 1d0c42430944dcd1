"""URL filters by path-template trees: per host, variable path segments become wildcards, statistically similar branches
are merged, and templates are rejected by smoothed labelled purity. Rules come first.

Pages are aggregated to (host, typed path) at once, map-side; the tree's steps work on those templates only, and pages
meet their template again in one join, whose page side Spark may split where a host is hot. Each tree node's children
are compared with the sum over all of them, never with each other.

Steps, for the segments of a path: (1) typed: runs of digits become #, long hexadecimal ones {hex}, UUIDs {uuid}, very
long ones {long}; from the DEPTH-th segment on a path is one segment. Then level by level from the root, each on the
templates as the levels above left them: (2) a node with more than CHILDREN children none of which has MAJORITY of its
pages is variable: its children become *; (3) children of a node whose pages are spread over the same remainders (cosine
with the node's at least SIMILAR) and whose share of bad labels does not differ from the node's (two-proportion |z| < Z)
become *. (4) A template is rejected if (bad + STRENGTH * prior) / (labelled + STRENGTH) >= REJECT, the prior being its
host's share, smoothed by that of all pages likewise.

Defined cases: a null url, or one without ://, has an empty host and path and the verdict of that empty template (no
rule fits); null labels count as none; repeated pages count as often as they occur; empty tables give empty results;
a path's empty segments are kept; extra columns pass by unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, table

#: Rules of the registered query: verdict and host/path prefix.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
CHILDREN, MAJORITY, SIMILAR, Z = 32, 0.5, 0.9, 1.96
#: Segments that are levels of the tree; the last one holds the rest of the path.
DEPTH = 12
STRENGTH, REJECT = 10.0, 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty without ://."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. Equally long ones: the first of the list."""
    rule = verdict = None
    for kind, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        at, slash, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule if rule is not None else F.lit(None).cast("string"))
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict if verdict is not None else F.lit(None).cast("string"))
    none = F.lit(None).cast("string")
    return (rule, verdict) if rules else (none, none)


def typed(path: Column) -> Column:
    """The path's segments with obvious variables generalised."""

    def kind(s: Column) -> Column:
        return (
            F.when(s.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"), F.lit("{uuid}"))
            .when(s.rlike("^(?=.*[0-9])[0-9a-fA-F]{12,}$") & ~s.rlike("^[0-9]+$"), F.lit("{hex}"))
            .when(F.char_length(s) > 64, F.lit("{long}"))
            .otherwise(F.regexp_replace(s, "[0-9]+", "#"))
        )

    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/", DEPTH), kind)


def _level(templates: DataFrame, at: int) -> DataFrame:
    """The templates that reach a level, with what stands before, there and after."""
    here = templates.where(F.size("shape") > at)
    return here.select("*", F.slice("shape", 1, at).alias("before"), F.get("shape", F.lit(at)).alias("here"), F.expr(f"slice(shape, {at + 2}, size(shape))").alias("after"))


def _starred(origins: DataFrame, nodes: DataFrame, at: int) -> DataFrame:
    """Templates in which the level's segment is * below the nodes (host, before and perhaps here)."""
    on = [c for c in ("host", "before", "here") if c in nodes.columns]
    marks = nodes.select(*on, F.lit(True).alias("_star"))
    out = _level(origins, at).join(marks, on, "left")
    shape = F.when(F.col("_star"), F.concat("before", F.array(F.lit("*")), "after")).otherwise(F.col("shape"))
    return out.select("host", shape.alias("shape"), "origin", "n", "labelled", "bad").union(origins.where(F.size("shape") <= at))


def _summed(origins: DataFrame) -> DataFrame:
    return origins.groupBy("host", "shape").agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "bad")))


def _variable(level: DataFrame) -> DataFrame:
    """(2) Nodes (host, before) with many children and no dominant one."""
    children = level.groupBy("host", "before", "here").agg(F.sum("n").alias("n"))
    spread = children.groupBy("host", "before").agg(F.count("*").alias("k"), (F.max("n") / F.sum("n")).alias("top"))
    return spread.where((F.col("k") > CHILDREN) & (F.col("top") < MAJORITY)).select("host", "before")


def _similar(level: DataFrame) -> DataFrame:
    """(3) Children (host, before, here) that are like the sum over all children of their node."""
    level = level.where("here != '*'")
    own = level.groupBy("host", "before", "here", "after").agg(F.sum("n").alias("c"))
    node = level.groupBy("host", "before", "after").agg(F.sum("n").alias("p"))
    square = node.groupBy("host", "before").agg(F.sum(F.col("p").cast("double") * F.col("p")).alias("pp"))
    products = own.join(node, ["host", "before", "after"]).groupBy("host", "before", "here")
    cosine = products.agg(F.sum(F.col("c").cast("double") * F.col("p")).alias("cp"), F.sum(F.col("c").cast("double") * F.col("c")).alias("cc")).join(square, ["host", "before"])
    rates = level.groupBy("host", "before", "here").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
    sums = rates.groupBy("host", "before").agg(F.sum("l").alias("sl"), F.sum("b").alias("sb"), F.count("*").alias("k"))
    p1, p0 = F.col("b") / F.col("l"), (F.col("sb") - F.col("b")) / (F.col("sl") - F.col("l"))
    pool = F.col("sb") / F.col("sl")
    error = F.sqrt(pool * (1 - pool) * (1 / F.col("l") + 1 / (F.col("sl") - F.col("l"))))
    told = (F.col("l") > 0) & (F.col("sl") > F.col("l")) & (pool > 0) & (pool < 1)
    alike = rates.join(sums, ["host", "before"]).where("k > 1").where(F.when(told, F.abs(p1 - p0) / error).otherwise(F.lit(0.0)) < Z)
    alike = alike.join(cosine, ["host", "before", "here"]).where(F.col("cp") / F.sqrt(F.col("cc") * F.col("pp")) >= SIMILAR)
    return alike.select("host", "before", "here")


def templates(pages: DataFrame) -> DataFrame:
    """From (host, shape, y) rows: (host, origin, template, purity, reject) for every distinct typed path `origin`."""
    counted = pages.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("y").alias("labelled"), F.coalesce(F.sum("y"), F.lit(0)).alias("bad"))
    origins = table(counted.select("host", "shape", F.col("shape").alias("origin"), "n", "labelled", "bad"), "paths")
    for at in range(origins.agg(F.coalesce(F.max(F.size("shape")), F.lit(0))).first()[0]):  # at most DEPTH
        origins = table(_starred(origins, _variable(_level(_summed(origins), at)), at), "paths")
        origins = table(_starred(origins, _similar(_level(_summed(origins), at)), at), "paths")
    # (4) purity
    final = _summed(origins)
    every = final.agg(F.sum("bad").alias("ab"), F.sum("labelled").alias("al"))
    hosts = final.groupBy("host").agg(F.sum("bad").alias("hb"), F.sum("labelled").alias("hl")).crossJoin(F.broadcast(every))  # `every` is one row
    share = F.coalesce(F.when(F.col("al") > 0, F.col("ab") / F.col("al")), F.lit(0.0))
    hosts = hosts.select("host", ((F.col("hb") + STRENGTH * share) / (F.col("hl") + STRENGTH)).alias("prior"))
    judged = final.join(hosts, "host").withColumn("purity", 1 - (F.col("bad") + STRENGTH * F.col("prior")) / (F.col("labelled") + STRENGTH))
    judged = judged.select("host", "shape", "purity", (1 - F.col("purity") >= REJECT).alias("reject"))
    return origins.join(judged, ["host", "shape"]).select("host", "origin", F.concat(F.lit("/"), F.array_join("shape", "/")).alias("template"), "purity", "reject")


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", label_col: str = "y") -> DataFrame:
    """Per row: id, host, path, rule, template, purity, verdict. `label_col`: 1 bad, 0 good, null unknown."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(label_col).cast("long").alias("y"))
    rows = rows.withColumn("shape", typed(F.col("path")))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    known = templates(rows).withColumnsRenamed({"host": "_host", "origin": "_origin"})
    out = rows.join(known, (F.col("host") == F.col("_host")) & (F.col("shape") == F.col("_origin")), "left")
    own = F.when(F.col("reject"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("id", "host", "path", rule.alias("rule"), "template", "purity", F.coalesce(verdict, own).alias("verdict"))


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    """Labels: a page is bad if the document that its url numbers is labelled toxic or of no quality."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("doc_id is not null").groupBy("doc_id").agg(F.max(((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")).alias("y"))
    _, path = host_and_path(F.col("url"))
    number = F.expr("try_cast(_digits as bigint)")
    pages = pages.withColumn("_digits", F.regexp_extract(path, r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)).withColumn("_doc", number)
    pages = pages.join(labels, F.col("_doc") == F.col("doc_id"), "left").select("page_id", "url", "y")
    return judge(pages, RULES).withColumnRenamed("id", "page_id")
