"""URL filter: rules first, then a tree of path templates judged by labelled purity.

Pages that a rule decides are the labelled ones.  For the others, each host has a tree of
templates: the segments of the path, with numbers and hashes written as wildcards.  Going
down the tree, segment by segment, branches whose share of blocked labels is no different from
that of all their siblings, by a binomial test, are merged into one, ``~``; the others stay
what they are, however many there are.  A template's purity is its share of blocked labels,
smoothed towards that of the template above it, up to the host and to all labels; one of
LEAST_BLOCKED or more is rejected.  A template whose labels are all alike, or that has none,
needs no further segments and ends in ``*``; a segment that all paths of a template share is
passed without a test.  So there are as many rounds as labels differ along one path.

Pages are counted by template before anything is joined, so a host with a third of all
pages is a few rows; pages meet their template's verdict in one join.

Defined cases: NULL, or no ``://``, is an empty host and path, which no rule fits.  Repeated
rows count each and get the same verdict.  Without any label the verdict is ``allow``.
Empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import lower_ascii, stored

# (verdict, host, start of the path).
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)

# A branch is merged if it is less than this many standard deviations off.
DEVIATIONS = 2.0
# Labels that the level above counts for.
STRENGTH = 4.0
LEAST_BLOCKED = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(text, parts, 1)), F.regexp_extract(text, parts, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``, or NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, of_host, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(of_host + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def generalised(segment: Column) -> Column:
    """A path segment with numbers and hashes as wildcards, and never mistaken for one of the tree's own."""
    return (
        F.when(segment.rlike("^[~*]$"), F.concat(F.lit("="), segment))
        .when(segment.rlike("^[0-9]+$"), F.lit("{n}"))
        .when(segment.rlike(r"^[0-9]+\.[A-Za-z]+$"), F.regexp_replace(segment, "^[0-9]+", "{n}"))
        .when(segment.rlike("^[0-9a-f-]{8,}$"), F.lit("{h}"))
        .otherwise(segment)
    )


def _purity(blocked: Column, labels: Column, above: Column) -> Column:
    return (blocked + STRENGTH * above) / (labels + STRENGTH)


def _shared(low: Column, high: Column) -> Column:
    """How many first segments two paths share; all paths between them in order share these, too."""
    pairs = F.zip_with(low, high, lambda a, b: F.coalesce(a == b, F.lit(False)))
    first = F.array_position(pairs, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(pairs)).cast("int")


def _open(rows: DataFrame) -> DataFrame:
    """Rows of templates whose labels differ, and whose paths go on."""
    per = rows.groupBy("host", "template").agg(
        F.sum("labels").alias("n"), F.sum("blocked").alias("b"), F.min("rest").alias("low"), F.max("rest").alias("high")
    ).where((F.col("b") > 0) & (F.col("b") < F.col("n")) & (F.col("low") != F.col("high")))
    passed = _shared(F.col("low"), F.col("high"))
    return per.select(
        "host", "template", F.col("n").alias("all_n"), F.col("b").alias("all_b"), passed.alias("passed"),
        F.slice("low", F.lit(1), passed).alias("common"),
    )


def _split(rows: DataFrame, open_templates: DataFrame) -> DataFrame:
    """The rows of open templates one segment further: branches that differ stay, the others are merged."""
    at = rows.join(open_templates, ["host", "template"])
    # Paths that end here are a branch of their own.
    branch = F.coalesce(F.get("rest", F.col("passed")), F.lit(""))
    at = at.withColumn("branch", branch).withColumn(
        "rest", F.slice("rest", F.col("passed") + 2, F.greatest(F.lit(1), F.size("rest")))
    )
    branches = at.groupBy("host", "template", "branch").agg(
        F.sum("labels").alias("n"), F.sum("blocked").alias("b"), F.first("p").alias("above"),
        F.first("all_n").alias("all_n"), F.first("all_b").alias("all_b"), F.first("common").alias("common"),
    )
    share = _purity(F.col("all_b"), F.col("all_n"), F.col("above"))
    off = F.abs(F.col("b") - F.col("n") * F.col("share"))
    spread = F.sqrt(F.col("n") * F.col("share") * (1 - F.col("share")))
    alike = (F.col("n") == 0) | (off < DEVIATIONS * spread)
    kept = F.when(alike, "~").otherwise(F.col("branch"))
    judged = branches.withColumn("share", share).select(
        "host", "template", "branch", "n", "b", "above",
        F.concat_ws("/", F.when(F.col("template") != "", F.col("template")), "common", kept).alias("next"),
    )
    groups = judged.groupBy("host", "next").agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.first("above").alias("above"))
    purity = groups.select("host", "next", _purity(F.col("b"), F.col("n"), F.col("above")).alias("p"))
    named = judged.select("host", "template", "branch", "next").join(purity, ["host", "next"])
    return at.drop("p").join(named, ["host", "template", "branch"]).select(
        "host", "segments", "rest", "labels", "blocked", F.col("next").alias("template"), "p"
    )


def templates(counted: DataFrame) -> DataFrame:
    """Paths (``host, segments``) with ``labels`` and ``blocked``: their ``template`` and its purity ``p``."""
    rows = stored(counted, "paths")
    total = rows.agg(F.sum("labels").alias("n"), F.sum("blocked").alias("b")).first()
    overall = (total["b"] or 0) / total["n"] if total["n"] else 0.0
    of_hosts = rows.groupBy("host").agg(F.sum("labels").alias("n"), F.sum("blocked").alias("b")).select(
        "host", _purity(F.col("b"), F.col("n"), F.lit(overall)).alias("p")
    )
    rows = rows.join(of_hosts, "host").select(
        "host", "segments", F.col("segments").alias("rest"), "labels", "blocked", F.lit("").alias("template"), "p"
    )
    done = []
    while True:
        rows = stored(rows, "templates")
        going_on = stored(_open(rows), "open")
        done.append(rows.join(going_on.select("host", "template"), ["host", "template"], "left_anti"))
        if going_on.isEmpty():
            break
        rows = _split(rows, going_on)
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    ending = F.when(F.size("rest") > 0, F.lit("*"))
    name = F.concat_ws("/", F.when(F.col("template") != "", F.col("template")), ending)
    return whole.select("host", "segments", name.alias("template"), "p")


def filtered(pages: DataFrame, rules=RULES) -> DataFrame:
    """Per page: ``page_id, host, path, rule, verdict, template``."""
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "judged", rule_of(F.col("host"), F.col("path"), rules)
    )
    segments = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), generalised)
    shaped = judged.select("page_id", "host", "path", "judged", segments.alias("segments"))
    counted = shaped.groupBy("host", "segments").agg(
        F.count("judged.verdict").alias("labels"),
        F.count(F.when(F.col("judged.verdict") == "block", 1)).alias("blocked"),
    )
    known = templates(counted).select(
        "host", "segments", "template", F.when(F.col("p") >= LEAST_BLOCKED, "block").otherwise("allow").alias("by_template")
    )
    return shaped.join(known, ["host", "segments"], "left").select(
        "page_id", "host", "path", F.col("judged.rule").alias("rule"),
        F.coalesce("judged.verdict", "by_template").alias("verdict"), "template",
    )
