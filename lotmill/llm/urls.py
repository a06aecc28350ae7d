"""URL rules by a sort-merge range join, in DataFrame functions only.

A prefix of a key is an interval of the sorted keys. Rules are intervals, urls
points; both are sorted together, and a sweep keeps the stack of the rules that are
open. An opening event carries the stack with its rule on top, a closing event the
stack below it, so the stack at a point is that of the last event before it. The sorted
list is cut into ranges, each swept by itself: what is open at its first row is looked up
among the rules, so every rule has its two events once, however many ranges there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotmill.llm.common import materialize

# The rules of the registered query: host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT_VERDICT = "allow"
STANDS, OPENS, POINT, CLOSES = -1, 0, 1, 2


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null or without ``://``."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    rest = F.when(F.contains(url, F.lit("://")), rest).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit("")), F.coalesce(path, F.lit(""))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def reversed_host(host: Column) -> Column:
    """``www.example.com`` as ``com.example.www.``: subdomains follow their domain."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def stacks(keys: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(space, key, stack): the rule prefixes that begin each distinct key, the longest last; keys without one are left out.

    Each key meets its own beginnings by equality, none longer than the longest rule, so the work grows with the
    length of the keys and not with their number times that of the rules.
    """
    longest = prefixes.agg(F.max(F.length("prefix"))).first()[0] or 0
    begun = keys.select("space", "key").distinct().withColumn(
        "_outer",
        F.explode(F.transform(F.sequence(F.lit(0), F.least(F.length("key"), F.lit(longest))), lambda n: F.substring("key", F.lit(1), n))),
    )
    outer = prefixes.select(F.col("space").alias("_space"), F.col("prefix").alias("_found")).distinct()
    return (
        begun.join(outer, (F.col("space") == F.col("_space")) & (F.col("_outer") == F.col("_found")))
        .groupBy("space", "key")
        .agg(F.array_sort(F.collect_list(F.struct(F.length("_found").alias("n"), F.col("_found").alias("p")))).alias("_stack"))
        .select("space", "key", F.transform("_stack", lambda s: s["p"]).alias("stack"))
    )


def rule_events(prefixes: DataFrame) -> DataFrame:
    """(space, at, kind, stack): where each rule opens and closes, and the stack from there on."""
    nested = stacks(prefixes.withColumnRenamed("prefix", "key"), prefixes)
    below = F.slice("stack", 1, F.greatest(F.size("stack") - 1, F.lit(0)))
    opens = F.struct(F.col("key").cast("binary").alias("at"), F.lit(OPENS).alias("kind"), F.col("stack"))
    # 0xFF is no byte of UTF-8, so this stands behind every key with the prefix.
    closes = F.struct(F.concat(F.col("key").cast("binary"), F.unhex(F.lit("FF"))).alias("at"), F.lit(CLOSES).alias("kind"), below.alias("stack"))
    return nested.select("space", F.explode(F.array(opens, closes)).alias("e")).select("space", "e.*")


def sweep(points: DataFrame, prefixes: DataFrame, parts: int, label: str) -> DataFrame:
    """``points`` (space, key, page_row, ...) with ``stack``: the rule prefixes of the same space that begin the key.

    Points and events are dealt to ``parts`` ranges of one order that ends with the page row, so that a space or
    a key with a third of all points fills no single range. The ranges are written, as their bounds
    are drawn anew whenever they are dealt. A range that begins with a point is given the stack that stands there.
    """
    carried = [F.col(c) for c in points.columns if c not in ("space", "key")]
    rows = points.select(
        "space",
        F.col("key").cast("binary").alias("at"),
        F.lit(POINT).alias("kind"),
        F.lit(0).alias("depth"),
        F.struct(F.col("key"), *carried).alias("row"),
    )
    # Where two rules close at one place, the outer one closes last.
    events = rule_events(prefixes).withColumn("depth", F.when(F.col("kind") == CLOSES, -F.size("stack")).otherwise(F.size("stack")))
    order = ["space", "at", "kind", "depth", F.col("row.page_row")]
    dealt = rows.unionByName(events, allowMissingColumns=True).repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt, label)
    first = F.min(F.struct("space", "at", "kind")).alias("e")
    edges = dealt.groupBy("_part").agg(first).filter(F.col("e.kind") == POINT).select("_part", "e.space", F.col("e.at").cast("string").alias("key"))
    # One row a range, so it goes to every executor.
    standing = stacks(edges, prefixes).join(F.broadcast(edges.select("_part", F.col("space").alias("_s"), F.col("key").alias("_k"))), (F.col("space") == F.col("_s")) & (F.col("key") == F.col("_k")))
    standing = standing.select("_part", "space", "stack", F.unhex(F.lit("")).alias("at"), F.lit(STANDS).alias("kind"), F.lit(0).alias("depth"))
    sorted_list = Window.partitionBy("_part", "space").orderBy("at", "kind", "depth")
    open_now = F.last("stack", ignorenulls=True).over(sorted_list.rowsBetween(Window.unboundedPreceding, 0))
    return (
        dealt.unionByName(standing, allowMissingColumns=True)
        .withColumn("_open", open_now)
        .filter(F.col("kind") == POINT)
        .select("space", "row.*", F.coalesce("_open", F.array().cast("array<string>")).alias("stack"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, parts: int | None = None, default: str = DEFAULT_VERDICT) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    ``rules`` is (host, path, verdict). A rule fits its host and all subdomains, if the url's path starts
    with the rule's; the longest text of host and path wins, of equal ones the longer host. Rules
    with a null or empty host or a null path take no part; of repeated rules with different verdicts block wins.
    A null url, or one without ``://``, has an empty host and path and gets ``default``, as does every url without a rule.

    Paths are swept first: the stack holds every rule path that begins the url's. For each
    of these, in a key space of its own, reversed hosts are swept; the top of that stack is the longest host.
    Both sweeps write their sorted ranges, without html, to the shared folder.
    """
    spark = pages.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = (
        rules.filter((F.col("host") != "") & F.col("path").isNotNull())
        .groupBy(F.translate("host", UPPER, UPPER.lower()).alias("rule_host"), F.col("path").alias("rule_path"))
        .agg(F.max("verdict").alias("rule_verdict"))
        .withColumn("rule_key", reversed_host(F.col("rule_host")))
    )
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("page_row"))
    by_path = sweep(
        urls.select(F.lit("").alias("space"), F.col("path").alias("key"), "page_id", "host", "page_row"),
        known.select(F.lit("").alias("space"), F.col("rule_path").alias("prefix")).distinct(),
        parts,
        "urls-paths",
    )
    # No rule path begins the url's: it goes on with one empty space, which has no rule.
    spaces = F.when(F.size("stack") > 0, F.col("stack")).otherwise(F.array(F.lit(None).cast("string")))
    hosts = by_path.select(
        F.explode(spaces).alias("space"), reversed_host(F.col("host")).alias("key"), "page_id", "host", F.col("key").alias("path"), "page_row"
    )
    by_host = sweep(hosts, known.select(F.col("rule_path").alias("space"), F.col("rule_key").alias("prefix")), parts, "urls-hosts")
    top = by_host.withColumn("_top", F.element_at(F.when(F.size("stack") > 0, F.col("stack")), -1))
    fits = F.when(
        F.col("_top").isNotNull(),
        F.struct((F.length("_top") + F.length("space")).alias("n"), F.length("_top").alias("h"), F.col("_top").alias("k"), F.col("space").alias("p")),
    )
    longest = top.groupBy("page_row").agg(
        F.any_value("page_id").alias("page_id"), F.any_value("host").alias("host"), F.any_value("path").alias("path"), F.max(fits).alias("_rule")
    )
    labelled = longest.join(
        known, (F.col("_rule.k") == F.col("rule_key")) & (F.col("_rule.p") == F.col("rule_path")), "left"
    )
    return labelled.select(
        "page_id",
        "host",
        "path",
        F.concat("rule_host", "rule_path").alias("rule"),
        F.coalesce("rule_verdict", F.lit(default)).alias("verdict"),
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")
