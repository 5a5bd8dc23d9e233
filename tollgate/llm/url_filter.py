"""URL allow and block rules by a sort-merge range join.

A host's canonical key is its labels in reverse, each ended by a separator
that sorts below every other character.  All subdomains of a rule's host then
form one interval of keys, and the intervals of nested hosts are nested.  The
rules' interval ends cut the key space into segments; within a segment the
stack of active rules is constant.  Pages and segment starts are
range-partitioned and sorted together, and one sweep hands each page the stack
of the last segment that starts at or before its key.

The sweep is split over the range partitions: the stack that a partition
inherits is the last one of the partitions before it.  Rows are sorted by
(key, path, id), so a hot host still spreads over many partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.staging import materialise

#: (action, host, path) of the fixed rule list.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
DEFAULT_VERDICT = "allow"
_STACK = "array<struct<size:int,rule:string,path:string,action:string>>"
_END, _NEXT = "\x01", "\x02"  # label end, and the first key after a host's interval


def host_of(url: F.Column) -> F.Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: F.Column) -> F.Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _clean(host: F.Column) -> F.Column:
    """Control characters that the key uses itself cannot be in a label."""
    return F.translate(host, "\x00" + _END + _NEXT, "\x03\x03\x03")


def reversed_key(host: F.Column) -> F.Column:
    labels = F.reverse(F.split(_clean(host), r"\."))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, _END), F.lit(_END)))


def _segments(rules: DataFrame) -> DataFrame:
    """Segment starts with the stack of rules active from there on, the
    longest rule first."""
    active = rules.groupBy("host").agg(F.collect_set(F.struct(
        (F.length("host") + F.length("path")).alias("size"), F.concat("host", "path").alias("rule"),
        "path", "action")).alias("own"))
    hosts = active.select(F.col("host").alias("inner"), F.split("host", r"\.").alias("labels"))
    # The host itself and every host above it, as suffixes of its labels.
    above = hosts.select("inner", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("labels")),
        lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))).alias("up", "host"))
    stacks = above.join(active, "host")

    stack = F.sort_array(F.flatten(F.collect_list("own")), asc=False).alias("stack")
    key = reversed_key(F.col("inner"))
    opened = stacks.groupBy("inner").agg(stack).select(key.alias("key"), "stack")
    # Where an interval ends only the hosts above it go on; they may be none.
    outer = hosts.join(stacks.filter("up > 0").groupBy("inner").agg(stack), "inner", "left")
    closed = outer.select(F.concat(F.substring(key, F.lit(1), F.length(key) - 1), F.lit(_NEXT)).alias("key"),
                          F.coalesce("stack", F.expr(f"cast(array() as {_STACK})")).alias("stack"))
    return opened.unionByName(closed)


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` has action, host and path.  A rule fits its host and every
    subdomain when the page's path starts with the rule's (a rule without a host
    fits none); the longest fitting
    rule (host and path together; of equal lengths the later in text order)
    decides, else ``default``.  Null urls and urls without ``://`` have an
    empty host and path and fit no rule.  Repeated pages give repeated rows;
    an empty table gives an empty result.
    """
    url = F.col(url_col)
    points = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"),
                          path_of(url).alias("path")).withColumn("key", reversed_key(F.col("host")))
    rules = rules.select("action", F.lower(_clean(F.col("host"))).alias("host"), "path").filter("host != ''").distinct()
    starts = _segments(rules).withColumn("start", F.lit(True))
    both = points.withColumn("start", F.lit(False)).unionByName(starts, allowMissingColumns=True)
    # Segment starts come before the pages with the same key.
    order = [F.col("key"), F.col("start").desc(), F.col("path"), F.col("page_id")]
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    swept = materialise(both.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "sweep")

    # One row per partition: the stack that its last segment start leaves.
    last = swept.filter("start").groupBy("part").agg(F.max_by("stack", "key").alias("stack"))
    parts = swept.select("part").distinct().join(last, "part", "left")
    carried = parts.select("part", F.last("stack", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))

    here = F.last("stack", ignorenulls=True).over(Window.partitionBy("part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    stacked = (swept.withColumn("here", here).filter(~F.col("start")).join(F.broadcast(carried), "part", "left")
               .withColumn("active", F.coalesce("here", "carried")))
    hit = F.get(F.filter("active", lambda r: F.startswith(F.col("path"), r["path"])), 0)
    return stacked.withColumn("hit", hit).select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.action"), F.lit(default)).alias("verdict"))


def fixed_rules(spark) -> DataFrame:
    return spark.createDataFrame(list(RULES), "action string, host string, path string")


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(action, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                   ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
j AS (
  SELECT p.*, r.rhost || r.rpath AS rule, action,
         row_number() OVER (PARTITION BY page_id ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST) AS k
  FROM p LEFT JOIN r ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM j WHERE k = 1
"""
