"""URL filters: allow and block rules on hosts with all subdomains and path prefixes, by a sort-merge range join (native).

The labels of a host in reverse order, then the path, are its canonical key; a rule is the interval of the keys that
begin with it, and intervals of rules nest or are apart. A rule reaches the subdomains of its host at the same path, so
a URL is looked up once for each suffix of its host at which a rule may stand (as many labels as the longest rule has).
Rules and URLs are dealt by range of their keys, sorted, and swept in order: a rule that begins brings the stack of the
rules that enclose it, and a URL takes the stack last brought, whose innermost member that still holds the URL is the
longest that fits. A range that begins between two rules takes the stack that the ranges before it have left, one for
each range. Of all suffixes the rule with the longest host and path together wins.

Equal URLs (by host and path) are judged once and the keys of a host that a third of all URLs share are dealt by path
and host. A null URL or one without ``://`` has an empty host and path, which no rule with a host fits. The host is taken
as it stands, with user, port and empty labels. Rules of the same host and path count once, where one of them blocks, as a
block; a rule with a null verdict is left out, a null host or path is empty. Of two rules of equal length that fit, the
longer host wins. Without rules the default holds for all; an empty table gives an empty table. A very long URL costs
time by its length for each suffix looked up. Rows that repeat all come back, and so do all columns; those named like the
four made ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, materialize, partitions

MADE = ("host", "path", "rule", "verdict")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def rules_of(spark: SparkSession, listed: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) as a table of rules."""
    return spark.createDataFrame(listed, "host string, path string, verdict string")


def stacked(rules: DataFrame) -> DataFrame:
    """Each rule with its ``stack``: itself and the rules of its host whose path its own begins with, the outermost first."""
    host, path = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER), F.coalesce("path", F.lit(""))
    own = materialize(rules.where(F.col("verdict").isNotNull()).groupBy(reversed_host(host).alias("key"), path.alias("path")).agg(F.max("verdict").alias("verdict"), F.first(host).alias("host")))
    begins = own.select("key", "path", F.explode(F.sequence(F.lit(0), F.char_length("path"))).alias("n")).select("key", F.col("path").alias("inner"), F.substr("path", F.lit(1), F.col("n")).alias("path"))
    chain = begins.join(own, ["key", "path"]).groupBy("key", "inner").agg(F.sort_array(F.collect_list(F.struct(F.char_length("path").alias("n"), "path", "host", "verdict"))).alias("stack"))
    return chain.select("key", F.col("inner").alias("path"), "stack")


def _looked_up(urls: DataFrame, labels: int) -> DataFrame:
    """Each host and path under the reversed suffixes of the host, of ``labels`` labels at most."""
    parts = F.reverse(F.split("host", r"\.", -1))
    few = F.slice(parts, 1, labels + 1)
    keys = F.transform(F.sequence(F.lit(1), F.least(F.size(few), F.lit(labels))), lambda n: F.array_join(F.slice(few, F.lit(1), n), "."))
    return urls.select("host", "path", F.explode(keys).alias("key"))


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``rule``, ``verdict`` of each distinct host and path that a rule fits."""
    spark = urls.sparkSession
    n, own = partitions(spark), materialize(stacked(rules))
    labels = own.agg(F.max(F.size(F.split("key", r"\.", -1)))).first()[0] or 1
    events = own.select("key", "path", F.lit("").alias("host"), F.lit(False).alias("is_url"), "stack").unionByName(_looked_up(urls.select("host", "path").distinct(), labels).withColumn("is_url", F.lit(True)), allowMissingColumns=True)
    # written, so that the ranges stay as they are
    dealt = materialize(events.repartitionByRange(n, "key", "path", "is_url", "host").sortWithinPartitions("key", "path", "is_url").withColumn("part", F.spark_partition_id()))
    begun = F.when(~F.col("is_url"), F.struct("key", "stack"))
    left = dealt.groupBy("part").agg(F.max_by(begun, F.when(~F.col("is_url"), F.struct("key", "path"))).alias("left"))  # one row a range
    carried = left.select("part", F.last("left", ignorenulls=True).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    sweep = Window.partitionBy("part").orderBy("key", "path", "is_url").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = dealt.join(F.broadcast(carried), "part").withColumn("top", F.coalesce(F.last(begun, ignorenulls=True).over(sweep), F.col("carried"))).where("is_url")
    fits = F.filter("top.stack", lambda r: F.startswith(F.col("path"), r["path"]))
    inner = F.when(F.col("top.key") == F.col("key"), F.element_at(F.when(F.size(fits) > 0, fits), -1))
    met = swept.select("host", "path", inner.alias("r")).where(F.col("r").isNotNull())
    best = met.groupBy("host", "path").agg(F.max(F.struct((F.char_length("r.host") + F.col("r.n")).alias("size"), F.char_length("r.host").alias("host_size"), "r")).alias("best"))
    return best.select("host", "path", F.concat("best.r.host", "best.r.path").alias("rule"), F.col("best.r.verdict").alias("verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the rule that won, else null) and ``verdict``. Rows meet
    their verdicts by host and path: pass narrow rows where there is a key to join wide ones by."""
    host, path = host_and_path(pages[url_col])
    rows = pages.select(F.struct(*[pages[f"`{c}`"] for c in pages.columns]).alias("row"), host.alias("host"), path.alias("path"))
    both = rows.join(judge(rows, rules), ["host", "path"], "left")
    kept = [F.col("row")[c].alias(c) for c in pages.columns if c not in MADE]
    return both.select(*kept, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
