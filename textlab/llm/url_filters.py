"""URL rules by a sort-merge range join over reversed-host keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each with a dot: a domain's key is a prefix of its subdomains' keys."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def active_stacks(rules: DataFrame) -> DataFrame:
    """``key, stack``: the rules that hold from ``key`` up to the next row's key.

    A host's subtree is the key interval from ``com.example.`` to ``com.example/`` (the character after the
    dot). Intervals nest, so at its start a host's own rules go on top of those of the hosts around it, and
    at its end they come off. The hosts around one are its label suffixes: an equality join finds them.
    """
    clean = rules.select(
        F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"), "action",
    ).groupBy("host", "path").agg(F.min("action").alias("action"))
    own = clean.select("host", F.struct(
        (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
        "path", F.concat("host", "path").alias("rule"), "action",
    ).alias("entry"))
    labels = F.split("host", r"\.", -1)
    around = own.select("host").distinct().select(
        F.col("host").alias("inner"),
        F.explode(F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        )).alias("host"),
    )
    nested = around.join(own, "host").groupBy("inner").agg(
        F.sort_array(F.collect_list("entry")).alias("inside"),
        F.sort_array(F.collect_list(F.when(F.col("host") != F.col("inner"), F.col("entry")))).alias("outside"),
    )
    key = host_key(F.col("inner"))
    ends = F.concat(F.expr("left(key, length(key) - 1)"), F.lit("/"))
    bounds = nested.withColumn("key", key)
    return bounds.select("key", F.col("inside").alias("stack")).unionByName(
        bounds.select(ends.alias("key"), F.col("outside").alias("stack"))
    )


def judge_urls(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", salts: int | None = None) -> DataFrame:
    """Every row of ``urls`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``action``. A rule fits its host and all subdomains of it if the path
    starts with the rule's. The longest fitting rule wins, counted over host and path, then over the host;
    of equal rules the smaller action holds. Rows that no rule fits get a null rule and ``default``.

    Rows are dealt by a hash of the whole row, so a hot host is spread, and each of the ``salts`` shares is
    sorted together with its own copy of the rule bounds: the sweep keeps the last stack it has seen.
    The copies cost rules x salts rows. Null urls have an empty host and path; repeated rows are judged each;
    other columns stay, and any named like a result column is replaced. No rules: all rows get the default.
    """
    shares = salts or 4 * int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    data = urls.drop("host", "path", "rule", "verdict")
    kept = F.struct(*[F.col(f"`{c}`") for c in data.columns])
    target = F.col(f"`{url}`").cast("string")
    events = data.select(
        F.pmod(F.xxhash64(kept.cast("string")), F.lit(shares)).alias("share"), kept.alias("row"),
        url_host(target).alias("host"), url_path(target).alias("path"),
    ).withColumn("key", host_key(F.col("host")))
    bounds = active_stacks(rules).select(
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1)).cast("array<bigint>")).alias("share"), "key", "stack"
    )
    sweep = Window.partitionBy("share").orderBy("key", F.col("stack").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    swept = bounds.unionByName(events, allowMissingColumns=True).withColumn("active", F.last("stack", ignorenulls=True).over(sweep))
    fitting = F.filter("active", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(fitting)
    return swept.where(F.col("row").isNotNull()).withColumn("best", best).select(
        "row.*", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
