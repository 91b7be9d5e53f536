"""URL filters: which block or allow rule holds for an address, by joining on short hashes.

A rule is a host and a path prefix. It fits a URL whose host is the rule's host or a subdomain of it and
whose path starts with the rule's path; of the rules that fit, the longest (host and path together,
then the smaller text) wins. Each distinct URL is expanded into (host suffix, path prefix)
expressions. Only expressions as deep as some rule are made, so a URL of thousands of dots and
slashes costs no more than the rules' own depths. An equi-join on the first 32 bits of the expression's
digest finds candidates; the full digest, the rest of the path and the precedence confirm them.

Defined cases: a rule without a host is an error, as it would fit nothing; no pages give no rows; a null URL, or one without ``://``, has an empty host and path and meets no rule; no rule
at all gives the default verdict; repeated rows each get their own result; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.tables import text_of


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, in ASCII lower case."""
    return lower_ascii(F.regexp_extract(text_of(url), r"(?s)\A.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, to ``?``, ``#`` or the end."""
    return F.regexp_extract(text_of(url), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, "\\.", -1))


def _slashes(path: Column) -> Column:
    return F.size(F.split(path, "/", -1)) - 1


def _prefix(path: Column, slashes: Column) -> Column:
    """The path up to and with so many slashes."""
    return F.when(slashes == 0, "").otherwise(F.concat(F.call_function("substring_index", path, F.lit("/"), slashes), F.lit("/")))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with the expression each is found by: the host, and its path up to the
    last slash."""
    known = rules.select(
        lower_ascii(text_of("host")).alias("rule_host"), text_of("path").alias("rule_path"), F.col("action")
    ).filter("rule_host <> ''")
    # One action per host and path: a block wins over an allow of the same length.
    known = known.groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))
    head = F.substring_index(F.col("rule_path"), "/", -1)
    stem = F.substring(F.col("rule_path"), F.lit(1), F.length("rule_path") - F.length(head))
    full = _digest(F.col("rule_host"), F.col("stem"))
    return (
        known.withColumn("stem", stem)
        .withColumn("labels", _labels(F.col("rule_host")))
        .withColumn("slashes", _slashes(F.col("stem")))
        .withColumn("rule_digest", full)
        .withColumn("rule_prefix", F.substring(full, 1, 8))
    )


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", keep: tuple[str, ...] = ()) -> DataFrame:
    """For each row: ``keep`` columns, host, path, rule (host and path; null if none fits), verdict.

    ``rules`` has host, path and action (``allow`` or ``block``).
    """
    if rules.filter(text_of("host") == "").head(1):
        raise ValueError("a rule has no host")
    table = rule_table(rules)
    # Pairs of two small numbers: there are few, however many rules.
    depths = [tuple(r) for r in table.select("labels", "slashes").distinct().collect()]
    address = F.col("address")
    urls = (
        pages.select(F.col(url).alias("address")).filter(address.contains("://")).distinct()
        .withColumn("host", host_of(address)).withColumn("path", path_of(address))
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(m).alias("slashes")) for n, m in sorted(depths)])
    if not depths:
        pairs = pairs.cast("array<struct<labels:int,slashes:int>>")
    deep = urls.withColumn("depth", F.explode(pairs))
    expressions = (
        deep.filter((F.col("depth.labels") <= _labels(F.col("host"))) & (F.col("depth.slashes") <= _slashes(F.col("path"))))
        .withColumn("suffix", F.call_function("substring_index", F.col("host"), F.lit("."), -F.col("depth.labels")))
        .withColumn("stem", _prefix(F.col("path"), F.col("depth.slashes")))
        .withColumn("digest", _digest(F.col("suffix"), F.col("stem")))
        .withColumn("prefix", F.substring("digest", 1, 8))
    )
    found = expressions.select("address", "path", "prefix", "digest").join(
        table.select("rule_host", "rule_path", "action", "rule_prefix", "rule_digest"),
        F.col("prefix") == F.col("rule_prefix"),
    ).filter((F.col("digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path")))
    name = F.concat("rule_host", "rule_path")
    best = found.groupBy("address").agg(
        F.min_by(F.struct(name.alias("rule"), "action"), F.struct((-F.length(name)).alias("n"), name.alias("name"))).alias("best")
    ).select("address", "best.rule", "best.action")
    named = pages.select(*keep, F.col(url).alias("_url"))
    return (
        named.join(best, F.col("_url") == F.col("address"), "left")
        .select(*keep, host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"), "rule",
                F.coalesce("action", F.lit(default)).alias("verdict"))
    )
