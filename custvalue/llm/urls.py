"""URL rules by hashed host-suffix and path-prefix expressions, in SQL functions only.

A rule is a host with a path prefix; it fits that host and its subdomains where the path starts
with the prefix. Every URL is expanded into the expressions that some rule could have: its last
n host labels with its first m path characters, for the shapes (n, m) that occur among the
rules. Shapes are rows of a table that the expansion is joined with, so a plan does not grow with
them. Expressions and rules meet on a short prefix of their digests, the full digests confirm
the match, and the longest rule wins.

Defined cases: a null URL and one without ``://`` have an empty host and path and no rule; an
empty path starts no rule; equally long rules rank block before allow, then by text; repeated
rows, and rows that repeat or lack a page_id, are judged each by its URL; of a very long URL
the host and as much of the path as the longest rule has are expanded; no pages or no rules are
fine; columns of the pages beside page_id and url are ignored, whatever their names. Rules that
repeat an expression count as their strongest; those without a host or path are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custvalue.llm.common import settle

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Hexadecimal digits of the short digest that rules and expressions are joined on.
SHORT = 8


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Digest, shape and rank of rules with columns host, path and verdict."""
    text = F.concat("host", "path")
    return (
        rules.where("host is not null and path is not null and host <> ''")
        .select(
            F.translate("host", UPPER, UPPER.lower()).alias("host"), "path", "verdict"
        )
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("rule_verdict"))
        .select(
            text.alias("rule"),
            "rule_verdict",
            F.sha2(F.concat_ws("\n", "host", "path"), 256).alias("digest"),
            (F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1).alias("labels"),
            F.length("path").alias("path_length"),
        )
        .withColumn("short", F.substring("digest", 1, SHORT))
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page; ``default`` where no rule fits.

    Of the rules only the number of labels and path characters of the longest come to the driver.
    """
    rules = settle(prepare_rules(rules), "rules")
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    most = rules.agg(F.max("labels").alias("labels"), F.max("path_length").alias("path_length")).first()
    labels, longest = most["labels"] or 0, most["path_length"] or 0
    # A URL is judged by its host and the first characters of its path, so those are
    # expanded once, however often pages share them.
    urls = urls.withColumn("start", F.substring("path", 1, longest))
    dots = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit("")))
    some = urls.where(F.lit(bool(labels)) & (F.col("host") != "")).select("host", "start").distinct()
    lengths = rules.select("path_length").distinct().withColumnRenamed("path_length", "m")
    shapes = rules.select(F.col("labels").alias("n"), F.col("path_length").alias("m")).distinct()
    every = F.sequence(F.lit(1), F.least(dots + 1, F.lit(labels)))
    starts = some.withColumn("m", F.explode(F.sequence(F.lit(0), F.length("start")))).join(lengths, "m")
    expanded = starts.withColumn("n", F.explode(every)).join(shapes, ["n", "m"])
    expression = F.concat_ws("\n", F.call_function("substring_index", F.col("host"), F.lit("."), -F.col("n")), F.substring("start", F.lit(1), F.col("m")))
    # Written, so that the join below can split a host with very many pages.
    found = settle(
        expanded.select("host", "start", F.sha2(expression, 256).alias("own"))
        .withColumn("short", F.substring("own", 1, SHORT))
        .join(rules, "short")
        .where("own = digest")
        .groupBy("host", "start")
        .agg(F.max(F.struct(F.length("rule"), "rule_verdict", "rule")).alias("best"))
        .select("host", "start", "best.rule", "best.rule_verdict"),
        "url-rules",
    )
    return urls.join(found, ["host", "start"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", F.lit(default)).alias("verdict"),
    )
