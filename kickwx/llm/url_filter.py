"""URL rules: host-suffix and path-prefix expressions, joined on short hash prefixes."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kickwx.llm.scratch import written

HASH_PREFIX = 8  # hex digits: 32 bits


def ascii_lower(x: Column) -> Column:
    return F.translate(x, string.ascii_uppercase, string.ascii_lowercase)


def with_host_path(df: DataFrame, url_col: str) -> DataFrame:
    """Add ``host`` and ``path``; both empty for a null url or one without ``://``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return df.withColumns({"host": ascii_lower(host), "path": path})


def url_filter(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default_verdict: str = "allow",
) -> DataFrame:
    """One row per page: ``<id_col>, host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict`` (``allow`` or ``block``). A rule fits a url whose host is the
    rule's or a subdomain of it and whose path starts with the rule's. Each distinct url is expanded into
    host suffix + path prefix expressions, of the label counts and path lengths that occur among the
    rules only (a rule can fit no other). Expressions meet rules in an equi-join on the first
    32 bits of SHA-256; the full digest is then compared. Of the rules that fit, the longest string wins,
    then block over allow, then the greater string; without one the verdict is ``default_verdict``.

    The driver reads the distinct (label count, path length) pairs of the rules: at most 127 labels
    times the longest rule path, whatever the number of rules. The rule table is broadcast only if the
    planner's size estimate allows; else the join shuffles, and hot expressions are split by the skew join. The
    winners of the distinct urls are written and joined back to the pages, where a hot url's rows can be split.

    Defined cases: a null url, or one without ``://``, has empty host and path and fits no rule; page ids
    may be null or repeated (each row is judged); empty input gives no rows; rules with a null or
    empty host are ignored; a null rule path counts as empty.
    """
    rule_rows = (
        rules.select(
            ascii_lower(F.col("host")).alias("rule_host"),
            F.coalesce("path", F.lit("")).alias("rule_path"),
            F.col("verdict").alias("rule_verdict"),
        )
        .filter("rule_host <> ''")
        .withColumn("rule", F.concat("rule_host", "rule_path"))
    )
    shapes = (
        rule_rows.select(F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("chars"))
        .distinct().collect()
    )
    # max over 'allow' < 'block': of one string with both verdicts, block holds
    rule_rows = rule_rows.groupBy("rule").agg(F.max("rule_verdict").alias("rule_verdict")).select(
        "rule", "rule_verdict", F.sha2("rule", 256).alias("rule_digest")
    ).withColumn("hash", F.substring("rule_digest", 1, HASH_PREFIX))

    judged = with_host_path(pages.select(F.col(id_col), F.col(url_col).alias("__url")), "__url")
    urls = judged.filter("host <> ''").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    fitting = F.filter(
        F.array(*[F.struct(F.lit(r.labels).alias("labels"), F.lit(r.chars).alias("chars")) for r in sorted(shapes)])
        if shapes else F.expr("array(named_struct('labels', 0, 'chars', 0))"),
        lambda s: (s["labels"] > 0) & (s["labels"] <= F.size(labels)) & (s["chars"] <= F.length("path")),
    )
    expressions = (
        urls.withColumn("shape", F.explode(fitting))
        .withColumn(
            "expression",
            F.concat(
                F.array_join(F.slice(labels, F.size(labels) - F.col("shape.labels") + 1, F.col("shape.labels")), "."),
                F.substring("path", F.lit(1), F.col("shape.chars")),
            ),
        )
        .withColumn("digest", F.sha2("expression", 256))
        .select("host", "path", "digest", F.substring("digest", 1, HASH_PREFIX).alias("hash"))
    )
    winners = written(
        expressions.join(rule_rows, "hash")
        .filter("digest = rule_digest")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("chars"), "rule_verdict", "rule")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("verdict")),
        "url-winners",
    )
    return judged.join(winners, ["host", "path"], "left").select(
        id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default_verdict)).alias("verdict")
    )
