"""URL filters: expand a URL into host-suffix x path-prefix expressions and look them up by hash prefix.

Null handling: a null URL, or one without ``://``, has empty host and path, fits no rule and gets the default verdict.
Rules with a null or empty host or a null path are ignored. Repeated input rows each keep their own verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULE_SCHEMA = "rule string, rule_host string, rule_path string, action string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BROADCAST_RULES = 1_000_000
PREFIX_HEX = 8


def rules_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``rules``: (``host/path...``, ``block`` or ``allow``) pairs; the host part ends at the first slash."""
    rows = []
    for text, action in rules:
        host, slash, path = text.partition("/")
        if not host or not slash or action not in ("block", "allow"):
            raise ValueError(f"not a rule: {text!r} {action!r}")
        rows.append((text, host.translate(str.maketrans(UPPER, LOWER)), slash + path, action))
    return spark.createDataFrame(rows, RULE_SCHEMA)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host is ASCII-lower-cased; both empty without ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: DataFrame, keep: list[str], url: str = "url", default: str = "allow") -> DataFrame:
    """Columns ``keep`` of every row of ``pages``, then ``host, path, rule, verdict``.

    Expressions are the host's suffixes times the path's prefixes, of those numbers of labels and lengths that occur among
    the rules, so a host of many labels costs no more; each is hashed (SHA-256), joined to the rules on the first hex digits, and confirmed on the full digest.
    The longest confirmed rule wins; at equal length the longer host, then ``block``, then the smaller text.
    The rules are broadcast only while they number at most MAX_BROADCAST_RULES; beyond that the join shuffles both
    sides by hash prefix. The only other exchange gathers a row's few confirmed rules, pre-aggregated, by row.
    """
    digest = lambda h, p: F.sha2(F.concat(h, F.lit("\t"), p), 256)
    rules = rules.where("rule_host is not null and rule_host <> '' and rule_path is not null")
    found = rules.agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.length("rule_path"))).alias("lens"), F.array_sort(F.collect_set(F.size(F.split("rule_host", r"\.")))).alias("labels")).first()
    ranked = F.struct(
        (-F.length("rule_host") - F.length("rule_path")).alias("a"), (-F.length("rule_host")).alias("b"),
        F.when(F.col("action") == "block", 0).otherwise(1).alias("c"), F.col("rule").alias("rule"), F.col("action").alias("action"),
    )
    table = rules.select(digest(F.col("rule_host"), F.col("rule_path")).alias("_full"), ranked.alias("_rank")).withColumn("_key", F.substring("_full", 1, PREFIX_HEX))
    if found["n"] <= MAX_BROADCAST_RULES:
        table = F.broadcast(table)
    host, path = split_url(F.col(url))
    kept = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    rows = pages.select(F.monotonically_increasing_id().alias("_row"), *kept, host.alias("_host"), path.alias("_path"))
    labels = F.split("_host", r"\.")
    depths = F.filter(F.array(*[F.lit(int(n)) for n in found["labels"]]).cast("array<int>"), lambda n: n <= F.size(labels))
    suffixes = F.transform(depths, lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    lens = F.array(*[F.lit(int(n)) for n in found["lens"]]).cast("array<int>")
    prefixes = F.transform(F.filter(lens, lambda n: n <= F.length("_path")), lambda n: F.col("_path").substr(F.lit(1), n))
    same = ["_row", *[f"_k{i}" for i in range(len(keep))], "_host", "_path"]
    spread = rows.select(*same, F.explode_outer(suffixes).alias("_h")).select(*same, "_h", F.explode_outer(prefixes).alias("_p"))
    keyed = spread.withColumn("_url_full", digest(F.col("_h"), F.col("_p"))).withColumn("_key", F.substring("_url_full", 1, PREFIX_HEX))
    best = keyed.join(table, "_key", "left").groupBy(*same).agg(F.min(F.when(F.col("_url_full") == F.col("_full"), F.col("_rank"))).alias("_best"))
    return best.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_best.rule").alias("rule"), F.coalesce("_best.action", F.lit(default)).alias("verdict"),
    )
