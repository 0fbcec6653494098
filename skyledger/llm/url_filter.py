"""URL rules by hashed host-suffix and path-prefix expressions.

Every URL is expanded into (suffix of its host, prefix of its path up to a slash); rules
are stored under the same expressions. Both meet on a short prefix of the expression's
digest; the full digest and the rule's whole path confirm, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the digest that URLs and rules meet on (four bytes).
SHORT = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) after the first ``://``, and the path before ``?`` or
    ``#``; both empty for null and for a URL without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def _parts(text: Column, mark: str) -> Column:
    return F.size(F.split(text, f"\\Q{mark}\\E"))


def _expressions(hosts: Column, paths: Column) -> Column:
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))


def _suffixes(host: Column, most: int) -> Column:
    """The whole host and what follows each dot, for at most ``most`` labels."""
    return F.transform(
        F.sequence(F.lit(1), F.least(_parts(host, "."), F.lit(most))),
        lambda k: F.call_function("substring_index", host, F.lit("."), -k),
    )


def _prefixes(path: Column, most: int) -> Column:
    """The empty path and the path up to each of its first ``most`` slashes."""
    slashes = F.least(_parts(path, "/") - 1, F.lit(most))
    ends = F.transform(
        F.filter(F.sequence(F.lit(0), slashes), lambda k: k > 0),
        lambda k: F.concat(F.call_function("substring_index", path, F.lit("/"), k), F.lit("/")),
    )
    return F.concat(F.array(F.lit("")), ends)


def judge_urls(
    urls: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    otherwise: str = "allow",
) -> DataFrame:
    """One row per row of ``urls``: id, host, path, rule, verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains where
    the path starts with the rule's; of several the longest (host and path together)
    wins, then the one with the longer host, then ``block``. Where none fits, ``rule`` is
    null and the verdict is ``otherwise``. Rules without a host are ignored, a null path
    is empty. Other columns of ``urls`` are ignored.

    Equal rows are counted and judged once, so a URL that a third of all rows hold is one
    row of the expansion. URLs are expanded only as deep as the deepest rule goes. The
    join is left to measured sizes: rules are broadcast if they are few, and otherwise
    large expressions are split by adaptive execution.
    """
    rules = rules.where("host is not null").select(
        F.translate(F.col("host").cast("string"), UPPER, LOWER).alias("rule_host"),
        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("rule_path"),
        F.col("verdict").cast("string").alias("rule_verdict"),
    )
    deepest = rules.agg(
        F.max(_parts(F.col("rule_host"), ".")).alias("labels"),
        F.max(_parts(F.col("rule_path"), "/")).alias("slashes"),
    ).first()
    # a rule is stored under its path up to the last slash; the rest is compared below
    head = F.regexp_extract("rule_path", "^(?:[\\s\\S]*/)?", 0)
    stored = rules.withColumn("rule_digest", F.sha2(F.concat("rule_host", head), 256)).withColumn(
        "short", F.substring("rule_digest", 1, SHORT)
    )
    host, path = host_and_path(F.col(url_column).cast("string"))
    rows = (
        urls.select(F.col(id_column), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
        .groupBy(id_column, "host", "path")
        .agg(F.count("*").cast("int").alias("copies"))
    )
    hosts = _suffixes(F.col("host"), deepest["labels"] or 1)
    paths = _prefixes(F.col("path"), deepest["slashes"] or 1)
    expanded = rows.withColumn("digest", F.explode(F.transform(_expressions(hosts, paths), lambda e: F.sha2(e, 256))))
    fits = (F.col("digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path"))
    met = expanded.withColumn("short", F.substring("digest", 1, SHORT)).join(stored, "short", "left")
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        (F.col("rule_verdict") == "block").alias("blocks"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    best = met.groupBy(id_column, "host", "path", "copies").agg(F.max(F.when(fits, rank)).alias("best"))
    return best.select(
        id_column,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
        "copies",
        F.explode(F.sequence(F.lit(0), F.expr("(copies - 1) div 4096"))).alias("block"),
    ).select(
        id_column,
        "host",
        "path",
        "rule",
        "verdict",
        F.explode(F.sequence(F.lit(1), F.expr("least(4096, copies - block * 4096)"))).alias("copy"),
    ).drop("copy")
