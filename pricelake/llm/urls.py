"""URL filter: rules first, then a path-template tree per host with smoothed labelled purity.

Numbers and long hexadecimal strings of a path become marks, so that the rows of the tree are few. Level by level, below each
parent (host and template so far) the segments are looked at together: a segment that is one of more than ``most`` values and
has under ``1 / most`` of the parent's rows becomes the wildcard ``*``; of the others, those whose labelled bad share doesn't
differ from their siblings' (two-proportion test at ``z``) are merged into the same wildcard branch when they have siblings. A template's
purity is its share of good labels, smoothed by the host's, which is smoothed by the share of all; templates below
``least_purity`` are rejected.

All sums are hash aggregates over (host, shape) rows, so a host with a third of all rows is summed before the shuffle.

Defined cases: a null url or one without ``://`` has an empty host and path, fits no rule and is judged by the template of that
host; paths deeper than ``DEEPEST`` segments keep the rest as one segment; without labels everything is allowed; repeated rows
are judged alike; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricelake.llm.store import stored

DEEPEST = 12
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, lower-cased (A-Z), and the path."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def match_rules(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(the longest fitting rule, its verdict) of (verdict, ``host/path``) rules; null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for word, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        its_host, slash, its_path = text.partition("/")
        fits = ((host == its_host) | F.endswith(host, F.lit(f".{its_host}"))) & F.startswith(path, F.lit(slash + its_path))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, word).otherwise(verdict)
    return rule, verdict


def shape(path: Column) -> Column:
    """The path with long hexadecimal strings and numbers as marks."""
    return F.regexp_replace(F.regexp_replace(path, r"(?<![0-9A-Za-z])[0-9A-Fa-f]{16,}(?![0-9A-Za-z])", "{x}"), "[0-9]+", "{n}")


def templates(shapes: DataFrame, most: int = 16, z: float = 2.0) -> DataFrame:
    """(host, shape, n, labelled, bad) -> the same with ``template``."""
    deepest = shapes.select(F.max(F.least(F.size(F.split("shape", "/")), F.lit(DEEPEST)))).first()[0] or 0
    segment = F.split("shape", "/", DEEPEST)
    rows = shapes.withColumns({"segments": segment, "template": F.lit("")})
    for level in range(deepest):
        at = F.get("segments", F.lit(level))
        rows = rows.withColumn("segment", at)
        children = rows.where("segment IS NOT NULL").groupBy("host", "template", "segment").agg(
            *(F.sum(c).alias(c) for c in ("n", "labelled", "bad"))
        )
        parents = children.groupBy("host", "template").agg(
            F.count("*").alias("values"), *(F.sum(c).alias(f"all_{c}") for c in ("n", "labelled", "bad"))
        )
        both = children.join(parents, ["host", "template"])
        rare = (F.col("values") > most) & (F.col("n") * most < F.col("all_n"))
        others, others_bad = F.col("all_labelled") - F.col("labelled"), F.col("all_bad") - F.col("bad")
        pooled = F.col("all_bad") / F.greatest("all_labelled", F.lit(1))
        spread = F.sqrt(pooled * (1 - pooled) * (1 / F.greatest("labelled", F.lit(1)) + 1 / F.greatest(others, F.lit(1))))
        apart = F.abs(F.col("bad") / F.greatest("labelled", F.lit(1)) - others_bad / F.greatest(others, F.lit(1))) > z * spread
        alone = F.col("values") == 1
        tells = (F.col("labelled") > 0) & (others > 0) & apart
        named = both.where((alone | (~rare & tells)) & (F.col("segment") != "")).select("host", "template", "segment", F.lit(True).alias("named"))
        rows = rows.join(named, ["host", "template", "segment"], "left")
        step = F.when(F.col("segment") == "", "").when(F.col("named"), F.col("segment")).otherwise("*")
        put = F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat_ws("", "template", F.lit("/" if level else ""), step))
        rows = stored(rows.withColumn("template", put).drop("named", "segment"), "template-level")
    return rows.drop("segments")


def judge(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], least_purity: float = 0.5, weight: float = 8.0,
    most: int = 16, z: float = 2.0,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of (page_id, url) by labels (page_id, bad boolean)."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("shape", shape(F.col("path")))
    known = labels.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    seen = parsed.join(known, "page_id", "left")
    shapes = seen.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.sum(F.coalesce(F.col("bad").cast("long"), F.lit(0))).alias("bad")
    )
    tree = stored(templates(stored(shapes, "shapes"), most, z), "templates")
    sums = [F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")]
    whole = tree.agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b")).select(
        ((F.coalesce("l", F.lit(0)) - F.coalesce("b", F.lit(0)) + 1) / (F.coalesce("l", F.lit(0)) + 1)).alias("good")
    ).first()[0]
    smoothed = lambda prior: (F.col("labelled") - F.col("bad") + weight * prior) / (F.col("labelled") + weight)
    hosts = tree.groupBy("host").agg(*sums).select("host", smoothed(F.lit(float(min(whole, 1.0)))).alias("of_host"))
    purity = tree.groupBy("host", "template").agg(*sums).join(hosts, "host").select(
        "host", "template", smoothed(F.col("of_host")).alias("purity")
    )
    judged = stored(tree.select("host", "shape", "template").join(purity, ["host", "template"]), "purity")
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") < least_purity, "block").otherwise("allow")
    return parsed.join(judged, ["host", "shape"], "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "template", "purity"
    )
