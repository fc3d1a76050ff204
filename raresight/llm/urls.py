"""URL filter: listed rules first, then a tree of path templates per host.

Host and path are cut from the url; a listed rule (host suffix and path prefix) decides where one
fits, the longest first.  The other urls are judged by a template tree: per host, a path's segments
are generalised level by level (segments of digits, long hexadecimal segments and segments of levels
with very many values become wildcards).  Labelled urls give each template its number of rejected and
accepted urls.  Templates of one parent whose labelled shares are statistically alike are merged
and share their counts, and a template is rejected when its smoothed share of rejected labels
reaches ``purity``.

Nulls, empty urls and urls without ``://`` have an empty host and path: no rule fits them and their
template is the empty one of the empty host.  Repeated rows are judged alike; other columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raresight.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest of ``rules`` ((verdict, "host/path")) that fits, as struct<rule, verdict>; null if none does."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule string, verdict string>")


# Segments that vary by their look: digits (with an ending or not), hexadecimal names, uuids.
VARIABLE = r"^([0-9]+|[0-9a-f]{16,}|[0-9a-f]{8}-[0-9a-f-]{27})(\.[a-z0-9]{1,5})?$"


def template_table(pages: DataFrame, wide: int) -> DataFrame:
    """``pages`` (host, path, ...) with ``template``: the path's segments, variable ones as ``*``.

    A level's segments under one (host, look of the path so far) are variable when they have more
    than ``wide`` different values.  Distinct values are counted after a partial aggregation.
    """
    looks = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), lambda s: F.regexp_replace(s, VARIABLE, "*$2"))
    cut = pages.withColumn("__looks", looks)
    parent = "array_join(slice(__looks, 1, i), '/')"
    values = (cut.filter(F.size("__looks") > 0)
              .select("host", F.explode(F.expr(f"transform(__looks, (s, i) -> struct(i as level, {parent} as parent, s as look))")).alias("x"))
              .select("host", "x.level", "x.parent", "x.look").distinct())
    many = values.groupBy("host", "level", "parent").agg(F.count("*").alias("n")).filter(F.col("n") > wide)
    levels = many.groupBy("host").agg(F.collect_set(F.concat_ws(" ", F.col("level").cast("string"), "parent")).alias("__many"))
    levels = written(levels, "url-levels")  # hosts with a wide level: sized by its files, so a small table is broadcast and no page moves
    shaped = F.expr(f"transform(__looks, (s, i) -> if(array_contains(coalesce(__many, array()), concat(cast(i as string), ' ', {parent})), '*', s))")
    return cut.join(levels, "host", "left").withColumn("template", F.concat(F.lit("/"), F.array_join(shaped, "/"))).drop("__looks", "__many")


def judge_templates(labelled: DataFrame, purity: float, prior: float, z: float, min_labels: int) -> DataFrame:
    """(host, template, n, bad, rejected) from (host, template, n labelled, bad labelled).

    Siblings (equal but for the last constant segment) are merged when each has ``min_labels`` labels
    and its share lies within ``z`` standard errors of the siblings' common share.
    """
    parent = F.regexp_replace("template", r"(?<=/)[^/*]+(?=(/\*[^/]*)*$)", "+")
    shares = labelled.withColumn("parent", parent)
    of_parent = shares.groupBy("host", "parent").agg(F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"))
    common = F.col("all_bad") / F.col("all_n")
    # |bad/n - common| <= z * sqrt(common (1 - common) / n), squared
    alike = (F.col("n") >= min_labels) & (F.pow(F.col("bad") / F.col("n") - common, 2) * F.col("n") <= z * z * common * (1 - common) + 1e-12)
    merged = shares.join(of_parent, ["host", "parent"]).withColumn("alike", F.coalesce(alike, F.lit(False)))
    of_alike = merged.filter("alike").groupBy("host", "parent").agg(F.sum("n").alias("like_n"), F.sum("bad").alias("like_bad"))
    both = merged.join(of_alike, ["host", "parent"], "left")
    pooled = both.select("host", "template", *[F.when(F.col("alike"), F.col(f"like_{c}")).otherwise(F.col(c)).alias(c) for c in ("n", "bad")])
    return pooled.select("host", "template", "n", "bad", ((F.col("bad") + prior) >= purity * (F.col("n") + 2 * prior)).alias("rejected"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], key: str = "page_id", url: str = "url", label: Column | None = None,
                purity: float = 0.8, prior: float = 1.0, z: float = 2.0, min_labels: int = 5, wide: int = 50) -> DataFrame:
    """(key, host, path, rule, template, verdict).  ``label`` (1 rejected, 0 accepted, null unknown) may use host,
    path and any column of ``pages``; by default urls that a listed rule decides are the labelled ones."""
    fit = listed(rules, F.col("host"), F.col("path"))
    cut = pages.select(pages[key], host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"),
                       (label if label is not None else F.lit(None).cast("int")).alias("__label"))
    ruled = cut.withColumn("__fit", fit)
    if label is None:
        ruled = ruled.withColumn("__label", F.when(F.col("__fit.verdict") == "block", 1).when(F.col("__fit.verdict") == "allow", 0))
    shaped = template_table(ruled, wide)
    labelled = shaped.filter("__label is not null").groupBy("host", "template").agg(F.count("*").alias("n"), F.sum("__label").alias("bad"))
    # every template is in the tree; those without labels keep counts of zero and are never rejected
    judged = judge_templates(written(labelled, "url-labelled"), purity, prior, z, min_labels).filter("rejected").select("host", "template", "rejected")
    judged = written(judged, "url-rejected")
    return (shaped.join(judged, ["host", "template"], "left")
            .select(key, "host", "path", F.col("__fit.rule").alias("rule"), "template",
                    F.coalesce(F.col("__fit.verdict"), F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict")))
