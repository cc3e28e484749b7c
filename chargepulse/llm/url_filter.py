"""URL filters as a sort-merge range join, in DataFrame functions only.

A rule ``(host, path)`` fits its host and all subdomains where the url's path starts
with the rule's.  Canonical keys reverse the host's labels (``com.example.www``); a
url makes one key per host suffix, a rule one, so a rule's path prefix is an interval
``[path, path + 0xFF)`` of byte strings under its reversed host.  Intervals of
one host are nested or apart.  Sorted by key, rule starts raise the depth of a stack
and rule ends lower it; a url's innermost rule is the last start at its depth.  Two
running windows over the same sorted partition express that sweep.

Rules are few against urls, but one suffix (``com``) may hold a third of all urls: a
suffix is swept in as many slices as its url count needs, each with that suffix's
rules.  Urls whose suffixes have no rule are never shuffled to a sweep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargepulse.llm.common import staged, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path, verdict) of the registered query; fixed by its contract.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def host_and_path(url: str = "url"):
    """Host (ASCII lower-cased) and path of a url; both empty without ``://``."""
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _reversed(host):
    return F.concat_ws(".", F.reverse(F.split(host, r"\.")))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", per_slice: int = 1000) -> DataFrame:
    """``(page_id, url)`` rows and ``(host, path, verdict)`` rules -> ``page_id, host, path, rule, verdict``.

    One row per input row, repeated ones and null ids included.  Null urls and urls
    without ``://`` have an empty host and path and fit no rule but one with an empty
    host and path.  The longest rule (host plus path) wins; of equally long ones the
    longer host.  Repeated rules count once; if their verdicts differ, the
    smallest string holds (``allow`` < ``block``).  Rules with a null host or path are left out.
    """
    host, path = host_and_path()
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = staged(rules.where("host is not null and path is not null")
                   .select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
                   .groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
                   .withColumn("suffix", _reversed(F.col("host"))), "url-rules")

    labels = F.split("host", r"\.")
    # Every suffix of the host, reversed: the first i labels of the reversed list.
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.concat_ws(".", F.slice(F.reverse(labels), F.lit(1), i)))
    points = urls.withColumn("suffix", F.explode(suffixes))
    hosts = staged(ruled.groupBy("suffix").agg(F.count("*").alias("rules")), "url-hosts")
    wide = F.greatest(F.lit(per_slice), 4 * F.col("rules"))  # so that repeated rules stay few against urls
    slices = staged(points.join(hosts, "suffix").groupBy("suffix", "rules").count()
                    .select("suffix", F.ceil(F.col("count") / wide).cast("int").alias("slices")), "url-slices")

    # The spread is by the whole row, so equal urls of different pages part as well.
    cut = F.pmod(F.xxhash64("page_id", "path"), F.col("slices")).cast("int")
    none = F.lit(None).cast("string")
    asked = points.join(slices, "suffix").select(
        "suffix", cut.alias("slice"), F.encode("path", "UTF-8").alias("key"), F.lit(1).alias("kind"),
        "page_id", "host", "path", none.alias("rule_host"), none.alias("rule_path"), none.alias("verdict"))
    spread = ruled.join(slices, "suffix").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))

    def event(kind: int, key):
        return spread.select("suffix", "slice", key.alias("key"), F.lit(kind).alias("kind"),
                             F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"),
                             none.alias("host"), none.alias("path"),
                             F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")

    begin = F.encode("path", "UTF-8")
    events = (asked.unionByName(event(0, begin))
              .unionByName(event(2, F.concat(begin, F.unhex(F.lit("FF"))))))

    step = F.when(F.col("kind") == 0, 1).when(F.col("kind") == 2, -1).otherwise(0)
    sweep = Window.partitionBy("suffix", "slice").orderBy("key", "kind", F.col("rule_path"))
    running = sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = (Window.partitionBy("suffix", "slice", "depth").orderBy("key", "kind")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    started = F.when(F.col("kind") == 0, F.struct("rule_host", "rule_path", "verdict"))
    # An end closes the depth that it leaves, so it never follows a start on its level.
    top = (events.withColumn("depth", F.sum(step).over(running))
           .withColumn("top", F.last(started, ignorenulls=True).over(level))
           .where("kind = 1 and depth > 0"))
    size = F.length("top.rule_host") + F.length("top.rule_path")
    fit = top.select("page_id", "host", "path",
                     F.struct(size.alias("size"), F.length("top.rule_host").alias("host_size"),
                              "top.rule_host", "top.rule_path", "top.verdict").alias("fit"), F.lit(0).alias("copies"))
    every = urls.select("page_id", "host", "path", F.lit(None).cast(fit.schema["fit"].dataType).alias("fit"),
                        F.lit(1).alias("copies"))
    judged = (fit.unionByName(every).groupBy("page_id", "host", "path")
              .agg(F.max("fit").alias("fit"), F.sum("copies").alias("copies")))
    return (judged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("page_id", "host", "path", F.concat("fit.rule_host", "fit.rule_path").alias("rule"),
                    F.coalesce("fit.verdict", F.lit(default)).alias("verdict")))


def op1_url_filters(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"),
                       spark.createDataFrame(RULES, "host string, path string, verdict string"))


ORACLE = """
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
         FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
                row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
         FROM parts p LEFT JOIN rules r
           ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
"""
