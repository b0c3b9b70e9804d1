"""Checks of a published site and the difference between two file sets, as anti-joins over (path, content)."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X

REQUIRED = ("index.html", "entities.html")


def resolve_asset(path: Column, reference: Column, base: str) -> Column:
    """The file that a reference from a page means: below the site's root for /..., else beside the page."""
    base = base.rstrip("/")
    rooted = F.regexp_replace(reference, r"^/+", "")
    if base:
        rooted = F.when((reference == base) | reference.startswith(f"{base}/"), F.regexp_replace(F.substring(reference, len(base) + 1, 1 << 30), r"^/+", "")).otherwise(rooted)
    beside = F.concat(F.regexp_extract(path, r"^(.*/)?[^/]*$", 1), reference)
    parts = F.filter(F.split(F.when(reference.startswith("/"), rooted).otherwise(beside), "/"), lambda p: (p != "") & (p != "."))
    # a .. takes the part before it away
    folded = F.aggregate(parts, F.array().cast("array<string>"), lambda a, p: F.when((p == "..") & (F.size(a) > 0), F.slice(a, F.lit(1), F.size(a) - 1)).otherwise(F.concat(a, F.array(p))))
    return F.array_join(folded, "/")


def missing_assets(files: DataFrame, base: str = "") -> DataFrame:
    """(path, reference) of style sheets and scripts that pages refer to but the site lacks."""
    refs = files.filter(F.col("path").endswith(".html")).select("path", F.explode(X.asset_references(F.col("content"))).alias("reference"))
    refs = refs.withColumn("file", resolve_asset(F.col("path"), F.col("reference"), base))
    return refs.join(files.select(F.col("path").alias("file")), "file", "left_anti").select("path", "reference")


def problems(files: DataFrame, title: str, base: str = "") -> DataFrame:
    """(detail) of everything that keeps a site from being valid."""
    spark = files.sparkSession
    wanted = spark.createDataFrame([(p,) for p in REQUIRED], "path string")
    absent = wanted.join(files, "path", "left_anti").select(F.concat(F.lit("missing page "), "path").alias("detail"))
    named = F.concat(F.lit('content="'), X.escape_html(F.lit(title)), F.lit('"'))
    unnamed = files.join(wanted, "path").filter(~F.contains("content", named)).select(F.concat("path", F.lit(" does not name the site")).alias("detail"))
    assets = missing_assets(files, base).select(F.concat("path", F.lit(" lacks "), "reference").alias("detail"))
    none = files.agg(F.count_if(F.col("path").endswith(".html")).alias("n")).filter("n = 0").select(F.lit("no HTML pages").alias("detail"))
    return absent.unionByName(unnamed).unionByName(assets).unionByName(none)


def sync_plan(source: DataFrame, target: DataFrame) -> DataFrame:
    """(path, action, step): copies with pages last, then deletions with pages first."""
    page = F.col("path").endswith(".html")
    copies = source.select("path", F.lit("copy").alias("action"), F.when(page, 2).otherwise(1).alias("step"))
    stale = target.select("path").join(source.select("path"), "path", "left_anti").select("path", F.lit("delete").alias("action"), F.when(page, 3).otherwise(4).alias("step"))
    return copies.unionByName(stale)


def _files(root: str) -> dict[str, str]:
    return {os.path.relpath(os.path.join(d, n), root).replace(os.sep, "/"): os.path.join(d, n) for d, _, names in os.walk(root) for n in names}


def publish(spark: SparkSession, source: str, target: str) -> int:
    """Makes target hold what source holds, by sync_plan's steps: a page never refers to files that are not there. Both are folders of the driver."""
    table = lambda root: spark.createDataFrame([(p,) for p in _files(root)], "path string")
    plan = sync_plan(table(source), table(target)).orderBy("step", "path").collect()  # the files that a site has
    for row in plan:
        to = os.path.join(target, row.path)
        if row.action == "copy":
            os.makedirs(os.path.dirname(to) or ".", exist_ok=True)
            shutil.copyfile(os.path.join(source, row.path), to)
        else:
            os.remove(to)
    return len(plan)


def preview_folder(root: str, base_url: str) -> str:
    path = base_url.partition("/")[2].strip("/")
    return f"{root}/{path}" if path else root
