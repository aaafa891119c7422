"""Cross-site boilerplate lines by distinct-site spread, with DataFrame functions only.

Every line's hash gets a HyperLogLog sketch of the sites it stands on; sketches merge by aggregation, before and after the
shuffle, so a line that stands everywhere costs one small row per task. Lines whose estimate is near the limit, within
ERRORS standard errors, are decided by an exact distinct count of their sites; far lines need none. Boilerplate lines are
taken out of the documents that hold them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import kept, pick

LOG_K = 12
ERRORS = 5.0
#: A boilerplate line is met in so many parts of the documents.
SALTS = 32


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _hash(line: Column) -> Column:
    """Hash of the line without blanks, tabs and carriage returns at its ends; NULL for a line of nothing else."""
    bare = F.regexp_replace(line, r"^[ \t\r]+|[ \t\r]+$", "")
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate(lines: DataFrame, min_sites: int) -> DataFrame:
    """The hashes of (hash, site) rows that stand on at least ``min_sites`` distinct sites."""
    error = ERRORS * 1.04 / math.sqrt(2**LOG_K)
    low, high = math.floor(min_sites * (1 - error)), math.ceil(min_sites * (1 + error))
    spread = kept(lines.groupBy("hash").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_K))).alias("sites")).where(F.col("sites") >= low))
    near = spread.where(F.col("sites") <= high).select("hash")
    # sites are made distinct within each task first, and by (hash, site), so that a line that stands everywhere is split
    exact = lines.distinct().join(near, "hash", "left_semi").groupBy("hash").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites)
    return kept(spread.where(F.col("sites") > high).select("hash").union(exact.select("hash")))


def without_boilerplate(docs: DataFrame, min_sites: int = 8, site: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_lines (lines that are not blank), n_removed, text without the lines that stand on ``min_sites`` or
    more sites.

    Lines end at line feeds and are compared without blanks at their ends; blank lines stay. A NULL site is no site. A NULL
    text stays NULL with no lines; an empty one stays empty; a text of boilerplate alone becomes empty. Every row gives one
    row, repeated rows too; ids may be NULL or repeated. Lines of any length, an empty table gives no rows, other columns are
    not read.
    """
    source = pick(docs, doc_id=doc_id, text=text, site=site).withColumn("row", F.xxhash64("doc_id", "text"))
    lines = source.select("row", "site", F.explode(F.transform(_lines(F.col("text")), _hash)).alias("hash")).where("hash is not null")
    bad = boilerplate(lines.where("site is not null").select("hash", "site"), min_sites)
    # all boilerplate of a row; a set is at most the row's own lines
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    held = lines.select("row", "hash", F.pmod("row", F.lit(SALTS)).cast("int").alias("salt")).join(bad.select("hash", salts.alias("salt")), ["hash", "salt"], "left_semi").groupBy("row").agg(F.collect_set("hash").alias("bad"))
    joined = source.join(held, "row", "left")
    parts = _lines(F.col("text"))
    stays = F.filter(parts, lambda line: ~F.coalesce(F.array_contains("bad", _hash(line)), F.lit(False)))
    counted = joined.select("doc_id", "text", F.col("bad").isNotNull().alias("hit"), parts.alias("parts"), F.when(F.col("bad").isNotNull(), stays).otherwise(parts).alias("stays"))
    solid = F.coalesce(F.size(F.filter("parts", lambda line: _hash(line).isNotNull())), F.lit(0)).cast("long")
    return counted.select("doc_id", F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(solid).alias("n_lines"),
                          F.when(F.col("hit"), F.size("parts") - F.size("stays")).otherwise(0).cast("long").alias("n_removed"),
                          F.when(F.col("hit"), F.array_join("stays", "\n")).otherwise(F.col("text")).alias("text"))
