"""Join shapes: dimension lookups, full joins of aggregates, parent chains.

No broadcast hints here: dimension sizes grow with the data, so the choice between a broadcast and a
shuffled join is left to the size statistics and AQE (``autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str | Column,
    dim_key: str,
    columns: Sequence[str] | None = None,
    prefix: str = "",
    keep_key: bool = False,
) -> DataFrame:
    """Left join that adds ``<prefix><column>`` for each wanted dim column; rows without a match pass through."""
    wanted = list(columns) if columns is not None else [c for c in dim.columns if keep_key or c != dim_key]
    slim = dim.select(F.col(dim_key).alias("_lookup_key"), *[F.col(c).alias(f"{prefix}{c}") for c in wanted])
    on = (df[key] if isinstance(key, str) else key) == slim["_lookup_key"]
    return df.join(slim, on, "left").drop("_lookup_key")


def lookup_within(df: DataFrame, dim: DataFrame, within: str, key: str, dim_key: str, columns: Sequence[str]) -> DataFrame:
    """``lookup`` by a key that belongs to one value of ``within``, a column of both sides; a NULL matches nothing.

    Rows that joins before have dealt by ``within`` stay where they are, only the dimension is moved. As two equal columns
    would deal both sides by both, the key is a range of one value. Each row is compared with all of the dimension's rows of its
    ``within`` value, so these should be few, as the lines of an order are.
    """
    slim = dim.select(F.col(within).alias("_lookup_within"), F.col(dim_key).alias("_lookup_key"), *columns)
    on = (df[within] == slim["_lookup_within"]) & df[key].between(slim["_lookup_key"], slim["_lookup_key"])
    return df.join(slim, on, "left").drop("_lookup_within", "_lookup_key")


BLANK_LANES = 4096


def lookup_text(df: DataFrame, dim: DataFrame, key: str | Column, dim_key: str, columns: Sequence[str], prefix: str) -> DataFrame:
    """``lookup`` with a text key: blank keys match nothing.

    Where the join shuffles, rows with a blank key are spread over the tasks by the texts they hold, in place of meeting in the
    one task of the NULL key; that they match nothing is a condition of its own, so no key of the dimension can be taken for
    theirs. This holds on streams too, where no plan is changed at run time.
    """
    c = F.col(key) if isinstance(key, str) else key
    clean = F.when(F.trim(c) != "", c)
    if dim.schema[dim_key].dataType.typeName() != "string":
        return lookup(df, dim, clean, dim_key, columns, prefix)
    texts = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() == "string"]
    lane = F.concat(F.lit("\u0001"), F.pmod(F.xxhash64(*texts), F.lit(BLANK_LANES)).cast("string")) if texts else F.lit("\u0001")
    slim = dim.select(F.col(dim_key).alias("_lookup_key"), *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    on = (F.coalesce(clean, lane) == slim["_lookup_key"]) & clean.isNotNull()
    return df.join(slim, on, "left").drop("_lookup_key")


def full_join(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full join of any number of aggregates; each join uses the key coalesced so far."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), frames)


def name_of_code(df: DataFrame, dictionary: DataFrame, parent: str, code: Column, name: str) -> DataFrame:
    """Add ``name`` = the dictionary text of ``code`` within one parent code."""
    names = dictionary.where(F.col("parent_code") == parent).select(
        F.col("dic_code").alias("_dic_code"), F.col("dic_name").alias(name)
    )
    return df.join(names, code == names["_dic_code"], "left").drop("_dic_code")


def region_chain(region: DataFrame) -> DataFrame:
    """id, name, parent_id -> the region with its two ancestors (``up1_*``, ``up2_*``)."""
    low = region.select(F.col("id").alias("region_id"), F.col("name").alias("region_name"), F.col("parent_id").alias("_p1"))
    mid = region.select(F.col("id").alias("up1_id"), F.col("name").alias("up1_name"), F.col("parent_id").alias("_p2"))
    top = region.select(F.col("id").alias("up2_id"), F.col("name").alias("up2_name"))
    return (
        low.join(mid, F.col("_p1") == F.col("up1_id"), "left")
        .join(top, F.col("_p2") == F.col("up2_id"), "left")
        .drop("_p1", "_p2")
    )
