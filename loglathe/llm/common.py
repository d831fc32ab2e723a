"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, scratch_dir

__all__ = ["crc_mod", "load", "materialise", "scratch_dir", "with_rank"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % mod


def with_rank(
    df: DataFrame, group: list[str], order: list[Column], salt: Column, name: str, parts: int = 64
) -> DataFrame:
    """Number the rows of each group from 0 without gathering a group in one task.

    Rows are dealt to ``parts`` buckets of each group by ``salt``, numbered inside
    their bucket, and shifted by the rows of the buckets before it. A group with a
    third of all rows is so sorted by up to ``parts`` tasks. Null-safe on the group.
    """
    from pyspark.sql import Window as W

    bucket = F.coalesce(F.pmod(salt, F.lit(parts)), F.lit(0)).cast("int")
    rows = df.withColumn("rank_bucket", bucket)
    sizes = rows.groupBy(*group, "rank_bucket").agg(F.count("*").alias("rank_rows"))
    before = W.partitionBy(*group).orderBy("rank_bucket").rowsBetween(W.unboundedPreceding, -1)
    shift = sizes.select(
        *[F.col(c).alias(f"rank_{i}") for i, c in enumerate(group)],
        F.col("rank_bucket").alias("rank_b"),
        F.coalesce(F.sum("rank_rows").over(before), F.lit(0)).alias("rank_shift"),
    )
    inside = W.partitionBy(*group, "rank_bucket").orderBy(*order)
    numbered = rows.withColumn("rank_inside", F.row_number().over(inside) - 1)
    on = [F.col(c).eqNullSafe(F.col(f"rank_{i}")) for i, c in enumerate(group)]
    joined = numbered.join(shift, [*on, F.col("rank_bucket") == F.col("rank_b")])
    return joined.select(*df.columns, (F.col("rank_inside") + F.col("rank_shift")).alias(name))
