"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein import session


def col(name: str) -> Column:
    """A top-level column by its literal name (dots included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct, so that no column of the input can
    clash with a working column."""
    return F.struct(*[col(c) for c in df.columns]).alias(name)


def field(name: str, of: str = "row") -> Column:
    return F.col(of).getField(name)


def unpacked(df: DataFrame, columns: list[str], outputs: list[str], of: str = "row") -> DataFrame:
    """The packed input columns, then ``outputs``; an input column that is
    named like an output (in any case) gives way to it."""
    taken = {o.lower() for o in outputs}
    kept = [field(c, of).alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *outputs)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared checkpoint folder and read
    back: later steps read it again without computing it again, and it
    survives lost executors."""
    spark = df.sparkSession
    path = f"{session.ensure_checkpoint_dir(spark).rstrip('/')}/skein-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """``df`` with the place (from 0, without gaps) of each row in ``order``:
    rows are dealt by sampled ranges and sorted there, and a place is the one
    in the range plus the counts of the ranges before (one number a partition)."""
    n = partitions(df.sparkSession)
    ranges = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    own = written(ranges.select("*", F.spark_partition_id().alias("_range"), inside.alias("_inside")), "numbered")
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = own.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    return own.join(F.broadcast(starts), "_range").select(*[col(c) for c in df.columns], (F.col("_start") + F.col("_inside")).alias(name))
