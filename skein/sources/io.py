"""Sources and sinks (IO1-IO8) and table-level set operations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Thread table as the cleaning job reads it.
THREAD = T.StructType([
    T.StructField("document", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("ext_labels", T.ArrayType(T.StringType())),
    T.StructField("rg_labels", T.ArrayType(T.StringType())),
])


def read_threads(spark: SparkSession, paths: str | Sequence[str], fmt: str = "json",
                 schema: T.StructType | str | None = THREAD, suffix: str | None = None,
                 **options) -> DataFrame:
    """IO1/IO2/IO3: one multi-path read with a declared schema (no inference
    job, no per-file schema drift). ``suffix`` keeps only files ending in it."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    if fmt == "csv":
        # Newlines survive (multiLine) and null stays distinct from ''.
        options = {"header": "true", "multiLine": "true", "escape": '"', "nullValue": "\\N",
                   "emptyValue": "", **options}
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(paths)


def write_threads(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                  partition_by: Sequence[str] | None = None, **options) -> None:
    """IO4: Parquet by default; CSV with header (arrays must be flattened). An
    existing path is an error unless ``mode`` says otherwise."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        options = {"header": "true", "escape": '"', "nullValue": "\\N", "emptyValue": '""', **options}
    for k, v in options.items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def flatten_arrays(df: DataFrame, seps: Mapping[str, str]) -> DataFrame:
    """IO5: array columns -> delimited strings (null elements skipped)."""
    return df.withColumns({c: F.concat_ws(sep, F.col(c).cast("array<string>")) for c, sep in seps.items()})


def preview(df: DataFrame, cols: Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """IO6: first rows of the selected columns (a plain LIMIT)."""
    return (df.select(*cols) if cols else df).limit(n)


def profile(df: DataFrame) -> DataFrame:
    """IO7: per column its type, non-null and null counts, from one aggregate
    pass (partial counts per task, one small final merge)."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count(F.col(f"`{c}`")).alias(f"nn_{i}")
                                                 for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f"nn_{i}").alias("non_null"))
        for i, f in enumerate(df.schema.fields)]))
    return (one.select(F.col("__rows"), stack.alias("s"))
            .select("s.position", "s.column", "s.type", "s.non_null",
                    (F.col("__rows") - F.col("s.non_null")).alias("nulls")))


def combine(dfs: Iterable[DataFrame]) -> DataFrame:
    """Bag union by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedupe(df: DataFrame, subset: Sequence[str], keep: str) -> DataFrame:
    """One row per distinct ``subset``, the one with the smallest ``keep``.

    ``min_by`` is a partial aggregate: a group of copies holding a third of the
    table collapses inside each map task before the shuffle, so no task ever
    receives the whole group (unlike a window over the copies)."""
    others = [c for c in df.columns if c not in subset]
    best = F.min_by(F.struct(*[F.col(c) for c in others]), F.col(keep)).alias("__best")
    return df.groupBy(*subset).agg(best).select(*subset, *[F.col(f"__best.{c}").alias(c) for c in others])


def save_model(model, path: str) -> None:
    """IO8: persist a fitted Spark ML model / pipeline (overwrites)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """IO8: load a saved ``PipelineModel`` (or any model saved by ``save_model``
    whose class is recorded in its metadata)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.util import DefaultParamsReader

    meta = DefaultParamsReader.loadMetadata(path, __import__("pyspark").SparkContext.getOrCreate())
    cls = meta["class"].replace("org.apache.spark", "pyspark")
    if cls == "pyspark.ml.PipelineModel":
        return PipelineModel.load(path)
    module, name = cls.rsplit(".", 1)
    return getattr(__import__(module, fromlist=[name]), name).load(path)
