"""Reading tables, and keeping fitted models."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate file in the folder that ``spark.checkpoint.dir`` names for the cluster.

    Where none is named, as in a local test, it is in the warehouse, which all executors share too. Files of an
    application are in a folder with its id, which can be deleted when the application has ended.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{folder}/{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """The same rows, computed once and written to the shared folder, for a result that is read several times."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a table that comes in fewer pieces than there are cores; leave any larger table alone.

    For costly work per row (text) on a table of few files. It shuffles, so only where it pays.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   ts_cols: tuple[str, ...] = (), ts_format: str | None = None,
                   multiline: bool = False) -> DataFrame:
    """A delimited text file with a header line, read as text and then cast to ``schema``.

    Columns are found by the names in the header, in any order; one that is not there is null, and files whose
    headers differ are an error. A field that does not fit its type becomes null instead of failing the job.
    ``multiline`` allows line breaks inside quotes, at the price that a file can no longer be split among tasks.
    """
    def reader():
        return (spark.read.option("sep", sep).option("header", True).option("quote", '"').option("escape", '"')
                .option("multiLine", multiline))

    header = reader().csv(path).columns  # reads the first line
    text = T.StructType([T.StructField(name, T.StringType(), True) for name in header])
    raw = reader().schema(text).option("enforceSchema", False).csv(path)
    raw = raw.withColumns({f.name: F.lit(None).cast("string") for f in schema.fields if f.name not in header})
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in ts_cols:
            args = (c,) if ts_format is None else (c, F.lit(ts_format))
            out.append(F.try_to_timestamp(*args).alias(f.name))
        else:
            out.append(c.try_cast(f.dataType).alias(f.name))
    return raw.select(*out)


def name_blank_header(df: DataFrame, name: str) -> DataFrame:
    """Give the unnamed first column of a headed file a name."""
    first = df.columns[0]
    if first.strip() in ("", "_c0", "Unnamed: 0"):
        return df.withColumnRenamed(first, name)
    return df


def parse_ts_permissive(df: DataFrame, col: str, fmt: str) -> tuple[DataFrame, DataFrame]:
    """Parse a text time; a bad one becomes null. Also one row with the count and share of bad ones."""
    parsed = df.withColumn(col, F.try_to_timestamp(F.col(col), F.lit(fmt)))
    bad = parsed.agg(F.count_if(F.col(col).isNull()).alias("n_bad"),
                     F.avg(F.col(col).isNull().cast("double")).alias("bad_share"))
    return parsed, bad


def to_features(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Add the columns as one vector; a missing value is an error, as for a numeric matrix."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def fit_or_load(spark: SparkSession, path: str, fit: Callable, load: Callable):
    """The model saved under ``path`` if there is one; else fit, save and return it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(jvm_path):
        return load(path)
    model = fit()
    model.write().save(path)
    return model
