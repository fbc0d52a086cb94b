"""Sources and sinks: transaction CSV (S1, S2, S10), Hive-partitioned Parquet
feature tables (S3, S6, S7), the format dispatcher (S4), partition removal
and period-scoped overwrite (S8) and the prediction CSV (S9)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DecimalType, IntegerType, StringType, StructField, StructType)

from ..session import scratch_path, storing

# Column names and order of a raw transaction file.
TXN_CSV_SCHEMA = StructType([
    StructField("customer_id", StringType()),
    StructField("transaction_id", StringType()),
    StructField("timestamp", StringType()),
    StructField("amount", DecimalType(18, 2)),
    StructField("category", StringType()),
    StructField("merchant_id", StringType()),
    StructField("payment_method", StringType()),
    StructField("device", StringType()),
    StructField("city", StringType()),
    StructField("balance", DecimalType(18, 2)),
    StructField("is_online", IntegerType()),
])


def hadoop_fs(spark: SparkSession, path: str):
    """(file system, path, JVM gateway) of a path, for names, renames and deletes; never for data."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def is_directory(spark: SparkSession, path: str) -> bool:
    """Whether the path is a directory in its own file system (the session's
    default one for a path without scheme)."""
    fs, hpath, _ = hadoop_fs(spark, path)
    return fs.exists(hpath) and fs.getFileStatus(hpath).isDirectory()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path that this package wrote, with all below it."""
    fs, hpath, _ = hadoop_fs(spark, path)
    fs.delete(hpath, True)


@contextmanager
def stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as a table under the checkpoint directory, for several jobs that
    each read some of its columns: what it is made from (a join) runs once.
    Removed at the end, so whatever is made from it has to be written by then."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        with storing(spark):
            df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads (0 where it reads none): their lengths, no data."""
    spark = df.sparkSession
    return sum(fs.getFileStatus(path).getLen() for fs, path, _ in (hadoop_fs(spark, f) for f in df.inputFiles()))


def tasks_for(df: DataFrame, task_bytes: int = 4 << 20) -> int | None:
    """Partitions for a shuffle of all rows of ``df``: one per ``task_bytes`` of the
    files that it reads (4 MB are about 300,000 transactions), so that a
    task's share does not grow with the input; at least one per core.  None where no
    files are read: the session's number holds."""
    size = input_bytes(df)
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes)) if size else None


def batch_count(df: DataFrame, batch_bytes: int) -> int:
    """Batches for the rows of ``df``: one per ``batch_bytes`` of the files that it reads."""
    return max(1, -(-input_bytes(df) // batch_bytes))


def entity_batches(df: DataFrame, entity: str, n: int) -> list[DataFrame]:
    """``df`` as ``n`` frames, all rows of an entity in one of them (rows without one too)."""
    return [df.where(F.pmod(F.xxhash64(F.col(entity)), F.lit(n)) == b) for b in range(n)] if n > 1 else [df]


def deal(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``df`` with the rows of equal ``keys`` in one of ``tasks`` partitions (None: adaptive)."""
    cols = [F.col(k) for k in keys]
    return df.repartition(tasks, *cols) if tasks else df.repartition(*cols)


def read_transactions_csv(spark: SparkSession, path: str, schema: StructType = TXN_CSV_SCHEMA,
                          ts_col: str = "timestamp", strict: bool = True, ntz: bool = True) -> DataFrame:
    """S1 + S2: header CSV with an explicit schema (no inference pass over the
    data); the time column is parsed with ``to_timestamp`` — under ANSI mode an
    unparseable value fails the job (``strict``), otherwise it becomes NULL
    (``try_to_timestamp``) and the row is dropped later by the grouping."""
    raw = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    if dict((f.name, f.dataType) for f in schema.fields).get(ts_col) != StringType():
        return raw
    parsed = F.to_timestamp(F.col(ts_col)) if strict else F.try_to_timestamp(F.col(ts_col))
    if ntz:
        parsed = parsed.cast("timestamp_ntz")
    return raw.withColumn(ts_col, parsed)


def check_transactions_csv(spark: SparkSession, path: str, schema: StructType = TXN_CSV_SCHEMA, ts_col: str = "timestamp",
                           ntz: bool = True, header: bool = True) -> DataFrame:
    """S1 + S2 without a failing job: every record of the CSV with its typed
    columns, ``_reject`` (why the record is bad; NULL for a good one) and
    ``_record`` (its text).  Bad is a record with too few or too many fields, a
    value that is not of its column's type, a decimal with more digits after the
    point than its column keeps, and a time that is none.  Empty values are NULL."""
    text = StructType([*[StructField(f.name, StringType()) for f in schema.fields], StructField("_corrupt", StringType())])
    raw = (spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt").csv(path))
    typed, why = [], [F.when(F.col("_corrupt").isNotNull(), F.lit("wrong number of fields"))]
    for f in schema.fields:
        c, kind = F.col(f.name), f.dataType.simpleString()
        if f.name == ts_col:
            value = F.try_to_timestamp(c)
            value = value.cast("timestamp_ntz") if ntz else value
            kind = "timestamp"
        else:
            value = c.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        why.append(F.when(c.isNotNull() & value.isNull(), F.lit(f"{f.name}: not {kind}")))
        if isinstance(f.dataType, DecimalType):
            why.append(F.when(value != c.try_cast("double"), F.lit(f"{f.name}: more than {f.dataType.scale} decimals")))
    reasons = F.filter(F.array(*why), lambda x: x.isNotNull())
    record = F.coalesce("_corrupt", F.to_csv(F.struct(*[F.col(f.name) for f in schema.fields])))
    return raw.select(*typed, F.when(F.size(reasons) > 0, F.array_join(F.when(F.col("_corrupt").isNotNull(), F.slice(reasons, 1, 1)).otherwise(reasons), "; "))
                      .alias("_reject"), record.alias("_record"))


def quarantine_transactions_csv(spark: SparkSession, path: str, out: str, schema: StructType = TXN_CSV_SCHEMA, **options) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) of a transaction CSV, both kept at ``out``: one pass
    over the file writes the typed good records and, in a partition of their own,
    the bad ones as (record, reason)."""
    checked = check_transactions_csv(spark, path, schema, **options)
    bad = F.col("_reject").isNotNull()
    checked.withColumn("_record", F.when(bad, F.col("_record"))).withColumn("_bad", bad).write.partitionBy("_bad").parquet(out)
    kept = spark.read.schema(StructType([*checked.schema.fields, StructField("_bad", BooleanType())])).parquet(out)
    return (kept.where(~F.col("_bad")).select(*[f.name for f in schema.fields]),
            kept.where(F.col("_bad")).select(F.col("_record").alias("record"), F.col("_reject").alias("reason")))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """Header CSV, one part file per task (no single-writer
    funnel); the directory is created by the writer.  ``compression``: a codec's
    name, for files that only readers of the directory open."""
    with storing(df.sparkSession):
        df.write.mode(mode).option("header", True).option("compression", compression).csv(path)


def write_predictions_csv(predictions: DataFrame, path: str) -> None:
    """The predictions' plain columns — (entity, predict_period,
    predicted_category) and, where a model made them, the probability — as
    header CSV."""
    flat = [f.name for f in predictions.schema.fields if f.dataType.typeName() != "array"]
    write_csv(predictions.select(*flat), path)


def _by_period(df: DataFrame, partition_col: str, shuffle: bool, mode: str = "overwrite"):
    """Writer of ``df`` partitioned by period.  The rebalance hint brings each
    period's rows together and lets adaptive execution split large periods and
    join small ones, so neither tasks × periods files nor one task per period
    result; a source that lies in period order already needs no shuffle."""
    df = df.withColumn(partition_col, F.col(partition_col).cast("string"))
    if shuffle:
        df = df.hint("rebalance", partition_col)
    return df.write.mode(mode).option("compression", "zstd").partitionBy(partition_col)


def write_partitioned(df: DataFrame | list[DataFrame], path: str, partition_col: str = "period", shuffle: bool = True) -> None:
    """Replace the whole table at ``path`` with ``df`` partitioned by
    ``partition_col`` (static overwrite: periods absent from ``df`` are
    removed, like deleting the directory first).  Of a list, the frames are
    written one after the other and together are the table."""
    for n, part in enumerate(df if isinstance(df, list) else [df]):
        with storing(part.sparkSession):
            _by_period(part, partition_col, shuffle, "append" if n else "overwrite").option("partitionOverwriteMode", "static").parquet(path)


def overwrite_periods(df: DataFrame, path: str, partition_col: str = "period") -> None:
    """S8 (path form): replace only the periods present in ``df``; all other
    period directories are left untouched (dynamic partition overwrite)."""
    with storing(df.sparkSession):
        _by_period(df, partition_col, True).option("partitionOverwriteMode", "dynamic").parquet(path)


def read_partitioned(spark: SparkSession, path: str, partition_col: str = "period") -> DataFrame:
    """S3: Hive-partitioned Parquet directory; the partition value comes back
    as text (``2025-08``, not an inferred date/int), so a filter on it is a
    partition filter (directory pruning) and only read columns are scanned."""
    if not is_directory(spark, path):
        raise ValueError(f"no directory of a partitioned table: {path}")
    df = spark.read.option("basePath", path).parquet(path)
    return df.withColumn(partition_col, F.col(partition_col).cast("string"))


def read_table(spark: SparkSession, path: str, csv_schema: StructType | None = None) -> DataFrame:
    """By name, ``*.csv`` → header CSV (explicit schema if given, else
    inferred; a malformed value fails the job) and ``*.parquet`` → Parquet, as
    Spark writes either as a directory; any other directory → partitioned
    Parquet; anything else raises."""
    p = path.rstrip("/")
    low = p.lower()
    if low.endswith(".csv"):
        r = spark.read.option("header", True).option("mode", "FAILFAST")
        return r.schema(csv_schema).csv(p) if csv_schema else r.option("inferSchema", True).csv(p)
    if low.endswith(".parquet"):
        return spark.read.parquet(p)
    if is_directory(spark, p):
        return read_partitioned(spark, p)
    raise ValueError(f"neither a directory nor a .parquet or .csv path: {path}")


def partition_name(spark: SparkSession, partition_col: str, value: str) -> str:
    """``col=value``, with the characters escaped that a writer escapes."""
    return f"{partition_col}={spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))}"


def stored_periods(spark: SparkSession, path: str, partition_col: str = "period") -> list[str]:
    """The period values that a table has directories for (names only)."""
    fs, base, jvm = hadoop_fs(spark, path)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(base, f"{partition_col}=*")) or []
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return sorted(unescape(s.getPath().getName().split("=", 1)[1]) for s in found)


def drop_partitions(spark: SparkSession, paths: str | list[str], periods=None, partition_col: str = "period") -> list[str]:
    """S8 (path form): delete ``period=<v>`` directories of one table or of
    several — all of them when ``periods`` is None.  Returns what was removed
    (``path/period=v``); a missing table is a no-op.  No data is read."""
    removed = []
    for path in [paths] if isinstance(paths, str) else paths:
        fs, base, jvm = hadoop_fs(spark, path)
        if not fs.exists(base):
            continue
        for v in stored_periods(spark, path, partition_col) if periods is None else periods:
            target = jvm.org.apache.hadoop.fs.Path(base, partition_name(spark, partition_col, v))
            if fs.exists(target) and fs.delete(target, True):
                removed.append(f"{path.rstrip('/')}/{target.getName()}")
    return removed


def drop_table_partitions(spark: SparkSession, tables: str | list[str], periods, partition_col: str = "period") -> None:
    """S8 (catalog form): ``ALTER TABLE … DROP IF EXISTS PARTITION``."""
    for table in [tables] if isinstance(tables, str) else tables:
        for v in periods:
            esc = str(v).replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_col} = '{esc}')")


def write_feature_store(combined: DataFrame | list[DataFrame], narrow: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Write the combined table once, then each narrow table *from the
    written combined table*: column-pruned scans of files that lie in period
    order, so the narrow tables are written without a shuffle.  ``combined``: a
    frame, or the batches of one (see :func:`write_partitioned`).

    Returns {table name: path}."""
    spark = (combined[0] if isinstance(combined, list) else combined).sparkSession
    paths = {"feature_store": f"{base.rstrip('/')}/feature_store"}
    write_partitioned(combined, paths["feature_store"])
    stored = read_partitioned(spark, paths["feature_store"])
    for name, df in narrow.items():
        paths[name] = f"{base.rstrip('/')}/feature_store_{name}"
        write_partitioned(stored.select(*df.columns), paths[name], shuffle=False)
    return paths


def read_narrow_tables(spark: SparkSession, paths: dict[str, str],
                       names=("core_behavior", "category", "payment", "growth", "trend")) -> list[DataFrame]:
    return [read_partitioned(spark, paths[n]) for n in names if n in paths]


def bucket_count(df: DataFrame) -> int:
    """Buckets for tables of the rows of ``df``: as many as a merge of them has tasks."""
    return tasks_for(df) or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def write_bucketed(df: DataFrame, table: str, path: str, keys=("customer_id", "period"), buckets: int | None = None) -> None:
    """J2, stored form: ``df`` as the catalog table ``table`` at ``path``, bucketed
    and sorted by ``keys`` with one file a bucket.  Tables with equal keys and
    bucket counts merge without a shuffle (``tables.merge_bucketed``); a bucket is
    what one task of the merge holds, so their number has to follow the rows
    (:func:`bucket_count`, also the default)."""
    n = buckets or bucket_count(df)
    with storing(df.sparkSession):
        df.repartition(n, *keys).write.mode("overwrite").option("compression", "zstd").bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
