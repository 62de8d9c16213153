"""Readers and writers (CSV as the interchange format, Parquet for stages).

All readers take an explicit schema: no inference pass over the data and a
stable plan. CSV is read PERMISSIVE (bad fields become null, short lines are
padded with nulls) with ``enforceSchema=False``, so a header whose column
names or order differ from the schema fails loudly instead of loading
swapped columns.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sparkrec.functions.keys import int_key
from sparkrec.sources.schemas import INTERACTIONS_CSV, PREDICTIONS, PREDICTIONS_FILE

# Column of a line that does not parse, folder of the bucketed rows, tasks a bucket's rows are dealt to.
CORRUPT = "_corrupt_record"
BUCKETED = "rows"
BUCKET_SPREAD = 4


def read_interactions_csv(spark: SparkSession, path: str, item_col: str = "app_id") -> DataFrame:
    """The review log: pruned to user, item, hours and flag, renamed to ours.

    Column pruning reaches the CSV scan (``ReadSchema`` has four columns). The
    keys are read as text: one beyond int fails, one that is no whole number
    becomes null (:func:`unparsable_keys` counts those).
    """
    raw = _review_log(spark, path)
    return raw.select(
        int_key("user_id").alias("user_id"),
        int_key(item_col).alias("item_id"),
        F.col("hours"),
        F.col("is_recommended"),
    )


def unparsable_keys(spark: SparkSession, path: str, item_col: str = "app_id") -> DataFrame:
    """One row: how many user and item keys of the review log are text but no whole number."""
    bad = lambda c: F.count_if(F.col(c).isNotNull() & int_key(c).isNull())
    return _review_log(spark, path).agg(bad("user_id").alias("user_id"), bad(item_col).alias("item_id"))


def read_rejects(spark: SparkSession, path: str, item_col: str = "app_id") -> DataFrame:
    """The review log's lines that did not parse whole: ``reason, record`` and the log's eight columns.

    ``reason`` is ``malformed`` for a line with a field of another type than
    the schema's (its value is null here and in :func:`read_interactions_csv`,
    where a bad flag counts as "not recommended") or with too few or too many
    fields, and ``record`` is that line as it stands. A line that parses but whose user
    or item key is no whole number has that column's name as reason (the user's
    first) and no record. Keys beyond int fail, as they do on reading. Every
    column is read, as a line is only known to be malformed by the fields parsed.
    """
    log = _review_log(spark, path, CORRUPT)
    bad = lambda c: F.col(c).isNotNull() & int_key(c).isNull()
    # true of every line, and needs every column, so that pruning can't leave a bad field unparsed
    whole = F.xxhash64(*[f.name for f in INTERACTIONS_CSV.fields]) >= F.lit(-(1 << 63))
    reason = F.when(F.col(CORRUPT).isNotNull() & whole, "malformed").when(bad("user_id"), "user_id").when(bad(item_col), item_col)
    named = log.select(reason.alias("reason"), F.col(CORRUPT).alias("record"), *[f.name for f in INTERACTIONS_CSV.fields])
    return named.where("reason IS NOT NULL")


def _review_log(spark: SparkSession, path: str, corrupt: str | None = None) -> DataFrame:
    keys = ("user_id", "app_id")
    fields = [StructField(f.name, StringType() if f.name in keys else f.dataType, True) for f in INTERACTIONS_CSV.fields]
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
    if corrupt:
        fields.append(StructField(corrupt, StringType(), True))
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(StructType(fields)).csv(path)


def read_titles_csv(
    spark: SparkSession,
    path: str,
    infer: bool = False,
    item_col: str = "app_id",
    title_col: str = "title",
) -> DataFrame:
    """Item titles ``(item_id int, title string)`` from a CSV with a header.

    The file may carry any other columns; the two are selected by header
    name. Without ``infer`` every column is read as a string (no extra
    pass over the file) and the key is parsed; with ``infer=True`` Spark
    infers the schema first (one more pass). Either way a key outside the
    int range fails, and an unparsable key becomes null.
    """
    reader = spark.read.option("header", True)
    raw = reader.option("inferSchema", True).csv(path) if infer else reader.csv(path)
    return raw.select(int_key(item_col).alias("item_id"), F.col(title_col).cast("string").alias("title"))


def read_users_csv(spark: SparkSession, path: str) -> DataFrame:
    """``user_id int`` of a CSV with that column; text that is no int fails."""
    return spark.read.option("header", True).csv(path).select(int_key("user_id", strict=True).alias("user_id"))


def write_csv(df: DataFrame, path: str) -> None:
    """Directory of part files with a header, replacing what is there."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "csv", buckets: int | None = None) -> None:
    """Predictions with the file's column names and types (score narrowed to float).

    ``bucketed`` is Parquet in buckets by user, sorted by user, for repeated
    one-user reads: :func:`read_predictions` prunes to the user's bucket. Each
    bucket's rows are dealt to up to ``BUCKET_SPREAD`` tasks by item, so a user
    with very many pairs is not written by one task. ``buckets`` defaults to
    ``spark.sql.shuffle.partitions``; the count is noted beside the data.
    """
    out = conform(df, PREDICTIONS).withColumnsRenamed(PREDICTIONS_FILE)
    if fmt == "csv":
        write_csv(out, path)
    elif fmt == "parquet":
        out.write.mode("overwrite").parquet(path)
    elif fmt == "bucketed":
        spark = df.sparkSession
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        user, item = PREDICTIONS_FILE["user_id"], PREDICTIONS_FILE["item_id"]
        dealt = out.repartition(buckets * BUCKET_SPREAD, F.pmod(F.hash(user), F.lit(buckets)), F.pmod(F.xxhash64(item), F.lit(BUCKET_SPREAD)))
        writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, user).sortBy(user)
        writer.option("path", f"{path}/{BUCKETED}").saveAsTable(_bucket_table(path))
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").json(f"{path}/layout")
    else:
        raise ValueError(f"unknown format {fmt!r}")


def read_predictions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A predictions file under the library's column names.

    A ``bucketed`` one is read through a table over its folder, which is made in this
    session's catalog if it is not there, whoever wrote the folder.
    """
    in_file = StructType([StructField(PREDICTIONS_FILE[f.name], f.dataType, True) for f in PREDICTIONS.fields])
    if fmt == "csv":
        raw = spark.read.schema(in_file).option("header", True).option("enforceSchema", False).csv(path)
    elif fmt == "parquet":
        raw = conform(spark.read.parquet(path), in_file)
    elif fmt == "bucketed":
        name, user = _bucket_table(path), PREDICTIONS_FILE["user_id"]
        if not spark.catalog.tableExists(name):
            buckets = spark.read.schema("buckets int").json(f"{path}/layout").first()["buckets"]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in in_file.fields)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{user}`) SORTED BY (`{user}`) "
                      f"INTO {int(buckets)} BUCKETS LOCATION '{path}/{BUCKETED}'")
        raw = spark.table(name)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return raw.withColumnsRenamed({name: own for own, name in PREDICTIONS_FILE.items()})


def _bucket_table(path: str) -> str:
    return "predictions_" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:16]


def conform(df: DataFrame, schema) -> DataFrame:
    """Select and cast to a fixed schema by name (no RDD round trip)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

