"""Diary, individuals and weights stored in buckets by respondent, so that they join where they lie.

The three tables that meet on (respid, quarter) are partitioned by quarter and, inside, bucketed and sorted by
respid. A scan of them is distributed by respid already, which is enough for the joins and for every distinct
that includes it: the diary is read, joined and reduced without an exchange, and so are individuals and weights.

A bucket can't be split by AQE, as there is no shuffle. So the sizes of the buckets are looked at (a listing,
no data is opened), and where one is out of proportion, as with a respondent who has a large share of the diary, the
table is read without its buckets: then it is shuffled as ever, and the skew join splits it.

The layout is Spark's own: bucketed Parquet tables of the session's catalog over folders of ``root``.
"""

from __future__ import annotations

import hashlib
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waveband.schemas import INPUT_SCHEMAS
from waveband.sources.releases import Folder
from waveband.sources.tables import TABLE_NAMES, SurveyTables, write_survey_tables

KEY = "respid"
#: fields of SurveyTables that are bucketed
BUCKETED = ("listening", "individuals", "weights")
_NAMES = dict(zip(SurveyTables.__dataclass_fields__, TABLE_NAMES))
_LAYOUT = "buckets="


def _table(root: str, name: str) -> str:
    """The catalog's name of a table: one for each root."""
    return f"waveband_{hashlib.sha256(root.encode()).hexdigest()[:12]}_{name}".lower().replace("-", "_")


def write_bucketed_tables(tables: SurveyTables, root: str, buckets: int, files_per_bucket: int = 1) -> None:
    """Write the bundle below ``root``; a bucket of a quarter has at most ``files_per_bucket`` files.

    Rows are dealt out by a hash of the whole row among those files, so a respondent with a large share is written by several tasks.
    """
    root = root.rstrip("/")
    spark = tables.listening.sparkSession
    plain = SurveyTables(*(t.limit(0) if f in BUCKETED else t for f, t in zip(_NAMES, tables.by_table_name().values())))
    write_survey_tables(plain, root)
    for field in BUCKETED:
        df, name = getattr(tables, field), _NAMES[field]
        bucket, file = F.pmod(F.hash(KEY), F.lit(buckets)), F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket))
        dealt = df.repartition("file_quarter", bucket, file)
        folder = f"{root}/{name}-by-{KEY}/{_LAYOUT}{buckets}"
        spark.sql(f"DROP TABLE IF EXISTS {_table(root, name)}")  # of the catalog only: the files are external
        dealt.write.partitionBy("file_quarter").bucketBy(buckets, KEY).sortBy(KEY).option("path", folder).format("parquet").saveAsTable(_table(root, name))


def bucket_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """``(file_quarter, bucket, bytes)`` of a bucketed table, from the listing of its files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
    bucket = F.regexp_extract("path", r"_(\d{5})(?:\.c\d+)?\.[^/]*$", 1).cast("int")
    quarter = F.regexp_extract("path", r"/file_quarter=([^/]*)/", 1)
    return files.groupBy(quarter.alias("file_quarter"), bucket.alias("bucket")).agg(F.sum("length").alias("bytes"))


def is_even(spark: SparkSession, folder: str, buckets: int) -> bool:
    """Whether no bucket is out of proportion, by the session's own settings for skewed partitions of a join."""
    factor = float(spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor"))
    threshold = spark._jsparkSession.sessionState().conf().getConfString("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256MB")
    least = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(threshold)
    # a task reads a bucket of all quarters in scope
    sizes = [r["bytes"] for r in bucket_sizes(spark, folder).groupBy("bucket").agg(F.sum("bytes").alias("bytes")).collect()]
    middle = median(sizes + [0] * (buckets - len(sizes))) if sizes else 0
    return not any(size > least and size > factor * middle for size in sizes)


def _registered(spark: SparkSession, root: str, name: str, folder: str, buckets: int) -> DataFrame:
    """The bucketed table as the session's catalog knows it; a session that doesn't is told."""
    table, schema = _table(root, name), INPUT_SCHEMAS[name]
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (file_quarter) "
                  f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")  # quarters that came since
    return spark.table(table)


def read_bucketed_tables(spark: SparkSession, root: str) -> SurveyTables:
    """The bundle below ``root``, its even tables by their buckets.

    Joins on (respid, quarter) may then use a distribution by respid alone; the session is set to allow that.
    """
    root = root.rstrip("/")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    frames = {}
    for field, name in _NAMES.items():
        columns = INPUT_SCHEMAS[name].fieldNames()
        if field in BUCKETED:
            layout = next(n for n in Folder(spark, f"{root}/{name}-by-{KEY}").names() if n.startswith(_LAYOUT))
            folder, buckets = f"{root}/{name}-by-{KEY}/{layout}", int(layout.removeprefix(_LAYOUT))
            if is_even(spark, folder, buckets):
                frames[field] = _registered(spark, root, name, folder, buckets).select(*columns)
            else:
                frames[field] = spark.read.schema(INPUT_SCHEMAS[name]).parquet(folder).select(*columns)
        else:
            frames[field] = spark.read.schema(INPUT_SCHEMAS[name]).parquet(f"{root}/{name}").select(*columns)
    return SurveyTables(**frames)
