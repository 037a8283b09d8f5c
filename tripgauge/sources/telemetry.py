"""Reading and writing telemetry."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.operators.kinematics import ROLLING_ROWS
from tripgauge.operators.quality import filter_coordinates
from tripgauge.operators.slicing import SLICE_ROWS, WHOLE_TRIPS, TripSlices, plan_slices, with_context
from tripgauge.schema import CSV_TIMESTAMP_FORMAT, EXTERNAL_NAMES, TELEMETRY

# Rows ahead of a slice that a bucketed table keeps: as many as any operator looks back.
STORED_CONTEXT = ROLLING_ROWS - 1


def normalize(df: DataFrame) -> DataFrame:
    """Rename external columns to engine names and fill in what is absent."""
    named = df.withColumnsRenamed({old: new for old, new in EXTERNAL_NAMES.items() if old in df.columns})
    absent = {
        f.name: F.lit(None).cast(f.dataType)
        for f in TELEMETRY.fields
        if f.name not in named.columns and f.name != "seq"
    }
    if "seq" not in named.columns:
        absent["seq"] = F.monotonically_increasing_id()
    return named.withColumns(absent) if absent else named


def read_telemetry(spark: SparkSession, fmt: str = "parquet", path: str | None = None, **options: str) -> DataFrame:
    """Telemetry through any installed connector, e.g. a wide-column store's with its
    own ``table`` and ``keyspace`` options, or files below ``path``."""
    return normalize(spark.read.format(fmt).options(**options).load(path))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    timestamp_format: str = CSV_TIMESTAMP_FORMAT,
) -> DataFrame:
    """CSV with a header row, which says what each column is, in any order. Types follow
    from the names: those of ``schema``, or of the telemetry columns; others are text.
    Columns of ``schema``, or ``id_viaje, tiempo, velocidad_kmh`` without one, must be
    there. ``infer`` reads the types off the data, at the cost of one more pass."""
    reader = spark.read.option("header", True).option("timestampFormat", timestamp_format)
    try:
        header = spark.read.option("header", True).csv(path).columns
        required = [f.name for f in (schema or CSV_SCHEMA).fields]
        missing = [c for c in required if c not in header and EXTERNAL_NAMES.get(c) not in header]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
        if infer:
            reader = reader.option("inferSchema", True)
        else:
            types = {**_TYPES_BY_NAME, **{f.name: f.dataType for f in (schema or CSV_SCHEMA).fields}}
            named = [T.StructField(c, types.get(c, T.StringType())) for c in header]
            # A file whose header differs is an error and not read by position.
            reader = reader.schema(T.StructType(named)).option("enforceSchema", False)
        df = normalize(reader.csv(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"telemetry file not found: {path}") from error
        raise
    if df.schema["event_time"].dataType != T.TimestampType():
        df = df.withColumn("event_time", F.to_timestamp("event_time"))
    return df.withColumn("speed_kmh", F.col("speed_kmh").cast("double"))


CSV_SCHEMA = T.StructType([
    T.StructField("id_viaje", T.StringType()),
    T.StructField("tiempo", T.TimestampType()),
    T.StructField("velocidad_kmh", T.DoubleType()),
])
_TYPES_BY_NAME = {
    **{f.name: f.dataType for f in TELEMETRY.fields},
    **{old: TELEMETRY[new].dataType for old, new in EXTERNAL_NAMES.items() if new in TELEMETRY.fieldNames()},
}


def append_telemetry(df: DataFrame, path: str) -> None:
    """Append samples stamped with their write time, which starts their retention."""
    stamped = df.withColumn("ingested_at", F.current_timestamp())
    stamped.select(*TELEMETRY.fieldNames()).write.mode("append").parquet(path)


def write_clustered(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write telemetry so that a trip's samples lie together in time order. Ranges of
    (trip, time) are balanced by rows, so a long trip spans several files, and the
    row-group statistics let a read of one trip skip the rest."""
    keys = ["trip_id", "event_time", "seq"]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, slice_rows: int = SLICE_ROWS) -> None:
    """Write telemetry as a table bucketed and sorted by trip, from which trips are scored
    without any shuffle. Where a trip is long the table is bucketed by trip *and* slice, and
    holds, marked as ``context``, the rows a look-back needs ahead of each slice; then
    only one row per trip and slice is shuffled. Read it with ``read_bucketed``.

    The rows ahead are those of all samples and those inside the coordinate bounds, so both
    may be scored; under another filter a slice's first rows may lack their predecessors."""
    slices = plan_slices(df, slice_rows=slice_rows)
    keys = ["trip_id"]
    if slices.needed:
        keys.append("slice")
        df = with_context(df, STORED_CONTEXT, slices, filter_coordinates(df))
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys, "event_time", "seq")
        .option("path", path)
        .saveAsTable(table)
    )


def read_bucketed(spark: SparkSession, table: str) -> tuple[DataFrame, TripSlices]:
    """A table of ``write_bucketed`` and the slices its rows come in, for ``kinematics`` and
    the like. Its files are sorted; with ``spark.sql.legacy.bucketedTableScan.outputOrdering``
    Spark relies on that and leaves out the sort too."""
    df = spark.table(table)
    if "slice" not in df.columns:
        return df, WHOLE_TRIPS
    return df, TripSlices(None, "trip_id", "event_time", "seq", STORED_CONTEXT)
