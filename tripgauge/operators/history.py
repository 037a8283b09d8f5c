"""Upserts: replace a document by key, or merge points into a bounded history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgauge.functions.columns import first_truthy_number, parse_time
from tripgauge.profiles import KEEP_POINTS

PROMOTED = ("avg_speed_kmh", "max_speed_kmh", "global_risk_score", "processed_at")


def latest_by_key(df: DataFrame, key: str, version: str, first: str) -> DataFrame:
    """The row with the highest ``version`` per key, and the lowest version the key
    was ever seen with as ``first``."""
    payload = [c for c in df.columns if c not in (key, first)]
    seen = F.coalesce(F.col(first), F.col(version)) if first in df.columns else F.col(version)
    # Both windows share one exchange and one sort; an aggregate of whole documents
    # would sort them on either side of it.
    versions = Window.partitionBy(key)
    return (
        df.select(
            key, *payload, F.min(seen).over(versions).alias(first),
            F.row_number().over(versions.orderBy(F.desc(version))).alias("_nth"),
        )
        .filter(F.col("_nth") == 1)
        .drop("_nth")
    )


def replace_documents(existing: DataFrame, updates: DataFrame, key: str = "trip_id") -> DataFrame:
    """``existing`` with every document of ``updates`` put in whole, by key. Both carry
    ``batch_id``; a replaced document keeps the ``created_seq`` of its first insert."""
    both = existing.unionByName(updates, allowMissingColumns=True)
    return latest_by_key(both, key, "batch_id", "created_seq")


def with_trip_id(documents: DataFrame) -> DataFrame:
    """Documents that name a trip."""
    return documents.filter(F.coalesce(F.col("trip_id"), F.lit("")) != "")


def promote_metrics(documents: DataFrame, as_of: Column) -> DataFrame:
    """Copy the nested headline metrics to the root and stamp the processing time."""
    return documents.withColumns({
        "avg_speed_kmh": F.col("basic.avg_speed_kmh"),
        "max_speed_kmh": F.col("basic.max_speed_kmh"),
        "global_risk_score": F.col("risk.score"),
        "processed_at": as_of,
    })


def structured_points(documents: DataFrame, as_of: Column) -> DataFrame:
    """One row per incoming point, with its time parsed and its speed as a number. A
    point may have any of the fields read here."""
    p = F.col("p")
    fields = documents.schema["points"].dataType.elementType.fieldNames()

    def given(name: str) -> Column:
        return (p[name] if name in fields else F.lit(None)).cast("string")

    time_given = F.coalesce(F.when(given("timestamp") != "", given("timestamp")), given("time"))
    speed = first_truthy_number(given("speed"), given("avg_speed_kmh"), given("max_speed_kmh"))
    return (
        documents.select("trip_id", "doc_seq", F.posexplode("points").alias("pos", "p"))
        .select(
            "trip_id",
            parse_time(time_given, as_of).alias("timestamp"),
            speed.alias("avg_speed_kmh"),
            speed.alias("max_speed_kmh"),
            "doc_seq",
            "pos",
        )
    )


def latest_fields(documents: DataFrame) -> DataFrame:
    """One row per trip: every field from the trip's last document that has it, the
    promoted ones from the last document of all.

    Which documents that takes is found on numbers alone; only those, a few per trip,
    meet in a window.
    """
    fields = [c for c in documents.columns if c not in ("trip_id", "doc_seq", *PROMOTED)]
    present = [F.when(F.col(c).isNotNull(), F.col("doc_seq")) for c in fields]
    needed = F.array(*[F.max(seq) for seq in (*present, F.col("doc_seq"))])
    wanted = documents.groupBy("trip_id").agg(F.array_distinct(needed).alias("seqs"))
    rows = documents.join(
        wanted.select("trip_id", F.explode("seqs").alias("doc_seq")), ["trip_id", "doc_seq"], "left_semi"
    )
    in_order = Window.partitionBy("trip_id").orderBy("doc_seq")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumns({
            **{c: F.last(c, ignorenulls=True).over(so_far) for c in fields},
            "_later": F.lead("doc_seq").over(in_order),
        })
        .filter(F.col("_later").isNull())
        .drop("_later", "doc_seq")
    )


def changed_histories(
    existing: DataFrame,
    batch: DataFrame,
    as_of: Column,
    keep: int = KEEP_POINTS,
    dedupe: bool = False,
) -> DataFrame:
    """The histories of the trips a batch of documents names, after applying it.

    A field keeps its stored value where no document of the batch has it; headline
    metrics and processing time follow the last document in ``doc_seq`` order. Points are
    pushed, sorted by time and cut to the newest ``keep``. A replayed batch pushes its
    points again unless ``dedupe`` drops those with equal time and speed.

    Points are ranked as rows and only the ``keep`` newest are gathered, so neither a
    large batch for one trip nor a long history meets in an array.
    """
    documents = with_trip_id(batch).withColumn("doc_seq", F.coalesce("doc_seq", F.lit(0).cast("long")))
    touched = existing.join(documents.select("trip_id"), "trip_id", "left_semi")
    before = F.lit(-1).cast("long").alias("doc_seq")
    stored = touched.select("trip_id", F.posexplode("points").alias("pos", "p")).select(
        "trip_id", "p.timestamp", "p.avg_speed_kmh", "p.max_speed_kmh", before, "pos"
    )
    points = stored.unionByName(structured_points(documents, as_of))
    if dedupe:
        value = ["trip_id", "timestamp", "avg_speed_kmh", "max_speed_kmh"]
        points = points.groupBy(*value).agg(F.min(F.struct("doc_seq", "pos")).alias("o")).select(
            *value, "o.doc_seq", "o.pos"
        )
    order = ["timestamp", "doc_seq", "pos"]
    newest = Window.partitionBy("trip_id").orderBy(*[F.desc(c) for c in order])
    item = F.struct(*order, "avg_speed_kmh", "max_speed_kmh")
    kept = (
        points.withColumn("rn", F.row_number().over(newest))
        .filter(F.col("rn") <= keep)
        .groupBy("trip_id")
        .agg(F.array_sort(F.collect_list(item)).alias("points"))
        .withColumn("points", F.transform("points", lambda p: F.struct(
            p["timestamp"].alias("timestamp"),
            p["avg_speed_kmh"].alias("avg_speed_kmh"),
            p["max_speed_kmh"].alias("max_speed_kmh"),
        )))
    )
    news = promote_metrics(documents, as_of).drop("points")
    fields = latest_fields(
        news.unionByName(touched.drop("points").withColumn("doc_seq", before), allowMissingColumns=True)
    )
    empty = F.array().cast(existing.schema["points"].dataType)
    return fields.join(kept, "trip_id", "left").withColumn("points", F.coalesce("points", empty))


def merge_history(
    existing: DataFrame,
    batch: DataFrame,
    as_of: Column,
    keep: int = KEEP_POINTS,
    dedupe: bool = False,
) -> DataFrame:
    """All stored histories after a batch of documents; see ``changed_histories``."""
    changed = changed_histories(existing, batch, as_of, keep, dedupe)
    untouched = existing.join(with_trip_id(batch).select("trip_id"), "trip_id", "left_anti")
    return changed.unionByName(untouched, allowMissingColumns=True)
