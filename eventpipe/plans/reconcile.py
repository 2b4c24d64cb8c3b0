"""Do stored images, image rows and image counts agree?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventpipe.operators.routing import IMAGE

MEASURES = ("n_objects", "n_rows", "n_counted")


def _measure(total: DataFrame, name: str) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return total.select(*[F.col("total") if m == name else zero.alias(m) for m in MEASURES]).toDF(*MEASURES)


def is_image_row() -> Column:
    return (F.col("event_type") == IMAGE) & F.col("image_object_key").isNotNull()


def count_image_rows(processed: DataFrame) -> DataFrame:
    return processed.where(is_image_row()).agg(F.count("*").alias("total"))


def sum_image_counts(counts: DataFrame) -> DataFrame:
    """Zero and not NULL where there is no window.

    Other types are left out of the sum, not of the rows: a filter would move below the counts, and closed windows
    could no longer take one pass over the events twice.
    """
    images = F.when(F.col("event_type") == IMAGE, F.col("event_count"))
    return counts.agg(F.coalesce(F.sum(images), F.lit(0)).cast("bigint").alias("total"))


def reconcile_images(listed: DataFrame, processed: DataFrame, counts: DataFrame) -> DataFrame:
    """One row: number of objects, of rows, of counted events, and the verdict.

    The verdict is on objects and rows. The counted events may well be more:
    they hold images without bytes and repeats, and lack windows still open.
    """
    objects = _measure(listed.agg(F.count("*").alias("total")), "n_objects")
    return _verdict(objects.unionByName(_measure(count_image_rows(processed), "n_rows")), counts)


def reconcile_totals(totals: DataFrame, counts: DataFrame) -> DataFrame:
    """The same from one row (n_objects, n_rows)."""
    return _verdict(totals.withColumn("n_counted", F.lit(0).cast("bigint")), counts)


def image_totals(totals: DataFrame) -> DataFrame:
    """Numbers of stored objects and of image rows, from totals that are kept up to date; reads no objects and no rows."""
    return totals.agg(
        F.coalesce(F.sum("n_objects"), F.lit(0)).alias("n_objects"), F.coalesce(F.sum("n_image_rows"), F.lit(0)).alias("n_rows")
    )


def _verdict(measured: DataFrame, counts: DataFrame) -> DataFrame:
    three = measured.unionByName(_measure(sum_image_counts(counts), "n_counted"))
    return three.agg(*[F.sum(m).alias(m) for m in MEASURES]).select(
        *MEASURES,
        (F.col("n_objects") - F.col("n_rows")).alias("diff"),
        (F.col("n_objects") == F.col("n_rows")).alias("matches"),
    )
