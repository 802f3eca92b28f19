"""What several operators share: words, row keys, lineage cuts, gapless ranks and connected components."""

from __future__ import annotations

import gc
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfleet.session import ensure_checkpoint_dir

#: A word: code points other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Links of a partition while components are sought; few partitions keep the files of many small rounds few.
LINKS = 200_000
#: The columns of ``documents``.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(text: Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(text, F.lit(""))


def row_key(*columns: Column) -> Column:
    """64-bit key of a row; rows that agree in these columns share it. Null and empty differ."""
    marked = [part for column in columns for part in (column.isNull(), column)]
    return F.xxhash64(*marked)


def cut(frame: DataFrame) -> DataFrame:
    """Write the frame to the shared checkpoint folder, so later stages and lost executors read it again."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def sweep(spark: SparkSession) -> None:
    """Let the driver forget frames that nothing refers to any more; Spark then deletes the shuffle files behind them."""
    gc.collect()
    spark._jvm.System.gc()


def without(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame without columns of these names, whatever their case."""
    taken = {name.lower() for name in names}
    return frame.select([frame[f"`{c}`"] for c in frame.columns if c.lower() not in taken])


def gapless(frame: DataFrame, group: str, order: Sequence[str], name: str, rows: int = 50_000) -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... without bringing a group into one task.

    A group is dealt into pieces by the hash of the order columns; each piece is numbered on its own
    and starts where the pieces before it end. ``rows`` is the mean size of a piece.
    """
    pieces = max(64, -(-frame.count() // rows))
    dealt = frame.withColumn("_piece", F.pmod(F.xxhash64(*order), F.lit(pieces)))
    sizes = dealt.groupBy(group, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(group).alias("_group"), F.col("_piece").alias("_start_piece"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(group, "_piece").orderBy(*order)
    numbered = dealt.withColumn("_rank", F.row_number().over(inside) - 1)
    joined = numbered.join(starts, (F.col(group) == F.col("_group")) & (F.col("_piece") == F.col("_start_piece")))
    return joined.withColumn(name, (F.col("_start") + F.col("_rank")).cast("long")).drop(
        "_piece", "_rank", "_start", "_start_piece", "_group"
    )


def ranked(frame: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number all rows from 0 in a total order, by ranges that are counted and numbered apart."""
    ranges = cut(frame.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_start", F.coalesce(F.sum("_n").over(before), F.lit(0))
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        ranges.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(starts.drop("_n"), "_range")
        .withColumn(name, (F.col("_start") + F.col("_rank")).cast("long"))
        .drop("_range", "_rank", "_start")
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``(a, b)`` links: ``(node, root)`` with the least node as root.

    Alternates two star steps until nothing changes: every node hands its larger neighbours, then
    its smaller ones, to the least node it knows. Both are joins on an aggregated minimum, so a node
    with very many neighbours is never gathered in one task.
    """
    links = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    seen, known = None, links.count()
    links = links.coalesce(max(1, -(-known // LINKS)))
    while True:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = (
            both.where("b > a").join(least, F.col("a") == F.col("n"))
            .select(F.col("b").alias("b"), F.col("m").alias("a")).where("a < b").distinct()
        )
        under = large.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("m"))
        small = large.join(under, F.col("b") == F.col("n")).select(
            F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")),
                              F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a < b").distinct()
        links = cut(small.coalesce(max(1, -(-known // LINKS))))
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen, known = now, now[0]
    rooted = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return rooted.union(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
