"""What values that a topic's schema cannot read look like: their fields, types and counts. Batch only."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def field_report(values: DataFrame, expected: Mapping[str, StructType], topic: str = "topic", value: str = "value") -> DataFrame:
    """``topic, field, type, n, verdict``: one row per field of the JSON objects in ``value``, over all rows of the topic.

    ``type`` is the least type that holds all values of the field, nested objects and arrays spelled out; ``n`` counts the
    objects that have the field, JSON null included. ``verdict`` says how the field relates to the topic's schema: ``known``,
    ``new``, or ``missing`` (in no object; without type). A row without field counts values that are no JSON
    object (``not an object``), NULL among them. Topics without schema have new fields only.

    Values are parsed once, as VARIANT. Fields and types are combined before the one shuffle, of a row per topic, field
    and task; the schemas' own fields join it as rows with no objects, without a join.
    """
    parsed = values.select(topic, F.try_parse_json(F.col(value).cast("string")).alias("_v"))
    shape = F.coalesce(F.schema_of_variant("_v"), F.lit(""))
    parsed = parsed.withColumn("_object", shape.startswith("OBJECT"))
    # an object without fields has nothing to explode, and is counted nowhere
    exploded = values.sparkSession.tvf.variant_explode(F.col("_v").outer())
    fields = parsed.where("_object").lateralJoin(exploded).select(
        topic, F.col("key").alias("field"), F.col("value").alias("_value"), F.lit(1).cast("bigint").alias("_n"), F.lit(0).alias("_known")
    )
    other = parsed.where("NOT _object").select(
        topic, F.lit(None).cast("string").alias("field"), F.lit(None).cast("variant").alias("_value"), F.lit(1).cast("bigint").alias("_n"), F.lit(0).alias("_known")
    )
    names = [(t, name) for t, schema in expected.items() for name in schema.fieldNames()]
    spark = values.sparkSession
    known = spark.createDataFrame(names, f"`{topic}` string, field string").select(
        topic, "field", F.lit(None).cast("variant").alias("_value"), F.lit(0).cast("bigint").alias("_n"), F.lit(1).alias("_known")
    )
    both = reduce(DataFrame.unionByName, (fields, other, known))
    told = both.groupBy(topic, "field").agg(
        F.schema_of_variant_agg("_value").alias("type"), F.sum("_n").alias("n"), F.max("_known").alias("_known")
    )
    verdict = (
        F.when(F.col("field").isNull(), "not an object").when(F.col("_known") == 0, "new").when(F.col("n") == 0, "missing").otherwise("known")
    )
    told_type = F.when(F.col("field").isNotNull() & (F.col("n") > 0), F.col("type"))
    return told.select(topic, "field", told_type.alias("type"), "n", verdict.alias("verdict"))
