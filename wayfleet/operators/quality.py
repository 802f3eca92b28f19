"""Value-domain checks and delivery accounting. Batch only, but for ``violations_by_window``."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.operators.dedup import known_by
from wayfleet.schemas import DOMAINS, WATERMARK


def in_domain(column: str, domain: tuple | list) -> Column:
    """True inside the domain; NULL for a missing value, which no rule counts."""
    if isinstance(domain, tuple):
        return F.col(column).between(*domain)
    return F.col(column).isin(domain)


def violations(
    records: Mapping[str, DataFrame], topics: Mapping[str, str], domains: Mapping = DOMAINS
) -> DataFrame:
    """``topic, rule, violations``: one aggregation per record kind covers all its rules."""

    def check(kind: str) -> DataFrame:
        rules = domains[kind]
        counted = records[kind].agg(*(F.count_if(~in_domain(c, d)).alias(c) for c, d in rules.items()))
        return counted.unpivot([], list(rules), "rule", "violations").select(
            F.lit(topics[kind]).alias("topic"), "rule", "violations"
        )

    return reduce(DataFrame.unionByName, map(check, records))


def violations_by_window(
    records: DataFrame, topic: str, rules: Mapping[str, tuple | list], width: str = "1 hour", delay: str = WATERMARK
) -> DataFrame:
    """``topic, window_start, rule, n, violations`` of one record kind, on a table or a stream.

    ``n`` counts the values a rule saw, missing ones left out. On a stream a window comes out, with all its rules, when
    the watermark has passed its end; rows that arrive later are dropped. Rows without time are in no window.
    One aggregation covers all rules; partial counts leave one row per task and window.
    """
    seen = {f"n_{c}": F.count(c) for c in rules}
    bad = {f"bad_{c}": F.count_if(~in_domain(c, d)) for c, d in rules.items()}
    counted = (
        records.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", width).alias("w"))
        .agg(*(f.alias(name) for name, f in {**seen, **bad}.items()))
    )
    each = [F.struct(F.lit(c).alias("rule"), F.col(f"n_{c}").alias("n"), F.col(f"bad_{c}").alias("violations")) for c in rules]
    return counted.select(F.lit(topic).alias("topic"), F.col("w.start").alias("window_start"), F.inline(F.array(*each)))


def topic_counts(log: DataFrame) -> DataFrame:
    """``topic, n`` of anything with a topic column."""
    return log.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def tag_topics(records: Mapping[str, DataFrame], topics: Mapping[str, str]) -> DataFrame:
    """``topic, device_id, timestamp, id, record`` of several frames in one; ``record`` tells records apart, by content
    where they have no id."""
    tagged = (
        df.select(F.lit(topics[kind]).alias("topic"), "id", "device_id", "timestamp", known_by(df).alias("record"))
        for kind, df in records.items()
    )
    return reduce(DataFrame.unionByName, tagged)


def drop_empty(records: DataFrame) -> DataFrame:
    """Without the all-NULL rows that undecodable values leave behind."""
    return records.dropna("all")


def reconcile(produced: DataFrame, landed: DataFrame) -> DataFrame:
    """``topic, produced, landed`` counts side by side, and records that are ``missing``, ``extra`` or ``duplicated``.

    Records are told apart by ``record`` (see ``tag_topics``): missing ones were produced more often than they landed, extra
    ones landed without having been produced, duplicated ones landed more often than they were produced. Each counts
    rows. Rows without id are the same record if all their columns agree, so both sides need the same columns and
    types. A topic of one side counts 0 on the other. Both inputs are counted by record and then by topic, without a join.
    """
    both = produced.select("topic", "record", F.lit(1).alias("p"), F.lit(0).alias("l")).unionByName(
        landed.select("topic", "record", F.lit(0).alias("p"), F.lit(1).alias("l"))
    )
    each = both.groupBy("topic", "record").agg(F.sum("p").alias("p"), F.sum("l").alias("l"))
    more = F.greatest(F.col("l") - F.col("p"), F.lit(0))
    return each.groupBy("topic").agg(
        F.sum("p").alias("produced"),
        F.sum("l").alias("landed"),
        F.sum(F.greatest(F.col("p") - F.col("l"), F.lit(0))).alias("missing"),
        F.sum(F.when(F.col("p") == 0, F.col("l")).otherwise(0)).cast("long").alias("extra"),
        F.sum(F.when(F.col("p") > 0, more).otherwise(0)).cast("long").alias("duplicated"),
    )
