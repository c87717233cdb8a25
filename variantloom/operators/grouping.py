"""Skew-safe building blocks: chunked running totals, ranks, paged nesting, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

PAGE_SIZE = 1000
CHUNK_SIZE = 4096


def running_total_before(
    df: DataFrame, keys: Sequence[str], order: str, value: Column, out: str, chunk: int = CHUNK_SIZE
) -> DataFrame:
    """Sum of ``value`` over the rows of the same keys that come earlier in the whole number ``order``.

    A plain window would sort all rows of a key in one task. Here a key is cut into ranges of ``order``:
    range totals (partial aggregation) get their own small window, rows are ordered only within their
    range, and both sums are added."""
    keys = list(keys)
    start = F.col(order) - F.pmod(F.col(order), F.lit(chunk))
    ranged = df.withColumn("_range", start).withColumn("_value", value)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy(*keys, "_range").agg(F.sum("_value").alias("_total"))
        .withColumn("_earlier", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .drop("_total")
    )
    inside = (
        Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .join(totals, [*keys, "_range"])
        .withColumn(out, F.col("_inside") + F.col("_earlier"))
        .drop("_range", "_value", "_inside", "_earlier")
    )


def unnest(df: DataFrame, keep: Sequence[str | Column], structs: str | Column, present: str) -> DataFrame:
    """One row per struct of an array; ``present`` is a member that is never null.

    The outer form with a filter behind it: for the inner form Spark infers a filter on the array and pushes
    it below, which would evaluate a computed array twice."""
    return df.select(*keep, F.inline_outer(structs)).where(F.col(present).isNotNull())


def settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a computed column that is evaluated once: filters on it are not pushed into its definition."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def page_of(member: Column, page_size: int = PAGE_SIZE) -> Column:
    """Page of a nested list, from a dense whole number such as the sample column index."""
    return F.floor(member / F.lit(page_size)).cast("bigint")


def nest(
    df: DataFrame, keys: Sequence[str], member: str, fields: Sequence[str | Column], out: str,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """Rows -> one sorted array of structs per (keys, page).

    ``member`` is a whole number; a page covers ``page_size`` consecutive values of it, so no task ever
    holds more than one page of a key however many rows the key has. Keys with small members have
    exactly one page."""
    struct = F.struct(F.col(member), *[F.col(f) if isinstance(f, str) else f for f in fields])
    return (
        df.groupBy(*keys, page_of(F.col(member), page_size).alias("page"))
        .agg(F.array_sort(F.collect_list(struct)).alias(out))
    )


def member_rank(df: DataFrame, keys: Sequence[str], member: str, out: str) -> DataFrame:
    """Adds ``out``: a dense rank from 0 of a text member among those of its key, in order of their md5.

    Members of a key are distinct. They are dealt into up to 65536 ranges of their md5: counts per range (partial
    aggregation) are added up in front of it, and only the members of one range are ordered in one task, so a key that
    holds most rows is spread."""
    keys = list(keys)
    dealt = df.withColumn("_md5", F.md5(F.col(member).cast("binary"))).withColumn("_range", F.substring("_md5", 1, 4))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    totals = totals.withColumn("_earlier", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, "_range").orderBy("_md5", member)
    ranked = dealt.withColumn("_inside", F.row_number().over(inside) - 1)
    return ranked.join(totals, [*keys, "_range"]).withColumn(out, (F.col("_earlier") + F.col("_inside")).cast("bigint")).drop(
        "_md5", "_range", "_inside", "_earlier")


def nest_members(
    df: DataFrame, keys: Sequence[str], member: str, fields: Sequence[str | Column], out: str, page_size: int = PAGE_SIZE,
) -> DataFrame:
    """As ``nest`` for a text member: pages of ``page_size`` members in order of their md5, sorted inside by member."""
    struct = F.struct(F.col(member), *[F.col(f) if isinstance(f, str) else f for f in fields])
    return (
        member_rank(df, keys, member, "_rank").groupBy(*keys, page_of(F.col("_rank"), page_size).alias("page"))
        .agg(F.array_sort(F.collect_list(struct)).alias(out))
    )


def first_by_content(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: of several the least by its other columns, whatever the partitions. Maps have no order; rows
    that differ in nothing else are told apart by their JSON text."""
    others = [f for f in df.schema.fields if f.name not in keys]
    order = [F.col(f.name) for f in others if "map<" not in f.dataType.simpleString()]
    if len(order) < len(others):
        order.append(F.to_json(F.struct(*[f.name for f in others])))
    return last_by_key(df, keys, order or [F.lit(0)])


def last_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The one row per key that is last in ``order``.

    Spark limits each key to one row before the exchange (group limit), so repeated keys do not travel."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
