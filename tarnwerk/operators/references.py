"""References to records that do not exist (problem 2).

Parent and child keys are brought into one long form, tagged, and grouped by parent table and key. A group tells
whether its parent exists, when it first arrived and when it was deleted, and how many children it has and when.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwerk.functions.scalars import norm_id
from tarnwerk.operators.joins import first_delivery, hot_split_join
from tarnwerk.operators.lineage import cut


@dataclass(frozen=True)
class Reference:
    """A column of a child table that names a key of a parent table."""

    table_name: str
    field_name: str
    parent: str


@dataclass(frozen=True)
class Parent:
    """A parent table: its key column and the times of its arrival and deletion."""

    name: str
    frame: DataFrame
    key: str
    deleted: str | None = None
    arrived: str = "loaded_at"


def children(table_name: str, df: DataFrame, record: str, fields: dict[str, str], arrived: str = "loaded_at") -> DataFrame:
    """Long form of the references of one child table: one row per record and field that is not null.

    fields: of each referring column, its parent table. Records without an id are left out; a record delivered
    again counts by its first arrival.
    """
    one = first_delivery(df, record, list(fields), arrived)
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.lit(p).alias("parent"), norm_id(F.col(f)).alias("key")) for f, p in fields.items()]))
    return one.select(F.lit(table_name).alias("table_name"), F.col(record).cast("bigint").alias("record_id"), F.col(arrived).alias("arrived"), each.alias("r")).select("table_name", "record_id", "arrived", "r.*").where(F.col("key").isNotNull())


def find_orphans(child_rows: DataFrame, parents: Sequence[Parent]) -> DataFrame:
    """One row per orphan reference: table_name, record_id, field_name, orphan_kind, load_month.

    ``missing``: no parent row has the key. ``late``: the parent's first arrival is after that of the child.
    ``deleted``: every row of the parent was deleted at or before the child's arrival. Nulls: a child with no arrival
    time can only be missing; a parent row with no key is ignored. Repeated parents count by their first arrival.
    Empty inputs give an empty result.

    Children of one key are pre-aggregated before the shuffle, so a key with a third of all rows costs one row per
    map task; only keys that may have orphans go back to the records, the hot ones by broadcast (hot_split_join).
    """
    tagged = [
        child_rows.groupBy("parent", "key").agg(F.count(F.lit(1)).alias("n"), F.min("arrived").alias("lo"), F.max("arrived").alias("hi")).select(
            "parent", "key", "n", "lo", "hi", F.lit(False).alias("is_parent"), F.lit(None).cast("timestamp_ntz").alias("first_in"), F.lit(None).cast("timestamp_ntz").alias("gone"), F.lit(False).alias("alive")
        )
    ]
    for p in parents:
        gone = F.col(p.deleted) if p.deleted else F.lit(None).cast("timestamp_ntz")
        tagged.append(
            p.frame.select(
                F.lit(p.name).alias("parent"), norm_id(F.col(p.key)).alias("key"), F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("timestamp_ntz").alias("lo"), F.lit(None).cast("timestamp_ntz").alias("hi"),
                F.lit(True).alias("is_parent"), F.col(p.arrived).alias("first_in"), gone.alias("gone"), gone.isNull().alias("alive"),
            ).where(F.col("key").isNotNull())
        )
    long = tagged[0]
    for t in tagged[1:]:
        long = long.unionByName(t)
    keys = long.groupBy("parent", "key").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.bool_or("is_parent").alias("has_parent"),
        F.min("first_in").alias("first_in"), F.max("gone").alias("gone"), F.bool_or("alive").alias("alive"),
    )
    gone = F.when(~F.col("alive"), F.col("gone"))
    suspect = keys.where((F.col("n") > 0) & (~F.col("has_parent") | (F.col("first_in") > F.col("lo")) | (gone <= F.col("hi")))).select(
        "parent", "key", "n", "has_parent", "first_in", gone.alias("gone")
    )
    # Counted, then joined twice: the suspect keys are cut, so the grouping runs once.
    suspect = cut(suspect)
    back = hot_split_join(child_rows, suspect, ["parent", "key"], "n")
    kind = F.when(~F.col("has_parent"), "missing").when(F.col("first_in") > F.col("arrived"), "late").when(F.col("gone") <= F.col("arrived"), "deleted")
    return back.select("table_name", "record_id", "field_name", kind.alias("orphan_kind"), F.date_format("arrived", "yyyy-MM").alias("load_month")).where(F.col("orphan_kind").isNotNull())


def count_orphans(orphans: DataFrame) -> DataFrame:
    """Orphans per table, field, kind and load month; sums are combined before the shuffle."""
    return orphans.groupBy("table_name", "field_name", "orphan_kind", "load_month").agg(F.count(F.lit(1)).alias("orphans"))
