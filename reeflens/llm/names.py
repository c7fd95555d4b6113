"""64-bit names of things that wider keys tell apart."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored

#: ``name(salt)``: 64 bits of a row's key, others for each salt.
Name = Callable[..., Column]


def with_node(rows: DataFrame, by: list[str], name: Name, renamed: DataFrame | None) -> DataFrame:
    """``rows`` with the ``node`` of their key ``by``; a null key has a null node."""
    if renamed is None:
        return rows.withColumn("node", name())
    return rows.join(renamed, by, "left").withColumn("node", F.coalesce("other", name())).drop("other")


def renamed_keys(keys: DataFrame, by: list[str], name: Name) -> DataFrame | None:
    """``(*by, other)``: nodes for the keys whose own one another key has too; None where there are none.

    So different keys are different nodes, while all that is moved by node
    has 64 bits.  ``keys`` may repeat a key; a null key has no node.
    """
    renamed, salt = None, 0
    while True:
        now = with_node(keys.select(*by), by, name, renamed)
        ends = now.groupBy("node").agg(*[F.min(c).alias(f"{c}_lo") for c in by], *[F.max(c).alias(f"{c}_hi") for c in by])
        twice = ends.where(reduce(or_, [F.col(f"{c}_lo") != F.col(f"{c}_hi") for c in by])).where("node is not null").select("node")
        if twice.isEmpty():
            return renamed
        salt += 1
        among = now.join(twice, "node")
        first = among.groupBy("node").agg(F.min(F.struct(*by)).alias("first"))
        again = among.join(first, "node").where(F.struct(*by) != F.col("first")).select(*by, name(salt).alias("other")).distinct()
        if renamed is not None:
            again = renamed.join(again, by, "left_anti").unionByName(again)
        renamed = stored(again, "renamed")
