"""Merge successive listings of one source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_listings(
    old: DataFrame, fresh: DataFrame, at: str = "fetchedAt", ties: Sequence[str] = ()
) -> DataFrame:
    """Per name of the fresh listing, the whole entry listed first.

    At equal times the old listing wins, then the order of ``ties``. Names that are only
    in the old listing are dropped. One shuffle on the name does the merge and the drop;
    each map task first reduces a name to one entry, so a name listed very often is cheap.
    """
    both = old.withColumn("_fresh", F.lit(0)).unionByName(fresh.withColumn("_fresh", F.lit(1)))
    entry = F.struct(*[F.col(c) for c in old.columns])
    first = F.struct(F.col(at), F.col("_fresh"), *[F.col(c) for c in ties])
    return (
        both.groupBy("name")
        .agg(F.min_by(entry, first).alias("_entry"), F.max("_fresh").alias("_listed"))
        .where("_listed = 1")
        .select("_entry.*")
    )


def unique_index(index: DataFrame, at: str = "fetchedAt", ties: Sequence[str] | None = None) -> DataFrame:
    """One entry per name: the one listed first, at equal times by ``ties``.

    Without ``ties`` all other columns that can be ordered break them, so two runs agree.
    """
    if ties is None:
        ties = [c for c, kind in index.dtypes if c not in ("name", at) and not kind.startswith(("map", "variant"))]
    entry = F.struct(*[F.col(c) for c in index.columns])
    first = F.struct(F.col(at), *[F.col(c) for c in ties])
    return index.groupBy("name").agg(F.min_by(entry, first).alias("_entry")).select("_entry.*")
