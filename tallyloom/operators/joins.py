"""Joins to lookups, to per-group values and to key lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.session import durable

def lookup_join(df: DataFrame, lookup: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Left equi-join; ``on`` maps a column of ``df`` to one of ``lookup``.

    NULL never matches.  The lookup's key columns are dropped from the result.  Its size in bytes at
    run time decides whether it is broadcast, so nothing is counted while the plan is made.
    """
    keys = {right: f"__lookup_{right}" for right in on.values()}
    renamed = lookup.withColumnsRenamed(keys)
    condition = reduce(and_, [df[left] == renamed[keys[right]] for left, right in on.items()])
    return df.join(renamed, condition, "left").drop(*keys.values())


def same_group(left: DataFrame, right: DataFrame, pairs: Mapping[str, str]) -> Column:
    """Null-safe equality over several column pairs, usable as a hash or merge join key."""
    return reduce(and_, [left[a].eqNullSafe(right[b]) for a, b in pairs.items()])


def attach_group_values(df: DataFrame, keys: Sequence[str], **values: Column) -> DataFrame:
    """Add per-group aggregates to every row; NULL keys form one group.

    The aggregate is combined before its shuffle, holds one row per group and is stored.  Its real
    size then decides the join: few groups are broadcast and the rows stay where they are, many
    groups take a shuffled join that is split where it is skewed.  A group with a large part of
    all rows is never gathered in one task, as it would be by a window over that group.
    """
    renamed = {key: f"__group_{key}" for key in keys}
    per_group = durable(
        df.groupBy(*keys)
        .agg(*[value.alias(name) for name, value in values.items()])
        .withColumnsRenamed(renamed),
        "groups",
    )
    return df.join(per_group, same_group(df, per_group, renamed), "left").drop(*renamed.values())


def count_unlisted(
    df: DataFrame, keys: Sequence[str], member: str, listed: DataFrame, listed_column: str,
    relevant: Column, **counts: Column,
) -> DataFrame:
    """Per group: how many relevant rows carry a member that is not on the list.

    Further ``counts`` are conditional counts over the same groups.
    """
    members = listed.select(F.col(listed_column).alias("__listed")).distinct()
    members = members.filter(F.col("__listed").isNotNull())
    joined = df.join(members, df[member] == members["__listed"], "left")
    unlisted = relevant & F.col(member).isNotNull() & F.col("__listed").isNull()
    return joined.groupBy(*keys).agg(
        *[F.count_if(condition).alias(name) for name, condition in counts.items()],
        F.count_if(unlisted).alias("unlisted"),
    )


def without_mirrored(
    df: DataFrame, others: DataFrame, on: Sequence[str]
) -> DataFrame:
    """Drop the rows that have a twin in ``others`` on all of ``on``; NULL has no twin.

    The other side is reduced to its distinct keys first, so repeated twins cost nothing.
    """
    return df.join(others.select(*on).distinct(), on=list(on), how="left_anti")


def reconcile_keys(left: DataFrame, right: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """Full reconciliation of two keyed lists: ``changed``, ``same``, ``only_left``, ``only_right``."""
    a = left.select(F.col(key).alias("__left_key"), *[F.col(c).alias(f"left_{c}") for c in compare])
    b = right.select(
        F.col(key).alias("__right_key"), *[F.col(c).alias(f"right_{c}") for c in compare]
    )
    joined = a.join(b, a["__left_key"] == b["__right_key"], "full_outer")
    same = reduce(and_, [F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}")) for c in compare])
    status = (
        F.when(F.col("__right_key").isNull(), "only_left")
        .when(F.col("__left_key").isNull(), "only_right")
        .when(same, "same")
        .otherwise("changed")
    )
    return joined.select(
        F.coalesce("__left_key", "__right_key").alias(key),
        status.alias("status"),
        *[F.col(f"left_{c}") for c in compare],
        *[F.col(f"right_{c}") for c in compare],
    )
