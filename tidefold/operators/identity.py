"""Identity resolution: account and device ids to stable user numbers, as aggregates and joins.

A record's account decides its user; an account that first appears with a device which had no
account then adopts the device's user, if it is the first to do so; known bindings never change.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import running_total

#: What stands for the account of a known device's user, of which only the existence matters. No id begins so.
OWNER = "\x00"


def _numbered(values: DataFrame, first: int, rows: int | None) -> DataFrame:
    """Dense numbers of distinct ``u`` in ascending order, from ``first``."""
    return running_total(values, "u", F.lit(1), "user_id", rows).select("u", (F.col("user_id") + first).alias("user_id"))


def assign(
    records: DataFrame, known: DataFrame | None = None, first: int | None = None, rows: int | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame]:
    """Users of the records' accounts (account_id, user_id) and devices (distinct_id, user_id, owned, seq).

    ``records`` has seq, account_id and distinct_id; empty strings are absent ids. ``known`` (user_id,
    account_id, distinct_ids) holds earlier bindings, of these ids at least: it goes before the records as
    rows of its own, and keeps its numbers. New users are numbered from ``first``, by default after the
    largest known one. ``owned`` tells whether a device's user has an account; ``seq`` is the device's first.
    ``rows`` is a bound of the number of new users, if one is known; ``keep`` puts away a frame that is
    read several times.
    """
    ids = records.select("seq", F.coalesce("account_id", F.lit("")).alias("a"), F.coalesce("distinct_id", F.lit("")).alias("d"))
    numbered = None
    if known is not None:
        old = known.select("user_id", F.coalesce("account_id", F.lit("")).alias("a"), F.explode_outer("distinct_ids").alias("d"))
        old = old.withColumn("d", F.coalesce("d", F.lit("")))
        bounds = old.agg(F.max("user_id").alias("top"), F.lit(None).cast("long").alias("low")).unionByName(
            records.agg(F.lit(None).cast("long").alias("top"), F.min("seq").alias("low"))
        )
        top, low = bounds.agg(F.coalesce(F.max("top"), F.lit(0)), F.coalesce(F.min("low"), F.lit(0))).first()
        # all rows of a user stand together, before every record, with the same creation number
        old = old.withColumn("seq", F.lit(min(0, low) - top - 1) + F.col("user_id"))
        numbered = old.select(F.col("seq").alias("u"), "user_id").distinct()
        ids = old.select("seq", "a", "d").unionByName(ids)
        first = top + 1 if first is None else first
    accounts = ids.where("a <> ''").groupBy("a").agg(F.min("seq").alias("s_a"), F.min_by("d", F.struct("seq", "d")).alias("d_a"))
    accounts = keep(accounts)
    devices = ids.where("d <> ''").groupBy("d").agg(F.min("seq").alias("s_d"), F.min_by("a", F.struct("seq", "a")).alias("a_d"))
    devices = keep(devices)
    anonymous = devices.where("a_d = ''").select("d", "s_d")
    claims = accounts.where("d_a <> ''").groupBy("d_a").agg(F.min_by("a", "s_a").alias("claimer"))
    claims = claims.join(anonymous, claims["d_a"] == anonymous["d"]).select("d", F.col("claimer").alias("a"), "s_d")
    of_account = keep(accounts.join(claims.select("a", "s_d"), "a", "left").select("a", F.coalesce("s_d", "s_a").alias("u_a")))
    # the devices with and without a first account apart: a join on an absent account would gather the latter in one task
    bound = devices.where("a_d <> ''").join(of_account, F.col("a_d") == of_account["a"])
    bound = bound.select("d", F.col("u_a").alias("u_d"), F.lit(True).alias("owned"), "s_d")
    free = anonymous.join(claims.select("d", F.lit(True).alias("claimed")), "d", "left")
    of_device = keep(bound.unionByName(free.select("d", F.col("s_d").alias("u_d"), F.coalesce("claimed", F.lit(False)).alias("owned"), "s_d")))
    made = of_account.select(F.col("u_a").alias("u")).unionByName(of_device.select(F.col("u_d").alias("u"))).distinct()
    if numbered is None:
        numbers = _numbered(made, first or 1, rows)
    else:
        numbers = numbered.unionByName(_numbered(made.join(numbered, "u", "left_anti"), first or 1, rows))
    of_account = of_account.where(~F.col("a").startswith(OWNER)).join(numbers, of_account["u_a"] == numbers["u"])
    of_device = of_device.join(numbers, of_device["u_d"] == numbers["u"])
    return (
        of_account.select(F.col("a").alias("account_id"), "user_id"),
        of_device.select(F.col("d").alias("distinct_id"), "user_id", "owned", F.col("s_d").alias("seq")),
    )


def attach(records: DataFrame, accounts: DataFrame, devices: DataFrame) -> DataFrame:
    """Append user_id to records: that of the account, or else of the device; null without either.

    Records with and without an account are joined apart, so none meet under an absent key. A hot
    account's records are one side of a join, which adaptive execution splits.
    """
    with_account = records.where("coalesce(account_id, '') <> ''")
    with_device = records.where("coalesce(account_id, '') = '' and coalesce(distinct_id, '') <> ''")
    nameless = records.where("coalesce(account_id, '') = '' and coalesce(distinct_id, '') = ''")
    columns = [F.col(f"`{c}`") for c in records.columns if c != "user_id"]
    of_account = accounts.select(F.col("account_id").alias("id__"), F.col("user_id").alias("user__"))
    of_device = devices.select(F.col("distinct_id").alias("id__"), F.col("user_id").alias("user__"))
    one = with_account.join(of_account, F.col("account_id") == F.col("id__"), "left").select(*columns, F.col("user__").alias("user_id"))
    two = with_device.join(of_device, F.col("distinct_id") == F.col("id__"), "left").select(*columns, F.col("user__").alias("user_id"))
    return one.unionByName(two).unionByName(nameless.select(*columns, F.lit(None).cast("long").alias("user_id")))


def resolve(records: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Append user_id to records (seq, account_id, distinct_id, ...), given earlier bindings (see ``assign``)."""
    return attach(records, *assign(records, known))


def bindings(accounts: DataFrame, devices: DataFrame) -> DataFrame:
    """(user_id, account_id, distinct_ids) of accounts and devices; a user's devices by their first appearance."""
    lists = devices.groupBy("user_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "distinct_id"))), lambda x: x["distinct_id"]).alias("distinct_ids")
    )
    return accounts.join(lists, "user_id", "full").select(
        "user_id", "account_id", F.coalesce("distinct_ids", F.array().cast("array<string>")).alias("distinct_ids")
    )
