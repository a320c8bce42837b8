"""User and event operations folded into documents, as windows and aggregates by key.

An operation older than what its document has seen (by ``_ts``) is skipped where its type asks for
that; a running maximum over all rows tells, since skipped rows are below it. The operations of a hot key
are dealt in ranges of ``seq``; maxima, sums and lists are made by range, and what earlier ranges come to
is carried into each, so no key's operations are one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import META_KEYS
from .order import RANGES, cuts_of, range_of

_ALWAYS = ("user_add", "user_append", "user_uniq_append")
_LISTS = ("user_append", "user_uniq_append")
#: A key is hot with more than so many operations, if they are also more than this part of all; so fewer than HOT_KEYS are.
HOT_ROWS, HOT_KEYS = 200_000, 1000


def number_text(x: Column) -> Column:
    """JSON text of a double, whole numbers without a fraction."""
    return F.when((x == F.floor(x)) & (F.abs(x) < 1e15), x.cast("long").cast("string")).otherwise(x.cast("string"))


def elements(json: Column) -> Column:
    """JSON texts of an array's elements; anything else is its own only element."""
    parts = F.from_json(F.when(json.startswith("["), json), "array<variant>")
    return F.coalesce(F.transform(parts, lambda v: F.coalesce(F.to_json(v), F.lit("null"))), F.array(json))


def _earlier(*keys: str, order: str = "seq"):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def hot_keys(ops: DataFrame, key: str, rows: int | None) -> dict:
    """Keys with too many operations for one task, and how many they have. ``rows`` is a bound of all operations, if one is known."""
    if rows is not None and rows <= HOT_ROWS:
        return {}
    counts = ops.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS)
    found = {r[0]: r["n"] for r in counts.orderBy(F.desc("n")).limit(HOT_KEYS).collect()}
    if len(found) < HOT_KEYS:
        return found
    least = ops.count() // HOT_KEYS
    return {k: n for k, n in found.items() if n > least}


def _split(ops: DataFrame, key: str, rows: int | None) -> tuple[DataFrame, DataFrame | None, int]:
    """Operations of common keys, those of hot ones (None if there are none), and how many the latter are."""
    hot = hot_keys(ops, key, rows)
    if not hot:
        return ops, None, 0
    is_hot = F.coalesce(F.col(key).isin(list(hot)), F.lit(False))
    return ops.where(~is_hot), ops.where(is_hot), sum(hot.values())


def _ranged(ops: DataFrame, rows: int) -> DataFrame:
    return ops.withColumn("range", range_of(F.col("seq"), cuts_of(ops, "seq", min(RANGES, -(-rows // HOT_ROWS) + 1))))


def _carried(ops: DataFrame, key: str) -> DataFrame:
    """Append prev, the largest ``_ts`` of earlier operations of the key, and first, the key's first ``seq``, by ranges."""
    by_range = ops.groupBy(key, "range").agg(F.max("_ts").alias("top"), F.min("seq").alias("low"))
    carry = by_range.select(
        key, "range", F.max("top").over(_earlier(key, order="range")).alias("carried"), F.min("low").over(Window.partitionBy(key)).alias("first")
    )
    prev = F.greatest(F.max("_ts").over(_earlier(key, "range")), F.col("carried"))
    return ops.join(carry, [key, "range"]).withColumn("prev", prev).drop("carried")


def _meta(rows: DataFrame, *keys: str) -> DataFrame:
    """Last value of each meta key, and the largest ``_ts``, as a map."""
    one = rows.select(*keys, "seq", F.explode(F.map_filter("doc", lambda k, _: k.isin(*META_KEYS) & (k != "_ts"))).alias("k", "v"))
    last = one.groupBy(*keys, "k").agg(F.max_by("v", "seq").alias("v"))
    top = rows.groupBy(*keys).agg(F.max("_ts").cast("string").alias("v")).withColumn("k", F.lit("_ts"))
    return last.unionByName(top)


def _applied(ops: DataFrame) -> DataFrame:
    """Append counts, whether an operation's data are applied, and passed, whether its meta keys are."""
    fresh = F.col("prev").isNull() | (F.col("_ts") >= F.col("prev"))
    kind = F.col("type")
    counts = F.when(kind.isin(*_ALWAYS), True).when(kind == "user_setOnce", F.col("seq") == F.col("first")).otherwise(fresh)
    passed = F.when(kind.isin(*_ALWAYS, "user_setOnce"), True).otherwise(fresh)
    return ops.withColumn("counts", counts).withColumn("passed", passed)


def _partial(ops: DataFrame, *keys: str) -> DataFrame:
    """By keys and property: at (the last reset), its value, and sums and list steps since."""
    data = ops.where("counts").select(*keys, "seq", "type", F.explode(F.map_filter("doc", lambda k, _: ~k.isin(*META_KEYS))).alias("k", "v"))
    reset = ~F.col("type").isin(*_ALWAYS)
    data = data.withColumn("at", F.max(F.when(reset, F.col("seq"))).over(Window.partitionBy(*keys, "k")))
    data = data.where("at is null or seq >= at")
    step = F.struct("seq", (F.col("type") == "user_uniq_append").alias("uniq"), elements(F.col("v")).alias("items"))
    return data.groupBy(*keys, "k").agg(
        F.max("at").alias("at"),
        F.max(F.when(reset & (F.col("type") != "user_unset"), F.col("v"))).alias("base"),
        F.sum(F.when(F.col("type") == "user_add", F.col("v").try_cast("double"))).alias("added"),
        F.array_sort(F.collect_list(F.when(F.col("type").isin(*_LISTS), step))).alias("steps"),
    )


def _common_users(ops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Operations that counted or passed, and partial values by user and property."""
    by_user = Window.partitionBy("user_id").orderBy("seq")
    ops = ops.withColumn("epoch", F.count(F.when(F.col("type") == "user_del", 1)).over(by_user))
    ops = ops.withColumn("last", F.max("epoch").over(Window.partitionBy("user_id")))
    ops = ops.where("epoch = last and type <> 'user_del'").withColumn("prev", F.max("_ts").over(_earlier("user_id")))
    ops = _applied(ops.withColumn("first", F.min("seq").over(Window.partitionBy("user_id"))))
    return ops, _partial(ops, "user_id")


def _hot_users(ops: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """The same, by ranges of ``seq``, joined range after range."""
    gone = ops.where("type = 'user_del'").groupBy("user_id").agg(F.max("seq").alias("gone"))  # HOT_KEYS rows at most
    ops = ops.join(F.broadcast(gone), "user_id", "left").where("type <> 'user_del' and (gone is null or seq > gone)").drop("gone")
    ops = _applied(_carried(_ranged(ops, rows), "user_id"))
    got = _partial(ops, "user_id", "range")
    last = F.max(F.when(F.col("at").isNotNull(), F.col("range"))).over(Window.partitionBy("user_id", "k"))
    got = got.withColumn("last", last).where("last is null or range >= last").groupBy("user_id", "k").agg(
        F.max("at").alias("at"), F.max("base").alias("base"), F.sum("added").alias("added"), F.array_sort(F.flatten(F.collect_list("steps"))).alias("steps")
    )
    return ops, got


def fold_users(ops: DataFrame, stored: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """(user_id, doc) after operations (user_id, seq, type, doc, _ts).

    ``stored`` (user_id, doc) is the state before; it goes first, as a set. Values of ``user_add``
    that aren't numbers are ignored. A user whose last word is a deletion is absent. ``rows`` is a bound
    of the number of operations, if one is known.
    """
    ops = ops.select("user_id", "seq", "type", "doc", "_ts")
    if stored is not None:
        low = ops.agg(F.min("seq")).first()[0] or 0
        before = F.try_element_at("doc", F.lit("_ts")).try_cast("long")
        ops = stored.select("user_id", F.lit(low - 1).alias("seq"), F.lit("user_set").alias("type"), "doc", before.alias("_ts")).unionByName(ops)
    common, hot, n = _split(ops, "user_id", rows)
    ops, got = _common_users(common)
    meta = _meta(ops.where("passed"), "user_id")
    if hot is not None:
        hot_ops, hot_got = _hot_users(hot, n)
        got, meta = got.unionByName(hot_got), meta.unionByName(_meta(hot_ops.where("passed"), "user_id"))
    start = F.when(F.col("base").isNull(), F.array().cast("array<string>")).otherwise(elements(F.col("base")))

    def union(acc: Column, s: Column) -> Column:
        fresh_items = F.filter(F.array_distinct(s["items"]), lambda x: ~F.array_contains(acc, x))
        return F.concat(acc, F.when(s["uniq"], fresh_items).otherwise(s["items"]))

    listed = F.concat(F.lit("["), F.array_join(F.aggregate("steps", start, union), ","), F.lit("]"))
    total = number_text(F.coalesce(F.col("base").try_cast("double"), F.lit(0.0)) + F.col("added"))
    value = F.when(F.size("steps") > 0, listed).when(F.col("added").isNotNull(), total).otherwise(F.col("base"))
    fields = got.select("user_id", "k", value.alias("v")).where("v is not null")
    return _documents(fields.unionByName(meta.where("k <> '#user_id'")), "user_id")


def fold_events(ops: DataFrame, stored: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """(uuid, doc) after event operations (uuid, seq, type, doc, _ts).

    ``track`` (and unknown types) insert only the first time; ``track_update`` merges and
    ``track_overwrite`` replaces, unless older than the document. ``rows`` is as in ``fold_users``.
    """
    ops = ops.select("uuid", "seq", "type", "doc", "_ts")
    if stored is not None:
        low = ops.agg(F.min("seq")).first()[0] or 0
        before = F.try_element_at("doc", F.lit("_ts")).try_cast("long")
        ops = stored.select("uuid", F.lit(low - 1).alias("seq"), F.lit("track_overwrite").alias("type"), "doc", before.alias("_ts")).unionByName(ops)
    common, hot, n = _split(ops, "uuid", rows)
    changes = F.col("type").isin("track_update", "track_overwrite")
    overwritten = F.when(F.col("type") == "track_overwrite", F.col("seq"))
    kept = common.withColumn("nth", F.row_number().over(Window.partitionBy("uuid").orderBy("seq"))).where(changes | (F.col("nth") == 1))
    kept = kept.withColumn("prev", F.max("_ts").over(_earlier("uuid"))).where("prev is null or _ts >= prev")
    kept = kept.withColumn("at", F.max(overwritten).over(Window.partitionBy("uuid"))).select("uuid", "seq", "doc", "at")
    if hot is not None:
        first = hot.groupBy("uuid").agg(F.min("seq").alias("first"))  # HOT_KEYS rows at most, as below
        rest = hot.join(F.broadcast(first), "uuid").where(changes | (F.col("seq") == F.col("first"))).drop("first")
        rest = _carried(_ranged(rest, n), "uuid").where("prev is null or _ts >= prev")
        at = rest.groupBy("uuid").agg(F.max(overwritten).alias("at"))
        kept = kept.unionByName(rest.join(F.broadcast(at), "uuid").select("uuid", "seq", "doc", "at"))
    kept = kept.where("at is null or seq >= at")
    fields = kept.select("uuid", "seq", F.explode("doc").alias("k", "v")).groupBy("uuid", "k").agg(F.max_by("v", "seq").alias("v"))
    return _documents(fields, "uuid")


def _documents(fields: DataFrame, key: str) -> DataFrame:
    entries = F.array_sort(F.collect_list(F.struct("k", "v")))
    return fields.groupBy(key).agg(F.map_from_entries(entries).alias("doc"))
