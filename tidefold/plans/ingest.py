"""From lines to state: parse, filter, resolve identities, fold; one commit for each batch.

A batch reads and rewrites only what its ids touch: the buckets of its users and changed events, and the
identity index of its accounts and devices, which is only added to, as dead letters and new events are.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import dead_letters, parse_lines, routing_key
from ..functions.rules import keep_record
from ..operators.folds import fold_events, fold_users
from ..operators.identity import OWNER, assign, attach, bindings
from .store import Store, Transaction, bucket_of

#: Index tables of the identities, from which ``id_mapping`` is made when it is read.
ACCOUNTS, DEVICES = "id_account", "id_device"


@dataclass
class UploadResult:
    lines: int = 0
    events: int = 0
    users: int = 0
    filtered: int = 0
    dead_letters: int = 0
    filter_errors: int = 0
    write_errors: int = 0

    def to_dict(self) -> dict[str, int]:
        return asdict(self)

    def __add__(self, other: UploadResult) -> UploadResult:
        return UploadResult(*(a + b for a, b in zip(asdict(self).values(), asdict(other).values(), strict=True)))


def classify(lines: DataFrame, include: list[str] = (), exclude: list[str] = (), ts: str | None = None) -> DataFrame:
    """Parsed records with ``kind``: event, user, filtered or error; filtered rows get no identity."""
    parsed = parse_lines(lines, ts=ts)
    kept, failed = keep_record(list(include), list(exclude), F.col("doc"))
    valid = F.col("error").isNull()
    parsed = parsed.withColumn("filter_failed", valid & failed)
    return parsed.withColumn("kind", F.when(~valid, "error").when(~kept, "filtered").otherwise(F.col("category")))


def statistics(classified: DataFrame, *more: Column) -> DataFrame:
    return classified.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if("filter_failed").alias("failed"), *more)


def ingest(
    store: Store, lines: DataFrame, include: list[str] = (), exclude: list[str] = (), ts: str | None = None, stream: str = "", batch: int | None = None, workers: int | None = None
) -> UploadResult:
    """Fold one batch of lines (line, seq from 1 on) into the store.

    Sequence numbers go on from the store's, and ``_ts`` with them unless ``ts`` names a column. A batch
    whose number isn't above the last one committed for its stream changes nothing. If another writer
    commits what this batch read, the batch is made again on top of it. With ``workers``, records are
    dealt to so many tasks by their routing key.
    """

    def change(tx: Transaction) -> UploadResult:
        if batch is not None:
            if tx.base.batches.get(stream, -1) >= batch:
                return UploadResult()
            tx.batches[stream] = batch
        start = tx.base.counters.get("seq", 0)
        records = classify(lines.withColumn("seq", F.col("seq") + F.lit(start)), include, exclude, ts)
        if workers:
            records = records.repartition(workers, routing_key())
        return _fold(tx, tx.stage(records), start)

    return store.update(change)


def _buckets(key: Column, n: int) -> Column:
    return F.collect_set(bucket_of(F.when(key != "", key), n))


def _fold(tx: Transaction, records: DataFrame, start: int) -> UploadResult:
    good = F.col("kind").isin("event", "user")
    counts = statistics(
        records,
        F.max("seq").alias("top"),
        _buckets(F.when(good, F.col("account_id")), tx.buckets(ACCOUNTS)).alias("accounts"),
        _buckets(F.when(good, F.col("distinct_id")), tx.buckets(DEVICES)).alias("devices"),
        _buckets(F.when(F.col("kind") == "event", F.col("uuid")), tx.buckets("event")).alias("events"),
    )
    found = {r["kind"]: r for r in counts.collect()}
    n = lambda k: found[k]["n"] if k in found else 0
    union = lambda name: sorted({b for r in found.values() for b in r[name]})
    result = UploadResult(sum(r["n"] for r in found.values()), n("event"), n("user"), n("filtered"), n("error"), sum(r["failed"] for r in found.values()))
    if found:
        tx.counters["seq"] = max([start, *(r["top"] for r in found.values())])
    if n("error"):
        tx.append("dead_letter", dead_letters(records))
    if not n("event") + n("user"):
        return result
    valid = records.where(good)
    accounts, devices = _identities(tx, valid, 2 * result.lines, (bool(union("accounts")), bool(union("devices"))), *_known(tx, valid, union("accounts"), union("devices")))
    whole = F.map_concat(F.map_filter("doc", lambda k, _: k != "#user_id"), F.create_map(F.lit("#user_id"), F.col("user_id").cast("string")))
    resolved = tx.stage(attach(valid, accounts, devices).withColumn("doc", whole))
    if n("user"):
        _users(tx, resolved.where("kind = 'user'"), n("user"))
    if n("event"):
        _events(tx, resolved.where("kind = 'event'"), union("events"), n("event"))
    return result


def _known(tx: Transaction, valid: DataFrame, account_buckets: list[int], device_buckets: list[int]) -> list[DataFrame]:
    """Earlier accounts and devices that the batch names, from the buckets that can hold them."""
    spark = valid.sparkSession
    accounts, devices = tx.read(ACCOUNTS, account_buckets), tx.read(DEVICES, device_buckets)
    if accounts is None or not account_buckets:
        accounts = spark.createDataFrame([], "account_id string, user_id long")
    else:
        accounts = tx.stage(accounts.join(valid.select("account_id").distinct(), "account_id", "left_semi"))
    if devices is None or not device_buckets:
        devices = spark.createDataFrame([], "distinct_id string, user_id long, owned boolean, seq long")
    else:
        devices = tx.stage(current_devices(devices.join(valid.select("distinct_id").distinct(), "distinct_id", "left_semi")))
    return [accounts, devices]


def current_devices(rows: DataFrame) -> DataFrame:
    """A device's row is added again when its user gets an account."""
    return rows.groupBy("distinct_id").agg(F.min("user_id").alias("user_id"), F.max("owned").alias("owned"), F.min("seq").alias("seq"))


def _identities(tx: Transaction, valid: DataFrame, most_new: int, named: tuple[bool, bool], old_accounts: DataFrame, old_devices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Users of the batch's accounts and devices; new bindings go to the index."""
    owner = F.when(F.col("owned"), F.concat(F.lit(OWNER), F.col("user_id").cast("string")))
    known = old_accounts.select("user_id", "account_id", F.array().cast("array<string>").alias("distinct_ids")).unionByName(
        old_devices.select("user_id", owner.alias("account_id"), F.array("distinct_id").alias("distinct_ids"))
    )
    top = tx.base.counters.get("user_id", 0)
    accounts, devices = map(tx.stage, assign(valid, known, top + 1, most_new, tx.stage))
    new_accounts = accounts.join(old_accounts.select("account_id"), "account_id", "left_anti")
    had = old_devices.select("distinct_id", F.col("owned").alias("had"))
    new_devices = devices.join(had, "distinct_id", "left").where("had is null or (owned and not had)").drop("had")
    count, most = accounts.select("user_id").unionByName(devices.select("user_id")).agg(F.count(F.lit(1)), F.max("user_id")).first()
    if count:
        tx.counters["user_id"] = max(top, most)
        if named[0]:
            tx.append(ACCOUNTS, new_accounts, "account_id")
        if named[1]:
            tx.append(DEVICES, new_devices, "distinct_id")
        tx.reads.update((ACCOUNTS, DEVICES))
    return accounts, devices


def _users(tx: Transaction, ops: DataFrame, rows: int) -> None:
    """Fold operations into the buckets of their users; the other users of a bucket are copied as they are."""
    touched = [r[0] for r in ops.select(bucket_of(F.col("user_id"), tx.buckets("user"))).distinct().collect()]
    stored = tx.read("user", touched)
    if stored is None:
        tx.rewrite("user", fold_users(ops, rows=rows), touched, "user_id")
        return
    keys = ops.select("user_id").distinct()
    folded = fold_users(ops, stored.join(keys, "user_id", "left_semi"), 2 * rows)
    tx.rewrite("user", folded.unionByName(stored.join(keys, "user_id", "left_anti").select("user_id", "doc")), touched, "user_id")


def _events(tx: Transaction, ops: DataFrame, touched: list[int], rows: int) -> None:
    """New events are added; only buckets with changes of stored events are rewritten."""
    stored = tx.read("event", touched)
    if stored is None:
        tx.append("event", fold_events(ops, rows=rows), "uuid")
        return
    old = tx.stage(stored.select("uuid").join(ops.select("uuid").distinct(), "uuid", "left_semi"))
    fresh = ops.join(old, "uuid", "left_anti")
    changes = ops.where(F.col("type").isin("track_update", "track_overwrite")).join(old, "uuid", "left_semi")
    buckets = [r[0] for r in changes.select(bucket_of(F.col("uuid"), tx.buckets("event"))).distinct().collect()]
    if buckets:
        before, keys = tx.read("event", buckets), changes.select("uuid").distinct()
        folded = fold_events(changes, before.join(keys, "uuid", "left_semi"), 2 * rows)
        tx.rewrite("event", folded.unionByName(before.join(keys, "uuid", "left_anti").select("uuid", "doc")), buckets, "uuid")
    tx.append("event", fold_events(fresh, rows=rows), "uuid")


def id_mapping(store_read) -> DataFrame | None:
    """(user_id, account_id, distinct_ids) from the index tables, which ``store_read`` reads by name."""
    accounts, devices = store_read(ACCOUNTS), store_read(DEVICES)
    if accounts is None and devices is None:
        return None
    spark = (devices if accounts is None else accounts).sparkSession
    accounts = spark.createDataFrame([], "account_id string, user_id long") if accounts is None else accounts
    devices = spark.createDataFrame([], "distinct_id string, user_id long, owned boolean, seq long") if devices is None else devices
    return bindings(accounts, current_devices(devices))

