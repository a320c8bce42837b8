"""Tables as Parquet folders under one log of commits.

A commit is a JSON file, named by its number, which lists the folders of every table, the counters and
the last batch of each stream; readers take the highest number. It is put in place without overwriting,
so of two writers one gets the number, and the other goes on top of it or starts again. All tables that
a transaction changes appear at once or not at all.

A table with a key is dealt in buckets by the key's hash: a change rewrites only the buckets it touches.
Appended folders are merged in levels, FAN at a time, so that a table's folders stay few and each row is
rewritten a logarithmic number of times. On file systems without an atomic rename (object stores), let
one process write at a time.
"""

from __future__ import annotations

import json
import os
import re
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field, replace
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

T = TypeVar("T")
#: Buckets of a new keyed table, and folders of a level that are merged.
BUCKETS, FAN = 16, 32
_COMMIT = re.compile(r"(\d{12})\.json$")
_LOCKS: dict[str, threading.RLock] = defaultdict(threading.RLock)


class Conflict(RuntimeError):
    """Another writer changed what a transaction read or writes."""


@dataclass(frozen=True)
class Table:
    """``parts`` has, for each bucket, the folders with their levels; ``version`` is the commit that changed it last."""

    schema: str
    key: str | None = None
    buckets: int = 1
    parts: dict[str, list[list]] = field(default_factory=dict)
    version: int = 0


@dataclass(frozen=True)
class State:
    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    counters: dict[str, int] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _path(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}" if path else self.root)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def list(self, path: str) -> list[str]:
        fs, target = self._path(path)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    def delete(self, path: str) -> None:
        fs, target = self._path(path)
        fs.delete(target, True)

    def read_text(self, path: str) -> str:
        fs, target = self._path(path)
        stream = fs.open(target)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> None:
        """Put a whole file in place, or raise Conflict if there is one of its name."""
        folder, _, name = path.rpartition("/")
        fs, draft = self._path(f"{folder}/.{name}.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        _, target = self._path(path)
        try:
            if fs.getUri().getScheme() == "file":
                os.link(draft.toUri().getPath(), target.toUri().getPath())
            else:
                jvm = self.spark._jvm
                files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
                kinds = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                files.rename(draft, target, kinds)
        except Exception as e:
            if fs.exists(target):
                raise Conflict(path) from e
            raise
        finally:
            fs.delete(draft, False)

    def numbers(self) -> list[int]:
        return sorted(int(m[1]) for x in self.list("_commits") if (m := _COMMIT.match(x)))

    def state(self, number: int | None = None) -> State:
        """The state after a commit, the last one by default."""
        if number is None:
            number = max(self.numbers(), default=0)
        if not number:
            return State()
        got = json.loads(self.read_text(f"_commits/{number:012d}.json"))
        return State(number, {k: Table(**t) for k, t in got["tables"].items()}, got["counters"], got["batches"])

    def frame(self, table: Table | None, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """Rows of a table, or of some of its buckets; None if there is no such table."""
        if table is None:
            return None
        wanted = table.parts if buckets is None else {str(b) for b in buckets} & table.parts.keys()
        paths = [f"{self.root}/{p}" for b in sorted(wanted, key=int) for p, _ in table.parts[b]]
        schema = StructType.fromJson(json.loads(table.schema))
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*dict.fromkeys(paths))

    def read(self, name: str) -> DataFrame | None:
        return self.frame(self.state().tables.get(name))

    def tables(self) -> list[str]:
        return sorted(self.state().tables)

    def update(self, change: Callable[[Transaction], T], tries: int = 8) -> T:
        """Run a change in a transaction and commit it; run it again if another writer came between."""
        with _LOCKS[self.root]:
            for k in range(tries):
                tx = Transaction(self)
                try:
                    out = change(tx)
                    tx.commit()
                    return out
                except BaseException as e:
                    tx.abort()
                    if not isinstance(e, Conflict) or k == tries - 1:
                        raise
                finally:
                    tx.close()
        raise AssertionError

    def write(self, name: str, df: DataFrame) -> None:
        """Replace a table as a whole."""
        self.update(lambda tx: tx.replace(name, df))

    def changes(self, name: str, since: int) -> DataFrame | None:
        """Rows of a table that were added and removed since a commit, with ``change`` insert or delete; None if nothing was."""
        old, new = self.state(since).tables.get(name) if since else None, self.state().tables.get(name)
        if new is None or old is not None and old.version == new.version:
            return None
        keep = {tuple(p[:1]) for b in (old.parts if old else {}).values() for p in b} & {tuple(p[:1]) for b in new.parts.values() for p in b}
        fresh = lambda t: replace(t, parts={b: [p for p in ps if (p[0],) not in keep] for b, ps in t.parts.items()})
        after = _comparable(self.frame(fresh(new)))
        if old is None:
            return after.select("*", F.lit("insert").alias("change"))
        before = _comparable(self.frame(fresh(old)))
        return after.exceptAll(before).select("*", F.lit("insert").alias("change")).unionByName(
            before.exceptAll(after).select("*", F.lit("delete").alias("change")), allowMissingColumns=True
        )

    def vacuum(self, keep: int = 2) -> None:
        """Drop all but the last commits, and the folders that only the dropped ones list."""
        numbers = self.numbers()
        gone, left = numbers[:-keep], numbers[-keep:]
        folders = lambda ns: {p for n in ns for t in self.state(n).tables.values() for b in t.parts.values() for p, _ in b}
        unused = folders(gone) - folders(left)
        for n in gone:
            self.delete(f"_commits/{n:012d}.json")
        for path in unused:
            self.delete(path)


def _comparable(df: DataFrame) -> DataFrame:
    """Maps, which can't be compared, as sorted arrays of entries."""
    maps = [f.name for f in df.schema if f.dataType.typeName() == "map"]
    return df.withColumns({c: F.array_sort(F.map_entries(F.col(f"`{c}`"))) for c in maps}) if maps else df


class Transaction:
    """Changes on top of one state, seen by its own reads, committed together."""

    def __init__(self, store: Store) -> None:
        self.store, self.base = store, store.state()
        self.reads: set[str] = set()
        self.sets: dict[str, Table] = {}
        self.adds: dict[str, list[Table]] = defaultdict(list)
        self.counters: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.written: list[str] = []
        self.staged: list[str] = []

    def table(self, name: str) -> Table | None:
        self.reads.add(name)
        return _with(self.sets.get(name, self.base.tables.get(name)), self.adds.get(name, []))

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame | None:
        return self.store.frame(self.table(name), buckets)

    def buckets(self, name: str) -> int:
        """Buckets of a keyed table; those of a new one if there is none."""
        found = self.sets.get(name, self.base.tables.get(name))
        return found.buckets if found else self.store.buckets

    def _put(self, name: str, df: DataFrame, key: str | None, level: int = 0) -> Table:
        """Write rows into a new folder, dealt by the key's buckets."""
        path = f"data/{name}/{uuid.uuid4().hex}"
        self.written.append(path)
        schema, target = df.schema.json(), f"{self.store.root}/{path}"
        if key is None:
            df.write.parquet(target)
            return Table(schema, parts={"0": [[path, level]]})
        n = self.buckets(name)
        dealt = df.withColumn("bucket_", bucket_of(F.col(f"`{key}`"), n)).hint("rebalance", "bucket_")
        dealt.write.partitionBy("bucket_").parquet(target)
        found = [x.partition("=")[2] for x in self.store.list(path) if x.startswith("bucket_=")]
        return Table(schema, key, n, {b: [[f"{path}/bucket_={b}", level]] for b in found})

    def stage(self, df: DataFrame) -> DataFrame:
        """Rows written to a folder that goes with the transaction: read as often as needed, made once, with a short plan."""
        path = f"data/_staged/{uuid.uuid4().hex}"
        self.staged.append(path)
        df.write.parquet(f"{self.store.root}/{path}")
        return self.store.spark.read.schema(df.schema).parquet(f"{self.store.root}/{path}")

    def replace(self, name: str, df: DataFrame, key: str | None = None) -> None:
        self.adds.pop(name, None)
        self.sets[name] = self._put(name, df, key)

    def rewrite(self, name: str, df: DataFrame, touched: Iterable[int], key: str) -> None:
        """Put new rows in place of all rows of the touched buckets."""
        old = self.table(name)
        new = self._put(name, df, key)
        kept = {b: p for b, p in (old.parts if old else {}).items() if b not in {str(t) for t in touched}}
        self.adds.pop(name, None)
        self.sets[name] = replace(new, parts=kept | new.parts)

    def append(self, name: str, df: DataFrame, key: str | None = None) -> None:
        """Add rows. Another writer's rows don't conflict with it."""
        self.adds[name].append(self._put(name, df, key))

    def _merged(self, name: str, table: Table) -> Table:
        """Merge the folders of each level of which there are FAN."""
        level = 0
        while True:
            full = {b: [p for p in ps if p[1] == level] for b, ps in table.parts.items()}
            full = {b: ps for b, ps in full.items() if len(ps) >= FAN}
            if not full:
                return table
            new = self._put(name, self.store.frame(replace(table, parts=full)), table.key, level + 1)
            left = {b: [p for p in ps if p not in full.get(b, [])] for b, ps in table.parts.items()}
            table = replace(table, parts={b: left.get(b, []) + new.parts.get(b, []) for b in left.keys() | new.parts.keys()})
            level += 1

    def commit(self) -> None:
        """Put the next commit in place; on top of another writer's if that changed nothing this one depends on."""
        if not (self.sets or self.adds or self.counters or self.batches):
            return
        while True:
            number = self.base.number + 1
            tables = dict(self.base.tables)
            for name in {*self.sets, *self.adds}:
                table = _with(self.sets.get(name, self.base.tables.get(name)), self.adds.get(name, []))
                tables[name] = replace(self._merged(name, table), version=number)
            state = State(number, tables, self.base.counters | self.counters, self.base.batches | self.batches)
            try:
                self.store.create_text(f"_commits/{number:012d}.json", json.dumps({k: v for k, v in asdict(state).items() if k != "number"}))
                used = {p for t in tables.values() for b in t.parts.values() for p, _ in b}
                self.staged += [p for p in self.written if not any(u == p or u.startswith(p + "/") for u in used)]  # merged at once
                return
            except Conflict:
                latest = self.store.state()
                version = lambda s, n: s.tables[n].version if n in s.tables else 0
                moved = any(version(latest, n) != version(self.base, n) for n in self.reads | self.sets.keys())
                moved |= any(latest.counters.get(k) != self.base.counters.get(k) for k in self.counters)
                moved |= any(latest.batches.get(k) != self.base.batches.get(k) for k in self.batches)
                if moved:
                    raise
                self.base = latest

    def abort(self) -> None:
        for path in self.written:
            self.store.delete(path)

    def close(self) -> None:
        for path in self.staged:
            self.store.delete(path)


def _with(table: Table | None, more: list[Table]) -> Table | None:
    """A table with appended parts."""
    for new in more:
        if table is None:
            table = new
            continue
        if table.buckets != new.buckets:
            raise Conflict("the table was dealt anew")
        table = replace(table, parts={b: table.parts.get(b, []) + new.parts.get(b, []) for b in table.parts.keys() | new.parts.keys()})
    return table
