"""The engine: upload, document and SQL queries and config over one store."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Iterator
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings
from ..functions.extended_json import ObjectId, decode, encode, typed
from ..functions.rules import RuleError, compile_rules
from ..operators import documents
from ..operators.documents import DocumentError
from ..sources.files import from_lines
from .config_store import ConfigStore, Registry, validate_filter, version_of
from .document_store import KEYS, DocumentStore, frame_of
from .ingest import ACCOUNTS, DEVICES, UploadResult, ingest
from .sql_api import SqlApi, SqlResult
from .store import BUCKETS, Store, Transaction, bucket_of

LOG = logging.getLogger(__name__)
MODES = ("single", "batch", "pipeline")


def parse_mode(mode: str) -> str:
    """An upload mode; batch if none is named."""
    mode = (mode or "batch").strip().lower()
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}: it must be one of {', '.join(MODES)}")
    return mode


class RuleHolder:
    """The rules in force; new ones that don't compile leave the last good ones."""

    def __init__(self, include: list[str] = (), exclude: list[str] = ()) -> None:
        self.rules = ([], [])
        self.swap(include, exclude)

    def swap(self, include: list[str], exclude: list[str]) -> None:
        for side, rules in (("include", include), ("exclude", exclude)):
            compile_rules(list(rules), side, F.col("doc"))
        self.rules = (list(include), list(exclude))


class Engine:
    """Upload lines, change and query documents, publish config. All arguments and results are plain values.

    ``include`` and ``exclude`` are rules of its own, ``use_config`` whether published ones join them,
    ``mode`` how uploads are cut, ``batch_size`` the lines of a batch (0: all of an upload),
    ``workers`` the tasks of the pipeline mode, and ``buckets`` those of new tables.
    """

    def __init__(
        self, spark: SparkSession, root: str, include: list[str] = (), exclude: list[str] = (), use_config: bool = True,
        mode: str = "batch", batch_size: int = 0, workers: int | None = None, buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.store, self.registry = spark, Store(spark, root, buckets), Registry()
        self.config = ConfigStore(spark, root, self.registry)
        self.documents = DocumentStore(self.store)
        self.include, self.exclude, self.use_config = list(include), list(exclude), use_config
        self.mode, self.batch_size, self.workers = parse_mode(mode), batch_size, workers
        self.holder, self.config_version = RuleHolder(include, exclude), 0
        self.registry.register("filter", validate_filter, self._apply_filter)

    @classmethod
    def from_settings(cls, spark: SparkSession, text: str | bytes = "", **flags: Any) -> Engine:
        """An engine by settings as JSON or YAML; flags win over them (see ``settings``)."""
        s = settings.load(text, **flags)
        if not s.root:
            raise ValueError("root is required")
        return cls(spark, s.root, s.include, s.exclude, mode=s.mode, batch_size=s.batch_size, workers=s.workers or None, buckets=s.buckets)

    def rules(self) -> tuple[list[str], list[str]]:
        """Own rules and the published ones; a published set that doesn't compile leaves the last good one in force."""
        if self.use_config and (version := self.config.version()) > self.config_version:
            self.config_version = version
            try:
                self.apply_published(self.config.fetch() or {})
            except RuleError as e:
                LOG.warning("published rules of version %d aren't used: %s", version, e)
        return self.holder.rules

    def apply_published(self, doc: dict[str, Any]) -> None:
        """Put published rules in force beside the engine's own; RuleError if one doesn't compile."""
        self.config_version = max(self.config_version, version_of(doc))
        self.registry.apply(doc)

    def _apply_filter(self, published: dict[str, list[str]]) -> None:
        self.holder.swap([*self.include, *published.get("include", [])], [*self.exclude, *published.get("exclude", [])])

    def upload(self, lines: Iterable[str], mode: str | None = None) -> UploadResult:
        """Fold lines into the store: each alone (single), or in batches; the pipeline mode counts failed writes and goes on."""
        mode = parse_mode(mode or self.mode)
        left = (x for x in lines if x)
        size = 1 if mode == "single" else self.batch_size
        result = UploadResult()
        while some := list(islice(left, size) if size else left):
            try:
                result += self.run(from_lines(self.spark, some), workers=self.workers if mode == "pipeline" else None)
            except Exception:
                if mode == "batch":
                    raise
                LOG.exception("a batch of %d lines isn't written", len(some))
                result += UploadResult(lines=len(some), write_errors=len(some))
        return result

    def run(self, lines: DataFrame, ts: str | None = None, stream: str = "", batch: int | None = None, workers: int | None = None) -> UploadResult:
        """Fold a frame of (line, seq from 1 on) into the store; see ``ingest``."""
        include, exclude = self.rules()
        return ingest(self.store, lines, include, exclude, ts, stream, batch, workers)

    def sql(self, statement: str) -> SqlResult:
        return SqlApi(self.documents).execute(statement)

    def sql_bytes(self, statement: bytes) -> bytes:
        return encode(self.sql(statement.decode()).to_dict()).encode()

    def ejson(self, request: dict[str, Any]) -> dict[str, Any]:
        """One request: action, collection, database, then its operands. Values may be marked by type; answers are plain."""
        kind, answer = self.ask(request)
        if kind == "documents":
            return {"documents": list(answer)}
        return answer

    def ejson_bytes(self, request: bytes) -> bytes:
        """One request as Extended JSON, its answer likewise."""
        return encode(self.ejson(decode(request))).encode()

    def ask(self, request: dict[str, Any]) -> tuple[str, Any]:
        """("documents", an iterator over them) or ("answer", a dict)."""
        try:
            request = typed(request)
        except ValueError as e:
            raise DocumentError(str(e)) from e
        action, name = request.get("action"), request.get("collection")
        if not action:
            raise DocumentError("action is required")
        if action not in ("findOne", "find", "aggregate", "insertOne", "updateOne", "deleteOne"):
            raise DocumentError(f"unknown action {action}")
        if not name:
            raise DocumentError("collection is required")
        if action in ("find", "findOne"):
            df = self.documents.read(name)
            args = {k: request.get(v) for k, v in (("query", "filter"), ("projection", "projection"), ("sort", "sort"))}
            limit = 1 if action == "findOne" else request.get("limit") or 0
            found = iter(()) if df is None else plain(documents.find(df, **args, skip=request.get("skip") or 0, limit=limit))
            if action == "find":
                return "documents", found
            first = next(found, None)
            return "answer", {} if first is None else {"document": first}
        if action == "aggregate":
            df = self.documents.read(name)
            tables = {t: self.documents.read(t) for t in self.documents.tables()}
            return "documents", iter(()) if df is None else plain(documents.aggregate(df, request.get("pipeline"), tables))
        change = {"insertOne": self._insert_one, "updateOne": self._update_one, "deleteOne": self._delete_one}[action]
        return "answer", self.store.update(lambda tx: change(tx, name, request))

    def _insert_one(self, tx: Transaction, name: str, request: dict) -> dict:
        if not request.get("document"):
            raise DocumentError("document is required")
        return {"insertedId": self._insert(tx, name, request["document"])}

    def _insert(self, tx: Transaction, name: str, document: dict) -> Any:
        own = document.get(KEYS[name][1]) if name in KEYS else None
        key = own if own is not None else document.get("_id", ObjectId(uuid.uuid4().hex[:24]))
        if name == "event" and own is None:
            document = {KEYS[name][1]: str(key), **document}
        try:
            self.documents.add(name, frame_of(self.spark, [{**document, "_id": key}]), tx)
        except ValueError as e:
            raise DocumentError(str(e)) from e
        return key

    def _chosen(self, tx: Transaction, name: str, request: dict) -> tuple[DataFrame | None, Any]:
        df = self.documents.read(name, tx)
        if df is not None and "_id" not in df.columns:
            raise DocumentError(f"{name} has no _id")
        return df, None if df is None else documents.first_match(df, request.get("filter"))

    def _delete_one(self, tx: Transaction, name: str, request: dict) -> dict:
        _, key = self._chosen(tx, name, request)
        if key is not None:
            self.documents.change(name, [key], None, tx)
        return {"deletedCount": int(key is not None)}

    def _update_one(self, tx: Transaction, name: str, request: dict) -> dict:
        update = request.get("update")
        if not documents.is_update(update):
            raise DocumentError("update is required")
        df, key = self._chosen(tx, name, request)
        if key is not None:
            chosen = F.col("_id").eqNullSafe(key)
            old = df.where(chosen)
            new = documents.apply_update(old, F.lit(True), update)
            before, after = (list(plain(x.drop("_id"))) for x in (old, new))
            if before != after:
                self.documents.change(name, [key], new, tx)
            return {"matchedCount": 1, "modifiedCount": int(before != after)}
        if not request.get("upsert"):
            return {"matchedCount": 0, "modifiedCount": 0}
        document = {k: v for k, v in (request.get("filter") or {}).items() if not k.startswith("$") and not isinstance(v, dict)}
        for op, fields in update.items():
            for k, v in fields.items():
                each = v["$each"] if isinstance(v, dict) and "$each" in v else [v]
                if op != "$unset":
                    document[k] = each if op in ("$push", "$addToSet") else v
        return {"matchedCount": 0, "modifiedCount": 0, "upsertedId": self._insert(tx, name, document)}

    def user_of(self, account_id: str = "", distinct_id: str = "") -> int | None:
        """Number of the user that an account, or else a device, is bound to; only their buckets of the index are read."""
        state = self.store.state()
        for name, key, value in ((ACCOUNTS, "account_id", account_id), (DEVICES, "distinct_id", distinct_id)):
            table = state.tables.get(name)
            if not value or table is None:
                continue
            bucket = self.spark.range(1).select(bucket_of(F.lit(value), table.buckets)).first()[0]
            if (row := self.store.frame(table, [bucket]).where(F.col(key) == value).agg(F.min("user_id")).first()) and row[0] is not None:
                return row[0]
        return None

    def watch(self, name: str, since: int = 0) -> tuple[int, DataFrame | None]:
        """The last commit's number, and the rows of a table that were added and removed since an earlier one."""
        now = self.store.state().number
        return now, self.store.changes(name, since)

    def publish_config(self, doc: dict) -> int:
        return self.config.publish(doc)

    def append_config(self, doc: dict) -> int:
        return self.config.append(doc)

    def fetch_config(self) -> dict | None:
        return self.config.fetch()

    def publish_config_bytes(self, doc: bytes, append: bool = False) -> int:
        return (self.append_config if append else self.publish_config)(decode(doc))

    def ensure_indexes(self) -> None:
        """Nothing to do: keys are unique by the folds, tables are dealt by key, and Parquet keeps its own statistics."""


def plain(df: DataFrame) -> Iterator[dict]:
    """Rows as dicts, a partition at a time; null fields are missing ones."""
    return (_without_nulls(r.asDict(recursive=True)) for r in df.toLocalIterator())


def _without_nulls(value: Any) -> Any:
    if isinstance(value, dict):
        return {k: _without_nulls(v) for k, v in value.items() if v is not None}
    return [_without_nulls(v) for v in value] if isinstance(value, list) else value


