"""One SQL statement over the store: queries by Catalyst, changes as transactions."""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .document_store import KEYS, DocumentStore
from .store import Transaction, bucket_of


class SqlError(ValueError):
    pass


@dataclass
class SqlResult:
    kind: str
    rows: DataFrame | None = None
    inserted: int = 0
    matched: int = 0
    modified: int = 0
    deleted: int = 0

    def documents(self) -> Iterator[dict]:
        """Rows as dicts, a partition at a time."""
        return (r.asDict(recursive=True) for r in self.rows.toLocalIterator())

    def to_dict(self) -> dict:
        """Zero counts and empty row lists stay in the answer."""
        if self.kind == "select":
            return {"rows": list(self.documents())}
        if self.kind == "insert":
            return {"insertedCount": self.inserted}
        if self.kind == "update":
            return {"matchedCount": self.matched, "modifiedCount": self.modified}
        return {"deletedCount": self.deleted}


_NAME = r"`(?:[^`]|``)+`|[\w.]+"
_UPDATE = re.compile(rf"update\s+({_NAME})\s+set\s+", re.I)
_DELETE = re.compile(rf"delete\s+from\s+({_NAME})\s*", re.I)
_INSERT = re.compile(rf"insert\s+into\s+({_NAME})\s*", re.I)
_QUERY = re.compile(r"(?:select|with)\b|\(", re.I)
_UNSUPPORTED = frozenset("alter analyze begin call commit create describe drop explain grant merge refresh revoke rollback set show truncate use".split())
#: Views of a session are named like the tables, so statements are analysed one at a time.
_VIEWS = threading.RLock()


def _open_characters(text: str) -> Iterator[tuple[int, str]]:
    """Characters of a statement outside quotes, brackets and comments, with their places."""
    depth, i, n = 0, 0, len(text)
    while i < n:
        c = text[i]
        if c in "'\"`":
            i += 1
            while i < n and text[i] != c:
                i += 2 if text[i] == "\\" and c != "`" else 1
        elif text.startswith("--", i):
            i = n if (end := text.find("\n", i)) < 0 else end
        elif text.startswith("/*", i):
            i = n if (end := text.find("*/", i)) < 0 else end + 1
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        elif not depth:
            yield i, c
        i += 1


def split_top(text: str, mark: str = ",", most: int = -1) -> list[str]:
    """Split at a mark outside quotes and brackets."""
    out, at = [], 0
    for i, c in _open_characters(text):
        if c == mark and len(out) != most:
            out.append(text[at:i])
            at = i + 1
    return [*out, text[at:]]


def split_word(text: str, word: str) -> tuple[str, str | None]:
    """What stands before and after the first such word outside quotes and brackets."""
    places = {i for i, _ in _open_characters(text)}
    for m in re.finditer(rf"(?<![\w`]){word}(?![\w`])", text, re.I):
        if m.start() in places:
            return text[: m.start()], text[m.end() :]
    return text, None


def _unquoted(name: str) -> str:
    name = name.strip()
    return name[1:-1].replace("``", "`") if name.startswith("`") else name


@dataclass
class SqlApi:
    """Runs statements. ``extra`` holds frames that queries see beside the store's tables."""

    store: DocumentStore
    extra: dict[str, DataFrame] = field(default_factory=dict)

    def _table(self, name: str, tx: Transaction) -> tuple[str, DataFrame]:
        name = _unquoted(name)
        df = self.store.read(name, tx)
        if df is None:
            raise SqlError(f"no such table: {name}")
        return name, df

    def _query(self, text: str, hide: bool) -> DataFrame:
        """A query's rows. With ``hide``, ``*`` leaves out ``_id``, which a query must name to see."""
        found = {n: self.store.read(n) for n in self.store.tables() if n in text} | {n: d for n, d in self.extra.items() if n in text}

        def run(tables: dict[str, DataFrame]) -> DataFrame:
            for name, df in tables.items():
                df.createOrReplaceTempView(f"`{name}`")
            try:
                return self.store.spark.sql(text)
            finally:
                for name in tables:
                    self.store.spark.catalog.dropTempView(name)

        with _VIEWS:
            if not hide:
                return run(found)
            try:
                return run({n: d.drop("_id") for n, d in found.items()})
            except AnalysisException as e:
                if isinstance(e, ParseException) or not re.search(r"(?<!\w)_id(?!\w)", text):
                    raise
                return run(found)

    def execute(self, statement: str) -> SqlResult:
        text = statement.strip()
        while text.endswith(";"):
            text = text[:-1].rstrip()
        word = re.split(r"[\s(]", text, maxsplit=1)[0].lower() if text else ""
        if word in _UNSUPPORTED:
            raise SqlError(f"unsupported statement type: {word}")
        try:
            if _QUERY.match(text):
                return SqlResult("select", self._query(text, hide=True))
            for head, change in ((_INSERT, self._insert), (_UPDATE, self._update), (_DELETE, self._delete)):
                if m := head.match(text):
                    return self.store.store.update(lambda tx, change=change, m=m: change(tx, m[1], text[m.end() :]))
        except ParseException as e:
            raise SqlError(f"parse SQL: syntax error: {e}") from e
        except AnalysisException as e:
            raise SqlError(f"analyse SQL: {e}") from e
        raise SqlError(f"parse SQL: syntax error near {text[:40]!r}")

    def _insert(self, tx: Transaction, name: str, rest: str) -> SqlResult:
        name, names = _unquoted(name), None
        if rest.startswith("(") and not re.match(r"\(\s*(?:select|with|values)\b", rest, re.I):
            inner = rest[1 : rest.index(")")]
            names, rest = [_unquoted(c) for c in split_top(inner)], rest[len(inner) + 2 :].strip()
        if not re.match(r"(?:values|select|with)\b|\(", rest, re.I):
            raise SqlError(f"parse SQL: syntax error near {rest[:40]!r}")
        new = self._query(rest, hide=True)
        old = self.store.read(name, tx)
        if names is None:
            names = [c for c in old.columns if c != "_id" or len(new.columns) == len(old.columns)] if old is not None else new.columns
        if len(names) != len(new.columns):
            raise SqlError(f"{len(new.columns)} values for {len(names)} columns")
        new = new.toDF(*names)
        if old is not None:  # values take the columns' types where they can
            new = new.select(*[F.col(f"`{c}`").try_cast(old.schema[c].dataType).alias(c) if c in old.columns and _castable(new, old, c) else F.col(f"`{c}`") for c in names])
        try:
            self.store.add(name, new, tx)
        except ValueError as e:
            raise SqlError(str(e)) from e
        return SqlResult("insert", inserted=new.count())

    def _hit(self, where: str | None) -> Column:
        return F.lit(True) if where is None else F.coalesce(F.expr(where), F.lit(False))

    def _update(self, tx: Transaction, name: str, rest: str) -> SqlResult:
        name, df = self._table(name, tx)
        sets, where = split_word(rest, "where")
        pairs = [split_top(s, "=", 1) for s in split_top(sets)]
        if any(len(p) != 2 for p in pairs):
            raise SqlError(f"parse SQL: syntax error near {sets[:40]!r}")
        changes = {_unquoted(k): F.expr(v) for k, v in pairs}
        if name in KEYS and {"_id", KEYS[name][1]} & changes.keys():
            raise SqlError("the key of a row can't be changed")
        old = {k: F.col(f"`{k}`") if k in df.columns else F.lit(None) for k in changes}
        marked = df.withColumn("__hit", self._hit(where))
        new = marked.withColumns({k: F.when(F.col("__hit"), v).otherwise(old[k]) for k, v in changes.items()})
        changed = F.lit(False)
        for k, v in changes.items():
            changed = changed | ~v.eqNullSafe(old[k])
        counts = marked.agg(F.count_if("__hit").alias("m"), F.count_if(F.col("__hit") & changed).alias("c")).first()
        if counts["m"]:
            self._put(tx, name, new.drop("__hit"), marked)
        return SqlResult("update", matched=counts["m"], modified=counts["c"])

    def _delete(self, tx: Transaction, name: str, rest: str) -> SqlResult:
        name, df = self._table(name, tx)
        before, where = split_word(rest, "where")
        if before.strip():
            raise SqlError(f"parse SQL: syntax error near {before[:40]!r}")
        marked = df.withColumn("__hit", self._hit(where))
        n = marked.agg(F.count_if("__hit")).first()[0]
        if n:
            self._put(tx, name, marked.where("not __hit").drop("__hit"), marked)
        return SqlResult("delete", deleted=n)

    def _put(self, tx: Transaction, name: str, new: DataFrame, marked: DataFrame) -> None:
        """Write a changed table; of a folded one, the buckets that hold changed rows."""
        if name not in KEYS:
            self.store.write(name, new, tx)
            return
        bucket = bucket_of(F.col("_id"), tx.buckets(name))
        touched = [r[0] for r in marked.where("__hit").select(bucket).distinct().collect()]
        tx.rewrite(name, self.store.folded(name, new.where(bucket.isin(touched))), touched, KEYS[name][0])


def _castable(new: DataFrame, old: DataFrame, name: str) -> bool:
    simple = lambda df: df.schema[name].dataType.typeName() not in ("struct", "array", "map")
    return simple(new) and simple(old)
