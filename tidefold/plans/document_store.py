"""User and event tables as documents: one typed column for each property, and back into maps of JSON texts."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import json_of
from .ingest import ACCOUNTS, DEVICES, id_mapping
from .store import Store, Table, Transaction, bucket_of

#: Key column of each folded table, and the property that stands for it.
KEYS = {"user": ("user_id", "#user_id"), "event": ("uuid", "#uuid")}
#: The table made from the index tables when it is read.
MAPPING = "id_mapping"
_KINDS = re.compile(r"`(?:[^`]|``)*`|OBJECT<|\bVOID\b|\bVARIANT\b")
_AS = {"OBJECT<": "STRUCT<", "VOID": "STRING", "VARIANT": "STRING"}


class DocumentStore:
    """Reads and writes a store's tables as documents; ``_id`` is the key of a folded table.

    Properties get the type that all their values share, text if they share none; a null property
    is the same as a missing one. Types are found in one pass over a version, once. Changes go through
    a transaction, in which reads see its own changes.
    """

    def __init__(self, store: Store) -> None:
        self.store, self.spark, self.kinds = store, store.spark, {}

    def tables(self) -> list[str]:
        names = self.store.tables()
        return sorted({*names} - {ACCOUNTS, DEVICES} | ({MAPPING} if {ACCOUNTS, DEVICES} & {*names} else set()))

    def read(self, name: str, tx: Transaction | None = None) -> DataFrame | None:
        state = None if tx else self.store.state()
        table = tx.table(name) if tx else state.tables.get(name)
        if name == MAPPING and table is None:
            return id_mapping(tx.read if tx else lambda n: self.store.frame(state.tables.get(n)))
        df = self.store.frame(table)
        return self.shown(name, df, table) if df is not None and name in KEYS else df

    def shown(self, name: str, df: DataFrame, table: Table) -> DataFrame:
        """Documents of a folded table, or of some of its rows."""
        key, shown = KEYS[name]
        entry = F.transform(F.map_entries("doc"), lambda e: F.concat(json_of(e["key"]), F.lit(":"), e["value"]))
        text = F.concat(F.lit("{"), F.array_join(entry, ","), F.lit("}"))
        texts = df.select(F.col(key).alias("_id"), text.alias("text"))
        version = (name, json.dumps(table.parts, sort_keys=True))
        if version not in self.kinds:
            whole = self.store.frame(table).select(text.alias("text"))
            self.kinds[version] = whole.agg(F.schema_of_variant_agg(F.try_parse_json("text"))).first()[0]
        kind = self.kinds[version]
        if not (kind or "").startswith("OBJECT<") or kind == "OBJECT<>":  # no rows, or none with a property
            return texts.select("_id", F.col("_id").alias(shown))
        schema = _KINDS.sub(lambda m: _AS.get(m[0], m[0]), kind)
        out = texts.select("_id", F.from_json("text", schema).alias("doc")).select("_id", "doc.*")
        return out if shown in out.columns else out.withColumn(shown, F.col("_id"))

    def folded(self, name: str, df: DataFrame) -> DataFrame:
        """Documents as rows of a folded table."""
        key, shown = KEYS[name]
        outside = {"_id", shown} if name == "user" else {"_id"}  # a user's number is the key alone
        names = [c for c in df.columns if c not in outside]
        entries = [F.struct(F.lit(c).alias("k"), F.when(F.col(f"`{c}`").isNotNull(), json_of(F.col(f"`{c}`"))).alias("v")) for c in names]
        doc = F.map_from_entries(F.filter(F.array(*entries), lambda e: e["v"].isNotNull()))
        own = F.col(f"`{shown}`") if shown in df.columns else F.col("`_id`")
        return df.select(own.cast("long" if name == "user" else "string").alias(key), doc.alias("doc"))

    def write(self, name: str, df: DataFrame, tx: Transaction) -> None:
        """Replace a table by documents."""
        if name == MAPPING:
            raise ValueError(f"{MAPPING} is read only")
        if name in KEYS:
            tx.replace(name, self.folded(name, df), KEYS[name][0])
        else:
            tx.replace(name, df)

    def change(self, name: str, ids: list[Any], df: DataFrame | None, tx: Transaction) -> None:
        """Put documents in place of those with the given ids; no documents if None. Only their buckets are rewritten."""
        if name not in KEYS:
            rest = self.read(name, tx).where(~F.col("_id").isin(ids))
            tx.replace(name, rest if df is None else united(rest, df))
            return
        key = KEYS[name][0]
        kind = "long" if name == "user" else "string"
        n = tx.buckets(name)
        new = None if df is None else self.folded(name, df)
        numbers = self.spark.createDataFrame([(x,) for x in ids], f"id {kind}").select(bucket_of(F.col("id"), n))
        touched = {r[0] for r in (numbers if new is None else numbers.unionByName(new.select(bucket_of(F.col(key), n).alias(numbers.columns[0])))).distinct().collect()}
        stored = tx.read(name, touched)
        rest = stored.where(~F.col(key).isin(ids))
        tx.rewrite(name, rest if new is None else rest.unionByName(new), touched, key)

    def add(self, name: str, df: DataFrame, tx: Transaction) -> None:
        """Add documents; ones of a key that is there already raise ValueError."""
        if name == MAPPING:
            raise ValueError(f"{MAPPING} is read only")
        old = self.read(name, tx)
        if name in KEYS:
            key = KEYS[name][0]
            rows = self.folded(name, df)
            if rows.where(F.col(key).isNull()).limit(1).count():
                raise ValueError(f"{KEYS[name][1]} is required")
            if old is not None:
                touched = [r[0] for r in rows.select(bucket_of(F.col(key), tx.buckets(name))).distinct().collect()]
                if tx.read(name, touched).join(rows.select(key), key, "left_semi").limit(1).count():
                    raise ValueError("duplicate key")
            tx.append(name, rows, key)
        elif old is None:
            tx.replace(name, df)
        elif _fits(df.schema, old.schema):
            tx.append(name, df.select(*df.columns))
        else:
            tx.replace(name, united(old, df))


def _fits(new: T.StructType, old: T.StructType) -> bool:
    """Whether rows can be added to a table's folders as they are."""
    kinds = {f.name: f.dataType for f in old}
    return all(f.name in kinds and kinds[f.name] == f.dataType for f in new)


def united(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both; a column whose types can't be united becomes text in both."""
    try:
        return a.unionByName(b, allowMissingColumns=True)
    except Exception:
        clash = [f.name for f in b.schema if f.name in a.columns and a.schema[f.name].dataType != f.dataType]
        text = lambda df: df.withColumns({c: df[f"`{c}`"].cast("string") if not isinstance(df.schema[c].dataType, (T.StructType, T.ArrayType, T.MapType)) else F.to_json(df[f"`{c}`"]) for c in clash})
        return text(a).unionByName(text(b), allowMissingColumns=True)


def frame_of(spark: SparkSession, documents: Iterable[dict[str, Any]]) -> DataFrame:
    """Documents of Python values as a frame; nested ones as structs. Fields without any value are left out."""

    def value(x: Any) -> Any:
        if isinstance(x, dict):
            return Row(**{k: value(v) for k, v in x.items()}) if x else None
        return [value(v) for v in x] if isinstance(x, list) else str(x) if type(x) not in (str, int, float, bool, type(None)) and isinstance(x, str) else x

    rows = [{k: value(v) for k, v in d.items()} for d in documents]
    names = list(dict.fromkeys(k for r in rows for k in r))
    fields = []
    for n in names:
        kinds = [spark.createDataFrame([Row(x=r[n])]).schema[0].dataType for r in rows if r.get(n) is not None]
        if kinds:
            fields.append(T.StructField(n, _storable(kinds[0])))
    return spark.createDataFrame([tuple(r.get(f.name) for f in fields) for r in rows], T.StructType(fields))


def _storable(kind: T.DataType) -> T.DataType:
    """A type whose unknown parts, those of empty lists and nulls, are text."""
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_storable(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _storable(f.dataType)) for f in kind])
    return kind
