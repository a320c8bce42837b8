"""Document queries over DataFrames: filters, find, aggregation pipelines and update operators."""

from __future__ import annotations

import datetime
import decimal
import operator
import re
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DocumentError(ValueError):
    """A request that isn't supported or isn't well formed."""


def field_at(path: str) -> Column:
    head, *rest = path.split(".")
    return reduce(lambda c, name: c.getField(name), rest, F.col(f"`{head}`"))


def _has(df: DataFrame, path: str) -> bool:
    try:
        df.select(field_at(path))
        return True
    except Exception:
        return False


def _field(df: DataFrame, path: str) -> Column:
    return field_at(path) if _has(df, path) else F.lit(None)


def _type(df: DataFrame, path: str) -> T.DataType:
    return df.select(_field(df, path)).schema[0].dataType


def _comparable(kind: T.DataType, value: Any) -> bool:
    """Whether values of a column's type and a literal are of one type bracket."""
    if isinstance(kind, T.NullType) or value is None:
        return True
    if isinstance(kind, T.NumericType):
        return isinstance(value, (int, float, decimal.Decimal)) and not isinstance(value, bool)
    if isinstance(kind, T.StringType):
        return isinstance(value, str)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return isinstance(value, datetime.date)
    if isinstance(kind, T.BinaryType):
        return isinstance(value, bytes)
    if isinstance(kind, (T.StructType, T.MapType)):
        return isinstance(value, dict)
    return isinstance(kind, T.BooleanType) == isinstance(value, bool)


def _literal(value: Any) -> Column:
    return F.struct(*[_literal(v).alias(k) for k, v in value.items()]) if isinstance(value, dict) else F.lit(str(value) if isinstance(value, str) else value)


_ORDER = {"$gt": operator.gt, "$gte": operator.ge, "$lt": operator.lt, "$lte": operator.le}


#: Operators of a field's condition.
_TESTS = frozenset((*_ORDER, "$eq", "$ne", "$in", "$nin", "$not", "$exists", "$size", "$all", "$elemMatch", "$regex"))


def _test(df: DataFrame, path: str, op: str, value: Any) -> Column:
    if op not in _TESTS:
        raise DocumentError(f"unknown operator {op}")
    column, kind = _field(df, path), _type(df, path)
    if isinstance(kind, T.ArrayType) and op in ("$eq", "$gt", "$gte", "$lt", "$lte", "$in") and not isinstance(value, list if op != "$in" else dict):
        return F.coalesce(F.exists(column, lambda x: _plain(x, kind.elementType, op, value)), F.lit(False))
    if op == "$ne":
        return ~_test(df, path, "$eq", value)
    if op == "$nin":
        return ~_test(df, path, "$in", value)
    if op == "$not":
        return ~_tests(df, path, value)
    if op == "$exists":
        return column.isNotNull() if value else column.isNull()
    if op == "$size":
        return F.coalesce(F.size(column) == value, F.lit(False))
    if op == "$all":
        return reduce(operator.and_, [_test(df, path, "$eq", v) for v in value], F.lit(True))
    if op == "$elemMatch":
        inner = lambda x: reduce(operator.and_, [_plain(x, kind.elementType, k, v) for k, v in value.items()])
        return F.coalesce(F.exists(column, inner), F.lit(False))
    return _plain(column, kind, op, value)


def _plain(column: Column, kind: T.DataType, op: str, value: Any) -> Column:
    no = F.lit(False)
    if op not in _TESTS:
        raise DocumentError(f"unknown operator {op}")
    if op == "$in":
        return reduce(operator.or_, [_plain(column, kind, "$eq", v) for v in value], no)
    if op == "$regex":
        return F.coalesce(column.rlike(value), no) if isinstance(kind, T.StringType) else no
    if isinstance(value, list):
        value = F.array(*[F.lit(v) for v in value])
    elif not _comparable(kind, value):
        return no
    if op == "$eq":
        return column.isNull() if value is None else column.eqNullSafe(value if isinstance(value, Column) else _literal(value))
    if op in _ORDER:
        return F.coalesce(_ORDER[op](column, value if isinstance(value, Column) else _literal(value)), no)
    raise DocumentError(f"unknown operator {op}")


def _tests(df: DataFrame, path: str, spec: Any) -> Column:
    if isinstance(spec, dict) and spec and all(k.startswith("$") for k in spec):
        spec = dict(spec)
        flags = spec.pop("$options", "")
        if flags and "$regex" in spec:
            spec["$regex"] = f"(?{flags}){spec['$regex']}"
        return reduce(operator.and_, [_test(df, path, op, v) for op, v in spec.items()])
    if isinstance(spec, dict) and any(k.startswith("$") for k in spec):
        raise DocumentError(f"operators and fields don't mix: {sorted(spec)}")
    return _test(df, path, "$eq", spec)


def compile_filter(df: DataFrame, query: dict | None) -> Column:
    """A condition that is never null: missing fields equal null and match no comparison."""
    out = F.lit(True)
    for key, value in (query or {}).items():
        if key in ("$and", "$or", "$nor"):
            parts = [compile_filter(df, q) for q in value]
            test = reduce(operator.and_ if key == "$and" else operator.or_, parts)
            out = out & (~test if key == "$nor" else test)
        elif key.startswith("$"):
            raise DocumentError(f"unknown operator {key}")
        else:
            out = out & _tests(df, key, value)
    return out


def _sorted(df: DataFrame, sort: dict) -> DataFrame:
    keys = [(_field(df, k).asc_nulls_first() if d > 0 else _field(df, k).desc_nulls_last()) for k, d in sort.items()]
    return df.orderBy(*keys)


def project(df: DataFrame, spec: dict | None) -> DataFrame:
    """Fields to keep (1), to leave out (0), or to compute; ``_id`` stays unless it is left out."""
    if not spec:
        return df
    wanted = {k: v for k, v in spec.items() if k != "_id"}
    if wanted and all(v in (0, False) and not isinstance(v, (dict, str)) for v in wanted.values()):
        return df.drop(*wanted, *(["_id"] if spec.get("_id", 1) in (0, False) else []))
    if not wanted:
        return df.drop("_id") if spec.get("_id") in (0, False) else df.select("_id")
    out = [F.col("_id")] if "_id" in df.columns and spec.get("_id", 1) not in (0, False) else []
    for k, v in wanted.items():
        out.append((_field(df, k) if v in (1, True) and not isinstance(v, (str, dict)) else value_of(df, v)).alias(k))
    return df.select(*out)


def find(df: DataFrame, query: dict | None = None, projection: dict | None = None, sort: dict | None = None, skip: int = 0, limit: int = 0) -> DataFrame:
    out = df.where(compile_filter(df, query))
    if sort:
        out = _sorted(out, sort)
    if skip:
        out = out.offset(skip)
    if limit:
        out = out.limit(abs(limit))
    return project(out, projection)


_MATH = {"$add": operator.add, "$subtract": operator.sub, "$multiply": operator.mul}


def value_of(df: DataFrame, e: Any) -> Column:
    if isinstance(e, str) and e.startswith("$"):
        return _field(df, e[1:])
    if isinstance(e, dict) and len(e) == 1 and next(iter(e)).startswith("$"):
        op, arg = next(iter(e.items()))
        if op == "$literal":
            return F.lit(arg)
        parts = [value_of(df, a) for a in (arg if isinstance(arg, list) else [arg])]
        if op in _MATH:
            return reduce(_MATH[op], parts)
        simple = {
            "$divide": lambda a, b: F.try_divide(a, b), "$mod": lambda a, b: F.try_mod(a, b), "$ifNull": lambda *a: F.coalesce(*a), "$concat": lambda *a: F.concat(*a),
            "$toLower": F.lower, "$toUpper": F.upper, "$size": F.size, "$abs": F.abs, "$floor": F.floor, "$ceil": F.ceil, "$eq": lambda a, b: a.eqNullSafe(b),
            "$gt": lambda a, b: a > b, "$gte": lambda a, b: a >= b, "$lt": lambda a, b: a < b, "$lte": lambda a, b: a <= b, "$cond": lambda a, b, c: F.when(a, b).otherwise(c),
        }
        if op in simple:
            return simple[op](*parts)
        raise DocumentError(f"unknown expression {op}")
    if isinstance(e, dict):
        return F.struct(*[value_of(df, v).alias(k) for k, v in e.items()])
    return F.lit(e)


def _accumulate(df: DataFrame, spec: dict) -> Column:
    (op, arg), *more = spec.items()
    x = value_of(df, arg) if arg != {} else F.lit(None)
    table = {
        "$sum": lambda: F.coalesce(F.sum(x), F.lit(0)), "$avg": lambda: F.avg(x), "$min": lambda: F.min(x), "$max": lambda: F.max(x), "$first": lambda: F.first(x),
        "$last": lambda: F.last(x), "$push": lambda: F.collect_list(x), "$addToSet": lambda: F.collect_set(x), "$count": lambda: F.count(F.lit(1)),
    }
    if more or op not in table:
        raise DocumentError(f"unknown accumulator {op}")
    return table[op]()


def aggregate(df: DataFrame, pipeline: list[dict] | None, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Stages in order, each a DataFrame operation."""
    for stage in pipeline or []:
        (name, spec), *more = stage.items()
        if more:
            raise DocumentError("a stage has one key")
        df = _stage(df, name, spec, tables or {})
    return df


def _stage(df: DataFrame, name: str, spec: Any, tables: dict[str, DataFrame]) -> DataFrame:
    if name == "$match":
        return df.where(compile_filter(df, spec))
    if name == "$sort":
        return _sorted(df, spec)
    if name == "$limit":
        return df.limit(spec)
    if name == "$skip":
        return df.offset(spec)
    if name == "$project":
        return project(df, spec)
    if name in ("$addFields", "$set"):
        return df.withColumns({k: value_of(df, v) for k, v in spec.items()})
    if name == "$unset":
        return df.drop(*([spec] if isinstance(spec, str) else spec))
    if name == "$count":
        return df.agg(F.count(F.lit(1)).alias(spec)).where(F.col(spec) > 0)
    if name == "$group":
        key = spec.get("_id")
        outputs = [_accumulate(df, v).alias(k) for k, v in spec.items() if k != "_id"]
        if key is None:
            return df.agg(F.count(F.lit(1)).alias("__n"), *outputs).where("__n > 0").select(F.lit(None).cast("string").alias("_id"), *[k for k in spec if k != "_id"])
        grouped = df.groupBy(value_of(df, key).alias("_id"))
        return grouped.agg(*outputs) if outputs else grouped.count().drop("count")
    if name == "$sortByCount":
        return df.groupBy(value_of(df, spec).alias("_id")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc_nulls_first("_id"))
    if name == "$unwind":
        path = spec if isinstance(spec, str) else spec["path"]
        keep = isinstance(spec, dict) and spec.get("preserveNullAndEmptyArrays")
        return df.withColumn(path[1:], (F.explode_outer if keep else F.explode)(_field(df, path[1:])))
    if name == "$unionWith":
        other = spec if isinstance(spec, str) else spec["coll"]
        more = aggregate(tables[other], spec.get("pipeline") if isinstance(spec, dict) else None, tables)
        return df.unionByName(more, allowMissingColumns=True)
    if name == "$lookup":
        # only keys that documents name are gathered; a document holds all of its matches by definition
        other, local = tables.get(spec["from"]), _field(df, spec["localField"])
        if other is None:
            return df.withColumn(spec["as"], F.array())
        named = df.select(local.alias("__k")).distinct()
        foreign = _field(other, spec["foreignField"])
        items = other.withColumn("__k", foreign).join(named.withColumnRenamed("__k", "__n"), F.col("__k").eqNullSafe(F.col("__n")), "left_semi")
        items = items.groupBy("__k").agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in other.columns])).alias("__items"))
        joined = df.join(items, local.eqNullSafe(F.col("__k")), "left")
        empty = F.array().cast(items.schema["__items"].dataType)
        return joined.withColumn(spec["as"], F.coalesce("__items", empty)).drop("__k", "__items")
    if name == "$bucket":
        bounds, by = spec["boundaries"], value_of(df, spec["groupBy"])
        key = reduce(lambda c, b: c.when((by >= b[0]) & (by < b[1]), b[0]), zip(bounds[1:], bounds[2:], strict=False), F.when((by >= bounds[0]) & (by < bounds[1]), bounds[0]))
        key = key.otherwise(F.lit(spec.get("default")))
        out = spec.get("output") or {"count": {"$sum": 1}}
        return df.groupBy(key.alias("_id")).agg(*[_accumulate(df, v).alias(k) for k, v in out.items()])
    if name == "$facet":
        # its answer is one document by definition, whose size is that of its branches; each branch is a column of its own
        parts = [aggregate(df, p, tables).agg(F.collect_list(F.struct("*")).alias(k)) for k, p in spec.items()]
        return df.sparkSession.range(1).select(*[p.scalar().alias(k) for p, k in zip(parts, spec, strict=True)])
    raise DocumentError(f"unknown stage {name}")


def apply_update(df: DataFrame, chosen: Column, update: dict, inserting: bool = False) -> DataFrame:
    """Change the chosen rows; fields that don't exist yet are added."""
    out = df
    for op, fields in update.items():
        if op == "$setOnInsert" and not inserting:
            continue
        for k, v in fields.items():
            old = _field(out, k)
            each = v["$each"] if isinstance(v, dict) and "$each" in v else [v]
            new = {
                "$set": lambda v=v: _literal(v), "$setOnInsert": lambda v=v: _literal(v), "$unset": lambda: F.lit(None),
                "$inc": lambda v=v, old=old: F.coalesce(old, F.lit(0)) + v, "$mul": lambda v=v, old=old: F.coalesce(old, F.lit(0)) * v,
                "$max": lambda v=v, old=old: F.greatest(old, F.lit(v)), "$min": lambda v=v, old=old: F.least(old, F.lit(v)),
                "$push": lambda e=each, old=old: F.concat(F.coalesce(old, F.array()), F.array(*map(F.lit, e))),
                "$addToSet": lambda e=each, old=old: reduce(lambda a, x: F.when(F.array_contains(a, x), a).otherwise(F.array_append(a, F.lit(x))), e, F.coalesce(old, F.array(*map(F.lit, e[:0])))),
            }.get(op)
            if new is None:
                raise DocumentError(f"unknown update operator {op}")
            out = out.withColumn(k, F.when(chosen, new()).otherwise(_as(old, out, k, v)))
    return out


def _as(old: Column, df: DataFrame, path: str, value: Any) -> Column:
    """The old value; as text where a text comes to stand beside values of another type."""
    return old.cast("string") if isinstance(value, str) and not isinstance(_type(df, path), (T.StringType, T.ArrayType)) else old


def first_match(df: DataFrame, query: dict | None, key: str = "_id") -> Any:
    """Key of the matching row with the smallest one, or None."""
    row = df.where(compile_filter(df, query)).agg(F.min(key)).first()
    return row[0] if row else None


def is_update(update: Any) -> bool:
    return isinstance(update, dict) and bool(update) and all(re.match(r"\$\w+$", k) for k in update)
