"""Log lines to validated, flattened records, in expressions only.

A document is a map from property name to the JSON text of its value: it can be grouped, compared
and stored as Parquet, which a variant can't.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Key names of the log format.
PAYLOAD_KEYS = ("#time", "#type", "#event_name")
ENVELOPE_KEYS = ("msg", "message", "log")
META_KEYS = ("#uuid", "#type", "#time", "#user_id", "#account_id", "#distinct_id", "_ts")

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def json_object(text: Column) -> Column:
    """A strict JSON object as a map of variants, or null.

    The text is parsed as the only element of an array, which the parser reads to its end; so
    what follows the object makes it fail.
    """
    wrapped = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<map<string,variant>>", _STRICT)
    ends = F.rtrim(F.translate(text, "\t\r\n", "   ")).endswith("}")
    return F.when(ends, let(wrapped, lambda w: F.when(F.size(w) == 1, F.get(w, F.lit(0)))))


def string_at(doc: Column, key: str) -> Column:
    """The value of a key if it is a JSON string, else empty."""
    text = F.try_variant_get(F.try_element_at(doc, F.lit(key)), "$", "string")
    is_string = F.schema_of_variant(F.try_element_at(doc, F.lit(key))) == "STRING"
    return F.coalesce(F.when(is_string, text), F.lit(""))


def is_payload(doc: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.map_contains_key(doc, k) for k in PAYLOAD_KEYS))


def json_texts(doc: Column) -> Column:
    return F.transform_values(doc, lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))


def overlay(*docs: Column) -> Column:
    """Maps laid over each other; of equal keys the last one's value stays."""
    return reduce(lambda low, high: F.map_concat(F.map_filter(low, lambda k, _: ~F.map_contains_key(high, k)), high), docs)


def text_of(json: Column) -> Column:
    """The string that a JSON text of a string stands for, else null."""
    return F.when(json.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), json, F.lit("}")), "$.v"))


def json_of(text: Column) -> Column:
    """JSON text of a string."""
    inner = F.to_json(F.struct(text.alias("v")))
    return F.substring(inner, 6, F.length(inner) - 6)


def parse_lines(df: DataFrame, line: str = "line", seq: str = "seq", ts: str | None = None) -> DataFrame:
    """Columns seq, line, error, type, uuid, account_id, distinct_id, category, time, doc and _ts.

    ``error`` is null for a valid record; the fields are null otherwise. Empty and null lines are
    skipped. ``_ts`` is the given column, or else the sequence number.
    """
    src = df.where((F.col(line).isNotNull()) & (F.col(line) != "")).select(
        F.col(seq).alias("seq"), F.col(line).alias("line"), F.col(ts or seq).cast("long").alias("_ts")
    )
    record = let(json_object(F.col("line")), lambda obj: let(_payload(obj), lambda p: _record(obj, p)))
    # a generator keeps later filters on the result from being put below, where they would parse again
    out = src.select("seq", "line", "_ts", F.inline(F.array(record)))
    return out.select("seq", "line", "error", "type", "uuid", "account_id", "distinct_id", "category", "time", "doc", "_ts")


def _payload(obj: Column) -> Column:
    """The object itself, or the first envelope's object that is a payload; nulls are no payload."""

    def first(keys: tuple[str, ...]) -> Column:
        if not keys:
            return F.lit(None).cast("map<string,variant>")
        inner = let(string_at(obj, keys[0]), lambda t: json_object(F.when(t.startswith("{"), t)))
        return let(inner, lambda x: F.when(is_payload(x), x).otherwise(first(keys[1:])))

    return F.when(is_payload(obj), obj).when(obj.isNotNull(), first(ENVELOPE_KEYS))


def _record(obj: Column, payload: Column) -> Column:
    names = (("#type", "type"), ("#uuid", "uuid"), ("#time", "time"), ("#account_id", "account_id"), ("#distinct_id", "distinct_id"), ("#event_name", "event_name"))
    fields = F.struct(*[string_at(payload, k).alias(n) for k, n in names])

    def judged(f: Column) -> Column:
        kind = F.when(f["type"].startswith("user_"), "user").when(f["type"].startswith("track"), "event").otherwise("none")
        # fixed values: the error texts of the log format
        error = let(
            kind,
            lambda k: F.when(obj.isNull() & (F.trim(F.col("line")) != "null"), "invalid JSON")
            .when(payload.isNull(), "not a log payload")
            .when((f["type"] == "") | (f["uuid"] == ""), "#type and #uuid are required (non-empty)")
            .when(k == "none", F.concat(F.lit('unsupported #type "'), f["type"], F.lit('": only user_* and track* are allowed')))
            .when(f["time"] == "", F.concat(k, F.lit(" record: #time is required")))
            .when((k == "event") & (f["event_name"] == ""), "event record: #event_name is required")
            .when(
                (f["account_id"] == "") & (f["distinct_id"] == ""),
                F.concat(k, F.lit(" record: at least one of #account_id or #distinct_id is required")),
            ),
        )

        def built(e: Column) -> Column:
            good = e.isNull()
            return F.struct(
                e.alias("error"),
                *[F.when(good, f[n]).alias(n) for n in ("type", "uuid", "account_id", "distinct_id", "time")],
                F.when(good, kind).alias("category"),
                F.when(good, _flat(payload, f)).alias("doc"),
            )

        return let(error, built)

    return let(fields, judged)


def _flat(payload: Column, f: Column) -> Column:
    stamp = F.create_map(F.lit("#time"), json_of(f["time"]), F.lit("#uuid"), json_of(f["uuid"]), F.lit("_ts"), F.col("_ts").cast("string"))
    props = F.try_element_at(payload, F.lit("properties"))
    inner = F.when(F.schema_of_variant(props).startswith("OBJECT"), F.try_variant_get(props, "$", "map<string,variant>"))

    def joined(p: Column) -> Column:
        root = F.map_filter(payload, lambda k, _: k != "properties")
        return F.when(p.isNotNull(), overlay(json_texts(root), json_texts(p), stamp)).otherwise(overlay(json_texts(payload), stamp))

    return let(inner, joined)


def routing_key() -> Column:
    """Account id, else distinct id: what a shuffle by user deals out by."""
    return F.coalesce(F.nullif(F.col("account_id"), F.lit("")), F.nullif(F.col("distinct_id"), F.lit("")), F.lit(""))


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where("error is not null").select("_ts", "line", "error")
