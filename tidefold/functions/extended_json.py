"""Extended JSON: typed values in requests and answers.

Requests may write values as ``{"$numberLong": "1"}`` and alike; answers are in the relaxed form, where
only dates, decimals, object ids and bytes are marked.
"""

from __future__ import annotations

import base64
import datetime as dt
import decimal
import json
import math
import re
from typing import Any


class ObjectId(str):
    """An object id: 24 hexadecimal digits. Tables hold it as text."""


_OBJECT_ID = re.compile(r"[0-9a-f]{24}").fullmatch
_UTC = dt.timezone.utc


def _date(value: Any) -> dt.datetime:
    if isinstance(value, str):
        when = dt.datetime.fromisoformat(value)
        return when if when.tzinfo else when.replace(tzinfo=_UTC)
    return dt.datetime(1970, 1, 1, tzinfo=_UTC) + dt.timedelta(milliseconds=int(value))


def _object_id(value: str) -> ObjectId:
    if not _OBJECT_ID(value.lower()):
        raise ValueError(f"not an object id: {value!r}")
    return ObjectId(value.lower())


#: The marks of typed values.
_READERS = {
    "$oid": _object_id, "$date": _date, "$numberInt": int, "$numberLong": int, "$numberDouble": float, "$numberDecimal": decimal.Decimal,
    "$uuid": str, "$symbol": str, "$binary": lambda v: base64.b64decode(v["base64"] if isinstance(v, dict) else v), "$undefined": lambda _: None,
}


def typed(value: Any) -> Any:
    """Marked values as what they stand for, at any depth; other values as they are."""
    if isinstance(value, dict):
        if len(value) == 1 and (mark := next(iter(value))) in _READERS:
            try:
                return _READERS[mark](typed(value[mark]))
            except (ValueError, TypeError, KeyError, decimal.InvalidOperation) as e:
                raise ValueError(f"{mark}: {e}") from e
        return {k: typed(v) for k, v in value.items()}
    return [typed(v) for v in value] if isinstance(value, list) else value


def decode(text: str | bytes) -> Any:
    return typed(json.loads(text))


def marked(value: Any, key: str = "") -> Any:
    """A value as relaxed Extended JSON; an ``_id`` of an object id's form is one."""
    if isinstance(value, dict):
        return {k: marked(v, k) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [marked(v) for v in value]
    if isinstance(value, ObjectId) or isinstance(value, str) and key in ("_id", "insertedId", "upsertedId") and _OBJECT_ID(value):
        return {"$oid": str(value)}
    if isinstance(value, dt.datetime):
        when = value.astimezone(_UTC) if value.tzinfo else value.replace(tzinfo=_UTC)
        fraction = f".{when.microsecond // 1000:03d}" if when.microsecond >= 1000 else ""
        return {"$date": when.strftime("%Y-%m-%dT%H:%M:%S") + fraction + "Z"}
    if isinstance(value, dt.date):
        return {"$date": f"{value.isoformat()}T00:00:00Z"}
    if isinstance(value, decimal.Decimal):
        return {"$numberDecimal": format(value, "f")}
    if isinstance(value, (bytes, bytearray)):
        return {"$binary": {"base64": base64.b64encode(value).decode(), "subType": "00"}}
    if isinstance(value, float) and not math.isfinite(value):
        return {"$numberDouble": "NaN" if math.isnan(value) else "Infinity" if value > 0 else "-Infinity"}
    return value


def encode(value: Any) -> str:
    return json.dumps(marked(value), default=str, ensure_ascii=False)
