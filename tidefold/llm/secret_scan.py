"""Secret scans with multipart credential linking, in DataFrame expressions only.

Three base kinds are always reported. Three weak kinds (access identifiers, secrets, endpoints)
are candidates which count only when complementary parts stand near them in the same scope:
an interval join of the parts of a text, made within the row as a merge over the parts sorted by
start. A scope is a run of lines without a blank line, and parts are near when their starts are at
most ``WINDOW`` code points apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import let

#: Base kinds as the contract states them, in listed order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Weak kinds.
IDENT = r"""(?i)\b(?:access_?key_?id|client_?id|account_?id|app_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
WEAK = r"""(?i)\b(?:pwd|pass|passphrase|private_?key|access_?key|auth|credential|key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}"""
ENDPOINT = r"""\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]{4,}"""
BLANK = r"\n[ \t]*\n"

KINDS = ("assign", "access", "hex", "ident", "weak", "endpoint")
_BOUNDARY = len(KINDS)
MIN_SECRET = 6
WINDOW = 240
#: No more parts than this can start within WINDOW on one side of a part in its scope: spans of a
#: kind don't overlap, and the shortest of each kind have 12, 20, 24, 7, 12 and 9 code points.
REACH = 160
_BLOCK = 64
_FAR = (1 << 31) - 1
_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _none() -> Column:
    return F.from_json(F.lit("[]"), _SPAN)


def _before(values: Column, of: Callable[[Column, Column], Column], start: int) -> Column:
    """What all earlier elements come to, in two levels so that long arrays stay cheap."""

    def fold(part: Column, first: Column) -> Column:
        return F.aggregate(part, first, of)

    def body(v: Column) -> Column:
        tops = F.aggregate(
            F.sequence(F.lit(0), F.floor(F.greatest(F.lit(0), F.size(v) - 1) / _BLOCK).cast("int")),
            F.array(F.lit(start)),
            lambda acc, b: F.concat(acc, F.array(fold(F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)), F.element_at(acc, -1)))),
        )

        def at(top: Column, i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            return fold(F.slice(v, block * _BLOCK + 1, i % _BLOCK), F.get(top, block))

        return let(tops, lambda top: F.transform(v, lambda _, i: at(top, i)))

    return let(values, body)


def _sums_before(values: Column) -> Column:
    return _before(values, lambda a, x: a + x, 0)


def _spans(text: Column, pattern: str, kind: int, value_group: int | None = None) -> Column:
    """Spans of leftmost non-overlapping matches in code points: what split() leaves between
    the matches gives the gaps."""

    def found(m: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        sizes = F.transform(m, F.length)

        def placed(g: Column, z: Column) -> Column:
            before = _sums_before(F.transform(z, lambda n, i: n + F.get(g, i)))
            return let(
                before,
                lambda at: F.transform(
                    z,
                    lambda n, i: F.struct(
                        (F.get(at, i) + F.get(g, i)).alias("start"),
                        F.lit(kind).alias("kind"),
                        (F.get(at, i) + F.get(g, i) + n).alias("end"),
                    ),
                ),
            )

        spans = let(gaps, lambda g: let(sizes, lambda z: placed(g, z)))
        if value_group is None:
            return spans
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
        return let(values, lambda v: F.filter(spans, lambda _, i: F.length(F.get(v, i)) >= MIN_SECRET))

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(matches, lambda m: F.when(F.size(m) == 0, _none()).otherwise(found(m)))


def _linked(parts: Column) -> Column:
    """Base spans, and the weak ones whose complement is near. ``parts`` is sorted and holds scope ends.

    A weak part that overlaps a base span, however far back that began, belongs to it and isn't reported.
    """
    scopes = _sums_before(F.transform(parts, lambda p: F.when(p["kind"] == _BOUNDARY, 1).otherwise(0)))
    ends = _before(F.transform(parts, lambda p: F.when(p["kind"] < 3, p["end"]).otherwise(0)), lambda a, x: F.greatest(a, x), 0)
    starts = F.reverse(F.transform(parts, lambda p: F.when(p["kind"] < 3, p["start"]).otherwise(_FAR)))
    following = F.reverse(_before(starts, lambda a, x: F.least(a, x), _FAR))

    def decide(scope: Column, covered: Column, ahead: Column) -> Column:
        def keep(x: Column, i: Column) -> Column:
            first = F.greatest(F.lit(0), i - REACH)
            around = F.transform(
                F.slice(parts, first + 1, F.lit(2 * REACH + 1)),
                lambda p, k: F.when(
                    (F.get(scope, first + k) == F.get(scope, i)) & (F.abs(p["start"] - x["start"]) <= WINDOW), p
                ),
            )

            def near(a: Column, *kinds: int) -> Column:
                return F.coalesce(F.exists(a, lambda p: F.coalesce(p["kind"].isin(*kinds), F.lit(False))), F.lit(False))

            def linked(a: Column) -> Column:
                secret, ident, endpoint = near(a, 0, 2, 4), near(a, 1, 3), near(a, 5)
                return ((x["kind"] == 3) & secret) | ((x["kind"] == 4) & (ident | endpoint)) | ((x["kind"] == 5) & secret & ident)

            inside = (F.get(covered, i) > x["start"]) | (F.get(ahead, i) < x["end"])
            return (x["kind"] < 3) | ((x["kind"] < _BOUNDARY) & ~inside & let(around, linked))

        return F.filter(parts, keep)

    return let(scopes, lambda scope: let(ends, lambda covered: let(following, lambda ahead: decide(scope, covered, ahead))))


def spans_column(text: Column) -> Column:
    """All reported spans of a text: array of (start, kind, end), by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    base = F.concat(_spans(text, ASSIGN, 0, 2), _spans(text, ACCESS, 1), _spans(text, HEX, 2))
    weak = F.concat(_spans(text, IDENT, 3), _spans(text, WEAK, 4), _spans(text, ENDPOINT, 5))

    def join(b: Column, w: Column) -> Column:
        parts = F.array_sort(F.concat(b, w, _spans(text, BLANK, _BOUNDARY)))
        # one part alone, or no weak part, needs no search for complements
        return F.when((F.size(w) == 0) | (F.size(b) + F.size(w) < 2), F.array_sort(b)).otherwise(let(parts, _linked))

    return let(base, lambda b: let(weak, lambda w: join(b, w)))


def scan_secrets(df: DataFrame, text_col: str = "text", spans_col: str = "secret_spans") -> DataFrame:
    """Append the array of secret spans to each row; no shuffle, rows stay independent.

    A null or empty text has no spans. Rows are neither merged nor dropped, and other columns pass
    through; one named like ``spans_col`` is replaced.
    """
    return df.withColumn(spans_col, spans_column(F.col(f"`{text_col}`")))


def describe_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def secret_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, digest of base spans and all spans of each row; ids may be null or repeated."""
    scanned = scan_secrets(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))).drop("text")
    spans = F.col("secret_spans")

    def count(kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    base = describe_spans(F.filter(spans, lambda s: s["kind"] < 3))
    return scanned.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(base, 256).alias("base_sha256"),
        describe_spans(spans).alias("spans"),
    )


def redact_secrets(df: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """Replace every reported span by ``mark``; a null text stays null, all rows stay.

    Overlapping spans are replaced together, once.
    """
    text = F.col(f"`{text_col}`")

    def rebuild(spans: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        folded = F.aggregate(
            spans,
            start,
            lambda acc, s: F.when(
                s["start"] >= acc["at"],
                F.struct(
                    s["end"].alias("at"),
                    F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)).alias("out"),
                ),
            ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
            lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
        )
        return F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(folded)

    return df.withColumn(text_col, let(spans_column(text), rebuild))
