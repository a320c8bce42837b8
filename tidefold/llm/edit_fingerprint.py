"""Document fingerprints by a randomised edit embedding.

All texts share random walks over their characters: at step j the walk writes the character it
stands on, and moves on if a random bit of (j, character) says so. Texts at a small edit distance
meet again soon after an edit, so edit distance becomes Hamming distance between the written
strings. A fingerprint samples the written string at shared random steps, as many in each octave
of steps, so that texts of all lengths are sampled evenly; likeness weighs an octave by its width.
An edit after which a walk doesn't meet again makes near copies look unlike, so a fingerprint holds
several independent walks, and likeness is that of the walk on which two texts agree best.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heapreplace
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, NumericType, StructField, StructType

from ._common import checkpoint, let, map_text
from ._links import components, join_by_key, meetings

SEED = 20
#: The random bits repeat after PERIOD steps; characters fall in CLASSES classes by hash.
PERIOD, CLASSES = 4096, 64
#: Octaves of steps, and samples in each, one at random in each equal part. The first octave is the first
#: SAMPLES steps, all of them; each later one is as wide as all before it. The last ends at 2**31 steps, about a thousand million characters.
OCTAVES, SAMPLES = 28, 16
#: Independent walks of a fingerprint, and what stands between them in it.
WALKS, BETWEEN = 4, "-"
#: Texts are walked side by side, in groups of so many characters; ones longer than this share of a group go alone.
GROUP, ALONE = 3_000_000, 0.25
_HEX = "0123456789abcdef"


def classes_of(codes: np.ndarray) -> np.ndarray:
    return ((codes * np.uint32(2654435761)) >> np.uint32(26)).astype(np.uint8)


def octave(k: int) -> tuple[int, int]:
    """First step and width of an octave."""
    return (SAMPLES << (k - 1), SAMPLES << (k - 1)) if k else (0, SAMPLES)


class OneWalk:
    """A shared walk, as an automaton whose state is a row of next states by class; its last entry is the step."""

    def __init__(self, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        moves = rng.integers(0, 2, (CLASSES, PERIOD), np.int8).astype(bool)
        moves[:, -1] = True
        # for each class and step, the step after the next move
        after = np.empty((CLASSES, PERIOD), np.int64)
        nxt = np.full(CLASSES, PERIOD)
        for j in range(PERIOD - 1, -1, -1):
            nxt = np.where(moves[:, j], j + 1, nxt)
            after[:, j] = nxt
        rows: list[list] = [[] for _ in range(PERIOD)]
        for j, row in enumerate(rows):
            row.extend(rows[k % PERIOD] for k in after[:, j].tolist())
            row.append(j)
        self.rows = rows
        self.table = (after % PERIOD).astype(np.int32)
        steps = []
        for k in range(OCTAVES):
            low, width = octave(k)
            steps.append(low + ((np.arange(SAMPLES) + rng.random(SAMPLES)) * (width // SAMPLES)).astype(np.int64))
        self.steps = np.concatenate(steps)
        self.values = rng.integers(1, 16, (997, 251), np.int64)

    def codes(self, text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")

    def run(self, codes: np.ndarray, state: list | None = None, at: int = 0) -> tuple[np.ndarray, list, int]:
        """Steps at which each character is entered, and state and step after the last."""
        phase = self.phases(classes_of(codes), self.rows[0] if state is None else state)
        entered, end = self.entered(phase, at)
        return entered, self.rows[int(phase[-1])], end

    def phases(self, classes: np.ndarray, state: list) -> np.ndarray:
        states = accumulate(classes.tobytes(), getitem, initial=state)
        return np.fromiter(map(itemgetter(-1), states), np.uint16, len(classes) + 1)

    def entered(self, phase: np.ndarray, at: int = 0) -> tuple[np.ndarray, int]:
        """Steps at which the characters are entered, and the step after the last; each period's first step is entered."""
        steps = phase.astype(np.int64)
        steps[1:] += PERIOD * np.cumsum(phase[1:] == 0)
        steps += at - int(phase[0])
        return steps[:-1], int(steps[-1])

    def sample(self, codes: np.ndarray, entered: np.ndarray, end: int) -> str:
        """A hexadecimal digit for each sampled step, 0 beyond the end."""
        steps = self.steps[: np.searchsorted(self.steps, end)]
        if not len(steps):
            return ""
        where = np.searchsorted(entered, steps, "right") - 1
        digits = self.values[np.arange(len(steps)) % 997, codes[where] % 251]
        return "".join(map(_HEX.__getitem__, digits.tolist()))


class Walk(OneWalk):
    """All walks; itself the first."""

    def __init__(self) -> None:
        super().__init__()
        self.all = [self, *(OneWalk(SEED + k) for k in range(1, WALKS))]
        # next phase by walk, class and phase; a walk's phases are marked by its place in the table
        self.offsets = (np.arange(WALKS, dtype=np.int32) * (CLASSES * PERIOD))[:, None]
        self.tables = np.concatenate([w.table.ravel() + o for w, o in zip(self.all, self.offsets[:, 0], strict=True)]).astype(np.int32)

    def fingerprint(self, text: str) -> str:
        codes = self.codes(text)
        return joined([w.sample(codes, *w.run(codes)[::2]) for w in self.all])

    def phases_of(self, texts: list[np.ndarray], starts: list[list[int]] | None = None) -> list[list[np.ndarray]]:
        """Phases of all walks at each character of each text and after its last, from the given ones or 0."""
        total = sum(map(len, texts))
        out: list = [None] * len(texts)
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        alone = 0
        while alone < len(order) and len(texts[order[alone]]) > ALONE * total:
            i = order[alone]
            classes = classes_of(texts[i])
            out[i] = [w.phases(classes, w.rows[starts[i][k] if starts else 0]) for k, w in enumerate(self.all)]
            alone += 1
        order = order[alone:]
        if not order:
            return out
        # texts lie one after another in lanes of about equal length; all lanes take a step at once
        longest = max(1, len(texts[order[0]]))
        n = min(len(order), max(1, sum(len(texts[i]) for i in order) // longest))
        lanes = [(0, k) for k in range(n)]
        heapify(lanes)
        places = []
        for i in order:
            at, lane = lanes[0]
            places.append((at, lane, i))
            heapreplace(lanes, (at + len(texts[i]) + 1, lane))
        length = max(lanes)[0]
        classes = np.zeros((n, length), np.uint8)
        begins: dict[int, list[tuple[int, int]]] = {}
        for at, lane, i in places:
            classes[lane, at : at + len(texts[i])] = classes_of(texts[i])
            begins.setdefault(at, []).append((lane, i))
        shifted = np.ascontiguousarray(classes.T).astype(np.int32) * PERIOD
        phase = np.zeros((length + 1, WALKS, n), np.int32)
        index = np.empty((WALKS, n), np.int64)
        bounds = [*sorted(begins), length]
        for low, high in zip(bounds, bounds[1:], strict=False):
            for lane, i in begins[low]:
                phase[low, :, lane] = self.offsets[:, 0] + (starts[i] if starts else 0)
            for step, now, then in zip(shifted[low:high], phase[low:high], phase[low + 1 : high + 1], strict=True):
                np.add(step, now, out=index)
                self.tables.take(index, out=then, mode="clip")
        by_lane = np.ascontiguousarray((phase & (PERIOD - 1)).astype(np.uint16).transpose(1, 2, 0))
        for at, lane, i in places:
            out[i] = list(by_lane[:, lane, at : at + len(texts[i]) + 1])
        return out

    def fingerprints(self, texts: list[str | None]) -> list[str]:
        out = []
        for codes_of in _groups([self.codes(t or "") for t in texts], len):
            for codes, phases in zip(codes_of, self.phases_of(codes_of), strict=True):
                out.append(joined([w.sample(codes, *w.entered(p)) for w, p in zip(self.all, phases, strict=True)]))
        return out


def joined(prints: list[str]) -> str:
    """The walks' samples as one text, which is empty if they all are."""
    return BETWEEN.join(prints) if any(prints) else ""


def _groups(items: list, size) -> Iterator[list]:
    group, total = [], 0
    for x in items:
        group.append(x)
        total += size(x)
        if total >= GROUP:
            yield group
            group, total = [], 0
    if group:
        yield group


@lru_cache(maxsize=1)
def shared_walk() -> Walk:
    """A worker process keeps the tables from task to task."""
    return Walk()


#: Weight of each sample, and the sum of those before it.
_WEIGHTS = np.repeat([float(octave(k)[1]) for k in range(OCTAVES)], SAMPLES) / SAMPLES
_TOTALS = np.concatenate([[0.0], np.cumsum(_WEIGHTS)])


def likeness(a: str, b: str) -> float:
    """The greatest, over the walks, share of equal samples. Two empty fingerprints are equal.

    Where one walk has all samples equal but another hasn't, it stays a little below one: only equal fingerprints are wholly alike.
    """
    if a == b:
        return 1.0
    shares = [_likeness(x.encode(), y.encode()) for x, y in zip(a.split(BETWEEN), b.split(BETWEEN), strict=False) if x or y]
    best = max(shares, default=0.0)
    return best if best < 1 else 1 - 0.001 * (1 - sum(shares) / len(shares))


def _likeness(a: bytes, b: bytes) -> float:
    """Octaves are weighed by width; samples beyond both ends don't count."""
    n = min(len(a), len(b))
    same = np.frombuffer(a, np.uint8, n) == np.frombuffer(b, np.uint8, n) if n else np.zeros(0, bool)
    return float(_WEIGHTS[:n] @ same / _TOTALS[max(len(a), len(b))])


def _digest_schema(source: DataFrame) -> StructType:
    return StructType.fromDDL(
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


def fingerprints(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """Append each whole text's fingerprint; null and empty texts have the empty one. Rows stay as they are."""

    def make():
        walk = shared_walk()
        return lambda texts: [walk.fingerprints(texts)]

    return map_text(df, text_col, f"`{out_col}` string", make, df.columns)


def _cuts(ids: DataFrame, n: int) -> list:
    """At most n - 1 ids that part the others into about equal ranges, ascending."""
    if isinstance(ids.schema[0].dataType, NumericType):
        return sorted(set(ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)).first()[0] or []))
    ranges = ids.where("doc_id is not null").repartitionByRange(n, "doc_id").groupBy(F.spark_partition_id().alias("p"))
    return sorted(r["low"] for r in ranges.agg(F.min("doc_id").alias("low")).collect())[1:]


def _array(values: list, kind: DataType) -> Column:
    """A constant array; folded into one literal, however long it is."""
    return F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.array().cast(ArrayType(kind))


def _bucket(value: Column, cuts: Column, n: int) -> Column:
    """Number of cuts below or at a value, by binary search in a constant array; 0 for null."""

    def step(span: Column, _: Column) -> Column:
        mid = F.floor((span["low"] + span["high"]) / 2).cast("int")
        above = F.coalesce(value >= F.get(cuts, mid), F.lit(False))
        halved = F.struct(F.when(above, mid + 1).otherwise(span["low"]).alias("low"), F.when(above, span["high"]).otherwise(mid).alias("high"))
        return F.when(span["low"] < span["high"], halved).otherwise(span)

    whole = F.struct(F.lit(0).alias("low"), F.lit(n).alias("high"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(n.bit_length())), whole, step, lambda span: span["low"])


def in_id_order(docs: DataFrame, n: int) -> DataFrame:
    """Rows (doc_id, text) dealt into ``n`` ranges of ids, sorted within, each range followed by the next one's first row.

    Ids are numbers or texts. ``follower`` marks those rows; the last range is followed by the first row
    of all. Only the bounds of the ranges, as many as partitions, reach the driver.
    """
    ids = docs.select("doc_id")
    kind = ids.schema[0].dataType
    cuts = _cuts(ids, max(n, 2))
    value = F.col("doc_id")
    bucket = _bucket(value, _array(cuts, kind), len(cuts))
    firsts = {r["b"]: r for r in ids.groupBy(bucket.alias("b")).agg(F.min("doc_id").alias("i"), F.count_if(value.isNull()).alias("nulls")).collect()}
    used = sorted(firsts)
    if not used:
        return docs.select(F.lit(0).alias("bucket"), F.lit(False).alias("follower"), "doc_id", "text")
    # for each range: its first id, and the range before it, to which its first row goes too
    nulls = firsts[used[0]]["nulls"] > 0
    first = [firsts[k]["i"] if k in firsts and not (nulls and k == used[0]) else None for k in range(len(cuts) + 1)]
    before = [used[used.index(k) - 1] if k in firsts else None for k in range(len(cuts) + 1)]
    own = let(
        bucket,
        lambda b: F.struct(
            b.alias("bucket"),
            F.when(F.get(_array(first, kind), b) == value, F.get(_array(before, IntegerType()), b))
            .when(value.isNull(), F.lit(before[used[0]]))
            .alias("target"),
        ),
    )
    places = F.array(
        F.struct(F.col("own.bucket").alias("bucket"), F.lit(False).alias("follower")),
        F.struct(F.col("own.target").alias("bucket"), F.lit(True).alias("follower")),
    )
    both = docs.withColumn("own", own).select("doc_id", "text", F.inline(F.filter(places, lambda x: x["bucket"].isNotNull())))
    dealt = both.repartitionById(max(n, 1), F.col("bucket"))
    return dealt.sortWithinPartitions("bucket", "follower", "doc_id", "text").select("bucket", "follower", "doc_id", "text")


def edited_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text: its second half replaced by the next document's beginning.

    Documents follow each other by ascending id, null first, equal ids by text; the first follows
    the last. Ids are numbers, or texts in the order of their bytes. A null text is empty. Every row
    gives a row, an empty table none; other columns are ignored.
    """
    spark = df.sparkSession
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = in_id_order(docs, n)
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *_digest_schema(docs).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = shared_walk()
        last = None  # the row before the group
        types = None

        def digests(rows: list[_Row]) -> pa.RecordBatch:
            for row, phases in zip(rows, walk.phases_of([r.codes for r in rows]), strict=True):
                row.walked(walk, phases)
            before = [last, *rows[:-1]]
            pairs = [(a, b) for a, b in zip(before, rows, strict=True) if a is not None and not a.follower and a.bucket == b.bucket]
            columns = list(zip(*_compare(walk, pairs), strict=True)) or [()] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

        rows, chars = [], 0
        for batch in batches:
            types = [batch.schema.field(2).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            for values in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                rows.append(_Row(*values[:3], walk.codes(values[3])))
                chars += len(rows[-1].codes)
                if chars >= GROUP:
                    yield digests(rows)
                    last, rows, chars = rows[-1], [], 0
        if rows:
            yield digests(rows)

    return ordered.mapInArrow(run, schema)


class _Row:
    def __init__(self, bucket: int, follower: bool, doc_id, codes: np.ndarray) -> None:
        self.bucket, self.follower, self.doc_id, self.codes = bucket, follower, doc_id, codes

    def walked(self, walk: Walk, phases: list[np.ndarray]) -> None:
        """Keep, for each walk, the phases, and the fingerprint."""
        self.phases = phases
        self.own = joined([w.sample(self.codes, *w.entered(p)) for w, p in zip(walk.all, phases, strict=True)])


def _compare(walk: Walk, pairs: list[tuple[_Row, _Row]]) -> Iterator[tuple]:
    """Digests of rows and the rows that follow them. An edited text is walked from where its own text ends."""
    tails = [b.codes[: len(a.codes) // 2] for a, b in pairs]
    kept = [len(a.codes) - len(a.codes) // 2 for a, _ in pairs]
    starts = [[int(p[k]) for p in a.phases] for (a, _), k in zip(pairs, kept, strict=True)]
    for (a, b), tail, k, phases in zip(pairs, tails, kept, walk.phases_of(tails, starts), strict=True):
        edited = np.concatenate([a.codes[:k], tail])
        prints = []
        for w, own, rest in zip(walk.all, a.phases, phases, strict=True):
            prints.append(w.sample(edited, *w.entered(np.concatenate([own[:k], rest]))))
        changed = joined(prints)
        digest = hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest()
        yield a.doc_id, len(a.codes), digest, a.own, changed, likeness(a.own, changed), likeness(a.own, b.own)


#: Banding: samples in a band, bands of an octave, and octaves that are banded: the last a walk reaches and those before it.
BAND, BANDS, BANDED = 8, 12, 3
#: Samples in a band of texts that end in the first octave.
SHORT_BAND = 3
#: Fingerprints of a chunk of a common band.
BAND_CHUNK = 128


@lru_cache(maxsize=1)
def _places() -> list[list[int]]:
    """Samples of an octave that make its bands: its halves, for edits that lie together, then random ones."""
    rng = np.random.default_rng(SEED)
    halves = [list(range(BAND)), list(range(SAMPLES - BAND, SAMPLES))]
    return halves + [sorted(rng.choice(SAMPLES, BAND, replace=False).tolist()) for _ in range(BANDS - len(halves))]


def band_keys(fingerprint: str) -> set[int]:
    """Keys of a fingerprint's bands; texts whose fingerprints share one are compared."""
    keys = set()
    for walk, own in enumerate(fingerprint.split(BETWEEN)):
        last = (len(own) - 1) // SAMPLES if own else -1
        for k in range(max(0, last - BANDED + 1), last + 1):
            part = own[k * SAMPLES : (k + 1) * SAMPLES]
            bands = [p for p in _places() if p[-1] < len(part)]
            if not last:
                bands = [list(range(i, i + SHORT_BAND)) for i in range(len(part) - SHORT_BAND + 1)]
            for n, places in enumerate(bands):
                digits = "".join([part[i] for i in places])
                keys.add(xxhash.xxh64_intdigest(f"{walk} {k} {places[0] if not last else n} {len(places)} {digits}") - (1 << 63))
    return keys


def spanning_pairs(items: list[tuple[int, str]], least: float) -> list[tuple[int, int]]:
    """A spanning forest of the graph that links (node, fingerprint) of at least this likeness."""
    root = list(range(len(items)))
    edges = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (node, own) in enumerate(items):
        for j in range(i):
            a, b = find(i), find(j)
            if a != b and likeness(own, items[j][1]) >= least:
                root[a] = b
                edges.append((node, items[j][0]))
    return edges


def near_documents(df: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint and class_id of every row; a class is named by the smallest id in it.

    Rows of equal fingerprints are one class. Fingerprints that agree on a band, some samples of an
    octave of a walk, meet and are verified: those of at least the given likeness link. Null and empty
    texts form one class; a class without an id has a null class_id. An empty table gives no rows.
    The README has the recall of the bands.
    """
    prints = fingerprints(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))).drop("text")
    prints = checkpoint(prints)
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    classes = checkpoint(classes.withColumn("node", F.monotonically_increasing_id()))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, own = (batch.column(k).to_pylist() for k in (0, 1))
            found = [(n, f, sorted(band_keys(f))) for n, f in zip(nodes, own, strict=True)]
            rows = [(n, f, k) for n, f, keys in found for k in keys]
            items = pa.array([{"node": n, "fingerprint": f} for n, f, _ in rows], pa.struct([("node", pa.int64()), ("fingerprint", pa.string())]))
            yield pa.RecordBatch.from_arrays([items, pa.array([k for *_, k in rows], pa.int64())], names=["item", "key"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = ([(x["node"], x["fingerprint"]) for x in group] for group in batch.column(0).to_pylist())
            edges = [e for group in groups for e in spanning_pairs(group, least)]
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    bands = checkpoint(classes.select("node", "fingerprint").mapInArrow(keyed, "item struct<node:bigint,fingerprint:string>, key long"))
    links = meetings(bands, "item", BAND_CHUNK).mapInArrow(verify, "a long, b long")
    roots = components(links.distinct())
    linked = classes.join(roots, "node").select("node", "root", "first_id")
    lowest = linked.groupBy("root").agg(F.min("first_id").alias("lowest"))
    named = classes.join(linked.join(lowest, "root").select("node", "lowest"), "node", "left")
    named = checkpoint(named.select("fingerprint", F.coalesce("lowest", "first_id").alias("class_id"), "n"))
    return join_by_key(prints, named, "fingerprint").select("doc_id", "fingerprint", "class_id")
