"""URL filters: longest host and path rule first, then a Bloom filter cascade over listed hosts.

The cascade's filters are broadcast, up to a bound of bytes. A list that needs more is dealt in shards
by the hash of its keys, each with a cascade within the bound, and the distinct hosts pass them in turn.
"""

from __future__ import annotations

import string
import struct
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import checkpoint

#: The contract's rules.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Listed host names. A listed name covers its subdomains.
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_ENDS = ("example.com", "example.net", "example.org")
LISTED = tuple(f"{a}.{b}" for a in LISTED_NAMES for b in LISTED_ENDS)

#: Bits per key and hashes of each level.
BITS_PER_KEY, HASHES = 10, 5
#: Bytes of filters that are broadcast at once, at most.
MAX_BYTES = 32 << 20
#: Salts that a host's rows are dealt by when verdicts come by join, so that a hot host is no task's work.
SALTS = 32
#: Bits of the bitmaps that Spark's bitmap functions make.
_BITMAP = 32768


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict, or null."""
    fitting = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        answer = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, answer) if fitting is None else fitting.when(fits, answer)
    return fitting


def host_keys(host: Column) -> Column:
    """A host and its parent domains of two labels and more: the keys that may be listed."""
    labels = F.split(host, r"\.", -1)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        )
    )


def _hash(key: Column, level: int) -> Column:
    return F.xxhash64(key, F.lit(level))


def _places(key: Column, level: int, bits: int) -> list[Column]:
    """Bit numbers of a key by double hashing."""
    a = _hash(key, level).bitwiseAND(F.lit(0xFFFFFFFF))
    b = F.shiftrightunsigned(_hash(key, level), 32).bitwiseOR(F.lit(1).cast("long"))
    return [F.pmod(a + b * F.lit(i), F.lit(bits)) for i in range(HASHES)]


class Cascade:
    """Bloom filters by level, each a byte array; ``lists`` is exact on the universe it was built for.

    It takes the keys whose shard number, by ``modulus``, is ``residue``; no other key is listed by it.
    """

    def __init__(self, modulus: int = 1, residue: int = 0) -> None:
        self.modulus, self.residue, self.hashes = modulus, residue, HASHES
        self.levels: list[tuple[int, np.ndarray]] = []

    @property
    def n_bytes(self) -> int:
        return sum(len(b) for _, b in self.levels)

    def passes(self, key: bytes, level: int) -> bool:
        bits, data = self.levels[level]
        h = xxhash.xxh64_intdigest(struct.pack("<i", level), xxhash.xxh64_intdigest(key, 42))
        a, b = h & 0xFFFFFFFF, h >> 32 | 1
        return all(data[(p := (a + b * i) % bits) >> 3] >> (p & 7) & 1 for i in range(self.hashes))

    def lists(self, key: str) -> bool:
        """A key that first fails at an even level isn't listed; at an odd level, it is."""
        raw = key.encode()
        if self.modulus > 1 and _shard_of(raw) % self.modulus != self.residue:
            return False
        for level in range(len(self.levels)):
            if not self.passes(raw, level):
                return level % 2 == 1
        return len(self.levels) % 2 == 1


def _shard(key: Column) -> Column:
    return F.shiftrightunsigned(_hash(key, -1), 1)


def _shard_of(key: bytes) -> int:
    return xxhash.xxh64_intdigest(struct.pack("<i", -1), xxhash.xxh64_intdigest(key, 42)) >> 1


def _tested(spark: SparkSession, value: object, test: Callable[[object, str], bool]) -> Callable[[Column], Column]:
    """A function of a text column: ``test`` with a broadcast value, once for each distinct text of a batch."""
    shipped = spark.sparkContext.broadcast(value)

    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        held = shipped.value
        return texts.map({t: test(held, t) for t in texts.unique()})

    return run


def _level(keys: DataFrame, level: int, n: int) -> tuple[int, np.ndarray]:
    """One filter: bitmaps of its bits, OR-ed together before and after the shuffle; some kilobytes reach the driver at once."""
    bits = max(64, -(-n * BITS_PER_KEY // 64) * 64)
    data = np.zeros(-(-bits // _BITMAP) * _BITMAP // 8, np.uint8)
    place = keys.select(F.explode(F.array(*_places(F.col("key"), level, bits))).alias("p"))
    maps = place.groupBy(F.floor(F.col("p") / _BITMAP).cast("int").alias("at")).agg(F.bitmap_construct_agg(F.col("p") % _BITMAP).alias("bits"))
    for at, found in maps.toLocalIterator():
        data[at * _BITMAP // 8 : (at + 1) * _BITMAP // 8] = np.frombuffer(found, np.uint8)
    return bits, data[: bits // 8].copy()


def _build(keys: DataFrame, cascade: Cascade, max_bytes: int) -> Cascade | None:
    """Alternate levels hold the listed keys and what the level before lets through wrongly; None if that needs too many bytes.

    Ends when a level has no false positive left in the whole universe.
    """
    spark = keys.sparkSession
    if cascade.modulus > 1:
        keys = keys.where(F.pmod(_shard(F.col("key")), F.lit(cascade.modulus)) == cascade.residue)
    inside, outside = keys.where("listed").select("key"), keys.where("not listed").select("key")
    while n := inside.count():
        level = len(cascade.levels)
        if cascade.n_bytes + n * BITS_PER_KEY // 8 > max_bytes and n > 1:
            return None
        cascade.levels.append(_level(inside, level, n))
        passing = _tested(spark, (cascade, level), lambda held, key: held[0].passes(key.encode(), held[1]))
        inside, outside = outside.where(passing(F.col("key"))), inside
    return cascade


def build_cascades(universe: DataFrame, listed: DataFrame, max_bytes: int | None = None) -> Iterator[Cascade]:
    """Cascades whose shards together cover the universe, each of ``max_bytes`` (MAX_BYTES) at most; a single one if that suffices.

    ``universe`` has the corpus's distinct keys and ``listed`` the distinct listed ones, both as ``key``.
    Listed keys that the corpus lacks play no part. A shard that needs too much is halved.
    """
    max_bytes = MAX_BYTES if max_bytes is None else max_bytes
    keys = universe.join(listed.withColumn("listed", F.lit(True)), "key", "left")
    keys = checkpoint(keys.select("key", F.coalesce("listed", F.lit(False)).alias("listed")))
    todo = [(1, 0)]
    while todo:
        modulus, residue = todo.pop()
        cascade = _build(keys, Cascade(modulus, residue), max_bytes)
        if cascade is None:
            todo += [(2 * modulus, residue + modulus), (2 * modulus, residue)]
        else:
            yield cascade


def banned_by(spark: SparkSession, cascade: Cascade) -> Callable[[Column], Column]:
    """Whether a host or a parent domain of it is listed, of a host column."""
    return _tested(spark, cascade, lambda held, host: any(map(held.lists, keys_of(host))))


def keys_of(host: str) -> list[str]:
    """As host_keys, of one host."""
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(max(len(labels) - 1, 1))] if host else []


def filter_urls(
    df: DataFrame,
    url_col: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    listed: Sequence[str] | DataFrame = LISTED,
) -> DataFrame:
    """Append host, path, rule and verdict to each row.

    The longest fitting rule decides; other urls are blocked if their host or a parent domain is
    listed, by the cascade. A null url, or one without ``://``, has an empty host and path, no rule,
    and is allowed. Columns of the four names are replaced; rows are neither dropped nor merged, and an
    empty table gives no rows.
    """
    spark = df.sparkSession
    host, path = F.col("host"), F.col("path")
    out = df.withColumn("host", host_of(F.col(f"`{url_col}`"))).withColumn("path", path_of(F.col(f"`{url_col}`")))
    ruled = out.withColumn("rule__", rule_of(host, path, rules) if rules else F.lit(None).cast("struct<rule:string,verdict:string>"))
    names = _listed_frame(spark, listed)
    hosts = ruled.where("rule__ is null").select(host).distinct()
    universe = hosts.select(F.explode(host_keys(host)).alias("key")).distinct()
    cascades = build_cascades(universe, names)
    first = next(cascades)
    if first.modulus == 1:
        judged = ruled.withColumn("banned__", banned_by(spark, first)(host))
    else:
        judged = _banned_by_rounds(ruled, hosts, first, cascades)
    return (
        judged.withColumn("rule", F.col("rule__.rule"))
        .withColumn("verdict", F.coalesce(F.col("rule__.verdict"), F.when(F.col("banned__"), "block").otherwise("allow")))
        .drop("rule__", "banned__")
    )


def _banned_by_rounds(rows: DataFrame, hosts: DataFrame, first: Cascade, more: Iterator[Cascade]) -> DataFrame:
    """Append banned__: the distinct hosts pass one shard's cascade after another, each broadcast alone; rows get the verdicts by join."""
    spark = rows.sparkSession
    hosts = checkpoint(hosts.where("host <> ''"))
    found = None
    for cascade in chain([first], more):
        some = checkpoint(hosts.where(banned_by(spark, cascade)(F.col("host"))))
        found = some if found is None else found.unionByName(some)
    salted = found.distinct().select("host", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt__"), F.lit(True).alias("banned__"))
    dealt = rows.withColumn("salt__", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if c != "rule__"]), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["host", "salt__"], "left").select(*rows.columns, F.coalesce("banned__", F.lit(False)).alias("banned__"))


def _listed_frame(spark: SparkSession, listed: Sequence[str] | DataFrame) -> DataFrame:
    if isinstance(listed, DataFrame):
        return listed.select(F.col(listed.columns[0]).alias("key")).where("key is not null").distinct()
    return spark.createDataFrame([(k,) for k in sorted(set(listed))], "key string")


def url_verdicts(df: DataFrame) -> DataFrame:
    return filter_urls(df.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


ORACLE = f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url, position('://' IN coalesce(url, '')) AS p FROM pages),
r AS (SELECT page_id, CASE WHEN p = 0 THEN '' ELSE substring(url, p + 3) END AS rest FROM u),
s AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM r),
h AS (SELECT page_id, translate(raw, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
             regexp_extract(substring(rest, length(raw) + 1), '^[^?#]*') AS path FROM s),
v AS (SELECT *, CASE
{chr(10).join(f"  WHEN (host = '{n}' OR host LIKE '%.{n}') AND starts_with(path, '/{p}') THEN '{n}/{p}'" for _, x in sorted(RULES, key=lambda r: (-len(r[1]), r[1])) for n, p in [x.split('/', 1)])}
  END AS rule FROM h)
SELECT page_id, host, path, rule, CASE
{chr(10).join(f"  WHEN rule = '{x}' THEN '{v}'" for v, x in RULES)}
{chr(10).join(f"  WHEN host = '{k}' OR host LIKE '%.{k}' THEN 'block'" for k in LISTED)}
  ELSE 'allow' END AS verdict FROM v
"""
