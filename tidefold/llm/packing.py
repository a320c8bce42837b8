"""Best-fit packing with a Martello-Toth dominance reduction, on the histogram of piece lengths.

A plan needs only how many pieces of each length there are, at most one count for each length up
to the capacity. The plan is made on the driver from that histogram; pieces find their places by
their rank among pieces of their length.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._common import checkpoint, map_text

CAPACITY = 2048
#: Pieces of a length are ranked within shares, so that a common length isn't one task's work. There are
#: about SHARES in all, of pieces between these bounds each.
SHARES, SHARE_PIECES = 4096, (256, 65536)
_PIECE = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"


def reduce_by_dominance(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Take fixed bins out of ``counts``: (lengths, how many such bins).

    For the longest piece left, a bin is fixed when no other bin that holds it can do better: alone
    if nothing fits beside it; with the longest that fits if it fills the bin, or if no two pieces
    fit beside the longest piece together. A length for which none holds is left, and the next one tried.
    """
    fixed = []
    sizes = sorted((s for s, n in counts.items() if n > 0), reverse=True)
    present = np.zeros(capacity + 1, bool)
    present[sizes] = True
    below = np.zeros(capacity + 1, np.int64)

    def refresh() -> None:
        known = np.where(present, np.arange(capacity + 1), 0)
        below[:] = np.maximum.accumulate(known)

    refresh()
    smallest = sizes[::-1]
    low = 0
    for s in sizes:
        while counts.get(s, 0) > 0:
            room = capacity - s
            best = int(below[room])
            if best == 0 or (best == s and counts[s] == 1):
                if best == s:
                    below_s = int(below[s - 1]) if s > 0 else 0
                    best = min(below_s, room)
                    best = int(below[best])
                if best == 0:
                    fixed.append(((s,), counts[s]))
                    counts[s] = 0
                    present[s] = False
                    refresh()
                    continue
            while low < len(smallest) and counts.get(smallest[low], 0) == 0:
                low += 1
            least = smallest[low]
            second = least if counts[least] > 1 else next((x for x in smallest[low + 1 :] if counts.get(x, 0) > 0), capacity)
            if best != room and least + second <= room:
                break
            n = counts[s] // 2 if best == s else min(counts[s], counts[best])
            fixed.append(((s, best), n))
            for x in (s, best):
                counts[x] -= n
                if counts[x] == 0:
                    present[x] = False
            refresh()
    return fixed


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over whole groups of equal bins: (lengths, how many such bins)."""
    open_bins: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for s in sorted((s for s, n in counts.items() if n > 0), reverse=True):
        left = counts[s]
        while left:
            room = next((r for r in range(s, capacity) if open_bins.get(r)), capacity)
            each = room // s
            if room == capacity:
                lengths, bins = (), max(1, left // each)
            else:
                lengths, bins = next(iter(open_bins[room].items()))
            take = min(each, left)
            used = max(1, min(bins, left // take))
            if room < capacity:
                if used == bins:
                    del open_bins[room][lengths]
                else:
                    open_bins[room][lengths] = bins - used
            new = lengths + (s,) * take
            group = open_bins[room - s * take]
            group[new] = group.get(new, 0) + used
            left -= used * take
    return [(lengths, n) for group in open_bins.values() for lengths, n in group.items()]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, how many, first sequence, offset) of each run of pieces."""
    counts = dict(counts)
    bins = reduce_by_dominance(counts, capacity)
    bins += best_fit(counts, capacity)
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for lengths, n in bins:
        offset = 0
        for s in lengths:
            rows.append((s, used[s], n, sequence, offset))
            used[s] += n
            offset += s
        sequence += n
    return rows


def cut(packed: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's packed ids; of a longer one, only the first is short."""
    n = len(packed) // 4
    first = n % capacity or capacity
    bounds = [0, *range(first, n, capacity), n] if n > capacity else [0, n]
    return [(k, a, b - a, zlib.crc32(packed[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]


#: Fixed value: how the byte-level pre-tokenizer of the tokenizers library splits a text.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: its own if it is visible in Latin-1, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(visible))
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def ranks_of(path: str) -> dict[bytes, int] | None:
    """Ranks equivalent to a tokenizer file, or None if it has no such form.

    It has if it splits texts as BYTE_LEVEL does and nothing more, and if its merges are in the order
    of the ids that they make, so that the earliest merge and the lowest id are the same choice.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, split = file["model"], file.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(
        model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    if not plain or file.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return None
    if any(not t["special"] for t in file.get("added_tokens") or []):
        return None  # such a token is found in texts before they are split
    vocab, as_byte = model["vocab"], byte_characters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab.get("".join(m), -1) for m in pairs]
    singles = [vocab.get(c, -1) for c in as_byte]
    if min(singles) < 0 or any(x >= y for x, y in zip([max(singles), *made], made, strict=False)):
        return None
    special = {t["content"] for t in file.get("added_tokens") or []}
    tokens = {t: i for t, i in vocab.items() if t not in special}
    if len(tokens) != len(singles) + len(made) or any(c not in as_byte for t in tokens for c in t):
        return None
    return {bytes(as_byte[c] for c in t): i for t, i in tokens.items()}


@lru_cache(maxsize=1)
def encoder(path: str) -> Callable[[str | None], bytes]:
    """Packed little-endian ids of a text by a tokenizer file, special strings being ordinary text.

    A file that has equivalent ranks is encoded from those by tiktoken, which gives the ids of the
    tokenizers library in a third of its time; any other file by that library, and so is a text that
    tiktoken's pattern engine gives up on (a run of millions of white space). A worker process keeps
    the encoder from task to task.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True

    def by_tokenizers(text: str | None) -> bytes:
        return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()

    ranks = ranks_of(path)
    if ranks is None:
        return by_tokenizers
    import tiktoken

    numbers = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    def by_ranks(text: str | None) -> bytes:
        try:
            return numbers(text or "", disallowed_special=()).astype("<u4", copy=False).tobytes()
        except ValueError:
            return by_tokenizers(text)

    return by_ranks


def pieces(df: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece; a null text is one end id."""

    def make():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
        names = ("piece", "start", "length", "ids_crc32")
        return lambda texts: [[[dict(zip(names, p, strict=True)) for p in cut(encode(t) + end, capacity)] for t in texts]]

    source = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_text(source, "text", f"p {_PIECE}", make, ["doc_id"]).select("doc_id", F.inline("p"))


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Append sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32).

    All pieces are placed, repeated rows too; an empty input gives no rows. A piece's rank is its
    place in a share of its length, after all earlier shares; a length has as many shares as its pieces
    ask for. The driver sees one count for each length.
    """
    spark: SparkSession = found.sparkSession
    found = checkpoint(found)
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    each = min(max(sum(counts.values()) // SHARES, SHARE_PIECES[0]), SHARE_PIECES[1])
    shares = F.array(*[F.lit(max(1, -(-counts.get(s, 0) // each))) for s in range(capacity + 1)])
    share = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.get(shares, F.col("length").cast("int"))).cast("int")
    found = found.withColumn("share", share)
    sizes = checkpoint(found.groupBy("length", "share").agg(F.count(F.lit(1)).alias("n")))
    earlier = W.partitionBy("length").orderBy("share").rowsBetween(W.unboundedPreceding, -1)
    first = sizes.select("length", "share", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    runs = spark.createDataFrame(plan(counts, capacity), "length long, rank long, n long, sequence long, offset long")
    order = W.partitionBy("length", "share").orderBy("doc_id", "piece", "start", "ids_crc32")
    # the pieces are already dealt by length and share, so joining the shares' starts moves only those
    ranked = found.withColumn("k", F.row_number().over(order) - 1).join(first, ["length", "share"])
    ranked = ranked.withColumn("rank", F.col("first") + F.col("k")).drop("share", "first", "k")
    # a few runs for each length: a bound that doesn't depend on the input, so they are broadcast
    table = runs.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("rank", "n", "sequence", "offset"))).alias("runs")
    )
    placed = ranked.join(F.broadcast(table), "length")
    # the run that holds a rank: the runs of a length are sorted by first rank and leave no gaps
    run = F.element_at(F.filter("runs", lambda x: (x["rank"] <= F.col("rank")) & (F.col("rank") < x["rank"] + x["n"])), 1)
    placed = placed.withColumn("run", run)
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("run.sequence") + F.col("rank") - F.col("run.rank")).alias("sequence_id"),
        F.col("run.offset").alias("offset"),
    )


def pack_documents(df: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize, cut and pack whole texts; other columns are ignored."""
    return pack(pieces(df, path, end_id, capacity, id_col, text_col), capacity)
