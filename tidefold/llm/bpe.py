"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterable
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_text

#: Entries of each of the two generations of a worker's cache of stretches between spaces, and characters of one that is kept.
CACHE, LONGEST = 400_000, 64
#: Pre-tokens that are kept with their ids.
PIECES = 800_000
#: Texts on which cutting before single spaces must not change the pre-tokens.
_CUTS = ("a b", "a  b", "1 2", ". .", "a. b", "a\n b", "\u00e9 \u00fc", "it's 's", "a -b", "x 's't", "$ 5", "\u4e2d \u6587", "A b C", "a 12345 b", "! ? b")
_BIT = [1 << i for i in range(256)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the lowest-ranked adjacent pair merges first, the leftmost of equals.

    Pairs wait in a rank queue. A bucket for each merge rank holds the list positions of its pairs,
    as a heap, so that equal ranks come leftmost first. Which buckets have entries is kept in a
    bitmap of two levels, a summary word over leaf words of 256 ranks: find-first-set on the summary,
    then on a leaf, gives the lowest rank. An entry isn't taken out when its pair goes; it is stale
    then, and skipped when its turn comes.
    """
    get = ranks.get
    whole = get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that starts at i
    before = list(range(-1, n - 1))  # start of the part before the part at i
    pair = [get(piece[i : i + 2]) for i in range(n - 1)]  # rank of the part at i with its right neighbour
    pair.append(None)
    summary, leaves, buckets = 0, {}, {}
    for i, rank in enumerate(pair):
        if rank is None:
            continue
        if rank in buckets:
            buckets[rank].append(i)  # ascending positions are a heap already
        else:
            buckets[rank] = [i]
            word = rank >> 8
            leaves[word] = leaves.get(word, 0) | _BIT[rank & 255]
            summary |= 1 << word
    while summary:
        word = (summary & -summary).bit_length() - 1
        leaf = leaves[word]
        rank = (word << 8) + (leaf & -leaf).bit_length() - 1
        bucket = buckets[rank]
        if len(bucket) > 1:
            i = heappop(bucket)
        else:
            i = bucket[0]
            del buckets[rank]
            leaf &= leaf - 1
            leaves[word] = leaf
            if not leaf:
                summary &= summary - 1
        if pair[i] != rank:
            continue
        gone = end[i]
        stop = end[i] = end[gone]
        pair[gone] = None
        if stop < n:
            before[stop] = i
            new = pair[i] = get(piece[i : end[stop]])
        else:
            new = pair[i] = None
        at, left = i, before[i]
        while True:  # first the pair of the new part with its right neighbour, then with its left one
            if new is not None:
                if new in buckets:
                    heappush(buckets[new], at)
                else:
                    buckets[new] = [at]
                    word = new >> 8
                    leaves[word] = leaves.get(word, 0) | _BIT[new & 255]
                    summary |= 1 << word
            if left < 0:
                break
            new = get(piece[left:stop])
            if pair[left] == new:
                break
            pair[left] = new
            at, left = left, -1
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class ChunkCache:
    """Encodes texts by the stretches between single spaces, whose ids don't depend on their context.

    A space before a character that isn't white space always starts a pre-token, so a text may be
    cut there if no space stands before other white space. Texts with such a space (doubled, before
    a line end, or last) are encoded whole. ``encode`` maps strings to packed little-endian ids.
    The cache has two generations of bounded size, of stretches of bounded length.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = CACHE) -> None:
        self.encode, self.limit = encode, limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def packed(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        found = list(map(self.young.get, rest))
        if None in found:
            got: dict[str, bytes] = {}
            new = []
            for w in {w for w, x in zip(rest, found, strict=True) if x is None}:
                if not w or w[0].isspace():
                    return self.encode([text])[0]
                x = self.old.get(w)
                if x is None:
                    new.append(w)
                else:
                    got[w] = x
            got.update(zip(new, self.encode([" " + w for w in new]), strict=True))
            found = [got[w] if x is None else x for w, x in zip(rest, found, strict=True)]
            for w in [w for w in new if len(w) > LONGEST]:
                del got[w]
            if len(self.young) + len(got) > self.limit:
                self.old, self.young = self.young, got
            else:
                self.young.update(got)
        return b"".join([*self.encode([first]), *found])


class Encoder:
    """Encodes and decodes by a rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.cache = ChunkCache(self._encode)
        self.cuts = all(self.split(t) == [w for k, x in enumerate(t.split(" ")) for w in self.split(" " * (k > 0) + x)] for t in _CUTS if "  " not in t)

    def _piece(self, piece: str) -> bytes:
        packed = self.pieces.get(piece)
        if packed is None:
            ids = merge(piece.encode(), self.ranks)
            packed = struct.pack(f"<{len(ids)}I", *ids)
            if len(piece) <= LONGEST:
                if len(self.pieces) >= PIECES:
                    self.pieces.clear()
                self.pieces[piece] = packed
        return packed

    def _encode(self, texts: list[str]) -> list[bytes]:
        split, piece = self.split, self._piece
        return [b"".join(map(piece, split(t))) for t in texts]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.cache.packed(text) if self.cuts else self._encode([text])[0], "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=1)
def encoder_of(path: str, pattern: str) -> Encoder:
    """A worker process keeps the encoder, with its caches, from task to task."""
    return Encoder(load_ranks(path), pattern)


def encode_texts(df: DataFrame, path: str, pattern: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """Append the array of ids of each whole text; a null text counts as empty. Other columns pass through.

    ``pattern`` splits a text into pre-tokens; texts may be cut before a space only if it is one that
    always starts a pre-token there, as that of the public tokenizers does, so other patterns are
    told apart by a check and encode each text in one go.
    """

    def make():
        encoder = encoder_of(path, pattern)
        return lambda texts: [[encoder.encode(t or "") for t in texts]]

    return map_text(df, text_col, f"`{out_col}` array<int>", make, df.columns)


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Append the bytes that each array of ids stands for; a null array gives empty bytes, an unknown id raises."""
    import pyarrow as pa
    from pyspark.sql.types import BinaryType, StructField, StructType

    schema = StructType([f for f in df.schema.fields if f.name != out_col] + [StructField(out_col, BinaryType())])

    def run(batches):
        encoder = encoder_of(path, r"\S+|\s+")
        for batch in batches:
            decoded = pa.array([encoder.decode(ids or ()) for ids in batch.column(ids_col).to_pylist()], type=pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in schema.names[:-1]] + [decoded], names=schema.names)

    return df.mapInArrow(run, schema)


def bpe_digest(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count of ids, digest of the ids and digest of the bytes they decode to, for each row.

    A null text counts as empty. Ids may be null or repeated; each row gives one row.
    """

    def make():
        encoder = encoder_of(path, pattern)
        shown = [str(i) for i in range(len(encoder.tokens))]

        def work(texts):
            counts, digests, decoded = [], [], []
            for t in texts:
                ids = encoder.encode(t or "")
                counts.append(len(ids))
                digests.append(hashlib.sha256(",".join(map(shown.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            return counts, digests, decoded

        return work

    source = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_text(source, "text", "n_tokens long, ids_sha256 string, decoded_sha256 string", make, ["doc_id"])
