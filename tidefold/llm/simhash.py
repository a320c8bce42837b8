"""SimHash near-duplicates: 64-bit fingerprints of word shingles, pigeonhole blocks, Hamming check."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import checkpoint, map_text
from ._links import components, join_by_key, near_links

WORDS, SEED = 3, 42


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Unsigned fingerprint: a bit is set if it is in over half of the shingles' XXH64 values.

    ASCII letters are lower-cased and ASCII white space separates words; a text with fewer words is
    one shingle, and a text without words (null too) has fingerprint zero.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        starts, ends = [0], [len(joined)]
    else:
        bounds = np.cumsum([len(p) + 1 for p in parts])
        ends = (bounds[words - 1 :] - 1).tolist()
        starts = [0, *bounds[: len(ends) - 1].tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)), "<u8", len(ends))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        part = hashes[k : k + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, out_col: str = "fp") -> DataFrame:
    """Append the fingerprint of each whole text as a signed long."""

    def make():
        return lambda texts: [np.array([fingerprint(t) for t in texts], "<u8").view("<i8")]

    return map_text(df, text_col, f"`{out_col}` long", make, df.columns if keep is None else keep)


def link_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed long) and component_id of every row.

    Fingerprints link at three or fewer differing bits; a component's id is the smallest non-null
    id in it (null if it has none). Null and empty texts share fingerprint zero and link like any
    other. Repeated rows and ids each give a row; other columns are ignored. An empty table gives no
    rows. Rows of a hot fingerprint get their component by broadcast, so no task holds all of them.
    """
    source = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    docs = checkpoint(fingerprints(source, "text", ["doc_id"]))
    first = checkpoint(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")))
    roots = components(near_links(first.select("fp")))
    linked = roots.join(first, roots["node"] == first["fp"]).select("fp", "root", "first_id")
    lowest = linked.groupBy("root").agg(F.min("first_id").alias("lowest"))
    linked = linked.join(lowest, "root").select("fp", "lowest")
    component = first.join(linked, "fp", "left").select("fp", F.coalesce("lowest", "first_id").alias("component_id"), "n")
    return join_by_key(docs, checkpoint(component), "fp").select("doc_id", "fp", "component_id")


def simhash_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    linked = link_documents(df, id_col, text_col)
    return linked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id is the smallest of their component; all columns stay.

    Ids are taken as keys: of rows that repeat a surviving id all stay, and rows with a null id stay,
    since nothing tells them apart.
    """
    linked = link_documents(df, id_col, text_col)
    gone = linked.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return df.join(gone, df[id_col] == gone["gone_id"], "left_anti")
