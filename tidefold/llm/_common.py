"""Helpers shared by the training-text operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes of text that a worker handles at once. Spark itself bounds the bytes of an Arrow batch.
PART_ROWS, PART_BYTES = 500, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder; only a local session that names none gets one of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir isn't set: the executors need a folder that all of them see")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidefold-"))
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage into the shared checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``, inside lambdas too."""
    return F.element_at(F.transform(F.array(value), body), 1)


def parts(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of PART_ROWS rows and PART_BYTES bytes of its text column at most, or of one row."""
    sizes = np.nan_to_num(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(float))
    ends = np.concatenate([[0.0], np.cumsum(sizes)])
    at = 0
    while at < batch.num_rows:
        full = int(np.searchsorted(ends, ends[at] + PART_BYTES, "right")) - 1
        end = min(max(full, at + 1), at + PART_ROWS, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def map_text(
    df: DataFrame,
    text_col: str,
    fields: str,
    make: Callable[[], Callable[[list], Iterable]],
    keep: list[str],
) -> DataFrame:
    """Append columns computed from whole texts in Arrow batches, without a shuffle.

    ``make()`` runs once in each Python task and returns a function from a list of texts
    (None for null) to one list for each field of ``fields``. ``keep`` names the input columns
    that are passed on; one that clashes with a new field is replaced by it.
    """
    new = StructType.fromDDL(fields)
    keep = [c for c in dict.fromkeys(keep) if c not in new.names]
    text_name = "text__"
    while text_name in keep:
        text_name += "_"
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(text_name))
    schema = StructType([source.schema[c] for c in keep] + new.fields)
    arrow_types = [_arrow(f.dataType.simpleString()) for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in (p for b in batches for p in parts(b, len(keep))):
            values = work(batch.column(len(keep)).to_pylist())
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(v, type=t) for v, t in zip(values, arrow_types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


def _arrow(name: str) -> pa.DataType:
    simple = {
        "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
        "boolean": pa.bool_(), "binary": pa.binary(), "float": pa.float32(),
    }
    if name.startswith("array<"):
        inner = name[6:-1]
        if inner.startswith("struct<"):
            return pa.list_(pa.struct([(k, simple[v]) for k, v in (x.split(":") for x in inner[7:-1].split(","))]))
        return pa.list_(_arrow(inner))
    return simple[name]


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in a fold; a null id falls in none."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds == fold, F.lit(False))
