"""The corpus pipeline against plain versions of its stages."""

import collections
import re

import corpus_pipeline
import pytest
from public_tokenizers import path
from test_operators import AWKWARD, brute_components, brute_fingerprint, linked_spans
from tidefold.llm import packing, quality, toxicity

SMALL = "/root/testdata/sf0.001"


def folder_of(spark, tmp_path, docs):
    """A folder with the given documents and the small tables' labels."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def redacted(text):
    out, at = "", 0
    for s, _, e in linked_spans(text):
        if s >= at:
            out += text[at:s] + "[secret]"
        at = max(at, e)
    return out + text[at:]


def plain_run(spark, sf_dir):
    """Pieces (doc_id, piece, start, length, ids_crc32) by stages written row by row; the two models are the pipeline's own."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    good, features = quality.fit_quality(docs, labels), quality.Features()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if good.score(features, t) >= 0.5]
    kept = spark.createDataFrame(rows, "doc_id long, text string")
    toxic = toxicity.fit_toxicity(kept, labels)
    rows = [(i, t) for i, t in rows if toxic.score(t) < 0.5]
    roots = brute_components([brute_fingerprint(t) for _, t in rows], lambda a, b: (a ^ b).bit_count() <= 3)
    low = {}
    for (i, _), r in zip(rows, roots, strict=True):
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    survivors = {i for (i, _), r in zip(rows, roots, strict=True) if i == low[r]}
    gone = {i for (i, _), r in zip(rows, roots, strict=True) if i is not None and i != low[r]}
    rows = [(i, t) for i, t in rows if i is None or i in survivors and i not in gone]
    encode = packing.encoder(path("byte_bpe_50k.json"))
    return collections.Counter((i, *p) for i, t in rows for p in packing.cut(encode(redacted(t or "")) + (0).to_bytes(4, "little")))


def checked(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    assert collections.Counter(tuple(r)[:5] for r in rows) == plain_run(spark, sf_dir)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        ends = [0]
        for offset, length in sorted(places):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
    return rows


def test_pipeline_against_plain_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame(
        [(9_000_001, docs.first()["text"]), (9_000_002, "user: alice\nkey = Zm9vYmFyYmF6 and some more words of an ordinary text that goes on")], "doc_id long, text string"
    )
    assert len(checked(spark, folder_of(spark, tmp_path, docs.unionByName(extra, allowMissingColumns=True)))) > 100


def test_pipeline_on_awkward_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(i, t, "x") for i, t in AWKWARD], "doc_id long, text string, lang string")
    checked(spark, folder_of(spark, tmp_path, docs.limit(40).unionByName(odd, allowMissingColumns=True)))


def test_pipeline_on_nothing(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder_of(spark, tmp_path, spark.read.parquet(f"{SMALL}/documents.parquet").limit(0))).count() == 0


def test_pipeline_stages_keep_columns_and_leave_one_folder(spark, tmp_path):
    import os

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
    out = corpus_pipeline.run(spark, SMALL)
    folder = re.sub(r"^file:/*", "/", os.path.dirname(out.inputFiles()[0]))
    assert os.listdir(os.path.dirname(folder)) == ["best_fit_packing"]


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    from tidefold.llm import _common

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        _common.checkpoint_folder(Session())
    assert _common.checkpoint_folder(spark)
