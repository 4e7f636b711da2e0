"""The stages on small odd documents."""

import json
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from arealis.llm.toxicity import toxicity_scores
from tests.llm.helpers import frame, odd_documents, similar_groups


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows = odd_documents()
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    marks = [(i, 1, int(i % 4 == 0)) for i, _, _ in rows if i is not None]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    return path


def plain(df):
    return Counter(json.dumps(list(r), default=str) for r in df.collect())


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    functions = dict(corpus_pipeline.STAGES)
    assert list(functions) == ["toxicity", "exact_dedup", "minhash_near_dedup", "mixing", "packing"]

    clean = functions["toxicity"](spark, docs, folder)
    assert clean.columns == columns
    scores = toxicity_scores(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    toxic = {r.doc_id for r in scores.where("predicted = 1").collect()}
    assert plain(clean) == Counter(
        {k: n for k, n in plain(docs).items() if json.loads(k)[0] not in toxic}
    )

    single = functions["exact_dedup"](spark, docs, folder)
    assert single.columns == columns
    texts = {}
    for r in docs.collect():
        best = texts.get(r.text or "", -1)
        texts[r.text or ""] = max(best, -1 if r.doc_id is None else r.doc_id)
    got = [(r.text or "", -1 if r.doc_id is None else r.doc_id) for r in single.collect()]
    assert sorted(got) == sorted(texts.items())

    apart = functions["minhash_near_dedup"](spark, single, folder)
    assert apart.columns == columns
    rows = [(r.doc_id, r.text, None) for r in single.collect()]
    named = [r[0] for r in rows]
    groups = similar_groups(rows)
    kept = {r.doc_id for r in apart.collect()} - {None}
    assert kept == set(groups.values()) and len(named) > len(kept)

    mix = functions["mixing"](spark, apart, folder)
    assert mix.columns == columns
    assert set(Counter((r.doc_id, r.text) for r in mix.collect()).values()) <= {1, 2}

    pieces = functions["packing"](spark, mix, folder).collect()
    room = Counter()
    for p in pieces:
        room[p.sequence_id] += p.length
    assert max(room.values()) <= 1024


def test_run_applies_all_stages(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(found.columns)
    assert found.count() > 0


def test_empty_documents(spark, folder, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_fold_is_crc32_of_the_id_as_text(spark):
    from pyspark.sql import functions as F

    from arealis.llm.common import fold

    found = spark.range(200).select("id", fold(F.col("id")).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 4 for r in found)
