"""The corpus pipeline, stage by stage, on a small table with edge rows and on empty ones."""

import collections
import tempfile

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tarmac import session
from tarmac.llm import components, langid, near_dup, packing, quality_model
from tarmac.llm.common import read

SF001 = "/root/testdata/sf0.001"
EDGE = [(10_000, None, "en", "src0", 0), (10_001, "", None, None, None), (None, "No id but some words to read here.", "en", None, 5),
        (None, "No id but some words to read here.", "en", None, 5), (10_002, "123 456", "en", "src1", 7), (10_003, "word " * 60_000, "en", "src0", 1)]


@pytest.fixture(scope="module")
def folder(spark):
    path = tempfile.mkdtemp(prefix="tarmac-pipeline-")
    docs = read(spark, SF001, "documents")
    edge = spark.createDataFrame(EDGE, docs.schema)
    copy = docs.limit(1)
    docs.unionByName(edge).unionByName(copy).withColumn("score", F.lit(1)).coalesce(3).write.parquet(f"{path}/documents.parquet")
    read(spark, SF001, "labels").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_in_order(spark, folder):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "language ID", "MinHash near-dedup", "mixing sources to target weights", "packing"]
    docs = read(spark, folder, "documents")
    before, columns = docs.collect(), docs.columns
    kept = collections.Counter(tuple(r) for r in before)
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, folder)
        assert sorted(out.columns) == sorted(columns)
        rows = collections.Counter(tuple(r) for r in out.select(columns).collect())
        assert rows and not rows - kept  # a stage only drops rows
        if name == "quality classifier":
            model = quality_model.train(docs, read(spark, folder, "labels"))
            good = quality_model.predict(docs, model).filter("predicted = 1").groupBy("doc_id").count().collect()
            assert {r.doc_id: r["count"] for r in good} == collections.Counter(r[columns.index("doc_id")] for r in rows.elements())
        elif name == "language ID":
            accepted = langid.predict(docs, langid.train(docs)).filter("accepted").count()
            assert accepted == rows.total() and not any(r[columns.index("text")] in ("", None, "123 456") for r in rows)
        else:
            classes = near_dup.near_duplicates(spark, docs)
            assert rows.total() == classes.select("class_id", F.when(F.col("class_id").isNull(), F.col("digest"))).distinct().count()
            assert max(collections.Counter(r[columns.index("text")] for r in rows.elements()).values()) == 1
        kept, docs = rows, spark.createDataFrame([tuple(r) for r in rows.elements()], docs.select(columns).schema).cache()
    mixed = corpus_pipeline.mix_sources(spark, docs, folder)
    assert sorted(mixed.columns) == sorted(columns)
    again = collections.Counter(r.doc_id for r in mixed.collect())
    assert set(again) <= {r[columns.index("doc_id")] for r in kept} and max(again.values()) <= 2


def test_run_packs_what_the_stages_keep(spark, folder):
    pieces = corpus_pipeline.run(spark, folder).collect()
    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in read(spark, folder, "documents").collect()}
    used = collections.Counter()
    for p in pieces:
        assert p.offset + p.length <= 1024
        used[p.sequence_id] += p.length
        if len(texts[p.doc_id] or "") < 5000:
            assert p.doc_tokens == len(whole.encode(texts[p.doc_id] or "", add_special_tokens=False).ids) + 1
    assert len(pieces) > 50 and sum(n < 1024 for n in used.values()) <= 1


def test_empty_tables_give_no_pieces(spark, folder):
    path = tempfile.mkdtemp(prefix="tarmac-pipeline-empty-")
    for name in ("documents", "labels"):
        read(spark, folder, name).limit(0).write.parquet(f"{path}/{name}.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []


def test_no_stage_broadcasts_a_table_by_its_estimate(spark, folder, monkeypatch):
    """Near-duplicates and packing: every plan starts without a broadcast of a written table, whose rows
    (20 buckets a text exploded, arrays, a piece a document) the planner takes to be far fewer bytes."""
    plans = []

    def planned(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def noted(module):
        write = module.table
        monkeypatch.setattr(module, "table", lambda s, df, name: plans.append(planned(df)) or write(s, df, name))

    for module in (near_dup, components, packing):
        noted(module)
    monkeypatch.setattr(session, "ESTIMATE_BYTES", -1)  # the test's tables are small
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(key, None) for key in keys]
    texts = [" ".join(f"word{(k * 7 + i * i) % 97}" for i in range(40 + k)) for k in range(12)]
    rows = [(i, f"{texts[i % 12]} {'end' * (i // 12)}") for i in range(48)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = corpus_pipeline.near_duplicates(spark, docs, folder)
    packed = corpus_pipeline.pack(spark, docs, folder)
    assert [spark.conf.get(key, None) for key in keys] == before
    assert len(plans) > 8 and sum("Join" in plan for plan in plans) > 4
    # a side is broadcast only by the bytes that its shuffle had, or as the few remainders that are cut
    assert not [plan for plan in [*plans, planned(one)] if "BroadcastHashJoin" in plan and "rank" not in plan]
    assert "SortMergeJoin" in planned(packed) and planned(packed).count("BroadcastHashJoin") <= 1
    monkeypatch.setattr(packing, "CUT_ROWS_SENT", 0)
    shuffled = corpus_pipeline.pack(spark, docs, folder)
    assert "BroadcastHashJoin" not in planned(shuffled)
    pieces = [collections.Counter(map(tuple, df.drop("sequence_id", "offset").collect())) for df in (packed, shuffled)]
    assert pieces[0] == pieces[1] and pieces[0].total() > 48  # some are cut
