import os

import pytest

from tarn.llm import common


def test_scratch_is_shared_and_cleared(spark):
    common.clear(spark)
    df = common.cut(spark.range(3), "x")
    folder = common._written[-1]
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir")) and df.count() == 3
    assert os.path.isdir(folder)
    common.clear(spark)
    assert not os.path.isdir(folder)


def test_a_cluster_must_name_its_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://x"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())


def test_free_name(spark):
    assert common.free_name(spark.range(1).toDF("A"), "a") == "a_"


def test_narrow_ids(spark):
    from pyspark.sql import functions as F

    from tarn.llm import decontaminate, language, licenses, lm, packing, simhash, suffix_dedup, topk

    docs = spark.createDataFrame([(1, "a b c d e f g", "en"), (2, "mit license here", "en")], "doc_id int, text string, lang string")
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id int, text string")
    for found in (packing.pack(docs), suffix_dedup.dedup(docs), lm.score_all(docs), simhash.near_duplicates(docs), language.identify(docs), licenses.scan(docs)):
        assert {r.doc_id for r in found.collect()} == {1, 2}
    assert [r.doc_id for r in decontaminate.matches(docs, items).collect()] == [1]
    assert simhash.keep_one(docs).count() == suffix_dedup.rewritten(docs).count() == 2
    vectors = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id int, embedding array<double>")
    assert topk.top_k(vectors).select(F.col("vec_id")).first().vec_id == 1


def test_slices_are_bounded_by_rows_and_bytes():
    import pyarrow as pa

    texts = ["x" * n for n in (10, 3 << 20, 3 << 20, 9 << 20, 5)] + ["y"] * 2500
    parts = list(common.sliced([pa.RecordBatch.from_pydict({"text": texts}), pa.RecordBatch.from_pydict({"text": pa.array([], pa.string())})]))
    assert [x for p in parts for x in p.column("text").to_pylist()] == texts
    assert all(p.num_rows <= common.BATCH_ROWS and (p.num_rows == 1 or p.nbytes <= common.BATCH_BYTES) for p in parts) and parts[-1].num_rows == 0


def test_settings_stay_and_dropped_tables_go(spark):
    before = {k: spark.conf.get(k) for k in common._WRITING}
    df = common.cut(spark.range(10).repartition(3), "x")
    assert {k: spark.conf.get(k) for k in common._WRITING} == before
    with pytest.raises(ZeroDivisionError), common._set(spark, common._WRITING):
        1 / 0  # noqa: B018
    assert {k: spark.conf.get(k) for k in common._WRITING} == before
    at = df._tarn_path
    assert os.path.isdir(at)
    common.drop(df)
    assert not os.path.isdir(at) and at not in common._written
