import corpus_pipeline
from tarn.llm import decontaminate, language, packing, suffix_dedup

from test_similar import brute_kept


def test_stages_one_after_another(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination", "best-fit packing"]
    stage = dict(corpus_pipeline.STAGES)

    known = stage["language ID"](spark, docs, sf_dir)
    assert known.columns == columns
    model = language.train(docs)
    want = {r.doc_id for r in language.identify(docs, model).collect() if not r.rejected}
    assert {r.doc_id for r in known.collect()} == want and len(want) > 0.99 * len(rows)

    one = stage["SimHash near-dedup"](spark, known, sf_dir)
    assert one.columns == columns
    assert {r.doc_id for r in one.collect()} == brute_kept([(r.doc_id, r.text) for r in known.collect()])

    cut = stage["suffix-array dedup"](spark, one, sf_dir)
    assert cut.columns == columns
    sizes = {r.doc_id: r.n_bytes - r.n_removed for r in suffix_dedup.dedup(one, corpus_pipeline.REPEATED, short=None).collect()}
    left = {r.doc_id: len(r.text.encode()) for r in cut.collect()}
    assert left.keys() == sizes.keys()
    # characters that a cut would split stay whole
    assert all(sizes[i] <= n <= sizes[i] + 6 * 20 for i, n in left.items()) and sum(left.values()) < sum(sizes.values()) + 100
    # no run of over 50 words is left in two documents
    runs = {}
    for r in cut.collect():
        w = r.text.split()
        for i in range(len(w) - 50):
            runs.setdefault(" ".join(w[i : i + 51]), set()).add(r.doc_id)
    assert all(len(x) == 1 or len(t.encode()) < corpus_pipeline.REPEATED for t, x in runs.items())

    clean = stage["benchmark decontamination"](spark, cut, sf_dir)
    assert clean.columns == columns
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert {r.doc_id for r in clean.collect()} == set(sizes) - {r.doc_id for r in decontaminate.matches(cut, benchmark).collect()}

    packed = stage["best-fit packing"](spark, clean, sf_dir).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean.collect()}
    last = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in last) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed)
    assert max(sum(r.length for r in packed if r.sequence_id == s) for s in {r.sequence_id for r in packed}) <= packing.CAPACITY


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, sf_dir)
    assert docs.collect() == []
