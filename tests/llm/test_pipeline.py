"""The pipeline against its parts done plainly on a small corpus."""

import hashlib

import corpus_pipeline
from tramline.llm import decontaminate, queries, signatures, suffixes


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_odd_tables_run_through_all_stages(spark, documents, prose, tmp_path):
    """Null and repeated keys, columns with an operator's own names, and no documents at all."""
    folder = str(tmp_path)
    spark.createDataFrame([(None, prose(5, 20))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    # key 1 has two texts, of which one stands three times; a null key's text is like no other
    pairs = [(1, prose(1)), (1, prose(1)), (1, prose(2)), (3, prose(1)), (None, prose(3)), (4, None), (4, None), (None, "")]
    for name, docs in (("some", documents(pairs, extra=True)), ("none", documents([], extra=True))):
        sub = f"{folder}/{name}"
        for table in ("benchmark", "labels"):
            spark.read.parquet(f"{folder}/{table}.parquet").write.parquet(f"{sub}/{table}.parquet")
        docs.write.parquet(f"{sub}/documents.parquet")
        own = spark.read.parquet(f"{sub}/documents.parquet")
        for step, (_, run) in enumerate(corpus_pipeline.STAGES):
            columns, own = own.columns, corpus_pipeline.stage(run(spark, own, sub), "test")
            assert step == len(corpus_pipeline.STAGES) - 1 or own.columns == columns
        texts = sorted((r.doc_id is None, r.doc_id or 0, r.decoded_sha256) for r in own.collect())
        # one of each text with words; texts without any link with nothing and all stay
        expected = [(1, prose(1)), (1, prose(2)), (None, prose(3)), (4, ""), (4, ""), (None, "")] if name == "some" else []
        assert texts == sorted((i is None, i or 0, hashlib.sha256(t.encode()).hexdigest()) for i, t in expected)


def test_stages_equal_their_brute_force(spark, documents, corpus, prose, tmp_path):
    item = prose(777, 20)
    pairs = [(i, t) for i, t in corpus if i is not None and i != 21] + [(70, prose(70, 30) + " " + item)]
    folder = str(tmp_path)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    documents(pairs).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    # nothing is known of quality: no document is rejected
    docs = steps["quality classifier"](spark, docs, folder)
    assert docs.count() == len(pairs)
    docs = steps["n-gram jaccard join"](spark, docs, folder)
    left = [(i, t) for (i, t), (_, n, c) in zip(pairs, signatures.brute_force(pairs), strict=True) if n == 0 or c == i]
    assert sorted(r.doc_id for r in docs.collect()) == sorted(i for i, _ in left)
    docs = steps["suffix-array dedup"](spark, docs, folder)
    kept = {r.doc_id: r.text for r in docs.collect()}
    for name, *_, digest in suffixes.brute_force(left):
        own = kept[name].encode()
        whole = hashlib.sha256(own).hexdigest() == digest
        assert whole or len(own) < len(dict(left)[name].encode())
    texts = sorted(kept.items())
    docs = steps["benchmark decontamination"](spark, docs, folder)
    clean = {r[0] for r in decontaminate.brute_force(texts, [(1, item)]) if not r[5]}
    assert {r.doc_id for r in docs.collect()} == clean and 70 not in clean
    assert docs.columns == columns
    last = steps["byte-level bpe"](spark, docs, folder)
    assert {r.doc_id: r.decoded_sha256 for r in last.collect()} == {
        i: hashlib.sha256(kept[i].encode()).hexdigest() for i in clean
    }
