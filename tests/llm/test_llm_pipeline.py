import corpus_pipeline
from llm_cases import awkward, empty

import __spark_entry__
from planpulse.llm import langid, queries, quality, simhash
from planpulse.llm.common import to_scratch

D = "/root/testdata/sf0.001"


def test_stages_against_their_operators(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "language_id", "simhash_near_dedup", "best_fit_packing"]
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = to_scratch(stage(spark, docs, D), name)
        kept.append((before, docs))
        if name != names[-1]:
            assert docs.columns == columns
    before, after = kept[0]
    model = quality.train(before, spark.read.parquet(f"{D}/labels.parquet"))
    good = {r.doc_id for r in quality.score(before, model).collect() if r.predicted}
    assert {r.doc_id for r in after.collect()} == good
    before, after = kept[1]
    model, text = langid.train(before), {r.doc_id: r.text or "" for r in before.collect()}
    known = [{(a, b, c) for codes in [s.tolist()] for x in codes for a, b, c in [(x >> 16, x >> 8 & 255, x & 255)]} for s in model.strings]

    def share(doc_id, lang):
        b = bytes(48 if 48 <= x <= 57 else x + 32 if 65 <= x <= 90 else x for x in text[doc_id].encode())
        return sum(t in known[model.languages.index(lang)] for t in zip(b, b[1:], b[2:])) / max(len(b) - 2, 1) if len(b) > 2 else 1

    told = {r.doc_id for r in langid.predict(before, model).collect()
            if r.lang_pred != "und" and r.score >= 0.3 and share(r.doc_id, r.lang_pred) >= model.floor}
    assert {r.doc_id for r in after.collect()} == told
    before, after = kept[2]
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in simhash.near_duplicates(before).collect()}
    before, after = kept[3]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}


def test_run_is_the_stages_in_a_row(spark):
    rows = corpus_pipeline.run(spark, D).collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in by.values():
        at = 0
        for offset, n in sorted(members):
            assert offset == at
            at += n
        assert at <= 2048


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, D).collect()}
    clean = [i for i, r in labels.items() if r.quality == 1]
    assert sum(i in kept for i in clean) / len(clean) > 0.97


def test_awkward_and_empty_inputs(spark):
    for make in (awkward, empty):
        docs = make(spark)
        for name, stage in corpus_pipeline.STAGES:
            docs = to_scratch(stage(spark, docs, D), name)
        if make is empty:
            assert docs.count() == 0


def test_every_query_is_registered():
    names = set(__spark_entry__.queries())
    assert {"pipeline"} < names and set(queries.QUERIES) <= names
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


JUNK = ["qzxv jkwp mbtrq zzkx wqpv hjklm xcvb ztrq pwkj vbnx " * 8, "Комитет собрался в понедельник и заслушал три доклада. " * 4,
        "委员会星期一开会听取了三份报告其中两份被接受" * 4, "a" * 500, "aGVsbG8gd29ybGQgdGhpcyBpcyBhIGxvbmc" * 6,
        "Il comitato si è riunito lunedì e ha ascoltato tre relazioni, di cui due sono state accettate. " * 3,
        "def f(x):\n    for i in range(10):\n        if x[i] > y: return {k: v for k, v in d.items()}\n" * 3, "12 34 !!", None]


def test_language_stage_rejects_junk_and_keeps_clean(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    junk = spark.createDataFrame([(10 ** 9 + i, t) for i, t in enumerate(JUNK)], "doc_id bigint, text string")
    both = docs.unionByName(junk, allowMissingColumns=True)
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, both, D).select("doc_id").collect()}
    assert not [t for i, t in enumerate(JUNK) if 10 ** 9 + i in kept]
    ids = [r.doc_id for r in docs.filter("n_chars > 0").select("doc_id").collect()]
    assert sum(i in kept for i in ids) / len(ids) > 0.99


def test_duplicate_stage_takes_columns_of_any_name(spark):
    rows = [(1, "a b c d e f", 1, "x", 2), (2, "a b c d e f", 2, "y", 3), (3, "k l m n o p", 3, "z", 4), (3, "k l m n o p", 4, "z", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _id int, _hash string, `rows` int")
    out = corpus_pipeline.duplicate_stage(spark, docs, D)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r._id in (3, 4)) for r in out.collect()) == [(1, False), (3, True)]
