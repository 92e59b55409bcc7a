"""The pipeline: every stage on its own input, against the operator's decisions."""

import corpus_pipeline
from cellscape.llm import decontamination, jaccard_join


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        kept.append(out)
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in kept]
    assert len(ids[1]) > 0.7 * len(ids[0])
    groups = jaccard_join.similar_components(kept[1])[0].collect()
    assert ids[2] == {r["doc_id"] for r in groups if r["doc_id"] == r["component_id"]}
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    found = {r["doc_id"] for r in decontamination.contaminated(kept[2], bench).collect()}
    assert ids[3] == ids[2] - found and decontamination.contaminated(kept[3], bench).count() == 0
    assert ids[4] == ids[3]
    final = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in final} == ids[4]


def test_stages_decide_by_row(spark, sf):
    """Null and repeated ids: each row goes or stays by its own text, one row of each group stays."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first()["text"]
    line = lambda tag: " ".join(f"{tag}{k}" for k in range(60))
    texts = lambda df: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in df.collect())

    def made(*rows):
        return spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], docs.schema).repartition(3)

    copies = made((1, line("a")), (1, line("a")), (1, line("a")), (None, line("a")), (None, line("b")), (None, line("b")),
                  (5, line("c")), (2, line("c")), (5, line("d")), (7, line("e")), (7, line("e") + " more"))
    got = texts(corpus_pipeline.jaccard_stage(spark, copies, sf))
    assert [(none, d, t.split()[0]) for none, d, t in got] == [
        (False, 1, "a0"), (False, 2, "c0"), (False, 5, "d0"), (False, 7, "e0"), (True, 0, "b0")]

    leaks = made((None, "x " + item), (None, line("a")), (3, line("b")), (3, item + " y"), (4, item))
    assert [t.split()[0] for _, _, t in texts(corpus_pipeline.decontamination_stage(spark, leaks, sf))] == ["b0", "a0"]

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    graded = corpus_pipeline.toxicity.grade_documents(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    bad = graded.where("expected_severity > 0").orderBy("rejected", "expected_severity").tail(1)[0]
    assert bad["rejected"]
    toxic = docs.where(docs.doc_id == bad["doc_id"]).first()["text"]
    # the other ids have no label, so that the model is the same
    odd = docs.unionByName(made((None, toxic), (-1, toxic), (-1, "a clean line of words"), (None, "another clean line")))
    kept = [t for _, _, t in texts(corpus_pipeline.toxicity_stage(spark, odd, sf))]
    assert toxic not in kept and {"a clean line of words", "another clean line"} <= set(kept)


def test_stages_keep_columns_of_any_name(spark, sf):
    """Extra columns that stages use inside, empty tables, null, empty and long texts."""
    long = "plain words of a long text " * 200_000
    rows = [(1, "a b c d e f", 7, "r", "f", 1), (2, None, 8, "r2", None, 2), (None, "", None, None, "f3", 3), (4, long, 9, "r4", "f4", 4),
            (5, "password = abcdefghijkl9", 24, "r5", "f5", 5), (5, "password = abcdefghijkl9 and five other words", 46, "r6", "f6", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, row_number string, found string, row_number_ int").repartition(3)
    for table in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, table, sf)
            assert got.columns == table.columns
            kept = {r["row_number_"]: tuple(r) for r in got.collect()}
            want = {r["row_number_"]: tuple(r) for r in table.collect()}
            if name == "secret_scan" and want:
                assert kept[5][:3] == (5, "[secret]", 8) and kept[6][3:] == want[6][3:]
                kept = {k: v for k, v in kept.items() if k < 5}
                want = {k: v for k, v in want.items() if k < 5}
            assert kept == want
        placed = corpus_pipeline.packing_stage(spark, table, sf).collect()
        assert len(placed) >= table.count() and sum(r["piece"] == 0 for r in placed) == table.count()
