import corpus_pipeline

from holdfast.llm.common import materialise


def test_stages_pass_documents_on(spark, odd, empty):
    for df in (odd, empty):
        docs = df
        for name, stage in corpus_pipeline.STAGES:
            out = materialise(stage(spark, docs, "/root/testdata/sf0.001"), name)
            if name == corpus_pipeline.STAGES[-1][0]:
                assert out.columns[:2] == ["doc_id", "piece"]
            else:
                assert out.columns == df.columns
                assert out.count() <= docs.count()
            docs = out


def test_run_keeps_clean_documents_and_drops_copies(spark):
    folder = "/root/testdata/sf0.001"
    packed = corpus_pipeline.run(spark, folder)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first = {r.id for r in docs.groupBy("text").agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "id").collect()}
    assert kept <= first
    good = [d for d, q in labels.items() if q and d in first]
    assert sum(d in kept for d in good) / len(good) > 0.85
    poor = [d for d, q in labels.items() if not q and d in first]
    assert sum(d in kept for d in poor) / len(poor) < 0.25  # of a fit on very few rows


def test_every_stage_calls_an_operator():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_rules_judge_rows_by_text_language_and_source(odd):
    from holdfast.llm.quality_rules import apply_rules, quality_rules

    judged = quality_rules(odd).where("kept").count()
    assert apply_rules(odd).count() == judged


def test_no_repeated_passage_of_over_50_words_stays(spark):
    """Over a whole table: what suffix_array_dedup takes out, and that it leaves texts without such passages alone."""
    from collections import Counter

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["text"])
    stage = dict(corpus_pipeline.STAGES)["suffix_array_dedup"]
    out = stage(spark, docs, "/root/testdata/sf0.01")
    assert out.columns == docs.columns
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in (docs, out))

    def windows(texts, n):
        split = [t.split() for t in texts]
        return Counter(tuple(w[k : k + n]) for w in split for k in range(len(w) - n + 1))

    assert before.keys() == after.keys()
    assert max(windows(after.values(), 51).values()) == 1
    short = windows(before.values(), 49)
    for k, t in before.items():
        words = t.split()
        if all(short[tuple(words[i : i + 49])] == 1 for i in range(len(words) - 48)):
            assert after[k] == t


def test_row_groups_are_bounded(spark):
    """A task that writes texts holds one row group at a time: some MB of it, however much it writes."""
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from holdfast.llm.common import importable, release

    importable(spark)
    noise = F.concat(*(F.sha2(F.concat_ws("-", "id", F.lit(k)), 512) for k in range(8)))
    table = materialise(spark.range(0, 48_000, 1, 1).select(noise.alias("text")), "noise")  # 49 MB in one task
    (name,) = (x.removeprefix("file://").removeprefix("file:") for x in table.inputFiles())
    meta = pq.ParquetFile(name).metadata
    sizes = [meta.row_group(k).total_byte_size for k in range(meta.num_row_groups)]
    release(table)
    assert sum(sizes) > 48_000_000 and max(sizes) < 16_000_000


def test_row_groups_of_long_texts_are_bounded(spark):
    """Fewer than 100 texts of 1 MB, and such texts after many short ones."""
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from holdfast.llm.common import importable, release

    importable(spark)
    numbers = F.sequence(F.lit(1), F.when(F.col("id") < 2000, 1).otherwise(8000))
    text = F.array_join(F.transform(numbers, lambda k: F.sha2(F.concat_ws("-", "id", k), 512)), "")
    for first, last in ((2000, 2060), (0, 2060)):
        table = materialise(spark.range(first, last, 1, 1).select(text.alias("text")), "long")
        (name,) = (x.removeprefix("file://").removeprefix("file:") for x in table.inputFiles())
        meta = pq.ParquetFile(name).metadata
        sizes = [meta.row_group(k).total_byte_size for k in range(meta.num_row_groups)]
        release(table)
        assert sum(sizes) > 60_000_000 and max(sizes) < 20_000_000


def test_a_sessions_own_bounds_stay(spark):
    from holdfast.llm.common import importable

    own = spark.newSession()
    own.conf.set("parquet.block.size", "1048576")
    importable(own)
    assert own.conf.get("parquet.block.size") == "1048576"
    assert own.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "256"
