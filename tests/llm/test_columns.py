"""Columns of any name may lie beside those that an operator reads."""

from matchloom.llm import columns, decontaminate, log_templates, near_dup, pii_surrogates, quality_rules, repeats

MORE = ["a.b", "N_ENTITIES", "__QUALITY", "N_BYTES", "n_lines_", "N_LINES", "Kept", "__ID", "x`y", "line", "tokens", "support", "Stratum"]


def docs(spark):
    text = "One line of a text for Dr. Anna Miller with some words in it\nand another line that has words of its own"
    rows = [(k, text, "en", *range(len(MORE))) for k in range(3)] + [(None, None, None, *range(len(MORE)))]
    return spark.createDataFrame(rows).toDF("doc_id", "TEXT", "lang", *MORE)


def carried(out, *gone):
    stay = columns.others(MORE, *gone)
    rows = out.select(*columns.all_named(stay)).distinct().collect()
    assert [tuple(r) for r in rows] == [tuple(MORE.index(c) for c in stay)]


def test_any_column_is_carried_along(spark):
    df = docs(spark)
    carried(pii_surrogates.replaced(df, key="k"), "n_entities")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    carried(quality_rules.judged(df, labels), "__quality", "__kept")
    assert quality_rules.keep_good(df, labels).columns == df.columns
    carried(repeats.without_repeats(df), *repeats.RESULTS)
    carried(log_templates.without_templates(df, counts=("n_lines", "n_dropped")), "n_lines")
    assert log_templates.keep_filled(df).columns == near_dup.keep_one(df).columns == df.columns
    assert decontaminate.clean(df, spark.createDataFrame([(1, "some words that no text has at all")], "item_id long, text string")).columns == df.columns


def test_pipeline_stages_carry_columns(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "some words that no text has at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = docs(spark).withColumnRenamed("TEXT", "text")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, str(tmp_path)).columns[: len(df.columns)] == df.columns, name
