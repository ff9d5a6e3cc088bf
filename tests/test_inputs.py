"""The given tables reach the operators whole and evenly spread."""

import random

from assayer.plans import inputs


def test_one_row_group_is_worked_on_by_several_tasks(spark, tmp_path):
    draw = random.Random(5)
    texts = ["".join(draw.choices("abcdefghij klmnop. qrstuvwxyz", k=20_000)) for _ in range(600)]
    # Keys repeat and are NULL, rows are copies of each other.
    documents = [(None if i % 50 == 0 else i // 2, t, "en", "web", len(t)) for i, t in enumerate(texts)] + [(7, "a copy", "en", "web", 6)] * 5
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(0, 200)], "doc_id long, quality long").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    inputs.source(spark, str(tmp_path)).write.parquet(f"{tmp_path}/source")
    found = spark.read.parquet(f"{tmp_path}/source")
    assert found.select("_metadata.file_path").distinct().count() > 1  # files with rows
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r._row_key, r.text_content) for r in found.collect()), key=key) == sorted(((d[0], d[1]) for d in documents), key=key)


def test_texts_cross_the_network_once_and_unsorted(spark, tmp_path):
    spark.createDataFrame([(1, "a", "en"), (None, "b", "en")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0), (None, 1)], "doc_id long, quality long").write.parquet(f"{tmp_path}/labels.parquet")
    for most in ("10MB", "-1"):  # whether labels may be broadcast or not
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
        try:
            plan = inputs.source(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "ShuffledHashJoin" in plan and "Sort " not in plan
        assert plan.count("Exchange hashpartitioning") == 2  # the texts and the labels


def test_labels_reach_every_row_of_their_key(spark, tmp_path, rows):
    documents = [(i % 7 if i % 10 else None, f"text {i % 33}", "en") for i in range(200)]
    labels = [(0, 1), (1, 0), (1, 1), (2, None), (None, 1), (9, 0)]
    spark.createDataFrame(documents, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality long").write.parquet(f"{tmp_path}/labels.parquet")
    found = inputs.source(spark, str(tmp_path)).select("_row_key", "text_content", "label")
    expected = []
    for key, text, _ in documents:
        of_key = [label for k, label in labels if key is not None and k == key]
        expected += [(key, text, label) for label in (of_key or [None])]
    assert rows(found) == sorted(expected, key=lambda t: tuple((v is None, str(v)) for v in t))
