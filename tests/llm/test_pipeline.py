import random

import corpus_pipeline
from pyspark.sql import functions as F


def test_stages(spark, tmp_path):
    maker = random.Random(2)
    words = {"aa": ["than", "ing", "ou", "wer"], "bb": ["schü", "ung", "ei", "ver"]}
    texts = []
    for lang, parts in words.items():
        vocabulary = ["".join(maker.choices(parts, k=2)) + str(i) for i in range(200)]
        texts += [(" ".join(maker.choices(vocabulary, k=60)), lang) for _ in range(40)]
    texts += [(texts[0][0].replace(" ", "  "), "aa"), ("12 34", "aa"), (None, None)]
    rows = [(i, t, lang, f"s{i % 3}", len(t or "")) for i, (t, lang) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    folder = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = corpus_pipeline.stored(docs, "test-stage")
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert seen[0] == set(range(81))
    # The copy with wider gaps is the longer text, so it stays.
    assert seen[1] == set(range(1, 81))
    assert seen[2] <= seen[1] and len(seen[2]) > 70
    final = corpus_pipeline.run(spark, folder)
    assert final.where(~F.col("intact")).count() == 0
    assert {r.doc_id for r in final.collect()} == seen[3]
