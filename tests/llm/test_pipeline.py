from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
from storelake.llm import quality, simhash
from tests.llm.helpers import documents
from tests.llm.test_quality import sample


def test_stages_take_effect(spark, tmp_path):
    texts = sample(120, 5)
    rows = [(i, t, "ab"[i % 3 % 2]) for i, (t, _) in enumerate(texts)]
    good = [i for i, (_, y) in enumerate(texts) if y]
    rows += [(1000 + k, texts[i][0], "a") for k, i in enumerate(good[:5])]  # exact copies
    rows += [(2000, None, "b"), (2001, "", "b")]
    # Near copies: one word of a long good text is another, so few bits of the print differ.
    long = " ".join(texts[i][0] for i in good[5:40])
    rows += [(3000 + k, long + f" and{k}", "b") for k in range(4)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(
        [(i, y, 0) for i, (_, y) in enumerate(texts)], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        folder = f"{tmp_path}/out-{name}"
        out.write.parquet(folder)
        docs = spark.read.parquet(folder)
        kept[name] = docs.collect()
        if name != "pack":
            assert docs.columns == spark.read.parquet(f"{tmp_path}/documents.parquet").columns
    ids = {name: {r.doc_id for r in rows} for name, rows in kept.items()}
    assert ids["quality"] >= set(good) and not ids["quality"] & {
        i for i, (_, y) in enumerate(texts) if not y
    }
    assert not ids["exact_dedup"] & set(good[:5]) and ids["exact_dedup"] >= set(range(1000, 1005))
    assert ids["near_dedup"] <= ids["exact_dedup"] and ids["pack"] == ids["mix"] <= ids["near_dedup"]
    linked = simhash.near_components(spark.read.parquet(f"{tmp_path}/out-exact_dedup")).collect()
    assert ids["near_dedup"] == {r.component_id for r in linked}
    near = {r.component_id for r in linked if 3000 <= (r.doc_id or 0) < 3004}
    assert len(near) < len(ids["exact_dedup"] & set(range(3000, 3004)))
    held = defaultdict(int)
    for r in kept["pack"]:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 4096
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(kept["pack"])


def test_model_scores_are_a_function_of_the_text():
    model = quality.fit(sample(40, 1))
    both = model.scores([b"a line.", b"a line."])
    assert both[0] == both[1]
