"""The pipeline's stages, one after the other, against plain versions."""

from __future__ import annotations

import os
import random

import brute
import corpus_pipeline
from sensorflow.llm import toxicity


def test_stages_take_effect(spark, tmp):
    rng = random.Random(8)
    letters = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 5)))
    text = lambda n: " ".join(letters() for _ in range(n))
    docs = {i: text(120) for i in range(150)}
    toxic = {i for i in range(150) if i % 3 == 0}
    for i in toxic:
        w = docs[i].split()
        w[7] = "vilest"
        docs[i] = " ".join(w)
    docs[1000] = docs[1] + " " + text(5)  # a near copy
    docs[1001] = docs[2]  # an exact copy
    item = text(40)
    docs[1002] = text(30) + " " + item + " " + text(30)
    docs[1003] = text(30) + " mail a.b@example.com " + text(20)
    rows = [(i, t, "en", "s", len(t)) for i, t in docs.items()] + [(2000, None, None, None, None), (2001, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(os.path.join(tmp, "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(os.path.join(tmp, "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(os.path.join(tmp, "benchmark.parquet"))
    left = spark.read.parquet(os.path.join(tmp, "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, tmp)
        assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r["doc_id"]: r["text"] for r in left.collect()}
    assert set(kept["toxicity"]) == set(dict.fromkeys([*docs, 2000, 2001])) - toxic
    comp = brute.components(kept["toxicity"], 5, 80)
    assert set(kept["near_dedup"]) == {i for i in comp if comp[i] == i} == set(kept["toxicity"]) - {1000, 1001}
    assert set(kept["decontamination"]) == set(kept["near_dedup"]) - {1002}
    assert set(kept["pii"]) == set(kept["decontamination"])
    assert "[EMAIL]" in kept["pii"][1003] and "example.com" not in kept["pii"][1003]
    out = corpus_pipeline.run(spark, tmp).collect()
    assert {r["doc_id"] for r in out} == set(kept["pii"])
    assert toxicity.HELD_OUT == 0
