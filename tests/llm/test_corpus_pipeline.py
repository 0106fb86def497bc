"""The pipeline stage by stage against what each stage's input says."""

import hashlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_native_operators import strip
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tierlake.llm import mixing, ordinal

SF = "/root/testdata/sf0.001"


def test_stages_on_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, outputs = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path_in = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), f"t{k}")
        outputs.append((name, path_in, docs))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name

    _, before, after = outputs[0]
    model = ordinal.train(before, spark.read.parquet(f"{SF}/labels.parquet"), ordinal.label_grade(), ordinal.GRADES)
    kept = {r.doc_id for r in ordinal.score_documents(before, model).filter("kept").collect()}
    assert {r.doc_id for r in after.collect()} == kept and 0 < len(kept) < before.count()

    _, before, after = outputs[1]
    best = {}
    for r in before.collect():
        key = strip(r.text)
        best[key] = min(best.get(key, (0, 1 << 60)), (-len(r.text or ""), r.doc_id))
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for _, d in best.values())

    _, before, after = outputs[2]
    items = [(r.doc_id, brute_fingerprint(r.text)) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(brute_components(items)))

    _, before, after = outputs[3]
    plan = {r.doc_id: int(r.taken / r.size + 0.5) for r in mixing.mix(before).collect() if r.size}
    assert Counter(r.doc_id for r in after.collect()) == Counter({d: n for d, n in plan.items() if n})

    _, before, after = outputs[4]
    library = Tokenizer.from_file(tokenizer)
    want = Counter()
    for r in before.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in after.collect()) == want


def test_run_applies_all_stages_and_handles_edge_and_empty_tables(spark, edge_sf, empty_sf):
    out = corpus_pipeline.run(spark, edge_sf)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
    assert corpus_pipeline.run(spark, empty_sf).count() == 0
