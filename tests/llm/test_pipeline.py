import os
import re

import corpus_pipeline as cp
from ledgerloom.llm import decontam, pii

SF = "/root/testdata/sf0.001"


def test_each_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*cp.COLUMNS)
    kept = {}
    for name, stage in cp.STAGES[:4]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == list(cp.COLUMNS)
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    first = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rude = re.compile("idiot|moron|worthless|pathetic|disgusting")
    assert sum(bool(rude.search((first[i] or "").lower())) for i in first if i not in kept["toxicity"]) >= 1
    assert set(kept["near_duplicates"]) <= set(kept["toxicity"]) and len(set(kept["near_duplicates"].values())) == len(kept["near_duplicates"])
    m = decontam.Matcher([(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert {i for i, t in kept["near_duplicates"].items() if not m.find(decontam.words(t))[0]} == set(kept["decontamination"])
    assert not any(re.search(pii.PATTERNS["email"].replace("++", "+").replace(r"|\G", ""), t) for t in kept["personal_data"].values())
    out = {r.doc_id: r for r in cp.STAGES[4][1](spark, docs, SF).collect()}
    assert {i: r.decoded for i, r in out.items()} == kept["personal_data"] and all(len(r.ids) == r.n_tokens for r in out.values())


def test_run_gives_the_rows_of_the_stages(spark):
    got = cp.run(spark, SF)
    assert got.count() > 100
    path = got.inputFiles()[0].removeprefix("file:").rsplit("/", 2)[0]
    assert os.listdir("/" + path.lstrip("/")) == ["bpe"]
