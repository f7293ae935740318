import random

import pytest
from helpers import doc_frame, edited, prose

import __spark_entry__ as entry
import corpus_pipeline
from loadloom.llm import secrets
from loadloom.llm.packing import LENGTHS


@pytest.fixture
def planted(spark, tmp_path):
    """Documents with toxic ones, near copies, leaks and secrets, and the tables the stages read."""
    rng = random.Random(20)
    rows, labels, kinds = [], [], {}
    item = prose(rng, 30)
    for i in range(900):
        text, kind = prose(rng, rng.choice((40, 120)), 400), "clean"
        if i % 6 == 0:
            ws = text.split()
            ws[rng.randrange(len(ws))] = rng.choice(("scum", "idiot"))
            text, kind = " ".join(ws), "toxic"
        elif i % 40 == 1:
            text, kind = text + " " + item, "leak"
        elif i % 40 == 2:
            text, kind = text + ' token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"', "secret"
        elif i % 40 == 3:
            text, kind = prose(rng, 200), "base"
        elif i % 40 == 4:
            text, kind = edited(rng, rows[-1][1], 0.01), "copy"
        rows.append((i, text))
        kinds[i] = kind
        labels.append((i, 1, int(kind == "toxic")))
    path = str(tmp_path)
    docs = doc_frame(spark, rows, clash=False)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, dict(rows), kinds


def test_every_decision_takes_effect_and_clean_documents_stay(spark, planted):
    path, texts, kinds = planted
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, ids = docs.columns, {k: {i for i, x in kinds.items() if x == k} for k in set(kinds.values())}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == columns, name
        docs.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        kept = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        if name == "toxicity":
            assert len(kept.keys() & ids["toxic"]) <= 0.05 * len(ids["toxic"]) and len(ids["clean"] - kept.keys()) <= 0.01 * len(ids["clean"])
        if name == "near_duplicates":
            assert ids["base"] <= kept.keys() and not kept.keys() & ids["copy"]
        if name == "decontamination":
            assert not kept.keys() & ids["leak"]
        if name == "secrets":
            assert all(secrets.REPLACEMENT in kept[i] for i in ids["secret"] & kept.keys())
            assert all(kept[i] == texts[i] for i in ids["clean"] & kept.keys())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r["doc_id"] for r in packed} == kept.keys() and all(r["length"] in LENGTHS for r in packed)


def test_run_equals_the_stages_and_is_registered(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "sequence", "length"} <= set(got.columns) and got.count() > 0
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]


def test_empty_documents(spark, planted):
    path, *_ = planted
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    assert docs.count() == 0


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
