import re

import corpus_pipeline
from corpus_helpers import empty, table
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.surrogates import find_entities
from test_superminhash import brute_force

SF = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    import __spark_entry__
    names = list(__spark_entry__.queries())
    assert [n for n in names if n.startswith("op")] == list(QUERIES) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "decontaminate", "personal_data", "encode"]
    good = stages["quality"](spark, docs, SF)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert good.columns == columns and sum(labels.get(i) == 1 for i in kept) >= 0.97 * sum(q == 1 for q in labels.values())

    unique = stages["near_dedup"](spark, docs, SF)
    text = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in unique.collect()} == {i for i, (_, c) in brute_force(text, 5).items() if c == i}

    clean = stages["decontaminate"](spark, docs, SF)
    plain = lambda t: " " + " ".join(re.sub(r"[^a-z0-9\s]", "", (t or "").lower()).split()) + " "
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {i for i, t in text.items() if any(p in plain(t) for p in items)}
    assert {r.doc_id for r in clean.collect()} == set(text) - dirty

    private = stages["personal_data"](spark, docs, SF)
    assert private.columns == columns and private.count() == len(text)
    for r in private.collect():
        for a, b, kind, _ in find_entities(text[r.doc_id] or ""):
            assert text[r.doc_id][a:b] not in r.text
        assert r.n_chars == len(r.text)


def test_run_is_the_stages_in_order(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
    assert sorted(map(tuple, got)) == sorted(map(tuple, docs.collect())) and got


def test_stages_take_awkward_and_empty_tables(spark):
    for name, step in corpus_pipeline.STAGES:
        for docs in (table(spark), empty(spark)):
            out = step(spark, docs, SF)
            out.collect()
            if name != "encode":
                assert out.columns == docs.columns
