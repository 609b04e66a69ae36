import hashlib

from corpus_helpers import empty, rows, table, word_sets
from ledgerloom.llm.fingerprints import fingerprint_documents, fingerprint_edits


def test_edited_texts_and_neighbours(spark):
    frame = table(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in fingerprint_edits(frame).collect()}
    text = {r[0]: r[1] or "" for r in rows() if r[0] is not None}
    order = sorted(text, reverse=True)
    assert sorted(got) == sorted(text)
    for k, i in enumerate(order):
        own, after = text[i], text[order[(k + 1) % len(order)]]
        third = len(own) // 3
        edited = own[:len(own) - third] + after[:third]
        assert got[i].n_chars == len(own)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[1].fingerprint == got[3].fingerprint and got[4].fingerprint == got[5].fingerprint == ""


def test_likeness_follows_the_sets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    order = sorted(text, reverse=True)
    wrong = []
    for r in fingerprint_edits(docs).collect():
        own, after = text[r.doc_id], text[order[(order.index(r.doc_id) + 1) % len(order)]]
        third = len(own) // 3
        a, b = word_sets(own, 5), word_sets(own[:len(own) - third] + after[:third], 5)
        wrong.append(r.near_edited - (len(a & b) / len(a | b) if a | b else 1.0))
    assert abs(sum(wrong) / len(wrong)) < 0.02 and (sum(e * e for e in wrong) / len(wrong)) ** 0.5 < 0.06


def test_nulls_repeats_and_empty_table(spark):
    got = fingerprint_edits(table(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows())
    assert fingerprint_edits(empty(spark)).collect() == []
    prints = {r.doc_id: r.fingerprint for r in fingerprint_documents(table(spark)).collect()}
    assert prints[1] == prints[3] == prints[13] != prints[2] and len(prints[1]) == 256


def test_plan_has_no_python(spark):
    plan = fingerprint_edits(table(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow"))
    one = spark.createDataFrame([(9, "a b c d e f")], "doc_id long, text string")
    assert fingerprint_edits(one).first().near_next == 1.0
