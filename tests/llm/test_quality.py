import zlib

import numpy as np
from corpus_helpers import empty, rows, table
from ledgerloom.llm import quality_cnn as q


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = q.score_documents(docs, q.fit(docs, labels)).toPandas()
    assert len(scored) == docs.count()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id]).all()
    both = scored.merge(labels.toPandas(), on="doc_id")
    both = both[both.held_out]
    rank, ones = both.score.rank(), (both.quality == 1).sum()
    auc = (rank[both.quality == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(both) - ones))
    assert auc > 0.9
    assert (both.predicted == both.quality).mean() > 0.9


def test_awkward_rows_and_missing_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = q.fit(table(spark), none)
    got = q.score_documents(table(spark), model).collect()
    assert len(got) == len(rows()) and {r.score for r in got} == {0.5} and {r.predicted for r in got} == {1}
    one = spark.createDataFrame([(2, 1, 0), (3, None, 0), (7, 1, 0), (7, 0, 0), (None, 0, 0)],
                                "doc_id long, quality int, toxic int")
    assert q.fit(table(spark), one).constant in (1.0, 0.5)
    assert q.score_documents(empty(spark), model).collect() == []


def _model():
    rng = np.random.default_rng(0)
    return q.Model(rng.normal(size=(256, q.DEPTH)).astype(np.float32),
                   rng.normal(size=(q.WIDTH * q.DEPTH, q.FILTERS)).astype(np.float32),
                   np.zeros(q.FILTERS, np.float32), rng.normal(size=2 * (q.FILTERS + 1)) * 0.01, 0.0)


def test_scores_do_not_depend_on_neighbours_and_cover_the_end():
    texts = [b"", b"abc", b"word " * 700, b"z" * 4000 + b"!", b"tail" * 129]
    model = _model()
    one = [q.probabilities(model, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    assert np.allclose(q.probabilities(model, raw, np.append(0, np.cumsum([len(t) for t in texts]))), one)
    longer = b"word " * 700 + b"#@&%" * 8
    assert q.probabilities(model, np.frombuffer(longer, np.uint8), np.array([0, len(longer)]))[0] != one[2]


def test_repeat_channel():
    flags = q.repeats(np.frombuffer(b"zu zu zu zu zu zu zu und keine", np.uint8))
    assert flags[4:18].all() and not flags[-8:].any()


def test_filter_keeps_columns(spark):
    kept = q.keep_good(table(spark), q.Model(*[np.zeros(0)] * 4, 0.0, constant=0.5))
    assert kept.columns == table(spark).columns and kept.count() == len(rows())
    assert q.keep_good(table(spark), q.Model(*[np.zeros(0)] * 4, 0.0, constant=0.1)).count() == 0


def test_features_against_a_plain_forward_pass():
    model, rng = _model(), np.random.default_rng(1)
    for text in (b"", b"hi", b"word " * 300, bytes(rng.integers(1, 256, 2000, dtype=np.uint8))):
        raw = np.frombuffer(text, np.uint8)
        n_segments = -(-(len(raw) + 32) // q.SEGMENT)
        data = np.zeros(n_segments * q.SEGMENT, np.uint8)
        data[:len(raw)] = raw
        flags = q.repeats(np.append(data, np.zeros(q.WIDTH, np.uint8)))
        chunks = []
        for first in range(0, max(1, n_segments - 1), 3):
            begin, end = first * q.SEGMENT, min((first + 4) * q.SEGMENT, len(data))
            tops = np.full(q.FILTERS, -np.inf)
            for at in range(begin, end, q.STEP):
                if at + q.WIDTH <= len(data):
                    tops = np.maximum(tops, model.embed[data[at:at + q.WIDTH]].reshape(-1) @ model.filters)
            share = q.REPEAT_SCALE * flags[begin:end].sum() / min(max(len(raw) - begin, 1), q.CHUNK)
            chunks.append([*np.maximum(tops + model.bias, 0), share])
        want = np.concatenate([np.max(chunks, axis=0), np.mean(chunks, axis=0)])
        got = q.features(model, raw, np.array([0, len(raw)]))[0]
        assert np.allclose(got, want, atol=1e-3), text[:10]


def test_an_id_with_two_texts_trains_alike(spark):
    docs = [(i, ("good clean words " if i % 2 else "### $$$ bad ") * (i % 5 + 1)) for i in range(1, 60)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, quality int")
    twice = docs + [(i, "another text") for i, _ in docs]
    models = []
    for rows_ in (twice, twice[::-1]):
        frame = spark.createDataFrame(rows_, "doc_id long, text string").repartition(3)
        models.append(q.fit(frame, labels))
    assert np.array_equal(models[0].filters, models[1].filters) and np.array_equal(models[0].dense, models[1].dense)
