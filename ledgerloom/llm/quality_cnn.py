"""Document quality by a byte-level convolutional network in numpy.

Every byte is embedded; learned filters of ``WIDTH`` bytes slide over the whole
document in steps of ``STEP``; overlapping chunks (four segments long, three
segments apart) keep each filter's largest response.  One more channel marks
bytes whose next four bytes stood up to ``LAGS`` bytes earlier, pooled by its
mean, since filters cannot compare bytes with each other.  A document's
features are every channel's maximum and mean over its chunks; a logistic
layer turns them into one probability.

Training is bounded: ``sample_rows`` labelled rows of each class, chosen by a
hash of the id (of an id's several texts the one with the smallest digest),
give at most ``chunks`` evenly spread chunks each; only these go to the driver,
where the small network is fitted, so ``2 * sample_rows * chunks`` chunks of
512 bytes bound it.  The output is shifted to
the labels' true class ratio, counted over all labels.  Scoring reads every
byte of every row.  Inputs of a score are the text's bytes, nothing else.

Defined results: null text is read as empty, and the empty text has a score
like any other; rows whose id is null are never trained on (``held_out``);
labels that are null, or contradict each other for one id, are not used;
without labels of both classes every score is the share of label 1 (0.5
without labels); repeated rows are scored each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, pick, prepare, utf8_buffer

DEPTH, FILTERS, WIDTH, STEP = 8, 32, 8, 4
SEGMENT, LAGS = 128, 24
CHUNK = 4 * SEGMENT
#: Scale of the repeat channel, near that of the filters' responses.
REPEAT_SCALE = 6.0
_PAD = 32                       # zero bytes behind a document, at least


@dataclass
class Model:
    embed: np.ndarray           # 256 x DEPTH
    filters: np.ndarray         # WIDTH * DEPTH x FILTERS
    bias: np.ndarray            # FILTERS
    dense: np.ndarray           # 2 * (FILTERS + 1)
    shift: float
    constant: float | None = None


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def repeats(data: np.ndarray) -> np.ndarray:
    """Bytes whose next four bytes also stood up to LAGS bytes earlier."""
    flag = np.zeros(len(data), bool)
    if len(data) < 8:
        return flag
    d = data.astype(np.uint32)
    code = d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16) | d[3:] << np.uint32(24)
    seen = flag[:len(code)]
    for lag in range(2, min(LAGS, len(code) - 1) + 1):
        seen[lag:] |= code[lag:] == code[:-lag]
    seen &= (data[:-3] != 0) & (data[3:] != 0)
    return flag


def padded(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents laid out in whole segments, zeros behind each; the rows+1
    offsets in segments."""
    sizes = np.diff(offsets)
    segments = np.append(0, np.cumsum(-(-(sizes + _PAD) // SEGMENT)))
    data = np.zeros(int(segments[-1]) * SEGMENT + WIDTH, np.uint8)
    target = np.repeat(segments[:-1] * SEGMENT - offsets[:-1], sizes) + np.arange(len(raw))
    data[target] = raw
    return data, segments


def _responses(model: Model, data: np.ndarray) -> np.ndarray:
    """Filter responses at every STEP-th byte (ReLU applied after pooling)."""
    n = (len(data) - WIDTH) // STEP
    x = model.embed[data[:(n + 1) * STEP]].reshape(n + 1, STEP * DEPTH)
    half = STEP * DEPTH
    y = x[:-1] @ model.filters[:half]
    y += x[1:] @ model.filters[half:]
    return y


def features(model: Model, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Maximum and mean over its chunks of every channel, for each row."""
    data, segments = padded(raw, offsets)
    n = int(segments[-1])
    per = SEGMENT // STEP
    response = _responses(model, data)[:n * per]
    response[segments[1:] * per - 1] = -np.inf             # this window would read the next document
    top = response.reshape(n, per, FILTERS).max(axis=1)
    rate = repeats(data)[:n * SEGMENT].reshape(n, SEGMENT).sum(axis=1).astype(np.float32)
    used = np.diff(segments)
    chunks = np.maximum(1, -(-(used - 1) // 3))            # of 4 segments, 3 apart
    row = np.repeat(np.arange(len(used)), chunks)
    first = segments[row] + 3 * (np.arange(len(row)) - np.repeat(np.cumsum(chunks) - chunks, chunks))
    last = segments[row + 1] - 1
    parts = [np.minimum(first + k, last) for k in range(4)]
    pooled = np.maximum(np.maximum.reduce([top[p] for p in parts]) + model.bias, 0)
    lengths = np.diff(offsets)
    begin = (first - segments[row]) * SEGMENT
    inside = np.clip(lengths[row] - begin, 1, CHUNK)
    share = REPEAT_SCALE * sum(np.where(first + k <= last, rate[p], 0) for k, p in enumerate(parts)) / inside
    channel = np.concatenate([pooled, share[:, None].astype(np.float32)], axis=1)
    starts = np.cumsum(chunks) - chunks
    return np.concatenate([np.maximum.reduceat(channel, starts, axis=0),
                           np.add.reduceat(channel, starts, axis=0) / chunks[:, None]], axis=1)


def probabilities(model: Model, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(offsets) - 1, model.constant)
    logit = features(model, raw, offsets).astype(np.float64) @ model.dense + model.shift
    return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def sample_chunks(raw: np.ndarray, chunks: int) -> np.ndarray:
    """At most ``chunks`` evenly spread chunks of one document (short documents:
    what there is, zero-padded)."""
    count = min(chunks, max(1, -(-len(raw) // CHUNK)))
    at = np.linspace(0, max(0, len(raw) - CHUNK), count).astype(np.int64)
    out = np.zeros((count, CHUNK), np.uint8)
    for k, a in enumerate(at):
        part = raw[a:a + CHUNK]
        out[k, :len(part)] = part
    return out


def train(samples: list[tuple[bytes, int]], prior: float, seed: int = 7, epochs: int = 14, batch: int = 48) -> Model:
    """Fit the network to (chunks, label) samples with Adam."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32)
    embed[0] = 0
    filters = rng.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH, FILTERS)).astype(np.float32)
    bias = np.zeros(FILTERS, np.float32)
    dense = rng.normal(0, 0.1, 2 * (FILTERS + 1)).astype(np.float64)
    offset = np.zeros(1)
    params = [embed, filters, bias, dense, offset]
    moments = [(np.zeros_like(p, np.float64), np.zeros_like(p, np.float64)) for p in params]
    docs = [np.frombuffer(b, np.uint8).reshape(-1, CHUNK) for b, _ in samples]
    labels = np.array([y for _, y in samples], np.float64)
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    shares = [np.array([REPEAT_SCALE * repeats(c).sum() / max(1, np.count_nonzero(c)) for c in d]) for d in docs]
    places = (CHUNK - WIDTH) // STEP + 1
    windows = np.arange(places)[:, None] * STEP + np.arange(WIDTH)
    t = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        for start in range(0, len(docs), batch):
            if start == 0:
                order = rng.permutation(len(docs))
            some = order[start:start + batch]
            data = np.concatenate([docs[i] for i in some])
            sizes = np.array([len(docs[i]) for i in some])
            starts = np.cumsum(sizes) - sizes
            seen = data[:, windows]                                       # chunk, place, WIDTH
            x = embed[seen].reshape(len(data), places, WIDTH * DEPTH)
            y = x @ filters
            best = y.argmax(axis=1)                                       # chunk, filter
            top = np.take_along_axis(y, best[:, None], axis=1)[:, 0] + bias
            pooled = np.maximum(top, 0)
            channel = np.concatenate([pooled, np.concatenate([shares[i] for i in some])[:, None]], axis=1)
            row = np.repeat(np.arange(len(some)), sizes)
            peak = np.maximum.reduceat(channel, starts, axis=0)
            mean = np.add.reduceat(channel, starts, axis=0) / sizes[:, None]
            f = np.concatenate([peak, mean], axis=1)
            p = 1 / (1 + np.exp(-np.clip(f @ dense + offset[0], -30, 30)))
            g = (p - labels[some]) * weight[some] / len(some)
            wide = FILTERS + 1
            is_peak = channel == peak[row]
            is_peak = is_peak / np.add.reduceat(is_peak, starts, axis=0)[row]
            dc = g[row, None] * (dense[:wide] * is_peak + dense[wide:] / sizes[row, None])
            dt = dc[:, :FILTERS] * (top > 0)
            each = np.arange(len(data))[:, None]
            win = x[each, best]                                           # chunk, filter, WIDTH * DEPTH
            d_filters = np.einsum("cf,cfk->kf", dt, win)
            d_x = (dt[:, :, None] * filters.T[None]).reshape(-1, DEPTH)
            d_embed = np.zeros(embed.shape)
            np.add.at(d_embed, seen[each, best].reshape(-1), d_x)
            d_embed[0] = 0
            grads = [d_embed, d_filters, dt.sum(axis=0), f.T @ g + 1e-4 * dense, np.array([g.sum()])]
            t += 1
            for param, grad, (m, v) in zip(params, grads, moments):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                param -= (rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(param.dtype)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    return Model(embed, filters, bias, dense, float(offset[0] + np.log(prior / (1 - prior))))


def _sample(chunks: int):
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                raw, at = utf8_buffer(part, "text")
                yield pa.RecordBatch.from_arrays([
                    pa.array([sample_chunks(raw[a:b], chunks).tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    part.column("label")], ["chunks", "label"])
    return run


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 1500, chunks: int = 6,
        doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """The network fitted to at most ``sample_rows`` labelled rows a class, of
    each at most ``chunks`` chunks spread over the whole text."""
    known = pick(labels, doc_id=doc_id, label=label).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").select("doc_id", "label")
    ratio = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}     # two rows at most
    total = sum(ratio.values())
    if len(ratio) < 2:
        return Model(*[np.zeros(0)] * 4, 0.0, constant=ratio.get(1, 0) / total if total else 0.5)
    ids = None
    for y in (0, 1):
        some = known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(sample_rows)
        ids = some if ids is None else ids.unionByName(some)
    # 2 * sample_rows ids: bounded, so they may be broadcast and their chunks collected
    rows = pick(docs, doc_id=doc_id, text=text).join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(
        F.min_by("text", F.struct(F.md5("text"), F.xxhash64("text"))).alias("text"), F.first("label").alias("label"))
    cut = rows.select("text", F.col("label").cast("int").alias("label")).mapInArrow(
        _sample(chunks), "chunks binary, label int")
    got = sorted((bytes(r["chunks"]), r["label"]) for r in cut.collect())
    if len({y for _, y in got}) < 2:
        return Model(*[np.zeros(0)] * 4, 0.0, constant=ratio[1] / total)
    return train(got, ratio[1] / total)


def _score(model: Model):
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text", 1 << 20):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(probabilities(
                        model, *utf8_buffer(part, "text")))], ["doc_id", "held_out", "score"])
    return run


def score_documents(docs: DataFrame, model: Model, keep_from: float = 0.3, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long")) \
        .withColumn("held_out", held_out())
    scored = rows.mapInArrow(_score(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= keep_from).cast("int"))


def _filter(model: Model, keep_from: float, text: str):
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, text, 1 << 20):
                yield part.filter(pa.array(probabilities(model, *utf8_buffer(part, text)) >= keep_from))
    return run


def keep_good(docs: DataFrame, model: Model, keep_from: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score ``keep_from`` or more."""
    prepare(docs.sparkSession)
    return docs.mapInArrow(_filter(model, keep_from, text), docs.schema)
