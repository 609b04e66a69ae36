"""Exact token counts without materialising token ids.

No vocabulary piece runs across the border in front of a space run, so a text
falls apart into independent pre-tokens (a space run and the characters up to
the next one).  The operator joins the per-document pre-token frequencies to
the piece counts of the distinct pre-tokens and sums them.

* A block is a run of consecutive rows of at most ``block_bytes`` of text
  within one input task.  Its frequencies are packed by cells: a row holds the
  block's pre-tokens of one cell with their documents' places and frequencies.
  A cell is a hash of the pre-token, so a distinct pre-token lives in one cell
  and its pieces are counted once, next to the frequencies it is joined to.
* Pre-tokens found in many documents of a block are dealt over all cells by
  block instead, so no cell gathers the frequent ones.
* Each task hands back, per block, the documents' partial sums; they meet by
  block.  More cells than tasks keep the dealing even; raise ``cells`` for
  more than that many parallel tasks.

Defined results: null or empty text has 0 bytes and 0 tokens; repeated rows
give one row each; a null ``doc_id`` is kept; an empty table gives an empty
result; very long texts form a block of their own; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, pick, prepare

SPACE = "▁"
_RUN = re.compile(" +[^ ]*")
#: A block's number: task, then block in the task.  Most rows of a block.
BLOCK_BITS, MOST_ROWS = 20, 65_535
#: A task remembers that many pre-tokens, and holds that many partial sums.
MEMO, MOST_HELD = 500_000, 4_000_000


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of ``text`` behind its dummy leading space, each without
    the first space of its run."""
    if not text:
        return []
    text = text.replace(SPACE, " ")
    if "  " not in text and text[0] != " ":
        return text.split(" ")
    return [run[1:] for run in _RUN.findall(" " + text)]


@lru_cache(maxsize=2)
def load_processor(model_file: str):
    """The library's processor, for models whose pre-tokens are independent:
    spaces kept and escaped, a dummy leading space, no piece with a space
    behind another character."""
    import sentencepiece
    processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
    if processor.encode("a  b", out_type=str) != processor.encode(" b", out_type=str)[:0] + \
            processor.encode("a", out_type=str) + processor.encode(" b", out_type=str):
        raise ValueError("the model does not keep spaces behind a dummy leading space")
    for i in range(processor.get_piece_size()):
        if SPACE in processor.id_to_piece(i).lstrip(SPACE):
            raise ValueError("pre-tokens are not independent: a piece has a space inside")
    return processor


def _words(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens of a batch's texts and the row each one is in."""
    texts = pa.compute.fill_null(part.column("text"), "")
    texts = pa.compute.replace_substring(texts, SPACE, " ")
    odd = np.asarray(pa.compute.or_(pa.compute.match_substring(texts, "  "), pa.compute.starts_with(texts, " ")))
    empty = np.asarray(pa.compute.equal(texts, ""))
    plain = np.flatnonzero(~odd & ~empty)
    lists = pa.compute.split_pattern(texts.take(pa.array(plain)), " ")
    rows = [np.repeat(plain, np.asarray(pa.compute.list_value_length(lists)))]
    words = [pa.compute.list_flatten(lists).cast(pa.string())]
    for i in np.flatnonzero(odd):
        own = pre_tokens(texts[int(i)].as_py())
        rows.append(np.full(len(own), i))
        words.append(pa.array(own, pa.string()))
    return pa.chunked_array(words).combine_chunks(), np.concatenate(rows)


_PACKED = pa.schema([("cell", pa.int32()), ("block", pa.int64()), ("tokens", pa.string()), ("each", pa.binary()),
                     ("places", pa.binary()), ("counts", pa.binary()), ("ids", pa.list_(pa.int64())),
                     ("sizes", pa.list_(pa.int64()))])


def _pack(cells: int, block_bytes: int):
    def run(batches):
        block = TaskContext.get().partitionId() << BLOCK_BITS
        for batch in batches:
            for some in byte_slices(batch, "text", block_bytes):
                for at in range(0, some.num_rows, MOST_ROWS):
                    yield from _pack_block(some.slice(at, MOST_ROWS), block, cells)
                    block += 1
    return run


def _pack_block(part: pa.RecordBatch, block: int, cells: int):
    n = part.num_rows
    sizes = pa.compute.fill_null(pa.compute.binary_length(part.column("text")), 0).cast(pa.int64())
    yield pa.RecordBatch.from_pylist([{
        "cell": block % cells, "block": block, "tokens": None, "ids": part.column("doc_id").to_pylist(),
        "sizes": sizes.to_pylist()}], schema=_PACKED)
    words, row = _words(part)
    if not len(words):
        return
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    key, freq = np.unique(code * n + row, return_counts=True)
    code, place = np.divmod(key, n)
    tokens = coded.dictionary.to_pylist()
    cell = np.array([zlib.crc32(t.encode()) for t in tokens], np.int64)
    spread = np.bincount(code, minlength=len(tokens)) * 16 > n
    spread &= n >= 64
    cell = (cell + np.where(spread, block, 0)) % cells
    order = np.argsort(cell, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    by = np.argsort(rank[code], kind="stable")
    place, freq = place[by].astype("<u2"), freq[by].astype("<u4")
    each = np.bincount(rank[code], minlength=len(tokens))
    ends = np.append(0, np.cumsum(each))
    cuts = np.append(np.flatnonzero(np.diff(cell[order], prepend=-1)), len(order))
    out = {name: [] for name in ("cell", "tokens", "each", "places", "counts")}
    for a, b in zip(cuts[:-1], cuts[1:]):
        out["cell"].append(int(cell[order[a]]))
        out["tokens"].append(SPACE.join([tokens[i] for i in order[a:b]]))
        out["each"].append(each[a:b].astype("<u2").tobytes())
        out["places"].append(place[ends[a]:ends[b]].tobytes())
        out["counts"].append(freq[ends[a]:ends[b]].tobytes())
    k = len(out["cell"])
    yield pa.RecordBatch.from_arrays([
        pa.array(out["cell"], pa.int32()), pa.array(np.full(k, block, np.int64)), pa.array(out["tokens"], pa.string()),
        pa.array(out["each"], pa.binary()), pa.array(out["places"], pa.binary()), pa.array(out["counts"], pa.binary()),
        pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.list_(pa.int64()))], schema=_PACKED)


def _join_counts(model_file: str):
    """Within a task's cells: count each distinct pre-token's pieces, join
    them to the frequencies, sum by document (places within a block are distinct)."""
    schema = pa.schema([("block", pa.int64()), ("places", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int64())),
                        ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))])

    def run(batches):
        processor = load_processor(model_file)
        lone = 1 if processor.piece_to_id(SPACE) != processor.unk_id() else len(SPACE.encode())
        pieces: dict[str, int] = {"": lone}
        sums: dict[int, np.ndarray] = {}
        held = 0

        def flush():
            for block, total in sums.items():
                places = np.flatnonzero(total)
                yield {"block": block, "places": places.tolist(), "tokens": total[places].tolist(),
                       "ids": [], "sizes": []}

        for batch in batches:
            done = []
            for row in batch.to_pylist():
                block = row["block"]
                if row["tokens"] is None:
                    n = len(row["ids"])
                    done.append({"block": block, "places": list(range(n)), "tokens": [0] * n,
                                 "ids": row["ids"], "sizes": row["sizes"]})
                    continue
                tokens = row["tokens"].split(SPACE)
                new = [t for t in tokens if t not in pieces]
                if len(pieces) + len(new) > MEMO:
                    pieces = {"": lone}
                    new = tokens
                pieces.update(zip(new, map(len, processor.encode(new, num_threads=1))))
                pieces[""] = lone
                each = np.array([pieces[t] for t in tokens], np.int64)
                weight = np.repeat(each, np.frombuffer(row["each"], "<u2")) * np.frombuffer(row["counts"], "<u4")
                part = np.bincount(np.frombuffer(row["places"], "<u2"), weight).astype(np.int64)
                old = sums.get(block)
                if old is None or len(old) < len(part):
                    held += len(part) - (0 if old is None else len(old))
                    if old is not None:
                        part[:len(old)] += old
                    sums[block] = part
                else:
                    old[:len(part)] += part
            if held > MOST_HELD:
                done += flush()
                sums.clear()
                held = 0
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        rest = list(flush())
        if rest:
            yield pa.RecordBatch.from_pylist(rest, schema=schema)
    return run


def _sum_blocks(batches):
    """One row per document from all partial sums of the task's blocks."""
    sums: dict[int, np.ndarray] = {}
    known: dict[int, tuple] = {}
    for batch in batches:
        for block, places, tokens, ids, sizes in zip(*(batch.column(c) for c in (
                "block", "places", "tokens", "ids", "sizes"))):
            block = block.as_py()
            if len(ids):
                known[block] = ids.values, sizes.values
            places, tokens = places.values.to_numpy(), tokens.values.to_numpy()
            total = sums.setdefault(block, np.zeros(MOST_ROWS + 1, np.int64) if len(places) else np.zeros(0, np.int64))
            total[places] += tokens
            if len(ids):
                sums[block] = total[:len(ids)].copy()
            elif block in known and len(total) > len(known[block][0]):
                sums[block] = total[:len(known[block][0])].copy()
    for block, (ids, sizes) in known.items():
        yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), sizes, pa.array(sums[block])],
                                         ["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, block_bytes: int = 16 << 20,
                 cells: int = 4096, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of
    every row; begin, end and added special tokens are not counted."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    packed = rows.mapInArrow(
        _pack(cells, block_bytes), "cell int, block long, tokens string, each binary, places binary, counts binary, "
        "ids array<long>, sizes array<long>")
    sums = packed.repartition("cell").mapInArrow(
        _join_counts(model_file), "block long, places array<int>, tokens array<long>, ids array<long>, "
        "sizes array<long>")
    return sums.repartition("block").mapInArrow(_sum_blocks, "doc_id long, n_bytes long, n_tokens long") \
        .withColumn("over_limit", F.col("n_tokens") > limit)
