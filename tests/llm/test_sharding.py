import random
import zlib
from collections import Counter

from corpus_helpers import empty, rows, table
from ledgerloom.llm.sharding import difference, shard_documents


def test_differencing_is_a_partition_and_tighter_than_greedy():
    rng = random.Random(1)
    weights = [rng.randint(1, 10_000) for _ in range(400)]
    shard = [s[0] for s in difference([[w] for w in weights], 7)]
    sums = Counter()
    for w, s in zip(weights, shard):
        sums[s] += w
    greedy = [0] * 7
    for w in sorted(weights, reverse=True):
        greedy[greedy.index(min(greedy))] += w
    assert set(shard) <= set(range(7))
    assert max(sums.values()) - min(sums.values()) <= max(greedy) - min(greedy)


def test_partial_partitions_keep_their_slots_apart():
    maps = difference([[5, 1, 0], [4, 4, 4], [9, 0, 3]], 3)
    assert all(sorted(m) == [0, 1, 2] for m in maps)
    assert difference([[1, 2]], 2) == [[1, 0]] and difference([], 3) == []


def test_every_row_placed_groups_whole_slots_gapless(spark):
    got = shard_documents(table(spark), n_shards=4, block_groups=3, fan_in=2).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    text = {r[0]: r[1] or "" for r in rows()}
    homes = {}
    for r in got:
        assert r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        assert r.law == "bytes" and r.grown_shard is None
        homes.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in homes.values())
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_empty_table(spark):
    assert shard_documents(empty(spark)).collect() == []


def test_near_equal_bytes_on_the_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sums = [r[1] for r in shard_documents(docs, block_groups=40, fan_in=3).groupBy("shard").sum("size").collect()]
    largest = docs.selectExpr("max(octet_length(text)) + 1").first()[0]
    assert len(sums) == 16 and max(sums) - min(sums) <= largest
