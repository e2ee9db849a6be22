import zlib
from collections import defaultdict

import numpy as np

from llm_cases import ODD
from quarry.llm.sharding import difference, shard_documents


def loads(sizes, place, k):
    return np.bincount(place, sizes, minlength=k)


def test_two_way_matches_hand_example():
    # 8 7 6 5 4: differences 1, 1, 4 -> 3, 1 -> 2
    s = np.array([8, 7, 6, 5, 4])
    a = loads(s, difference(s, 2), 2)
    assert abs(a[0] - a[1]) == 2


def test_plain_merging_of_sums_gives_the_same_loads():
    rng = np.random.default_rng(1)
    for k in (2, 3, 7):
        s = rng.integers(1, 10_000, 60)
        parts = [[int(x)] + [0] * (k - 1) for x in s]
        while len(parts) > 1:  # straight from the definition
            parts.sort(key=lambda p: -(max(p) - min(p)))
            a, b = sorted(parts[0], reverse=True), sorted(parts[1])
            parts = [[x + y for x, y in zip(a, b)]] + parts[2:]
        got = sorted(loads(s, difference(s, k), k))
        assert sum(got) == s.sum()
        assert got[-1] - got[0] <= 2 * (max(parts[0]) - min(parts[0])) + 5


def test_tighter_than_greedy():
    s = np.random.default_rng(3).lognormal(7, 1, 3000).astype(np.int64)
    got = loads(s, difference(s, 24), 24)
    assert got.max() - got.min() <= 50


def check(rows, shards):
    by_text, slots, size = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        size[r.shard] += r["size"]
        by_text[(r.text_crc32, r["size"])].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in by_text.values())
    return [size[i] for i in range(shards)]


def test_documents(make_docs):
    rows = shard_documents(make_docs(ODD, extra=["shard", "slot", "size", "item"]), 3).collect()
    assert len(rows) == len(ODD)
    check(rows, 3)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1]["size"] == 8 and by_id[1].text_crc32 == 0 and by_id[1].shard == by_id[2].shard
    assert by_id[6]["size"] == 8 + len("café 日本 😀 ﬁ".encode())
    assert by_id[6].text_crc32 == zlib.crc32("café 日本 😀 ﬁ".encode())
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_blocks_bundles_and_levels(make_docs):
    rng = np.random.default_rng(5)
    docs = [(i, f"{i} " + "y" * int(n)) for i, n in enumerate(rng.integers(1, 400, 3000))]
    docs += [(10_000 + i, "copy " * 40) for i in range(1000)]  # a hot group, larger than a shard
    rows = shard_documents(make_docs(docs), 4, bundles_per_shard=16, block_rows=64, final_rows=256).collect()
    size = sorted(check(rows, 4))
    assert len(rows) == 4000
    # the group fills one shard well or the others share the rest evenly
    assert size[2] - size[0] <= 0.01 * sum(size)


def test_few_final_rows_make_larger_bundles(make_docs):
    rows = shard_documents(make_docs([(i, f"{i} " * (1 + i % 7)) for i in range(300)]), 3,
                           bundles_per_shard=64, block_rows=40, final_rows=24).collect()
    assert len(rows) == 300
    size = check(rows, 3)
    assert max(size) - min(size) <= 0.2 * sum(size)


def test_empty(make_docs):
    assert shard_documents(make_docs([]), 4).collect() == []
