import random
import re

import numpy as np
import pytest
import xxhash

from llm_cases import ODD
from quarry.llm.components import components, spanning_edges
from quarry.llm.golay import near_codewords
from quarry.llm.simhash import fingerprint, fuzzy_keys, link_fingerprints, near_duplicates


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(edges, nodes):
    up = {n: n for n in (*nodes, *(x for e in edges for x in e))}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def test_fingerprints():
    random.seed(2)
    for _ in range(50):
        t = " ".join(random.choice(["a", "B", "c\t", "é", "\x0bd", "Zz"]) for _ in range(random.randint(0, 12)))
        assert fingerprint(t) == plain_fingerprint(t)
    for _, t in ODD:
        assert fingerprint(t or "") == plain_fingerprint(t)


def test_codewords_near_words():
    rng = np.random.default_rng(0)
    code = near_codewords(np.arange(1 << 12, dtype=np.int64) << 11)[:, 0]
    assert len(near_codewords(np.arange(1 << 23, dtype=np.int64)[::4097])) > 0
    x = rng.integers(0, 1 << 23, 3000)
    for flips in (0, 1, 2):
        y = x.copy()
        for r in range(len(y)):
            for b in rng.choice(23, flips, replace=False):
                y[r] ^= 1 << int(b)
        a, b = near_codewords(x), near_codewords(y)
        shared = ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any(axis=(1, 2))
        assert shared.all()
    assert len(code) == 4096


def test_keys_of_pairs_within_four_bits():
    rng = random.Random(4)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 4)):
            y ^= 1 << b
        row, key = fuzzy_keys(np.array([x, y], np.uint64))
        assert set(key[row == 0].tolist()) & set(key[row == 1].tolist())


@pytest.mark.parametrize("run_rows", [8192, 20])
def test_links_against_all_pairs(ckpt, run_rows):
    """A crowd of near copies, with keys over and under ``run_rows``."""
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base[:6]:
        for _ in range(60):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 3)):
                x ^= 1 << bit
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in sorted(fps)]
    df = ckpt.createDataFrame([(x,) for x in signed], "fp long")
    got = [(r.u, r.v) for r in link_fingerprints(df, 4, run_rows).collect()]
    want = [(a, b) for i, a in enumerate(signed) for b in signed[:i]
            if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 4]
    assert groups(got, signed) == groups(want, signed)
    with pytest.raises(ValueError):
        link_fingerprints(df, 5)


def test_documents(make_docs):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(50)]
    rows = list(ODD)
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(3, 200))]
        for _ in range(rng.randint(1, 3)):
            rows.append((100 + len(rows), " ".join(base[: len(base) - rng.randint(0, 1)])))
    got = near_duplicates(make_docs(rows, extra=["fp", "fingerprint", "component_id"])).collect()
    assert len(got) == len(rows)
    fp = {i: plain_fingerprint(t) for i, t in rows}
    edges = [(a, b) for a in fp for b in fp if a is not None and b is not None and a < b
             and (fp[a] ^ fp[b]).bit_count() <= 4]
    want = groups(edges, [i for i in fp if i is not None])
    for r in got:
        assert r.fingerprint == f"{fp[r.doc_id]:016x}"
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None else None)


def test_empty(make_docs):
    assert near_duplicates(make_docs([])).collect() == []


def test_components(ckpt):
    rng = random.Random(3)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(200, 260)]
    odd = [(5, 5), (7, 6), (6, 7), (6, 7)]
    loose = [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    edges = path + star + odd + loose
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(ckpt.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == groups(edges, nodes)
    u, v = spanning_edges(np.array([a for a, _ in edges]), np.array([b for _, b in edges]))
    assert groups(list(zip(u.tolist(), v.tolist())), nodes) == groups(edges, nodes)
    assert len(u) < len(nodes)
    assert components(ckpt.createDataFrame([], "u long, v long")).collect() == []
