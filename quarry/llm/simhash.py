"""Near duplicates by SimHash fingerprints, found with Golay-code fuzzy keys.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each read as
a 23-bit word.  Words at most 2 bits apart share a codeword within 4 bits of
both (``golay.near_codewords``, 1 or 6 codewords a word).  With at most 4
differing bits over three segments, either no segment has more than 2, or one
has 3 or 4 and of the other two one has none and the other at most one.  So
linked fingerprints always share a key of one of these kinds:

* a codeword of each segment (36 bits, kind 0);
* all bits of one segment and a codeword of another (33 or 34 bits, kinds 1-6).

Keys of distinct fingerprints are dealt by key; fingerprints that meet under a
key are compared bit by bit, and only a spanning set of the links goes on, so
a group of near copies never becomes all its pairs.  A key with more than
``run_rows`` fingerprints is cut into blocks, and each pair of blocks is
compared by a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, spanning_edges
from .golay import near_codewords
from .tables import batch_of, text_slices, written

SEED = 42
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # (lowest bit, bits)
# distance that the keys above guarantee
MAX_BITS = 4
_WHITE = dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")
_FOLD = {**_WHITE, **{u: u + 32 for u in range(ord("A"), ord("Z") + 1)}}


def fingerprint(text: str, shingle: int = 4) -> int:
    """SimHash of one text: lower-case A-Z, words between white space (space
    and U+0009 to U+000D), XXH64 (seed 42) of each space-joined shingle,
    repeats included; a bit is set if more than half of the hashes have it.
    Fewer words than a shingle are one shingle; no word gives 0."""
    words = [w for w in text.translate(_FOLD).encode().split(b" ") if w]
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    size = min(shingle, n)
    starts = np.concatenate([[0], ends])[: n - size + 1].tolist()
    stops = (ends[size - 1:] - 1).tolist()
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    hashes = np.fromiter((digest(view[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield batch_of(schema, [part.column("doc_id"), pa.array(fps)])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key of the fingerprints (uint64)."""
    parts = [((fps >> np.uint64(low)) & np.uint64((1 << bits) - 1)).astype(np.int64) for low, bits in SEGMENTS]
    near = [near_codewords(p) for p in parts]
    rows, keys = [], []

    def emit(kind: int, value: np.ndarray, real: np.ndarray) -> None:
        row = np.nonzero(real)[0]
        rows.append(row)
        keys.append((np.int64(kind) << 60) | value[real])

    a, b, c = near
    all_three = (a[:, :, None, None] << 24) | (b[:, None, :, None] << 12) | c[:, None, None, :]
    emit(0, all_three, (a[:, :, None, None] >= 0) & (b[:, None, :, None] >= 0) & (c[:, None, None, :] >= 0))
    kind = 1
    for i in range(3):
        for j in range(3):
            if i != j:
                emit(kind, (parts[i][:, None] << 12) | near[j], near[j] >= 0)
                kind += 1
    return np.concatenate(rows), np.concatenate(keys)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 2048):
            part = fps[at:at + 2048]
            row, key = fuzzy_keys(part.view(np.uint64))
            yield batch_of(schema, [pa.array(key), pa.array(part[row])])


def _links_of_run(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the fingerprints that share a key, all compared."""
    x, step, found = fps.view(np.uint64), 1024, []
    for i in range(0, len(x), step):
        for j in range(i, len(x), step):
            near = np.bitwise_count(x[i:i + step, None] ^ x[None, j:j + step]) <= bits
            p, q = np.nonzero(near)
            keep = p + i < q + j
            if keep.any():
                found.append(spanning_edges(fps[i + p[keep]], fps[j + q[keep]]))
    if not found:
        return fps[:0], fps[:0]
    return spanning_edges(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


def _links(bits: int, run_rows: int | None):
    """mapInArrow over rows sorted by (key, fp): kind 0 rows are links (a, b),
    kind 1 rows are (key, fp) of keys with more than ``run_rows`` rows."""
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])

    def rows(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return batch_of(schema, [pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)])

    def closed(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Links of complete runs of equal keys."""
        edge = np.nonzero(key[1:] != key[:-1])[0] + 1
        start = np.concatenate([[0], edge])
        size = np.diff(np.concatenate([start, [len(key)]]))
        us, vs = [], []
        # short runs: all rows compared with the one 1, 2, ... places on
        short = np.repeat(size <= 16, size)
        for o in range(1, int(min(16, size.max(initial=1)))):
            i = np.nonzero((key[o:] == key[:-o]) & short[o:])[0]
            i = i[np.bitwise_count(fp[i].view(np.uint64) ^ fp[i + o].view(np.uint64)) <= bits]
            us.append(fp[i])
            vs.append(fp[i + o])
        for s, n in zip(start[size > 16].tolist(), size[size > 16].tolist(), strict=True):
            u, v = _links_of_run(fp[s:s + n], bits)
            us.append(u)
            vs.append(v)
        if us:
            u, v = spanning_edges(np.concatenate(us), np.concatenate(vs))
            if len(u):
                yield rows(0, u, v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = fp = np.empty(0, np.int64)
        large = None  # the key of a run that is handed on
        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column("fp").to_numpy(zero_copy_only=False)])
            if large is not None:
                n = int(np.searchsorted(key != large, True))
                if n:
                    yield rows(1, key[:n], fp[:n])
                key, fp = key[n:], fp[n:]
                if not len(key):
                    continue
                large = None
            last = int(np.nonzero(key != key[-1])[0][-1]) + 1 if key[0] != key[-1] else 0
            if last:
                yield from closed(key[:last], fp[:last])
                key, fp = key[last:], fp[last:]
            if run_rows is not None and len(key) > run_rows:
                large = key[0]
                yield rows(1, key, fp)
                key, fp = key[:0], fp[:0]
        if len(key):
            yield from closed(key, fp)

    return run


def link_fingerprints(fps: DataFrame, bits: int = 4, run_rows: int = 8192) -> DataFrame:
    """Distinct (fp) -> spanning links (u, v) of all pairs within ``bits``."""
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"the keys find pairs of at most {MAX_BITS} differing bits")
    out = "kind int, a long, b long"
    keys = fps.select("fp").mapInArrow(_key_rows, "key long, fp long")
    first = written(keys.repartition("key").sortWithinPartitions("key", "fp")
                    .mapInArrow(_links(bits, run_rows), out), "links")
    links = first.where("kind = 0").select("a", "b")
    large = first.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    counts = written(large.groupBy("key").agg(F.count("*").alias("n")), "large")
    if not counts.isEmpty():
        # each pair of blocks of a large key is a key of its own
        blocks = F.ceil(F.col("n") * 2 / F.lit(run_rows)).cast("int")
        block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        pairs = (large.join(counts, "key").withColumn("blocks", blocks).withColumn("block", block)
                 .select("key", "fp", "block", other.alias("other"))
                 .select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "fp"))
        links = links.unionByName(
            pairs.repartition("key").sortWithinPartitions("key", "fp")
            .mapInArrow(_links(bits, None), out).select("a", "b"))
    return links.select(F.col("a").alias("u"), F.col("b").alias("v"))


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4, run_rows: int = 8192) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id
    (smallest doc_id that links of at most ``bits`` differing bits reach).

    Texts without a word, null ones included, have fingerprint 0, which links
    like any other.  Rows with equal fingerprints are one node however many
    they are.  Rows with a null doc_id get the component of the others (null
    if there is none); repeated rows get a row each; an empty table gives no
    rows; other columns are ignored."""
    fps = written(fingerprints(docs, shingle), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    comp = components(link_fingerprints(nodes, bits, run_rows))
    placed = nodes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = written(placed.join(smallest, "component").select("fp", "component_id"), "placed")
    return fps.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
