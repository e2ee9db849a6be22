"""Fill-in-the-middle transformation, cut at line ends by word-parallel marks.

The UTF-8 bytes of a slice of texts are viewed as 64-bit words.  A few integer
operations mark the bytes that end a line in every word; counting the marks of
each word and adding them up answers where the k-th line of any text ends: a
binary search finds the word, a multiplication and a comparison of all its
bytes at once find the byte.  Characters are counted in the same way, from
marks on the bytes that continue one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .tables import batch_of, cut_batches

# The default markers of prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")

ONES = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)


def line_ends(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is a line feed (no carry leaves a byte)."""
    x = words ^ (ONES * np.uint64(0x0A))
    return ~(((x & LOW7) + LOW7) | x | LOW7)


def continuations(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte of the form 10xxxxxx."""
    return words & ~(words << np.uint64(1)) & HIGH


class Marks:
    """Marked bytes of an array of words: how many lie before a byte, and
    where the k-th one is."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks in the bytes before ``at`` (below 8 x words)."""
        word = at >> 3
        below = (np.uint64(1) << ((at & 7) << 3).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte that holds mark number k, counted from 0."""
        word = np.searchsorted(self.before, k, side="right") - 1
        rest = (k - self.before[word] + 1).astype(np.uint64)
        upto = (self.marks[word] >> np.uint64(7)) * ONES  # byte i: marks in the bytes 0 to i
        reached = ((upto | HIGH) - rest * ONES) & HIGH
        return (word << 3) + 8 - np.bitwise_count(reached)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of texts; null is empty.  At least one byte
    follows the last text, and the bytes fill whole words."""
    filled = pc.fill_null(column, "").cast(pa.large_binary())
    if not len(filled):
        return np.zeros(8, np.uint8), np.zeros(1, np.int64)
    _, at, data = filled.buffers()
    offsets = np.frombuffer(at, np.int64, len(filled) + 1, filled.offset * 8)
    first, size = offsets[0], offsets[-1] - offsets[0]
    raw = np.zeros((size // 8 + 1) * 8, np.uint8)
    if size:
        raw[:size] = np.frombuffer(data, np.uint8, size, first)
    return raw, offsets - first


def cut_lines(raw: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n, first, second, prefix_chars, middle_chars) per text: its number of
    lines, the bytes after the smaller and the larger of h1 % (n + 1) and
    h2 % (n + 1) lines, and the characters before and between them."""
    words = raw.view("<u8")
    ends, inner = Marks(line_ends(words)), Marks(continuations(words))
    a, b = offsets[:-1], offsets[1:]
    passed = ends.rank(a)
    closed = ends.rank(b) - passed
    n = closed + ((b > a) & (raw[np.maximum(b - 1, 0)] != 0x0A))

    def after(k: np.ndarray) -> np.ndarray:
        out = np.where(k == 0, a, b)
        at = np.flatnonzero((k > 0) & (k <= closed))
        out[at] = ends.select(passed[at] + k[at] - 1) + 1
        return out

    def chars(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return q - p - (inner.rank(q) - inner.rank(p))

    k1, k2 = h1 % (n + 1), h2 % (n + 1)
    first, second = after(np.minimum(k1, k2)), after(np.maximum(k1, k2))
    return n, first, second, chars(a, first), chars(first, second)


def arranged(form: str, prefix: bytes, middle: bytes, suffix: bytes, markers: Sequence[bytes]) -> bytes:
    p, s, m = markers
    if form == "psm":
        return b"".join((p, prefix, s, suffix, m, middle))
    if form == "spm":
        return b"".join((s, suffix, p, prefix, m, middle))
    return prefix + middle + suffix


def restored(form: str, output: bytes, markers: Sequence[bytes]) -> bytes:
    """The text that ``arranged`` was given, from its output and form alone.  A
    text that holds a marker stays plain, and no marker overlaps another one,
    so the first hit of each marker is the one put in."""
    if form == "plain":
        return output
    p, s, m = markers
    head, second = (p, s) if form == "psm" else (s, p)
    x, _, rest = output.removeprefix(head).partition(second)
    y, _, middle = rest.partition(m)
    prefix, suffix = (x, y) if form == "psm" else (y, x)
    return prefix + middle + suffix


def _draws(ids: list, seed: int) -> np.ndarray:
    """Four 32-bit numbers per id: the first digits of a SHA-256."""
    raw = b"".join(hashlib.sha256(b"%d:%s" % (seed, b"" if i is None else b"%d" % i)).digest()[:16] for i in ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50,
                   markers: Sequence[str] = MARKERS, with_text: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n (lines), form ('plain', 'psm' or 'spm'),
    prefix_chars and middle_chars (null if plain) and the output text, or with
    ``with_text=False`` output_sha256 and restored_sha256 (the latter of the
    text rebuilt from output and form).

    ``rate`` per cent of the texts are cut, ``spm`` per cent of those put the
    suffix first; both draws and both cuts come from a SHA-256 of ``seed`` and
    doc_id, so the result does not depend on the partitions.

    A null text is an empty one; an empty text and one that holds a marker are
    plain.  Lines end after a line feed only.  Very long texts are worked on
    whole, one at a time.  Rows that share a doc_id are each cut by the same
    draws; a null doc_id draws as an empty id.  An empty table gives no rows;
    other columns, whatever their names, are ignored.  Markers must not be
    empty, and must start with '<' and end with '>' with neither inside."""
    marks = [m.encode() for m in markers]
    if len({*marks}) != 3 or not all(len(m) > 2 and m[:1] == b"<" and m[-1:] == b">" and m.count(b"<") == 1
                                     and m.count(b">") == 1 for m in marks):
        raise ValueError("three different markers of the form <...> are needed")
    tail = [("output", pa.string())] if with_text else [("output_sha256", pa.string()),
                                                        ("restored_sha256", pa.string())]
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), *tail])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in cut_batches(batches):
            text = part.column("text")
            raw, offsets = text_bytes(text)
            h = _draws(part.column("doc_id").to_pylist(), seed)
            n, first, second, prefix, middle = cut_lines(raw, offsets, h[:, 0], h[:, 1])
            plain = (offsets[1:] == offsets[:-1]) | (h[:, 2] % 100 >= rate)
            for m in markers:
                plain |= pc.fill_null(pc.match_substring(text, m), False).to_numpy(zero_copy_only=False)
            form = np.where(plain, "plain", np.where(h[:, 3] % 100 < spm, "spm", "psm")).tolist()
            whole = memoryview(raw)
            made: list[list] = [[] for _ in tail]
            for f, a, p, q, b in zip(form, offsets[:-1].tolist(), first.tolist(), second.tolist(),
                                     offsets[1:].tolist(), strict=True):
                out = arranged(f, whole[a:p].tobytes(), whole[p:q].tobytes(), whole[q:b].tobytes(), marks)
                if with_text:
                    made[0].append(out.decode())
                else:
                    made[0].append(hashlib.sha256(out).hexdigest())
                    made[1].append(hashlib.sha256(restored(f, out, marks)).hexdigest())
            yield batch_of(schema, [part.column("doc_id"), n, form, pa.array(prefix, mask=plain),
                                    pa.array(middle, mask=plain), *made])

    ddl = "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
    return docs.select("doc_id", "text").mapInArrow(run, ddl + ", ".join(f"{name} string" for name, _ in tail))


def restore_documents(made: DataFrame, markers: Sequence[str] = MARKERS) -> DataFrame:
    """(doc_id, text) of the rows of ``fill_in_middle`` (doc_id, form, output).
    A null output or form gives a null text; other columns are ignored."""
    marks = [m.encode() for m in markers]
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in cut_batches(batches, "output"):
            text = [None if f is None or o is None else restored(f, o.encode(), marks).decode()
                    for f, o in zip(part.column("form").to_pylist(), part.column("output").to_pylist(), strict=True)]
            yield batch_of(schema, [part.column("doc_id"), text])

    return made.select("doc_id", "form", "output").mapInArrow(run, "doc_id long, text string")


# The digest of the default parameters, for DuckDB.
DIGEST_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
           FROM documents),
u AS (SELECT *, string_split(x, chr(10)) AS parts,
             len(string_split(x, chr(10))) - (x = '' OR right(x, 1) = chr(10))::BIGINT AS n FROM t),
k AS (SELECT *, least(('0x' || h[1:8])::BIGINT % (n + 1), ('0x' || h[9:16])::BIGINT % (n + 1)) AS k1,
             greatest(('0x' || h[1:8])::BIGINT % (n + 1), ('0x' || h[9:16])::BIGINT % (n + 1)) AS k2,
             x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') AS plain,
             ('0x' || h[25:32])::BIGINT % 100 < 50 AS spm FROM u),
c AS (SELECT *, CASE WHEN k1 = 0 THEN 0 WHEN k1 = n THEN length(x)
                     ELSE length(array_to_string(parts[1:k1], chr(10))) + 1 END AS c1,
             CASE WHEN k2 = 0 THEN 0 WHEN k2 = n THEN length(x)
                  ELSE length(array_to_string(parts[1:k2], chr(10))) + 1 END AS c2 FROM k),
s AS (SELECT *, substr(x, 1, c1) AS p, substr(x, c1 + 1, c2 - c1) AS m, substr(x, c2 + 1) AS s FROM c)
SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN NOT plain THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE WHEN plain THEN x WHEN spm THEN '<S>' || s || '<P>' || p || '<M>' || m
                   ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM s
"""
