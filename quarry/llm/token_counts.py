"""Token counts with a whole-token shortcut.

A vocabulary string is a *whole token* if, encoded as a pre-token of its own,
it comes out as that one token.  The set is proved once, offline, by encoding
every vocabulary string that can be a pre-token; a pre-token in the set counts
1 by a set lookup.  Only the rest is merged, each distinct one once per slice.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import SPACE, piece_model
from .tables import batch_of, text_slices

# Counts of merged pre-tokens a worker remembers between slices; beyond that
# they are merged again, so this bounds memory and changes no result.
REMEMBERED = 200_000


@functools.lru_cache(maxsize=4)
def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings that encode alone as one token."""
    model = piece_model(path)
    able = [p for p in model.ids if p.startswith(SPACE) and model.words(p[1:].replace(SPACE, " ")) in ([p], [])]
    return frozenset(p for p, ids in zip(able, model.library_ids(able), strict=True) if ids == [model.ids[p]])


def count_words(path: str, texts: list[str], known: dict[str, int]) -> list[int]:
    """Tokens of each text; ``known`` remembers merged pre-tokens."""
    model, whole = piece_model(path), whole_tokens(path)
    split = [model.words(t) for t in texts]
    rest = set()
    for words in split:
        rest.update(words)
    rest -= whole
    new = [w for w in rest if w not in known]
    counts = dict(zip(new, map(len, model.library_ids(new)), strict=True))
    counts.update((w, known[w]) for w in rest if w in known)
    free = REMEMBERED - len(known)
    if free > 0:
        known.update((w, counts[w]) for w in new[:free])
    # one per pre-token, and what a merged one has beyond that
    more = {w: c - 1 for w, c in counts.items() if c != 1}
    return [len(words) + sum(more[w] for w in words if w in more) for words in split]


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    ``path`` is a SentencePiece BPE model with byte fallback and without text
    normalisation, readable on every executor.  A null or empty text has no
    bytes and no tokens.  Repeated rows are counted each; a null doc_id is
    kept; an empty table gives no rows; other columns are ignored."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                        ("over_limit", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for part, texts in text_slices(batches):
            counts = count_words(path, texts, known)
            yield batch_of(schema, [part.column("doc_id"), [len(t.encode()) for t in texts], counts,
                                    [c > limit for c in counts]])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
