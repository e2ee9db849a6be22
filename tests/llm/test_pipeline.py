"""run() against the same stages in plain Python, and the registered queries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from quarry.llm.quality import features, fit_quality
from quarry.llm.queries import QUERIES
from quarry.llm.labelled import crc_mod
from test_decontaminate import plain as plain_contamination
from test_line_dedup import plain as plain_lines
from test_simhash import plain_fingerprint

SF = "/root/testdata/sf0.001"


def plain_run(spark):
    from pyspark.sql import functions as F
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    model = fit_quality(docs, labels, crc_mod(F.col("doc_id"), 3) != 1)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    rows = [r for r in rows if model.score(np.array([features(r[1] or "")]))[0] >= 0.5]
    rows = [(i, t, s) for (i, _, s), t in zip(rows, plain_lines(rows, 5), strict=True)]
    fp = {i: plain_fingerprint(t) for i, t, _ in rows}
    label = {i: i for i in fp}
    changed = True
    while changed:
        changed = False
        for a in fp:
            low = min(label[b] for b in fp if (fp[a] ^ fp[b]).bit_count() <= 4)
            if low < label[a]:
                label[a], changed = low, True
    kept = [(i, t) for i, t, _ in rows if label[i] == i]
    bad = {r[0] for r in plain_contamination(kept, [(r.item_id, r.text) for r in bench.collect()]) if r[5]}
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = []
    for i, t in kept:
        if i not in bad:
            ids = lib.encode(t or "")
            out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                        hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    return out


def test_run_as_plain_python(ckpt):
    got = sorted(map(tuple, corpus_pipeline.run(ckpt, SF).collect()))
    assert got == sorted(plain_run(ckpt))
    assert len(got) > 50


def test_stages_take_odd_rows(ckpt, tmp_path):
    """Nulls in every column, repeated rows, an extra column, no rows at all."""
    rng = random.Random(0)
    text = " ".join(rng.choice(["river", "stone", "cloud", "tree", "walks"]) for _ in range(80))
    rows = [(1, text, "en", "s1", 1, "x"), (1, text, "en", "s1", 1, "x"), (None, text, None, None, None, None),
            (2, None, "en", "s2", None, "x"), (3, "", "en", "s3", 0, "x"), (4, text + " end", "en", "s1", 1, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    for table, rows_, sch in (("labels", [(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int"),
                              ("benchmark", [(1, "a b c"), (None, None)], "item_id long, text string")):
        ckpt.createDataFrame(rows_, sch).write.parquet(str(tmp_path / f"{table}.parquet"))
    for data in (rows, []):
        docs = ckpt.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(ckpt, docs, str(tmp_path))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns and out.count() <= docs.count()
                if name == "simhash near-dedup" and data:
                    assert sorted((r.doc_id for r in out.collect()), key=repr) == [1, 2, None]
            else:
                assert out.count() == docs.count()


# Names that operators and stages use for columns of their own.
TAKEN = ["_text", "_row", "_hash", "_crc", "_id", "_doc", "_lines", "gone", "text_hash", "text_crc", "n_lines",
         "n_removed", "words", "prints", "item", "ids", "grams", "hashes", "fp", "node", "component", "component_id",
         "fingerprint", "score", "y", "place", "line"]


def test_stages_carry_columns_of_any_name(ckpt, tmp_path):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["river", "stone", "cloud", "tree"]) for _ in range(60)) for _ in range(4)]
    rows = [(i, texts[i % 4], "en", f"s{i}", 9, *(i * 7 + j for j in range(len(TAKEN)))) for i in range(8)]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(
        f", `{c}` long" for c in TAKEN)
    ckpt.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    ckpt.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = ckpt.createDataFrame(rows, schema)
    want = {r[0]: r[5:] for r in rows}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(ckpt, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert all(tuple(r[c] for c in TAKEN) == want[r.doc_id] for r in out.collect())
    assert corpus_pipeline.STAGES[-1][1](ckpt, docs, str(tmp_path)).count() == 8


def test_every_operator_is_registered():
    names = entry.queries()
    assert [k for k in names if k.startswith("op")] == list(QUERIES)
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", [q for q in QUERIES if q != "op12_collocations"])
def test_queries_return_a_row_per_input_row(ckpt, name):
    table = {"op5": "embeddings", "op13": "pages"}.get(name.split("_")[0], "documents")
    assert QUERIES[name](ckpt, SF).count() == ckpt.read.parquet(f"{SF}/{table}.parquet").count()
