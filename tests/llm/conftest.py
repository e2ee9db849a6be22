import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture(scope="session")
def ckpt(spark, tmp_path_factory):
    """A checkpoint folder of the test run where the session names none."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return spark


DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(ckpt):
    def make(rows, extra=None):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in
                ((*r, "s0") if len(r) == 2 else r for r in rows)]
        df = ckpt.createDataFrame(full, DOC)
        if extra:
            from pyspark.sql import functions as F
            for name in extra:
                df = df.withColumn(name, F.lit("x"))
        return df
    return make
