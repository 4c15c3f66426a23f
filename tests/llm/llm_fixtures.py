import os

import pytest

ROWS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """documents from (doc_id, text) pairs, with two further columns of clashing names."""
    def make(rows, lang="en"):
        full = [(i, t, lang, "s", None if t is None else len(t), "x", 1) for i, t in rows]
        return spark.createDataFrame(full, ROWS + ", kept string, fingerprint long")
    return make


@pytest.fixture()
def table_dir(tmp_dir):
    """Write frames as <name>.parquet in one folder; returns the folder."""
    def make(**frames):
        for name, frame in frames.items():
            frame.write.mode("overwrite").parquet(os.path.join(tmp_dir, f"{name}.parquet"))
        return tmp_dir
    return make
