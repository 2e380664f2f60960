from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text), with columns whose names an operator might use itself."""

    def make(rows, split: int = 3):
        full = [(i, t, "en", f"src{(i or 0) % 2}", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(full, SCHEMA)
        extra = {c: df["lang"] for c in ("row", "key", "kind", "band", "component", "batch", "spans", "items", "size", "host", "path", "kept")}
        return df.withColumns(extra).repartition(split)

    return make


@pytest.fixture
def table(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture
def odd_texts():
    """Null, empty, blank, very long, repeated and non-ASCII texts."""
    long = " ".join(f"word{i % 977} tail{i % 31}" for i in range(60_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, "same text here, twice"), (6, "same text here, twice"), (7, "żółć 漢字 é"), (8, "a"), (None, "no id")]
