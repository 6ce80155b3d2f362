import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, lang[, source]]) as a documents table."""
    def build(*rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture
def clashing():
    """The same rows with extra columns named like the operators' own."""
    def add(docs):
        names = ["row", "w", "wh", "h", "size", "taken", "print", "spans", "sha", "t", "d", "tie", "_key", "kept", "words", "path", "id"]
        return docs.select("*", *[F.lit(f"x{n}").alias(n) for n in names])

    return add


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables to a folder as the driver lays them out."""
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
