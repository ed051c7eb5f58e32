import pytest
from pyspark.sql import Row
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text[, source])."""

    def made(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return made


@pytest.fixture(scope="session")
def sf_dir(spark, documents, tmp_path_factory):
    """Writes a folder of documents and labels, for registered queries."""

    def made(rows, labels=()):
        root = tmp_path_factory.mktemp("sf")
        documents(rows).write.parquet(str(root / "documents.parquet"))
        spark.createDataFrame([Row(doc_id=d, quality=1, toxic=t) for d, t in labels], "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
        return f"file://{root}"

    return made


@pytest.fixture(scope="session")
def corpus():
    """The texts of the smallest test table, by id."""
    import duckdb

    return dict(duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall())
