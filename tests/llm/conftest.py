import pytest

DOC = "doc_id LONG, text STRING, lang STRING, source STRING"


@pytest.fixture(scope="session")
def docs(spark):
    def make(rows, schema=DOC):
        """rows: (id, text) or longer tuples."""
        width = len(schema.split(","))
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)

    return make


ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "word"), (5, "word"), (None, "word one two"), (6, "x" * 3000 + " é日本 👩‍👩"), (6, "twice the same id"), (7, "\n\n\n"), (8, "A b C d E f\nA b C d E f\n" * 40)]


@pytest.fixture(scope="session")
def odd(docs):
    """Nulls, empty and long texts, repeats, null ids; further columns with clashing names."""
    from pyspark.sql import functions as F

    base = docs(ODD)
    clash = ["n", "doc", "pos", "rk", "token", "g", "size", "row", "keep", "id", "vec", "shard", "ids", "part", "target", "w", "c", "k1", "root"]
    return base.select("*", *[F.lit(f"x{c}").alias(c) for c in clash])
