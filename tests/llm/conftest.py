import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"w{i * 7919 % 1000}" for i in range(40_000))
COPY = "one passage of twelve words that several texts of this table hold in full " * 3


@pytest.fixture(scope="session")
def small(spark, sf):
    """The smallest table with edge cases: nulls, empty and very long texts, copies, repeated rows, clashing names."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = [
        (None, "a text without an id " * 6), (None, None), (9000, None), (9001, ""), (9002, " \n\t "), (9003, LONG),
        (9004, COPY), (9005, COPY), (9006, COPY), (9006, COPY), (9007, COPY + "and a little more of it than before"),
        (9008, "x"), (9009, "x"), (9008, "another text under an id that comes twice " * 4), (9010, "Ünï cödé tëxt ﷽ 𝔘 " * 30),
        (9011, LONG + " end"), (9012, "first line of it is long enough\nx\n\nfirst line of it is long enouph\nx"),
        (9013, "first line of it is long enoug\nlast"), (9014, "a@b.c@d.e call +1 (555) 123-4567 or 4111 1111 1111 1111 at 1.2.3.4.5.6.7.256"),
        (9015, " ".join(["rep rep rep"] * 40)), (9016, "퟿".join("ab")),
    ]
    more = spark.createDataFrame([(i, t, "en", "src0", None) for i, t in odd], docs.schema)
    return docs.union(more).cache()


@pytest.fixture(scope="session")
def clashing(small):
    """The same with columns named like those that the operators use inside."""
    names = ["version", "node", "key", "hash", "doc", "text_", "n", "kept", "spans", "stats", "id", "line"]
    return small.withColumns({c: F.lit(i).cast("long") for i, c in enumerate(names)})


@pytest.fixture(scope="session")
def none(small):
    return small.where("false")
