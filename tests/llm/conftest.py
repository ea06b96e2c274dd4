import pytest

from wakeline.llm.tables import ship_package

DOC_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that the operators use inside; as further columns of an input they must do no harm
CLASHING = ["row", "node", "key", "keys", "kept", "size", "shard", "slot", "text_key", "word", "component", "spans", "wanted",
            "bucket", "kind", "_pos", "_part", "items", "tokens", "held_out", "score", "failed_rules", "piece", "part", "w", "l"]


@pytest.fixture(autouse=True)
def _package(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with nulls in every column, empty, blank, short and very long texts, ties and repeated rows."""
    words = "the of and to in a is that it for on was as with by this".split()
    prose = " ".join(words[(i * i + i // 7) % 16] + (str(i % 29) if i % 3 else "") for i in range(300)) + ".\nSecond line here."
    texts = [None, "", " \n\t ", "one", "one two three four", prose, prose, prose + " tail", "x" * 50_000,
             " ".join(f"w{i % 977}é" for i in range(30_000)), "Released under the MIT License.", "idiot " + prose[::-1], "éé\u0301 日本語 \U0001f600"]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, prose, None, None, None), (None, None, None, None, None), (3, "another text of id three", "en", "s0", 1)]
    df = spark.createDataFrame(rows, DOC_COLUMNS)
    return df


@pytest.fixture(scope="session")
def wide_docs(spark, edge_docs):
    """The same with many more columns, whose names the operators use for their own."""
    from pyspark.sql import functions as F

    return edge_docs.select("*", *(F.lit(7).alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_COLUMNS)
