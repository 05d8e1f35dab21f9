import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def odd_texts():
    """Nulls, empty and very short texts, ties, copies, a very long text, periodic and non-ASCII ones."""
    base = "The quick brown Fox jumps over the lazy dog while seven wise owls watch from an old oak tree nearby today"
    long = " ".join(f"word{i % 9973} and thing{i % 31}" for i in range(40_000))
    return [
        None, "", "   \t\n ", "one", "one two three", "One TWO three", base, base, base.upper(), base + " again",
        base.replace("seven", "eight"), "prefix " * 3 + base, long, long + " the end", "a" * 3000, "b" + "a" * 3000 + "c",
        "Ünïcödé ßtraße   naïve façade " * 6, "Ünïcödé ßtraße   naïve façade " * 6 + "ü", "日本語のテキスト 中文 文本 " * 12,
        "123 456 !!! ???", "line one\nline two\n\nline four.\n", "x  y   z  \n  w", "<|endoftext|> in a text <|startoftext|>",
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd texts under ids with gaps, beside a null id, repeated rows and rows that share an id."""
    texts = odd_texts()
    langs, sources = ["en", "de", None], ["b", None, "a", "c", ""]
    rows = [(3 * i - 6, t, langs[i % 3], sources[i % 5], 1) for i, t in enumerate(texts)]
    rows += [(None, texts[6], "en", None, None), rows[6], rows[9], (rows[9][0], "another text of the same id " * 4, "en", "a", 2)]
    return spark.createDataFrame(rows, DOCUMENT).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)
