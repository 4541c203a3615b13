import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, shard int, fp long, score double, body string, batch int, verdict string, place int"


def edge_rows():
    """Nulls in any column, empty and very long texts, repeated rows and ties."""
    long = "\n".join(f"The {w} of the line goes on and on, as word{i % 977} says." for i, w in enumerate(["house", "tree", "river"] * 3000))
    texts = [None, "", "   \n\t ", "one", "a b c", long, "x" * 5000, "Hello world. " * 40, "Hello world. " * 40, "ÉÀ ß İ ﬁ 中文 кириллица العربية", "<|endoftext|> and <|startoftext|>", "1234 !!! ###", "\x00\x1c\x85 a\u00a0b"]
    rows = [(i, t, ("en", "fr", None)[i % 3], f"s{i % 2}" if i % 4 else None, len(t) if t else None) for i, t in enumerate(texts)]
    rows += [rows[7], (None, "no id at all, but some words.", None, None, None), (None, None, None, None, None)]
    return [(*r, None, 7, 5, 0.5, "b", 3, "v", 9) for r in rows]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
