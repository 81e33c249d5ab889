"""Rows that every operator has to take: nulls, empty, long and repeated texts, and columns named like an operator's own."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, score double, _key string, component int, n bigint"


def rows():
    long = " ".join(f"word{i % 977} and{i % 13}." for i in range(30_000))
    texts = [None, "", " \n\t ", "One sentence here. And another one there.", "One sentence here. And another one there.", "été 中文 \U0001f600!", long, "x" * 50_000, "!!! ...", long]
    out = [(i, t, "en" if i % 3 else None, "s", None, 7, 0.5, "k", i, None) for i, t in enumerate(texts)]
    return out + [out[3]]


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
