"""Small fixtures with the awkward cases every operator has to survive."""

import pytest
from pyspark.sql import types as T

from barsmith.llm.common import prepare

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

LABELS = "doc_id long, quality int, toxic int"


def base_words(start: int, n: int) -> list[str]:
    """``n`` words of an invented vocabulary, the same for the same start."""
    out, x = [], start * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append("".join("bcdfglmnprst"[(x >> s) % 12] + "aeiou"[(x >> (s + 4)) % 5] for s in (3, 9, 15)))
    return out


@pytest.fixture()
def docs_of(spark):
    prepare(spark)

    def make(rows):
        """Documents from (doc_id, text) or (doc_id, text, lang)."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture()
def awkward(docs_of):
    """Nulls, empty and blank texts, repeated rows, a very long text."""
    long_text = " ".join(base_words(1, 4000)) + "\n" + "x" * 50_000
    return docs_of([(1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (5, long_text),
                    (6, " ".join(base_words(2, 60))), (None, "no id here"), (7, "été über Niño ß", None)])
