"""Hashed text embeddings, a fixed stand-in for a remote embedding model (T5)."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import normalised


# A word is a run of letters and digits of any script.
WORD, GAP = r"[\p{L}\p{N}]", r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case words; the ends of the text may add an empty one."""
    return F.split(normalised(F.coalesce(text, F.lit(""))), GAP)


def place(word: Column, dim: int) -> Column:
    """A number below `dim` from the first 32 bits of the MD5 of the word, which any SQL engine can repeat."""
    return F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long") % dim


def hash_embeddings(df: DataFrame, dim: int = 64, text: str = "feedback_text", model: str | None = None) -> DataFrame:
    """`vector array<float>` of length `dim` and norm one for every text that has a word.

    Hashing needs no fitted vocabulary, so texts embedded in different runs, and query
    texts, share one space.  Rows without a word are left out by a test on the text itself;
    a test on the words would be pushed down and split every text twice.  A word counts at the place that
    its hash names, so the vocabulary of the counts is just the list of places.
    """
    rows = df.filter(F.col(text).rlike(WORD))
    rows = rows.withColumn("_places", F.transform(F.array_remove(words(F.col(text)), ""), lambda w: place(w, dim).cast("string")))
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(dim)], inputCol="_places", outputCol="_counts")
    rows = counter.transform(rows)
    rows = Normalizer(inputCol="_counts", outputCol="_unit").transform(rows)
    return rows.withColumn("vector", vector_to_array("_unit", "float32")).withColumn(
        "model", F.lit(model or f"hash-{dim}")
    ).drop("_places", "_counts", "_unit")
