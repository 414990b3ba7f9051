"""Awkward documents and small brute-force helpers for the tests of this folder."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def documents(spark, rows):
    """(doc_id, text) pairs as a documents table."""
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def awkward():
    """Nulls, empty and blank texts, ties, repeated rows, shared prefixes and a very long text."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    return [
        (1, "one two three four five"), (2, "one two three four five"), (2, "one two three four five"), (None, "one two three four five"),
        (3, None), (4, ""), (5, "  \n "), (6, long), (7, long + "!"), (8, long), (None, None), (9, "é" * 200), (10, "e" * 200),
        (11, "😀 naïve <|endoftext|> café's  two  spaces\t"), (12, "x"), (12, "y"),
    ]


def union_find(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
