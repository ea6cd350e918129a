"""Small tables shared by the tests of the training-data operators."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Null, empty, blank and long texts, ties, repeated rows, null columns.
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, "word", None, "a", 4),
    (5, "word " * 20000, "en", "b", 100000), (6, "x" * 50000, "en", None, 50000), (7, "same line here\nsame line here", "en", "a", 29),
    (7, "same line here\nsame line here", "en", "a", 29), (None, "no id at all here", "en", "a", 17), (None, None, None, None, None),
    (8, "12 34 !! 56", "en", "a", 11), (9, "é世界 \U0001F600 ok\x00 fine\r\nnext", "fr", "c", 20), (10, "word", "en", "a", 4)]


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def odd(spark):
    return docs(spark, ODD)


def empty(spark):
    return docs(spark, [])


def clashing(df):
    """The same rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    for name in ("id", "fp", "copy", "score", "lang_pred", "ids", "n_lines", "component_id", "shard", "weight", "mass", "body", "key", "host"):
        df = df.withColumn(name, F.lit("extra"))
    return df


def components(nodes, links):
    """Smallest reachable node of each node, by brute force."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
