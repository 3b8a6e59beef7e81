"""Small tables with the awkward cases every operator has to take."""

import random

from pyspark.sql import functions as F

WORDS = ("the and of to in is that it was for on are with as his they at be this from have or by one had not but "
         "what all were when we there can an your which their said if do will each about how up out them then she").split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    out = []
    for i in range(n):
        out.append(r.choice(WORDS) + r.choice(WORDS))
        if i % 17 == 16:
            out[-1] += ".\n" + r.choice(WORDS)
    return " ".join(out)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def awkward_documents(spark):
    """NULLs everywhere, empty and very long texts, ties, equal rows, clashing extra columns."""
    long = prose(1, 30_000)
    base = prose(2, 200)
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 2), (2, base, "en", "a", 2),  # copies, a repeated row
        (3, base + " andtail", "en", "b", 3), (4, None, "en", "a", 4), (5, "", None, None, 5),
        (6, "   \n\t ", "de", "b", 6), (7, long, "en", "a", 7), (None, prose(3, 50), "en", None, 8),
        (8, "one two", "en", "b", 9), (9, "one two", "en", "b", None), (10, prose(4, 300), None, "c", 10),
        (11, "é ü ß İ ﬀ " + prose(5, 40), "fr", "c", 11), (None, None, None, None, None)]
    df = frame(spark, rows, "doc_id long, text string, lang string, source string, n_chars long")
    # names that the operators use themselves
    for name in ("size", "shard", "slot", "target", "taken", "key", "node", "label", "row", "detected", "removed",
                 "block", "n", "a", "b"):
        df = df.withColumn(name, F.lit(name))
    return df


def empty_like(df):
    return df.limit(0)
