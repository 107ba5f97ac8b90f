"""A small table of documents with everything that an operator must bear."""

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(60_000))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 5),
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 5),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa", None, None, None),
    (3, None, "en", "a", None),
    (4, "", "en", "b", 0),
    (5, "   \n\n \t ", "fr", "b", 6),
    (None, "a null id with words of its own", "en", "a", 1),
    (None, None, None, None, None),
    (6, LONG, "en", "a", len(LONG)),
    (7, "x" * 300_000, "en", "c", 300_000),
    (8, "ÄÖÜ ß é 中文 😀\r\nzweite Zeile\r\n", "de", "c", 3),
    (9, "one", "en", "c", 3),
    (10, "one", "en", "c", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("row", "id", "h", "c", "n", "k", "label", "score", "predicted", "size", "shard", "slot", "start", "length", "lines", "_host", "kept",
            "lines_total", "state", "place", "part", "toxic", "draw", "item_id")


def documents(spark, rows=ROWS, clashing=True):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING}) if clashing else df
