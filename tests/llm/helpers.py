"""Small frames and plain-Python word rules shared by the corpus tests."""

import re

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("size", "score", "key", "class", "spans", "position", "target", "n_words")

LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
PROSE = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau "
         "upsilon phi chi psi omega one two three four five six seven eight nine ten")


def edge_rows():
    """Nulls everywhere, empty and white texts, a very long one, ties and repeated rows."""
    return [
        (1, PROSE, "en", "s1", len(PROSE)),
        (2, PROSE, "en", "s1", len(PROSE)),                    # an exact copy
        (3, PROSE + " eleven", "en", "s1", None),              # a near copy
        (4, None, "en", "s1", None),
        (5, "", None, None, 0),
        (6, " \t\n ", "en", "", 4),
        (7, LONG, "de", "s2", len(LONG)),
        (8, "word", "de", "s2", 4),
        (9, "Über ÉTÉ naïve Wörter, größer; ÀÉ", "fr", "s3", 33),
        (9, "Über ÉTÉ naïve Wörter, größer; ÀÉ", "fr", "s3", 33),   # a repeated row
        (10, "same key, one text", "en", "s3", 18),
        (10, "same key, another text", "en", "s3", 22),
        (None, "no key here", None, "s3", 11),
        (None, None, None, None, None),
    ]


def edge_docs(spark, extra=False):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows(), DOCS)
    return df.withColumns({c: F.lit(f"mine {c}") for c in CLASHING}) if extra else df


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def write_tables(spark, folder, **tables):
    """Frames as the Parquet tables of a data folder."""
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")
