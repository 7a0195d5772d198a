"""Rows that every operator has to take: nulls, empty and very long texts, repeats, clashing names."""

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          # names that operators use for their own columns
          "size bigint, fp bigint, rid bigint, words string, spans string, kept boolean, value string, component bigint, "
          "score double, block bigint, variant bigint")
LONG = ("the quick brown fox jumps over the lazy dog number " + "wörd é 12 " * 9) * 400


def rows():
    base = [
        (1, "Alpha beta gamma delta\nepsilon zeta eta theta iota kappa", "en", "b"),
        (2, None, None, None),
        (3, "", "en", "a"),
        (4, "  \n\t ", "en", "a"),
        (5, LONG, "en", "a"),
        (5, LONG, "en", "a"),
        (6, LONG + " end", "en", None),
        (None, "no id but text, CC BY and all rights reserved", "de", "b"),
        (7, 'token = "9f8e7d6c5b4a39281706f5e4d3c2b1a0" İK CC BY', "fr", "c"),
        (8, "one", "fr", "c"),
        (9, "one", "fr", "c"),
    ]
    return [(i, t, la, s, None if t is None else len(t), *[None] * 11) for i, t, la, s in base]


def odd_docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def on_tables(spark, tmp_path, **frames):
    """A folder with the given tables as Parquet, for queries that take a folder."""
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
