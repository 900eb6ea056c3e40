import os

import pytest

SF = "/root/testdata/sf0.001"

# Names that operators use inside, or return.
CLASHING = "keep_id string, score string, node string, label string, h1 string, h2 string, key string, " \
           "version string, start string, spans string, digest string, recipe string, minimizers string, r string, " \
           "a string, b string, n string, held_out string, lang string"


@pytest.fixture(scope="session")
def documents(spark):
    """rows of (doc_id, text) as a documents table with columns of clashing names."""
    names = [c.split()[0] for c in CLASHING.split(", ")]

    def of(rows):
        return spark.createDataFrame([(i, t, *(f"x{k}" if k % 2 else None for k in range(len(names)))) for i, t in rows],
                                     f"doc_id bigint, text string, {CLASHING}")
    return of


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, very long texts."""
    long = " ".join(f"w{i * i % 9973}" for i in range(60_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three four five six seven"), (5, "one two three four five six seven"),
            (6, "One  two\tthree four five six seven"), (7, long), (8, long + " end"), (9, "x" * 5000), (10, "é漢𝔘 — ça va? it's <|endoftext|> 12½"),
            (None, "one two three four five six seven"), (None, None), (11, "the same line here\nanother line\nthe same line here"),
            (12, "The same line here \n\n tail"), (13, "ab " * 300), (14, " 　")]


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """Writes tables as a folder of test data and gives its path."""
    def of(**tables):
        base = str(tmp_path_factory.mktemp("sf"))
        for name, df in tables.items():
            df.write.parquet(os.path.join(base, f"{name}.parquet"))
        return base
    return of
