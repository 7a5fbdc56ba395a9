import pytest

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
LICENSE = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from varzea.llm.common import ship
    ship(spark)


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text) with nulls, empty and very long texts, repeated rows, copies, ties and near copies."""
    base = " ".join(f"token{i}" for i in range(300))
    out = [(1, "the quick brown fox " * 12), (2, None), (3, ""), (4, " \t\n"), (5, LONG), (6, LONG + " tail"),
           (7, base), (8, base), (8, base), (9, base.replace("token150", "other")), (10, base + " more"),
           (11, f"intro {PASSAGE} outro"), (12, f"another start {PASSAGE} and end"), (13, PASSAGE),
           (14, f"x\n{LICENSE}\nGNU General Public License, MIT license; CC BY"), (15, "Ünï çödé ΣΑΣ 日本語 <|endoftext|> a"),
           (16, "dup line here\ndup line here\nother"), (17, "a|b # $ % & < > *" * 10), (None, "text without id " * 9),
           (None, None), (18, "a" * 5000), (19, "ab " * 700)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With extra columns whose names the operators use themselves."""
    data = [(i, t, "en", "src", len(t or ""), 1, "p", 2.0) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "fp int, __part string, score double").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
