import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def vocabulary():
    from txnscope.llm.queries import vocabulary as path

    return path


@pytest.fixture(scope="session")
def sf_docs():
    """{doc_id: text} of the smallest documents table."""
    import pandas as pd

    table = pd.read_parquet(os.path.join(SF, "documents.parquet"))
    return dict(zip(table.doc_id.tolist(), table.text.fillna("").tolist()))


# ids and texts with every odd case: nulls, empty, white space only, short, long, ties, repeated rows
ODD = [
    (None, "the null id comes first"),
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, " ".join(f"word{i}" for i in range(60))),
    (6, "prefix " + " ".join(f"word{i}" for i in range(60)) + " suffix"),
    (7, "x" * 5000),
    (8, "a " * 3000),
    (9, "ein Straße über  doppelte   Leerzeichen\n\nund 日本語 🙂 <|endoftext|> </s>"),
    (10, "same text under one id"),
    (10, "same text under one id"),
    (10, "other text under the same id"),
    (11, "same text under one id"),
]
DDL = "doc_id long, text string, row string, key long, score double, n_words string, shard string, ids array<int>"


@pytest.fixture(scope="session")
def odd(spark):
    """The odd cases, with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, "r", None, 0.5, "w", None, [1]) for i, t in ODD], DDL)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DDL)
