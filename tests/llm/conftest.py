"""Small document tables with every awkward case in them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

#: Names that operators use for their results or inside.
CLASHES = ("fp", "fingerprint", "component_id", "id", "t", "key", "n", "words", "lo", "shard", "slot", "rank", "score",
           "lang_pred", "length", "offset", "sequence_id", "start", "n_tokens", "kept_text", "n_lines", "term", "vec")


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, clashes=True, lang=None):
        rows = [(i, t, lang[i] if lang else None) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        return df.select("*", *[F.lit(1).alias(c) for c in CLASHES]) if clashes else df

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and blank texts, copies, near copies, a very long text, shared lines and passages."""
    passage, long = prose(1, 60), prose(2, 30_000)
    near = passage.split()
    near[30] = "changed"
    return [None, "", " \n\t ", passage, passage, " ".join(near), long, f"{prose(3, 40)} {passage} {prose(4, 25)}",
            "Shared line\n" + prose(5, 30), " shared LINE \n" + prose(6, 30), "one", "a b c", prose(7, 19), prose(8, 20),
            "x " * 200, None, "", passage.upper(), "ünï çödé 字 " * 30, long]
