import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from documents import DOCS, docs_frame, sentence


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, space-only, tiny, long, repeated and control texts."""
    rng = random.Random(4)
    long = sentence(rng, 6000)
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One two"), (6, "one"), (7, long),
        (8, long), (9, "<|endoftext|> é 海 \x00 \u2028 end"), (10, "12 345 !!"), (11, sentence(rng, 40)),
        (11, sentence(rng, 40)), (12, sentence(rng, 30)), (12, None), (None, "no id at all here"),
        (None, None), (13, "a b c d e f g h i j k l"), (14, "A B C D E F G H I J K L"),
    ]


@pytest.fixture()
def odd(spark, odd_rows):
    return docs_frame(spark, odd_rows)


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], DOCS)
