import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that the operators use inside
          "size long, kept boolean, key long, h long, shard int, prefix string, count long, target double, hash long, _id long, root long")


def prose(rng, n, words="the of and to a in is that it was red dog runs over lazy blue hill far from home".split()):
    return " ".join(rng.choice(words) + ("x" * rng.randrange(3) if rng.random() < .3 else "") for _ in range(n))


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from riskmesh.llm.shared import ship
    ship(spark)


def frame(spark, rows):
    """rows: (doc_id, text, lang, source); the other columns carry noise."""
    return spark.createDataFrame([(i, t, lang, source, 7, 1, True, 5, 6, 99, "p", 3, 0.5, 11, 12, 13) for i, t, lang, source in rows], SCHEMA)


def odd_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(4)
    long = prose(rng, 60_000)
    same = prose(rng, 90)
    return [(1, None, "en", "a"), (2, "", "en", "b"), (3, " \t\n\r ", None, None), (4, same, "en", "a"), (5, same, "en", None),
            (6, long, "en", "b"), (7, same + " end", None, "b"), (8, "one", "de", "c"), (9, "one two", "de", "c"), (10, "One  TWO", "de", "c"),
            (11, prose(rng, 120), "de", "a"), (11, prose(rng, 80), "de", "a"), (12, "a\nb\na\n\nb\n", "en", "a"), (13, "é ü 漢字 🙂 " * 30, "en", "a"),
            (None, prose(rng, 70), "en", "a"), (None, same, "en", "b"), (14, same, "en", "a"), (14, same, "en", "a"), (15, "!!! ### 123", "en", "a")]


def key(*values):
    return tuple((v is not None, v) for v in values)
