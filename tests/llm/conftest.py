import hashlib
import random

import pytest

# Names that operators might use themselves.
EXTRA = "doc size shard slot row key bits h a b u v gone copies score label root void kept text_crc32 __row n run".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def words(seed: int, n: int) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(n)]


def prose(seed: int, n: int) -> str:
    return " ".join(words(seed, n)).capitalize() + "."


LONG_LINE = "This very line is found in a great many of the documents here."


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, copies, repeated rows, ids twice."""
    rows = [
        (None, "A text without id, of some ten words or a few more.", None, None),
        (None, None, "en", "s1"),
        (1, None, None, None),
        (2, "", "en", "s1"),
        (3, " \t\n \x0b\x0c\r ", "en", "s2"),
        (4, prose(4, 60), "en", "s2"),
        (5, prose(4, 60), "en", "s3"),
        (6, prose(6, 80), "de", "s3"),
        (6, prose(6, 80), "de", "s3"),
        (7, prose(7, 40), "de", None),
        (7, prose(8, 40), "de", "s1"),
        (8, prose(9, 30_000), "en", "s1"),
        (9, "Äpfel! \U0001f600 ÉTÉ | Ünï #1\r\nzwei\x85drei vier", "de", "ß"),
        (10, "one", "en", "s2"),
    ]
    for i in range(11, 40):
        rows.append((i, f"{prose(i, 50)}\n  {LONG_LINE.upper()}\n{prose(i + 100, 20)}\n", "de" if i % 3 else "en", f"s{i % 4}"))
    for i in range(40, 60):
        rows.append((i, prose(4, 60), "en", "s0"))
    return rows


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows):
        full = [(*r, None if r[1] is None else len(r[1]), *["x"] * len(EXTRA)) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd(frame):
    return frame(odd_rows()).cache()


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
