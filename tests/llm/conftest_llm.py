import zlib

import numpy as np
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, vocabulary: int = 5000) -> list[str]:
    """Invented words; the same seed gives the same words."""
    return [f"w{x:x}" for x in np.random.default_rng(seed).integers(0, vocabulary, n)]


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture()
def make(spark):
    """A documents table from ``(doc_id, text)`` or ``(doc_id, text, source)``."""

    def table(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return table


#: Texts that every operator must take: null, empty, blank, short, odd, very long.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "a b c d"),
    (6, "Grüße, Ünïcode — 日本語 テキスト \U0001f600 'tis don't <|endoftext|> x\x1cy\x85z"),
    (7, " ".join(words(1, 30_000))),
    (8, "one"),
    (8, "one"),
    (None, "no id here"),
]
