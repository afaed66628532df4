"""Odd rows for the tests of this folder."""

import random

import pytest

SF0001, SF001 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key long, th long, fp long, component long, "
          "hash long, n_words long, rule string, token string, row long, part long, uid long, label string, k long, h string")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def odd_texts():
    """(doc_id, text): nulls, empty and blank texts, ties, copies, near copies, shared passages, a long text, scripts."""
    rng = random.Random(5)
    a, b, shared = prose(rng, 120), prose(rng, 200), prose(rng, 60)
    long = prose(rng, 6000, 3000)
    near = b.split()
    near[100] = "changed"
    texts = [(1, a), (2, a), (2, a), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "one two"), (8, "One Two"), (None, a), (None, None),
             (9, b), (10, " ".join(near)), (11, prose(rng, 50) + "\n" + shared + "\n" + prose(rng, 40)),
             (12, prose(rng, 30) + " " + shared), (12, a), (30, "own words " + prose(rng, 30) + " " + shared), (30, b), (13, "spam " * 400), (14, "x" * 1500), (15, long),
             (16, "prefix " + long[:20000]), (17, "ÀÉ ñandú 漢字 😀 " * 30), (18, "a%%% b### c$$$ d&&& e*** " * 20), (19, "line one here\n" * 40),
             (20, "Licensed under CC BY-NC 4.0. All Rights Reserved.\nGNU General Public License text"), (21, "all rights\nreserved"),
             (22, "tab\tsep\x0bwords\x0c here\r\n" * 5), (23, "\0nul \x1c sep \x85 next \u00a0 nbsp"), (24, "'ll it's  double  blanks \n\n x " * 9)]
    return texts


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(k, t, "en", "s", len(t or ""), 7, 7, 7, 7, 7, 7, "r", "t", 7, 7, 7, "l", 7, "h") for k, t in odd_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
