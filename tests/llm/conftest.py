import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, n bigint, bucket string, "
          "rank string, `key` string, class string, shard string, digest string, keep_id bigint, component string, rep string")


def frame(spark, rows):
    """A documents table of (doc_id, text) with further columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "en", "s", 1, 7, 8, "b", "r", "k", "c", "s", "d", 9, "x", "y") for i, t in rows], SCHEMA)


def words(n, seed=0, vocabulary=400):
    import random
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def hard_rows():
    """Null, empty, blank, repeated, upper-case, very long and odd texts; null and repeated ids."""
    long = " ".join(words(12_000, 5, 3_000))
    base = words(80, 1)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, " ".join(base)), (5, " ".join(base)), (5, " ".join(base)),
        (6, " ".join(base).upper()), (None, " ".join(base)), (None, None), (7, "x" * 20_000), (8, long), (9, long + " tail"),
        (10, " ".join(base[:60] + words(40, 2))), (11, " ".join(words(30, 3) + base[5:70])), (12, "one two three"),
        (13, "one two three"), (14, "ÉTÉ été \x00 <|endoftext|>  a   b\n\n c d"), (15, "été"), (0, "One TWO three"),
        (16, "a line that repeats across documents\nanother line\n\nanother line"),
        (17, "A line that repeats across documents!\nsomething else"),
    ]


@pytest.fixture(scope="session")
def hard(spark):
    return frame(spark, hard_rows())


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
