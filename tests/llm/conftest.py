import re
import zlib

import pandas as pd
import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, rank int,"
    " fingerprint string, ids binary, row long, key long, value long, size long, id long, part int"
)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def crc(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


ODD_TEXTS = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one two"), (6, "the cat sat on the mat and slept all day long"),
    (7, "the cat sat on the mat and slept all day long"), (7, "the cat sat on the mat and slept all day long"),
    (None, "null id with a text of several plain words in it, more than ten"), (None, None),
    (8, "a b c d e " * 40), (9, "line one here\nline one here\nline two there\n\n\nline one here"), (10, "x" * 30_000),
    (11, "ß é ñ 漢字     é 🙂 " * 20), (12, "1234 5678 %%% $$$ !!"), (13, "word " * 20_000),
    (14, "\\ <s> </s> [INST] <|endoftext|> 'll don't"), (15, " ".join(f"w{k}" for k in range(30_000))), (16, "\x00\x01 ctl \x1c x"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward case, and columns whose names the operators use themselves."""
    rows = [
        (k, t, None if n % 4 == 0 else ("en", "fr")[n % 2], None if n % 5 == 0 else f"s{n % 3}", None, None, 0.5, 1, "f", b"i", 1, 2, 3, 4, 5, 6)
        for n, (k, t) in enumerate(ODD_TEXTS)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents():
    return pd.read_parquet(f"{SMALL}/documents.parquet")


def rows_of(df, *columns):
    """Rows as sorted tuples of text, so that nulls and repeats compare."""
    return sorted(tuple(repr(r[c]) for c in columns) for r in df.collect())
