"""Small document tables with nulls, empty and long texts, repeated rows and clashing columns."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [None, "", " ", "\n\n", "a", " lead", "trail ", "two  spaces", "a\tb\x0bc\x0cd\re", "café ñandú 漢字 кот", "\x1c\x85\xa0x",
       "x" * 1500, "ab" * 900, "<|endoftext|> in <|endoftext|>text", "don't we'll I'm", "1234567 12.5%", "🙂🙂 á", "!!! ??? ...",
       "same line\nsame line\n \nother\nsame line", "\r\n\r\n x"]


def odd_rows():
    rows = [(i, t, None if i % 3 else "en", None if i % 4 else "s", None if i % 5 else 1) for i, t in enumerate(ODD)]
    return rows + rows[4:6] + [(None, "no id here", "en", "s", 3), (None, None, None, None, None)]


def random_texts(n, seed=1, words=(0, 120)):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    sep = [" "] * 20 + ["\n", "  ", "\t", " \n"]
    out = []
    for _ in range(n):
        out.append("".join(rng.choice(vocab) + rng.choice(sep) for _ in range(rng.randint(*words))))
    return out


def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
