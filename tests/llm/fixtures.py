"""Small documents with every odd case, and brute-force helpers."""

import random

COLUMNS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, __block bigint, key string, slot int, "
    "size int, fp int, words int, digest string, copies int, shard int"
)
PASSAGE = "The quick brown fox jumps over the lazy dog while seventeen sailors sing an old and very long song."


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["an", "er", "th", "ing", "on", "é", "st", "ou"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows() -> list[tuple]:
    texts = [
        (1, words(1, 80)), (2, words(1, 80)), (3, words(1, 79) + " other"), (4, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "two words"),
        (9, PASSAGE), (10, words(2, 30) + "\n" + PASSAGE + "\n" + words(3, 30)), (11, words(4, 30) + "\n" + PASSAGE + "\n" + words(5, 30)),
        (11, words(4, 30) + "\n" + PASSAGE + "\n" + words(5, 30)), (12, words(6, 20)), (12, words(7, 20)), (None, words(1, 80)), (None, words(8, 60)),
        (13, "x" * 3000), (14, "line of text\n" * 40), (15, "日本語のテキスト。" * 30), (16, "A B <|endoftext|> C D 🎉 naïve"), (17, "ab" * 20000 + " " + "é" * 500),
        (18, words(9, 4000)), (19, "### $$$ ||| !!! " * 60), (20, words(1, 80).upper()), (-5, words(10, 120)), (21, PASSAGE[:49]), (22, "x" + PASSAGE[:50]),
    ]
    langs, sources = ["en", "de", None, ""], ["a", "b", None, "é", ""]
    return [
        (i, t, langs[k % 4], sources[k % 5], None if t is None else len(t), k, "k", 1, 2, 3, 4, "d", 5, 6) for k, (i, t) in enumerate(texts)
    ]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, COLUMNS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def word_list(text: str) -> list[str]:
    import re

    return re.findall("[^\x20\x09-\x0d]+", text or "")
