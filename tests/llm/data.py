"""Small tables that hold what operators must stand: nulls, empty and long texts, ties, repeated rows, odd columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use as names of their own.
CLASHING = ["row", "key", "id", "text_", "score", "slot", "shard", "rule", "host", "path", "word", "n", "cls", "x", "k", "bucket", "digest", "win", "item"]


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioutnsrlkm") for _ in range(2 + r.randrange(vocabulary) % 6)) for _ in range(n))


def documents(spark, rows, more: bool = False):
    """`rows`: (doc_id, text) or (doc_id, text, lang). With `more`, columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if more:
        df = df.selectExpr("*", *[f"'?' AS `{c}`" for c in CLASHING])
    return df


def odd_texts() -> list[tuple]:
    """Ids with nulls and repeats, texts null, empty, blank, tiny, without letters, repeated, and one very long."""
    long = prose(1, 30_000)
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "a"), (5, "12 34 --"), (6, "one two three four"), (7, prose(2, 80)), (7, prose(2, 80)),
        (8, prose(2, 80)), (8, prose(3, 60)), (None, prose(4, 50)), (None, None), (9, long), (10, "ÀÉ ß 中文 \U0001f642 \x85\xa0 x"), (11, "<|endoftext|> a<|endoftext|>"),
    ]
