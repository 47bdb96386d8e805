"""Documents with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import random

from pyspark.sql import functions as F

random.seed(7)
WORDS = ["".join(random.choice("abcdeghilmnorstuwyé") for _ in range(random.randint(1, 9))) for _ in range(400)]


def prose(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        out.append(rng.choice(WORDS) + rng.choice(["", "", "", "", ",", ".", ".\n"]))
    return " ".join(out)


def changed(text, edits, seed):
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def texts():
    """(doc_id, text) with every awkward case."""
    base = [prose(120, i) for i in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[0]) for i in range(15)]  # exact copies
    rows += [(200 + i, changed(base[1], i % 9, i)) for i in range(40)]  # near copies, up to 8 edits
    rows += [(300 + i, changed(prose(400, 99), i % 12, i + 50)) for i in range(30)]
    rows += [(400, None), (401, ""), (402, "   \n\t \n"), (403, "one"), (404, "One"), (405, "one two"), (406, "a b c")]
    rows += [(407, prose(30_000, 5)), (408, "x" * 70_000), (409, "\n" * 500), (410, "é" * 3000 + " 日本語 " * 50)]
    rows += [(411, base[2].upper()), (412, " ".join([base[3]] * 3)), (500, base[4]), (500, base[4])]
    return rows


def documents(spark, rows=None):
    """The columns of documents, and others whose names operators use themselves."""
    df = spark.createDataFrame(texts() if rows is None else rows, "doc_id bigint, text string")
    return df.repartition(5).select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"),
        F.length("text").cast("bigint").alias("n_chars"),
    )


CLASHES = ["row", "id", "score", "found", "n_words", "made", "kept", "host", "component", "shard", "ids", "spans"]


def clashing(df):
    """``df`` with columns that are named like those that operators make."""
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
