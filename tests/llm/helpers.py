"""Small tables with every awkward case: nulls, empty and long texts, repeated rows, clashing columns."""

import random

SYLLABLES = "th er on an re le st mi ka de en is to la".split()


def prose(rng, n):
    out = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    return " ".join(out)


def documents(spark, seed=1, more=()):
    rng = random.Random(seed)
    rows = [(k, prose(rng, rng.randint(15, 120)), f"src{k % 3}") for k in range(40)]
    rows += [(100, None, "src0"), (101, "", None), (102, " \n\t ", "src1"), (103, "one two", "src1"), (None, prose(rng, 40), "src2"), (104, "x" * 5000, "src0"), (105, prose(rng, 30_000), "src0")]
    rows += [(106, rows[3][1], "src0"), rows[3], rows[3], (107, rows[5][1] + " tail", "src1")]
    rows += list(more)
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def clashing(df):
    """Extra columns with names that operators use inside."""
    out = df
    for c in ("k", "c", "n", "label", "bands", "bits", "w", "at", "block", "bucket", "number", "slot", "position", "phase", "key", "hit_id", "text_key", "score", "held_out", "row", "host", "path"):
        out = out.selectExpr("*", f"'x' AS {c}")
    return out


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
