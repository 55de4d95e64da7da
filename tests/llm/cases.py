"""Documents with nulls, empties, ties, repeats, long texts and clashing column names."""

import random

CLASHES = (
    "n_words long, kept boolean, label int, c string, tag long, line string, a long, b long, gram long, "
    "cuts string, gone string, fingerprint long, component_id long, bands string, start long, n long"
)


def texts(seed=3, n=60):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(draw.randint(2, 9))) for _ in range(400)]
    sentence = lambda: " ".join(draw.choice(vocabulary) for _ in range(draw.randint(6, 24))).capitalize() + "."
    rows = ["\n".join(sentence() for _ in range(draw.randint(1, 9))) for _ in range(n)]
    passage = " ".join(sentence() for _ in range(8))
    for k in range(0, n, 7):
        rows[k] = rows[k] + "\n" + passage  # a passage many share
    for k in range(3, n, 11):
        rows[k] = rows[2]  # copies
    for k in range(5, n, 13):
        rows[k] = rows[4].replace("e", "a", 1)  # near copies
    rows[8] = "Again and again. " * 300
    rows[9] = " ".join(rows[:6]) * 12
    rows[10] = "x" * 5000
    return [*rows, "", " ", "\n\n \t\n", "a", "ab", "one two", None, "É" * 120 + "ø" * 3, "é" * 120 + "ø"]


def documents(spark, rows=None):
    """(doc_id, text) in a frame with columns whose names the operators use inside."""
    if rows is None:
        rows = list(enumerate(texts()))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    extra = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in (x.split() for x in CLASHES.split(", ")))
    return frame.selectExpr("*", *[x for x in extra.split(", ")]).repartition(3)


def empty(spark):
    return documents(spark, []).where("false")
