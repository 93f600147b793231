"""A small table of documents with every awkward case, and a column that is called like an inner one."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, tie string, shard int"

#: names that stages use inside, as columns of a table: what stands in them must come out as it went in
INNER = ["_d", "_t", "_id", "_tie", "_keep", "_with", "starts", "ends", "_D_", "leaf", "hits", "runs", "_text", "_y", "component", "window"]


def texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word().capitalize() if rng.random() < 0.1 else word() for _ in range(n))
    base, passage = prose(300), prose(60)
    near = base.split(" ")
    near[150] = "changed"
    out = [None, "", " \n\t ", "one", base, base, " ".join(near), passage, prose(40) + " " + passage + ". " + prose(30), prose(20) + "\n" + passage + "!", "ab" * 300, prose(9), prose(9).upper(), prose(6000), "x " * 500, "\x00 odd \u2028 text \U0001f600 <|endoftext|> a  b"]
    return out + [prose(rng.randint(1, 120)) for _ in range(25)]


def documents(spark):
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t), "x", "y", 1) for i, t in enumerate(texts())]
    rows += [rows[4], rows[8], (None, "no id", None, None, None, None, None, None), (8, "another text with the id eight", "en", "s0", 30, "x", "y", 1)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
