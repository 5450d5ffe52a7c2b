"""Small corpora with every awkward case, and brute-force helpers."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, xh string, h int, _kept int"


def words(text):
    return WORD.findall(text or "")


def prose(rng, n):
    return " ".join("".join(rng.choice(("th", "er", "on", "an", "re", "ing", "ly", "ou", "é")) for _ in range(rng.randint(1, 4)))
                    for _ in range(n))


def awkward(seed=5, n=40):
    """(doc_id, text) rows: prose, exact and near copies, shared passages, nulls, empties, repeated rows and ids."""
    rng = random.Random(seed)
    shared = prose(rng, 70)
    rows = []
    for i in range(n):
        text = prose(rng, rng.randint(1, 300))
        if i % 5 == 1:
            text = f"{prose(rng, rng.randint(0, 40))} {shared}\n{prose(rng, rng.randint(0, 40))}"
        if i % 7 == 3:
            text = rows[i - 2][1]
        if i % 11 == 6:
            text = rows[i - 1][1].replace(" ", "\t", 3) + " extra"
        rows.append((i, text))
    same = "same words again " * 400
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, same), (104, same + "end"), (104, same + "end"), (105, "x" * 5000),
             (None, rows[0][1]), (None, None), (3, prose(rng, 120)), (106, "Ünïcode  \x0b wörds… 日本 語")]
    return rows


def documents(spark, rows):
    full = [(i, t, "en" if i is None or i % 3 else None, "src0", len(t or ""), "clash", 7, 1) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
