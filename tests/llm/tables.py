"""A small table with every kind of awkward row."""

import random

WORDS = "ba ce di fo gu ha je ki lo mu na pe qui ro su ta ve wo xa yo zu am en il om".split()
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id string, text_key long, fp long, kept string, component string, _key string, row_key string, spans int"
)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choices(WORDS, k=rng.randint(1, 3))) for _ in range(n)]
    return " ".join(w + (".\n" if rng.random() < 0.06 else "") for w in words)


def make_docs(spark, rows, schema=SCHEMA):
    """Rows (doc_id, text[, lang, source]) with extra columns named like results."""
    filled = [(r + ("en", "web")[len(r) - 2 :])[:4] for r in rows]
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 1, 2, "k", None, "_", "r", 3) for r in filled], schema)


def awkward_rows():
    base = prose(1, 120)
    return [
        (1, base),
        (2, base),  # equal text
        (2, base),  # equal row
        (3, None),
        (4, ""),
        (5, " \n\t \n"),
        (None, base),
        (None, None),
        (6, "une phrase à part, Ünïcödé 漢字 🙂 <|endoftext|>", None, None),
        (7, prose(2, 60), "en", None),
        (8, "short"),
        (9, prose(3, 25_000)),  # very long
        (10, prose(1, 120).replace("ba", "BA"), None, "web"),
    ]
