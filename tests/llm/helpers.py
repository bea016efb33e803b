"""Small tables with every awkward row: nulls, repeated rows and ids, empty
and blank texts, one long text, and extra columns whose names clash with the
operators' own."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, row long, kind string, n int, fold int, "
          "name1 string, shingle int, spans string, clean string")
SYLLABLES = ["the", "an", "ou", "re", "st", "in", "gé", "li", "mo", "ß"]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


def docs_of(spark, texts, langs=None):
    """One row per (id, text)."""
    rows = [(i, t, langs[k] if langs else "en", "s", 1, 0.5, 7, "k", 3, 9, "a", 4, "x", "y") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def awkward(seed=1):
    rng = random.Random(seed)
    base = words(rng, 60)
    return [(0, None), (1, ""), (2, "  \n "), (3, base), (3, base), (None, base), (None, "Null id, "+words(rng, 5)), (5, "a"), (6, "a b"),
            (7, base + " end"), (8, words(rng, 3000)), (9, "É 東京 <|endoftext|> it's  x\ty z " + words(rng, 4)), (10, words(rng, 40))]
