"""Documents with every odd case, as rows and as frames."""

import random

CLASHING = "key string, norm string, bucket long, score double, kept boolean, node long, digest string, size long, row long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
FILLER = ("x", "y", 1, 0.5, True, 2, "z", 3, 4)


def odd_rows() -> list[tuple]:
    """NULLs in every column, empty, blank and very long texts, ties, repeated
    rows and copies that differ in white space only."""
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "omega", "Élan", "naïve", "it's", "42", "x-ray", "漢字", "ﬁn"]
    base = " ".join(rng.choice(words) for _ in range(60))
    rows = [
        (0, base, "en", "a", len(base)),
        (1, base.replace(" ", "\n"), "en", "a", len(base)),
        (2, base + " ", "en", None, len(base) + 1),
        (3, base + "\t", "de", "b", len(base) + 1),
        (4, None, None, None, None),
        (5, "", "en", "a", 0),
        (6, " \t\n ", "en", "b", 4),
        (None, "only words without an id here", "en", "a", 29),
        (None, None, None, None, None),
        (7, "one", "en", "c", 3),
        (8, "ONE", "en", "c", 3),
        (9, "two words", "en", "c", 9),
        (10, "two words", "en", "c", 9),
        (10, "two words", "en", "c", 9),
        (11, "12345 !!! 678", "en", "c", 13),
        (12, " ".join(rng.choice(words) for _ in range(30_000)), "en", "b", None),
        (13, "nbsp here \x1c control   line <|endoftext|> end", "en", "a", 40),
        (14, "<|ENDOFTEXT|> “quotes” é İ ΑΣ", "de", "a", 20),
    ]
    for i in range(15, 45):
        t = base.split()
        for _ in range(i % 4):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i, " ".join(t), ["en", "de"][i % 2], ["a", "b", "c", "d"][i % 4], 0))
    for i in range(45, 75):
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 200))), "en", "d", 0))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, *FILLER) for r in rows], SCHEMA).repartition(3)
