"""Fixtures: rows of ``documents`` with the awkward cases in them."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ["ka", "lo", "mi", "ter", "son", "ve", "ru", "dan", "pel", "ost", "bri", "gu", "fa", "len"]
COMMON = {"en": ["the", "of", "and", "to"], "fr": ["le", "de", "et", "un"]}


def prose(rng, n, lang="en"):
    """``n`` words: function words and made-up ones, a line end now and then."""
    words = []
    for _ in range(n):
        if rng.random() < 0.35:
            words.append(rng.choice(COMMON[lang]))
        else:
            stem = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 4)))
            words.append(stem if lang == "en" else stem + "é")
    return "".join(w + ("\n" if rng.random() < 0.03 else " ") for w in words).strip()


def edge_rows():
    """Null ids, texts and sources; empty, blank, short and very long texts;
    copies, near copies and rows that repeat whole."""
    rng = random.Random(5)
    base = prose(rng, 300)
    words = base.split(" ")
    near = words.copy()
    near[150] = "changed"
    rows = [
        (1, base, "en", "a"), (2, base, "en", "b"), (2, base, "en", "b"),
        (3, " ".join(near), "en", "a"), (4, base.upper(), None, None),
        (5, None, "en", "a"), (6, "", "fr", None), (7, " \t\r\n\x0b\x0c ", "en", "a"),
        (8, "one two three", "en", "b"), (9, "one two three", "en", "b"), (10, "solo", None, "c"),
        (None, prose(rng, 80), "en", "a"), (None, base, "en", "a"), (None, None, None, None),
        (11, prose(rng, 60_000), "en", "long"), (12, "x" * 700_000, "en", "long"),
        (13, "same same " * 400, "en", "a"), (14, "Ünïcödé 字 🙂 words here", "fr", "c"),
    ]
    rows += [(100 + i, prose(rng, rng.randint(30, 200), "fr" if i % 3 == 0 else "en"),
              "fr" if i % 3 == 0 else "en", "abc"[i % 3]) for i in range(30)]
    return [(*r, len(r[1] or "")) for r in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)


def clashing(df):
    """``df`` with extra columns named like what operators use inside."""
    names = ["row", "id", "src", "size", "tie", "digest", "n", "text_hash", "no_id", "kept", "score",
             "held_out", "words", "mix_row", "target", "taken", "seed", "region", "turns", "pieces"]
    for name in names:
        df = df.withColumn(name, df[df.columns[0]].cast("string"))
    return df
