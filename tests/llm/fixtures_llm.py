"""Small tables with awkward rows, shared by the tests of the operators."""

import random

WORDS = ["ant", "bee", "cat", "dog", "elk", "fox", "gnu", "hen", "ibis", "jay", "kite", "lark", "mole", "newt", "owl", "pig",
         "quail", "rat", "seal", "toad", "urial", "vole", "wolf", "yak", "zebra", "été", "über", "ñu", "日本", "Ox."]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def rows():
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    return [
        (1, base), (2, " ".join(near)), (3, None), (4, ""), (5, " \t\n "), (6, "single"), (7, prose(2, 80)),
        (8, base), (8, base), (9, prose(3, 9000)), (None, prose(4, 70)), (None, None), (10, prose(2, 80) + " tail"),
        (11, "A\x00b\x1c c  d e"), (12, prose(5, 60) + " " + " ".join(base.split(" ")[20:100])), (13, "x" * 5000),
    ]


CLASH = ("score", "overlaps", "n_pii", "bucket", "key", "label", "row", "text_crc32", "th", "n")


def messy(spark, some=None):
    """The rows with extra columns named like the operators' own."""
    data = [(d, t, "en", f"src{i % 3}", len(t) if t is not None else None, *[f"{c}{i}" for c in CLASH])
            for i, (d, t) in enumerate(rows() if some is None else some)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{c}` string" for c in CLASH))


def empty(spark):
    return messy(spark).where("false")
