"""Documents with every awkward property the operators define a result for."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, body string, "
    "n_words long, score double, fp long, row string, kept boolean, words string, label int"
)

PROSE = (
    "The keeper of the old light walked down to the shore and counted the boats that came in "
    "with the evening tide while the wind was still from the west and the water was calm for a "
    "time as it is on days like this by the end of the summer when all of them are at sea again"
)
LONG = " ".join(f"{PROSE} {i} times" for i in range(700))
TEXTS = [
    (1, PROSE),
    (2, PROSE),
    (2, PROSE),
    (3, PROSE + " once more"),
    (None, PROSE),
    (4, None),
    (None, None),
    (5, ""),
    (6, " \t\n "),
    (7, "one"),
    (8, "word " * 400),
    (9, LONG),
    (10, "###" * 300),
    (11, "Überall sagt man: große Straße\n\nÜberall sagt man: große Straße\n漢字かな交じり文 𝄞𝄞"),
    (12, "line\nline\nline\n  \nother"),
    (13, "\x00\x01 odd \x7f bytes   and   more"),
]


def awkward(spark):
    rows = [
        (i, t, "en", "s", 1, "body", 5, 0.5, 3, "row", True, "words", 1) for i, t in TEXTS
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return awkward(spark).limit(0)


def listed(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
