"""Small tables with every awkward case: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977} and" for i in range(9_000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # columns whose names the operators use inside
    "key long, size long, shard int, fp long, bin long, h long, y int, score double, spans string, w string, quality_score string"
)


def rows():
    texts = [
        (1, "The plain text of a note.\nReleased under the MIT License.\nMore of the same plain text here."),
        (2, None),
        (3, ""),
        (4, "   \n\t  "),
        (5, LONG),
        (6, LONG + " tail"),
        (7, "The plain text of a note.\nReleased under the MIT License.\nMore of the same plain text here."),
        (7, "The plain text of a note.\nReleased under the MIT License.\nMore of the same plain text here."),
        (8, "a" * 450),
        (9, "x" + "a" * 130 + "y" + "a" * 130),
        (10, "Éêüß ñandú 12345 %%% \u0000 \U0001f600 ok"),
        (None, "A row without an id has a text of its own."),
        (None, None),
        (11, "one"),
        (12, "one two"),
    ]
    return [
        (d, t, None if i % 4 == 0 else ("en" if i % 2 else "de"), None, None, 1, 2, 3, 4, 5, 6, 7, 8.0, "s", "w", "q")
        for i, (d, t) in enumerate(texts)
    ]


def table(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark):
    got = [(1, 1, 0), (3, 0, 0), (4, 0, 1), (5, 1, 0), (6, 1, None), (8, 0, 1), (9, 0, 0), (None, 1, 1), (9, 1, 0), (99, None, 1)]
    return spark.createDataFrame(got, "doc_id long, quality int, toxic int")
