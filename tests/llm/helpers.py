"""Small document tables with the awkward rows that every operator must take."""

from __future__ import annotations

# The columns after source have names that operators use for columns of their own.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id string, key string, "
    "row string, size string, tag string, take string, chunk string, score string, _row string, "
    "_id string, _key string, _of string, label string, task string, length string"
)
EXTRA = ("x",) * 15


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *EXTRA) for r in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


AWKWARD = [
    (1, None), (2, ""), (3, "  \t\n"), (4, "one"), (5, "one"), (5, "one"), (6, "One\ntwo. three!"),
    (None, "lost id"), (7, "é́ \U0001f600 \x00 \x85 x y " * 30), (8, "word " * 60_000),
    (8, "another text with the same id"), (9, "a,b;c d"),
]
