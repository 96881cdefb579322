"""Small tables of odd documents."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row string, spans string"

#: (doc_id, text): null and empty texts, white space only, ties, copies, code points beyond the basic plane.
ODD = [
    (0, None),
    (1, ""),
    (2, " \n\t "),
    (3, "One word"),
    (4, "One word"),
    (5, "the cat sat on the mat. " * 12),
    (6, "The cat sat on the mat. " * 12),
    (7, "aé\U0001f600 中文 x\n\nx\nx"),
    (9, "mail me at a.b@c.de or 192.168.0.1"),
]
LONG = [(20, "word " * 60_000), (21, "x" * 200_000)]


def frame(spark, rows, lang="en", source="s"):
    """Documents with further columns whose names the operators use themselves."""
    full = [(i, t, lang, source, None if t is None else len(t), None, "r", "s") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)
