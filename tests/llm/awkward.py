"""Documents that operators must take as they come."""

LONG = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy " * 400

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, fp string, component string, "
    "size string, target string, score string, language string, key int, label int, line int, found int"
)

ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n ", None, None),
    (4, LONG, "en", "a"),
    (4, LONG, "en", "a"),
    (5, LONG.upper(), "en", "b"),
    (None, "the quick brown fox jumps over the lazy dog", "en", "b"),
    (None, None, None, None),
    (6, "the quick brown fox jumps over the lazy dog", "en", ""),
    (7, "Ünïcode straße ñandú, élan vital \U0001f600 and more \x00 text", "de", "c"),
    (8, "a", "xx", "c"),
    (9, "\n\n\n", "en", "c"),
]


def awkward(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like inner ones."""
    rows = [(*row, None, "x", "y", "z", "t", "s", "l", 1, 2, 3, 4) for row in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark):
    return awkward(spark).where("false")
