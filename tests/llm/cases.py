"""Small document tables with the awkward cases every operator meets."""

LONG = "lorem ipsum dolor sit amet " * 8000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away.\nIt came back later that day to sleep some more.", "a"),
    (2, None, None), (3, "", "a"), (4, " \t\n ", "b"), (None, "a text without an id", "b"), (None, None, None),
    (5, "The quick brown fox jumps over the lazy dog and runs away.\nIt came back later that day to sleep some more.", "a"),
    (5, "The quick brown fox jumps over the lazy dog and runs away.\nIt came back later that day to sleep some more.", "a"),
    (6, "The  quick brown fox jumps over the lazy dog and runs away.\nIt came back later that day to sleep some more. ", None),
    (7, LONG, "c"), (8, LONG + "x", "c"), (9, "é́ İ 漢字 <|endoftext|> <|ENDOFTEXT|> \x1c\xa0 don't 's ..., !.", None),
    (10, "A\nA\nA\nB\nA\nB", "d"), (5, "another text with the same id", None),
]
SCHEMA = "doc_id long, text string, row string, print string, __id int, best int, id string, mix int, same string"


def documents(spark, rows=ROWS):
    """Columns besides id and text have the names that operators use inside."""
    return spark.createDataFrame([(i, t, s, "p", 1, 2, "i", 3, "s") for i, t, s in rows], SCHEMA)


def empty(spark):
    return documents(spark, [])


def untouched(rows) -> bool:
    """Whether all other columns still hold what documents() put there."""
    return all(tuple(r)[3:] == ("p", 1, 2, "i", 3, "s") for r in rows)
