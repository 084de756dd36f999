"""Awkward rows that the tests share."""

#: Names that operators use inside; tables that have such columns must not disturb them.
CLASHING = "tid h line line_no slice first_id key word words bits keep n stay kept digest print anchor part pattern size label fold score text_sha256 _id c".split()
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
ROWS = [
    (1, "Hello there WORLD\nA line that is shared\nlast", "a"),
    (2, "hello THERE world\na LINE that is shared  \nlast", "a"),
    (3, None, "b"),
    (4, "", None),
    (5, " \n\t\n ", None),
    (6, LONG, "b"),
    (7, LONG, "a"),
    (8, f"begin {PASSAGE} end", "a"),
    (9, f"other start {PASSAGE} other end\nA line that is shared", "b"),
    (9, f"other start {PASSAGE} other end\nA line that is shared", "b"),
    (None, "a line that is shared\nof no one", "c"),
    (11, "x\ny\n" * 3000 + "A line that is shared", "c"),
    (12, f"{PASSAGE} {PASSAGE}", "c"),
    (13, "Élan É\nA LINE THAT IS SHARED", "a"),
]
