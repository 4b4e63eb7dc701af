"""Rows that operators must bear, and plain versions of what they compute."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " score string, kept string, kinds int, part string, fp string"
)
LONG = "alpha beta gamma delta " * 4000 + "unique" * 3000


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated
    rows, and columns named like those operators make."""
    texts = [
        None, "", "   \n\t ", "one", "two words", LONG, "x" * 50_000,
        "a b c d e f g h", "a b c d e f g h", "Ünïcödé 漢字 😀 words",
        "line\nline\nline\n\nline", "tab\tand\x0bvertical\x0cfeed", "  nbsp",
        "nul\0byte", "<|endoftext|> </s> [INST]", "  two  spaces  ",
    ]
    rows = [
        (i, t, "en", "src1", len(t or ""), "s", "k", 1, "p", "f")
        for i, t in enumerate(texts)
    ]
    rows.append((None, "no id here", None, None, None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None, None))
    rows += [rows[4], rows[4]]
    rows.append((4, "same id, other text", "de", "src2", 3, "", "", 0, "", ""))
    return rows


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(seed, n, letters="abcdefgh"):
    rng = random.Random(seed)
    return " ".join(
        "".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n)
    )


def rows_of(df):
    return [row.asDict() for row in df.collect()]
