"""Small awkward inputs for the tests of the training-data operators."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FOLDER = "/root/testdata/sf0.001"
# Columns whose names are those of results or of helper columns.
CLASHING = "kept boolean, digest string, row string, score double, fp bigint, piece int, predicted int, group_size bigint, x int"

ODD_TEXTS = [
    None,
    "",
    " \t\n\x0b\f\r ",
    "one",
    "two words",
    "It's we'll DON'T 'S ''s  a.b,c!d 1234 x1y2 ²½Ⅷ",
    "tab\tnew\nline\r\nnbsp thin ideo　nel\u0085fs\x1cgs\x1dus\x1f end",
    "<|endoftext|>x<|endoftext|> <|startoftext|> <|endof text|> <|ENDOFTEXT|>",
    "café café İstanbul ΣΑΣ ẞ ﬁ Å é. ́start",
    "\U0001f600\U0001f468‍\U0001f469 你好世界 สว ال 한글 한",
    "a" * 3000,
    "ab " * 3000,
    ("long text without end. Yes, it goes on! " * 400).strip(),
    "trailing space ",
    "  two  spaces\n\n\nlines \n x",
    "$%&*#|<> symbols%%% word&&& x### | y |",
    "\x00nul\x00 \x00<|endoftext|>",
]


def odd_documents(spark: SparkSession) -> DataFrame:
    """Each odd text, one of them twice under its id, copies under other ids, a null id, null language and source, extra columns."""
    rows = [(k, t, "en" if k % 3 else None, "s" if k % 2 else None, 0) for k, t in enumerate(ODD_TEXTS)]
    rows += [rows[12], (90, ODD_TEXTS[12], "en", "s", 0), (None, "row without id", "en", "s", 0), (91, " ab" * 3000, "de", "t", 0)]
    extra = (True, "d", "r", 0.5, 1, 2, 3, 4, 5)
    return spark.createDataFrame([r + extra for r in rows], f"{SCHEMA}, {CLASHING}")


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
