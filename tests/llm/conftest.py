import pytest

#: Columns whose names the operators use inside; none of them may matter.
CLASH = ["key", "n_words", "score", "size", "cls", "row", "n", "toxic", "bucket", "class", "ids", "pi", "copies", "rank", "token", "kept"]

TEXTS = [
    (0, None), (1, ""), (2, " \t\n "), (3, "word"), (4, "Ärger über ñandú, Straße № 5!"),
    (5, "the same line. " * 30 + "\n" + "the same line. " * 30), (6, "The SAME line. " * 30 + "\n" + "the same line. " * 30),
    (7, "x" * 5000 + " " + "lorem ipsum dolor " * 4000), (8, "one two three four five six seven eight nine ten"),
    (9, "one two three four five six seven eight nine ten"), (9, "one two three four five six seven eight nine ten"),
    (10, "a | b | c | d | e\nHome | About | Contact\nA real sentence stands here, with words enough to be kept."),
    (11, "日本語 の テキスト です。  x\n\n y"), (12, "<|endoftext|> <|STARTOFTEXT|> end"),
]


@pytest.fixture
def odd(spark):
    """Null, empty, long, repeated and strange texts, with a source and columns of clashing names."""
    rows = [(i, t, ["s2", "s1", None, "s10"][i % 4], ["en", "de", None][i % 3], *([0] * len(CLASH))) for i, t in TEXTS]
    schema = "doc_id long, text string, source string, lang string, " + ", ".join(f"`{c}` int" for c in CLASH)
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def none(odd):
    """The same without rows."""
    return odd.limit(0)


@pytest.fixture
def doc_table(spark, tmp_path):
    """Writes frames as the tables of a scale folder; returns its path."""
    def write(**tables):
        for name, frame in tables.items():
            frame.write.parquet(f"file://{tmp_path}/{name}.parquet")
        return f"file://{tmp_path}"

    return write
