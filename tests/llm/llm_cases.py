"""Texts and tables that the operators' tests share."""

ODD = ["", " ", "  ", "a  b", "foo \n \n bar  ", "x\x1c y", "\x85 z", "é ñ 123abc  ", "<|endoftext|> hi", "hi<|endoftext|>\n", "it's we're  'll", "\n\n\n  x", "日本語 テキスト", "　 x 　", "a\n\n\nb", "\nab c\n", "a \nb", "\t\t x\t \ty", "A\r\nB\r\n\r\nC", "!!" * 400 + " ok", "z" * 3000, "word " * 5000]


def words(seed, n, vocabulary=400):
    import random

    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def documents(spark, texts, ids=None, extra=True):
    """A documents table with a null text, columns of clashing names, and rows in no order."""
    rows = [(i, t, "en", f"src{(i or 0) % 3}", len(t) if t is not None else None, "x", 1) for i, t in zip(ids or range(len(texts)), texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, n int")
    return df if extra else df.drop("id", "n")
