"""Small inputs that every operator must survive."""

import random

from pyspark.sql import functions as F

WORDS = "the river and old mill turn over quiet stones while bright birds sing near tall green trees every long summer day".split()
EXTRA = ("node", "class", "kind", "score", "q", "th", "mark", "h1", "piece", "length", "__keep", "__hash", "__id", "__rank", "v", "part", "x0", "x1")


def prose(seed: int, words: int = 40) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(words))


def edge_rows() -> list[tuple[int | None, str | None]]:
    """(doc_id, text): nulls, empty and very long texts, ties, repeated rows."""
    a, b = prose(1), prose(2)
    near = a.split()
    near[5] = "other"
    line = "This line is shared by several documents here"
    long = prose(3, 30_000)
    return [
        (1, a), (2, a), (3, " ".join(near) + " " + prose(4, 60) if False else " ".join(near)), (4, b), (5, None), (6, ""), (7, "   \n\t"),
        (8, long), (9, long), (10, "x" * 100_000), (11, "9" * 50_000), (12, "Hello"), (12, "Hello"), (13, b), (13, prose(5)),
        (None, "no id but text " + prose(6)), (None, None), (None, a),
        (20, f"{line}\nfirst own line of this one\n{line}"), (21, f"  {line.upper()} \nsecond"), (22, line), (23, f"{line}\r\n\nzwölf Boxkämpfer jagen Viktor"),
        (24, "日本語のテキスト 🙂 é"), (25, "<|endoftext|> said <|endoftext|>"), (26, "a b c\x1cd\x85e"),
        (27, "mail jo@ex.org or jane [at] mail [dot] example [dot] com, 10.0.0.1, +1 (555) 123-4567, 4111 1111 1111 1111"),
    ]


def edge_docs(spark, extra: bool = True):
    """The rows with the columns of documents, and columns whose names the operators use themselves."""
    rows = [(i, t, "en" if k % 3 else None, f"src{k % 2}", None if t is None else len(t)) for k, (i, t) in enumerate(edge_rows())]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.withColumns({c: F.lit("mine") for c in EXTRA}) if extra else df


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols or df.columns).collect()), key=repr)
