"""Documents with nulls, ties, repeats, empty and long texts, and columns named like internals."""

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " fp bigint, `row` string, score double, kept array<int>, spans string, lid bigint, digest bigint, `a b` map<string, int>"
)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    letters = "etaoinshrdlu"
    lines, line = [], []
    for _ in range(words):
        line.append("".join(draw.choice(letters) for _ in range(draw.randint(2, 6))))
        if draw.random() < 0.08:
            lines.append(" ".join(line))
            line = []
    return "\n".join([*lines, " ".join(line)])


def documents(spark, extra=()):
    base = prose(1, 120)
    texts = [
        (0, base),
        (1, base),
        (2, base.replace("e", "E")),
        (3, base + " tail"),
        (4, None),
        (5, ""),
        (6, " \n\t\n "),
        (7, prose(2, 9)),
        (8, prose(2, 9)),
        (8, prose(2, 9)),
        (8, prose(3, 40)),
        (None, prose(4, 40)),
        (None, prose(5, 40)),
        (None, None),
        (10, prose(6, 30_000)),
        (11, "é ñ 漢字 \U0001f600 Ωmega\x85x"),
        (12, "one"),
        (13, "a\r\nb\r\n\r\na\n"),
        *extra,
    ]
    rows = [
        (i, t, None if k % 3 else "en", f"src{k % 2}", None if k % 4 == 0 else len(t or ""), k, "r", 0.5, [k], "s", k, k, {"k": k})
        for k, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df, *columns):
    """Rows as sorted tuples."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))
