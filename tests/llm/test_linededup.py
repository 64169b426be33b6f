import random

from awkward import documents, empty, plain, prose

from pairloom.llm import linededup


def words(line):
    return frozenset(line.lower().replace("\t", " ").replace("\r", " ").split(" ")) - {""}


def by_rule(rows):
    """Texts with every line removed that an earlier line matches, all pairs of lines looked at."""
    lines = [(i, n, words(x)) for i, t in rows if t is not None for n, x in enumerate(t.split("\n"))]
    gone = set()
    for k, (i, n, s) in enumerate(lines):
        if s and any(o and 9 * len(s & o) >= 4 * (len(s) + len(o)) for j, m, o in lines if (j, m) < (i, n)):
            gone.add((i, n))
    return [
        (i, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)) for i, t in rows
    ]


def near_lines(seed, lines):
    draw = random.Random(seed)
    common = [f"w{k}" for k in range(12)]
    seeds = [[draw.choice(common) if draw.random() < 0.5 else f"r{draw.randrange(400)}" for _ in range(draw.randint(1, 40))] for _ in range(12)]
    out = []
    for _ in range(lines):
        line = list(draw.choice(seeds))
        for _ in range(draw.choice([0, 0, 1, 2, 4, 8])):
            line[draw.randrange(len(line))] = f"n{draw.randrange(99)}"
        if draw.random() < 0.3:
            line = line[: max(1, int(len(line) * draw.uniform(0.7, 1)))]
        out.append(("  " if draw.random() < 0.1 else " ").join(line))
    return out


def test_matches_all_pairs(spark):
    rows = [(d, "\n".join(near_lines(d, 30) + ["", " \t"])) for d in range(12)]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert plain(got, "doc_id", "text") == sorted(by_rule(rows))


def test_many_near_copies_are_settled_by_one_each(spark):
    base = prose(7, 30).replace("\n", " ").split()
    rows = [(d, " ".join([*base[: d % 30], f"x{d}", *base[d % 30 + 1 :]])) for d in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = dict(plain(linededup.dedup_lines(docs), "doc_id", "text"))
    assert got == dict(by_rule(rows))


def test_lines_keep_an_f_at_their_ends(spark):
    rows = [(1, "are for all of these\nf\n\f\ncliff of"), (2, "for all of these\nf\n \f \nclif of\no")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = dict(plain(linededup.dedup_lines(docs), "doc_id", "text"))
    assert got == {1: rows[0][1], 2: " \f \nclif of\no"}


def test_awkward_documents(spark):
    docs = documents(spark)
    got = linededup.dedup_lines(docs, count_col="gone")
    assert got.columns == [*docs.columns, "gone"]
    assert linededup.dedup_lines(docs).schema == docs.schema
    rows = got.collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in rows if r.doc_id != 8 and r.doc_id is not None}
    assert texts[4] is None and texts[5] == "" and texts[6] == " \n\t\n "
    assert texts[1] == "" and texts[12] == "one"
    assert texts[13] == "a\r\nb\r\n\r\n"  # of the two lines of one word the first
    assert [r.gone for r in rows if r.doc_id == 1] == [documents(spark).filter("doc_id = 1").first().text.count("\n") + 1]


def test_no_documents(spark):
    assert linededup.dedup_lines(empty(spark)).count() == 0
