import xxhash
from awkward import documents, empty, plain

from pairloom.llm import simhash
from pairloom.llm.components import components


def by_rule(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_awkward_documents(spark):
    docs = documents(spark)
    rows = [(r.doc_id, by_rule(r.text)) for r in docs.collect()]
    root = groups(sorted({p for _, p in rows}), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, p in rows:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    want = [(i, f"{p:016x}", least.get(root[p])) for i, p in rows]
    got = simhash.near_duplicates(docs)
    assert plain(got, "doc_id", "fingerprint", "component_id") == plain(
        spark.createDataFrame(want, got.schema), "doc_id", "fingerprint", "component_id"
    )


def test_links_join_all_that_are_near(spark):
    start = 0x123456789ABCDEF0
    chain = [start ^ ((1 << 2 * k) - 1) for k in range(20)] + [start ^ (0x7F << 50)]
    signed = [p - (1 << 64) if p >> 63 else p for p in chain]
    made = components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint")))
    root = groups(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    got = {r.node: r.root for r in made.collect()}
    assert got == {n: r for n, r in root.items() if list(root.values()).count(r) > 1}


def test_components_of_random_graphs(spark):
    import random

    draw = random.Random(3)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(5, 5), (7, 8), (8, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    pairs = {frozenset(e) for e in edges}
    nodes = sorted({n for e in edges if e[0] != e[1] for n in e})
    assert got == groups(nodes, lambda a, b: frozenset((a, b)) in pairs)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    found = {}
    for r in simhash.near_duplicates(docs).collect():
        found.setdefault(r.component_id if r.component_id is not None else r.fingerprint, []).append(r)
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(texts) == len(found)
    assert len({by_rule(t) for _, t in texts}) == len(texts)
    assert (0, documents(spark).filter("doc_id = 0").first().text) in texts
    assert sum(i == 8 for i, _ in texts) == 1  # 7 is a copy of the other two


def test_no_documents(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_one(empty(spark)).count() == 0
