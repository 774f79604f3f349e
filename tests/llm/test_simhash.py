"""Fingerprints and links against brute force."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from broadsheet.llm import simhash
from broadsheet.llm.components import connected_components


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    """Least id reachable, by comparing all pairs."""
    least = {i: i for i in prints}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                least[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog again and again"),
    (2, "THE QUICK brown fox\njumps over the lazy dog again and again"),
    (3, ""),
    (4, None),
    (5, "one two"),
    (6, "É é É"),
    (7, "\t \n"),
    (8, "word " * 3000),
    (9, "a b c\x1cd e f"),
]


def test_fingerprints_match_a_plain_count(spark):
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string")
    got = {r[0]: r[1] for r in simhash.near_duplicates(rows).select("doc_id", "fingerprint").collect()}
    assert got == {i: f"{plain_fingerprint(t):016x}" for i, t in TEXTS}


def test_groups_and_null_ids(spark):
    rows = spark.createDataFrame([*TEXTS, (None, ""), (1, TEXTS[0][1])], "doc_id long, text string")
    got = [(r[0], r[1]) for r in simhash.near_duplicates(rows).select("doc_id", "component_id").collect()]
    assert len(got) == len(TEXTS) + 2
    by_id = dict(got)
    assert by_id[1] == by_id[2] == 1
    assert by_id[4] == by_id[7] == by_id[None] == 3
    kept = simhash.drop_near_duplicates(rows.withColumns({"fp": F.lit("own"), "row": F.lit(1), "doc": F.lit(2)}))
    assert kept.columns == ["doc_id", "text", "fp", "row", "doc"]
    assert sorted(r[0] for r in kept.collect()) == [1, 3, 5, 6, 8, 9]


def test_only_null_ids_keep_one(spark):
    rows = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert simhash.drop_near_duplicates(rows).count() == 1


def test_empty_table(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(rows).count() == 0
    assert simhash.drop_near_duplicates(rows).columns == ["doc_id", "text"]


def cloud(seed, n, families):
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(families)]
    out = set()
    while len(out) < n:
        x = rnd.choice(centres)
        for _ in range(rnd.randint(0, 4)):
            x ^= 1 << rnd.randrange(64)
        out.add(x)
    return sorted(out)


UNEQUAL = [(list(range(40)), 1), (list(range(40, 64)), 0)]


@pytest.mark.parametrize("bucket,plan", [(0, None), (2, UNEQUAL), (1000, UNEQUAL), (1000, [(list(range(64)), 2)])])
def test_links_connect_exactly_what_brute_force_connects(spark, bucket, plan):
    prints = cloud(5, 300, 12)
    nodes = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    edges = simhash.links(nodes, bucket=bucket, plan=plan)
    for a, b in edges.collect():
        assert (a & (1 << 64) - 1 ^ b & (1 << 64) - 1).bit_count() <= 2
    roots = {r[0]: r[1] for r in connected_components(edges).collect()}
    got = {}
    for x in prints:
        got.setdefault(roots.get(signed(x), signed(x)), set()).add(x)
    wanted = {}
    for x, root in plain_components({x: x for x in prints}).items():
        wanted.setdefault(root, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, wanted.values()))


def test_small_buckets_list_every_pair(spark):
    prints = cloud(8, 200, 20)
    nodes = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    got = {tuple(sorted((a & (1 << 64) - 1, b & (1 << 64) - 1))) for a, b in simhash.links(nodes, bucket=10**6).collect()}
    assert got == {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2}


def test_plan_covers_the_radius_and_follows_size():
    sample = [signed(x) for x in cloud(1, 500, 500)]
    for total in (10**3, 10**6, 10**10):
        plan = simhash.plan_groups(sample, total)
        assert sum(t + 1 for _, t in plan) == 3
        assert len(set().union(*(g for g, _ in plan))) == sum(len(g) for g, _ in plan)
    assert len(simhash.plan_groups(sample, 10**3)) >= len(simhash.plan_groups(sample, 10**10))


def test_long_chain_settles(spark):
    edges = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    assert {r[0] for r in connected_components(edges).select("root").collect()} == {0}


def plain_roots(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in list(parent)}


def test_components_take_logarithmic_rounds(spark, monkeypatch):
    import random

    from broadsheet.llm import components

    rnd = random.Random(4)
    n = 10_000
    falling = [(i, i + 1) for i in range(0, 3000)][::-1]
    path = list(range(3000, 6000))
    rnd.shuffle(path)
    randomly = list(zip(path, path[1:]))
    hub = [(6000, 6001 + j * 100 + k) if k == 0 else (6001 + j * 100 + k - 1, 6001 + j * 100 + k) for j in range(39) for k in range(100)]
    extra = [(rnd.randrange(9900, n), rnd.randrange(9900, n)) for _ in range(60)] + [(n + 5, n + 5)]
    edges = falling + randomly + hub + extra
    rounds = []
    real = components.materialise
    monkeypatch.setattr(components, "materialise", lambda df: rounds.append(1) or real(df))
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components.connected_components(frame).collect()}
    assert got == plain_roots(edges)
    assert (len(rounds) - 1) / 2 <= 20
