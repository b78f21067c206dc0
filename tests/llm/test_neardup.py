import random
from collections import Counter

import numpy as np

from foldwise.llm import neardup as N
from foldwise.llm import registry
from foldwise.llm.graph import components


def shingles(t):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, min(1, len(w)))))


def similarity(a, b):
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / max(1, sum(max(a[k], b[k]) for k in keys))


def brute(rows):
    bags = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= 0.8:
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    ids = {}
    for (d, _), g in zip(rows, group):
        if d is not None:
            ids[g] = min(ids.get(g, d), d)
    return Counter((d, ids.get(g)) for (d, _), g in zip(rows, group))


def texts(rnd, groups, most):
    out = []
    for _ in range(groups):
        words = [f"v{rnd.randint(0, 400)}" for _ in range(rnd.randint(1, 150))]
        for _ in range(rnd.randint(1, most)):
            copy = list(words)
            for _ in range(rnd.randint(0, 6)):
                copy[rnd.randrange(len(copy))] = f"u{rnd.randint(0, 9999)}"
            out.append(" ".join(copy * rnd.choice([1, 1, 3])))
    return out


def test_signature_agreement_is_weighted_jaccard():
    rnd, values, wanted = random.Random(5), [], []
    for _ in range(60):
        words = [f"x{rnd.randint(0, 12)}" for _ in range(120)]
        other = words[:rnd.randint(10, 120)] + [f"x{rnd.randint(0, 12)}" for _ in range(rnd.randint(0, 60))]
        pair = [" ".join(words * 3), " ".join(other)]
        w, size = N.Words().read(pair)
        sig = N.signatures(*N.bags(w, size), 2)
        values.append((sig[0] == sig[1]).mean())
        wanted.append(similarity(*map(shingles, pair)))
        assert (sig != 0).all()
    assert abs(np.mean(np.array(values) - wanted)) < 0.01
    assert np.abs(np.array(values) - wanted).max() < 0.12


def test_bags_are_exact():
    rnd = random.Random(8)
    many = ["", None, "a", "a b c d", "a b c d e", "a a a a a a a"] + texts(rnd, 10, 2)
    doc, h, w = N.bags(*N.Words().read(many))
    for k, t in enumerate(many):
        assert sorted(w[doc == k]) == sorted(shingles(t).values())
    sim = N.similar(many)
    for i in range(len(many)):
        for j in range(len(many)):
            if i != j:
                assert abs(sim[i, j] - similarity(shingles(many[i]), shingles(many[j]))) < 1e-5


def test_classes_against_brute_force(spark, monkeypatch):
    rnd = random.Random(11)
    rows = [(100 + i, t) for i, t in enumerate(texts(rnd, 25, 6))]
    rows += [(5, rows[0][1].upper()), (None, rows[3][1]), (7, None), (8, ""), (9, " \n"), (None, None), (11, rows[8][1]), (11, rows[8][1]), (12, "short text"), (13, "Short  text")]
    rows.append((14, " ".join(f"q{i % 700}" for i in range(40_000))))
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, class_id string").repartition(3)
    want = brute(rows)
    for tile in (128, 2):  # families in one tile, and in many
        monkeypatch.setattr(N, "TILE", tile)
        out = N.classes(df).collect()
        assert Counter((r.doc_id, r.class_id) for r in out) == want
        heads = Counter(r.class_id for r in out if r.representative and r.class_id is not None)
        assert set(heads.values()) == {1} and set(heads) == {c for _, c in want if c is not None}
    kept = N.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for _, c in want if c is not None})


def test_large_group_and_empty_table(spark):
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(300):
        copy = list(base)
        copy[i] = f"z{i}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows + [(1000 + i, " ".join(base)) for i in range(200)], "doc_id long, text string")
    assert {r.class_id for r in N.classes(df).collect()} == {0}
    assert N.classes(df.limit(0)).count() == 0


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 200), rnd.randint(0, 200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 3000 + i) for i in range(50)]
    group = {}
    for a, b in edges:
        ga, gb = group.get(a, {a}) , group.get(b, {b})
        for x in (both := ga | gb):
            group[x] = both
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert set(got) == set(group) - alone
    for x in got:
        assert got[x] in group[x] and {got[y] for y in group[x]} == {got[x]}


def test_op4_query_matches_sql(spark, duck, sf):
    df = registry.QUERIES["op4_minhash_neardup"](spark, sf)
    res = duck.execute(registry.ORACLE["op4_minhash_neardup"])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(tuple(r) for r in df.select(cols).collect()) == sorted(res.fetchall())
