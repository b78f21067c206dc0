import random
import re

import numpy as np

from foldwise.llm import decontaminate as D
from foldwise.llm import registry

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def brute(text, items, window):
    ws, hit, found = WORD.findall(lower(text)), set(), set()
    for name, t in items:
        b = WORD.findall(lower(t))
        n = min(window, len(b))
        grams = {tuple(b[o:o + n]) for o in range(len(b) - n + 1)} if b else set()
        for o in range(len(ws) - n + 1) if b else ():
            if tuple(ws[o:o + n]) in grams:
                hit |= set(range(o, o + n))
                found.add(str(name) if name is not None else "")
    return len(ws), len(hit), sorted(found)


def test_suffix_array_and_longest():
    rnd = random.Random(1)
    for _ in range(50):
        a = np.array([rnd.randint(0, 3) for _ in range(rnd.randint(0, 60))], np.int32)
        order = D.suffix_array(a, 8)
        key = [tuple(a[i:i + 8]) + (0,) * (8 - len(a[i:i + 8])) for i in order]
        assert key == sorted(key)
    words = "ab cd ef gh ij".split()
    for _ in range(40):
        texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40))) for _ in range(4)]
        block = D.Block([("x", " ".join(rnd.choice(words) for _ in range(12)))], 3)
        shard = D.Shard(texts, block)
        length, place = shard.longest(block)
        every = [w.encode() for t in texts for w in t.split() + [""]]
        for q, n, p in zip(block.query, length, place):
            want = [w for w in (list(block.vocab)[i - 1] for i in q if i)]
            best = max((next((k for k in range(len(want)) if s + k >= len(every) or every[s + k] != want[k]), len(want)) for s in range(len(every))), default=0)
            if best >= block.least:
                assert n == best and every[p:p + n] == want[:n]


def test_against_brute_force(spark):
    rnd, words = random.Random(2), "Aa b ç d 7".split()
    items = [(1, " ".join(rnd.choice(words) for _ in range(12))), (2, "b-d"), (None, "ç ç ç"), (3, None), (4, "--"), (1, "7 7 7 7")]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))), i, "s") for i in range(60)]
    docs += [(100, None, 0, None), (None, "b, d!", 0, None), (101, items[0][1] * 3000, 0, ""), (101, items[0][1], 0, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string, n_hit int, items string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    for size in (1 << 20, 10):  # one block, and many
        out = D.contamination(d, b, window=4, block_bytes=size).collect()
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r["items"], r.contaminated) for r in out)
        want = []
        for i, t, _, _ in docs:
            w, h, f = brute(t, items, 4)
            want.append((i is None, i or 0, w, h, f, h > 0))
        assert got == sorted(want)
    kept = D.remove_contaminated(d, b, window=4)
    assert kept.columns == d.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted(t or "" for _, t, _, _ in docs if not brute(t, items, 4)[1])


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in D.contamination(d, b).collect()] == [(1, 3, 0, [], False)]
    assert D.contamination(d.limit(0), b).count() == 0
    assert D.longest_matches(d, b).count() == 0


def test_longest_matches(spark):
    d = spark.createDataFrame([(1, "x a b c y"), (2, "q a b c d e z"), (3, None)], "doc_id long, text string").repartition(3)
    b = spark.createDataFrame([(9, "A b c d e f")], "item_id long, text string")
    out = {(r.item_word): (r.length, r.doc_id, r.doc_word) for r in D.longest_matches(d, b, window=3).collect()}
    assert out == {0: (5, 2, 1), 1: (4, 2, 2), 2: (3, 2, 3)}


def test_query_matches_sql(spark, duck, sf):
    df = registry.QUERIES["op9_decontamination"](spark, sf)
    res = duck.execute(registry.ORACLE["op9_decontamination"])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(tuple(r) for r in df.select(cols).collect()) == sorted(res.fetchall())


def test_block_grows_with_the_words_of_an_item():
    words = [f"w{i}" for i in range(20_000)]
    block = D.Block([("x", " ".join(words))], 10)
    assert sum(v.nbytes for v in vars(block).values() if isinstance(v, np.ndarray)) < 100 * len(words)
    place, size, item = D.Shard([" ".join(["no", *words[500:530], "no"])], block).windows(block)
    assert sorted(place) == list(range(1, 22)) and set(size) == {10} and set(item) == {0}


def test_shared_windows_are_searched_once():
    """The windows of 2,000 items that share a passage are marked once a place."""
    passage = " ".join(f"p{i}" for i in range(12))
    block = D.Block([(f"i{i}", f"a{i} {passage} z{i}") for i in range(2000)], 10)
    shard = D.Shard([f"x {passage} y"] * 300, block)
    place, size, window = shard.occurrences(block)
    assert len(place) == 3 * 300 and set(size) == {10} and len(set(window)) == 3
    got = list(shard.matches(block, 1 << 16))
    assert sum(len(item) for item, *_ in got) == 300 * 2000 and len(got) > 5
    assert all((set(start), set(length), set(place % 15)) == ({1}, {12}, {1}) for _, start, length, place in got)


def maximal(text, items, window):
    ws, out = WORD.findall(lower(text)), []
    for name, t in items:
        b = WORD.findall(lower(t))
        least = min(window, len(b))
        for p in range(len(ws)):
            for o in range(len(b)):
                if ws[p] == b[o] and not (p and o and ws[p - 1] == b[o - 1]):
                    n = 0
                    while p + n < len(ws) and o + n < len(b) and ws[p + n] == b[o + n]:
                        n += 1
                    if n >= least:
                        out.append((str(name), o, n, p))
    return out


def test_matches_against_brute_force(spark):
    rnd, words = random.Random(5), "a b c d".split()
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 14)))) for i in range(9)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))) for _ in range(25)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((i, *m) for i, t in enumerate(texts) for m in maximal(t, items, 4))
    for size in (1 << 20, 10):  # one block, and more than are chained
        got = D.matches(d, b, window=4, block_bytes=size).collect()
        assert sorted((r.doc_id, r.item_id, r.item_word, r.length, r.doc_word) for r in got) == want
        out = D.contamination(d, b, window=4, block_bytes=size).collect()
        for r in out:
            w, h, f = brute(texts[r.doc_id], items, 4)
            assert (r.n_words, r.n_hit, r["items"]) == (w, h, f)
            # the columns follow from the matches
            mine = [m for m in want if m[0] == r.doc_id]
            assert len({p for m in mine for p in range(m[4], m[4] + m[3])}) == r.n_hit and sorted({m[1] for m in mine}) == r["items"]


def test_longest_match_ties_go_to_the_smallest_id(spark):
    d = spark.createDataFrame([(i, "x a b c y") for i in (7, 3, 12)], "doc_id long, text string").repartition(3)
    b = spark.createDataFrame([(9, "a b c")], "item_id long, text string")
    assert [tuple(r) for r in D.longest_matches(d, b, window=3).collect()] == [("9", 0, 3, 3, 1)]
