import hashlib
import itertools
import json
import random
from collections import Counter

import numpy as np

from foldwise.llm import bpe, registry, shards


def test_order_is_a_keyed_permutation():
    for n in (1, 2, 3, 7, 64, 65, 1000, 4097):
        order = shards.Order(n, 5)
        s = order.slot(np.arange(n))
        assert sorted(s) == list(range(n)) and (order.index(s) == np.arange(n)).all()
    a, b = shards.Order(1000, 1).slot(np.arange(1000)), shards.Order(1000, 2).slot(np.arange(1000))
    assert (a != b).mean() > 0.9 and abs(np.corrcoef(a, np.arange(1000))[0, 1]) < 0.2


def check(spark, manifest, rows, id_col="doc_id"):
    """Every document's sequences are where its numbers and the permutation put them."""
    enc, size = bpe.encoder(bpe.default_path(), bpe.default_pattern()), manifest["length"]
    out = {r.sequence: r for r in shards.report(spark, manifest).collect()}
    n = manifest["n_sequences"]
    assert sorted(out) == sorted(r.slot for r in out.values()) == list(range(n))
    whole = {r.slot: tuple(r.ids) for r in shards.read_sequences(spark, manifest).collect()}
    stream = {k: whole[out[k].slot] for k in out}
    have, want = Counter(), Counter((i, tuple(enc.encode(t))) for i, t in rows if t)
    for r in shards.documents_of(spark, manifest).collect():
        ids, k = list(stream[r.sequence][r.place:]), r.sequence
        while manifest["end"] not in ids:
            k += 1
            ids += stream[k]
        have[(r.doc_id, tuple(ids[:ids.index(manifest["end"])]))] += 1
    assert have == want and sum(map(len, stream.values())) == sum((len(ids) + 1) * c for (_, ids), c in want.items())
    for r in out.values():
        ids = np.array(whole[r.slot], "<u2")
        assert r.sha256 == hashlib.sha256(ids.tobytes()).hexdigest() and r.n_tokens == len(ids)
        assert (r.shard, r.offset) == (r.slot // manifest["per_shard"], r.slot % manifest["per_shard"] * manifest["stride"])
    return whole


def test_shards_round_trip_and_resume(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["the", "of", "tion", "é", "xyz"]) for _ in range(rnd.randint(0, 60)))) for i in range(150)]
    rows += [(5000, None), (5001, ""), (5002, "very long " * 9000), (5003, "same row twice and again"), (5003, "same row twice and again"),
             (5004, "abc" * 4000), (5005, "a" + " " * 9000 + "b"), (None, "no id"), (None, "nor here")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, slot int, ids string").repartition(4)
    got = shards.materialise(df, path=str(tmp_path / "a"), length=16, per_shard=37, key=9)
    assert json.load(open(tmp_path / "a/manifest.json")) == got
    whole = check(spark, got, rows)
    size = [p.stat().st_size for p in sorted((tmp_path / "a").glob("*.bin"))]
    assert size[:-1] == [37 * got["stride"]] * (got["shards"] - 1) and sum(size) == got["n_sequences"] * got["stride"]
    assert not list((tmp_path / "a").glob(".shard*"))
    part = {r.slot: tuple(r.ids) for r in shards.read_sequences(spark, got, 50, 200).collect()}
    assert part == {s: whole[s] for s in range(50, 200)}


def test_no_sequences(spark, tmp_path):
    df = spark.createDataFrame([(None, ""), (1, None)], "doc_id long, text string")
    for d in (df, df.limit(0)):
        none = shards.materialise(d, path=str(tmp_path / "e"))
        assert none["n_sequences"] == none["shards"] == 0 and shards.report(spark, none).count() == shards.read_sequences(spark, none).count() == 0


def test_op8_query(spark, sf, monkeypatch):
    made = []
    write = shards.materialise
    monkeypatch.setattr(shards, "materialise", lambda *a, **k: made.append(write(*a, **k)) or made[0])
    out = registry.QUERIES["op8_training_order"](spark, sf)
    assert out.count() == made[0]["n_sequences"]
    check(spark, made[0], [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])


def test_long_runs_are_found_from_few_blocks():
    """As by measuring every run; such texts go to the linear encoder, with equal ids."""
    rnd, n = random.Random(4), shards._LONG
    found = set()
    for _ in range(2000):
        text = "".join(rnd.choice([" ", "a", " ", "é"]) * rnd.choice([1, 100, n // 2 - 1, n - 2, n - 1, n, n + 1]) for _ in range(rnd.randint(1, 6)))
        runs = [len(list(g)) for _, g in itertools.groupby(text, str.isspace)]
        if len(text) > n:
            found.add(max(runs) >= n)
            assert shards._unbroken(text) == (max(runs) >= n)
    assert found == {False, True}
    path, pattern = bpe.default_path(), bpe.default_pattern()
    for text in ("<|endoftext|> it's 12  \n\n x", "word " * 2000, "a" * n + " b" * n):
        assert shards._ids(text, path, pattern).tolist() == bpe.encoder(path, pattern).encode(text)
