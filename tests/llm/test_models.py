import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from foldwise.llm import langid, lm, registry


def crc(d):
    return zlib.crc32(str(d).encode()) % 5


def test_forward_sums_all_segmentations():
    path, rnd = langid.default_path(), random.Random(1)
    vocab = langid.vocabulary(path)
    probs = np.zeros((len(vocab) + 1, 2))
    probs[:-1] = np.random.default_rng(0).random((len(vocab), 2)) / 50

    def total(w):
        if not w:
            return np.ones(2)
        return sum(probs[vocab[w[:n]]] * total(w[n:]) for n in range(1, min(len(w), langid.PIECE) + 1) if w[:n] in vocab)

    words = [b" " + "".join(rnd.choice("thean é") for _ in range(rnd.randint(1, 7))).encode() for _ in range(40)]
    got = langid.loglik(words, probs, path)
    for w, g in zip(words, got):
        assert np.allclose(g, np.log(total(w)))
    # expected uses weighted by their bytes explain every byte of the words
    n = np.ones(len(words))
    e = langid.expected(words, n, probs[:, :1], path)
    length = np.array([len(b) for b in vocab])
    assert np.isclose((e * length).sum(), sum(map(len, words)))


def test_op2_held_out_accuracy_and_cases(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = registry.QUERIES["op2_language_id"](spark, sf).collect()
    assert len(out) == len(docs) and all(r.held_out == (crc(r.doc_id) == 0) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_langid_defined_cases(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de", 0.5) for i in range(60)]
    train = spark.createDataFrame(rows + [(99, None, "fr", 0.1), (98, "x", None, 0.2)], "doc_id long, text string, lang string, score double")
    model = langid.train(train)
    ask = spark.createDataFrame([(1, "the dog", 1), (1, "the dog", 1), (2, "die katze " * 20_000, 1), (3, None, 1), (4, "", 1), (None, "12 ² --", 1), (6, "DER", 1)],
                                "doc_id long, text string, score int")
    out = langid.predict(ask, model).collect()
    assert Counter((r.doc_id, r.lang_pred) for r in out) == Counter([(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (None, "und"), (6, "de")])
    none = langid.train(train.limit(0))
    assert {r.lang_pred for r in langid.predict(ask, none).collect()} == {"und"}
    assert langid.predict(ask.limit(0), model).count() == 0


def toks(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [""]


def check_base(out, texts, train, n_hot=None):
    c = Counter(w for d, t in train for w in toks(t))
    n, v = sum(c.values()), len(c)
    for r in out:
        w = toks(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)


def test_op5_counts_and_held_out_gain(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = registry.QUERIES["op5_lm_score"](spark, sf).collect()
    assert len(out) == len(texts) and all(r.held_out == (crc(r.doc_id) == 1) for r in out)
    check_base(out, texts, [(d, t) for d, t in texts.items() if crc(d) != 1])
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_rare_tokens_by_join_and_normalisation(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(rnd.choices(words, [1 / (k + 1) for k in range(60)], k=rnd.randint(0, 40))) for i in range(80)}
    texts |= {900: None, 901: "", 902: "A new WORD " * 4000}
    docs = spark.createDataFrame([(i, t, 7) for i, t in texts.items()], "doc_id long, text string, n_tokens int").repartition(3)
    model = lm.train(docs.where("doc_id < 60"), hot=5)  # nearly all tokens are joined
    out = lm.score(docs, model, keep=["doc_id"]).collect()
    check_base(out, texts, [(d, t) for d, t in texts.items() if d < 60])
    m = model.lookup
    at = np.random.default_rng(0).integers(0, lm.BUCKETS, (3, 50))
    p = sum(np.exp(lm.class_logprob(at, np.full(50, k), m.bias, m.weights)) for k in range(lm.CLASSES))
    assert np.allclose(p, 1, atol=1e-4)
    # the tokens of a class, with one unseen token, share its mass
    count = {int(np.array([r.h], np.int64).view(np.uint64)[0]): (r.c, r.e) for r in model.counts.collect()}
    h, e = np.array(list(count), np.uint64), np.array([x for _, x in count.values()])
    mass = np.bincount(m.classes.of(h, e), [c + 0.5 for c, _ in count.values()], lm.CLASSES) + 0.5
    assert np.allclose(mass, m.size)
    empty = lm.train(docs.limit(0))
    assert [(r.n_known, r.train_tokens) for r in lm.score(docs.where("doc_id = 900"), empty, keep=["doc_id"]).collect()] == [(0, 0)]
    assert lm.score(docs.limit(0), model, keep=["doc_id"]).count() == 0


def test_lm_features_stay_within_their_text():
    h = np.arange(10, 16, dtype=np.uint64)
    one, two = lm.features(h, np.array([6])), lm.features(h, np.array([2, 1, 3]))
    assert (two[:, 3:] == lm.features(h[3:], np.array([3]))).all() and (one[:, :2] == two[:, :2]).all()
    assert (two[:, 2] == two[:, 0]).all()


def test_lm_score_columns_of_any_name(spark):
    """All input columns stay, but for those that bear an output's name."""
    df = spark.createDataFrame([(1, "a b c", 7, "x", "y", "z")], ["doc_id", "text", "n_tokens", "a.b", "_row", "_cold"])
    out = lm.score(df, lm.train(df))
    assert out.columns == ["doc_id", "text", "a.b", "_row", "_cold", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    r = out.first()
    assert (r["a.b"], r["_row"], r["_cold"], r.n_tokens, r.n_known) == ("x", "y", "z", 4, 4)


def test_lm_tokens_of_a_class_see_their_context(spark):
    """The leaves of a class's tree share its probability under every history, and a
    rare token that always follows the same word is likelier there than elsewhere."""
    rnd = random.Random(8)
    rare = [f"q{i}zz" for i in range(40)]   # one ending: one class
    texts = [" ".join(f"p{k} {rare[k]}" for k in rnd.choices(range(40), k=30)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    model = lm.train(docs)
    m = model.lookup
    k = lm.OWN + lm.token_hash(b"zz") % (lm.CLASSES - lm.OWN)
    at = (k - lm.OWN << m.tree.depth) + np.arange(1 << m.tree.depth)
    for seed in range(3):
        x = np.random.default_rng(seed).integers(0, 1 << 63, (3, 1), np.uint64).repeat(len(at), 1)
        assert abs(np.exp(lm.token_logprob(m.tree, m.slots, at, x)).sum() - 1) < 1e-4
    pairs = [(0, " ".join(f"p{k} {rare[k]}" for k in range(20, 40))), (1, " ".join(f"p{k} {rare[59 - k]}" for k in range(20, 40)))]
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(pairs, "doc_id long, text string"), model).collect()}
    assert math.isclose(got[0].base_score, got[1].base_score) and got[0].score > got[1].score + 5


def test_trainer_starts_with_plain_arrays():
    """ufunc.at leaves its fast path for the dtype object of an unpickled array."""
    import pickle
    tree, slots = pickle.loads(pickle.dumps((lm.Tree(1, np.ones((lm.CLASSES - lm.OWN) << 1)), np.full(lm.SLOTS, 0.5, np.float32))))
    t = lm.Trainer(np.zeros(lm.CLASSES, np.float32), np.zeros((lm.BUCKETS, lm.CLASSES), np.float32), 0.1, tree, slots)
    assert t.slots.dtype is np.dtype(np.float32) and t.seen.dtype is np.dtype(np.float32)
    assert (t.slots == slots).all() and t.slots is not slots


def test_lm_words_of_many_texts_at_once():
    """Arrow's split equals that of one text, the end token included."""
    chars = [chr(i) for i in range(0x180)] + [" ", "　", "\U0001f600", "\xa0"] + [" "] * 60 + list("abZ") * 30
    rng = np.random.default_rng(2)
    texts = [None, "", " ", "\n\t", "a ", " a", *("".join(rng.choice(chars, 50)) for _ in range(300))]
    seen = lm.Counted(np.sort(np.array([lm.token_hash(b"a"), lm.token_hash(b"")], np.uint64)), np.array([3, 4]))
    for part in (texts[:100], texts[100:], []):
        want = [lm.tokens(t) for t in part]
        number, sizes = seen.numbers(part)
        flat = [t for w in want for t in w]
        assert sizes.tolist() == [len(w) for w in want]
        assert seen.hash[number].tolist() == [lm.token_hash(t) for t in flat]
        assert seen.ending[number].tolist() == [lm.token_hash(t[-2:]) % (lm.CLASSES - lm.OWN) + lm.OWN for t in flat]
        assert seen.known[number].tolist() == [t in (b"a", b"") for t in flat]
