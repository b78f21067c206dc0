"""Language-model scoring with a hashed maximum-entropy model.

Tokens are the white-space separated words of the text (A-Z lower-cased)
and one end token.  Two scores come from one pass:

* base: add-one-half unigrams with the counts of all training documents;
* model: ``P(class | history) * P(token | class, history)``.  The class softmax
  sums hashed feature weights of the previous token, the previous two, and the
  token before the previous one (skip).  Frequent tokens are a class each, the
  others share classes by ending.  The tokens of such a class are the leaves of
  a binary tree, placed by their hashes: every step down is a maximum-entropy
  choice with the same three features, hashed with the tree's node, beside the
  log ratio of the counts below.  A tree has about as many leaves as its class
  has tokens (``DEPTH`` steps at most); tokens that share a leaf, and one unseen
  token, share its probability by their smoothed counts.

Counts cover all training documents.  Training is one pass of mini-batch
gradient updates in every task over its own rows, started from the class
frequencies; the weights are averaged by how often a task used them
(``epochs`` repeats that from the average).

Scale: the vocabulary grows with the corpus, so it is never sent whole.
At most ``hot`` tokens can occur at least ``N / hot`` times; those are
broadcast (hash and count, ``hot`` * 16 bytes) and looked up in sorted
arrays, the rest is joined in Spark.  Tokens are identified by their 64-bit
xxHash; among a billion distinct tokens 0.03 pairs are expected to collide.

Defined cases: a null text is empty: one end token.  No training document:
N = V = 0, every count is 0 and the class weights are 0.  Repeated rows are
scored, and counted, one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import written

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CACHE = 500_000
#: classes: the end token and the most frequent words one each, then endings
CLASSES, OWN = 32, 16
#: rows of the weight table, and how many of them travel together
BUCKETS, BLOCK = 1 << 14, 64
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
#: steps of a class's tree at most, weights of the tree's features, tokens of an update
DEPTH, SLOTS, STEP = 16, 1 << 19, 1 << 13
END = b""


def tokens(text: str | None) -> list[bytes]:
    out = text.encode().translate(_LOWER).split() if text else []
    out.append(END)
    return out


def words(texts) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(words of all texts in a row as numbers of distinct ones, tokens per text with
    the end): :func:`tokens` of many texts at once."""
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, at = lists.values, lists.offsets.to_numpy()
    full = pc.greater(pc.binary_length(flat), 0)   # spaces at a text's ends leave empty strings
    count = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])[at]
    return flat.filter(full).dictionary_encode(), np.diff(count) + 1


def token_hash(token: bytes) -> int:
    return xxhash.xxh64_intdigest(token)


class Hashes(dict):
    """Token -> its number; hashes and classes by ending lie in arrays by number."""

    def __init__(self):
        super().__init__()
        self.hash, self.ending = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.new: list[bytes] = []
        self.by_end: dict[bytes, int] = {}

    def settle(self) -> None:
        """Bring the arrays up to the tokens numbered since the last call."""
        if self.new:
            h = np.array([token_hash(t) for t in self.new], np.uint64)
            ends = [t[-2:] for t in self.new]
            for t in set(ends) - self.by_end.keys():   # two bytes: 65,793 endings at most
                self.by_end[t] = token_hash(t) % (CLASSES - OWN)
            e = np.fromiter(map(self.by_end.__getitem__, ends), np.int64, len(ends)) + OWN
            self.hash, self.ending = np.concatenate([self.hash, h]), np.concatenate([self.ending, e])
            self.new = []

    def numbers(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(number of every token in a row, tokens per text)."""
        if len(self) > _CACHE:
            self.clear()
            self.hash, self.ending = self.hash[:0], self.ending[:0]
        found, sizes = words(texts)
        own = [*found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist(), END]
        self.new = [t for t in own if t not in self]
        self.update(zip(self.new, range(len(self), len(self) + len(self.new))))
        number = np.fromiter(map(self.__getitem__, own), np.int64, len(own))
        out, inner = np.full(sizes.sum(), number[-1]), np.ones(sizes.sum(), bool)
        inner[np.cumsum(sizes) - 1] = False
        out[inner] = number[found.indices.to_numpy()]
        self.settle()
        return out, sizes

    def read(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, class by ending, tokens per text) of all tokens in a row."""
        k, sizes = self.numbers(texts)
        return self.hash[k], self.ending[k], sizes


class Counted(Hashes):
    """Also whether a token is hot, and the log10 of its count, found once a number."""

    def __init__(self, hash_: np.ndarray, count: np.ndarray):
        super().__init__()
        self.hot, self.count = hash_, count
        self.known, self.logs = np.zeros(0, bool), np.zeros(0)

    def settle(self) -> None:
        begin = len(self.hash)
        super().settle()
        h = self.hash[begin:]
        known, logs = np.zeros(len(h), bool), np.zeros(len(h))
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
            known = self.hot[at] == h
            logs = np.where(known, np.log10(self.count[at] + 0.5), 0.0)
        # the arrays by number start again whenever the numbers do
        self.known, self.logs = np.concatenate([self.known[:begin], known]), np.concatenate([self.logs[:begin], logs])


def _signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)


def contexts(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the three features of every token, within its own text."""
    first = np.zeros(len(h), bool)
    first[np.cumsum(sizes)[:-1]] = True
    if len(h):
        first[0] = True
    second = np.concatenate([[False], first[:-1]]) & ~first
    one = np.concatenate([[0], h[:-1]]).astype(np.uint64)
    one[first] = 1
    two = np.concatenate([[0], one[:-1]]).astype(np.uint64)
    two[first] = 2
    two[second] = 1

    def mixed(x: np.ndarray) -> np.ndarray:
        return (x ^ (x >> np.uint64(29))) * _ODD[3]

    return np.stack([mixed(one * _ODD[0]), mixed(one * _ODD[0] + two * _ODD[1] + np.uint64(7)), mixed(two * _ODD[2] + np.uint64(3))])


def buckets_of(context: np.ndarray) -> np.ndarray:
    return (context >> np.uint64(64 - 14)).astype(np.uint16)


def features(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Buckets of the three features of every token, within its own text."""
    return buckets_of(contexts(h, sizes))


class Tree:
    """The trees of all classes by ending, ``depth`` steps each: per inner node the
    log ratio of the counts below its two sides, per leaf the log10 of its count."""

    def __init__(self, depth: int, mass: np.ndarray):
        """``mass``: smoothed counts of the leaves, class by class."""
        self.depth = depth
        at = mass.reshape(CLASSES - OWN, 1 << depth).astype(np.float64)
        self.leaf = np.log10(at).astype(np.float32).ravel()
        self.prior = np.zeros((CLASSES - OWN, 1 << depth), np.float32)
        for k in range(depth - 1, -1, -1):   # a level's nodes are 2^k .. 2^(k+1)-1
            self.prior[:, 1 << k:2 << k] = np.log(at[:, 1::2] / at[:, ::2])
            at = at[:, ::2] + at[:, 1::2]
        self.prior = self.prior.ravel()

    def leaves(self, h: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """The leaf of every token of a class by ending."""
        return (cls - OWN << self.depth) + (h >> np.uint64(64 - self.depth)).astype(np.int64)

    def steps(self, leaf: np.ndarray, context: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(side taken, log odds of the right side, slots of the three features) of
        every step (rows) to every leaf."""
        d = self.depth
        leaf = leaf.astype(np.int32)
        place = (leaf & (1 << d) - 1) + (1 << d)
        down = np.arange(d, -1, -1, dtype=np.int32)[:, None]
        path = place >> down
        side = (path[1:] & 1).astype(np.float32)
        node = path[:-1]
        node += leaf >> d << d
        mixed = node.view(np.uint32) * np.uint32(0x9E3779B1)
        low = (context >> np.uint64(18)).astype(np.uint32)
        slot = np.empty((3, *node.shape), np.int64)
        z = self.prior.take(node)
        for k in range(3):
            x = mixed ^ low[k]
            x *= np.uint32(0x85EBCA6B)
            x >>= np.uint32(32 - 19)
            slot[k] = x
            z += weights.take(slot[k])
        return side, np.clip(z, -30, 30, out=z), slot


def token_logprob(tree: Tree, weights: np.ndarray, leaf: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each leaf within its class, given the history."""
    side, z, _ = tree.steps(leaf, context, weights)
    z *= 1 - 2 * side
    np.exp(z, out=z)
    z += 1
    # sixteen factors of 1 + e^30 at most
    return -np.log(np.prod(z, axis=0, dtype=np.float64))


class Classes:
    """Class of each token: its own for the frequent ones, else by ending."""

    def __init__(self, own: list[int]):
        order = np.argsort(np.array(own, np.uint64)) if own else np.zeros(0, np.int64)
        self.hash, self.number = np.array(own, np.uint64)[order], order

    def of(self, h: np.ndarray, ending: np.ndarray) -> np.ndarray:
        if not len(self.hash):
            return ending
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return np.where(self.hash[at] == h, self.number[at], ending)


_ONES = np.ones(CLASSES, np.float32)


def class_scores(buckets: np.ndarray, bias: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Summed weights of every class, kept within -60 and 60."""
    z = weights.take(buckets[0], axis=0)
    z += weights.take(buckets[1], axis=0)
    z += weights.take(buckets[2], axis=0)
    z += bias
    return np.clip(z, -60, 60, out=z)


def class_logprob(buckets: np.ndarray, cls: np.ndarray, bias: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Natural log of the softmax at each token's own class."""
    z = class_scores(buckets, bias, weights)
    own = z[np.arange(len(cls)), cls]
    return own - np.log(np.exp(z, out=z) @ _ONES)


class Trainer:
    """Weights of one task while it runs over its rows (row-wise Adagrad)."""

    def __init__(self, bias: np.ndarray, weights: np.ndarray, rate: float, tree: Tree, slots: np.ndarray):
        self.bias, self.weights, self.rate = bias, weights.copy(), rate
        # a copy would keep the unpickled dtype object, for which ufunc.at takes its slow path
        self.tree, self.slots, self.seen = tree, np.zeros(len(slots), np.float32), np.zeros(SLOTS, np.float32)
        self.slots[:] = slots
        self.square, self.used = np.full(BUCKETS, 1e-6, np.float32), np.zeros(BUCKETS, np.float32)

    def update(self, buckets: np.ndarray, cls: np.ndarray) -> None:
        g = class_scores(buckets, self.bias, self.weights)
        np.exp(g, out=g)
        g /= (g @ _ONES)[:, None]
        g[np.arange(len(cls)), cls] -= 1
        for row in buckets:
            order = np.argsort(row, kind="stable")
            keys = row[order]
            begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            n = np.diff(np.append(begin, len(keys)))
            u = keys[begin].astype(np.int64)
            # sums per bucket; most have one or two tokens and need no reduction
            total = g.take(order.take(begin), axis=0)
            two = np.flatnonzero(n == 2)
            total[two] += g.take(order.take(begin[two] + 1), axis=0)
            many = np.flatnonzero(n > 2)
            if len(many):
                total[many] = np.add.reduceat(g.take(order[np.repeat(n > 2, n)], axis=0), np.cumsum(n[many]) - n[many], axis=0)
            self.square[u] += np.einsum("ij,ij->i", total, total)
            self.weights[u] -= (self.rate / np.sqrt(self.square[u]))[:, None] * total
            self.used[u] += n.astype(np.float32)


    def update_tree(self, leaf: np.ndarray, context: np.ndarray) -> None:
        """One update of the steps to the tokens' leaves, slot by slot (Adagrad)."""
        side, z, slot = self.tree.steps(leaf, context, self.slots)
        g = 1 / (1 + np.exp(-z)) - side
        g, square = g.ravel(), (g * g).ravel()
        slot = slot.reshape(3, -1)
        for at in slot:
            np.add.at(self.seen, at, square)
        g *= np.float32(self.rate)
        for at in slot:
            root = self.seen.take(at)
            root += 1
            np.subtract.at(self.slots, at, g / np.sqrt(root, out=root))


class Lookup:
    """What the scoring tasks get: hot counts, class sizes and weights."""

    def __init__(self, hash_: np.ndarray, count: np.ndarray, classes: Classes, size: np.ndarray, bias, weights, n: int, v: int, tree: Tree, slots):
        order = np.argsort(hash_)
        self.hash, self.count, self.classes = hash_[order], count[order], classes
        self.size, self.bias, self.weights, self.n, self.v = size, bias, weights, n, v
        self.tree, self.slots = tree, slots


class Model:
    """A trained model: ``counts`` (hash, c) in Spark, the bounded rest here."""

    def __init__(self, counts: DataFrame, least: int, lookup: Lookup):
        self.counts, self.least, self.lookup = counts, least, lookup


def token_counts(docs: DataFrame, text: str) -> DataFrame:
    """(h, e, c): hash, class by ending and count of every token of all texts;
    counted in the tasks first, then by hash."""
    from foldwise.llm.bpe import slices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = Hashes(), np.zeros(0, np.int64)

        def emit():
            seen.settle()
            return pa.RecordBatch.from_arrays([pa.array(_signed(seen.hash)), pa.array(seen.ending.astype(np.int32)), pa.array(total)], ["h", "e", "c"])
        for b in batches:
            for part in slices(b, "_text"):
                if len(seen) > _CACHE:
                    yield emit()
                    seen, total = Hashes(), np.zeros(0, np.int64)
                n = np.bincount(seen.numbers(part.column("_text"))[0], minlength=len(seen))
                n[:len(total)] += total
                total = n
        if len(seen):
            yield emit()

    return (docs.select(F.col(text).alias("_text")).mapInArrow(run, "h bigint, e int, c bigint")
            .groupBy("h").agg(F.max("e").alias("e"), F.sum("c").alias("c")))


def train(docs: DataFrame, text: str = "text", hot: int = 1_000_000, epochs: int = 1, rate: float = 0.1) -> Model:
    """Counts over all of ``docs`` and class weights trained on all of it."""
    counts = written(token_counts(docs, text), "lm-counts")
    n, v = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    n, v = n or 0, v or 0
    least = max(1, -(-n // hot))
    end = int(_signed(np.array([token_hash(END)], np.uint64))[0])
    top = [r.h for r in counts.where(F.col("h") != end).orderBy(F.desc("c"), "h").limit(OWN - 1).collect()]
    own = [int(np.array([h], np.int64).view(np.uint64)[0]) for h in [end, *top]]
    classes = Classes(own)
    number = F.col("e")
    for k, h in enumerate([end, *top]):
        number = F.when(F.col("h") == h, k).otherwise(number)
    size, mass = np.full(CLASSES, 0.5), np.full(CLASSES, 0.5)
    for r in counts.groupBy(number.alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        size[r.k] += r.c + 0.5 * r.n
        mass[r.k] += r.c
    bias = np.log(mass / mass.sum()).astype(np.float32)
    weights = np.zeros((BUCKETS, CLASSES), np.float32)
    depth = min(DEPTH, max(1, int(np.ceil(np.log2(max(1, v) / (CLASSES - OWN))))))
    mass = np.full((CLASSES - OWN) << depth, 0.5)
    # at most 2^(4 + DEPTH) leaves, whatever the vocabulary
    leaf = F.shiftleft(number - OWN, depth) + F.shiftrightunsigned("h", 64 - depth)
    part = counts.where(number >= OWN).groupBy(leaf.alias("leaf")).agg(F.sum(F.col("c") + 0.5).alias("m")).toArrow()
    mass[part.column("leaf").to_numpy()] += part.column("m").to_numpy()
    tree, slots = Tree(depth, mass), np.zeros(SLOTS, np.float32)
    for _ in range(epochs if n else 0):
        weights, slots = _epoch(docs, text, classes, bias, weights, rate, tree, slots)
    table = counts.where(F.col("c") >= least).select("h", "c").toArrow()
    look = Lookup(table.column("h").to_numpy().view(np.uint64), table.column("c").to_numpy(), classes, size, bias, weights, n, v, tree, slots)
    return Model(counts, least, look)


def _epoch(docs: DataFrame, text: str, classes: Classes, bias, weights, rate: float, tree: Tree, slots) -> tuple[np.ndarray, np.ndarray]:
    """One pass of updates over all training texts; the tasks' weights, averaged
    by use, come back in blocks (the tables' sizes are constants)."""
    from foldwise.llm.bpe import slices
    sent = docs.sparkSession.sparkContext.broadcast((classes, bias, weights, rate, tree, slots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, bias, weights, rate, tree, slots = sent.value
        seen, trainer = Hashes(), Trainer(bias, weights, rate, tree, slots)
        for b in batches:
            for part in slices(b, "_text", 2 << 20):
                h, ending, sizes = seen.read(part.column("_text"))
                x, c = contexts(h, sizes), classes.of(h, ending)
                f = buckets_of(x)
                for i in range(0, len(h), STEP):
                    trainer.update(f[:, i:i + STEP], c[i:i + STEP])
                tail = np.flatnonzero(c >= OWN)
                leaf = tree.leaves(h[tail], c[tail])
                for i in range(0, len(tail), STEP):
                    trainer.update_tree(leaf[i:i + STEP], x[:, tail[i:i + STEP]])
        key, data, used = [], [], []
        for k in range(0, BUCKETS, BLOCK):
            n = trainer.used[k:k + BLOCK]
            if n.any():
                key.append(k)
                data.append((trainer.weights[k:k + BLOCK] * n[:, None]).tobytes())
                used.append(n.tobytes())
        # the tree's weights follow as keys from BUCKETS on, in half precision
        for k in range(0, SLOTS, BLOCK * CLASSES):
            n = np.minimum(trainer.seen[k:k + BLOCK * CLASSES], 60_000).astype(np.float16)
            if n.any():
                key.append(BUCKETS + k)
                data.append(trainer.slots[k:k + BLOCK * CLASSES].astype(np.float16).tobytes())
                used.append(n.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), pa.array(data, pa.binary()), pa.array(used, pa.binary())], ["k", "w", "n"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, n = np.zeros(BLOCK * CLASSES), np.zeros(BLOCK if key[0].as_py() < BUCKETS else BLOCK * CLASSES)
        for b in batches:
            for x, y in zip(b.column("w").to_pylist(), b.column("n").to_pylist()):
                if len(x) == 2 * len(w):
                    often = np.frombuffer(y, np.float16).astype(np.float32)
                    w += np.frombuffer(x, np.float16) * often
                    n += often
                    continue
                w += np.frombuffer(x, np.float32)
                n += np.frombuffer(y, np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([w.astype(np.float32).tobytes()], pa.binary()),
                                          pa.array([n.astype(np.float32).tobytes()], pa.binary())], ["k", "w", "n"])

    # summed in two steps, so no task meets what all tasks have sent
    shape = "k int, w binary, n binary"
    rows = (docs.select(F.col(text).alias("_text")).mapInArrow(run, shape)
            .groupBy("k", F.pmod(F.spark_partition_id(), F.lit(32)).alias("s")).applyInArrow(add, shape)
            .groupBy("k").applyInArrow(add, shape).collect())
    out, slots = weights.copy(), slots.copy()
    for r in rows:
        n = np.frombuffer(bytes(r.n), np.float32)
        if r.k >= BUCKETS:
            at, w = r.k - BUCKETS, np.frombuffer(bytes(r.w), np.float32)
            slots[at:at + len(n)][n > 0] = w[n > 0] / n[n > 0]
            continue
        mean = np.frombuffer(bytes(r.w), np.float32).reshape(BLOCK, CLASSES) / np.maximum(n, 1)[:, None]
        out[r.k:r.k + BLOCK][n > 0] = mean[n > 0]
    return out, slots


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every document with ``n_tokens``, ``n_known`` (tokens with a count),
    ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities); of the
    input the columns ``keep`` (all by default) stay, but for those that bear one
    of these names."""
    from foldwise.llm.bpe import slices
    from pyspark.sql import types as T

    made = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    look = model.lookup
    sent = docs.sparkSession.sparkContext.broadcast(look)
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([base.schema["_row"]]
                          + [T.StructField(c, T.LongType()) for c in ("_tokens", "_hot")]
                          + [T.StructField(c, T.DoubleType()) for c in ("_log", "_class")] + [T.StructField("_cold", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        seen, log_size = Counted(m.hash, m.count), np.log10(m.size)
        for b in batches:
            for part in slices(b, "_text", 2 << 20):
                number, sizes = seen.numbers(part.column("_text"))
                h = seen.hash[number]
                x, c = contexts(h, sizes), m.classes.of(h, seen.ending[number])
                f = buckets_of(x)
                cls = np.empty(len(h))
                for i in range(0, len(h), STEP):
                    cls[i:i + STEP] = class_logprob(f[:, i:i + STEP], c[i:i + STEP], m.bias, m.weights) / np.log(10)
                tail = np.flatnonzero(c >= OWN)
                leaf = m.tree.leaves(h[tail], c[tail])
                for i in range(0, len(tail), STEP):
                    cls[tail[i:i + STEP]] += token_logprob(m.tree, m.slots, leaf[i:i + STEP], x[:, tail[i:i + STEP]]) / np.log(10)
                cls[tail] -= m.tree.leaf[leaf]
                cls[c < OWN] -= log_size[c[c < OWN]]
                known, logs = seen.known[number], seen.logs[number]
                begin = np.cumsum(sizes) - sizes
                cold = pa.array(_signed(h[~known]))
                ends = np.concatenate([[0], np.cumsum(np.add.reduceat((~known).astype(np.int64), begin))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), pa.array(sizes), pa.array(np.add.reduceat(known.astype(np.int64), begin)),
                     pa.array(np.add.reduceat(logs, begin)), pa.array(np.add.reduceat(cls, begin)),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), cold)], schema.names)

    first = written(base.mapInArrow(run, schema).withColumn("_rid", F.monotonically_increasing_id()), "lm-scored")
    rare = model.counts.where(F.col("c") < model.least).select("h", "c")
    cold = (first.select("_rid", F.explode("_cold").alias("h")).join(rare, "h", "left")
            .groupBy("_rid").agg(F.count("c").alias("_n"), F.sum(F.log10(F.coalesce(F.col("c"), F.lit(0)) + 0.5)).alias("_l")))
    norm = float(np.log10(look.n + 0.5 * (look.v + 1)))
    logs = F.col("_log") + F.coalesce(F.col("_l"), F.lit(0.0))
    return (first.drop("_cold").join(cold, "_rid", "left")
            .select("_row.*", F.col("_tokens").alias("n_tokens"), (F.col("_hot") + F.coalesce(F.col("_n"), F.lit(0))).alias("n_known"),
                    F.lit(look.n).cast("bigint").alias("train_tokens"), (logs - F.col("_tokens") * F.lit(norm)).alias("base_score"),
                    (logs + F.col("_class")).alias("score")))


def held_out(id_col: str = "doc_id"):
    """Kept out of the training: crc32 of the id's text leaves 1 when divided by
    5 (a null id: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))
