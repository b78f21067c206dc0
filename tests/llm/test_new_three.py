"""Fingerprints (op11), conversation repair (op12), token alignment (op13)
against brute-force versions."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from foldwise.llm import align, fingerprint, registry, repair


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# ------------------------------------------------------------------ op11
def flat_likeness(a, b):
    """All pieces of both trees at once, no branch skipped."""
    x, y = (Counter(p for s in f.split(";")[1:] for q in s.split("|") for p in q.split(",")) for f in (a, b))
    weight = lambda c: sum(n * int(p.split(":")[1]) for p, n in c.items())
    total = weight(x) + weight(y)
    return 2 * weight(x & y) / total if total else float(a == b)


def brute11(docs):
    docs = sorted(docs, key=lambda r: (r[0] is not None, r[0]))
    out = {}
    for k, (key, text) in enumerate(docs):
        text, after = text or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        prints = [fingerprint.fingerprint(t) for t in (text, edited, after)]
        near = [1.0 if prints[0] == p else flat_likeness(prints[0], p) for p in prints[1:]]
        out[key] = (len(text), sha(edited), prints[0], prints[1], *near)
    return out


def same11(got, want):
    assert len(got) == len(want)
    for r in got:
        assert r[1:5] == want[r[0]][:4]
        assert r[5:] == pytest.approx(want[r[0]][4:], abs=1e-9)


def test_op11_query(spark, sf):
    docs = rows_of(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    got = rows_of(registry.QUERIES["op11_merkle_fingerprint"](spark, sf))
    same11(got, brute11(docs))
    assert np.median([r[5] for r in got]) > 0.4 and np.median([r[6] for r in got]) < 0.1


def test_op11_edges(spark):
    long = "".join(f"word{i * 7919 % 1000} " for i in range(40000))
    docs = [(None, "null id"), (1, None), (2, ""), (3, "a"), (4, "é" * 5000), (5, "x\n\n\ny\n"), (6, long), (7, long), (8, "ends\n")]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], "doc_id long, text string, _text int, fingerprint string")
    same11(rows_of(fingerprint.against_next(df.repartition(5))), brute11(docs))
    assert rows_of(fingerprint.against_next(df.limit(0))) == []
    one = rows_of(fingerprint.against_next(df.where("doc_id = 5")))
    assert one == [(5, *brute11([(5, "x\n\n\ny\n")])[5])]
    twice = rows_of(fingerprint.against_next(df.where("doc_id = 6").union(df.where("doc_id = 6"))))
    assert [r[6] for r in twice] == [1.0, 1.0]
    assert {r[2] for r in rows_of(fingerprint.fingerprints(df)) if r[0] in (1, 2)} == {fingerprint.fingerprint("")}


@settings(max_examples=150, deadline=None)
@given(st.text("ab. \né", max_size=600), st.integers(0, 600), st.integers(0, 40), st.text("xy\n", max_size=30))
def test_changes_locate_edits(text, at, cut, put):
    """Outside the spans both texts are equal, and the spans hold the edit."""
    text = text * 5
    at = min(at, len(text))
    edited = text[:at] + put + text[at + cut:]
    a, b = fingerprint.fingerprint(text), fingerprint.fingerprint(edited)
    spans = fingerprint.changes(a, b)
    i = j = 0
    for a0, a1, b0, b1 in [*spans, (len(text), len(text), len(edited), len(edited))]:
        assert text[i:a0] == edited[j:b0]
        i, j = a1, b1
    assert (a == b) == (text == edited) and bool(spans) == (text != edited)
    assert fingerprint.likeness(a, b) == pytest.approx(1.0 if a == b else flat_likeness(a, b))


@settings(max_examples=100, deadline=None)
@given(st.text("ab \né𝄞", max_size=3000))
def test_pieces_tile_the_text(text):
    data = text.encode()
    if data:
        ends, chars, last = fingerprint.pieces(data)
        parts = [data[a:b].decode() for a, b in zip([0, *ends.tolist()], ends.tolist())]
        assert "".join(parts) == text and [len(p) for p in parts] == chars.tolist()
        assert all(len(p.encode()) <= fingerprint.LONGEST + 3 for p in parts)
        assert [p.endswith("\n") for p in parts[:-1]] == last.tolist()[:-1] and last[-1]


# ------------------------------------------------------------------ op12
def plain_search(rows):
    """Cheapest, then least audit by dynamic programming over whole audits."""
    best = {(0, 0): (0, "", ())}
    n = len(rows)
    for i in range(n + 1):
        # inserts at i: at most three turn a state into itself, so three rounds settle
        for _ in range(4):
            for s in range(4):
                if (i, s) in best:
                    c, a, w = best[i, s]
                    role = ("user", "user", "assistant", "user")[s]
                    to = i, {"u": 2, "a": 3}[role[0]]
                    cand = (c + 3, a + "I", (*w, (role, "")))
                    best[to] = min(best.get(to, cand), cand)
        if i == n:
            break
        role, text, fault = rows[i]
        for s in range(4):
            if (i, s) not in best:
                continue
            c, a, w = best[i, s]
            moves = [(4, "D", s, w)]
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                may = {0: "su", 1: "u", 2: "a", 3: "u"}[s]
                if role[:1] and role[0] in may:
                    moves.append((more, "K", "_sua".index(role[0]), (*w, (role, text))))
                put = ("user", "user", "assistant", "user")[s]
                moves.append((3 + more, "R", "_sua".index(put[0]), (*w, (put, text))))
            for more, letter, to, words in moves:
                cand = (c + more, a + letter, words)
                best[i + 1, to] = min(best.get((i + 1, to), cand), cand)
    return min(best[n, s] for s in (0, 3) if (n, s) in best)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute12(original):
    groups = {r[0]: [] for r in original}
    for r in damaged(original):
        groups[r[0]].append(r[1:])
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, counts = set(), [], Counter()
        for _, role, text in rows:
            core = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        turns = [t for t, _, _ in rows if t is not None]
        cost, audit, words = plain_search(marked)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in words))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"], illegal,
                     cost, audit, sha("\n".join(f"{r}:{t}" for r, t in words)))
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def test_op12_query(spark, sf):
    rows = rows_of(spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    got = registry.QUERIES["op12_conversation_repair"](spark, sf)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: r[1:] for r in rows_of(got)} == brute12(rows)


def odd_conversations(seed, n=260):
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[rng.integers(len(xs))]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys", "Ünd"]
    texts = ["One.", "Two!", "open", " ", "", None, "Três? \n", ".", "x" * 3000]
    ids = [None, 1, 2, 2, 2, 2, 2, 5, 6, 7, 8, 9, 10, 11]
    rows = [(pick(ids), pick([None, *range(30)]), pick(roles), pick(texts)) for _ in range(n)]
    return rows + rows[:5]


@pytest.mark.parametrize("seed", range(4))
def test_op12_odd_rows(spark, seed, monkeypatch):
    """Nulls, ties, repeated rows, odd roles; conversations over several blocks
    and ranges; extra columns whose names clash."""
    monkeypatch.setattr(repair, "BLOCK", (256, 3, 7, 2)[seed])
    rows = odd_conversations(seed)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", _c int, audit string").repartition(6)
    # ranges of a few rows each
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = {r[0]: r[1:] for r in rows_of(repair.damaged_and_repaired(df))}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == brute12(rows)


def test_op12_empty_and_lost(spark):
    assert rows_of(repair.damaged_and_repaired(spark.createDataFrame([], SCHEMA))) == []
    lost = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = rows_of(repair.damaged_and_repaired(spark.createDataFrame([(lost, 0, "user", "Gone.")], SCHEMA)))
    assert got == [(lost, 0, 0, 0, 0, 0, 0, "", sha(""))]


def test_repaired_turns(spark):
    """The operator's own outputs on undamaged rows."""
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Why?"), (2, 0, "user", "A."), (2, 1, "assistant", "B.")]
    report, turns = repair.repair(spark.createDataFrame(rows, SCHEMA))
    audits = {r.conv_id: (r.cost, r.audit) for r in report.collect()}
    assert audits == {1: (6, "KIKKI"), 2: (0, "KK")}
    assert sorted(rows_of(turns.where("conv_id = 1"))) == [(1, 0, "system", "Be kind."), (1, 1, "user", ""), (1, 2, "assistant", "Hello."), (1, 3, "user", "Why?"), (1, 4, "assistant", "")]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["", "", "truncated", "blank", "duplicate"])), max_size=9))
def test_bidirectional_search(rows):
    want = plain_search([(r, "t", f) for r, f in rows])
    coded = [(r[:1], f) for r, f in rows]
    assert repair.search(coded) == want[:2]
    # any cut into two stretches gives the same way
    for k in range(len(coded) + 1):
        through = repair.chained(repair.ways(coded[:k], (0,)), repair.ways(coded[k:], ends=repair.FINAL))
        assert min(through.values()) == want[:2]


# ------------------------------------------------------------------ op13
def brute13(docs):
    """Both vocabularies by their own libraries; every end compared with every end."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(c): c for c in kept} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in kept)}
    bytes_a = lambda i: bytes(back[c] for c in a.id_to_token(i))
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    per, links = {}, Counter()
    for key, text in docs:
        ids_a, ids_b, pairs, groups = [], [], [], []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            ta, tb = [bytes_a(i) for i in ids_a], [bytes_b(i) for i in ids_b]
            if b"".join(ta) != (" " + text).encode() or b"".join(tb) != (" " + text).encode():
                ids_a, ids_b = [], []
            else:
                ends_a, ends_b = list(itertools.accumulate(map(len, ta))), list(itertools.accumulate(map(len, tb)))
                where = {e: j for j, e in enumerate(ends_b)}
                i0 = j0 = 0
                for i, e in enumerate(ends_a):
                    if e in where:
                        j = where[e]
                        pairs.append((ids_a[i], ids_b[j]))
                        groups.append(",".join(map(str, ids_a[i0:i + 1])) + "|" + ",".join(map(str, ids_b[j0:j + 1])))
                        i0, j0 = i + 1, j + 1
        per[key] = (ids_a, ids_b, pairs, groups)
        links.update(pairs)
    high = defaultdict(int)
    for (_, j), n in links.items():
        high[j] = max(high[j], n)
    return {k: (len(x), len(y), len(g), len(p), sum(links[q] == high[q[1]] for q in p), sum(links[q] for q in p), sha(";".join(g)) if x else "")
            for k, (x, y, p, g) in per.items()}


def test_op13_query(spark, sf):
    docs = rows_of(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    got = registry.QUERIES["op13_token_alignment"](spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r[0]: r[1:] for r in rows_of(got)} == brute13(docs)


def test_op13_edges(spark):
    texts = [None, "", " ", "a", "▁no tokens", "<|endoftext|> and </s><unk>", "nul\x00byte", "é𝄞 漢字 ﬁn", "  two  spaces\n\n\tand tabs ", "x" * 3000, "same", "same", "word " * 4000]
    docs = list(enumerate(texts))
    df = spark.createDataFrame([(k, t, 0, "x") for k, t in docs], "doc_id long, text string, n_a int, _id string").repartition(4)
    out = align.summary(df).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got, want = {r[0]: r[1:] for r in rows_of(out)}, brute13(docs)
    assert got == want and got[4] == (0, 0, 0, 0, 0, 0, "") and got[10] == got[11]
    assert rows_of(align.summary(df.limit(0))) == []
    for r in align.align(df).collect():
        vocab = align.vocabularies()
        x = align.Alignment(r.a_ids, r.b_ids, vocab)
        assert (x.link_a.tolist(), x.link_b.tolist()) == (r.link_a, r.link_b) and len(r.a_ids) == want[r.doc_id][0]


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 300)), st.sets(st.integers(1, 300)), st.sets(st.integers(1, 300)))
def test_diagonal_run_skipping(a, b, both):
    x, y = sorted(a | both), sorted(b | both)
    i, j = align.common_ends(np.array(x, np.int64), np.array(y, np.int64))
    want = sorted((a | both) & (b | both))
    assert [x[k] for k in i] == want and [y[k] for k in j] == want


def test_pairs_stay_below_their_bound():
    v = align.vocabularies()
    assert 0 < v.pair_bound() < 400_000 and v.a_length.min() > 0 and v.b_length.min() > 0


def test_both_libraries_of_a_agree():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    v = align.vocabularies()
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 40_000):
        texts = [f" a{c}b {c}1 {c}. {c}{c}  {c}\n{c}'s" for c in map(chr, points[k:k + 40_000])]
        ids = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
        assert ids == [v._a.encode_ordinary(x) for x in texts]


def test_types(spark, sf):
    for name in ("op11_merkle_fingerprint", "op12_conversation_repair", "op13_token_alignment"):
        df = registry.QUERIES[name](spark, sf)
        assert all(isinstance(f.dataType, (T.LongType, T.StringType, T.DoubleType)) for f in df.schema)
