import hashlib
import random

import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from foldwise.llm import bpe, registry

ENC = bpe.encoder(bpe.default_path(), bpe.default_pattern())
TIK = tiktoken.Encoding("own", pat_str=bpe.default_pattern(), mergeable_ranks=ENC.ranks, special_tokens={})
ODD = st.text(st.one_of(st.sampled_from(" \n\t\x1c\x85\xa0'sabct.,0९é漢́"), st.characters(exclude_categories=["Cs"])), max_size=30)


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_encode_equals_public_library(text):
    ids = ENC.encode(text)
    assert ids == TIK.encode_ordinary(text)
    assert ENC.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(ODD, ODD)
def test_append(text, added):
    assert ENC.append(text, ENC.encode(text), added) == TIK.encode_ordinary(text + added)


def test_prefixes_and_edits_follow_the_definition():
    rnd = random.Random(3)
    for _ in range(300):
        a = "".join(rnd.choice("thea in'é") for _ in range(rnd.randint(0, 50))).encode()
        i = rnd.randint(0, len(a))
        j = rnd.randint(i, len(a))
        b = "".join(rnd.choice("thea'é") for _ in range(rnd.randint(0, 5))).encode()
        state = bpe.PrefixState(ENC, a)
        assert state.tokens(i) == ENC.merged(a[:i])
        state.edit(i, j, b)
        assert state.tokens() == ENC.merged(a[:i] + b + a[j:])


def test_edit_stops_where_the_table_agrees():
    state = bpe.PrefixState(ENC, b"theinandther" * 400)
    assert state.edit(100, 101, b"x") < 300


def test_pair_follows_the_definition():
    rnd, tokens = random.Random(5), list(ENC.usable.values())
    for _ in range(5000):
        a, b = rnd.choice(tokens[:4000]), rnd.choice(tokens)
        assert ENC.pair(a, b) == (ENC.merged(ENC.bytes_of[a] + ENC.bytes_of[b]) == [a, b])


def test_rows_nulls_long_and_clashing_columns(spark):
    rows = [(1, None, "x", 7), (None, "", "y", 8), (2, "a b", None, 9), (2, "a b", None, 9), (3, "zq" * 60000 + " the" * 30000, "z", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    out = bpe.decode_documents(bpe.encode_documents(df, out="i"), ids="i", out="d").collect()
    assert len(out) == 5
    for r in out:
        assert r.i == TIK.encode_ordinary(r.text or "") and bytes(r.d) == (r.text or "").encode()
        assert "ids" in r.asDict()
    assert bpe.encode_documents(df.limit(0)).count() == 0
    more = bpe.append_documents(bpe.encode_documents(df, out="i"), "text", "i", "ids").collect()
    assert all(r.ids_appended == TIK.encode_ordinary((r.text or "") + (r.ids or "")) for r in more)


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = registry.QUERIES["op6_byte_bpe"](spark, sf).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = TIK.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_memo_tables_end_with_the_task(spark):
    """A worker that waits keeps the tokenizer, not what it has remembered."""
    ENC.encode("remembered")
    assert ENC._pieces
    ENC.forget()
    assert not (ENC._pieces or ENC._old or ENC._pairs or ENC._border) and ENC.encode("thea in é") == TIK.encode_ordinary("thea in é")
    docs = spark.createDataFrame([(i, f"zq{i}xv and k{i}w") for i in range(200)], "doc_id long, text string").repartition(4)
    assert bpe.encode_documents(docs).selectExpr("sum(size(ids))").first()[0] > 600

    def held(batches):
        import pandas as pd
        for b in batches:
            enc = bpe.encoder(bpe.default_path(), bpe.default_pattern())
            yield pd.DataFrame({"n": [sum("zq" in p for p in [*enc._pieces, *enc._old])]})

    assert spark.range(0, 4, 1, 4).mapInPandas(held, "n long").selectExpr("max(n)").first()[0] == 0
