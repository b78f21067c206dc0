import re
import shutil

import tiktoken

import __spark_entry__ as E
import corpus_pipeline
from foldwise.llm import bpe
from test_decontaminate import brute as hits
from test_native import base, stats
from test_neardup import brute as classes


def test_registered():
    q = E.queries()
    assert q["pipeline"] is corpus_pipeline.run and "pipeline" not in E.oracle_sql()
    for n in range(1, 11):
        assert sum(bool(re.match(rf"op{n}_", k)) for k in q) == 1


def test_stages_against_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    enc = bpe.encoder(bpe.default_path(), bpe.default_pattern())
    public = tiktoken.Encoding("own", pat_str=bpe.default_pattern(), mergeable_ranks=enc.ranks, special_tokens={})
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, sf)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        before, after = {r.doc_id: r.text for r in now.collect()}, {r.doc_id: r for r in out.collect()}
        if k < 4:
            assert out.columns == docs.columns and set(after) <= set(before)
        if k == 0:
            for d, t in before.items():
                n, _, _, _, rep = stats(t)
                if n < 50 or 100 * rep > 50 * n:
                    assert d not in after
                elif quality.get(d) == 1:
                    assert d in after
                elif quality.get(d) == 0:
                    assert d not in after
        elif k == 1:
            assert set(after) == {c for _, c in classes(list(before.items()))}
        elif k == 2:
            assert set(after) == {d for d, t in before.items() if not hits(t, items, 10)[1]}
        elif k == 3:
            assert set(after) == set(before)
            for d, t in before.items():
                assert not base(after[d].text) and after[d].n_chars == len(after[d].text)
                if not base(t) and "token" not in t:
                    assert after[d].text == t
        else:
            assert set(after) == set(before) and all(list(r.ids) == public.encode_ordinary(before[d]) for d, r in after.items())
        now = out
    whole = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, sf).collect()}
    assert whole == {d: list(r.ids) for d, r in after.items()}
    assert set(whole) < set(text)


def test_stages_on_empty_and_odd_documents(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    none = spark.createDataFrame([], docs.schema)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "ok " * 5, None, "s", None)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf).count() == 0
        assert stage(spark, odd, sf).count() <= 3
    # tables beside documents may be empty too
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    shutil.copy(f"{sf}/documents.parquet", tmp_path / "documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
