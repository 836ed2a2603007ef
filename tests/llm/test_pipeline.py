"""The pipeline, stage by stage, against brute force on its own input."""

import os
import sys
from collections import Counter
from itertools import groupby

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
import corpus_pipeline as p  # noqa: E402
from test_similarity import plain_components  # noqa: E402

from wayfare.llm.common import BATCH, ROWS, documents, slices, small_batches, store  # noqa: E402
from wayfare.llm.pii import masked  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain_cut(texts, length=p.substrings.PASSAGE_BYTES):
    """Repeated byte strings of the length; runs of over 50 words, or of 400 bytes, go."""
    seen = Counter(t[i : i + length] for t in texts.values() for i in range(len(t) - length + 1))
    out = {}
    for d, t in texts.items():
        mark = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        kept, at = [], 0
        for gone, run in groupby(mark):
            run = t[at : (at := at + len(list(run)))]
            if not gone or len(run) < 400 and len(run.split()) <= 50:
                kept.append(run)
        out[d] = b"".join(kept)
    return out


def test_stages(spark):
    docs = documents(spark, SF)
    columns = docs.columns
    seen = [docs.collect()]
    for name, stage in p.STAGES[:-1]:
        docs = store(stage(spark, docs, SF), name)
        assert docs.columns == columns
        seen.append(docs.collect())
    raw, good, single, cut, clean = ({r.doc_id: r.text for r in rows} for rows in seen)
    assert 0.6 * len(raw) < len(good) < len(raw) and all(raw[d] == t for d, t in good.items())
    groups = plain_components(list(good.items()), 80)
    assert single == {d: t for d, t in good.items() if groups[d][2]}
    assert set(cut) == set(single)
    for d, left in plain_cut({d: t.encode() for d, t in single.items()}).items():
        assert cut[d] == left.decode(errors="ignore")
    assert sum(cut[d] != t for d, t in single.items()) > 5
    assert clean == {d: masked(t) for d, t in cut.items()}
    assert all(r.n_chars == len(r.text) for r in seen[-1])
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = p.STAGES[-1][1](spark, docs, SF).collect()
    tokens = {d: len(lib.encode(t, add_special_tokens=False).ids) + 1 for d, t in clean.items()}
    assert {r.doc_id: r.doc_tokens for r in pieces} == tokens
    assert sum(r.length for r in pieces) == sum(tokens.values())
    assert p.run(spark, SF).count() == len(pieces)


def odd_documents(spark):
    """Nulls, repeats, an own id for rows of one text, a very long text, and columns with the operators' names."""
    whole = documents(spark, SF).select("doc_id", "text", "n_chars")
    rows = whole.union(whole.limit(5))
    extra = spark.createDataFrame([(None, "no id, " * 30, None), (900001, None, None), (900002, "", 0), (900003, " \n", 2), (900004, "word soup " * 150_000, 1), (900005, "tie of words here now", 1), (900006, "tie of words here now", 1)], rows.schema)
    names = ("text_hash", "spans", "k_text", "k_doc", "k_hash", "g", "row", "made", "start", "length", "sequence_id", "component_id")
    return rows.union(extra).select("*", *(F.lit(n).alias(n) for n in names))


def test_stages_on_odd_tables(spark):
    docs = odd_documents(spark)
    for name, stage in p.STAGES[:-1]:
        before = docs.count()
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        assert out.where("text_hash <> 'text_hash' or spans <> 'spans' or g <> 'g' or `row` <> 'row'").count() == 0
        docs = store(out, name)
        assert 0 < docs.count() <= before and (name in ("quality", "neardup") or docs.count() == before)
    texts = [r.text for r in docs.collect()]
    assert texts.count("tie of words here now") <= 1
    pieces = p.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert pieces.where("length > 4096").count() == 0


def test_stages_on_an_empty_table(spark):
    docs = documents(spark, SF).limit(0)
    for name, stage in p.STAGES[:-1]:
        docs = store(stage(spark, docs, SF), name)
        assert docs.count() == 0
    assert p.STAGES[-1][1](spark, docs, SF).count() == 0


def test_stages_without_labels_keep_all(spark, tmp_path):
    documents(spark, SF).limit(20).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert p.good_quality(spark, documents(spark, str(tmp_path)), str(tmp_path)).count() == 20


def test_stages_hand_few_rows_to_python(spark, monkeypatch):
    """Stored tables of the middle stages are made from small batches, and the session's own setting comes back."""
    before, seen, plain = spark.conf.get(BATCH), [], p.substrings.store
    for module in (p.neardup, p.substrings):
        monkeypatch.setattr(module, "store", lambda df, label: (seen.append(int(spark.conf.get(BATCH))), plain(df, label))[1])
    docs = documents(spark, SF)
    p.without_near_duplicates(spark, docs, SF)
    p.without_repeats(spark, docs, SF)
    assert max(seen) == ROWS and spark.conf.get(BATCH) == before
    spark.conf.set(BATCH, "100")
    try:
        with small_batches(spark):
            assert spark.conf.get(BATCH) == "100"
    finally:
        spark.conf.unset(BATCH)
    batch = docs.select("doc_id").toArrow().to_batches()[0]
    assert [x for b in slices([batch], 7) for x in b.column(0).to_pylist()] == batch.column(0).to_pylist()
