"""A corpus from raw documents to packed sequences, in five stages.

quality     documents that the ordinal classifier rejects go
neardup     one document of each group of near-duplicates stays
substrings  passages of over 50 words (or 400 bytes) that occur elsewhere are cut out
pii         personal data is replaced by its kind in brackets
packing     every document is cut into power-of-two sequences

Each stage works on all that its predecessor kept and returns the columns of
``documents``, but the last, which returns the pieces.  A cut may split a character;
its remaining bytes go.  ``n_chars``, if there, follows the text.  Null texts stay null;
an empty table gives no pieces; further columns, whatever their names, stay as they are.
Repeated rows, and rows of equal id and text, are one document after the second stage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wayfare.llm import neardup, packing, pii, quality, substrings
from wayfare.llm.common import documents, drop, slices, small_batches, store

#: SQL has no form for the classifier or the tokens; the stages are tested against brute force.
ORACLE_SQL = None
#: Near-duplicates are five-word shingle sets that are so many hundredths alike.
SIMILAR = 80


def rewritten(docs: DataFrame, change: Callable[..., str], found: DataFrame | None = None) -> DataFrame:
    """``docs`` with each text changed by ``change(text)``, or by ``change(text, spans)`` with the spans ``found`` for it."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs["doc_id"].alias("doc_id"), F.xxhash64(docs["text"]).alias("text_hash"))
    rows = rows.withColumn("spans", F.lit(None)) if found is None else substrings.on_doc(rows, found, "left")
    place, plain = docs.columns.index("text"), found is None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, spans = b.column(0).field(place).to_pylist(), b.column(1).to_pylist()
            made = [t if t is None or not (plain or s) else change(t) if plain else change(t, s) for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.string())], ["row", "made"])

    kinds = StructType([StructField("row", docs.schema), StructField("made", StringType())])
    out = rows.select("row", "spans").mapInArrow(run, kinds)
    length = {"n_chars": F.coalesce(F.length("made"), F.lit(0)).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return out.select(*(length[c].alias(c) if c in length else F.col("made").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with small_batches(spark):
        model = quality.train(spark, docs, sf_dir)
    return quality.select_good(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with small_batches(spark):
        return neardup.one_of_each(docs, SIMILAR)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with small_batches(spark):
        found = substrings.repeated_spans(docs, substrings.PASSAGE_BYTES)
    return rewritten(docs, lambda text, spans: substrings.cut(text.encode(), spans, substrings.is_passage)[0].decode(errors="ignore"), found)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rewritten(docs, pii.masked)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", good_quality), ("neardup", without_near_duplicates), ("substrings", without_repeats), ("pii", without_pii), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
        if last is not None:
            drop(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
