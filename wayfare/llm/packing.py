"""Operator 4: packing by power-of-two decomposition.

Each document's tokens (its ids, then the end id) are cut into pieces whose
lengths are powers of two, at most ``limit``: whole ``limit``s first, then the
binary digits of the rest, longest first.  Every piece is a sequence of its own,
so no sequence crosses documents and none is padded.  Pieces of equal length
share a bucket; ``sequence_id`` starts with the bucket's exponent, so a bucket's
sequences are one range of ids and batches of one shape are ranges of it.

Null text counts as empty (one piece: the end id).  Null ids stay null; repeated
rows are packed once each.  Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from wayfare.llm.bpe import WORD, byte_symbols, normal, stretches
from wayfare.llm.common import documents

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int"
#: Stretches kept in a worker's memory before the table starts again.
KEPT_STRETCHES = 700_000


def binary_lengths(n: int, limit: int) -> list[int]:
    """``n`` as whole limits, then descending powers of two."""
    whole, rest = divmod(n, limit)
    return [limit] * whole + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


class LibraryWords(dict):
    """Stretch of text without spaces -> its ids as bytes, by the tokenizers library's BPE model.

    Only what the library would do to each stretch anyway (normal form, words, byte
    symbols) happens here, once per distinct stretch and task.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        whole = Tokenizer.from_file(path)
        self.tokenize, self.words = whole.model.tokenize, {}
        self.special = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pattern, self.symbols = regex.compile(WORD), dict(enumerate(byte_symbols()))

    def __missing__(self, stretch: str) -> bytes:
        if len(self) >= KEPT_STRETCHES:
            self.clear()
            self.words.clear()
        out = b""
        for k, part in enumerate(self.marks.split(stretch) if self.marks and "<" in stretch else [stretch]):
            if k % 2:
                out += self.special[part].to_bytes(4, "little")
            elif part:
                out += b"".join([self.words.get(w) or self.word(w) for w in self.pattern.findall(normal(part))])
        if len(stretch) <= 64:
            self[stretch] = out
        return out

    def word(self, word: str) -> bytes:
        out = np.asarray([t.id for t in self.tokenize(word.encode().decode("latin-1").translate(self.symbols))], "<u4").tobytes()
        if len(word) <= 64:
            self.words[word] = out
        return out


@lru_cache(2)
def library_words(path: str) -> LibraryWords:
    return LibraryWords(path)


def pack(docs: DataFrame, path: str, end_id: int = 2, limit: int = 4096) -> DataFrame:
    """One row per piece, with its place in its document and its sequence."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = library_words(path)
        end, part = np.asarray([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        used = [0] * limit.bit_length()
        try:
            for batch in batches:
                for at in range(0, len(batch), 256):
                    few, rows = batch.slice(at, 256), []
                    for doc, text in zip(few.column(0).to_pylist(), few.column(1).to_pylist(), strict=True):
                        ids = b"".join(map(words.__getitem__, stretches(text or ""))) + end
                        total, start = len(ids) // 4, 0
                        for n in binary_lengths(total, limit):
                            k = n.bit_length() - 1
                            rows.append((doc, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), total, (k << 56) + (part << 32) + used[k], 0, k))
                            used[k] += 1
                            start += n
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 7 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"])
        finally:  # workers live on, and a later step has no use for the words
            words.clear()
            words.words.clear()

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, SCHEMA)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
