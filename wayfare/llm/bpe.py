"""Operator 6: BPE encoding and decoding as a streaming transducer.

The merge list fixes how far to the right of a token boundary the text can
still change that boundary.  :func:`sufficient_lookahead` computes a bound in
one pass over the merges; :class:`Transducer` keeps that many symbols, emits
every token that ends further to the left, and starts afresh at the last
boundary it emitted (no merge ever crosses a final boundary).  Memory is
constant however long a word is.  :class:`TextDecoder` turns ids back into text
piece by piece.

Null text counts as empty; an empty text has no tokens.  Columns other than
``doc_id`` and ``text`` are ignored; repeated rows give repeated results.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from wayfare.llm.common import documents

#: Unicode White_Space; fixed values.
SPACE = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The vocabulary's own word pattern; fixed value, from its file.
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
END = "</w>"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, running_sha256 string"
#: Words kept in a worker's memory before the table starts again.
CACHE_WORDS = 600_000


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if printable, else 256 and up in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Merges:
    """A merge list by id: vocabulary, pair ranks, and the lookahead they need."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.names = [""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for name, i in vocab.items():
            self.names[i] = name
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for name, i in self.special.items():
            self.names[i] = name
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        rules = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.pairs = {(a, b): (rank, made) for rank, (a, b, made) in reversed(list(enumerate(rules)))}
        self.ranks = {pair: rank for pair, (rank, _) in self.pairs.items()}
        self.made = [made for _, _, made in rules]
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + END] for s in symbols]
        self.size = [len(n.removesuffix(END)) for n in self.names]
        self.longest = max(self.size)
        self.lookahead = sufficient_lookahead(rules, self.size)
        back = {s: b for b, s in enumerate(symbols)}
        self.raw = [bytes(back[c] for c in n.removesuffix(END)) + (b" " if n.endswith(END) else b"") if i not in self.special.values() else n.encode() for i, n in enumerate(self.names)]

    def merge(self, ids: list[int]) -> list[int]:
        """All merges, lowest rank first and leftmost among equals."""
        if len(ids) < 64:
            rank, made, none = self.ranks.get, self.made, len(self.made)
            ranks = list(map(rank, zip(ids, ids[1:], strict=False), repeat(none)))
            while ranks and (best := min(ranks)) < none:
                i = ranks.index(best)
                ids[i : i + 2] = [made[best]]
                del ranks[i]
                if i < len(ranks):
                    ranks[i] = rank((ids[i], ids[i + 1]), none)
                if i:
                    ranks[i - 1] = rank((ids[i - 1], ids[i]), none)
            return ids
        pairs = self.pairs
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*pairs[p], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in pairs]
        heap = [(rank, i, made, p) for rank, made, i, p in heap]
        heapq.heapify(heap)
        while heap:
            _, i, made, (a, b) = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := (made, ids[k])) in pairs:
                    heapq.heappush(heap, (pairs[p][0], i, pairs[p][1], p))
            if (h := before[i]) >= 0 and (p := (ids[h], made)) in pairs:
                heapq.heappush(heap, (pairs[p][0], h, pairs[p][1], p))
        return [x for x in ids if x >= 0]


def sufficient_lookahead(rules: list[tuple[int, int, int]], size: list[int]) -> int | None:
    """How many symbols right of a token's end can matter to it; None if the list is not in making order.

    A token is disturbed from the right only by a rule of lower rank that takes
    it as its left part; that rule needs its own right part to stand, which again
    only rules of still lower rank disturb.  Ranks fall along such a chain, so one
    pass in rank order sums the longest one.
    """
    formed: dict[int, int] = {}  # reach that the making of a token needs
    taken: dict[int, int] = {}  # reach of the rules so far that take it as left part
    made = {t for _, _, t in rules}
    reach = lambda x: max(formed.get(x, 0), taken.get(x, 0))
    for a, b, t in rules:
        if a in made and a not in formed or b in made and b not in formed:
            return None
        formed.setdefault(t, max(reach(b), reach(a) - size[b], 0))
        taken[a] = max(taken.get(a, 0), size[b] + reach(b))
    return max((reach(x) for x in {*formed, *taken}), default=0)


class Transducer:
    """Encodes one word whose bytes come in pieces, holding a bounded window."""

    def __init__(self, merges: Merges, block: int = 512):
        self.merges, self.held = merges, bytearray()
        self.window = None if merges.lookahead is None else merges.lookahead + block + merges.longest

    def push(self, piece: bytes) -> Iterator[int]:
        self.held += piece
        while self.window and len(self.held) > self.window:
            inner, stable = self.merges.inner, self.window - self.merges.lookahead
            done = 0
            for token in self.merges.merge([inner[b] for b in self.held[: self.window]]):
                if (end := done + self.merges.size[token]) > stable:
                    break
                yield token
                done = end
            del self.held[:done]

    def finish(self) -> list[int]:
        m, held = self.merges, self.held
        ids = m.merge([m.inner[b] for b in held[:-1]] + [m.last[held[-1]]]) if held else []
        self.held = bytearray()
        return ids


class TextDecoder:
    """Ids to text, one piece at a time; bytes of a character may lie in several tokens."""

    def __init__(self, merges: Merges):
        self.raw, self.state = merges.raw, codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.raw.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder(dict):
    """Stretch of text without spaces -> its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        super().__init__()
        self.merges, self.words = Merges(path), {}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.merges.special)) + ")") if self.merges.special else None
        self.pattern = regex.compile(WORD)

    def __missing__(self, stretch: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
            self.words.clear()
        out, word = b"", self.words.get
        parts = self.marks.split(stretch) if any(m in stretch for m in self.merges.special) else [stretch]
        for k, part in enumerate(parts):
            if k % 2:
                out += packed([self.merges.special[part]])
            elif part:
                out += b"".join([word(w) or self.word(w) for w in self.pattern.findall(normal(part))])
        if len(stretch) <= 64:
            self[stretch] = out
        return out

    def word(self, word: str) -> bytes:
        m, raw = self.merges, word.encode()
        if len(word) > 64:
            t = Transducer(m)
            return b"".join([*(packed(list(t.push(raw[i : i + 4096]))) for i in range(0, len(raw), 4096)), packed(t.finish())])
        # a word that no window would cut
        self.words[word] = out = packed(m.merge([*map(m.inner.__getitem__, raw[:-1]), m.last[raw[-1]]]))
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, stretches(text)))


_OTHER = regex.compile("[\x1c-\x1f]")
_STRETCH = regex.compile(f"[^{SPACE}]+")


def stretches(text: str) -> list[str]:
    """Text between white space; no token crosses one."""
    return _STRETCH.findall(text) if _OTHER.search(text) else text.split()


def normal(part: str) -> str:
    part = part if part.isascii() else unicodedata.normalize("NFC", part)
    return part.replace("Σ", "σ").lower()


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def bpe_digest(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of their decoded form,
    digest of their running text.

    The vocabulary names no decoder, so its decoded form is the tokens' names
    joined by spaces; :class:`TextDecoder` gives the running text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        names = [n.encode() for n in enc.merges.names]
        for batch in batches:
            out = []
            for text in batch.column(1):
                ids = enc.encode(text.as_py() or "")
                back = np.frombuffer(ids, "<u4")
                digest, running, decoder = hashlib.sha256(), hashlib.sha256(), TextDecoder(enc.merges)
                for i in range(0, len(back), 65536):
                    some = back[i : i + 65536].tolist()
                    digest.update(b" " * (i > 0) + b" ".join(map(names.__getitem__, some)))
                    running.update(decoder.push(some).encode())
                running.update(decoder.finish().encode())
                out.append((len(back), hashlib.sha256(ids).hexdigest(), digest.hexdigest(), running.hexdigest()))
            n, a, b, c = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(c, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "running_sha256"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, SCHEMA)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_digest(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
