"""Licence scan, personal data, BPE and packing against brute force."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wayfare.llm.bpe import Encoder, TextDecoder, Transducer, bpe_digest
from wayfare.llm.licenses import BASE, RARE, SPDX, TEMPLATES, Index, document_frequencies, licence_words, scan_licences, words_of
from wayfare.llm.packing import library_words, pack
from wayfare.llm.pii import BASE as PII_BASE
from wayfare.llm.pii import find, find_pii, luhn, masked

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", "   ", "Hello, World's don't 12 <|endoftext|>!!", "a" * 5000 + "!" * 3000, "Ünï İ Σας\x1c　x", "mail a.b@c.de@f.gh x@y +1 (743) 555-3824 4111 1111 1111 1111 10.0.0.1.2 300.1.1.1 1.2.3.4.5.6.7.8", "Licensed under CC BY-NC 4.0. All rights reserved. All Rights Reserved", "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License."]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    noise = ["".join(rng.choices("ab@.+-:09 15()cC\nby reserved", k=rng.randint(1, 200))) for _ in range(60)]
    rows = [(i, t, "x", i) for i, t in enumerate(TEXTS + noise)] + [(None, "null id", "x", 1), (3, TEXTS[3], "x", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, start long").repartition(3)


def by_text(docs, out):
    key = docs.select("doc_id", "text").distinct()
    return [(r.text or "", r) for r in out.join(key, out.doc_id.eqNullSafe(key.doc_id)).collect()]


def test_licences(docs):
    for text, r in by_text(docs, scan_licences(docs)):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
        at = [(i, label) for phrase, label in BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert r.first_word == min((i for i, _ in at), default=None) and r.last_word == max((i for i, _ in at), default=None)
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        if text == "Released under the MIT License.":
            assert (r.labels, r.score) == ("mit", 1.0)


def plain_pii(text):
    """The base kinds by regular expressions."""
    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(*m.span(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        out += [(*m.span(), "card")] * (14 <= len(digits) <= 19 and luhn(digits))
    out += [(*m.span(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], PII_BASE.index(s[2])))


def test_pii(docs):
    rng = random.Random(5)
    for k in range(3000):
        text = "".join(rng.choices("0123456789..++@@- ()aZé", k=rng.randint(0, 60)))
        assert [s for s in find(text) if s[2] in PII_BASE] == plain_pii(text), text
    for text, r in by_text(docs, find_pii(docs)):
        want = ",".join(f"{k}:{s}:{e}" for s, e, k in plain_pii(text))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert r.n_email == want.count("email") and r.n_ip == want.count("ip") and r.n_card == want.count("card") and r.n_phone == want.count("phone")
    assert masked("to a@b.cd, iban DE89 3704 0044 0532 0130 00") == "to [EMAIL], iban [IBAN]"
    assert find("http://me:pw@host ssn: 123-45-6789 account no 12345678") == [(7, 12, "login"), (23, 34, "ssn"), (46, 54, "account")]


def test_iban_with_words_after_it():
    for iban in ("DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "gb82 west 1234 5698 7654 32", "NO9386011117947", "MT84MALT011000012345MTLCAST001S", "ZZ22 3704 0044 0532 0130 00"):
        for before in ("iban ", "IBAN no: "):
            for after in ("", ".", " for payment today", " and call", " a", " 1 2 3", "\nfor payment", " for payment by the twentieth of the month"):
                assert find(before + iban + after)[:1] == [(len(before), len(before + iban), "iban")], iban + after
                assert masked(before + iban + after) == before + "[IBAN]" + after
    assert not [s for s in find("iban DE89370400440532013001 for payment today, iban DE8937040044053201300 0x") if s[2] == "iban"]


def test_bpe_matches_the_library(docs):
    lib, own = Tokenizer.from_file(PATH), Encoder(PATH)
    rng = random.Random(1)
    letters = [chr(c) for c in range(32, 127)] + list("äöüßéΣσςİ́\x1c\x1f\x85　\n\t12中国😀") + ["<|endoftext|>", "'s", "'LL", "  "]
    for _ in range(400):
        text = "".join(rng.choices(letters, k=rng.randint(0, 80)))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text
    for text, r in by_text(docs, bpe_digest(docs, PATH)):
        ids = lib.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_running_text(spark):
    rows = [(0, "one two, three"), (1, "äöß 中国😀 x"), (2, ""), (3, "a " * 70000), (4, None)]
    want = {0: "one two , three ", 1: "äöß 中国 😀 x ", 2: "", 3: "a " * 70000, 4: ""}
    got = {r.doc_id: r.running_sha256 for r in bpe_digest(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()}
    assert got == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in want.items()}


def test_bpe_streams_in_constant_memory():
    m = Encoder(PATH).merges
    word = "".join(random.Random(2).choices("abcdetinghx", k=20000)).encode()
    t, got, most = Transducer(m), [], 0
    for i in range(0, len(word), 100):
        got += t.push(word[i : i + 100])
        most = max(most, len(t.held))
    got += t.finish()
    assert got == m.merge([m.inner[b] for b in word[:-1]] + [m.last[word[-1]]]) and most <= t.window
    d = TextDecoder(m)
    assert "".join([*(d.push([x]) for x in got), d.finish()]) == word.decode() + " "


def test_packing(docs):
    lib = Tokenizer.from_file(PATH)
    rows = by_text(docs, pack(docs, PATH, limit=64))
    seen = {}
    for text, r in rows:
        ids = [*lib.encode(text, add_special_tokens=False).ids, 2]
        assert r.doc_tokens == len(ids) and r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 64
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        seen.setdefault((r.doc_id, r.doc_tokens), set()).update(range(r.start, r.start + r.length))
    assert all(s == set(range(n)) for (_, n), s in seen.items())
    assert len({r.sequence_id for _, r in rows}) == len({(r.sequence_id, r.length) for _, r in rows}) == len(rows)
    assert pack(docs.limit(0), PATH).count() == 0


def test_workers_keep_no_words_after_packing(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = spark.range(0, 4000, 1, 8).selectExpr("id doc_id", "concat('word', id, ' other', id * 7) text")
    assert pack(texts, path).agg({"length": "sum"}).first()[0] > 8000

    def held(batches):
        for _ in batches:
            words = library_words(path)
            yield pa.RecordBatch.from_arrays([pa.array([len(words) + len(words.words)])], ["n"])

    assert {r.n for r in spark.range(0, 8, 1, 8).mapInArrow(held, "n long").collect()} == {0}


def test_pii_anchors_and_long_values(spark):
    secret = "k" * 5000 + "1"
    assert find(f"ftp://{'u' * 400}:{'p' * 3000}@host") == [(6, 6 + 400 + 1 + 3000, "login")]
    assert find(f'token = "{secret}" password: hunter22, token = words api_key=12345') == [(9, 9 + len(secret), "secret"), (9 + len(secret) + 12, 9 + len(secret) + 20, "secret")]
    assert find("x1.2.3.4.5.6.7.256 and 4111-1111 1111 1111.") == [(1, 8, "ip"), (23, 42, "card")]
    long = ("word 12 " * 200_000) + "a@b.org 10.0.0.1"
    assert [k for _, _, k in find(long)] == ["email", "ip"]
    docs = spark.createDataFrame([(1, long, "x")], "doc_id long, text string, spans string")
    assert find_pii(docs).first().n_ip == 1
    for empty in (find_pii(docs.limit(0)), scan_licences(docs.limit(0)), bpe_digest(docs.limit(0), public_tokenizers.path("word_bpe_49k.json"))):
        assert empty.count() == 0


def test_pii_takes_linear_time():
    """Lines of cues and anchors that never come to a match, a million characters each; quadratic work would take hours."""
    for unit in ("token=", "password: ", "secret='", "tokentoken:", "iban ", "iban DE", "ssn ", "account 1", "http://", "http://a:", "a@", "+1 ", "+1(", "1 ", "1.", "1-", "%@", "api-key:x"):
        began = time.process_time()
        find(unit * (1_000_000 // len(unit)))
        assert time.process_time() - began < 10, unit
    began = time.process_time()
    assert find("token=" * 200_000) == [] and time.process_time() - began < 1
    assert find("token=" * 2000 + "x1") == [(6, 12002, "secret")]
    assert find("secret=abcdtoken = hunter22") == [(19, 27, "secret")]


def test_licence_labels(spark):
    texts = {"// SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: Apache-2.0": "apache-2.0", "This is free and unencumbered software released into the public domain.": "unlicense", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "isc", "the MIT of licence words": "", "made available under the terms of the Eclipse Public License 2.0": "epl-2.0"}
    texts |= {"MIT License": "mit", "MIT License\n\nCopyright (c) 2020 Jane": "mit", "LGPL v3": "lgpl", "SPDX-License-Identifier: BSD-2-Clause": "bsd", "CC0 1.0 Universal": "cc0-1.0", "GNU Affero General Public License": "agpl-3.0,gpl"}
    texts |= {"// SPDX-License-Identifier: Apache-2.0 OR MIT": "apache-2.0,mit", "SPDX-License-Identifier: (Foo-1.1 AND ISC) OR GPL-2.0-only WITH Classpath-exception": "gpl-2.0,isc", "SPDX-License-Identifier: none\nread this or mit": "mit", "SPDX-License-Identifier: Other": ""}
    texts |= {"you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License": "gpl,gpl-3.0", "the license of mit and others": "", "under a licence: boost software license": "bsl-1.0"}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.labels for r in scan_licences(docs).collect()} == dict(enumerate(texts.values()))


def plain_labels(text, frequency):
    """Labels and places by the method's definition, for every template and every place of the text.

    A template is at a place if each of its key phrases stands where the place says, give or take two words, and half
    or more of the (at most five) rarest words that the text has of the template do.
    """
    words, out = words_of(text), set()
    near = lambda at, phrase: any(p >= 0 and words[p : p + len(phrase)] == phrase for p in range(at - 2, at + 3))
    for label, full, keys in TEMPLATES:
        full, keys = full.encode().split(), [k.encode().split() for k in keys]
        if not set(sum(keys, [])) <= set(words):
            continue
        rarest = sorted(set(full) & set(words), key=lambda w: (frequency.get(w, 0), w))[:5]
        first = [next(i for i in range(len(full)) if full[i : i + len(k)] == k) for k in keys]
        spots = [(p, i) for p, w in enumerate(words) if w in rarest for i, x in enumerate(full) if x == w]
        for at in {p - i for p, i in spots}:
            agree = sum(-2 <= p - i - at <= 2 for p, i in spots)
            if 2 * agree >= len(rarest) and all(near(at + i, k) for i, k in zip(first, keys, strict=True)):
                found = {label} if label else expression(words, max(at, 0))
                out |= {(x, max(at, 0)) for x in found}
    return out


def expression(words, at):
    """Identifiers after the licence lines that start within two words of ``at``, by a walk over joins."""
    out, line = set(), b"spdx license identifier".split()
    for p in range(max(at - 2, 0), at + 3):
        rest = words[p + 3 :] if words[p : p + 3] == line else None
        while rest is not None:
            text = b" ".join(rest) + b" "
            out |= {label for name, label in SPDX.items() if text.startswith(name.encode() + b" ")}
            joins = [i for i, w in enumerate(rest[:6]) if w in (b"or", b"and", b"with")]
            rest = rest[joins[0] + 1 :] if joins else None
    return out


def test_licence_labels_by_brute_force(spark):
    rng, texts = random.Random(11), [None, "", "word " * 300_000 + "Released under the MIT License."]
    for _ in range(300):  # licence texts with words lost, added and changed, several in one file
        parts = []
        for _, full, _ in rng.sample(TEMPLATES, rng.randint(1, 3)):
            words = [w for w in full.split() if rng.random() > 0.03]
            words.insert(rng.randint(0, len(words)), "other") if rng.random() < 0.3 else None
            parts += [*rng.choices(licence_words(), k=rng.randint(0, 5)), *words]
        texts.append(" ".join(parts))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, labels string").repartition(4)
    frequency = document_frequencies(docs)
    assert frequency == {w.encode(): n for w in licence_words() if (n := sum(w.encode() in words_of(t) for t in texts))}
    found = {r.doc_id: set(filter(None, r.places.split(","))) for r in scan_licences(docs).collect()}
    assert found == {i: {f"{label}:{at}" for label, at in plain_labels(t, frequency)} for i, t in enumerate(texts)}
    assert sum(map(len, found.values())) > 300


def test_rare_words_are_the_file_s_own():
    index = Index.build({w.encode(): i for i, w in enumerate(licence_words())})
    text = next(t for label, t, _ in TEMPLATES if label == "isc").encode().split()
    everything, less = index.rare_words(set(text)), index.rare_words(set(text) - {b"appear", b"all", b"above"})
    t = next(i for i, x in enumerate(index.templates) if x.label == "isc")
    of = lambda places: {w for w, at in places.items() if any(k == t for k, _ in at)}
    assert len(of(everything)) == len(of(less)) == RARE and of(everything) != of(less)
