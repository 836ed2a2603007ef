"""Plain Python fingerprints to hold operator 9 against."""

import hashlib
import re

import xxhash


def x(*values):
    """64-bit hash of strings or numbers, chained, as a signed number."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else (v % (1 << 64)).to_bytes(8, "little"), h)
    return h - (1 << 64) if h >> 63 else h


def fingerprint(text):
    words = [w.encode() for w in re.split("[\x20\x09-\x0D]+", text) if w]
    h = [x(w) for w in words]
    if len(h) < 4:
        return [x(*h)] if h else []
    p = [x(a, b) for a, b in zip(h, h[1:], strict=False)]
    return sorted({x(p[i], p[i + 2]) for i in range(len(p) - 2) if min(p[i], p[i + 2]) <= p[i + 1]})[:256]


def written(marks):
    return "".join(f"{v % (1 << 64):016x}" for v in marks)


def likeness(a, b):
    union = sorted({*a, *b})[:256]
    return len({*a} & {*b} & {*union}) / len(union) if union else 1.0


def brute(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, text) in enumerate(rows):
        after, n = rows[(i + 1) % len(rows)][1] or "", len(text or "")
        edited = (text or "")[: n - n // 3] + after[: n // 3]
        a, b, c = fingerprint(text or ""), fingerprint(edited), fingerprint(after)
        out[doc] = (n, hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), likeness(a, b), likeness(a, c))
    return out
