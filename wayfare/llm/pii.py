"""Operator 2: personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, digits, schemes and
identifier cues.  A local parser grows each anchor to the left and right as far as its
own grammar allows and validates what it got.  Parsers look at the anchor's
neighbourhood only, in linear time, and never retry; only an IBAN's end is tried at its
country's length, or without one at up to 20 word ends.  A social-security number stands
within 16 characters of its cue, an account number within 12, a secret (8 characters or
more, a digit among them) after the cue's colon or equals sign: that is what the kinds mean.

Kinds, in this order: email, ip, card, phone (the base kinds, leftmost and
non-overlapping per kind), then login (user and password in an address), iban,
ssn and account (a number after a cue), secret.  Places are code points, end exclusive.

Null text counts as empty; an empty text has no spans, an empty table no rows.  Texts
are read whole, however long.  Repeated rows give repeated results; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import documents

KINDS = ("email", "ip", "card", "phone", "login", "iban", "ssn", "account", "secret")
BASE = KINDS[:4]
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_other long"
#: Anchors and what they announce.
ANCHORS = {"@": "at", "+": "plus", "http://": "scheme", "https://": "scheme", "ftp://": "scheme", "iban": "iban", "ssn": "ssn", "social security": "ssn", "account": "account", "acct": "account", "konto": "account", "compte": "account", "cuenta": "account", "password": "secret", "passwd": "secret", "secret": "secret", "token": "secret", "api_key": "secret", "api-key": "secret", "apikey": "secret", **dict.fromkeys("0123456789", "digit")}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++){3,}+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_LOGIN = re.compile(r"[A-Za-z0-9._%+-]++:[^\s@/]++@")
_DIGITS = re.compile(r"[0-9]+")
_SECRET = re.compile(r"""["']?[ \t]*[:=][ \t]*["']?([^\s"',;<>]{8,})""")
_IBAN = re.compile(r"[\s:#.]{0,4}((?:no|nr|number)?[\s:#.]{0,4})([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30})")
_ALNUM = re.compile(r"[A-Za-z0-9]")
_SSN = re.compile(r"[^0-9\n]{0,16}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"[^0-9\n]{0,12}([0-9][0-9 -]{4,24}[0-9])(?![0-9])")
#: Lengths of the IBANs of the countries in the registry.
_IBAN_LENGTHS = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def iban_holds(found: str) -> bool:
    s = found.replace(" ", "").upper()
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def iban_end(text: str, start: int, most: int) -> int | None:
    """Where the IBAN at ``start`` ends, at ``most`` or before.

    Words may follow it.  It has its country's length; for other countries the
    longest run of whole words whose checksum holds counts.
    """
    ends = [k + 1 for k in range(start, most) if text[k] != " "]
    length = _IBAN_LENGTHS.get(text[start : start + 2].upper())
    tries = ends[14:][::-1] if length is None else ends[length - 1 : length]
    return next((e for e in tries if not _ALNUM.match(text, e) and iban_holds(text[start:e])), None)


@lru_cache(1)
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word, kind in ANCHORS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def folded(text: str) -> str:
    """Lower case, letter by letter, in the same number of code points."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign ``at``, starting no earlier than ``floor``."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    found = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, found.end()) if found else None


def chain_at(text: str, at: int) -> tuple[int, list[tuple[int, int, str]]]:
    """Where the dotted chain of numbers (or the digits) at ``at`` ends, and its addresses of four parts."""
    m, out = _CHAIN.match(text, at), []
    if not m:
        return _DIGITS.match(text, at).end(), out
    parts = m.group().split(".")
    for k in range(0, len(parts) - 3, 4):
        end = at + len(".".join(parts[k : k + 4]))
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts[k : k + 4]):
            out.append((at, end, "ip"))
        at = end + 1
    return m.end(), out


def card_at(text: str, at: int) -> tuple[int, list[tuple[int, int, str]]]:
    """Where the digits at ``at``, with single spaces or dashes among them, end, and whether they are a card number."""
    m = _CARD.match(text, at)
    if not m:
        return at + 1, []
    digits = m.group().replace(" ", "").replace("-", "")
    return m.end(), [(*m.span(), "card")] if 14 <= len(digits) <= 19 and luhn(digits) else []


def find(text: str) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind), by start, then kind as listed."""
    out: list[tuple[int, int, str]] = []
    floor = chain = card = 0
    cues: dict[str, int] = {}
    for last, (size, kind) in automaton().iter(folded(text)):
        at = last - size + 1
        if kind == "at":
            if span := email_at(text, at, floor):
                out.append((*span, "email"))
                floor = span[1]
        elif kind == "plus":
            if m := _PHONE.match(text, at):
                end = m.end()
                while not text[end - 1].isdigit():
                    end -= 1
                if end - at >= 4 and 10 <= sum(c.isdigit() for c in text[at:end]) <= 15:
                    out.append((at, end, "phone"))
        elif kind == "digit":
            if at >= chain:
                chain, found = chain_at(text, at)
                out += found
            if at >= card:
                card, found = card_at(text, at)
                out += found
        elif kind == "scheme":
            if m := _LOGIN.match(text, last + 1):
                out.append((last + 1, m.end() - 1, "login"))
        else:
            # a cue inside what an earlier one of its kind has looked at to the end says nothing new
            if last + 1 < cues.get(kind, 0):
                continue
            m = {"iban": _IBAN, "ssn": _SSN, "account": _ACCOUNT, "secret": _SECRET}[kind].match(text, last + 1)
            if m and kind == "secret" and not _DIGITS.search(m[1]):
                cues[kind] = m.end()
                continue
            if m:
                span = m.span(m.lastindex)
                if kind == "iban":
                    end = iban_end(text, *span)
                    if end is None:
                        continue
                    span = (span[0], end)
                cues[kind] = span[1]
                out.append((*span, kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def digest(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(1):
                spans = find(text.as_py() or "")
                base = [s for s in spans if s[2] in BASE]
                n = [sum(s[2] == k for s in spans) for k in BASE]
                rows.append((*n, hashlib.sha256(digest(base).encode()).hexdigest(), digest(spans), len(spans) - len(base)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, cols, kinds)], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_other"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def masked(text: str) -> str:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    out, done = [], 0
    for start, end, kind in find(text):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir))
