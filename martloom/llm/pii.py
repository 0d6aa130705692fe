"""Personal data by anchor expansion.

One Aho-Corasick automaton finds anchors: at-signs, URL schemes, digit pairs,
dotted digits, plus signs before a digit and identifier cues. A small
deterministic parser per kind then expands each anchor to the boundaries of
the e-mail, address or account around it and validates the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOCAL = frozenset(LETTERS + DIGITS + "._%+-")
LABEL = frozenset(LETTERS + DIGITS + "-")
DIGIT = frozenset(DIGITS)
PHONE = frozenset(DIGITS + " ().-")
UPPER = frozenset(LETTERS[26:] + DIGITS)
URL_END = frozenset(" \t\n\r\x0b\x0c<>\"'`{}|\\^")
BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "iban", "key", "password")
# Schemes and identifier cues.
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
KEY_CUES = ("AKIA", "ASIA")
PASSWORD_CUES = ("password=", "passwd=", "pwd=")
IBAN_CUE = "IBAN"
COLUMNS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
Span = tuple[int, int]


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word, kind in [("@", "email"), (IBAN_CUE, "iban"), *((s, "url") for s in SCHEMES),
                       *((c, "key") for c in KEY_CUES), *((c, "password") for c in PASSWORD_CUES)]:
        a.add_word(word, (kind, len(word)))
    for d in DIGITS:
        a.add_word("+" + d, ("phone", 2))
        for e in DIGITS:
            a.add_word(d + "." + e, ("ip", 3))
            for gap in ("", " ", "-"):
                a.add_word(d + gap + e, ("card", 2 + len(gap)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _while(text: str, at: int, kind: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in kind:
        at += 1
    return at


def email_at(text: str, at: int, floor: int) -> Span | None:
    """The e-mail around the at-sign at ``at``; nothing before ``floor`` is free."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = _while(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    dotted = False
    while end < len(text) and text[end] == ".":
        label = _while(text, end + 1, LABEL)
        if label == end + 1:
            break
        end, dotted = label, True
    return (start, end) if dotted else None


def ips_in(text: str, start: int) -> tuple[list[Span], int]:
    """Addresses of the chain of dotted numbers that begins at ``start``, and its end."""
    parts, at = [], start
    while True:
        end = _while(text, at, DIGIT)
        parts.append((at, end))
        if end + 1 < len(text) and text[end] == "." and text[end + 1] in DIGIT:
            at = end + 1
        else:
            break
    found = []
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        if all(len(p := text[a:b].lstrip("0")) <= 3 and int(p or "0") <= 255 for a, b in four):
            found.append((four[0][0], four[3][1]))
    return found, parts[-1][1]


def digit_run(text: str, start: int) -> int:
    """End of the digits from ``start`` with at most one space or hyphen between two."""
    at, n = start + 1, len(text)
    while at < n:
        if text[at] in DIGIT:
            at += 1
        elif text[at] in " -" and at + 1 < n and text[at + 1] in DIGIT:
            at += 2
        else:
            break
    return at


def digits_of(text: str, span: Span) -> str:
    return "".join(c for c in text[span[0] : span[1]] if c in DIGIT)


def phone_at(text: str, at: int) -> Span | None:
    stop = _while(text, at + 2, PHONE)
    while stop > at + 3 and text[stop - 1] not in DIGIT:
        stop -= 1
    if stop <= at + 3 or text[stop - 1] not in DIGIT:
        return None
    return (at, stop) if 9 <= len(digits_of(text, (at, stop))) <= 15 else None


def iban_at(text: str, at: int) -> Span | None:
    """After the cue: country, check digits, groups; valid by the remainder modulo 97."""
    start = at
    while start < len(text) and start < at + 3 and text[start] in " :":
        start += 1
    end, chars = start, ""
    while end < len(text) and len(chars) < 34:
        if text[end] in UPPER:
            chars += text[end]
            end += 1
        elif text[end] == " " and end + 1 < len(text) and text[end + 1] in UPPER and chars:
            end += 1
        else:
            break
    if len(chars) < 15 or not (chars[:2].isalpha() and chars[2:4].isdigit()):
        return None
    return (start, end) if int("".join(str(int(c, 36)) for c in chars[4:] + chars[:4])) % 97 == 1 else None


def spans_of(text: str) -> dict[str, list[Span]]:
    """All spans by kind, each kind in order; end exclusive, in code points."""
    found: dict[str, list[Span]] = {k: [] for k in BASE + ADDED}
    done = dict.fromkeys(found, 0)
    for last, (kind, width) in automaton().iter(text):
        at = last + 1 - width
        if at < done[kind]:
            continue
        span = None
        if kind == "email":
            if span := email_at(text, at, done[kind]):
                done[kind] = span[1]
        elif kind == "ip":
            start = at
            while start > done[kind] and text[start - 1] in DIGIT:
                start -= 1
            more, done[kind] = ips_in(text, start)
            found[kind] += more
        elif kind == "card":
            done[kind] = end = digit_run(text, at)
            digits = digits_of(text, (at, end))
            if 13 <= len(digits) <= 19 and luhn(digits):
                span = (at, end)
        elif kind == "phone":
            span = phone_at(text, at)
        elif kind == "url":
            end = last + 1
            while end < len(text) and text[end] not in URL_END:
                end += 1
            while end > last + 1 and text[end - 1] in ".,;:!?)]":
                end -= 1
            done[kind] = end
            span = (at, end) if end > last + 1 else None
        elif kind == "iban":
            span = iban_at(text, last + 1)
        elif kind == "key":
            end = last + 1
            while end < len(text) and end - at <= 20 and text[end] in UPPER:
                end += 1
            free = at == 0 or text[at - 1] not in LABEL
            span = (at, end) if free and end - at == 20 and (end == len(text) or text[end] not in LABEL) else None
        else:
            end = last + 1
            while end < len(text) and text[end] not in URL_END:
                end += 1
            span = (last + 1, end) if end - last > 6 else None
        if span:
            found[kind].append(span)
            done[kind] = max(done[kind], span[1])
    return found


def joined(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def find_pii(docs: DataFrame) -> DataFrame:
    """Spans of personal data per document.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. NULL
    and empty texts have no spans; NULL ids and repeated rows are answered
    row by row; an empty table gives no rows. ``spans`` lists the four base
    kinds, then URLs, IBANs, access keys and passwords.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = spans_of(text or "")
                base = hashlib.sha256(joined(found, BASE).encode()).hexdigest()
                rows.append((doc_id, *(len(found[k]) for k in BASE), base, joined(found, BASE + ADDED)))
            if rows:
                types = [*[pa.int64()] * 5, pa.string(), pa.string()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=[c.split()[0] for c in COLUMNS.split(", ")])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(scan, COLUMNS)
