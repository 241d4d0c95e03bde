"""Personal data by anchors: one automaton finds cues, small parsers expand them to spans.

An Aho-Corasick automaton passes over the lowered text once and reports at-signs, plus signs,
schemes, and words that announce an identifier (``password``, ``iban``, ``street`` …).  From each of
these a deterministic parser walks to the boundary of the address, account or secret
and validates it.  Numbers without any cue (IP addresses and cards) are anchored at
their digits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegralType

from sluice.llm.batches import slices, texts_of

Span = tuple[int, int]

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("url", "secret", "iban", "account", "address")
KINDS = BASE_KINDS + ADDED_KINDS

# Cues, lower case, by the parser that they start.
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "postgres://", "mysql://", "mongodb://", "redis://", "amqp://")
SECRET_CUES = ("password", "passwd", "pwd", "token", "secret", "api_key", "api-key", "apikey", "access_key", "private_key")
KEY_CUES = ("akia", "asia", "ghp_", "gho_", "xoxb-", "xoxp-", "sk-", "eyj", "-----begin ")
IBAN_CUES = ("iban",)
ACCOUNT_CUES = ("account", "acct", "konto", "compte", "cuenta", "ssn", "social security", "passport", "tax id")
STREET_CUES = (" street", " avenue", " road", " lane", " boulevard", "straße", "strasse", "rue ", "calle ")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match always ends where a run of digits ends, so that one can only begin at the start of a run.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SECRET = re.compile(r"['\"]?[ \t]*(?:[:=]|:=|=>|is)[ \t]*['\"]?([^\s'\",;]{6,})")
KEY = re.compile(
    r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|gh[po]_[0-9A-Za-z]{36}|xox[bp]-[0-9A-Za-z-]{10,}|sk-[0-9A-Za-z_-]{20,}"
    r"|eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}"
    r"|-----BEGIN [A-Z ]*PRIVATE KEY-----[0-9A-Za-z+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"
)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{1,4}){3,8}(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"(?:[ \t]*(?:no|nr|number|num|id|#|nummer)\.?)?[ \t]*[:=#]?[ \t]*([0-9](?:[ -]?[0-9]){5,17})(?![0-9])", re.I)
USERINFO = re.compile(r"[^\s/@:]+(?::[^\s/@]*)?@[^\s<>\"']+")
QUERY_SECRET = re.compile(r"[^\s<>\"']*?[?&;](?:token|key|password|secret|sig|auth)=[^\s<>\"'&]+", re.I)
HOUSE_BEFORE = re.compile(r"[0-9]{1,5}[a-z]?,? (?:[^\W\d_][\w'-]* ){0,3}[^\W\d_][\w'-]*\Z")
HOUSE_AFTER = re.compile(r"[^\W\d_]?[\w' -]{0,40}?,? [0-9]{1,5}[a-z]?\b")
TRIM = ".,;:!?)]}"


def luhn(digits: str) -> bool:
    """The checksum of card numbers."""
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def iban_valid(text: str) -> bool:
    """The checksum of an IBAN."""
    raw = text.replace(" ", "")
    if not 15 <= len(raw) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in raw[4:] + raw[:4])) % 97 == 1


def email_spans(text: str, anchors: list[int]) -> list[Span]:
    """Around each at-sign: the run of local characters before it and a dotted domain after it."""
    found: list[Span] = []
    end = 0
    for at in anchors:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            found.append((start, end))
    return found


def ip_spans(text: str) -> list[Span]:
    return [m.span() for m in IP.finditer(text) if all(_part(p) for p in m[0].split("."))]


def _part(digits: str) -> bool:
    kept = digits.lstrip("0")
    return len(kept) <= 3 and int(kept or 0) <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def card_spans(text: str) -> list[Span]:
    found = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(m.span())
    return found


def phone_spans(text: str, anchors: list[int]) -> list[Span]:
    """At each plus sign: digits, blanks, dots, brackets and hyphens up to the last digit."""
    found: list[Span] = []
    end = 0
    for at in anchors:
        if at >= end and (m := PHONE.match(text, at)):
            end = m.end()
            if 9 <= len(_digits(m[0])) <= 15:
                found.append(m.span())
    return found


def url_spans(text: str, anchors: list[tuple[int, int]]) -> list[Span]:
    """After a scheme: an address that carries a user's name, a password or a token."""
    found = []
    for start, end in anchors:
        if m := USERINFO.match(text, end) or QUERY_SECRET.match(text, end):
            stop = m.end()
            while text[stop - 1] in TRIM and stop > end + 1:
                stop -= 1
            found.append((start, stop))
    return found


def secret_spans(text: str, anchors: list[tuple[int, int]]) -> list[Span]:
    """After a cue and ``=`` or ``:``: a value of six characters or more that holds a digit.

    Or, where the cue begins a key of a known form, that key.
    """
    found = []
    for start, end in anchors:
        if key := KEY.match(text, start):
            found.append(key.span())
        elif (m := SECRET.match(text, end)) and any("0" <= c <= "9" for c in m[1]):
            found.append((m.start(1), m.end(1) - (len(m[1]) - len(m[1].rstrip(TRIM)))))
    return found


def iban_spans(text: str, anchors: list[tuple[int, int]]) -> list[Span]:
    """After a cue, within a few signs: an IBAN whose checksum holds."""
    found = []
    for _, end in anchors:
        m = IBAN.search(text, end, end + 60)
        if m and iban_valid(m[0]):
            found.append(m.span())
    return found


def account_spans(text: str, anchors: list[tuple[int, int]]) -> list[Span]:
    """After a cue: a number of six to eighteen digits."""
    return [m.span(1) for _, end in anchors if (m := ACCOUNT.match(text, end))]


def address_spans(text: str, anchors: list[tuple[int, int]]) -> list[Span]:
    """Around a word for a street: house number and name on either side."""
    found = []
    for start, end in anchors:
        if text[start] == " ":
            low = max(0, start - 60)
            if m := HOUSE_BEFORE.search(text[low:start]):
                found.append((low + m.start(), end))
        elif text[end - 1] == " ":
            if (start == 0 or not text[start - 1].isalnum()) and (m := HOUSE_AFTER.match(text, end)):
                found.append((start, m.end()))
        else:
            low = start
            while low > 0 and (text[low - 1].isalpha() or text[low - 1] == "-"):
                low -= 1
            if m := re.compile(r" [0-9]{1,5}[a-z]?\b").match(text, end):
                found.append((low, m.end()))
    return found


PARSERS: dict[str, tuple[tuple[str, ...], Callable[[str, list[tuple[int, int]]], list[Span]]]] = {
    "url": (SCHEMES, url_spans),
    "secret": (SECRET_CUES + KEY_CUES, secret_spans),
    "iban": (IBAN_CUES, iban_spans),
    "account": (ACCOUNT_CUES, account_spans),
    "address": (STREET_CUES, address_spans),
}


@cache
def automaton() -> ahocorasick.Automaton:
    """Finds all cues in one pass."""
    out = ahocorasick.Automaton()
    cues: dict[str, list[str]] = {"@": ["email"], "+": ["phone"]}
    for kind, (words, _) in PARSERS.items():
        for word in words:
            cues.setdefault(word, []).append(kind)
    for cue, kinds in cues.items():
        out.add_word(cue, (len(cue), kinds))
    out.make_automaton()
    return out


def _lowered(text: str) -> str:
    """Lower case of the same length, so that places stay what they are."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _apart(spans: list[Span]) -> list[Span]:
    """Spans from left to right without those that overlap an earlier one."""
    kept: list[Span] = []
    for start, end in sorted(set(spans)):
        if end > start and (not kept or kept[-1][1] <= start):
            kept.append((start, end))
    return kept


def find_spans(text: str) -> dict[str, list[Span]]:
    """Spans by kind, in code points, end exclusive; spans of unlike kinds may overlap."""
    anchors: dict[str, list[tuple[int, int]]] = {}
    for last, (length, kinds) in automaton().iter(_lowered(text)):
        for kind in kinds:
            anchors.setdefault(kind, []).append((last + 1 - length, last + 1))
    found = {
        "email": email_spans(text, [a for a, _ in anchors.get("email", [])]),
        "ip": ip_spans(text),
        "card": card_spans(text),
        "phone": phone_spans(text, [a for a, _ in anchors.get("phone", [])]),
    }
    for kind, (_, parser) in PARSERS.items():
        found[kind] = _apart(parser(text, anchors[kind])) if kind in anchors else []
    return found


def mask_text(text: str) -> str:
    """``text`` with each span replaced by its kind, as ``<EMAIL>``.

    Where spans of several kinds overlap, their union takes the kind that starts first.
    """
    marks = sorted((s, -e, k) for k, spans in find_spans(text).items() for s, e in spans)
    if not marks:
        return text
    merged: list[list] = []
    for start, end, kind in marks:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], -end)
        else:
            merged.append([start, -end, kind])
    out, at = [], 0
    for start, end, kind in merged:
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*out, text[at:]])


def _listed(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def pii_spans(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, n_<kind> for each kind, base_sha256, spans)``, a row per document.

    ``spans`` lists kind:start:end by kind and start.  A null text is an empty one and has
    none.  Null ids and repeated rows stay as they are, an empty table gives no rows, and other
    columns are not looked at.  Each text is judged alone and whole; the time is linear in
    its length but for runs of digits and separators after a plus sign.
    """
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            every = [find_spans(t) for t in texts_of(batch, "text")]
            counts = [pa.array([len(f[k]) for f in every], pa.int64()) for k in KINDS]
            digests = [hashlib.sha256(_listed(f, BASE_KINDS).encode()).hexdigest() for f in every]
            spans = [_listed(f, KINDS) for f in every]
            arrays = [batch.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    narrow = docs.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"`{text_column}` as text")
    return narrow.mapInArrow(run, schema)


def mask_documents(docs: DataFrame, *, text_column: str = "text", size_column: str | None = "n_chars") -> DataFrame:
    """All documents with their spans masked, and their number of characters set anew.

    A null text stays null, an empty one empty, and both are as many characters.  Null ids, repeated rows and all other columns
    stay as they are, a size column that is not of whole numbers too; an empty table stays empty.
    """
    has_size = size_column in docs.columns and isinstance(docs.schema[size_column].dataType, IntegralType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t if t is None else mask_text(t) for t in batch.column(text_column).to_pylist()]
            arrays = dict(zip(batch.schema.names, batch.columns, strict=True))
            arrays[text_column] = pa.array(texts, pa.string())
            if has_size:
                kind = batch.schema.field(size_column).type
                arrays[size_column] = pa.array([t if t is None else len(t) for t in texts], kind)
            yield pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    return docs.mapInArrow(run, docs.schema)
