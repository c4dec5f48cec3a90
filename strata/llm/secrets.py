"""Secrets in texts: patterns for the plain ones, structure for the encoded ones.

Three kinds are reported by their pattern alone: assignments to a telling name, access key ids
and long hexadecimal runs. For the rest a pattern only names candidates; a candidate is decoded
and reported once what it holds has the structure of a secret:

- ``signed``: a token of three parts whose header is JSON naming a known signature algorithm,
  whose payload is JSON and whose signature has the length of that algorithm;
- ``key``: base64, armoured or bare, and ``hexkey``: hexadecimal, that is a private key: nested
  lengths that fill each other to the byte, in the order of one of the key encodings.

Each text is looked at whole, in the task that reads it; nothing is shuffled.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds, in the order in which spans of one start are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "signed", "key", "hexkey")

# The plain patterns, with the least length of what has to be long.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_LEAST_VALUE = 6
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_LEAST_ACCESS = 20
# Runs end where their characters end, so looking for long ones only finds the same.
_HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = ("passw", "secret", "token", "apikey", "api_key")

# Candidates. The first bytes of JSON objects and of DER sequences show in base64.
_SIGNED = re.compile(
    r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+(?![A-Za-z0-9_-])"
)
_ARMOURED = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----([A-Za-z0-9+/=\s]+)-----END \1-----")
_BARE = re.compile(r"(?<![A-Za-z0-9+/])(?:M[A-I]|b3Bl)[A-Za-z0-9+/]{38,}={0,2}(?![A-Za-z0-9+/=])")
_HEX_EITHER = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{46,}(?![0-9A-Fa-f])")

# Bytes of a signature by algorithm; RSA signatures are as long as their modulus,
# which has 1,024 to 65,536 bits.
_SIGNATURE = {
    "HS256": 32, "HS384": 48, "HS512": 64,
    "ES256": 64, "ES384": 96, "ES512": 132, "ES256K": 64, "EdDSA": 64,
}
_RSA = {"RS256", "RS384", "RS512", "PS256", "PS384", "PS512"}
_LEAST_MODULUS, _MOST_MODULUS = 128, 8192

# Tags of DER and the magic of the other key encoding.
_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30
_OPENSSH = b"openssh-key-v1\x00"


class Span(NamedTuple):
    """A secret: code points from ``start``, before ``end``."""

    kind: str
    start: int
    end: int
    detail: str


# --- structure --------------------------------------------------------------------------


def der_children(body: memoryview) -> list[tuple[int, memoryview]] | None:
    """(tag, content) of the values that fill ``body`` to the byte; None if none do."""
    found, at = [], 0
    while at < len(body):
        if at + 2 > len(body):
            return None
        tag, length, at = body[at], body[at + 1], at + 2
        if length & 0x80:
            more = length & 0x7F
            if not 1 <= more <= 4 or at + more > len(body):
                return None
            length, at = int.from_bytes(body[at : at + more]), at + more
            if length < 0x80:
                return None
        if at + length > len(body):
            return None
        found.append((tag, body[at : at + length]))
        at += length
    return found


def private_key(raw: bytes) -> str | None:
    """Which encoding of a private key ``raw`` is, if any."""
    if raw.startswith(_OPENSSH):
        return "openssh" if _is_openssh(memoryview(raw)[len(_OPENSSH) :]) else None
    outer = der_children(memoryview(raw))
    if outer is None or [t for t, _ in outer] != [_SEQUENCE]:
        return None
    parts = der_children(outer[0][1])
    if not parts:
        return None
    tags, first = [t for t, _ in parts], bytes(parts[0][1])
    if len(tags) in (9, 10) and set(tags[:9]) == {_INTEGER}:
        if len(parts[1][1]) > _MOST_MODULUS:
            return None
        modulus, prime, other = (int.from_bytes(parts[i][1]) for i in (1, 4, 5))
        return "pkcs1" if first in (b"\0", b"\1") and modulus == prime * other else None
    if tags == [_INTEGER] * 6 and first == b"\0":
        return "dsa"
    if tags[:2] == [_INTEGER, _OCTETS] and first == b"\1" and set(tags[2:]) <= {0xA0, 0xA1}:
        return "sec1" if 16 <= len(parts[1][1]) <= 66 else None
    if tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS] and set(tags[3:]) <= {0xA0, 0xA1, 0x81}:
        return "pkcs8" if first in (b"\0", b"\1") and _is_algorithm(parts[1][1]) else None
    if tags == [_SEQUENCE, _OCTETS] and len(parts[1][1]) >= 16:
        return "pkcs8 encrypted" if _is_algorithm(parts[0][1]) else None
    return None


def _is_algorithm(body: memoryview) -> bool:
    parts = der_children(body)
    return bool(parts) and parts[0][0] == _OID and len(parts) <= 2 and len(parts[0][1]) >= 3


def _strings(body: memoryview, count: int) -> tuple[list[memoryview], memoryview] | None:
    """``count`` strings with four bytes of length in front, and what follows them."""
    found = []
    for _ in range(count):
        length = int.from_bytes(body[:4])
        if len(body) < 4 + length or len(body) < 4:
            return None
        found.append(body[4 : 4 + length])
        body = body[4 + length :]
    return found, body


def _is_openssh(body: memoryview) -> bool:
    """Cipher, derivation, its options, the number of keys, each public one, the private ones."""
    head = _strings(body, 3)
    if head is None or not head[0][0] or len(head[1]) < 4:
        return False
    keys = int.from_bytes(head[1][:4])
    if not 1 <= keys <= len(body) // 4:
        return False
    tail = _strings(head[1][4:], keys + 1)
    if tail is None or len(tail[1]):
        return False
    return all(_strings(k, 2) is not None for k in tail[0][:-1]) and len(tail[0][-1]) >= 8


def _base64(text: str, alphabet: bytes | None = None) -> bytes | None:
    """Bytes of base64 with or without its padding; None where it is none."""
    text = text.rstrip("=")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), alphabet, validate=True)
    except binascii.Error:
        return None


def signed_token(token: str) -> str | None:
    """The algorithm of a signed token whose three parts agree with each other, else None."""
    head, payload, signature = (_base64(p, b"-_") for p in token.split("."))
    if head is None or payload is None or signature is None:
        return None
    try:
        header, claims = json.loads(head), json.loads(payload)
    except (ValueError, RecursionError):
        return None
    if not isinstance(header, dict) or not isinstance(claims, dict):
        return None
    name = header.get("alg")
    if not isinstance(name, str):
        return None
    if name in _RSA:
        return name if len(signature) >= _LEAST_MODULUS else None
    return name if _SIGNATURE.get(name) == len(signature) else None


# --- scanning ---------------------------------------------------------------------------


def base_spans(text: str) -> Iterator[Span]:
    """What the plain patterns match, left to right and without overlap within a kind."""
    low = text.lower()
    if any(n in low for n in _NAMES):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= _LEAST_VALUE:
                yield Span("assign", *m.span(), m[1].lower())
    for m in _ACCESS.finditer(text):
        if m.end() - m.start() >= _LEAST_ACCESS:
            yield Span("access", *m.span(), "")
    for m in _HEX.finditer(text):
        yield Span("hex", *m.span(), f"{m.end() - m.start()} digits")


def confirmed_spans(text: str) -> Iterator[Span]:
    """Candidates that decode to what they claim to be."""
    if ".e" in text:
        for m in _SIGNED.finditer(text):
            if name := signed_token(m[0]):
                yield Span("signed", *m.span(), name)
    armoured = []
    if "-----BEGIN " in text:
        for m in _ARMOURED.finditer(text):
            raw = _base64(re.sub(r"\s", "", m[2]))
            if raw and (name := private_key(raw)):
                armoured.append(m.span())
                yield Span("key", *m.span(), name)
    for m in _BARE.finditer(text):
        if any(a <= m.start() < b for a, b in armoured):
            continue
        raw = _base64(m[0])
        if raw and (name := private_key(raw)):
            yield Span("key", *m.span(), name)
    for m in _HEX_EITHER.finditer(text):
        if len(m[0]) % 2 == 0 and (name := private_key(bytes.fromhex(m[0]))):
            yield Span("hexkey", *m.span(), name)


def scan(text: str) -> list[Span]:
    """All spans by start, then kind as listed in ``KINDS``, then end."""
    found = [*base_spans(text), *confirmed_spans(text)]
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


_SPANS = "array<struct<kind: string, start: long, end: long, detail: string>>"
_SPANS_ARROW = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("detail", pa.string())]
    )
)


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, secrets): the spans of every row of ``docs`` (doc_id, text), with the algorithm,
    encoding or name found.

    A missing or empty text has none. Repeated rows and rows without doc_id are scanned each.
    Other columns are ignored; an empty table gives no rows.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[s._asdict() for s in scan(t.as_py() or "")] for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found, _SPANS_ARROW)], ["doc_id", "secrets"]
            )

    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return texts.mapInArrow(find, f"doc_id long, secrets {_SPANS}")


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """(doc_id, text) with ``mask`` in place of each secret; overlapping ones become one."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else _masked(t, mask) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return texts.mapInArrow(clean, "doc_id long, text string")


def _masked(text: str, mask: str) -> str:
    out, at = [], 0
    for s in scan(text):
        if s.end <= at:
            continue
        if s.start >= at:
            out += [text[at : s.start], mask]
        at = s.end
    return "".join([*out, text[at:]])


def digests(docs: DataFrame) -> DataFrame:
    """Per row doc_id, n_assign, n_access, n_hex, base_sha256 (of kind:start:end of the plain
    kinds, comma-joined) and spans (all of them, joined likewise); rows as in ``find_secrets``."""

    def part(span, *names: str):
        return F.concat_ws(":", *[span[n].cast("string") for n in names])

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: part(s, "kind", "start", "end")), ",")

    found = find_secrets(docs)
    plain = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(text(plain).cast("binary"), 256).alias("base_sha256"),
        text(F.col("secrets")).alias("spans"),
    )
