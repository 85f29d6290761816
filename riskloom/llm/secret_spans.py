"""Secrets in texts: patterns, and encoded keys and signed tokens confirmed by their structure.

Three patterns report what they match (kinds assign, access, hex). Two further kinds are
reported only after decoding:

- key: a run of base64 (either alphabet, also broken over lines or with ``\\n`` written
  out), a run of hex digits, or the body of a PEM block is decoded, and the bytes must be
  one private key: DER whose nested lengths all fit (PKCS#1 with p * q = n, DSA with
  g^x = y, SEC 1, PKCS#8 with the inner key of its algorithm, encrypted PKCS#8) or the
  OpenSSH format. The outer length says where the run has to end. Bytes that are text
  are searched once more for PEM blocks and tokens, as in encoded configuration files.
- jwt: three (signed) or five (encrypted) dotted base64 parts whose header is a JSON object
  with its algorithm; a signed token needs a JSON payload and a signature of the length
  that its algorithm makes.

Public keys and certificates are no secrets and not reported. Keys over ``MAX_KEY`` bytes
(RSA beyond 16,384 bits has fewer) are not confirmed. Everything happens inside the task
that reads the text; each pattern looks at a character a bounded number of times, so long
texts cost in proportion. There is no shuffle.

Defined results: null and empty texts have no spans; rows with a null ``doc_id``, equal ids
and repeated rows each give a row; other columns are not read. Spans of different kinds
may overlap, those of one kind do not.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "key")
MAX_KEY = 1 << 14
SCHEMA = "doc_id long, spans array<struct<kind: string, start: long, end: long, detail: string>>"

# The patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

# Object identifiers of key algorithms (DER contents, hex).
RSA, DSA, EC = "2a864886f70d010101", "2a8648ce380401", "2a8648ce3d0201"
CURVE_KEYS = {"2b656e": 32, "2b656f": 56, "2b6570": 32, "2b6571": 57}
ENCRYPTIONS = ("2a864886f70d0105", "2a864886f70d010c01")
# Signature bytes of signed tokens.
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "none": 0}

_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[w-z0-9_-][A-Za-z0-9_-]{2,}(?:\.[A-Za-z0-9_-]*){2,4}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{48,}")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----((?:[^-]|-(?!----))*)-----END \1-----")
_BREAK = re.compile(r"\\[nrt]|\s")
_UNITS = re.compile(r"(?:\\[nrt]|\s)*([A-Za-z0-9+/_=-])")
_GOES_ON = re.compile(r"[A-Za-z0-9+/_=]")
_URLSAFE = str.maketrans("-_", "+/")
_OPENSSH = b"openssh-key-v1\x00"


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    detail: str | None


def decoded(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, padded or not; None if it is none."""
    text = text.rstrip("=").translate(_URLSAFE)
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


# --- DER ------------------------------------------------------------------------------


def element(data: bytes, at: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the contents of the DER element at ``at``; the end may lie behind the data."""
    if at + 2 > len(data):
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or at + width > len(data):
            return None
        size, at = int.from_bytes(data[at : at + width], "big"), at + width
        if size < 0x80 or size < 1 << 8 * (width - 1):
            return None
    return tag, at, at + size


def contents(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of elements that fill ``data`` exactly."""
    out, at = [], 0
    while at < len(data):
        found = element(data, at)
        if not found or found[2] > len(data):
            return None
        out.append((found[0], data[found[1] : found[2]]))
        at = found[2]
    return out


def inside(data: bytes) -> list[tuple[int, bytes]] | None:
    """What stands in the one SEQUENCE that is all of ``data``."""
    whole = contents(data)
    return contents(whole[0][1]) if whole and len(whole) == 1 and whole[0][0] == 0x30 else None


def _algorithm(body: bytes) -> str | None:
    parts = contents(body)
    return parts[0][1].hex() if parts and parts[0][0] == 0x06 and parts[0][1] else None


def _rsa(numbers: list[int]) -> bool:
    return numbers[0] in (0, 1) and numbers[4] > 1 and numbers[5] > 1 and numbers[4] * numbers[5] == numbers[1]


def _dsa(numbers: list[int]) -> bool:
    version, p, q, g, y, x = numbers
    small = p.bit_length() <= 1 << 14 and q.bit_length() <= 512
    return small and version == 0 and 0 < x < q < p and 1 < g < p and pow(g, x, p) == y


def _sec1(parts: list[tuple[int, bytes]]) -> bool:
    tags = [t for t, _ in parts]
    if tags[:2] != [2, 4] or parts[0][1] != b"\x01" or not 20 <= len(parts[1][1]) <= 66:
        return False
    nested = {0xA0: 0x06, 0xA1: 0x03}
    return tags[2:] in ([], [0xA0], [0xA1], [0xA0, 0xA1]) and all(
        (held := contents(body)) is not None and [t for t, _ in held] == [nested[t0]] for t0, body in parts[2:]
    )


def der_key(data: bytes) -> str | None:
    """The format of the private key that ``data`` is, all of it."""
    parts = inside(data) if len(data) <= MAX_KEY else None
    if not parts:
        return None
    tags = [t for t, _ in parts]
    if set(tags) == {2} or (tags[:9] == [2] * 9 and tags[9:] == [0x30]):
        numbers = [int.from_bytes(body, "big", signed=True) for t, body in parts if t == 2]
        if len(numbers) == 9:
            return "PKCS#1" if _rsa(numbers) else None
        return "DSA" if len(numbers) == 6 and _dsa(numbers) else None
    if _sec1(parts):
        return "SEC 1"
    if tags[:3] == [2, 0x30, 4] and parts[0][1] in (b"\x00", b"\x01") and all(t in (0xA0, 0x81, 0xA1) for t in tags[3:]):
        return "PKCS#8" if _inner_key(_algorithm(parts[1][1]), parts[2][1]) else None
    if tags == [0x30, 4] and (_algorithm(parts[0][1]) or "").startswith(ENCRYPTIONS):
        return "encrypted PKCS#8" if len(parts[1][1]) >= 16 and len(parts[1][1]) % 8 == 0 else None
    return None


def _inner_key(algorithm: str | None, body: bytes) -> bool:
    if algorithm == RSA:
        return der_key(body) == "PKCS#1"
    if algorithm == EC:
        return _sec1(inside(body) or [])
    whole = contents(body)
    if not algorithm or not whole or len(whole) != 1:
        return False
    if algorithm in CURVE_KEYS:
        return whole[0][0] == 4 and len(whole[0][1]) == CURVE_KEYS[algorithm]
    return whole[0][0] == 2 if algorithm == DSA else True


# --- OpenSSH --------------------------------------------------------------------------


def openssh_size(data: bytes) -> int | None:
    """Bytes of the OpenSSH private key that ``data`` begins with, by its nested lengths."""
    if not data.startswith(_OPENSSH):
        return None
    at = len(_OPENSSH)

    def field() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    cipher, kdf, options = field(), field(), field()
    n = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if None in (cipher, kdf, options) or not 1 <= n <= 16:
        return None
    public = [field() for _ in range(n)]
    private = field()
    if private is None or None in public or not all(p[4:8] in (b"ssh-", b"ecds", b"sk-s", b"sk-e") for p in public):
        return None
    if cipher == b"none" and private[:4] != private[4:8]:  # both check numbers
        return None
    return at if len(private) >= 8 and len(private) % 8 == 0 else None


def key_format(data: bytes) -> str | None:
    """The format of the private key that ``data`` is, all of it."""
    return "OpenSSH" if openssh_size(data) == len(data) else der_key(data)


# --- candidates -----------------------------------------------------------------------


def _base64_run(text: str, start: int, size: int) -> tuple[str, int]:
    """Base64 signs for ``size`` bytes from ``start`` on, past line breaks, and where they end."""
    signs, at, need = [], start, -(-size // 3) * 4
    while len(signs) < need and (found := _UNITS.match(text, at)):
        signs.append(found[1])
        at = found.end()
    return "".join(signs), at


def run_key(text: str, start: int) -> tuple[str, int] | None:
    """Format and end of the private key whose base64 begins at ``start``."""
    head = decoded(text[start : start + 8])
    if head is None:
        return None
    if head.startswith(_OPENSSH[:6]):
        size = openssh_size(decoded(_base64_run(text, start, MAX_KEY)[0].partition("=")[0]) or b"")
    else:
        found = element(head, 0) if head[0] == 0x30 else None
        size = found[2] if found else None
    if size is None or not 16 <= size <= MAX_KEY:
        return None
    signs, end = _base64_run(text, start, size)
    if _GOES_ON.match(text, end):
        return None
    form = key_format(decoded(signs) or b"")
    return (form, end) if form else None


def token_format(candidate: str) -> tuple[str, int] | None:
    """Algorithm and length of the token that the dotted base64 parts begin with."""
    parts = candidate.split(".")
    try:
        header = json.loads(decoded(parts[0]) or b"")
    except (ValueError, RecursionError):
        return None
    if not isinstance(header, dict) or not isinstance(header.get("alg"), str):
        return None
    if len(parts) == 5 and isinstance(header.get("enc"), str):
        whole = all(decoded(p) is not None for p in parts) and all(parts[2:])
        return (f"encrypted {header['alg']}", len(candidate)) if whole else None
    try:
        payload = json.loads(decoded(parts[1]) or b"")
    except (ValueError, RecursionError):
        return None
    signature = decoded(parts[2])
    if not isinstance(payload, dict) or signature is None:
        return None
    size = SIGNATURES.get(header["alg"])
    fits = len(signature) == size if size is not None else len(signature) >= 64
    return (f"signed {header['alg']}", sum(map(len, parts[:3])) + 2) if fits else None


def pem_keys(text: str) -> list[Span]:
    """PEM blocks whose body is a private key; of one encrypted in the old way only the size can be told."""
    out = []
    for m in _PEM.finditer(text) if "-----BEGIN " in text else ():
        body = m[2].replace("\\r", "").replace("\\n", "\n").replace("\r", "")
        sealed = "Proc-Type:" in body and "ENCRYPTED" in body
        data = decoded(_BREAK.sub("", body.partition("\n\n")[2] if sealed else body)) or b""
        form = f"encrypted {m[1]}" if sealed and data and len(data) % 8 == 0 else key_format(data)
        if form:
            out.append(Span("key", *m.span(), f"PEM, {form}"))
    return out


def confirmed(text: str, nested: bool = False) -> list[Span]:
    """Keys and tokens in ``text``; a run that decodes to text counts if that text holds one."""
    out = []
    for m in _TOKEN.finditer(text):
        if found := token_format(m[0]):
            out.append(Span("jwt", m.start(), m.start() + found[1], found[0]))
    blocks, block, end = pem_keys(text), 0, 0
    for m in _RUN.finditer(text):
        while block < len(blocks) and blocks[block].end <= m.start():
            block += 1
        if m.start() < end or block < len(blocks) and blocks[block].start <= m.start():
            continue
        if found := run_key(text, m.start()):
            end = found[1]
            out.append(Span("key", m.start(), end, f"base64, {found[0]}"))
        elif not nested and (data := decoded(m[0])) and data.isascii():
            within = confirmed(data.decode("ascii"), nested=True)
            out += [Span(s.kind, *m.span(), f"base64, {s.detail}") for s in within[:1]]
    out += blocks
    for m in _HEX_RUN.finditer(text):
        if len(m[0]) % 2 == 0 and (form := key_format(bytes.fromhex(m[0]))):
            out.append(Span("key", *m.span(), f"hex, {form}"))
    return out


def spans_of(text: str | None) -> list[Span]:
    """All spans of one text, by start, then kind as in ``KINDS``; places are code points."""
    if not text:
        return []
    out = [Span("assign", *m.span(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    out += [Span("access", *m.span(), None) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [Span("hex", *m.span(), None) for m in HEX.finditer(text)]
    out += confirmed(text)
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and its spans, with the confirmed format as ``detail`` of added kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("detail", pa.string())]))
        for batch in batches:
            for part in tb.steps(batch, "text"):
                found = [[s._asdict() for s in spans_of(t)] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(found, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def of_kinds(spans: str | Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def joined(spans: str | Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
