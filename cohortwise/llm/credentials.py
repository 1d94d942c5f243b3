"""Secrets in text: fixed patterns, and encoded keys and tokens confirmed by their structure."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.arrow import pieces

# Kinds in the order in which spans of equal start are listed: the fixed patterns, then those confirmed by structure.
BASE = ("assign", "access", "hex")
CONFIRMED = ("pem", "der", "openssh", "jwt")
KINDS = (*BASE, *CONFIRMED)

# The patterns and their shortest lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

# Candidates for decoding; each is reported only if what it decodes to parses to its end.
# A run of hex letters is found faster by its shortest length; shorter runs would be dropped anyway.
_LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)
# Line ends may be written as escapes, as in JSON strings.
_LINE_END = r"(?:\r?\n|(?:\\+r)?\\+n)"
# Lines with a name and a value may come before the body and end with an empty one.
_PEM_HEADERS = rf"(?:{_LINE_END}[ \t]*[A-Za-z][A-Za-z0-9-]*:[^\r\n\\]*)+"
_PEM = re.compile(rf"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----({_PEM_HEADERS})?((?:[A-Za-z0-9+/=\s]|\\+[nrt])+)-----END \1-----")
_ENCRYPTED = re.compile(r"DEK-Info:[ \t]*([A-Z0-9-]+),([0-9A-Fa-f]+)")
# Bytes of a block, by the start of the cipher's name.
_CIPHER_BLOCKS = {"DES": 8, "AES": 16, "CAMELLIA": 16, "SEED": 16, "IDEA": 8, "RC2": 8, "BF": 8, "CAST5": 8}
_GAPS = re.compile(r"\s+|\\+[nrt]")
_JWT = re.compile(r"(?:(?<![A-Za-z0-9])|(?<=\\[nrt]))eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*(?![A-Za-z0-9_-]|\.[A-Za-z0-9_-])")
# First letters of the base64 of a DER sequence and of an OpenSSH key; both name their own length.
_KEY_START = re.compile(r"M[A-P]|b3BlbnNzaC1rZXktdjEA")
_BEFORE = re.compile(r"[A-Za-z0-9]\Z")
_ESCAPE = re.compile(r"\\[nrt]\Z")
_LETTERS = re.compile(r"[A-Za-z0-9+/_-]+")
_WRAP = re.compile(r"[ \t]*(?:\r?\n|(?:\\+r)?\\+n)[ \t]*(?=[A-Za-z0-9+/_-])(?!-----)")
_BEHIND = re.compile(r"[A-Za-z0-9+/=]|[_-][A-Za-z0-9+/_=-]")
_HEX_BYTES = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
# Bytes in hex with separators, as key tools print them, from the first byte of a DER sequence or an OpenSSH key on.
_HEX_PRINTED = re.compile(r"(?<![0-9A-Fa-f])(?<![0-9A-Fa-f][: ])(?:30|6[Ff])(?:(?::[ \t]*(?:\r?\n[ \t]*)?|[ ])[0-9A-Fa-f]{2}){23,}(?![0-9A-Fa-f]|:[0-9A-Fa-f])")
_NO_HEX = re.compile(r"[^0-9A-Fa-f]+")

_SEQUENCE, _INTEGER, _BITS, _OCTETS, _OID = 0x30, 0x02, 0x03, 0x04, 0x06
# Object identifiers (DER content) of key algorithms: RSA, EC, Ed25519, Ed448, X25519, X448, DSA.
_KEY_OIDS = {bytes.fromhex(x) for x in ("2a864886f70d010101", "2a8648ce3d0201", "2b6570", "2b6571", "2b656e", "2b656f", "2a8648ce380401")}
# Names of signing algorithms in token headers.
_SIGNING = {f"{family}{bits}" for family in ("HS", "RS", "ES", "PS") for bits in (256, 384, 512)} | {"EdDSA", "ES256K"}


def elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER elements that fill ``data`` exactly, or None."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size = int.from_bytes(data[at : at + n], "big")
            if size < 0x80 or data[at] == 0:  # lengths have one shortest form
                return None
            at += n
        if at + size > len(data):
            return None
        found.append((tag, data[at : at + size]))
        at += size
    return found


def is_private_key(data: bytes) -> bool:
    """Does ``data`` parse to its end as a PKCS#1, SEC1, DSA, PKCS#8 or encrypted PKCS#8 private key?"""
    outer = elements(data)
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    parts = elements(outer[0][1])
    if not parts or len(parts) < 2:
        return False
    tags = [tag for tag, _ in parts]
    if tags[0] == _SEQUENCE:  # encrypted: algorithm, octets
        algorithm = elements(parts[0][1])
        return tags == [_SEQUENCE, _OCTETS] and bool(algorithm) and algorithm[0][0] == _OID and len(parts[1][1]) >= 16
    if tags[0] != _INTEGER or len(parts[0][1]) != 1:
        return False
    if tags[1] == _OCTETS:  # SEC1: version 1, private value
        return parts[0][1] == b"\x01" and len(parts[1][1]) >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])
    if tags[1] == _SEQUENCE:  # PKCS#8: version, algorithm, octets
        algorithm = elements(parts[1][1])
        return len(parts) >= 3 and bool(algorithm) and algorithm[0][0] == _OID and algorithm[0][1] in _KEY_OIDS and tags[2] == _OCTETS
    # PKCS#1: version and eight numbers; DSA: version and five
    return all(t == _INTEGER for t in tags) and len(parts) in (6, 9) and len(parts[1][1]) >= 32


def is_openssh_key(data: bytes) -> bool:
    """Does ``data`` parse to its end as an OpenSSH private key (magic, then length-prefixed fields)?"""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        (size,) = struct.unpack(">I", data[at : at + 4])
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    cipher, kdf, options = field(), field(), field()
    if not cipher or not kdf or options is None or at + 4 > len(data):
        return False
    (keys,) = struct.unpack(">I", data[at : at + 4])
    at += 4
    if not 1 <= keys <= 16:
        return False
    return all(field() for _ in range(keys)) and bool(field()) and at == len(data)


def is_signed_token(text: str) -> bool:
    """Is ``text`` header.payload.signature with a JSON header that names a signing algorithm and a JSON payload?"""
    try:
        header, payload, signature = text.split(".")
        head = json.loads(_base64(header, url=True))
        body = json.loads(_base64(payload, url=True))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(body, dict) and head.get("alg") in _SIGNING and len(signature) >= 22


def _base64(text: str, url: bool = False) -> bytes:
    """Strict decoding; ValueError if the letters, the padding or the unused last bits are wrong."""
    bare = text.rstrip("=")
    if len(text) != len(bare) and len(text) % 4:
        raise ValueError("padding")
    full = bare + "=" * (-len(bare) % 4)
    data = base64.b64decode(full.translate({45: 43, 95: 47}) if url else full, validate=True)
    if base64.b64encode(data).rstrip(b"=") != bare.encode().translate(bytes.maketrans(b"-_", b"+/") if url else None):
        raise ValueError("unused bits")
    return data


def _key_kind(data: bytes) -> str | None:
    return "der" if is_private_key(data) else "openssh" if is_openssh_key(data) else None


def is_encrypted_body(headers: str, data: bytes) -> bool:
    """Is ``data`` whole blocks of the cipher that the headers name, with a start value of the right size?"""
    named = _ENCRYPTED.search(headers)
    block = _CIPHER_BLOCKS.get(named[1].split("-")[0]) if named and "ENCRYPTED" in headers else None
    return bool(block) and len(named[2]) == 2 * block and len(data) >= block and len(data) % block == 0


class _Wrapped:
    """Base64 of either alphabet from a place in a text on, over line ends; read only as far as is asked."""

    def __init__(self, text: str, start: int):
        self.text, self.at, self.lines, self.size = text, start, [], 0

    def letters(self, n: int) -> tuple[str, int] | None:
        """The first ``n`` letters and where they end, or None if there are fewer."""
        while self.size < n:
            if self.lines:
                gap = _WRAP.match(self.text, self.at)
                if not gap:
                    return None
                self.at = gap.end()
            line = _LETTERS.match(self.text, self.at)
            if not line:
                return None
            self.lines.append(line[0])
            self.size += len(line[0])
            self.at = line.end()
        return "".join(self.lines)[:n], self.at - (self.size - n)

    def head(self, n: int) -> bytes:
        """The first ``n`` bytes; ValueError if there are fewer."""
        got = self.letters(-(-n * 4 // 3))
        if not got:
            raise ValueError("end")
        return base64.b64decode((got[0] + "A" * (-len(got[0]) % 4)).translate({45: 43, 95: 47}))[:n]


def _named_size(read: _Wrapped) -> int:
    """Bytes of the key by its own length fields."""
    if read.head(1)[0] == _SEQUENCE:
        size = read.head(2)[1]
        n = size & 0x7F if size >= 0x80 else 0
        if n > 4:
            raise ValueError("length")
        # What no private key starts with is not read any further: version of one byte, or algorithm.
        if read.head(4 + n)[2 + n :] != bytes((_INTEGER, 1)) and read.head(3 + n)[-1] != _SEQUENCE:
            raise ValueError("first part")
        return 2 + n + (int.from_bytes(read.head(2 + n)[2:], "big") if n else size)
    at = len(b"openssh-key-v1\0")

    def number() -> int:
        return int.from_bytes(read.head(at + 4)[at:], "big")

    for _ in range(3):
        at += 4 + number()
    keys = number()
    at += 4
    for _ in range(min(keys, 16) + 1):
        at += 4 + number()
    return at


def _wrapped_keys(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of keys in base64, plain or safe for addresses, in one line or several.

    A key ends where its own length fields say; no letter may follow there, and padding must be right or missing.
    """
    done = 0
    for m in _KEY_START.finditer(text):
        start = m.start()
        if start < done or _BEFORE.search(text, max(start - 1, 0), start) and not _ESCAPE.search(text, max(start - 2, 0), start):
            continue
        read = _Wrapped(text, start)
        try:
            got = read.letters(-(-_named_size(read) * 4 // 3))
            kind = got and _key_kind(_base64(got[0], url=True))
        except ValueError:
            continue
        if not kind:
            continue
        pad = "=" * (-len(got[0]) % 4)
        end = got[1] + len(pad) * text.startswith(pad, got[1])
        if not _BEHIND.match(text, end):
            done = end
            yield start, end, kind


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns: leftmost, not overlapping within a kind; too short ones are dropped after matching."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of encoded keys and signed tokens whose decoded bytes have the right structure."""
    found = []
    covered = []
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            try:
                data = _base64(_GAPS.sub("", m[3]))
            except ValueError:
                continue
            if _key_kind(data) or m[2] and is_encrypted_body(m[2], data):
                found.append((m.start(), KINDS.index("pem"), m.end()))
                covered.append((m.start(), m.end()))
    if "eyJ" in text:
        found += [(m.start(), KINDS.index("jwt"), m.end()) for m in _JWT.finditer(text) if is_signed_token(m[0])]
    for start, end, kind in _wrapped_keys(text):
        if not any(a <= start < b for a, b in covered):
            found.append((start, KINDS.index(kind), end))
    for m in _HEX_BYTES.finditer(text):
        if any(a <= m.start() < b for a, b in covered):
            continue
        kind = _key_kind(binascii.unhexlify(m[0]))
        if kind:
            found.append((m.start(), KINDS.index(kind), m.end()))
    for m in _HEX_PRINTED.finditer(text):
        kind = _key_kind(binascii.unhexlify(_NO_HEX.sub("", m[0])))
        if kind:
            found.append((m.start(), KINDS.index(kind), m.end()))
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All spans of every row, in code points, end exclusive.

    Columns: id, spans (array of kind, start, end; by start, then kind as in
    ``KINDS``), n_assign, n_access, n_hex, base_sha256 (of the fixed patterns'
    spans as ``kind:start:end``, comma-joined) and joined (all spans likewise).
    Null and empty texts have no spans. Every row gets a row, repeated ones too;
    other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = f"id {kind}, spans array<struct<kind: string, start: long, end: long>>, n_assign long, n_access long, n_hex long, base_sha256 string, joined string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            rows = []
            for raw in texts:
                text = raw.decode()
                base = base_spans(text)
                every = sorted(base + confirmed_spans(text))
                counts = [sum(k == n for _, k, _ in base) for n in range(len(BASE))]
                named = [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in every]
                rows.append((named, *counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
            columns = list(zip(*rows))
            kinds = [pa.list_(span), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "spans", "n_assign", "n_access", "n_hex", "base_sha256", "joined"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """(id, text) with every reported span replaced by ``mark``; overlapping spans are replaced once."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            clean = []
            for raw in texts:
                text, out, at = raw.decode(), [], 0
                for start, _, end in sorted(base_spans(text) + confirmed_spans(text)):
                    if start >= at:
                        out += [text[at:start], mark]
                    at = max(at, end)
                clean.append("".join([*out, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(clean, pa.string())], ["id", "text"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, text string")
