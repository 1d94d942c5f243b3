import base64
import hashlib
import json
import re
import struct

import pytest
from cohortwise.llm import credentials as c


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else (lambda b: bytes([0x80 | len(b)]) + b)(n.to_bytes((n.bit_length() + 7) // 8, "big"))
    return bytes([tag]) + size + body


def integer(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


RSA = der(0x30, b"".join(map(integer, [0, 1 << 1023, 65537, 1 << 1000, 1 << 511, 1 << 510, 3, 5, 7])))
PKCS8 = der(0x30, integer(0) + der(0x30, der(6, bytes.fromhex("2b6570"))) + der(4, der(4, bytes(range(32)))))
EC = der(0x30, integer(1) + der(4, bytes(range(32))) + der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))))


def field(b):
    return struct.pack(">I", len(b)) + b


OPENSSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + struct.pack(">I", 1) + field(b"public" * 8) + field(b"private" * 20)


def b64(x, url=False):
    return (base64.urlsafe_b64encode(x).rstrip(b"=") if url else base64.b64encode(x)).decode()


def token(alg="HS256"):
    return ".".join(b64(x, True) for x in (json.dumps({"alg": alg, "typ": "JWT"}).encode(), b'{"sub":"1"}', bytes(range(32))))


@pytest.mark.parametrize("key,kind", [(RSA, "der"), (PKCS8, "der"), (EC, "der"), (OPENSSH, "openssh")])
def test_encoded_keys(key, kind):
    for text in (f"key {b64(key)} end", f"key {key.hex()} end"):
        assert [c.KINDS[k] for _, k, _ in c.confirmed_spans(text)] == [kind]
    pem = f"x\n-----BEGIN PRIVATE KEY-----\n{b64(key)}\n-----END PRIVATE KEY-----\ny"
    assert c.confirmed_spans(pem) == [(2, c.KINDS.index("pem"), len(pem) - 2)]


@pytest.mark.parametrize("key", [RSA, PKCS8, EC, OPENSSH])
def test_what_only_looks_like_a_key_is_not_reported(key):
    for broken in (key[:-1], key + b"\0", key[:1] + bytes([key[1] ^ 1]) + key[2:], bytes(len(key)), b"A" * len(key)):
        assert c.confirmed_spans(f"key {b64(broken)} end {broken.hex()}") == []
    assert c.confirmed_spans(f"-----BEGIN PRIVATE KEY-----\n{b64(key[:-1])}\n-----END PRIVATE KEY-----") == []


def wrapped(s, gap="\n", width=64):
    return gap.join(s[k : k + width] for k in range(0, len(s), width))


@pytest.mark.parametrize("key,kind", [(RSA, "der"), (PKCS8, "der"), (EC, "der"), (OPENSSH, "openssh")])
def test_keys_in_other_surroundings(key, kind):
    safe = base64.urlsafe_b64encode(key).decode()
    forms = [b64(key), safe, safe.rstrip("="), wrapped(b64(key)), wrapped(b64(key), "\r\n", 76), wrapped(b64(key), "\\n"), wrapped(b64(key), "\n    ", 20)]
    for form in forms:
        for before, after in (("PRIVATE_KEY=", "\nNEXT=1"), ("key: ", ". More"), ('{"k": "', '"}'), ("see\n", "\nend"), ("\\n", "\\nend"), ("", "")):
            text = before + form + after
            assert c.confirmed_spans(text) == [(len(before), c.KINDS.index(kind), len(before) + len(form))], text
    for gap in ("\n", "\\n", "\\r\\n", "\\\\n"):
        pem = f'{{"private_key": "-----BEGIN PRIVATE KEY-----{gap}{wrapped(b64(key), gap)}{gap}-----END PRIVATE KEY-----{gap}"}}'
        (span,) = c.confirmed_spans(pem)
        assert c.KINDS[span[1]] == "pem" and pem[span[0] : span[2]].endswith("-----END PRIVATE KEY-----")


@pytest.mark.parametrize("key", [RSA, PKCS8, EC, OPENSSH])
def test_broken_keys_in_other_surroundings(key):
    for broken in (key[:-1], key + b"\0", key[:1] + bytes([key[1] ^ 1]) + key[2:]):
        for text in (f"PRIVATE_KEY={b64(broken)}", wrapped(b64(broken), width=60), f"-----BEGIN PRIVATE KEY-----\\n{b64(broken)}\\n-----END PRIVATE KEY-----\\n"):
            assert c.confirmed_spans(text) == []


@pytest.mark.parametrize("key,kind", [(RSA, "der"), (PKCS8, "der"), (EC, "der"), (OPENSSH, "openssh")])
def test_keys_printed_in_hex(key, kind):
    pairs = [key.hex()[k : k + 2] for k in range(0, 2 * len(key), 2)]
    lines = ":\n    ".join(":".join(pairs[k : k + 15]) for k in range(0, len(pairs), 15))
    for form in (":".join(pairs), ":".join(pairs).upper(), " ".join(pairs), lines):
        for before, after in (("priv:\n    ", "\npub:"), ("", ""), ("key ", " end.")):
            assert c.confirmed_spans(before + form + after) == [(len(before), c.KINDS.index(kind), len(before) + len(form))], form[:40]
    for broken in (pairs[:-1], [*pairs, "00"], ["31", *pairs[1:]]):
        assert c.confirmed_spans("key " + ":".join(broken) + " end") == []


def test_pem_blocks_with_header_lines():
    for gap in ("\n", "\r\n", "\\n"):
        for headers in ("Proc-Type: 4,ENCRYPTED" + gap + "DEK-Info: AES-128-CBC," + "0F" * 16, "Proc-Type: 4,ENCRYPTED" + gap + "DEK-Info: DES-EDE3-CBC," + "ab" * 8):
            body = wrapped(b64(bytes(range(160))), gap)
            pem = f"-----BEGIN RSA PRIVATE KEY-----{gap}{headers}{gap}{gap}{body}{gap}-----END RSA PRIVATE KEY-----"
            assert c.confirmed_spans("x " + pem) == [(2, c.KINDS.index("pem"), 2 + len(pem))], (gap, headers)
            assert c.confirmed_spans(pem.replace("DEK-Info", "Other")) == []
            assert c.confirmed_spans(pem.replace(body, b64(bytes(range(157))))) == []
        plain = f"-----BEGIN RSA PRIVATE KEY-----{gap}Comment: mine{gap}{gap}{wrapped(b64(RSA), gap)}{gap}-----END RSA PRIVATE KEY-----"
        assert c.confirmed_spans(plain) == [(0, c.KINDS.index("pem"), len(plain))]


def test_tokens_at_the_end_of_a_sentence():
    for before, after in (("t ", "."), ("t ", ". Next"), ("t=", "..."), ("\\n", "\\n"), ("(", ")."), ("_", ",")):
        assert c.confirmed_spans(before + token() + after) == [(len(before), c.KINDS.index("jwt"), len(before) + len(token()))]
    assert c.confirmed_spans(f"{token()}.abc") == [] == c.confirmed_spans(f"x{token()}")


def test_signed_tokens():
    assert c.confirmed_spans(f"t {token()} x") == [(2, c.KINDS.index("jwt"), 2 + len(token()))]
    bad = [token("none"), token()[:-30], "eyJhbGci.eyJhbGci.aaaaaaaaaaaaaaaaaaaaaaaaaaa", token().replace(".", "", 1)]
    assert [c.confirmed_spans(t) for t in bad] == [[]] * 4


def brute(text):
    text = text or ""
    found = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    for k, p, n in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        found += [(m.start(), k, m.end()) for m in re.finditer(p, text) if len(m[0]) >= n]
    return sorted(found)


CASES = [
    'password = "hunter22" toKen: abcdef api_key=x apikey:\'abcdefgh',
    "toKen = abcdefgh paſsword=abcdefgh",  # letters that only fold to ASCII ones don't count
    "secret=secret=abcdef token= =a token:token:abcdef",
    "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 12 + " AKIA123 xAKIA" + "0" * 30,
    "\U0001f600 " + "0123456789abcdef" * 2 + " " + "f" * 23 + " F" + "e" * 24,
    None,
    "",
]


def test_base_spans_against_plain_patterns(spark, docs, odd):
    rows = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    for table in (rows, docs, odd):
        got = sorted((str(r["id"]), r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in c.scan(table).collect())
        want = []
        for r in table.collect():
            spans = brute(r["text"])
            digest = hashlib.sha256(",".join(f"{c.KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()
            want.append((str(r["doc_id"]), *[sum(k == n for _, k, _ in spans) for n in range(3)], digest))
        assert got == sorted(want)


def test_spans_hold_all_base_spans_and_redaction(spark, empty):
    text = f"token = {token()} and {b64(PKCS8)}"
    row = c.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    kinds = [s["kind"] for s in row["spans"]]
    assert kinds == ["assign", "jwt", "der"] and row["joined"].startswith("assign:0:")
    assert c.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["text"] == "[secret] and [secret]"
    assert c.scan(empty).count() == 0
