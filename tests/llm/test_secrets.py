"""Secret scans: plain patterns against a character-level scan, layers against planted ones."""

import base64
import gzip
import hashlib
import random
import re
import urllib.parse
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F
from llm_rows import EDGES, documents  # noqa: F401

from meterstar.llm import secrets

SECRET = "password=hunter2hunter2"


def b64(data):
    return base64.b64encode(data).decode()


def escapes(text):
    return "".join(f"\\u{ord(c):04x}" for c in text)


NOISE = bytes(random.Random(1).choices(b"ghijklmnopqrstu ", k=700))

LAYERS = {
    "url": urllib.parse.quote(SECRET, safe=""),
    "all of it as url": "".join(f"%{b:02X}" for b in SECRET.encode()),
    "url twice": urllib.parse.quote(urllib.parse.quote(SECRET, safe=""), safe=""),
    "unicode": escapes(SECRET),
    "hex escapes": "".join(f"\\x{b:02x}" for b in SECRET.encode()),
    "long escapes": "".join(f"\\U{ord(c):08x}" for c in SECRET),
    "braced escapes": "".join(f"\\u{{{ord(c):x}}}" for c in SECRET),
    "decimal entities": "".join(f"&#{ord(c)};" for c in SECRET),
    "entities": "".join(f"&#x{b:x};" for b in SECRET.encode()),
    "base64": b64(SECRET.encode()),
    "base64 three times": b64(b64(b64(SECRET.encode()).encode()).encode()),
    "url of base64": urllib.parse.quote(b64(SECRET.encode() + b"?"), safe=""),
    "base64 of url": b64(urllib.parse.quote(SECRET, safe="").encode()),
    "gzip": b64(gzip.compress(SECRET.encode() * 3)),
    "zlib of gzip": b64(zlib.compress(gzip.compress(SECRET.encode() * 3))),
    "zstd": b64(zstandard.compress(SECRET.encode() * 3)),
    "base64 of gzip of base64": b64(gzip.compress(b64(SECRET.encode()).encode())),
    "unicode of base64": escapes(b64(SECRET.encode())),
    "Latin-1 in base64": b64(f"clé: {SECRET}".encode("latin-1")),
    "UTF-16 in base64": b64(f"Schlüssel {SECRET}".encode("utf-16")),
    "UTF-16 BE at an odd place": b64(b"\x07" + SECRET.encode("utf-16-be")),
    "UTF-32 in base64": b64(SECRET.encode("utf-32")),
    "binary dump in gzip": b64(gzip.compress(bytes(range(256)) + SECRET.encode() + b"\0\1\2")),
    "Latin-1 in url": "%E9" + "".join(f"%{b:02X}" for b in SECRET.encode()),
    "Latin-1 in hex escapes": "\\xe9" + "".join(f"\\x{b:02x}" for b in SECRET.encode()),
    "lone surrogate": "\\ud83d" + escapes(SECRET),
    "url of gzip": urllib.parse.quote(gzip.compress(SECRET.encode() * 3)),
    "form of zlib": urllib.parse.quote_plus(zlib.compress(SECRET.encode() * 3)),
    "all of zstd as url": "".join(f"%{b:02X}" for b in zstandard.compress(SECRET.encode() * 3)),
    "gzip as a bytes literal": repr(gzip.compress(SECRET.encode() * 3 + bytes(range(256))))[2:-1],
    "later gzip member": b64(gzip.compress(b"log " * 9) + gzip.compress(b"more ") + gzip.compress(SECRET.encode())),
    "later zstd frame": b64(zstandard.compress(b"log " * 9) + zstandard.compress(SECRET.encode() * 3)),
    "text after gzip": b64(gzip.compress(b"log " * 9) + SECRET.encode()),
    "wrapped text": base64.encodebytes(b"-" * 52 + SECRET.encode() + b" and more" * 20).decode().strip(),
    "wrapped gzip": "blob: " + base64.encodebytes(gzip.compress(NOISE + SECRET.encode())).decode().strip(),
    "wrapped by CRLF, indented": "\r\n  ".join(re.findall(".{1,64}", b64(zlib.compress(NOISE + SECRET.encode())))),
    "wrapped below a word": "Attachment\n" + base64.encodebytes(zstandard.compress(NOISE + SECRET.encode())).decode().strip(),
    "glued by /": "/data/" + b64(SECRET.encode()),
    "glued by -": "a-bc-" + b64(SECRET.encode()),
    "glued by _, gzip": "key_" + b64(gzip.compress(SECRET.encode() * 3)),
    "gzip as code points": "".join(f"\\u{b:04x}" for b in gzip.compress(SECRET.encode() * 3)),
}


@pytest.mark.parametrize("name", LAYERS)
def test_a_planted_secret_is_found_at_its_place(name):
    before, after = "Über café 𝄞 text. ", " and more."
    text = before + LAYERS[name] + after
    found, _, whole = secrets.find_secrets(text)
    spans = [(a, b) for a, k, b, d, *_ in found if k == 0 and d > 0]
    assert whole and spans, found
    # The span covers the value, within the run that was encoded.
    for a, b in spans:
        assert len(before) <= a < b <= len(before) + len(LAYERS[name])
        assert b - a > len(SECRET) / 2
    assert secrets.redact(text).startswith(before) and secrets.redact(text).endswith(after)
    assert LAYERS[name] not in secrets.redact(text)


@pytest.mark.parametrize("inner", ["token%3Dabcdefghij", escapes("token=abcdefghij"), b64(b"token=abcdefghij")])
def test_a_nested_blob_planted_twice_is_found_twice(inner):
    blob = b64(inner.encode())
    text = f"first {blob} and\nagain {blob} end"
    found, _, whole = secrets.find_secrets(text)
    at = text.index(blob), text.rindex(blob)
    assert whole and [(f[0], f[2]) for f in found] == [(a, a + len(blob)) for a in at]
    assert blob not in secrets.redact(text)


def test_a_secret_that_only_the_decoded_whole_shows():
    text = "x api_key%3D%22abc%64efghi%22 y"
    ((a, kind, b, depth, via, value),) = secrets.find_secrets(text)[0]
    assert (kind, depth, via, value) == (0, 1, "url", 'api_key="abcdefghi')
    assert text[a:b] == "api_key%3D%22abc%64efghi"


def slow_spans(text):
    """The three patterns tried at every place, leftmost first, failing matches dropped."""
    kinds = (
        (secrets.ASSIGN, lambda m: len(m[2]) >= 6),
        (re.compile("AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 20),
        (re.compile("[0-9a-f]+"), lambda m: m.end() - m.start() >= 24),
    )
    out = []
    for k, (pattern, good) in enumerate(kinds):
        at = 0
        while at < len(text):
            m = pattern.match(text, at)
            if m and good(m):
                out.append((m.start(), k, m.end()))
            at = m.end() if m else at + 1
    return sorted(out)


def test_plain_patterns_against_a_scan_of_every_place():
    rng = random.Random(4)
    parts = ["password", "PassWD", "secret", "token", "api_key", "apikey", "API_KEY", "=", ":", " ", '"', "'",
             "AKIA", "AKIA" + "Q7" * 9, "abcdef0123456789" * 2, "0" * 23, "ſecret", "Key", "x", "\n", "%3D",
             "hunter2", "a/b+c.d-e_f", "é", "𝄞", ": \"", "token=secret=token: \"abcdefg\""]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert secrets.base_spans(text) == slow_spans(text), text
        found = [(a, k, b) for a, k, b, d, *_ in secrets.find_secrets(text)[0] if d == 0]
        assert found == slow_spans(text)


def test_cycles_and_bombs_end():
    quine = "%25" * 40_000 + "41"
    layers, whole = secrets.unwrap(quine)
    assert whole and len(layers) <= 3
    bomb = b64(zlib.compress(b"password=hunter2 " * 2_000_000))
    found, _, whole = secrets.find_secrets("token=abcdefgh " + bomb, max_decoded=1 << 20)
    assert not whole and found[0][5] == "token=abcdefgh"
    assert any(f[1] == 0 and f[3] > 0 for f in found)


def test_a_stream_without_its_end_is_not_whole():
    data = gzip.compress(SECRET.encode() + b" " + NOISE)
    for cut in (b64(data[:-20]), base64.encodebytes(data[:-20]).decode(), urllib.parse.quote(data[:-20])):
        found, _, whole = secrets.find_secrets("see " + cut)
        assert not whole and any(f[1] == 0 for f in found)
    assert secrets.find_secrets("100%25 of x^2 and x^, 50%25")[2]


def test_size_loses_no_escapes_and_bombs_are_read_to_their_end():
    text = "plain words " * 200 + "token%3Dabcdefgh and \\u0074oken%3Dhgfedcba"
    found, _, whole = secrets.find_secrets(text, max_decoded=100)
    assert whole and {f[5] for f in found} == {"token=abcdefgh", "token=hgfedcba"}
    bomb = b64(gzip.compress(gzip.compress(b"x" * 3_000_000 + b" token=abcdefgh " + b"y" * 3_000_000)))
    text = f"see {bomb} end"
    ((a, _, b, *_, value),), _, whole = secrets.find_secrets(text, max_decoded=1 << 20)
    assert not whole and (a, b, value) == (4, 4 + len(bomb), "token=abcdefgh")
    assert secrets.redact(text, max_decoded=1 << 20) == "see <UNREAD> end"
    assert secrets.redact("see " + b64(gzip.compress(NOISE)[:-20])) == "see <UNREAD>"
    assert secrets.find_secrets("see " + b64(gzip.compress(b"")) + " end")[2]


def test_query_rows(spark, documents):
    rows = EDGES + [(9, 'api_key: "abc-123_xyz" é ' + "0a" * 12), (10, b64(SECRET.encode()))]
    got = secrets.digest(secrets.scan_secrets(documents(rows))).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    empty = hashlib.sha256(b"").hexdigest()
    for doc_id in (1, 2, 3, 4, 5):
        r = by_id[doc_id]
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) == (0, 0, 0, empty, "")
    text = rows[-2][1]
    want = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in slow_spans(text))
    assert by_id[9].spans == want and (by_id[9].n_assign, by_id[9].n_hex) == (1, 1)
    assert by_id[9].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert by_id[10].base_sha256 == empty and by_id[10].spans == f"assign:0:{len(rows[-1][1])}"


def test_redacted_documents_keep_their_columns(spark, documents):
    df = documents(EDGES + [(9, "my token=abcdefgh!")])
    out = secrets.redact_documents(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert (rows[9].text, rows[9].n_chars) == ("my <ASSIGN>!", 12)
    assert rows[1].text is None and rows[3].n_chars == 300_000
    assert out.filter(F.col("text").isNull()).count() == 2
    assert secrets.redact_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("finding", ["AKIA" + "A" * 20, "token=" + "a" * 12, "0123456789abcdef" * 2])
def test_base64_of_any_first_byte_and_phase_is_read(finding):
    """Also runs that come out all in one case."""
    for first in range(256):
        for phase in range(3):
            data = bytes([first]) + b"D" * phase + b" " + finding.encode()
            for run in (b64(data), b64(data[1:])):
                text = f"key {run} end"
                assert secrets.find_secrets(text)[0], (first, phase, run)


def test_a_run_of_one_case_is_redacted(spark, documents):  # noqa: F811
    run = b64(b"DAKIA" + b"A" * 20).rstrip("=")
    assert run.isupper()
    out = secrets.redact_documents(documents([(1, f"see {run} there")])).first().text
    assert run not in out and out.startswith("see <")
