"""Deep, repeated, streamed and hostile layers, each with its defined result."""

import base64
import gzip
import random
import re
import resource
import time
import zlib
from urllib.parse import quote

import pytest

from capturemill.llm import secrets

KEY = 'password = "hunter2hunter2"'
HEXKEY = "0123456789abcdef" * 2


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


def _escaped_by_definition(text):
    """The escaped runs by the pattern that tries every start and end."""
    one = r"(?:[^\s%\\\"'<>]|%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})"
    unit = r"(?:%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})"
    return [m.span() for m in re.finditer(f"{one}*{unit}{one}*", text)]


@pytest.mark.parametrize("text", ["a%41b c%zz%42 \\u0041x \"q%20\" plain %", "%", "%%41", "\\x41\\", "a\\b%41", "x<y%41>z", ""])
def test_escaped_runs(text):
    assert [m.span() for m in secrets._ESCAPED.finditer(text) if secrets._HAS_ESCAPE.search(m[0])] == _escaped_by_definition(text)


def test_escapes_are_found_in_linear_time():
    text = "%41" + "a" * 1_000_000 + " " + "b%42" * 250_000
    t = time.time()
    secrets.all_spans(text)
    assert time.time() - t < 5


@pytest.mark.parametrize("wrap", [gzip.compress, zlib.compress, lambda x: gzip.compress(gzip.compress(x)), lambda x: zlib.compress(gzip.compress(zlib.compress(x))), lambda x: gzip.compress(b"plain words ") + gzip.compress(x), lambda x: gzip.compress(b64(gzip.compress(x)).encode())])
def test_compressed_layers(wrap):
    run = b64(wrap((KEY + " and " + HEXKEY).encode()))
    assert secrets.all_spans(f"see {run} here") == sorted((4, k, 4 + len(run)) for k in (0, 2))
    assert secrets.all_spans(f"see {b64(wrap(b'only plain words'))} here") == []


def test_text_that_begins_like_a_compressed_stream():
    run = b64("x " + KEY)
    assert secrets._packed(b"x " + KEY.encode()) and [k for _, k, _ in secrets.all_spans(run)] == [0]
    run = b64(gzip.compress(("x " + KEY).encode()))
    assert [k for _, k, _ in secrets.all_spans(run)] == [0]


def test_layers_that_repeat_or_contain_themselves_end():
    inner = b64(b64(KEY))
    spans = secrets.all_spans(f"{inner} {inner}")
    assert len(spans) == 2 and spans[0][0] < len(inner) < spans[1][0]
    source = lambda: iter((gzip.compress(KEY.encode()),))
    digest = secrets._examined(source)[0]
    assert secrets.byte_kinds(source, frozenset((digest,))) is None


@pytest.mark.parametrize("piece", [64, 100, 1000])
def test_pieces_change_nothing(piece, monkeypatch):
    """Content is looked at in pieces of any size with the same result."""
    fill = "".join(f"word{i} " for i in range(300))
    long = quote(("long" * 80 + KEY).replace(" ", "_"), safe="")
    texts = [fill + KEY + fill, fill + "password" + " " * 300 + "=" + " " * 300 + "hunter22 " + fill, fill + b64(HEXKEY) + fill, b64(fill + "AKIA" + "A" * 16), b64(gzip.compress((fill + KEY).encode())), fill + "".join(f"%{c:02x}" for c in KEY.encode()) * 9, "é" * 500 + long, fill + b64(fill * 3 + HEXKEY) + "=" + fill, fill]
    want = [{k for _, k, _ in secrets.all_spans(t)} for t in texts]
    monkeypatch.setattr(secrets, "PIECE", piece)
    for t, kinds in zip(texts, want, strict=True):
        got = secrets.byte_kinds(lambda t=t: iter([gzip.compress(t.encode())]), frozenset())
        assert got == kinds, (piece, t[:40])


def test_a_bomb_is_inflated_in_bounded_memory():
    stream = zlib.compressobj(9)
    packed = b"".join(stream.compress(b"a b " * 250_000) for _ in range(200)) + stream.compress(KEY.encode()) + stream.flush()
    run = b64(packed)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert secrets.all_spans(run) == [(0, 0, len(run))]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000


def test_scan_of_odd_tables(spark):
    d = spark.createDataFrame([(1, KEY, 3), (1, KEY, 3), (2, None, 4), (None, "", 5), (3, "word " * 200_000 + KEY, 6)], "doc_id long, text string, spans int")
    got = {(r.doc_id, r.n_assign, r.spans) for r in secrets.scan_documents(d).collect()}
    end = 25  # the closing quote isn't part of the value
    assert got == {(1, 1, f"assign:0:{end + 1}"), (2, 0, ""), (None, 0, ""), (3, 1, f"assign:1000000:{1000000 + end + 1}")}
    assert secrets.scan_documents(d.limit(0)).count() == 0


# --- drawn secrets in drawn layers in drawn surroundings -----------------------------------------------


def _wraps(rng):
    b64 = lambda raw: base64.b64encode(raw).decode()
    url = lambda raw: base64.urlsafe_b64encode(raw).decode().rstrip("=")

    def lines(raw):
        body, width = b64(raw), rng.choice([20, 64, 76])
        return rng.choice(["\n", "\r\n", "\n  "]).join(body[i : i + width] for i in range(0, len(body), width))

    return [
        ("percent", lambda t: "".join(f"%{b:02X}" for b in t.encode())), ("some percent", lambda t: "".join(f"%{ord(c):02x}" if c in '% \r\n' or rng.random() < 0.4 else c for c in t)),
        ("u", lambda t: "".join(f"\\u{ord(c):04x}" for c in t)), ("braces", lambda t: "".join(f"\\u{{{ord(c):x}}}" for c in t)), ("x", lambda t: "".join(f"\\x{ord(c):02X}" for c in t)),
        ("base64", lambda t: b64(t.encode())), ("url base64", lambda t: url(t.encode())), ("base64 lines", lambda t: lines(t.encode())), ("utf-16", lambda t: b64(t.encode(rng.choice(["utf-16-le", "utf-16-be"])))),
        ("gzip", lambda t: b64(gzip.compress(t.encode()))), ("zlib", lambda t: b64(zlib.compress(t.encode()))), ("gzip url", lambda t: url(gzip.compress(t.encode()))),
    ]


def test_every_drawn_secret_is_found_in_drawn_layers_and_surroundings():
    rng = random.Random(31)
    wraps = _wraps(rng)
    around = ["", " ", "ab/", "x_", "token-", "https://h.io/p/", "abc%2F", "k=", "\"", "é ", "a+b/", "seen in line:\n"]
    for i in range(600):
        kind = rng.choice(["assign", "access", "hex"])
        secret = {"assign": f"password={rng.randrange(10**9):x}hunter22", "access": "AKIA" + "".join(rng.choice("ABCDEFGH234567") for _ in range(16)), "hex": "".join(rng.choice("0123456789abcdef") for _ in range(32))}[kind]
        text, names = f"{rng.choice(['', 'note: ', 'a b '])}{secret}{rng.choice(['', ' end', '; x'])}", []
        for depth in range(rng.choice([1, 1, 2, 3])):
            name, wrap = wraps[i % len(wraps)] if depth == 0 else rng.choice(wraps)
            names.append(name)
            text = wrap(text)
        before, after = rng.choice(around), rng.choice(["", " ", "\"", " tail", "\n"])
        whole = f"words before {before}{text}{after}"
        start = len(whole) - len(after) - len(text)
        spans = [(a, b) for a, k, b in secrets.all_spans(whole) if secrets.KINDS[k] == kind and b > start and a < start + len(text)]
        assert spans, (kind, names, before, whole)


def test_letters_alone_may_be_base64():
    """A run of lower-case letters is decoded like any other, and words give nothing."""
    words = "incomprehensibilities uncharacteristically Floccinaucinihilipilification " * 3
    assert secrets.all_spans(words) == []
    assert secrets.all_spans("\\ud83d\\ude00" * 3 + " plain") == []
    assert secrets._escapes("\\ud83d\\ude00\\ud83d")[0] == "😀�" and list(secrets._escapes("a\\ud83d\\ude00")[2]) == [1, 13]


@pytest.mark.parametrize("piece", [200, 333, 1000])
def test_a_long_run_is_decoded_like_a_short_one(piece, monkeypatch):
    """Readable stretches, UTF-16 and streams inside of a base64 run in a compressed stream are found at any size of the run."""
    rng = random.Random(7)
    noise = lambda n: bytes(rng.choice(b"\x00\x81\x9f\xff\xfe\xc0") for _ in range(n))
    wide, packed = KEY.encode("utf-16-le"), gzip.compress(KEY.encode())
    inner = [noise(900) + KEY.encode() + noise(900), noise(901) + wide + noise(902), noise(900) + KEY.encode("utf-16-be") + noise(900), noise(900) + packed, noise(999) + ("é" * 600 + KEY).encode() + noise(999), noise(950) + b"short" + noise(950)]
    texts = ["a" * k + b64(x) for x in inner for k in (0, 1, 2, 3)] + ["ab" * 500 + "/" + b64(packed), "x" * 501 + "_" + b64(zlib.compress(HEXKEY.encode()))]
    want = [{k for _, k, _ in secrets.all_spans(t)} for t in texts]
    assert sum(map(bool, want)) == 22
    monkeypatch.setattr(secrets, "PIECE", piece)
    for t, kinds in zip(texts, want, strict=True):
        got = secrets.byte_kinds(lambda t=t: iter([gzip.compress(t.encode())]), frozenset())
        assert got == kinds, (piece, t[:40])
