"""Secret scans with recursive decoding.

The base patterns are run over a text. Then its layers are unwrapped: runs with percent or backslash escapes (``\\x70``, ``\\u0070``, pairs of
surrogates, ``\\u{70}``), base64 runs, and base64 runs that hold compressed streams, one in another and one after another. Base64 is decoded at all
four alignments, as what stands before it may be of its alphabet too (a path, a prefix and a dash), and lines of base64 that follow one
another are one run; a readable stretch of 12 bytes or more of what comes out, UTF-8 or ASCII in UTF-16, is a layer. Each decoded layer is scanned with the same
patterns and unwrapped in turn, wherever it occurs. A layer whose text or bytes it was itself unwrapped from isn't unwrapped again, so cycles
end. A text's findings are kept and mapped to all of its occurrences; a finding in a layer is reported at the span of the text
around it that its first to last character came from, and so on out to the original.

All that lies in a compressed stream maps to the whole run that holds it, so only the kinds found in it matter. It is
inflated in pieces, again for each look at it, and never held: its memory is bounded at any size, its time is in proportion to what it inflates to.

Defined cases: null is the empty text. Empty texts have no spans. A run that doesn't decode to text (UTF-8 and
printable, but for line ends and tabs) isn't a layer; nor are raw deflate streams, other compressions and encodings, or base64 of another alphabet. Base64 lines
within a compressed stream's content are one run up to ``PIECE`` characters. Equal rows get equal spans. Spans found twice are listed once.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, trimmed

KINDS = ("assign", "access", "hex")


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(_either, ("password", "passwd", "secret", "token")), _either("api") + "_?" + _either("key")])
ASSIGN = re.compile(rf"(?:{_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
_CODE = r"\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}"
_ESCAPED = re.compile(rf"(?:[^\s%\\\"'<>]++|%[0-9A-Fa-f]{{2}}|{_CODE}|\\(?=(?:[ux][0-9A-Fa-f{{]{{0,5}})?(?:%[0-9A-Fa-f]{{2}}|{_CODE})))++")  # a backslash alone, if its escape hides behind other escapes
_UNIT = re.compile(r"((?:%[0-9A-Fa-f]{2})+)|\\u([dD][89abAB][0-9A-Fa-f]{2})\\u([dD][c-fC-F][0-9A-Fa-f]{2})|\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})")
_HAS_ESCAPE = re.compile(rf"%[0-9A-Fa-f]{{2}}|{_CODE}")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+[\x20\t]*+\r?\n[\x20\t]*+)+[A-Za-z0-9+/_-]++={0,2}")
#: UTF-8 text without controls but line ends and tabs; ASCII in UTF-16, either end first.
_SIGN = rb"(?:[\t\n\r\x20-\x7e]|\xc2[\xa0-\xbf]|[\xc3-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})"
_READABLE = re.compile(_SIGN + rb"{12,}+")
_WIDE = re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){6,}+|(?:\x00[\t\n\r\x20-\x7e]){6,}+")
#: One unit or more of these, with the most bytes behind a unit's first.
_UNITS = [(re.compile(_SIGN + rb"++"), 3), (re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00)++"), 1), (re.compile(rb"(?:\x00[\t\n\r\x20-\x7e])++"), 1)]
_ALPHABET = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_PERCENT = re.compile(r"%[0-9A-Fa-f]{2}")
#: Bytes or characters of a compressed stream's content that are looked at together, and the longest stretch of text that decides whether a base pattern matches, blanks as one.
PIECE, NEAR = 1_000_000, 64
_UNPRINTABLE = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f�]")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the base patterns' matches, in order."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _printable(raw: bytes) -> str | None:
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    return None if not text or _UNPRINTABLE.search(text) else text


def _escapes(run: str) -> tuple[str, array, array]:
    """The run without escapes, with the start and end in the run of each character."""
    text, start, end, at = [], array("L"), array("L"), 0

    def plain(a: int, b: int) -> None:
        text.append(run[a:b])
        start.extend(range(a, b))
        end.extend(range(a + 1, b + 1))

    def put(s: str, a: int, b: int) -> None:
        text.append(s)
        start.append(a)
        end.append(b)

    for m in _UNIT.finditer(run):
        plain(at, m.start())
        at = m.end()
        if m[1]:
            raw, i = bytes.fromhex(m[1].replace("%", "")), m.start()
            try:
                for c in raw.decode():
                    n = 3 * len(c.encode())
                    put(c, i, i + n)
                    i += n
            except UnicodeDecodeError:
                for k, x in enumerate(raw):
                    put(chr(x) if x < 128 else "\ufffd", m.start() + 3 * k, m.start() + 3 * k + 3)
        elif m[2]:
            put(chr(0x10000 + ((int(m[2], 16) & 0x3FF) << 10) + (int(m[3], 16) & 0x3FF)), m.start(), m.end())
        else:
            code = int(m[4] or m[5] or m[6], 16)
            put("\ufffd" if 0xD800 <= code < 0xE000 or code > 0x10FFFF else chr(code), m.start(), m.end())
    plain(at, len(run))
    return "".join(text), start, end


def _unbase64(run: str) -> bytes | None:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None


# --- compressed streams, in pieces ----------------------------------------------------------------------

Bytes, Texts = Callable[[], Iterator[bytes]], Callable[[], Iterator[str]]


def _packed(raw: bytes) -> bool:
    """Whether bytes begin as a gzip or zlib stream does."""
    return raw[:2] == b"\x1f\x8b" or (raw[:1] == b"\x78" and len(raw) > 2 and (raw[0] * 256 + raw[1]) % 31 == 0)


def inflated(source: Bytes) -> Iterator[bytes]:
    """The content of compressed streams, one after another. What follows the last is left."""
    stream, left = zlib.decompressobj(47), b""
    for raw in source():
        raw = left + raw
        left = b""
        while raw:
            if stream is None:
                if len(raw) < 3:
                    left = raw
                    break
                if not _packed(raw):
                    return
                stream = zlib.decompressobj(47)
            data = stream.decompress(raw, PIECE)
            if data:
                yield data
            raw = stream.unused_data if stream.eof else stream.unconsumed_tail
            if stream.eof:
                stream = None
    while stream is not None and (data := stream.decompress(stream.unconsumed_tail, PIECE)):
        yield data


def _decoded(source: Bytes) -> Iterator[str]:
    decoder = codecs.getincrementaldecoder("utf-8")()
    for raw in source():
        if text := decoder.decode(raw):
            yield text
    decoder.decode(b"", True)


def _examined(source: Bytes) -> tuple[bytes, bool, bool, bytes | None]:
    """A byte layer's digest, whether it reads as text, whether it begins as a compressed stream, and all of it if it is short."""
    digest, decoder, text, size, short = hashlib.blake2b(digest_size=16), codecs.getincrementaldecoder("utf-8")(), True, 0, b""
    for raw in source():
        digest.update(raw)
        short = short + raw if size < PIECE else short
        size += len(raw)
        if text:
            try:
                text = not _UNPRINTABLE.search(decoder.decode(raw))
            except UnicodeDecodeError:
                text = False
    try:
        decoder.decode(b"", True)
    except UnicodeDecodeError:
        text = False
    return digest.digest(), text and size > 0, _packed(short[:3]), short if size <= PIECE else None


def byte_kinds(source: Bytes, path: frozenset[bytes]) -> set[int] | None:
    """Kinds found in what a byte layer unwraps to (None: it isn't one). Layers of ``path`` end it."""
    text = None
    while True:
        try:
            digest, readable, packed, short = _examined(source)
        except zlib.error:
            break
        if digest in path:
            break
        path = path | {digest}
        if short is not None:
            source = partial(iter, (short,))
        if readable:
            text = partial(_decoded, source), path
        if not packed:
            break
        source = partial(inflated, source)
    return text and text_kinds(*text)


def _between(source: Texts, a: int, b: int) -> Iterator[str]:
    at = 0
    for t in source():
        if at + len(t) > a and at < b:
            yield t[max(0, a - at) : b - at]
        at += len(t)
        if at >= b:
            return


def _stretches(source: Texts) -> Iterator[str | tuple[int, int]]:
    """A text in parts of about PIECE characters that end at white space, and the places of longer stretches without any."""
    held, at, begun = "", 0, None  # ``at``: where ``held`` begins; ``begun``: where the long stretch does
    for t in source():
        if begun is not None:
            m = re.search(r"\s", t)
            if not m:
                at += len(t)
                continue
            yield begun, at + m.start()
            at, t, begun = at + m.start(), t[m.start() :], None
        held += t
        if len(held) >= PIECE:
            cut = max(held.rfind(" "), held.rfind("\n"), held.rfind("\t")) + 1
            if cut:
                yield held[:cut]
                held, at = held[cut:], at + cut
            if len(held) >= PIECE:
                begun, at, held = at, at + len(held), ""
    if begun is not None:
        yield begun, at
    elif held:
        yield held


def _cut(held: str) -> int:
    """Where a run may be cut: before an escape that may be incomplete and the group of percent escapes it ends, or between the characters of a very long group."""
    cut = len(held)
    last = max(held.rfind("%", max(0, cut - 2)), held.rfind("\\", max(0, cut - 11)))
    if last >= 6 and held[last - 6 : last - 4] == "\\u":  # the first of a pair, perhaps
        last -= 6
    low = cut = cut if last < 0 else last
    while low >= 3 and _PERCENT.fullmatch(held, low - 3, low):
        low -= 3
    if low or len(held) < 2 * PIECE:
        return low
    while cut > 3 and int(held[cut - 2 : cut], 16) & 0xC0 == 0x80:
        cut -= 3
    return cut - 3


def _unescaped(source: Texts) -> Iterator[str]:
    """A long run without its escapes."""
    held = ""
    for t in source():
        held += t
        if len(held) > PIECE and (cut := _cut(held)) > 0:
            yield _escapes(held[:cut])[0]
            held = held[cut:]
    if held:
        yield _escapes(held)[0]


def _bytes_of(source: Texts) -> Iterator[bytes]:
    """A long base64 run decoded in pieces."""
    held = ""
    for t in source():
        held += t
        cut = len(held) // 4 * 4 - 4
        if cut > 0:
            yield _unbase64(held[:cut]) or b""
            held = held[cut:]
    yield _unbase64(held) or b""


def text_kinds(source: Texts, path: frozenset[bytes]) -> set[int]:
    """Kinds found in a text that comes in pieces, and in its layers."""
    found: set[int] = set()
    near = ""
    for t in source():
        near = re.sub("\x20{2,}", " ", near + t)
        found.update(k for _, k, _ in base_spans(near))
        near = near[-NEAR:]
    for part in _stretches(source):
        if len(found) == len(KINDS):
            break
        if isinstance(part, str):
            found.update(k for _, k, _ in all_spans(part, outer=path))
            continue
        run = partial(_between, source, *part)
        if any(_HAS_ESCAPE.search(x) for x in run()):
            found |= text_kinds(partial(_unescaped, run), path)
        at, begun, held = 0, None, []
        for t in _with_end(run()):
            for m in _ALPHABET.finditer(t):
                if begun is not None and m.start() > 0:
                    found |= _run_kinds(source, part[0] + begun, part[0] + at, held, path)
                    begun, held = None, []
                begun = at + m.start() if begun is None else begun
                held = [*held, m[0]] if sum(map(len, held)) < PIECE else held
                if m.end() < len(t):
                    found |= _run_kinds(source, part[0] + begun, part[0] + at + m.end(), held, path)
                    begun, held = None, []
            if begun is not None and not _ALPHABET.match(t):
                found |= _run_kinds(source, part[0] + begun, part[0] + at, held, path)
                begun, held = None, []
            at += len(t)
    return found


def _with_end(pieces: Iterator[str]) -> Iterator[str]:
    yield from pieces
    yield " "


def _run_kinds(source: Texts, a: int, b: int, held: list[str], path: frozenset[bytes]) -> set[int]:
    """Kinds in a base64 run at ``a`` to ``b`` of a text; ``held`` is its text if it is short; a longer one is decoded in pieces, with the same result."""
    if b - a < 16:
        return set()
    if b - a <= PIECE:
        return {k for _, k, _ in all_spans("".join(held)[: b - a], outer=path)}
    # What `_of_base64` does, in pieces.
    out: set[int] = set()
    for shift in range(4):
        raw = partial(_bytes_of, partial(_between, source, a + shift, b))
        _, whole, packed, _ = _examined(raw)
        if whole:
            return out | text_kinds(partial(_decoded, raw), path)
        for i in [*([0] if packed else []), *_gzips(raw)]:
            out |= byte_kinds(partial(_bytes_between, raw, i), path) or set()
        for unit, tail in _UNITS:
            for x, y, held_bytes in _runs(raw, unit, tail):
                got = partial(_bytes_between, raw, x, y) if held_bytes is None else partial(iter, (held_bytes,))
                if y - x >= 12 and (tail == 1 or y - x >= 48 or len(held_bytes.decode()) >= 12):
                    out |= text_kinds(partial(_decoded, partial(_narrow, got) if tail == 1 else got), path)
    at, near = a, ""
    for t in _between(source, a, b):
        near += t
        for m in re.finditer("[/_+-](?=(.{4}))", near):
            if (head := _unbase64(m[1])) and _packed(head):
                out |= byte_kinds(partial(_bytes_of, partial(_between, source, at + m.end(), b)), path) or set()
        at, near = at + max(0, len(near) - 4), near[-4:]
    return out


def _bytes_between(source: Bytes, a: int, b: int | None = None) -> Iterator[bytes]:
    at = 0
    for raw in source():
        if at + len(raw) > a:
            yield raw[max(0, a - at) : b and b - at]
        at += len(raw)
        if b is not None and at >= b:
            return


def _narrow(source: Bytes) -> Iterator[bytes]:
    for raw in source():
        yield raw.replace(b"\0", b"")


def _gzips(source: Bytes) -> Iterator[int]:
    """Where gzip streams may begin behind the first byte."""
    at, near = 0, b""
    for raw in source():
        near += raw
        yield from (at + m.start() for m in re.finditer(b"\x1f\x8b\x08", near) if at + m.start())
        at, near = at + max(0, len(near) - 2), near[-2:]


def _runs(source: Bytes, unit: re.Pattern[bytes], tail: int) -> Iterator[tuple[int, int, bytes | None]]:
    """The places of all longest runs of ``unit``, which has up to ``tail`` bytes behind its first, and the bytes of those that aren't longer than PIECE."""
    at, left, begun, own = 0, b"", None, b""
    for raw in _with_last(source()):
        left, pos = left + (raw or b""), 0
        while True:
            m = unit.search(left, pos) if begun is None else unit.match(left, pos)
            if begun is None and m is None:
                pos = max(pos, len(left) - tail)
                break
            begun = at + m.start() if begun is None else begun
            end = m.end() if m else pos
            own = own + left[m.start() : end] if m and len(own) <= PIECE else own
            pos = end
            if raw is not None and end >= len(left) - tail:  # it may go on
                break
            yield begun, at + end, own if len(own) <= PIECE else None
            begun, own = None, b""
        at, left = at + pos, left[pos:]


def _with_last(pieces: Iterator[bytes]) -> Iterator[bytes | None]:
    yield from pieces
    yield None


# --- texts in memory ------------------------------------------------------------------------------------


def _layers(text: str, outer: frozenset[bytes]):
    """Each decodable run of a text: ``start, end, decoded text, place`` where ``place`` gives a character's start and end in the run; or the kinds found in a compressed stream, and None."""
    if _HAS_ESCAPE.search(text):
        for m in _ESCAPED.finditer(text):
            if _HAS_ESCAPE.search(m[0]):
                decoded, a, b = _escapes(m[0])
                yield m.start(), m.end(), decoded, lambda x, a=a, b=b: (a[x], b[x])
    for m in _BASE64.finditer(text):
        for decoded, place in _of_base64(m[0], outer):
            yield m.start(), m.end(), decoded, place
    if "\n" in text:
        for m in _LINES.finditer(text):
            kept = [i for i, c in enumerate(m[0]) if c not in " \t\r\n"]
            for decoded, place in _of_base64("".join(m[0].split()), outer):
                yield m.start(), m.end(), decoded, place and (lambda x, place=place, kept=kept: (kept[place(x)[0]], kept[place(x)[1] - 1] + 1))


def _of_base64(run: str, outer: frozenset[bytes]):
    """What a base64 run holds at any of its alignments: ``decoded text, place`` of each readable stretch, or the kinds found in a compressed stream, and None."""
    n = len(run)

    def place_of(at, shift: int):
        # Byte i comes from characters i * 4 // 3 to (i + 1) * 4 / 3, rounded up.
        return lambda x: (shift + at[x] * 4 // 3, min(n, shift - (-at[x + 1] * 4 // 3)))

    for shift in range(4):
        if (raw := _unbase64(run[shift:])) is None:
            continue
        starts = [0] if _packed(raw) else []
        starts += [i.start() for i in re.finditer(b"\x1f\x8b\x08", raw) if i.start()]
        whole = _printable(raw)
        if not whole:
            for i in starts:
                if found := byte_kinds(partial(iter, (raw[i:],)), outer):
                    yield found, None
        for m in _READABLE.finditer(raw):
            text = m[0].decode()
            if text.isascii():
                at = range(m.start(), m.end() + 1)
            else:
                at = array("L", [m.start()])
                for c in text:
                    at.append(at[-1] + len(c.encode()))
            yield text, place_of(at, shift)
        for m in _WIDE.finditer(raw):
            yield m[0].replace(b"\0", b"").decode(), place_of(range(m.start(), m.end() + 2, 2), shift)
        if whole:
            return
    # A stream that begins after a separator of the alphabet, whatever its alignment.
    for m in re.finditer("[/_+-]", run):
        at = m.end()
        if (head := _unbase64(run[at : at + 4])) and _packed(head) and (raw := _unbase64(run[at:])) and (found := byte_kinds(partial(iter, (raw,)), outer)):
            yield found, None


def _mapped(s: int, place, spans) -> set[tuple[int, int, int]]:
    """Spans of a decoded run in places of the text around it."""
    return {(s + place(x)[0], k, s + place(y - 1)[1]) for x, k, y in spans}


def all_spans(text: str, base: list[tuple[int, int, int]] | None = None, outer: frozenset[bytes] = frozenset()) -> list[tuple[int, int, int]]:
    """The base spans and those of all decoded layers, in original places. ``outer`` has the digests of the byte layers that the text was unwrapped from."""
    held: dict[str, set[tuple[int, int, int]]] = {}
    path = {text}  # the texts that are being unwrapped: one in another
    stack: list[list] = [[text, _layers(text, outer), set(), set(), None]]  # text, its layers, spans found, texts at which cycles ended, the run that is being unwrapped
    while True:
        own, layers, found, cut, _ = stack[-1]
        for s, e, decoded, place in layers:
            if place is None:
                found |= {(s, k, e) for k in decoded}
                continue
            spans = set(base_spans(decoded))
            if decoded in path:
                cut.add(decoded)
            elif decoded in held:
                spans |= held[decoded]
            else:
                stack[-1][4] = s, place, spans
                path.add(decoded)
                stack.append([decoded, _layers(decoded, outer), set(), set(), None])
                break
            found |= _mapped(s, place, spans)
        else:
            stack.pop()
            if not stack:
                return sorted(set(base_spans(text) if base is None else base) | found)
            path.discard(own)
            cut.discard(own)
            if not cut:  # else what was found depends on the path
                held[own] = found
            stack[-1][3].update(cut)
            s, place, spans = stack[-1][4]
            stack[-1][2].update(_mapped(s, place, spans | found))


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(batches):
    import pyarrow as pa

    for batch in batches:
        counts: list[list[int]] = [[], [], []]
        digest, spans = [], []
        for t in batch.column(1).to_pylist():
            t = t or ""
            base = base_spans(t)
            for k in range(3):
                counts[k].append(sum(x[1] == k for x in base))
            digest.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(all_spans(t, base)))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digest, pa.string()), pa.array(spans, pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row; the counts and the digest are of the base spans."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(trimmed(_scan), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(text: str, mark: str = "[secret]") -> str:
    """The text with every span replaced, overlapping spans as one."""
    out, at = [], 0
    for a, _, b in all_spans(text):  # by their starts
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])
