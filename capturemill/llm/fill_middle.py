"""Fill-in-the-middle texts, cut at units that a sparse checkpoint index finds.

A unit is a run of ASCII letters or any other single code point. One pass over a text's UTF-8 bytes counts its units and notes, at every
``EVERY``-th unit, the byte and code-point offsets where it starts. A cut at unit ``u`` is found by a binary search of the checkpoints and
a rescan of ``EVERY`` units at most, so that no list of units or of code points is held. Nothing is shuffled: each row stands alone.

Defined cases: a null text is taken as empty; an empty text, one that holds a sentinel, and one that the rate leaves out stay ``plain``; a
null id is written as nothing in the key of the draws; equal ids draw equally; a very long text, or a very long run of letters, is
scanned in pieces; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, trimmed

P, S, M = "<P>", "<S>", "<M>"
#: Units between two checkpoints.
EVERY = 1024
_PIECE = 1 << 16
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _scan(data: bytes, begin: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where units and code points start in ``data[begin:begin + size]``, by the byte before it as well."""
    b = np.frombuffer(data, np.uint8, min(size, len(data) - begin), begin)
    letter = _LETTER[b]
    before = np.empty_like(letter)
    before[1:] = letter[:-1]
    before[:1] = begin > 0 and _LETTER[data[begin - 1]]
    point = (b & 0xC0) != 0x80
    return point & ~(letter & before), point


class Checkpoints:
    """The number of units and code points of a text, and the offsets of every ``every``-th unit."""

    def __init__(self, data: bytes, every: int = EVERY):
        self.data, self.every = data, every
        units = points = 0
        self.unit_at, self.byte_at, self.point_at = [], [], []
        for begin in range(0, len(data), _PIECE):
            starts, point = _scan(data, begin, _PIECE)
            at = np.flatnonzero(starts)
            chosen = at[(-units) % every :: every]
            if len(chosen):
                passed = np.cumsum(point)
                self.unit_at += range(units + (-units) % every, units + len(at), every)
                self.byte_at += (chosen + begin).tolist()
                self.point_at += (passed[chosen] - 1 + points).tolist()
            units += len(at)
            points += int(point.sum())
        self.n, self.n_points = units, points

    def seek(self, unit: int) -> tuple[int, int]:
        """Byte and code-point offset at which a unit starts; those of the end for the number of units."""
        if unit >= self.n:
            return len(self.data), self.n_points
        i = bisect_right(self.unit_at, unit) - 1
        left, begin, passed = unit - self.unit_at[i], self.byte_at[i], self.point_at[i]
        size = 2 * self.every
        while True:
            starts, point = _scan(self.data, begin, size)
            at = np.flatnonzero(starts)
            if len(at) > left:
                return begin + int(at[left]), passed + int(point[: at[left]].sum())
            left, begin, passed, size = left - len(at), begin + len(point), passed + int(point.sum()), _PIECE


def draws(id_col: Column, seed: str = "1", n: int = 4) -> list[Column]:
    """The first ``n`` 32-bit groups of the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def _arrange(every: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = {k: [] for k in ("n", "form", "prefix_chars", "middle_chars", "output")}
            texts = batch.column("text").cast(pa.binary())
            for i, (h1, h2, form) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("h1", "h2", "form")), strict=True)):
                data = texts[i].as_py()
                index = Checkpoints(data, every)
                cut = [None, None]
                if form != "plain":
                    (a, p), (b, q) = (index.seek(u) for u in sorted((h1 % (index.n + 1), h2 % (index.n + 1))))
                    prefix, middle, suffix, cut = data[:a], data[a:b], data[b:], [p, q - p]
                    data = b"".join((b"<P>", prefix, b"<S>", suffix, b"<M>", middle) if form == "psm" else (b"<S>", suffix, b"<P>", prefix, b"<M>", middle))
                for k, v in zip(out, (index.n, form, *cut, data), strict=True):
                    out[k].append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, t).cast(pa.string()) if k == "output" else pa.array(v, t) for (k, v), t in zip(out.items(), kinds, strict=True))], ["doc_id", *out])

    return trimmed(run)


def fill_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1", rate: int = 90, spm: int = 20, every: int = EVERY) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each row. ``rate`` percent of the texts are cut, ``spm`` percent of these with the suffix first."""
    small_batches(df.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2, h3, h4 = draws(F.col(id_col), seed)
    plain = (text == "") | (h3 % 100 >= rate)
    for mark in (P, S, M):
        plain = plain | F.contains(text, F.lit(mark))
    form = F.when(plain, "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("doc_id"), text.alias("text"), h1.alias("h1"), h2.alias("h2"), form.alias("form"))
    return rows.mapInArrow(_arrange(every), f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text from an output and its form alone."""
    body = F.substring(output, 4, 2**31 - 1)

    def between(text: Column, a: str, b: str | None) -> Column:
        tail = F.substring(text, F.instr(text, a) + 3, F.lit(2**31 - 1)) if a else text
        return F.substring_index(tail, b, 1) if b else tail

    psm = F.concat(between(body, "", S), between(body, M, None), between(body, S, M))
    spm = F.concat(between(body, P, M), between(body, M, None), between(body, "", P))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digests(rows: DataFrame) -> DataFrame:
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
