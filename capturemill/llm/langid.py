"""Language identification by unigrams over pieces, with all segmentations summed.

The pieces are a public vocabulary of byte strings, whole, and all single bytes. Each language has a probability for each
piece. A word (lower case, with the space before it) is scored by the forward algorithm: the sum, over all ways to cut
it into pieces, of the product of the pieces' probabilities. A text's score is the product over its words; the answer is the
language of the largest score with its share of the prior, and ``score`` is its posterior share.

Probabilities are learned by expectation maximisation (forward and backward sums give each piece's expected count) on a
bounded sample: about ``docs_per_lang`` labelled texts per language, chosen by a hash of the id, whole texts.
Pieces don't cross words. Words of up to ``SHORT`` bytes are worked side by side with the words of their length; a longer one,
of any length, is worked by itself in logarithms. Both sum the same segmentations, in learning and in scoring.

Defined cases: a null text, or one without a letter, is ``und`` with score 0. Null labels aren't learned from. With
no labelled row every text is ``und``. Equal rows get equal answers. An empty table gives no rows. Columns that aren't named are ignored.
"""

from __future__ import annotations

import os
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, crc_mod, give_back, mix, small_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Bytes of a word (with its space) that is worked with others, and words worked at once.
SHORT, TOGETHER = 40, 4_000
#: Bytes of words that a task holds scores for; words of more than KEPT bytes aren't held.
CACHE, KEPT = 8_000_000, 64
_LETTER = re.compile(r"[^\W\d_]")
_K, _L = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SCALE = 2.5  # each byte's factor exp(2.5) keeps products near 1


def load_pieces(path: str = VOCABULARY) -> list[bytes]:
    """The vocabulary's byte strings, and all single bytes. ``path`` is a file of base64 strings and ranks that every driver of a job can read."""
    import base64

    if not os.path.exists(path):
        raise FileNotFoundError(f"no vocabulary at {path}: give the path of a tiktoken file")
    with open(path, "rb") as f:
        pieces = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
    return sorted(pieces | {bytes([i]) for i in range(256)})


class PieceModel:
    """Pieces and their probabilities by language."""

    def __init__(self, pieces: list[bytes], langs: list[str]):
        self.langs = langs
        sizes = np.array([len(p) for p in pieces])
        self.lengths = frozenset(sizes.tolist())
        self.longest = int(sizes.max())
        hashes = np.zeros(len(pieces), dtype=np.uint64)
        for n in self.lengths:
            at = np.flatnonzero(sizes == n)
            h = np.zeros(len(at), dtype=np.uint64)
            for column in np.frombuffer(b"".join(pieces[i] for i in at), dtype=np.uint8).reshape(-1, n).T:
                h = (h ^ column) * _K
            hashes[at] = self._named(h, n)
        order = np.argsort(hashes)
        self.hashes, self.sizes = hashes[order], sizes[order]
        self.seen = np.zeros(1 << 22, dtype=bool)
        self.seen[self.hashes >> np.uint64(42)] = True
        self.set(np.full((len(pieces), len(langs)), 1.0 / len(pieces)))

    def set(self, prob: np.ndarray) -> None:
        self.prob = prob * np.exp(_SCALE * self.sizes)[:, None]
        self.logp = np.log(prob)

    @staticmethod
    def _named(h: np.ndarray, n: int) -> np.ndarray:
        """The hash of byte strings of length ``n`` from the running hash of their bytes."""
        with np.errstate(over="ignore"):
            return mix(h ^ (np.uint64(n) * _L))

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are pieces, and which pieces they are."""
        may = np.flatnonzero(self.seen[h >> np.uint64(42)])
        at = np.minimum(np.searchsorted(self.hashes, h[may]), len(self.hashes) - 1)
        hit = self.hashes[at] == h[may]
        return may[hit], at[hit]

    def lattice(self, rows: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """By place of their end: the pieces in equally long words as (length, words, pieces)."""
        n = rows.shape[1]
        out: list[list] = [[] for _ in range(n + 1)]
        columns = np.ascontiguousarray(rows.T)
        for i in range(n):
            h = np.zeros(len(rows), dtype=np.uint64)
            for k in range(1, min(self.longest, n - i) + 1):
                h = (h ^ columns[i + k - 1]) * _K
                if k in self.lengths:
                    words, pieces = self.find(self._named(h, k))
                    if len(words):
                        out[i + k].append((k, words, pieces))
        return out

    def forward(self, rows: np.ndarray, lattice=None) -> np.ndarray:
        """Forward sums (scaled) at each place: places x words x languages."""
        lattice = lattice or self.lattice(rows)
        a = np.zeros((rows.shape[1] + 1, len(rows), len(self.langs)))
        a[0] = 1
        for i in range(1, len(a)):
            for k, words, pieces in lattice[i]:
                a[i][words] += a[i - k][words] * self.prob[pieces]
        return a

    def long_lattice(self, word: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces in one word, by place of their end: (starts, pieces, edges of the ends' groups)."""
        b = np.frombuffer(word, dtype=np.uint8)
        starts, ends, found = [], [], []
        h = np.zeros(len(b), dtype=np.uint64)
        for k in range(1, min(self.longest, len(b)) + 1):
            h = (h[: len(b) - k + 1] ^ b[k - 1 :]) * _K
            if k in self.lengths:
                at, pieces = self.find(self._named(h, k))
                starts.append(at)
                ends.append(at + k)
                found.append(pieces)
        start, end, piece = (np.concatenate(x) for x in (starts, ends, found))
        order = np.argsort(end, kind="stable")
        return start[order], piece[order], np.searchsorted(end[order], np.arange(1, len(b) + 2))

    def long_forward(self, lattice, n: int) -> np.ndarray:
        """Logarithms of the forward sums at each place of one word."""
        start, piece, edge = lattice
        a = np.full((n + 1, len(self.langs)), -np.inf)
        a[0] = 0
        for i in range(1, n + 1):
            x = slice(edge[i - 1], edge[i])
            a[i] = np.logaddexp.reduce(a[start[x]] + self.logp[piece[x]], axis=0)
        return a

    def score_words(self, words: list[bytes]) -> np.ndarray:
        """log probability of each word by language."""
        out = np.zeros((len(words), len(self.langs)))
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) < SHORT:
                by.setdefault(len(w) + 1, []).append(i)
            else:
                w = b" " + w
                out[i] = self.long_forward(self.long_lattice(w), len(w))[-1]
        for n, own in by.items():
            for j in range(0, len(own), TOGETHER):
                part = own[j : j + TOGETHER]
                rows = np.frombuffer(b"".join(b" " + words[i] for i in part), dtype=np.uint8).reshape(-1, n)
                out[part] = np.log(np.maximum(self.forward(rows)[n], 1e-300)) - _SCALE * n
        return out

    def improve(self, words: list[bytes], counts: np.ndarray, smooth: float = 0.05) -> None:
        """One step of expectation maximisation from words and their counts (words x languages)."""
        sums = np.zeros((len(self.hashes), len(self.langs)))

        def add(pieces: np.ndarray, share: np.ndarray) -> None:
            for c in range(len(self.langs)):
                sums[:, c] += np.bincount(pieces, weights=share[:, c], minlength=len(sums))

        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) < SHORT:
                by.setdefault(len(w) + 1, []).append(i)
            else:
                self._expect_long(b" " + w, counts[i], add)
        for n, own in by.items():
            for j in range(0, len(own), TOGETHER):
                part = own[j : j + TOGETHER]
                rows = np.frombuffer(b"".join(b" " + words[i] for i in part), dtype=np.uint8).reshape(-1, n)
                lat = self.lattice(rows)
                a = self.forward(rows, lat)
                b = np.zeros_like(a)
                b[n] = counts[part] / np.maximum(a[n], 1e-300)
                pieces, shares = [], []
                for i in range(n, 0, -1):
                    for k, at, found in lat[i]:
                        p = self.prob[found]
                        b[i - k][at] += b[i][at] * p
                        pieces.append(found)
                        shares.append(a[i - k][at] * b[i][at] * p)
                add(np.concatenate(pieces), np.concatenate(shares))
        sums += smooth
        self.set(sums / sums.sum(axis=0))

    def _expect_long(self, word: bytes, counts: np.ndarray, add) -> None:
        """Expected counts of the pieces of one long word."""
        start, piece, edge = lat = self.long_lattice(word)
        a = self.long_forward(lat, len(word))
        b = np.full_like(a, -np.inf)
        b[-1] = 0
        for i in range(len(word), 0, -1):
            x = slice(edge[i - 1], edge[i])
            s = start[x]  # distinct, as the ends are the same
            b[s] = np.logaddexp(b[s], b[i] + self.logp[piece[x]])
        end = np.repeat(np.arange(1, len(word) + 1), np.diff(edge))
        add(piece, np.exp(a[start] + self.logp[piece] + b[end] - a[-1]) * counts)


def train(docs: DataFrame, pieces: list[bytes], docs_per_lang: int = 120, rounds: int = 2) -> tuple[PieceModel, np.ndarray] | None:
    """Model and log priors from rows of ``doc_id, text, lang``; None without labelled rows."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not n:
        return None
    langs = sorted(n)
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, docs_per_lang / n[k])))])
    u = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_003)) / 1_000_003.0
    some = labelled.filter(u < F.element_at(share, F.col("lang")))
    words = some.select("lang", F.explode(F.split(F.lower("text"), SPACES)).alias("w")).filter("w <> ''").groupBy("lang", "w").count()
    ids: dict[bytes, int] = {}
    cells = [(ids.setdefault(r.w.encode(), len(ids)), langs.index(r.lang), r["count"]) for r in words.toLocalIterator()]
    counts = np.zeros((len(ids), len(langs)))
    for i, j, c in cells:
        counts[i, j] = c
    model = PieceModel(pieces, langs)
    for _ in range(rounds):
        model.improve(list(ids), counts)
    total = sum(n.values())
    return model, np.log(np.array([n[k] / total for k in langs]))


class Scorer:
    """Predictions for texts, with the scores of words seen before."""

    def __init__(self, model: PieceModel, prior: np.ndarray):
        self.model, self.prior = model, prior
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.scores = np.zeros((1024, len(self.model.langs)))
        self.held = 0

    def _hold(self, words: list[bytes]) -> None:
        found, n = self.model.score_words(words), len(self.place)
        while n + len(words) > len(self.scores):
            self.scores = np.concatenate((self.scores, np.zeros_like(self.scores)))
        self.scores[n : n + len(words)] = found
        self.place.update(zip(words, range(n, n + len(words)), strict=True))
        self.held += sum(map(len, words)) + 8 * len(words)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not _LETTER.search(text):
            return "und", 0.0
        words = text.lower().encode(errors="replace").split()
        if new := list({w for w in words if w not in self.place and len(w) <= KEPT}):
            self._hold(new)
        z = self.scores[[self.place[w] for w in words if len(w) <= KEPT]].sum(axis=0) + self.prior
        for w in words:
            if len(w) > KEPT:
                z = z + self.model.score_words([w])[0]
        z = np.exp(z - z.max())
        best = int(z.argmax())
        return self.model.langs[best], float(z[best] / z.sum())

    def batch(self, texts: list[str | None]):
        """Predictions of some texts, whose new words are worked together."""
        at, size = 0, 0
        out: list[tuple[str, float]] = []
        for i, t in enumerate([*texts, None]):
            size += len(t or "")
            if size > 500_000 or i == len(texts):
                if self.held > CACHE:
                    self.clear()
                new = {w for t in texts[at : i + 1] if t and _LETTER.search(t) for w in t.lower().encode(errors="replace").split()}
                if new := [w for w in new if w not in self.place and len(w) <= KEPT]:
                    self._hold(new)
                out += map(self.predict, texts[at : i + 1])
                at, size = i + 1, 0
        return out


def predictor(held):
    """A column function ``text -> struct<lang_pred, score>``; only the text goes to Python."""
    from typing import Iterator

    import pyarrow as pa

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(*held.value)
        for b in batches:
            out = scorer.batch(b.to_pylist())
            yield pa.StructArray.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], names=["lang_pred", "score"])
        del scorer
        give_back()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "lang_pred string, score double").asNondeterministic()


def fitted(learn: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY, modulus: int = 4, held_out: int = 2, **training) -> tuple[Column | None, Column]:
    """From the rows of ``learn`` that aren't held out: a function of a text column (None without a labelled row), and which rows are held out."""
    small_batches(learn.sparkSession)
    out = crc_mod(F.col(id_col), modulus) == held_out
    lang = F.col("lang") if "lang" in learn.columns else F.lit(None)
    fit = train(learn.filter(~out).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), lang.cast("string").alias("lang")), load_pieces(path), **training)
    return None if fit is None else predictor(learn.sparkSession.sparkContext.broadcast(fit)), out


def identify(docs: DataFrame, learn: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", **training) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``. Learns from the rows of ``learn`` (default: ``docs``) that aren't held out."""
    predict, out = fitted(docs if learn is None else learn, id_col, text_col, **training)
    if predict is None:
        return docs.select(F.col(id_col).alias("doc_id"), out.alias("held_out"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    found = docs.select(F.col(id_col).alias("doc_id"), out.alias("held_out"), predict(F.col(text_col).cast("string")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_known(docs: DataFrame, min_score: float = 0.5, **training) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text has a known language by a share of ``min_score`` or more."""
    predict, _ = fitted(docs, **training)
    if predict is None:
        return docs.limit(0)
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), predict(F.col("text").cast("string")).alias("p"))
    return found.filter((F.col("p.lang_pred") != "und") & (F.col("p.score") >= min_score)).select("row.*")
