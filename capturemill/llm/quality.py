"""Quality rules by distribution divergence, on DataFrame functions alone.

A document's histogram over character classes and its histogram over common words are compared, by the
Jensen-Shannon distance (base 2, so 0 to 1), with the same histograms of each reference language. References
are the summed histograms of all documents that carry the language's label and pass the base rule. The
document is dropped when its least distance over the languages is above the limit. Guards: the character
test needs ``min_chars`` characters and the word test ``min_words`` words; a shorter text isn't judged by it,
as a histogram of a few words is far from any reference by chance alone. For the same reason the limit of the word
test is ``max_common + 0.7 / sqrt(words)``.

Defined cases: a null or empty text has no words and fails the base rule. Rows with equal ids are judged each
for itself. A language without labelled documents has no reference; with no reference at all the base rule decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, checkpointed

# Common words of the reference languages, each list by language.
COMMON = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "was", "on", "are", "as", "with", "be", "at", "by", "this", "from", "or", "an"],
    "fr": ["le", "la", "les", "de", "des", "du", "et", "en", "un", "une", "que", "qui", "est", "pour", "dans", "pas", "sur", "avec", "au", "il", "elle"],
    "de": ["der", "die", "das", "und", "ist", "von", "mit", "den", "dem", "ein", "eine", "nicht", "zu", "auf", "im", "für", "sich", "als", "des", "auch", "er"],
    "es": ["el", "la", "los", "las", "de", "que", "y", "en", "un", "una", "se", "del", "por", "con", "no", "su", "para", "al", "es", "lo", "como"],
}
WORDS = list(dict.fromkeys(w for words in COMMON.values() for w in words))
#: Character classes by pattern; what is in none of them is white space.
CLASSES = {"lower": r"\p{Ll}", "upper": r"\p{Lu}", "digit": r"\p{Nd}", "stop": r"[.,;:!?'\"]", "symbol": r"[#*$%&|<>@+=~^_{}\[\]\\/()-]"}
#: One letter for each common word, so that a text's common words are one short string.
_LETTERS = ["", *(chr(33 + i) for i in range(len(WORDS)))]
assert len(_LETTERS) <= 94


def _rest(text: Column, keep: str) -> Column:
    """The characters of ``text`` in the class ``keep``."""
    inner = keep[1:-1] if keep.startswith("[") else keep
    return F.regexp_replace(text, f"[^{inner}]++", "")


def _letter(word: Column) -> Column:
    """The letter of a common word, looked up among those of its length; of any other word the empty text."""
    size, found = F.length(word), None
    for k in sorted({len(w) for w in WORDS}):
        of = [w for w in WORDS if len(w) == k]
        code, letter = F.array(*[F.lit(w) for w in of]), F.array(F.lit(""), *[F.lit(_LETTERS[1 + WORDS.index(w)]) for w in of])
        at = F.get(letter, F.array_position(code, word).cast("int"))
        found = F.when(size == k, at) if found is None else found.when(size == k, at)
    return found.otherwise("")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, label, base counts and the two histograms."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    out = docs.select(F.col(id_col).alias("doc_id"), lang.cast("string").alias("lang"), text.alias("t"))
    out = out.select("doc_id", "lang", "t", F.filter(F.split("t", SPACES), lambda w: w != "").alias("w"))
    n = F.size("w")
    # Windows as hashes of three words, each with its place, in the order of the hashes.
    window = F.transform(F.slice("w", 3, F.greatest(n - 2, F.lit(0))), lambda x, i: F.struct(F.xxhash64(F.get("w", i), F.get("w", i + 1), x).alias("h"), i.alias("i")))
    letters = F.transform(F.transform("w", lambda x: F.lower(F.rtrim(x, F.lit(".,")))), _letter)
    out = out.select(
        "doc_id",
        "lang",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length("t").alias("chars"),
        F.length(_rest(F.col("t"), "[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0).alias("lines"),
        *[F.length(_rest(F.col("t"), p)).alias(f"c_{k}") for k, p in CLASSES.items()],
        F.sort_array(window).alias("win"),
        F.array_join(letters, "").alias("codes"),
    )
    hits = _hits(F.col("win"))
    out = out.select("*", hits.alias("at")).drop("win")
    gaps = F.transform("at", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("at", i + 1) - p, F.lit(3))))
    known = reduce(lambda a, b: a + b, [F.col(f"c_{k}") for k in CLASSES])
    return out.select(
        "doc_id",
        "lang",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(gaps, F.lit(0), lambda a, x: a + x).cast("long").alias("n_repeat_words"),
        F.array(*[F.col(f"c_{k}").cast("double") for k in CLASSES], (F.col("chars") - known).cast("double")).alias("classes"),
        F.array(*[(F.length("codes") - F.length(F.replace("codes", F.lit(x), F.lit("")))).cast("double") for x in _LETTERS[1:]]).alias("common"),
    )


def _hits(win: Column) -> Column:
    """Places of windows equal to a neighbour in hash order, ascending."""
    same = F.filter(win, lambda x, i: (x["h"] == F.get(win, i - 1)["h"]) | (x["h"] == F.get(win, i + 1)["h"]))
    return F.sort_array(F.transform(same, lambda x: x["i"]))


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(counts, lambda x: x / F.greatest(total, F.lit(1.0)))


def js_distance(shares: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance, base 2, of a column of shares to fixed shares."""

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    q = F.array(*[F.lit(float(x)) for x in reference])
    terms = F.zip_with(shares, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def _own(common: Column, lang: str, n_words: Column) -> Column:
    """Counts of a language's common words, then of all other words."""
    own = F.transform(F.array(*[F.lit(WORDS.index(w)) for w in COMMON[lang]]), lambda i: F.get(common, i))
    return F.concat(own, F.array(n_words.cast("double") - F.aggregate(own, F.lit(0.0), lambda a, x: a + x)))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def references(feats: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Shares by language over character classes and over common words. One row of sums for each language in COMMON at most reaches the driver."""
    sums = [F.sum(F.get("classes", F.lit(i))).alias(f"k{i}") for i in range(len(CLASSES) + 1)]
    sums += [F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(len(WORDS))] + [F.sum("n_words").alias("n")]
    out = {}
    for r in feats.filter(~base_failed() & F.col("lang").isin(*COMMON)).groupBy("lang").agg(*sums).collect():
        k = [r[f"k{i}"] for i in range(len(CLASSES) + 1)]
        w = [r[f"w{WORDS.index(x)}"] for x in COMMON[r["lang"]]]
        w.append(r["n"] - sum(w))
        out[r["lang"]] = ([x / max(sum(k), 1) for x in k], [x / max(sum(w), 1) for x in w])
    return dict(sorted(out.items()))


def divergence_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_class: float = 0.25, max_common: float = 0.3, min_chars: int = 200, min_words: int = 50) -> DataFrame:
    """Judge every document; see the module's notes. ``class_jsd`` and ``common_jsd`` are the least distances over the languages."""
    feats = checkpointed(features(docs, id_col, text_col))
    refs = references(feats)
    out = feats
    if refs:
        cls, com = F.col("cls"), {k: F.col(f"own_{k}") for k in refs}
        out = feats.select("*", _shares(F.col("classes")).alias("cls"), *[_shares(_own(F.col("common"), k, F.col("n_words"))).alias(f"own_{k}") for k in refs])
        both = F.array(*[F.struct(js_distance(cls, v[0]).alias("a"), js_distance(com[k], v[1]).alias("b")) for k, v in refs.items()])
        out = out.select("*", both.alias("d")).select("*", F.array_min(F.transform("d", lambda x: x["a"])).alias("class_jsd"), F.array_min(F.transform("d", lambda x: x["b"])).alias("common_jsd"))
    else:
        out = feats.select("*", F.lit(None).cast("double").alias("class_jsd"), F.lit(None).cast("double").alias("common_jsd"))
    odd = (F.col("word_chars") >= min_chars) & (F.coalesce("class_jsd", F.lit(0.0)) > max_class)
    odd = odd | ((F.col("n_words") >= min_words) & (F.coalesce("common_jsd", F.lit(0.0)) > max_common + 0.7 / F.sqrt("n_words")))
    out = out.select("*", base_failed().alias("base_failed"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~odd).alias("kept"), "class_jsd", "common_jsd")
