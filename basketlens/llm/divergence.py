"""Quality rules: counts per document and its divergence from the language it is said to be in."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.shared import WORD, whole_text
from basketlens.session import staged

# Frequent words by language.
COMMON = {
    "de": ("der", "die", "und", "das", "in", "ist", "zu", "den", "von", "mit"),
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "was", "for"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "del", "se", "por"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "que", "est"),
}
#: Character classes that are counted by their characters. Further ones are white space, bytes of characters beyond
#: their first one, and whatever is left (lower-case letters for the most part).
CLASSES = ("[A-Z]", "[0-9]", r"[.,;:!?'\"()\-]", r"[#*$%&|<>]")
_SPACE = r"[\x20\x09-\x0D]+"
#: What is taken out of a word before it is looked for in the lists.
PUNCTUATION = ".,;:!?'\"()-"
_CHAR_BINS = len(CLASSES) + 3
_LONGEST = max(len(w) for ws in COMMON.values() for w in ws)
#: Longer words, punctuation included, are on no list.
AT_MOST = _LONGEST + 3
_BINS = 1 + max(map(len, COMMON.values()))


@dataclass(frozen=True)
class Limits:
    """When a document is refused. Divergences are Jensen-Shannon distances with base 2, 0 to 1."""

    words: int = 20
    repeat_percent: int = 30
    char_divergence: float = 0.32
    #: Of the divergence that a text without a single frequent word has from the reference.
    word_share: float = 0.9
    #: Shorter documents are not judged by that histogram.
    chars_least: int = 100
    words_least: int = 60


LIMITS = Limits()


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, even where the body refers to it in a lambda."""
    return F.transform(F.array(value), body)[0]


def _histograms(rows: DataFrame) -> DataFrame:
    """rows (text, lang, ...) with words, word_chars and the counts char_counts (of bytes) and word_counts."""
    rows = rows.withColumn("words", F.array_remove(F.split("text", _SPACE), ""))
    rows = rows.withColumns(
        {
            "word_chars": F.char_length(F.array_join("words", "")),
            "few": F.filter("words", lambda w: F.char_length(w) <= AT_MOST),
            "marked": F.regexp_replace("text", r"[a-z\x20\x09-\x0D]+", ""),
            "common": F.create_map(*[x for lang, ws in COMMON.items() for x in (F.lit(lang), F.array(*map(F.lit, ws)))])[F.col("lang")],
        }
    )
    rows = rows.withColumn("classes", F.array(*[F.regexp_count("marked", F.lit(characters)) for characters in CLASSES]))
    chars, size, found = F.char_length("text"), F.octet_length("text"), F.col("classes")
    spaces, more = chars - F.col("word_chars"), size - chars
    rest = chars - spaces - sum((found[i] for i in range(len(CLASSES))), F.lit(0))
    bare = F.translate(F.lower(F.array_join("few", " ")), PUNCTUATION, "")
    rows = rows.withColumn("short", F.filter(F.split(bare, " "), lambda w: F.char_length(w) <= _LONGEST))
    # counted in lower case and without punctuation; a word that is not on the list of the language is in bin 0
    counted = F.transform("common", lambda w: F.size("short") - F.size(F.array_remove("short", w)))
    none = F.array(*[F.lit(0)] * (_BINS - 1))
    rows = rows.withColumns({"char_counts": F.concat("classes", F.array(spaces, more, rest)), "hits": F.coalesce(counted, none)})
    other = F.size("words") - F.aggregate("hits", F.lit(0), lambda a, x: a + x)
    return rows.withColumn("word_counts", F.concat(F.array(other), "hits")).drop("few", "short", "marked", "classes", "common", "hits")


def _taken(docs: DataFrame, *keep: str) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(None)
    return docs.select(row.alias("row"), whole_text().alias("text"), F.col("lang").cast("string").alias("lang"))


def references(counted: DataFrame) -> DataFrame:
    """For each language (null is one) the character-class and common-word counts of all rows of `counted`, and in
    `word_alone` how far a text without any common word is from the latter."""
    sums = [
        F.array(*[F.sum(F.col(name)[i]) for i in range(n)]).alias(alias)
        for name, alias, n in (("char_counts", "char_reference", _CHAR_BINS), ("word_counts", "word_reference", _BINS))
    ]
    alone = F.array(F.lit(1), *[F.lit(0)] * (_BINS - 1))
    return counted.groupBy("lang").agg(*sums).withColumn("word_alone", _distance(alone, F.col("word_reference")))


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms; 0 where one is empty, as nothing is known then."""

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def term(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        return (part(p, m) + part(q, m)) / 2

    def shares(xs: Column) -> Column:
        return _let(F.nullif(total(xs), F.lit(0)), lambda n: F.transform(xs, lambda x: x / n))

    terms = F.zip_with(shares(counts), shares(reference), term)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)))


def _windows() -> Column:
    """Hashes of all windows of 8 words by position: of pairs of words, then of fours and eights."""

    def paired(step: int) -> Callable[[Column], Column]:
        def both(hs: Column) -> Column:
            n = F.size(hs) - step
            tail = F.slice(hs, step + 1, F.greatest(n, F.lit(0)))
            return F.zip_with(F.slice(hs, 1, F.greatest(n, F.lit(0))), tail, lambda a, b: F.xxhash64(a, b))

        return both

    return _let(_let(paired(1)(F.col("words")), paired(2)), paired(4))


def _repeated_words() -> Column:
    """Words inside 8-word windows that occur twice or more in the text. From `windows`, the hashes of all windows by position."""

    def positions(pairs: Column) -> Column:
        def twice(x: Column, k: Column) -> Column:
            return (x["h"] == F.get(pairs, k - 1)["h"]) | (x["h"] == F.get(pairs, k + 1)["h"])

        return F.sort_array(F.transform(F.filter(pairs, twice), lambda x: x["i"]))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda x, k: F.coalesce(F.least(F.lit(8), F.get(places, k + 1) - x), F.lit(8)))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    pairs = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    count = _let(_let(pairs, positions), covered)
    return F.when(F.size(F.array_distinct("windows")) < F.size("windows"), count).otherwise(F.lit(0).cast("bigint"))


def counted(docs: DataFrame, *keep: str) -> DataFrame:
    """The `keep` columns as the struct `row`, lang, the counts n_words, word_chars, n_symbols, n_dup_lines and
    n_repeat_words, and both histograms of every whole text."""
    rows = _histograms(_taken(docs, *keep))
    rows = rows.withColumn("windows", _windows())
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda line: F.rlike(line, F.lit(WORD))))
    return rows.select(
        "row",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("char_counts")[CLASSES.index("[#*$%&|<>]")].cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words().alias("n_repeat_words"),
        F.char_length("text").alias("n_chars"),
        "char_counts",
        "word_counts",
    )


def judged(counts: DataFrame, reference: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Counted rows with base_failed, char_divergence, word_divergence and kept.

    Base rules: too few words, or too many of them inside repeated windows. A document that passes them goes only if
    one of its histograms is far from the one of its language and it is long enough to be judged by it; for words, as far as
    a text that has next to none of the frequent ones, be it of another language or a list of words. A null text is
    an empty one (too few words); rows alike get the same verdict; a language without reference refuses nothing.
    """
    known = reference.withColumnRenamed("lang", "reference_lang")
    found = counts.join(known, F.col("lang").eqNullSafe(F.col("reference_lang")), "left").select(
        "*",
        _distance(F.col("char_counts"), F.col("char_reference")).alias("char_divergence"),
        _distance(F.col("word_counts"), F.col("word_reference")).alias("word_divergence"),
        ((F.col("n_words") < limits.words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))).alias("base_failed"),
    )
    far = F.coalesce((F.col("n_chars") >= limits.chars_least) & (F.col("char_divergence") > limits.char_divergence), F.lit(False))
    odd = F.coalesce((F.col("n_words") >= limits.words_least) & (F.col("word_divergence") > limits.word_share * F.col("word_alone")), F.lit(False))
    return found.select("*", (~(F.col("base_failed") | far | odd)).alias("kept"))


def quality(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Counts and verdict of every row, named by doc_id; the language references are those of the same table.

    An empty table gives no row; columns other than doc_id, text and lang are not looked at.
    """
    counts = staged(counted(docs, "doc_id"), "counts")
    found = judged(counts, staged(references(counts), "references"), limits)
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def drop_low_quality(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """The rows of docs, all columns, that are kept."""
    reference = staged(references(_histograms(_taken(docs))), "references")
    return judged(counted(docs, *docs.columns), reference, limits).where("kept").select("row.*")
