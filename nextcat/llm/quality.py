"""Quality rules by distribution divergence [native].

Every document is reduced to two histograms: its characters by class, and its
words by a language's most common words (all others share one bin).  Each
language's reference holds the same histograms summed over all documents of
that language.  A document is rejected when a Jensen-Shannon distance (base 2,
so 0 to 1) to its reference exceeds a limit; documents below a length guard are
not judged by that histogram, since short samples are far from any reference by
chance.  Base rules (word count, repeated windows) come before.

Only DataFrame functions run here: all work on one text stays inside its row
(arrays of the row's words), one small aggregate builds the references, and no
text is shuffled.

Defined cases: a null or empty text has no words, counts 0 and fails the base
rule; a text whose language is null, empty or has under ``min_ref_words`` words
in all has no reference of its own and is judged by neither distance, whatever
other documents there are; repeated rows each get their own result; other
columns are never read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, broadcast_if_small, cut, fresh, let, text_of, words_of

SYMBOLS = r"[#*$%&|<>]"

#: Character classes in the order in which they are taken out of the text.
CHAR_CLASSES = (
    ("lower", r"\p{Ll}+"),
    ("space", SPACE + "+"),
    ("upper", r"\p{Lu}+"),
    ("digit", r"\p{N}+"),
    ("stop", r"[.,;:'\"()?!-]+"),
    ("symbol", SYMBOLS + "+"),
)


@dataclass(frozen=True)
class QualityRules:
    window: int = 8            # words per repeated window
    min_words: int = 20        # fewer: base rule fails
    max_repeat_pct: int = 30   # percent of words in repeated windows
    common_words: int = 32     # words with a bin of their own, per language
    min_ref_words: int = 2000  # words a language needs for its own reference
    min_class_chars: int = 250   # guard of the character-class distance
    min_dist_words: int = 40     # guard of the common-word distance
    max_class_distance: float = 0.27
    max_word_distance: float = 0.4


def char_classes(text: Column) -> Column:
    """Characters per class, then all other characters, as array<long>.  Each
    class is cut out before the next is counted, so later passes are short."""
    def step(rest: Column, classes, counts):
        if not classes:
            return F.array(*counts, F.length(rest).cast("long"))
        return let(F.regexp_replace(rest, classes[0], ""),
                   lambda left: step(left, classes[1:], [*counts, (F.length(rest) - F.length(left)).cast("long")]))
    return step(text, [p for _, p in CHAR_CLASSES], [])


def repeated_words(hashes: Column, n: Column, window: int) -> Column:
    """Words inside windows that occur twice or more in the row's own text.

    Windows are compared by 64-bit hashes, made by doubling from the words'
    hashes.  Most texts have no equal windows, which a hash-set pass shows; for the rest the
    (hash, position) pairs are sorted and the covered positions summed."""
    def covered(win: Column) -> Column:
        pairs = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(s: Column) -> Column:
            twice = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
            return let(F.sort_array(F.transform(twice, lambda x: x["i"])), lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window)))),
                F.lit(0).cast("long"), lambda a, x: a + x))
        return let(pairs, count)

    def judge(win: Column) -> Column:
        return F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0).cast("long")).otherwise(covered(win))

    def windows(part: Column, width: int) -> Column:
        """Windows of the full width, from those of ``width``: two that overlap or meet make a wider one."""
        if width == window:
            return judge(part)
        wider = min(2 * width, window)
        joined = F.transform(F.slice(part, 1, F.size(part) - (wider - width)),
                             lambda h, i: F.xxhash64(h, F.get(part, i + (wider - width))))
        return let(joined, lambda x: windows(x, wider))

    return F.when(n < window, F.lit(0).cast("long")).otherwise(windows(hashes, 1))


def repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


#: Cells of the lookup table of a language's common words.
CELLS = 512


def lookup(ref: Column) -> Column:
    """The reference words by cell of their hash: finding a word reads one cell, not all words."""
    return F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda c: F.filter(ref, lambda h: F.pmod(h, F.lit(CELLS)) == c))


def word_bins(hashes: Column, n: Column, ref: Column, table: Column) -> Column:
    """Words equal to each reference word, then all others, as array<long>."""
    def bins(common: Column) -> Column:
        each = F.transform(ref, lambda k: (F.size(common) - F.size(F.array_remove(common, k))).cast("long"))
        return F.concat(each, F.array((n - F.size(common)).cast("long")))
    return let(F.filter(hashes, lambda h: F.array_contains(F.get(table, F.pmod(h, F.lit(CELLS)).cast("int")), h)), bins)


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two count arrays of one length; null if one is all 0."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def distance(t: Column) -> Column:
        terms = F.zip_with(counts, reference, lambda a, b: let(
            F.struct((a / t["a"]).alias("p"), (b / t["b"]).alias("q")),
            lambda x: part(x["p"], (x["p"] + x["q"]) / 2) + part(x["q"], (x["p"] + x["q"]) / 2)))
        return F.when((t["a"] > 0) & (t["b"] > 0),
                      F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2)))
    return let(F.struct(total(counts).alias("a"), total(reference).alias("b")), distance)


def language_references(docs: DataFrame, rules: QualityRules = QualityRules(),
                        text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per language with enough words: (lang, common array<string>,
    word_counts, class_counts).

    Ties between equally common words go to the smaller word."""
    base = docs.select(F.col(lang).cast("string").alias("lang"), text_of(text).alias("text")).where(F.col("lang") != "")
    words = cut(base.select("lang", F.explode(words_of(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n")))
    totals = words.groupBy("lang").agg(F.sum("n").alias("total")).where(F.col("total") >= rules.min_ref_words)
    # ranks up to a limit: every task sends on no more than that many words of a language
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "word"))
    top = (words.withColumn("rank", rank).where(F.col("rank") <= rules.common_words).groupBy("lang")
           .agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "word"))).alias("top")))
    merged = top.join(totals, "lang")
    names = [f"c{i}" for i in range(len(CHAR_CLASSES) + 1)]
    classes = base.select("lang", char_classes(F.col("text")).alias("c")).groupBy("lang").agg(*[F.sum(F.col("c")[i]).alias(c) for i, c in enumerate(names)])
    c = classes.select(F.col("lang").alias("c_lang"), F.array(*names).alias("class_counts"))
    return (merged.join(c, F.col("lang") == F.col("c_lang"))
            .select("lang", F.transform("top", lambda x: x["word"]).alias("common"),
                    F.concat(F.transform("top", lambda x: -x["m"]),
                             F.array(F.col("total") - F.aggregate("top", F.lit(0).cast("long"), lambda s, x: s - x["m"])))
                    .alias("word_counts"), "class_counts"))


def quality_rules(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text", lang: str = "lang",
                  out: str = "quality") -> DataFrame:
    """``docs`` plus one struct column ``out``: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance
    (both null where the length guard or a missing reference leaves the text
    unjudged) and kept."""
    refs = language_references(docs, rules, text, lang)
    hashed = cut(refs.select("lang", F.transform("common", lambda w: F.xxhash64(w)).alias("common"), "word_counts", "class_counts"))
    hashed = cut(hashed.withColumn("table", lookup(F.col("common"))))
    n_refs = hashed.count()
    parts = F.struct("common", "table", "word_counts", "class_counts")
    r, k, out = fresh(docs, "_ref", "_ref_lang", out)
    own = hashed.select(F.col("lang").alias(k), parts.alias(r))
    keyed = docs.join(broadcast_if_small(own, n_refs), docs[lang].cast("string") == F.col(k), "left")
    ref = F.col(r)

    names = [c for c, _ in CHAR_CLASSES]

    def judged(x: Column, hashes: Column, n: Column, classes: Column) -> Column:
        chars = F.when((F.length(x) >= rules.min_class_chars) & ref.isNotNull(), js_distance(classes, ref["class_counts"]))
        bins = word_bins(hashes, n, ref["common"], ref["table"])
        common = F.when((n >= rules.min_dist_words) & ref.isNotNull(), let(bins, lambda b: js_distance(b, ref["word_counts"])))
        return F.struct(
            n.cast("long").alias("n_words"),
            (F.length(x) - classes[names.index("space")]).cast("long").alias("word_chars"),
            classes[names.index("symbol")].alias("n_symbols"),
            repeated_lines(x).alias("n_dup_lines"),
            repeated_words(hashes, n, rules.window).alias("n_repeat_words"),
            chars.alias("class_distance"), common.alias("word_distance"))

    body = let(text_of(text), lambda x: let(words_of(x), lambda w: let(
        F.transform(w, lambda v: F.xxhash64(v)), lambda h: let(F.size(w), lambda n: let(
            char_classes(x), lambda c: judged(x, h, n, c))))))
    failed = lambda q: (q["n_words"] < rules.min_words) | (100 * q["n_repeat_words"] > rules.max_repeat_pct * q["n_words"])
    far = lambda q: (F.coalesce(q["class_distance"] > rules.max_class_distance, F.lit(False))
                     | F.coalesce(q["word_distance"] > rules.max_word_distance, F.lit(False)))
    verdict = let(body, lambda q: F.struct(
        q["n_words"].alias("n_words"), q["word_chars"].alias("word_chars"), q["n_symbols"].alias("n_symbols"),
        q["n_dup_lines"].alias("n_dup_lines"), q["n_repeat_words"].alias("n_repeat_words"),
        failed(q).alias("base_failed"), q["class_distance"].alias("class_distance"),
        q["word_distance"].alias("word_distance"), (~failed(q) & ~far(q)).alias("kept")))
    return keyed.select(*[docs[c] for c in docs.columns], verdict.alias(out))


def keep_good(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged."""
    q, = fresh(docs, "quality")
    return quality_rules(docs, rules, text, lang, q).where(F.col(q)["kept"]).drop(q)
