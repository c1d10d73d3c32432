"""Quality rules: counts with fixed limits, and divergence from a language.

A document's character-class histogram and its histogram of common words are
compared with references of every language by Jensen-Shannon distance (base 2,
0 to 1). It passes if the nearest language is near enough in both. A third
distance takes all other words as one class, so that a text without common
words is far from every language. Documents below a minimum length have no
meaningful histogram and pass on the counts alone. Built-in functions only; no
row leaves its task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislecast.llm.common import WORD, text_of
from aislecast.session import stage

OWN = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
OWN += ["class_distance", "word_distance", "prose_distance", "kept"]

# Character classes; what is in none of them, mostly small letters, is the last.
CLASSES = {
    "other": r"^\x00-\x7F",
    "upper": "A-Z",
    "digit": "0-9",
    "space": r"\x20\x09-\x0D",
    "symbol": r"#*$%&|<>",
    "punct": r"!\"'()+,\-./:;=?@\[\\\]^_`{}~",
}


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    divergence_words: int = 50  # fewer words: no divergence test
    common_words: int = 20  # fewer common words found: no word test
    max_class_distance: float = 0.3
    max_word_distance: float = 0.7
    max_prose_distance: float | None = 0.88  # of the distance of a text without common words; None: no such test
    common: int = 30  # common words of a language's reference
    languages: int = 100  # references at most, the largest languages


def _without(text: Column, chars: str) -> Column:
    return F.regexp_replace(text, f"[{chars}]+", "")


def _repeated(words: str) -> list[tuple[str, Column]]:
    """Words in three-word windows that occur twice or more, in steps.

    Only if some 64-bit hash of a window occurs twice, windows are sorted by
    hash, equal neighbours give positions, and the union of [p, p + 2] over
    sorted positions is counted.
    """
    w, h, s, p = (F.col(c) for c in (words, "_hashes", "_grams", "_places"))
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    grams = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def twin(x: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(s, i - 1)["h"] == x["h"]).otherwise(F.lit(False))
        return before | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))

    cover = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
    return [
        ("_hashes", F.when(F.size(w) >= 4, hashes)),
        ("_grams", F.when(F.size(F.array_distinct(h)) < F.size(h), grams)),
        ("_places", F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))),
        ("n_repeat_words", F.coalesce(F.aggregate(cover, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")),
    ]


def with_counts(docs: DataFrame, rules: Rules, text_col: str = "text") -> DataFrame:
    """Adds _text, _words, _class (histogram) and the base counts."""
    text = text_of(text_col)
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD))
    out = docs.withColumn("_text", text).withColumn("_chars", F.length("_text"))
    # Two passes over the text; the other classes are counted in the little that is left.
    out = out.withColumn("_solid", _without(F.col("_text"), CLASSES["space"])).withColumn("_few", _without(F.col("_solid"), "a-z"))
    out = out.withColumn("_space", F.col("_chars") - F.length("_solid"))
    for name, chars in CLASSES.items():
        if name != "space":
            out = out.withColumn(f"_{name}", F.length("_few") - F.length(_without(F.col("_few"), chars)))
    rest = F.col("_chars") - sum((F.col(f"_{n}") for n in CLASSES), F.lit(0))
    out = (
        out.withColumn("_class", F.array(*(F.col(f"_{n}").cast("long") for n in CLASSES), rest.cast("long")))
        .withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
        .withColumn("_lines", lines)
    )
    for name, column in _repeated("_words"):
        out = out.withColumn(name, column)
    n_words = F.size("_words").cast("long")
    failed = (n_words < rules.min_words) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(rules.max_repeat_percent) * n_words
    )
    return out.select(
        *docs.columns,
        "_text",
        "_words",
        "_class",
        n_words.alias("n_words"),
        (F.col("_chars") - F.col("_space")).cast("long").alias("word_chars"),
        F.col("_symbol").cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        failed.alias("base_failed"),
    )


def learn_words(
    docs: DataFrame, rules: Rules, lang_col: str = "lang", text_col: str = "text"
) -> tuple[dict[str, dict[str, float]], dict[str, float]]:
    """The shares of the most frequent lower-cased words of every language among themselves; and, for the
    prose test, their share of all its words.

    From all rows that name a language. The limit per language is applied in
    each task before the shuffle; the driver gets rules.languages times
    rules.common rows at most, of the languages with most words.
    """
    counted = (
        docs.filter(F.col(lang_col).isNotNull())
        .select(
            F.col(lang_col).alias("lang"),
            F.explode(F.regexp_extract_all(F.lower(text_of(text_col)), F.lit(WORD), F.lit(0))).alias("word"),
        )
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    best = counted.withColumn("_rank", rank).filter(F.col("_rank") <= rules.common)
    largest = best.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "lang").limit(rules.languages)
    if rules.max_prose_distance is not None:
        largest = largest.join(counted.groupBy("lang").agg(F.sum("n").alias("every")), "lang")
    out: dict[str, dict[str, float]] = {}
    common: dict[str, float] = {}
    for r in best.join(largest, "lang").orderBy("lang", "word").collect():
        out.setdefault(r["lang"], {})[r["word"]] = r["n"] / r["total"]
        if rules.max_prose_distance is not None:
            common[r["lang"]] = r["total"] / r["every"]
    return out, common


def learn_classes(measured: DataFrame, rules: Rules, lang_col: str = "lang") -> dict[str, list[float]]:
    """The shares of the character classes of every language, of those with most characters."""
    sums = [F.sum(F.get("_class", F.lit(k))).alias(f"c{k}") for k in range(len(CLASSES) + 1)]
    total = sum((F.col(f"c{k}") for k in range(1, len(sums))), F.col("c0"))
    largest = (
        measured.filter(F.col(lang_col).isNotNull())
        .groupBy(F.col(lang_col).alias("lang"))
        .agg(*sums)
        .withColumn("chars", total)
        .filter("chars > 0")
        .orderBy(F.desc("chars"), "lang")
        .limit(rules.languages)
    )
    return {r["lang"]: [r[f"c{k}"] / r["chars"] for k in range(len(sums))] for r in largest.collect()}


def _divergence_term(p: Column, q: Column) -> Column:
    """One class's share of twice the divergence, in bits."""
    term = lambda x: F.when(x > 0, x * F.log2(2.0 * x / (p + q))).otherwise(0.0)
    return term(p) + term(q)


def _distance(twice: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), twice / 2.0))


def _class_distance(shares: list[float]) -> Column:
    total = F.aggregate("_class", F.lit(0).cast("long"), lambda a, x: a + x)
    p = lambda k: F.get("_class", F.lit(k)) / F.greatest(total, F.lit(1).cast("long"))
    terms = [_divergence_term(p(k), F.lit(float(q))) for k, q in enumerate(shares)]
    return _distance(sum(terms[1:], terms[0]))


def _word_distance(shares: dict[str, float]) -> Column:
    """Over the reference's words: those not in the text add their own share."""
    known = F.create_map(*(F.lit(x) for item in shares.items() for x in item))
    mine = F.filter("_hist", lambda x: x["word"].isin(list(shares)))
    total = F.aggregate(mine, F.lit(0).cast("long"), lambda a, x: a + x["n"])

    def add(a: Column, x: Column) -> Column:
        q = F.element_at(known, x["word"])
        return F.struct(
            (a["terms"] + _divergence_term(x["n"] / total, q)).alias("terms"), (a["seen"] + q).alias("seen")
        )

    start = F.struct(F.lit(0.0).alias("terms"), F.lit(0.0).alias("seen"))
    return F.aggregate(mine, start, add, lambda a: _distance(a["terms"] + (1.0 - a["seen"])))


def _prose_distance(shares: dict[str, float], common: float) -> Column:
    """Over the reference's words and all others as one; 1 is that of a text without the reference's words."""
    known = F.create_map(*(F.lit(x) for w, q in shares.items() for x in (w, q * common)))
    mine = F.filter("_hist", lambda x: x["word"].isin(list(shares)))
    other = max(0.0, 1.0 - common)
    none = math.sqrt((common + (other * math.log2(2 * other / (1 + other)) if other else 0.0) + math.log2(2 / (1 + other))) / 2)

    def add(a: Column, x: Column) -> Column:
        p, q = x["n"] / F.col("n_words"), F.element_at(known, x["word"])
        return F.struct(
            (a["terms"] + _divergence_term(p, q)).alias("terms"), (a["own"] + p).alias("own"), (a["seen"] + q).alias("seen")
        )

    def finish(a: Column) -> Column:
        rest = _divergence_term(F.greatest(F.lit(0.0), 1.0 - a["own"]), F.lit(other))
        return _distance(a["terms"] + (common - a["seen"]) + rest) / none

    return F.aggregate(mine, F.struct(*(F.lit(0.0).alias(c) for c in ("terms", "own", "seen"))), add, finish)


def _nearest(distances: list[Column]) -> Column:
    if not distances:
        return F.lit(None).cast("double")
    return F.least(*distances) if len(distances) > 1 else distances[0]


def measure(
    docs: DataFrame,
    references: tuple[dict[str, dict[str, float]], dict[str, float]],
    rules: Rules,
    text_col: str = "text",
) -> DataFrame:
    """Adds the base counts, word_distance, prose_distance and _class (characters by class)."""
    words, common = references
    out = with_counts(docs.drop(*(c for c in OWN if c != text_col)), rules, text_col)
    known = sorted({w for shares in words.values() for w in shares})
    hist = F.transform(
        F.array_distinct("_common"),
        lambda w: F.struct(w.alias("word"), (F.size("_common") - F.size(F.array_remove("_common", w))).cast("long").alias("n")),
    )
    long = F.col("n_words") >= rules.divergence_words
    enough = long & (F.size("_common") >= rules.common_words)
    prose = _nearest([_prose_distance(words[g], common[g]) for g in common])
    return (
        out.withColumn("_common", F.filter(F.transform("_words", F.lower), lambda w: w.isin(known)))
        .withColumn("_hist", hist)
        .withColumn("word_distance", F.when(enough, _nearest([_word_distance(w) for w in words.values()])))
        .withColumn("prose_distance", F.when(long, prose))
        .drop("_text", "_words", "_common", "_hist")
    )


def verdict(measured: DataFrame, classes: dict[str, list[float]], rules: Rules) -> DataFrame:
    """Adds class_distance and kept to measured rows."""
    distance = F.when(F.col("n_words") >= rules.divergence_words, _nearest([_class_distance(c) for c in classes.values()]))
    far = lambda c, limit: F.coalesce(F.col(c) > limit, F.lit(False))
    out = measured.withColumn("class_distance", distance)
    fine = ~far("class_distance", rules.max_class_distance) & ~far("word_distance", rules.max_word_distance)
    if rules.max_prose_distance is not None:
        fine = fine & ~far("prose_distance", rules.max_prose_distance)
    return out.withColumn("kept", ~F.col("base_failed") & fine).drop("_class")


def judge(
    docs: DataFrame,
    rules: Rules | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per input row: the id, base counts, distances and the verdict.

    Columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, word_distance, prose_distance and class_distance (to the nearest
    language; null where the text is too short to tell or no row names a
    language; word_distance also where it has few common words) and kept.

    Null or empty text has no words and fails the word minimum. A null language
    gives no reference but is judged like the rest. Repeated rows get equal
    verdicts. No rows give no rows. Other columns are ignored. A text of any
    length is one row.
    """
    rules = rules or Rules()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    measured = stage(measure(rows, learn_words(rows, rules), rules).drop("text"), "measured")
    return verdict(measured, learn_classes(measured, rules), rules).drop("lang")


def filter_documents(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """Only the rows that pass, with the columns they came with."""
    rules = rules or Rules()
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text", "lang")
    # written before the filter, which would else be pushed below and repeat the measures
    measured = stage(measure(rows, learn_words(rows, rules), rules).drop("text"), "measured")
    return verdict(measured, learn_classes(measured, rules), rules).filter("kept").select("_row.*")
