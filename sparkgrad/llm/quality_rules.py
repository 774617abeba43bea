"""Quality rules: a threshold table compiled into one projection of built-in expressions.

``measures`` turns a text into counts, ``RULES`` holds the thresholds on ratios of those
counts, ``verdict`` compiles the table into one boolean column. The whole operator is a
single map over the rows: no shuffle, no user function, no state between rows.

Repeated 8-word windows are found inside the row: hashes of all windows, an exact test
for any repeat by a hash set, and only then a sort that brings equal hashes together.

Defined results: a NULL, empty or blank text has zero counts and fails the base rule
(fewer than 20 words); repeated rows are judged alike; the stop-word rule, whose list is of four languages in Latin letters (small, capitalised
or in capitals), passes texts that are mostly in other letters; a text all in capitals fails the rule on them whatever its words; an empty table gives an empty
result; other columns of the input pass through ``keep_good`` untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgrad.llm.text import WHITE, free_name, let, read, words

SYMBOLS = "#*$%&|<>"
WIDTH = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for on with as was be by are this or an from at not have which "
    "der die das und ist von zu mit den im nicht ein eine auf für sich des dem auch es "
    "le la les et est un une du que qui dans pour pas au sur par avec ne ce en "
    "el los las por con para del se una no su al lo como más o sus pero y de a"
).split()


STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})


@dataclass(frozen=True)
class Rule:
    """``low <= top / bottom <= high``, both counts from ``measures``; a zero bottom passes."""

    name: str
    top: str
    bottom: str
    low: float
    high: float


LEAST_STOPS = 0.04
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols_per_word", "n_symbols", "n_words", 0.0, 0.25),
    Rule("stop_word_share", "n_stop_words", "n_latin_words", LEAST_STOPS, 1.0),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", 0.0, 0.5),
    Rule("upper_case_share", "n_upper", "word_chars", 0.0, 0.3),
)


def repeated_words(w: Column, width: int = WIDTH) -> Column:
    """Words covered by windows of ``width`` words that occur twice or more, the first occurrence included.

    ``width`` is a power of two.
    """
    if width & (width - 1):
        raise ValueError("width has to be a power of two")

    def covered(h: Column) -> Column:
        marked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            # F.get gives NULL outside the array, and NULL is no equality
            near = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, lambda x, k: near(x, k - 1) | near(x, k + 1)), lambda x: x["i"]))

        first = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda acc, x: F.struct(
            (acc["n"] + F.least(F.lit(width), x + width - acc["end"])).alias("n"), (x + width).alias("end"))
        return F.aggregate(let(marked, starts), first, step, lambda acc: acc["n"])

    def wider(span: int):
        def joined(h: Column) -> Column:
            n = F.greatest(F.size(h) - span, F.lit(0))
            return F.zip_with(F.slice(h, 1, n), F.slice(h, span + 1, n), lambda a, b: F.xxhash64(a, b))

        return joined

    # hashes of 1, 2, 4, ... words; the last step leaves one hash per window of ``width`` words
    hashes, span = F.transform(w, lambda x: F.xxhash64(x)), 1
    while span < width:
        hashes = let(hashes, wider(span))
        span *= 2
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def measures(text: Column) -> Column:
    """Struct of counts (long) over the whole text."""
    filled = F.coalesce(text.cast("string"), F.lit(""))

    def counts(w: Column) -> Column:
        stop = F.filter(w, lambda x: x.isin(STOP_FORMS))
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"),
                        F.size(stop).cast("long").alias("n_stop_words"))

    # a line counts if it holds a word
    lines = F.filter(F.split(filled, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    line_counts = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                                F.size(F.array_distinct(x)).cast("long").alias("d")))
    # only read where stop words are few
    latin = 2 * F.length(F.regexp_replace(filled, r"\P{IsLatin}+", "")) >= F.length(F.regexp_replace(filled, r"\P{L}+", ""))
    return let(F.struct(let(words(filled), counts).alias("w"), line_counts.alias("l")), lambda m: F.struct(
        m["w"]["n_words"].alias("n_words"),
        F.length(F.regexp_replace(filled, WHITE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(filled, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (m["l"]["n"] - m["l"]["d"]).alias("n_dup_lines"), m["w"]["n_repeat_words"].alias("n_repeat_words"),
        m["w"]["n_stop_words"].alias("n_stop_words"), F.when(
            m["w"]["n_stop_words"] >= LEAST_STOPS * m["w"]["n_words"], m["w"]["n_words"]).when(latin, m["w"]["n_words"]).otherwise(0).alias("n_latin_words"),
        F.length(F.regexp_replace(filled, r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        m["l"]["n"].alias("n_lines")))


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean expression over a struct of counts."""
    ok = F.lit(True)
    for rule in rules:
        ratio = m[rule.top].cast("double") / m[rule.bottom].cast("double")
        ok = ok & ((m[rule.bottom] == 0) | ratio.between(rule.low, rule.high))
    return ok


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, into: str = "_judged") -> DataFrame:
    """The input with one more column: a struct of counts, ``base_failed`` and ``kept``."""
    if into in docs.columns:
        raise ValueError(f"the input has a column {into!r}; name another one")
    return docs.withColumn(into, let(measures(F.col(text)), lambda m: let(base_failed(m), lambda failed: F.struct(
        m.alias("counts"), failed.alias("base_failed"), (~failed & verdict(m, rules)).alias("kept")))))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, with the input's columns."""
    into = free_name(docs.columns, "_judged")
    return judge(docs, text, rules, into).where(F.col(into)["kept"]).drop(into)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = F.col("_judged")
    return judge(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *[
        j["counts"][c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        j["base_failed"].alias("base_failed"), j["kept"].alias("kept"))


def _ratio_sql(rule: Rule) -> str:
    return (f"({rule.bottom} = 0 OR ({rule.top}::DOUBLE / {rule.bottom}::DOUBLE >= {rule.low} "
            f"AND {rule.top}::DOUBLE / {rule.bottom}::DOUBLE <= {rule.high}))")


SPACE_SQL = r"[\x20\x09-\x0D]+"
OP7_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '{SPACE_SQL}'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(regexp_replace(x, '{SPACE_SQL}', '', 'g')) > 0) AS ln
  FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + {WIDTH - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WIDTH - 2})) AS i FROM d WHERE len(w) >= {WIDTH})),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + {WIDTH})) AS p FROM twice) GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '{SPACE_SQL}', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^{SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
    (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    len(ln)::BIGINT AS n_lines,
    len(list_filter(w, lambda x: list_contains([{", ".join(f"'{x}'" for x in STOP_FORMS)}], x)))::BIGINT AS n_stop_words,
    CASE WHEN n_stop_words >= {LEAST_STOPS}::DOUBLE * len(w) OR 2 * length(regexp_replace(text, '\P{{Latin}}+', '', 'g')) >= length(regexp_replace(text, '\P{{L}}+', '', 'g')) THEN len(w) ELSE 0 END::BIGINT AS n_latin_words,
    length(regexp_replace(text, '\P{{Lu}}+', '', 'g'))::BIGINT AS n_upper
  FROM d LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {" AND ".join(_ratio_sql(r) for r in RULES)} AS kept
FROM b
"""
