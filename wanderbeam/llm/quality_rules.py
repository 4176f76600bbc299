"""Quality rules: a threshold table compiled into one Spark projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderbeam.llm.text import SPACES, let, words

WINDOW = 5
SYMBOLS = "#*$%&|<>"
# Frequent function words of the four languages, without punctuation.
STOP_WORDS = """
the of and to in is that it for as was with be by on not he are this at from or an a
der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch
de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se
de la que el en y a los se del las un por con no una su para es al lo como
""".split()


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie in [low, high]; a bound of None does not apply."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# The production table. Measures are those of ``measures``.
RULES = (
    Rule("mean_word_length", "mean_word_chars", 2.0, 25.0),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("stop_words", "stop_word_ratio", 0.02, None),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.3),
    Rule("blank_lines", "words_per_line", 1.0, None),
)


def repeated_words(text_words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of ``window`` words that the text has twice or more.

    Windows are compared by the 64-bit hash of their words' hashes. Texts without a repeated
    window, most of them, end after sorting the hashes; the others sort (hash, position).
    """

    def hashes(w: Column) -> Column:
        return let(
            F.transform(w, lambda x: F.xxhash64(x)),
            lambda h: F.transform(
                F.sequence(F.lit(0), F.size(h) - window),
                lambda i: F.xxhash64(*[h[i + k] for k in range(window)]),
            ),
        )

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            def twin(x: Column, i: Column) -> Column:
                before = F.when(i > 0, p[i - 1]["h"] == x["h"]).otherwise(False)
                after = F.when(i < F.size(p) - 1, p[i + 1]["h"] == x["h"]).otherwise(False)
                return before | after

            return F.array_sort(F.transform(F.filter(p, twin), lambda x: x["i"]))

        def length(at: Column) -> Column:
            # Each window adds the words that the next one doesn't reach; the last adds all.
            steps = F.transform(
                at, lambda x, k: F.when(k < F.size(at) - 1, F.least(F.lit(window), at[k + 1] - x)).otherwise(window)
            )
            return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

        return let(let(pairs, places), length)

    def count(h: Column) -> Column:
        has_twin = let(F.sort_array(h), lambda s: F.exists(F.transform(s, lambda x, i: (i > 0) & (s[i - 1] == x)), lambda b: b))
        return F.when(has_twin, covered(h)).otherwise(0)

    counted = let(hashes(text_words), count)
    return F.when(F.size(text_words) >= window + 1, counted).otherwise(0).cast("long")


def measures(docs: DataFrame, text: str = "text", stop_words: tuple[str, ...] = tuple(STOP_WORDS)) -> DataFrame:
    """Adds the counts and ratios that rules refer to; ``__words`` is dropped again.

    NULL is an empty text. A text without words has zero counts and zero ratios. A line is
    what stands between line feeds; it counts as a duplicate if it holds a word and equals an
    earlier line. Stop words are compared in lower case without a final stop or comma.
    """
    body = F.coalesce(F.col(text), F.lit(""))

    def line_counts(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup"),
        )

    def word_counts(w: Column) -> Column:
        bare = F.transform(w, lambda x: F.rtrim(x, F.lit(".,")))
        return F.struct(
            F.size(w).cast("long").alias("n"),
            F.length(F.array_join(w, "")).cast("long").alias("chars"),
            F.size(F.filter(bare, lambda x: x.isin(*stop_words))).cast("long").alias("stops"),
            repeated_words(w).alias("repeats"),
        )

    # Sentence-initial capitals count as stop words, words in capitals throughout do not.
    stop_words = tuple(dict.fromkeys([*stop_words, *(w[:1].upper() + w[1:] for w in stop_words if len(w) > 1)]))
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    counted = docs.withColumn(
        "__m",
        F.struct(
            let(words(body), word_counts).alias("w"),
            let(lines, line_counts).alias("l"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("symbols"),
        ),
    )
    n, n_lines = F.col("__m.w.n"), F.col("__m.l.n")

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    return counted.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        n.alias("n_words"),
        F.col("__m.w.chars").alias("word_chars"),
        F.col("__m.symbols").alias("n_symbols"),
        F.col("__m.l.dup").alias("n_dup_lines"),
        F.col("__m.w.repeats").alias("n_repeat_words"),
        ratio(F.col("__m.w.chars"), n).alias("mean_word_chars"),
        ratio(F.col("__m.symbols"), n).alias("symbols_per_word"),
        ratio(F.col("__m.w.stops"), n).alias("stop_word_ratio"),
        ratio(F.col("__m.l.dup"), n_lines).alias("dup_line_ratio"),
        ratio(n, n_lines).alias("words_per_line"),
    )


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one array column with the names of the rules that fail."""

    def fails(rule: Rule) -> Column:
        value = F.col(rule.measure)
        low = F.lit(False) if rule.low is None else value < rule.low
        high = F.lit(False) if rule.high is None else value > rule.high
        return F.when(low | high, F.lit(rule.name))

    return F.array_compact(F.array(*[fails(r) for r in rules])) if rules else F.array().cast("array<string>")


def rule_verdicts(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures, ``failed_rules`` and ``kept`` of every row, in one projection of the scan."""
    return measures(docs, text).withColumn("failed_rules", compiled(rules)).withColumn(
        "kept", F.size("failed_rules") == 0
    )


def document_rules(docs: DataFrame) -> DataFrame:
    """The base counts, ``base_failed`` and ``kept`` of every document."""
    judged = rule_verdicts(docs.select("doc_id", "text"))
    base_failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (F.col("kept") & ~base_failed).alias("kept"),
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )
