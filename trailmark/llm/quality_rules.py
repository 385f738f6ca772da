"""Heuristic quality rules: a threshold table compiled into one projection of built-in functions.

``MEASURES`` names what can be measured of a text (lengths, symbols, stop words, lines) and how; a rule holds a
measure against a lower and an upper bound. ``compile_rules`` turns a table of such rules into columns, so all
rules of all rows are one projection without shuffle, and a text's arrays are built once for all its measures.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import WHITE

SYMBOLS = r"#*$%&|<>"
EDGES = ".,;:!?\"'()[]«»„“”¿¡"  # cut from a word before it is looked up as a stop word

# Frequent function words by language.
STOP_WORDS = {
    "en": "the be to of and that have with is it for as was on are this",
    "de": "der die das und ist nicht ein eine zu den mit von im des auf für",
    "fr": "le la les de des et est un une que qui dans en pour pas du par sur",
    "es": "el la los las de y que en un una es por con para se no del al",
    "it": "il lo la gli di che e è un una per con non del della",
    "pt": "o a os as de que e em um uma do da para com não por",
    "nl": "de het een en van in is dat op te met voor niet",
}


@dataclass(frozen=True)
class Rule:
    """A text fails the rule ``name`` when ``measure`` is below ``low`` or above ``high`` (None: no bound).

    A measure that is NULL, as a share of nothing, fails no rule.
    """

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The default table. The first two rules are the base; a text that fails any rule is not kept.
RULES = (
    Rule("too_short", "n_words", low=50),
    Rule("repeated_words", "repeat_word_share", high=0.5),
    Rule("word_length", "mean_word_chars", low=2, high=14),
    Rule("symbols", "symbols_per_word", high=0.25),
    Rule("shouting", "marks_per_word", high=0.5),
    Rule("no_stop_words", "stop_word_share", low=0.01),
    Rule("repeated_lines", "dup_line_share", high=0.5),
    Rule("bullets", "bullet_line_share", high=0.9),
    Rule("cut_lines", "ellipsis_line_share", high=0.5),
)
BASE = ("too_short", "repeated_words")


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, also where ``use`` reads it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    """The maximal runs of characters outside ``[\\x20\\x09-\\x0D]``."""
    inside = F.btrim(text, F.lit(WHITE))
    return F.when(inside == "", F.array().cast("array<string>")).otherwise(F.split(inside, r"[\x20\x09-\x0D]+"))


def lines_of(text: Column) -> Column:
    """The lines between ``\\n`` that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words which the text holds twice or more, the first one included.

    Windows are compared by a 64-bit hash. They are sorted with their positions, so equal ones are neighbours:
    n log n for n words.
    """

    def covered(hashes: Column) -> Column:
        def positions(ordered: Column) -> Column:
            twice = F.filter(
                ordered,
                lambda x, i: (x["h"] == F.get(ordered, i - 1)["h"]) | (x["h"] == F.get(ordered, i + 1)["h"]),
            )
            return F.sort_array(F.transform(twice, lambda x: x["at"]))

        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        nothing = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            _bind(placed, positions), nothing,
            lambda acc, at: F.struct(at.alias("last"), (acc["n"] + F.least(F.lit(width), at - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    def windows(ws: Column) -> Column:
        every = F.transform(ws, lambda w, i: F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, width)]))
        return F.slice(every, F.lit(1), F.size(ws) - (width - 1))

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    return _bind(words, lambda ws: F.when(F.size(ws) <= width, F.lit(0)).otherwise(_bind(windows(ws), count)))


def _stop_words(words: Column) -> Column:
    known = sorted({w for line in STOP_WORDS.values() for w in line.split()})
    return F.size(F.filter(words, lambda w: F.lower(F.btrim(w, F.lit(EDGES))).isin(known)))


def _characters(text: Column, which: str) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{which}]+", ""))


def counts(df: DataFrame, text_column: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with the counts that the measures are made of, each a long column ``prefix`` + its name."""
    text, words, lines = F.col("__text"), F.col("__words"), F.col("__lines")
    read = df.withColumn("__text", F.coalesce(F.col(text_column), F.lit("")))
    cut = read.withColumns({"__words": words_of(text), "__lines": lines_of(text)})
    named = {
        "n_words": F.size(words),
        "word_chars": F.char_length(F.translate(text, WHITE, "")),
        "n_symbols": _characters(text, SYMBOLS),
        "n_marks": _characters(text, "!"),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(words),
        "n_stop_words": _stop_words(words),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: F.ltrim(x).substr(1, 1).isin("-", "*", "•", "·"))),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))),
    }
    kept = [F.col(f"`{c}`") for c in df.columns]
    return cut.select(*kept, *[c.cast("long").alias(prefix + n) for n, c in named.items()])


def _share(part: str, whole: str) -> Callable[[Callable[[str], Column]], Column]:
    return lambda c: F.try_divide(c(part).cast("double"), c(whole))


#: measure -> expression over the counts
MEASURES: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "n_words": lambda c: c("n_words").cast("double"),
    "n_lines": lambda c: c("n_lines").cast("double"),
    "mean_word_chars": _share("word_chars", "n_words"),
    "repeat_word_share": _share("n_repeat_words", "n_words"),
    "symbols_per_word": _share("n_symbols", "n_words"),
    "marks_per_word": _share("n_marks", "n_words"),
    "stop_word_share": _share("n_stop_words", "n_words"),
    "dup_line_share": _share("n_dup_lines", "n_lines"),
    "bullet_line_share": _share("n_bullet_lines", "n_lines"),
    "ellipsis_line_share": _share("n_ellipsis_lines", "n_lines"),
}


def compile_rules(rules: Sequence[Rule], count: Callable[[str], Column]) -> list[tuple[str, Column]]:
    """(rule name, failed?) for every rule; ``count`` gives the column of a count. An unknown measure raises."""
    compiled = []
    for rule in rules:
        if rule.measure not in MEASURES:
            raise ValueError(f"unknown measure {rule.measure!r} in rule {rule.name!r}")
        value, tests = MEASURES[rule.measure](count), []
        if rule.low is not None:
            tests.append(value < F.lit(float(rule.low)))
        if rule.high is not None:
            tests.append(value > F.lit(float(rule.high)))
        failed = F.lit(False)
        for test in tests:
            failed = failed | F.coalesce(test, F.lit(False))
        compiled.append((rule.name, failed))
    return compiled


def judge(df: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[str] = BASE, text_column: str = "text") -> DataFrame:
    """``df`` with all counts, ``failed_rules`` (in the table's order), ``base_failed`` and ``kept``.

    A NULL text is an empty one: no words, no lines, so it fails ``too_short``. Rows are judged each by itself,
    repeated ones alike. A column of ``df`` that has the name of a result is replaced by it. An empty table gives
    an empty result.
    """
    taken = {"n_words", "word_chars", "n_symbols", "n_marks", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words",
             "n_bullet_lines", "n_ellipsis_lines", "failed_rules", "base_failed", "kept"}
    own = [c for c in df.columns if c not in taken or c == text_column]
    source = df.select(*[F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(own)], F.col(f"`{text_column}`").alias("__source"))
    counted = counts(source, "__source", "__n_")
    failed = compile_rules(rules, lambda name: F.col(f"__n_{name}"))
    names = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in failed])) if failed else F.array().cast("array<string>")
    return (
        counted.withColumn("__failed", names)
        .select(
            *[F.col(f"__in_{i}").alias(c) for i, c in enumerate(own)],
            *[F.col(c).alias(c[4:]) for c in counted.columns if c.startswith("__n_")],
            F.col("__failed").alias("failed_rules"),
            F.arrays_overlap("__failed", F.array(*[F.lit(b) for b in base])).alias("base_failed"),
            (F.size("__failed") == 0).alias("kept"),
        )
    )
