"""Quality rules in column expressions, evaluated as a short-circuit cascade.

The cost of each rule and the share of documents it rejects are estimated on a sample of rows from all partitions; the cascade
tries the rules with the most rejections per cost first, and a document meets only the rules up to its first failure. The words
are split once and shared by the rules. The order never changes a verdict. Everything is Spark SQL within the row, so nothing is
shuffled: words are arrays, repeated windows are found by comparing and, where there are many, sorting their hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.arrays import let
from tablejobs.llm.shared import written

BLANK = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 500  # about as many rows show cost and selectivity; they only choose an order
SAMPLE_SEED = 7
REPEATS = 3  # evaluations of each rule on a row, of which the fastest counts
FEW = 16  # repeated windows up to which each window is looked up in their list; beyond it the windows are sorted

# A document is rejected if one of these holds. The first two are the base; the others are this cascade's own verdict.
BASE = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
}
RULES = BASE | {
    "symbols": "5 * n_symbols > n_words",
    "repeated_lines": "n_dup_lines >= 5 and 2 * n_dup_lines > n_lines",
    "long_words": "word_chars > 25 * n_words",
    "capitals": "10 * n_capitals > 4 * word_chars",
}


def word_list(text: str) -> str:
    return rf"filter(split({text}, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"


def line_list(text: str) -> str:
    """Lines that have a word."""
    return f"filter(split({text}, '\\n'), l -> btrim(l, '{BLANK}') <> '')"


def measures(text: str, words: str | None = None, lines: str | None = None) -> dict[str, str]:
    """SQL of each measure of the text in the expression ``text``, which must not be null. ``words`` and ``lines`` may name
    columns that hold its lists already."""
    words, lines = words or word_list(text), lines or line_list(text)

    def only(characters: str) -> str:
        return f"cast(char_length(regexp_replace({text}, '[^{characters}]+', '')) as bigint)"

    def covered(windows: str) -> str:
        """Words in the windows at these places."""
        return f"size(array_distinct(flatten(transform({windows}, p -> array(p, p + 1, p + 2)))))"

    places = "sequence(0, size(g) - 1)"
    looked_up = covered(f"filter({places}, i -> array_contains(d, g[i]))")
    pairs = "sort_array(transform(g, (x, i) -> struct(x as g, i as i)))"
    beside = "filter(s, (x, k) -> (k > 0 and s[k - 1].g = x.g) or (k < size(s) - 1 and s[k + 1].g = x.g))"
    in_order = let(pairs, "s", covered(f"transform({beside}, y -> y.i)"))
    twice = let("sort_array(g)", "o", "array_distinct(filter(o, (x, k) -> k > 0 and o[k - 1] = x))")
    some = let(twice, "d", f"if(size(d) <= {FEW}, {looked_up}, {in_order})")
    hashes = "transform(sequence(0, size(h) - 3), i -> xxhash64(h[i], h[i + 1], h[i + 2]))"
    repeats = let(hashes, "g", f"if(size(array_distinct(g)) = size(g), 0, {some})")
    return {
        "n_words": f"cast(size({words}) as bigint)",
        "word_chars": f"cast(char_length(array_join({words}, '')) as bigint)",
        "n_symbols": only(SYMBOLS),
        "n_lines": f"cast(size({lines}) as bigint)",
        "n_dup_lines": "cast(" + let(lines, "l", "size(l) - size(array_distinct(l))") + " as bigint)",
        "n_repeat_words": "cast(" + let(f"transform({words}, w -> xxhash64(w))", "h", f"if(size(h) < 4, 0, {repeats})") + " as bigint)",
        "n_capitals": only("A-Z"),
    }


def _spelled(rule: str, text: str, words: str, lines: str | None = None) -> str:
    """The rule with each measure replaced by its SQL. Without ``lines`` a rule on lines splits the text, once."""
    sql = measures(text, words, lines or "lines_")
    parts = rule.split(" ")
    spelled = " ".join(sql.get(part, part) for part in parts)
    return spelled if lines or not {"n_lines", "n_dup_lines"} & set(parts) else let(line_list(text), "lines_", spelled)


def sample(docs: DataFrame, text_col: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` texts, each row chosen with the same chance; the same ones for the same partitions. They stay on the
    executors: no text comes to the driver."""
    share = min(1.0, rows / max(docs.count(), 1))
    texts = docs.select(F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return written(texts.where(F.rand(SAMPLE_SEED) < share), "quality_sample")


def estimates(texts: DataFrame, rules: dict[str, str] = RULES) -> dict[str, tuple[float, int]]:
    """Nanoseconds a row and number of rejected rows of each rule, from one job over the sample: the clock is read in the row,
    before and after the rule. What all rules share, the split into words, is in no rule's cost."""
    clock = "cast(reflect('java.lang.System', 'nanoTime') as bigint)"
    given = texts.select("text", F.expr(word_list("text")).alias("words"), F.explode(F.sequence(F.lit(1), F.lit(REPEATS))).alias("turn"))
    given = given.withColumn("row", F.xxhash64("text"))
    timed = [F.expr(f"struct({clock} as a, {_spelled(rule, 'text', 'words')} as hit, {clock} as b)").alias(name) for name, rule in rules.items()]
    best = given.select("row", "turn", *timed).groupBy("row").agg(
        F.count_if(F.col("turn") == 1).alias("n"),
        *[F.min(F.col(name)["b"] - F.col(name)["a"]).alias(f"{name}_time") for name in rules],
        *[F.bool_or(F.col(name)["hit"]).alias(f"{name}_hit") for name in rules],
    )
    totals = best.agg(
        F.sum("n").alias("n"),
        *[F.sum(F.col("n") * F.col(f"{name}_time")).alias(f"{name}_time") for name in rules],
        *[F.sum(F.col("n") * F.col(f"{name}_hit").cast("long")).alias(f"{name}_hit") for name in rules],
    ).first()
    return {name: ((totals[f"{name}_time"] or 0) / max(totals["n"] or 0, 1), totals[f"{name}_hit"] or 0) for name in rules}


def ranked(found: dict[str, tuple[float, int]]) -> list[str]:
    """Names by rejections per cost, the best first. Costs count in powers of four, and rules alike in both keep their order, so
    that small differences between runs change nothing."""
    return sorted(found, key=lambda name: -(found[name][1] + 1) / 4.0 ** round(math.log(max(found[name][0], 1), 4)))


def order(docs: DataFrame, text_col: str = "text", rules: dict[str, str] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules, those with the most rejections per time first, as seen on about ``sample_rows`` rows."""
    return ranked(estimates(sample(docs, text_col, sample_rows), rules))


def cascade(names: list[str], text: str, words: str, lines: str | None = None, rules: dict[str, str] = RULES) -> str:
    """SQL that is true where no rule holds. A rule is evaluated only where none before it held."""
    tried = "".join(f" when {_spelled(rules[name], text, words, lines)} then false" for name in names)
    return f"case{tried} else true end"


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of every row, repeated rows
    and null ids included. Null, empty and blank texts have no words and are rejected."""
    names = order(docs, text_col)
    given = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    given = given.select("doc_id", "text", F.expr(word_list("text")).alias("words"), F.expr(line_list("text")).alias("lines"))
    sql = measures("text", "words", "lines")
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = given.select("doc_id", "text", "words", "lines", *[F.expr(sql[name]).alias(name) for name in shown])
    base_failed = F.expr(" or ".join(f"({rule})" for rule in BASE.values()))
    rest = {name: " ".join(f"`{part}`" if part in shown else part for part in rule.split(" ")) for name, rule in RULES.items()}
    kept = F.expr(cascade(names, "text", "words", "lines", rest))
    return found.select("doc_id", *shown, base_failed.alias("base_failed"), kept.alias("kept"))


def keep(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, all columns as they are. Rows with null, empty or blank texts go."""
    kept = cascade(order(docs, text_col), "text_", "words_")
    return docs.where(F.expr(let(f"coalesce(`{text_col}`, '')", "text_", let(word_list("text_"), "words_", kept))))
