"""Personal data in text: checked patterns, and identifiers found by the company they keep.

Base: e-mail addresses, IP addresses, card and phone numbers, by patterns and checks. Bootstrapping goes on from these seeds:
the two words before a seed are a lexical pattern; what stands behind a pattern elsewhere and looks like an identifier (six
characters or more: one word with a digit, or groups of digits joined by single blanks, brackets, dots or hyphens) is an
instance. Where a word and groups begin together, the shorter is the instance and the longer is its span. Patterns and instances form a graph that is scored in rounds: a
pattern by the share of its occurrences in the whole corpus that are trusted instances (and it needs ``SUPPORT`` different
ones), an instance by the chance that not all its patterns are wrong. Instances above ``TRUST`` are trusted in the next round,
until no round finds new ones. An instance has the kind of its seed or of the best pattern that found it, a pattern the kind
most of its trusted instances have. Patterns above ``TRUST`` at the end add the instances behind them to the spans.

Everything is Spark SQL. Spans are found by putting a mark around each match and adding up the lengths of the pieces; the
graph has a row for each identifier-like string, and no text travels. Texts with the same md5 have the same spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.arrays import let, replaced, running
from tablejobs.llm.decontaminate import free_names
from tablejobs.llm.shared import BROADCAST_IDS, written

MARK, OTHER = "\x01", "\x02"
# A match begins where the last one ended or where no letter of its first part stands before it: elsewhere it would have begun
# earlier. Possessive repeats never go back; nothing that follows them could match what they took.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){11}", "phone": r"\+[0-9]"}
KINDS = list(PATTERNS)
TOKEN = "A-Za-z0-9@._%+/-"
LEAST = 6  # characters
WORD = rf"(?<![{TOKEN}])(?=[A-Za-z@._%+/-]*+[0-9])[{TOKEN}]{{{LEAST},}}+"
# Digits that go on as a word with letters are no groups.
DIGITS = "[0-9]++(?:[.-][0-9]++)*+(?![.-]*+[A-Za-z0-9@_%+/])"
GROUPS = rf"(?<![{TOKEN}])\(?+{DIGITS}(?:(?:\)[ .-]?+\(?+| \(?+|\(){DIGITS})*+"
CONTEXT = 2  # words
CONTEXT_CHARS = 80
SUPPORT = 3
TRUST = 0.7
SLOTS = 1 << 18  # of the bitmap of patterns
SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string,context:string>"


def _valid(kind: str, value: str) -> str:
    digits = f"translate({value}, ' -().+', '')"
    if kind == "ip":
        bare = "ltrim('0', q)"
        return f"forall(split({value}, '[.]'), q -> char_length({bare}) < 4 and cast(concat('0', {bare}) as int) <= 255)"
    if kind == "card":
        digit = "cast(substring(d, -i, 1) as int)"
        luhn = f"aggregate(sequence(1, char_length(d)), 0, (t, i) -> t + if(i % 2 = 1, {digit}, {digit} * 2 - if({digit} > 4, 9, 0)))"
        return f"transform(array({digits}), d -> char_length(d) between 12 and 19 and {luhn} % 10 = 0)[0]"
    if kind == "phone":
        return f"char_length({digits}) between 9 and 15"
    return "true"


def _matches(text: str, pattern: str, kind: str, rank: int, hint: str, valid: str) -> str:
    """SQL of the spans of the valid matches, with the words before each."""
    pattern, hint = pattern.replace("\\", "\\\\"), hint.replace("\\", "\\\\")
    pieces = f"split(regexp_replace({text}, '{pattern}', '{MARK}$0{MARK}'), '{MARK}')"  # every other piece is a match
    before = rf"regexp_extract(right(s.before, {CONTEXT_CHARS}), '(\\S+\\s+\\S+)\\s*$', 1)"
    context = rf"lower(regexp_replace({before}, '\\s+', ' '))"
    span = f"struct(s.at as start, {rank} as rank, s.at + char_length(x) as end, '{kind}' as kind, x as value, {context} as context)"
    state = {"at": ("0", "s.at + char_length(x)"), "odd": ("false", "not s.odd"), "before": ("''", "x")}
    found = running(pieces, state, f"if(s.odd and {valid}, {span}, null)", SPAN)
    return f"if({text} rlike '{hint}', filter({found}, x -> x is not null), cast(array() as array<{SPAN}>))"


def base_spans(text: str) -> Column:
    """Spans of the base kinds by start, then kind. ``text`` is SQL of a text that is not null and has no mark."""
    found = [_matches(text, PATTERNS[k], k, i, HINTS[k], _valid(k, "x")) for i, k in enumerate(KINDS)]
    return F.expr(f"sort_array(concat({', '.join(found)}))")


def scan(docs: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """The columns ``keep``, md5 of the text as ``text_key``, base spans, and instances that overlap none of them."""
    text = f"translate(coalesce(`{text_col}`, ''), '{MARK}', '{OTHER}')"
    found = docs.select(*keep, F.expr(f"md5(coalesce(`{text_col}`, ''))").alias("text_key"), F.expr(text).alias("clean"))
    found = found.select(*keep, "text_key", "clean", base_spans("clean").alias("base"))
    words = _matches("clean", WORD, "", len(KINDS), "[0-9]", "true")
    groups = _matches("clean", GROUPS, "", len(KINDS), "[0-9]", f"char_length(x) >= {LEAST}")
    found = found.select(*keep, "text_key", "base", F.expr(_apart("base", f"sort_array(concat({words}, {groups}))")).alias("both"))
    # At most two begin together, the shorter first.
    end = "if(get(both, i + 1).start = s.start, get(both, i + 1).end, s.end)"
    one = f"struct(s.start as start, s.rank as rank, {end} as end, s.kind as kind, s.value as value, s.context as context)"
    others = f"filter(transform(both, (s, i) -> if(get(both, i - 1).start = s.start, null, {one})), s -> s is not null)"
    return found.select(*keep, "text_key", "base", F.expr(let("both", "both", others)).cast(f"array<{SPAN}>").alias("others"))


def _apart(base: str, instances: str) -> str:
    """SQL of the instances that overlap no base span; both are in order. One pass forward finds those that begin inside a
    span, one backward those in which a span begins."""
    no = f"cast(null as {SPAN})"
    marks = f"sort_array(concat(transform(base, b -> struct(b.start as start, 0 as what, b.end as end, {no} as c)), transform(all_, c -> struct(c.start as start, 1 as what, c.end as end, c as c))))"
    forward = running("marks_", {"reach": ("0", "if(x.what = 0, greatest(s.reach, x.end), s.reach)")}, "s.reach > x.start", "boolean")
    backward = running("reverse(marks_)", {"next": (f"{2**31 - 1}", "if(x.what = 0, x.start, s.next)")}, "s.next < x.end", "boolean")
    taken = "if(m.what = 1 and not inside_[i] and not over_[size(over_) - 1 - i], m.c, null)"
    kept = f"filter(transform(marks_, (m, i) -> {taken}), c -> c is not null)"
    kept = let(marks, "marks_", let(forward, "inside_", let(backward, "over_", kept)))
    return let(base, "base", let(instances, "all_", f"if(size(base) = 0 or size(all_) = 0, all_, {kept})"))


def patterns(found: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(context, kind) of the patterns that the rounds leave above ``TRUST``; ``found`` is what ``scan`` gave for ``docs``."""
    short = F.expr("if(char_length(s.value) > 64, sha2(s.value, 256), s.value)").alias("value")
    rows = found.select(F.explode(F.concat("base", "others")).alias("s")).select("s.context", short, "s.kind", "s.rank")
    nodes = rows.where("context <> ''").groupBy("context", "value").agg(
        F.count("*").alias("times"), F.min(F.when(F.col("kind") != "", F.col("rank"))).alias("seed")
    )
    nodes = written(nodes, "pii_nodes")
    wide = nodes.groupBy("context").agg(F.count("*").alias("n"), F.count("seed").alias("seeds"), F.sum("times").alias("seen"))
    wide = written(wide.where(f"n >= {SUPPORT}"), "pii_contexts")
    empty = docs.sparkSession.createDataFrame([], "context string, kind string")
    if wide.where(f"seeds >= {SUPPORT}").isEmpty():
        return empty  # no pattern can have support in the first round, so none will later

    # How often the words of a pattern occur in the corpus, whatever follows: counted where they are read, and only then joined.
    # A bitmap leaves out most words that belong to no pattern before they are counted.
    slot = F.expr(f"cast(pmod(xxhash64(context), {SLOTS}) as int)")
    used = set(wide.select(F.collect_set(slot)).first()[0])  # at most SLOTS numbers
    bitmap = F.lit(bytes(49 if i in used else 48 for i in range(SLOTS)))
    words = rf"filter(split(lower(coalesce(`{text_col}`, '')), '\\s+'), w -> w <> '')"
    pairs = "if(size(words) < 3, array(), transform(sequence(0, size(words) - 3), i -> concat_ws(' ', words[i], words[i + 1])))"
    pairs = docs.select(F.explode(F.expr(let(words, "words", pairs))).alias("context"))
    pairs = pairs.where(F.substring(bitmap, slot + 1, F.lit(1)) == F.lit(b"1"))
    occurs = pairs.groupBy("context").agg(F.count("*").alias("occurs"))
    wide = wide.join(occurs, "context", "left").select("context", F.expr("greatest(seen, coalesce(occurs, 0))").alias("occurs"))
    wide = written(wide, "pii_contexts")

    graph = written(nodes.join(wide, "context"), "pii_graph")
    seeds = graph.where("seed is not null").groupBy("value").agg(F.min("seed").alias("of"))
    trusted = written(seeds, "pii_trusted")
    n, best = trusted.count(), empty
    while True:  # the trusted only grow, and the graph is finite
        known = graph.join(trusted, "value").groupBy("context", "occurs").agg(
            F.count("*").alias("n"), F.sum("times").alias("seen"), F.mode("of", True).alias("of")
        )
        scored = known.where(f"n >= {SUPPORT}").select("context", "of", (F.col("seen") / F.col("occurs")).alias("score"))
        scored = written(scored, "pii_scored")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))
        first = F.max_by("of", F.struct("score", "context"))
        judged = graph.join(scored, "context").groupBy("value").agg((1 - doubt).alias("score"), first.alias("of"))
        new = judged.where(f"score >= {TRUST}").select("value", "of").join(trusted, "value", "left_anti")
        trusted = written(trusted.union(new.select(*trusted.columns)), "pii_trusted")
        best = scored.where(f"score >= {TRUST}")
        if (now := trusted.count()) == n:
            break
        n = now
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return best.select("context", F.element_at(kinds, F.col("of") + 1).alias("kind"))


def discovered(found: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(text_key, extra): spans of the instances behind trusted patterns; a row for each text that has any."""
    known = patterns(found, docs, text_col).withColumnRenamed("kind", "of")
    rows = found.where("size(others) > 0").select("text_key", "others").dropDuplicates(["text_key"])
    rows = rows.select("text_key", F.explode("others").alias("s")).withColumn("context", F.col("s.context"))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("of")).cast("int") - 1
    span = F.struct(F.col("s.start"), rank.alias("rank"), F.col("s.end"), F.col("of").alias("kind"), F.col("s.value"), F.col("context"))
    return rows.join(known, "context").groupBy("text_key").agg(F.collect_list(span.cast(SPAN)).alias("extra"))


def _listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row, repeated rows and null ids included; a null
    or empty text has no spans. Counts and digest are of the base spans; ``spans`` has all, in code points, end exclusive."""
    given = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    found = written(scan(given, "text", "doc_id"), "pii_spans")
    found = found.join(discovered(found, given, "text"), "text_key", "left")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    every = "sort_array(concat(base, coalesce(extra, array())))"
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed(every).alias("spans"))


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (spans that overlap by that of the first). Other columns,
    texts without spans and null texts stay as they are."""
    columns = docs.columns
    key, text = free_names(docs, "text_key", "masked_text")
    found = written(scan(docs, text_col), "pii_spans")
    extra = discovered(found, docs, text_col)
    spans = found.where("size(base) > 0").select("text_key", "base").dropDuplicates(["text_key"]).join(extra, "text_key", "full")
    every = "sort_array(concat(coalesce(base, array()), coalesce(extra, array())))"
    spans = written(spans.select(F.col("text_key").alias(key), F.expr(every).alias(text)), "pii_all")
    keyed = docs.withColumn(key, F.md5(F.coalesce(docs[text_col], F.lit(""))))
    if spans.count() <= BROADCAST_IDS // 16:
        spans = F.broadcast(spans)
    t = f"`{text_col}`"
    result = keyed.join(spans, key, "left")
    masked = replaced(t, f"`{text}`", "concat('[', upper(x.kind), ']')")
    return result.withColumn(text_col, F.expr(f"if(`{text}` is null, {t}, {masked})")).select(*[f"`{c}`" for c in columns])
