"""Quality rules: a decision list learned from labelled statistics, run as Spark conditions.

Each document is reduced to counts by built-in expressions, row by row, without a shuffle. On
labelled documents sequential covering then learns rules for the bad ones: a rule grows
threshold by threshold (the one with the best information gain), is pruned on rows it did not
grow on, and is kept while it is precise there; the rows it covers are set aside and the next
rule is grown. Every step is one aggregate over the binned statistics, so the driver sees
histograms only. The rules become one ordered ``CASE WHEN``.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetide.llm.shared import SPACE, filter_computed, free_name, stored

# Labelled rows used for learning, at most: those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
BINS = 24
MAX_RULES = 8
MAX_CONDITIONS = 4
# Share of bad rows among those a rule covers, on rows it was not grown on.
MIN_PRECISION = 0.9
# Bad rows that a rule must cover on either part.
MIN_COVER = 3
# One row in so many is kept for pruning.
PRUNE_PART = 3

# Fixed values of the base rule.
SYMBOLS = "#*$%&|<>"
GRAM = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _without(text: Column, characters: str) -> Column:
    """Characters that text loses without the given ones."""
    rest = text
    for c in characters:
        rest = F.replace(rest, F.lit(c))
    return F.length(text) - F.length(rest)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it occurs there.

    A named column would be written out at each use when the optimizer pushes a filter below the
    projection that makes it.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _stats(text: Column) -> Column:
    """The struct of counts of a text, as one expression in which no step is repeated."""
    count = lambda c: c.cast("bigint")

    def of_text(t: Column) -> Column:
        flat = t
        for c in "\t\n\x0b\x0c\r":
            flat = F.replace(flat, F.lit(c), F.lit(" "))
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
        words = F.array_remove(F.split(flat, " "), "")
        return _bound(lines, lambda line: _bound(words, lambda w: of_words(t, line, w)))

    def of_words(t: Column, line: Column, w: Column) -> Column:
        return _bound(F.transform(w, lambda x: F.xxhash64(x)), lambda h: of_hashes(t, line, w, h))

    def of_hashes(t: Column, line: Column, w: Column, h: Column) -> Column:
        n = F.size(w)
        return F.struct(
            count(n).alias("n_words"),
            count(F.length(t) - _without(t, " \t\n\x0b\x0c\r")).alias("word_chars"),
            count(_without(t, SYMBOLS)).alias("n_symbols"),
            count(F.size(line) - F.size(F.array_distinct(line))).alias("n_dup_lines"),
            count(repeated_words(n, h)).alias("n_repeat_words"),
            count(F.regexp_count(t, F.lit("[A-Z]"))).alias("n_upper"),
            count(_without(t, "!?")).alias("n_exclaims"),
            count(F.regexp_count(t, F.lit("[0-9]"))).alias("n_digits"),
            count(_without(t, ".,;:")).alias("n_marks"),
            count(F.size(line)).alias("n_lines"),
            count(F.size(F.array_distinct(h))).alias("n_distinct"),
        )

    def repeated_words(n: Column, h: Column) -> Column:
        window = F.transform(
            F.sequence(F.lit(0), n - GRAM), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(GRAM)])
        )
        grams = F.when(n >= GRAM, window).otherwise(F.expr("cast(array() as array<bigint>)"))
        # Only texts that repeat a window sort theirs.
        return _bound(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(F.lit(0)))

    def covered(g: Column) -> Column:
        # Sorted windows with their places: equal ones come together.
        placed = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return _bound(placed, twice)

    def twice(p: Column) -> Column:
        here, before, after = (lambda i, k=k: F.get(p, i + k)["x"] for k in (0, -1, 1))
        found = F.filter(
            F.sequence(F.lit(0), F.size(p) - 1),
            lambda i: here(i).eqNullSafe(before(i)) | here(i).eqNullSafe(after(i)),
        )
        places = F.array_sort(F.transform(found, lambda i: F.get(p, i)["i"]))
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(-GRAM).alias("at")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(GRAM), i - a["at"])).alias("n"), i.alias("at")),
            lambda a: a["n"],
        )

    return _bound(F.coalesce(text, F.lit("")), of_text)


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with a struct column ``stats`` (a free name) in place of ``text``.

    Fields: the base counts ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and
    ``n_upper, n_exclaims, n_digits, n_marks, n_lines, n_distinct``. NULL text counts as no
    words. ``n_repeat_words`` compares 64-bit hashes of five-word windows inside one text.
    A filter on the struct costs one more computation at most, wherever the optimizer puts it.
    """
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, _stats(F.col(text)).alias(free_name(keep, "stats")))


def base_failed(stats: Column) -> Column:
    """The fixed base rule: too few words, or too many of them in repeated windows."""
    few = stats["n_words"] < MIN_WORDS
    return few | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"])


def features(stats: Column) -> dict[str, Column]:
    """Numbers that conditions are put on, none of them NULL."""
    words, chars, lines = stats["n_words"], stats["word_chars"], stats["n_lines"]
    return {
        "words": words.cast("double"),
        "symbol_share": _ratio(stats["n_symbols"], chars),
        "upper_share": _ratio(stats["n_upper"], chars),
        "exclaim_share": _ratio(stats["n_exclaims"], chars),
        "digit_share": _ratio(stats["n_digits"], chars),
        "mark_share": _ratio(stats["n_marks"], chars),
        "word_length": _ratio(chars, words),
        "dup_line_share": _ratio(stats["n_dup_lines"], lines),
        "repeat_share": _ratio(stats["n_repeat_words"], words),
        "line_words": _ratio(words, lines),
        "distinct_share": _ratio(stats["n_distinct"], words),
    }


@dataclass(frozen=True)
class Condition:
    """``feature > cut`` or ``feature <= cut``."""

    feature: str
    above: bool
    cut: float

    def column(self, values: dict[str, Column]) -> Column:
        v = values[self.feature]
        return v > F.lit(self.cut) if self.above else v <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction of conditions that marks a document as bad."""

    conditions: tuple[Condition, ...]
    covered: int
    precision: float

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions))

    def column(self, values: dict[str, Column]) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column(values)
        return out


def labelled_sample(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, bad, stats`` of at most ``rows`` labelled documents.

    A document labelled more than once takes its worst label; NULL ids and labels are left out.
    The sample is broadcast: ``rows`` bounds it.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy("doc_id").agg((F.min("quality") <= 0).alias("bad"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(int(rows))
    return statistics(documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))


def _tally(rows: DataFrame, names: list[str]) -> dict:
    """Rows by part, class, feature and bin."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(f"b.{n}").alias("k")) for n in names]))
    counted = rows.select("prune", "bad", pairs.alias("x")).groupBy("prune", "bad", "x.f", "x.k").count()
    return {(r["prune"], r["bad"], r["f"], r["k"]): r["count"] for r in counted.collect()}


def _gain(good: int, bad: int, good_in: int, bad_in: int) -> float:
    """Information that narrowing to the inner rows gives about the bad ones."""
    if not bad_in:
        return 0.0
    return bad_in * (math.log2(bad_in / (bad_in + good_in)) - math.log2(bad / (bad + good)))


def learn_rules(
    sample: DataFrame,
    max_rules: int = MAX_RULES,
    max_conditions: int = MAX_CONDITIONS,
    min_precision: float = MIN_PRECISION,
    min_cover: int = MIN_COVER,
    bins: int = BINS,
) -> list[Rule]:
    """Rules for bad documents from ``doc_id, bad, stats``, in order; none if a class is absent.

    The driver holds one count for each part, class, feature and bin at a time.
    """
    values = features(F.col("stats"))
    names = list(values)
    rows = sample.filter(~base_failed(F.col("stats")))
    rows = rows.select("doc_id", "bad", F.struct(*[v.alias(n) for n, v in values.items()]).alias("v"))
    # Cut points come from each class on its own, so that a rare one has as many.
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    at = rows.groupBy("bad").agg(*[F.percentile(f"v.{n}", shares).alias(n) for n in names]).collect()
    if len(at) < 2:
        return []
    cuts = {}
    for n in names:
        found_at = sorted({c for r in at for c in r[n]})
        # With the middles between them, so that a cut can lie apart from either class.
        cuts[n] = sorted({*found_at, *((a + b) / 2 for a, b in zip(found_at, found_at[1:], strict=False))})
    place = lambda n: F.size(F.filter(F.lit(cuts[n]), lambda c: F.col(f"v.{n}") > c))
    binned = stored(
        rows.select(
            "bad",
            (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PRUNE_PART)) == 0).alias("prune"),
            F.struct(*[place(n).alias(n) for n in names]).alias("b"),
        ).coalesce(1),
        "binned",
    )

    def inside(tested: tuple[Condition, ...]) -> Column:
        out = F.lit(True)
        for c in tested:
            k = cuts[c.feature].index(c.cut)
            out = out & (F.col(f"b.{c.feature}") > k if c.above else F.col(f"b.{c.feature}") <= k)
        return out

    def sums(tally: dict, prune: bool, bad: bool, name: str, k: int) -> tuple[int, int]:
        """Rows at or below and above the k-th cut."""
        each = [(b, n) for (p, c, f, b), n in tally.items() if (p, c, f) == (prune, bad, name)]
        low = sum(n for b, n in each if b <= k)
        return low, sum(n for _, n in each) - low

    rules: list[Rule] = []
    left = binned
    while len(rules) < max_rules:
        grown: list[Condition] = []
        trail: list[tuple[int, int]] = []  # good and bad rows of the pruning part after each condition
        held = left
        while len(grown) < max_conditions:
            tally = _tally(held, names)
            total = {(p, c): sum(sums(tally, p, c, names[0], -1)) for p in (False, True) for c in (False, True)}
            good, bad = total[False, False], total[False, True]
            if grown:
                trail.append((total[True, False], total[True, True]))
            if not good or bad < min_cover:
                break
            best, found = 0.0, None
            for name in names:
                for k, cut in enumerate(cuts[name]):
                    goods, bads = sums(tally, False, False, name, k), sums(tally, False, True, name, k)
                    for above in (False, True):
                        gain = _gain(good, bad, goods[above], bads[above])
                        # Of equal cuts the one furthest from the good rows.
                        same = found is not None and (found.feature, found.above, above) == (name, True, True)
                        if bads[above] >= min_cover and (gain > best + 1e-9 or same and gain >= best - 1e-9):
                            best, found = gain, Condition(name, above, cut)
            if found is None:
                break
            grown.append(found)
            held = held.filter(inside((found,)))
        if len(trail) < len(grown):
            tally = _tally(held, names)
            trail.append(tuple(sum(sums(tally, True, c, names[0], -1)) for c in (False, True)))
        if not grown:
            break
        # Prune: the shortest beginning that is best on the rows it did not grow on.
        worth = [(b - g) / (b + g) if b + g else -1.0 for g, b in trail]
        size = worth.index(max(worth)) + 1
        good, bad = trail[size - 1]
        precision = bad / (bad + good) if bad + good else 0.0
        if precision < min_precision or bad < min_cover:
            break
        rules.append(Rule(tuple(grown[:size]), good + bad, precision))
        left = left.filter(~inside(tuple(grown[:size])))
    return rules


def verdict(rules: list[Rule], stats: Column) -> Column:
    """Number of the first rule that rejects (0: the base rule), NULL for documents that stay."""
    values = features(stats)
    out = F.when(base_failed(stats), F.lit(0))
    for k, rule in enumerate(rules):
        out = out.when(rule.column(values), F.lit(k + 1))
    return out


def judge(documents: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """Every row with its statistics in place of the text, ``rule`` (what rejects it, else NULL)
    and ``kept``. Extra columns stay; an added name that is taken gets a leading underscore."""
    judged = statistics(documents, text)
    stats = judged.columns[-1]
    rule = free_name(judged.columns, "rule")
    judged = judged.withColumn(rule, _bound(F.col(stats), lambda s: verdict(rules, s)))
    return judged.withColumn(free_name(judged.columns, "kept"), F.col(rule).isNull())


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, **options) -> list[Rule]:
    """Learn rules from documents and their ``quality`` labels (0 is bad)."""
    return learn_rules(stored(labelled_sample(documents, labels, rows), "labelled"), **options)


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that no rule rejects, with the columns they came with."""
    rules = fit(documents, labels)
    # The text travels beside its twin, which the statistics consume.
    twin = free_name(documents.columns, "_twin")
    judged = statistics(documents.withColumn(twin, F.col("text")), twin)
    stats = F.col(judged.columns[-1])
    return filter_computed(judged, verdict(rules, stats).isNull()).select(*documents.columns)
