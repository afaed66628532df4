"""Quality rules as a short-circuit cascade, in SQL functions only.

``order_rules`` orders the rules by rejections per cost, both measured on a
sample.  ``judge`` applies them one after the other: the counts that a rule
reads are computed only of rows that no earlier rule rejected.  Where all
counts are wanted of all rows, ``measure`` adds them and ``cascade`` joins the
rules into one CASE over them.  The order changes the time taken, never the
verdict: a row is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import WORD, discard, words_of, written

# Rows of the sample on which costs and rejections are measured (about; a
# Bernoulli sample).  It decides the order of the rules, not their outcome.
SAMPLE_ROWS = 2000
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A named rule; ``rejects`` gives the boolean column that is true for a row to reject, over the counts ``reads``."""

    name: str
    rejects: Callable[[], Column]
    reads: tuple[str, ...] = MEASURES


def default_rules() -> list[Rule]:
    """Rules over the counts of ``measure``, mild enough to leave ordinary prose alone."""
    n = F.col("n_words")
    return [
        Rule("few_words", lambda: n < 20, ("n_words",)),
        Rule("repeated_words", lambda: 100 * F.col("n_repeat_words") > 30 * n, ("n_words", "n_repeat_words")),
        Rule("symbols", lambda: 10 * F.col("n_symbols") > n, ("n_words", "n_symbols")),
        Rule("word_length", lambda: (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n), ("n_words", "word_chars")),
        Rule("repeated_lines", lambda: 2 * F.col("n_dup_lines") > F.col("n_lines"), ("n_lines", "n_dup_lines")),
    ]


def solid(c: Column) -> Column:
    """``c``, where the optimizer leaves it.

    It would copy a count's whole expression into a filter on it, over and over for
    nested ones; it moves no filter below a column that depends on the place of a row.
    """
    return F.when(F.monotonically_increasing_id() >= 0, c)


def expressions(text: str = "text") -> dict[str, tuple[tuple[str, ...], Column]]:
    """The counts and the columns on the way to them, each with the columns it is made of, in an order that works."""
    hashes = F.transform("__words", lambda w: F.xxhash64(w))
    windows = F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("__words") - WINDOW),
        lambda i: F.xxhash64(*[F.get("__hashes", i + k) for k in range(WINDOW)])))
    ordered = F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), F.array_sort(
        F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    repeated = F.array_sort(F.transform(F.filter(F.transform("__ordered", lambda x, k: F.struct(
        x["i"].alias("i"), (F.coalesce(F.get("__ordered", k - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get("__ordered", k + 1)["h"] == x["h"], F.lit(False))).alias("again"))),
        lambda x: x["again"]), lambda x: x["i"]))
    covered = F.aggregate(F.transform("__places", lambda p, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get("__places", k + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(WORD))
    return {
        "__words": ((), words_of(F.col(text))),
        "__lines": ((), lines),
        "n_words": (("__words",), F.size("__words").cast("long")),
        "__hashes": (("__words",), hashes),
        "n_lines": (("__lines",), F.size("__lines").cast("long")),
        "n_dup_lines": (("__lines",), (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long")),
        "__windows": (("__words", "__hashes", "n_words"), windows),
        "__ordered": (("__windows",), ordered),
        "__places": (("__ordered",), repeated),
        "word_chars": (("__words",), F.aggregate("__words", F.lit(0).cast("long"), lambda a, w: a + F.length(w))),
        "n_symbols": ((), F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long")),
        "n_repeat_words": (("__places",), F.coalesce(covered.cast("long"), F.lit(0).cast("long"))),
    }


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words to every row.

    Counts are over whole texts; a null or empty text gives zeros.  Columns of
    these names that ``df`` has already are replaced.  Windows of 8 words are
    compared by 64-bit hashes.  One narrow projection: no shuffle.
    """
    exprs = {name: c for name, (_, c) in expressions(text).items()}
    kept = [c for c in df.columns if c not in MEASURES]

    def named(*names: str) -> list[Column]:
        return [exprs[n].alias(n) for n in names]

    at_last = {"word_chars", "n_symbols", "n_repeat_words"}
    return (df.select(*kept, *named("__words", "__lines"))
            .select(*kept, "__words", *named("n_words", "__hashes", "n_lines", "n_dup_lines"))
            .select("*", *named("__windows"))
            .select("*", *named("__ordered"))
            .select("*", *named("__places"))
            .select(*kept, *[solid(exprs[n] if n in at_last else F.col(n)).alias(n) for n in MEASURES]))


def order_rules(df: DataFrame, rules: Sequence[Rule], prepare: Callable[[DataFrame], DataFrame] = measure,
                sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Order ``rules`` by rejected rows per second on a sample of about ``sample_rows`` rows.

    Each rule is timed with what it needs (``prepare`` is pruned to the counts
    that the rule reads), twice, and the shorter time counts, less that of a job
    over the sample that tests nothing.  An empty table leaves the order as given.
    """
    total = df.count()
    if not total or len(rules) < 2:
        return list(rules)
    sample = written(df.sample(min(1.0, sample_rows / total), seed=7), "quality-sample")

    def timed(judged: DataFrame) -> tuple[float, int]:
        times, found = [], 0
        for _ in range(2):
            began = time.perf_counter()
            found = judged.first()[0] or 0
            times.append(time.perf_counter() - began)
        return min(times), found

    empty, _ = timed(sample.agg(F.count_if(F.lit(False))))
    scored = []
    for rule in rules:
        took, rejected = timed(prepare(sample).agg(F.count_if(rule.rejects())))
        scored.append((rejected / max(took - empty, 1e-3), rule))
    discard(sample)
    return [r for _, r in sorted(scored, key=lambda x: -x[0])]


def cascade(rules: Sequence[Rule]) -> Column:
    """The name of the first rule, in the order given, that rejects a row; null if none does."""
    out = None
    for rule in rules:
        test = F.coalesce(rule.rejects(), F.lit(False))
        out = F.when(test, rule.name) if out is None else out.when(test, rule.name)
    return out if out is not None else F.lit(None).cast("string")


def quality_filter(df: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text",
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Add the counts of ``measure`` and ``rejected_by`` (null: the row is kept).

    Null and empty texts have no words, so ``few_words`` rejects them; repeated
    rows are judged each by itself; an empty table stays empty; other columns
    pass through.
    """
    text_only = df.select(F.col(text).alias("text"))
    ordered = order_rules(text_only, default_rules() if rules is None else rules, sample_rows=sample_rows)
    return measure(df, text).withColumn("rejected_by", cascade(ordered))


def judge(df: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS,
          ordered: bool = False) -> DataFrame:
    """Add ``rejected_by`` (null: the row is kept) and the counts that were needed for it.

    The rules are ordered on a sample unless ``ordered`` says that they are.  Each
    count is computed once, before the first rule that reads it, and only of rows
    that no rule before rejected: it is null elsewhere, and such rows are not tested
    again.  Verdicts are those of ``quality_filter``; so are the results for null,
    empty and repeated texts and for columns that ``df`` has already.
    """
    rules = default_rules() if rules is None else list(rules)
    if not ordered:
        rules = order_rules(df.select(F.col(text).alias("text")), rules, sample_rows=sample_rows)
    exprs = expressions(text)
    kept = [c for c in df.columns if c not in MEASURES and c != "rejected_by"]
    out = df.select(*kept, F.lit(None).cast("string").alias("rejected_by"))
    done: set[str] = set()

    def wanted(name: str) -> set[str]:
        return {name}.union(*map(wanted, exprs[name][0]))

    for rule in rules:
        missing = [n for n in exprs if n in set().union(*map(wanted, rule.reads)) - done]
        while missing:
            ready = [n for n in missing if done.issuperset(exprs[n][0])]
            out = out.select("*", *[solid(F.when(F.col("rejected_by").isNull(), exprs[n][1])).alias(n) for n in ready])
            done.update(ready)
            missing = [n for n in missing if n not in done]
        verdict = F.coalesce("rejected_by", F.when(rule.rejects(), F.lit(rule.name)))
        out = out.select(*[c for c in out.columns if c != "rejected_by"], solid(verdict).alias("rejected_by"))
    return out.select(*kept, *[c for c in MEASURES if c in done], "rejected_by")
