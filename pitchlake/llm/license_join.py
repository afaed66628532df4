"""License scan: phrases by place, and an exact set-similarity join with license templates, in SQL functions only.

A text block is a line.  A template fits a block when the block holds at
least ``THRESHOLD`` of the template's distinct words.  Tokens are ordered by
their frequency over the whole corpus, rarest first (only template tokens
need an order: others can't be shared).  With required overlap
a = ceil(t * |T|), a block that fits

* holds one of the first |T| - a + 1 tokens of T (prefix filter),
* has at least a distinct template tokens (length filter), and
* from its first shared token, at place p of T and place q of the block's own
  template tokens in the same order, shares at most 1 + min(|T| - p - 1,
  |block| - q - 1) tokens, which must reach a (positional filter).

Candidates fetched by prefix tokens are verified by exact overlap.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.url_rules import LOWER, UPPER

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after A-Z became a-z
RAW_WORDS = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"  # the same words before
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_GAP = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"
THRESHOLD = 0.8

# Phrases of the base scan, by label.
PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

# Templates of common license lines, by label.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "mit": "released under the mit license",
    "rights-reserved": "all rights reserved",
}


def lower_words(text: Column) -> Column:
    """Words of a text in order, A-Z lower-cased."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), GAP), "")


def phrase_columns(text: Column, phrases: Mapping[str, str] = PHRASES) -> dict[str, Column]:
    """n_words, and ``places``: structs (word index, label) of every phrase, in word order; null where there is none."""
    text = F.coalesce(text, F.lit(""))
    any_phrase = "|".join(RAW_GAP.join(map(re.escape, p.split())) for p in phrases.values())
    # Most texts hold no phrase: one search over the raw text spares them the word array.
    words = F.when(text.rlike(f"(?i)(?:{any_phrase})"), lower_words(text))
    return {"n_words": F.regexp_count(text, F.lit(RAW_WORDS)).cast("long"), "__words": words}


def phrase_places(words: str, phrases: Mapping[str, str] = PHRASES) -> Column:
    def at(i: Column, phrase: str) -> Column:
        return F.array(*[F.get(words, i + k) for k in range(len(phrase.split()))]) == F.array(*map(F.lit, phrase.split()))

    def label(w: Column, i: Column) -> Column:
        first = None
        for name, phrase in phrases.items():
            test = (w == phrase.split()[0]) & F.coalesce(at(i, phrase), F.lit(False))
            found = F.array(F.struct(i.cast("long").alias("i"), F.lit(name).alias("label")))
            none = F.array().cast("array<struct<i:bigint,label:string>>")
            part = F.when(test, found).otherwise(none)
            first = part if first is None else F.concat(first, part)
        return first

    starts = sorted({p.split()[0] for p in phrases.values()})
    return F.flatten(F.filter(F.transform(words, lambda w, i: F.when(w.isin(*starts), label(w, i))), lambda x: x.isNotNull()))


def template_index(docs: DataFrame, text: str, templates: Mapping[str, str], threshold: float) -> tuple[list[tuple], list[str]]:
    """(token, place, label, size, need, tokens) for the prefix tokens of each template, and all template tokens in order.

    Corpus frequencies are counted over all of ``docs``, for template tokens
    only; what reaches the driver is bounded by the templates.
    """
    sets = {k: sorted(set(v.lower().split())) for k, v in templates.items()}
    wanted = docs.sparkSession.createDataFrame([(t,) for t in sorted({t for s in sets.values() for t in s})], "token string")
    rows = (docs.select(F.explode(F.split(F.coalesce(F.col(text), F.lit("")), RAW_GAP)).alias("raw"))
            .select(F.translate("raw", UPPER, LOWER).alias("token"))
            .join(F.broadcast(wanted), "token").groupBy("token").count().collect())
    counts = {r["token"]: r["count"] for r in rows}

    def rank(token: str) -> tuple[int, str]:
        return counts.get(token, 0), token

    out = []
    for label, tokens in sorted(sets.items()):
        ordered = sorted(tokens, key=rank)
        need = math.ceil(threshold * len(ordered) - 1e-9)
        out += [(t, p, label, len(ordered), need, ordered) for p, t in enumerate(ordered[:len(ordered) - need + 1])]
    return out, sorted({t for s in sets.values() for t in s}, key=rank)


def matching_blocks(docs: DataFrame, key: list[str], text: str = "text", templates: Mapping[str, str] = TEMPLATES,
                    threshold: float = THRESHOLD) -> DataFrame:
    """Every (row, line, template) whose line holds at least ``threshold`` of the template's words.

    Returns ``key`` columns, line (0-based), block (its text), label, overlap and
    containment.  Null texts have no lines; an empty table gives no rows;
    repeated lines and rows count each.  Very long texts are split into lines
    inside their row, and only lines with a prefix token go on.
    """
    entries, every = template_index(docs, text, templates, threshold)
    spark = docs.sparkSession
    schema = "token string, place int, label string, size int, need int, tokens array<string>"
    if not entries:
        probe = "(?!)"
    else:
        probe = "(?i)(?<![0-9A-Za-z\\x{80}-\\x{10FFFF}])(?:" + "|".join(sorted({re.escape(e[0]) for e in entries})) + ")(?![0-9A-Za-z\\x{80}-\\x{10FFFF}])"
    index = spark.createDataFrame(entries, schema)
    lines = (docs.filter(F.col(text).rlike(probe))
             .select(*key, F.posexplode(F.split(text, "\n")).alias("line", "block"))
             .filter(F.col("block").rlike(probe))
             # The block's template tokens, in the order of all (others can't be shared).
             .withColumn("__set", F.array_intersect(F.array(*map(F.lit, every)).cast("array<string>"), lower_words(F.col("block")))))
    more = F.least(F.col("size") - F.col("place"), F.size("__set") - F.col("at")) - 1  # tokens after the shared one
    fetched = (lines.select("*", F.posexplode("__set").alias("at", "token"))
               .join(F.broadcast(index), "token")  # one row per prefix token of the caller's templates
               # A template may be fetched by several prefix tokens: keep its first shared one.
               .filter(F.size(F.array_intersect(F.slice("tokens", F.lit(1), F.col("place")), "__set")) == 0)
               .filter((F.size("__set") >= F.col("need")) & (1 + more >= F.col("need"))))
    overlap = F.size(F.array_intersect("tokens", "__set"))
    return (fetched.withColumn("overlap", overlap).filter(F.col("overlap") >= F.col("need"))
            .select(*key, "line", "block", "label", "overlap", (F.col("overlap") / F.col("size")).alias("containment")))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases: Mapping[str, str] = PHRASES,
         templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: key, n_words, n_base, first_word, last_word, base_labels, labels and score.

    ``labels`` is the base labels and those of fitting templates; ``score`` the
    largest containment of a fitting template, 1 for a phrase, else 0.  Null and
    empty texts give zero words and empty labels.  Rows are told apart by key and
    a 128-bit text hash; copies of one key and text share a result and are all kept.
    """
    row = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).withColumn("__hash", F.md5(F.coalesce("__text", F.lit(""))))
    cols = phrase_columns(F.col("__text"), phrases)
    base = (row.select("__key", "__hash", *[c.alias(n) for n, c in cols.items()])
            .select("__key", "__hash", "n_words", F.when(F.col("__words").isNotNull(), phrase_places("__words", phrases)).alias("p")))
    found = (matching_blocks(row, ["__key", "__hash"], "__text", templates, threshold)
             .groupBy("__key", "__hash").agg(F.collect_set("label").alias("t"), F.max("containment").alias("c"))
             .select(F.col("__key").alias("k"), F.col("__hash").alias("h"), "t", "c"))
    labels = F.coalesce(F.array_distinct(F.transform("p", lambda x: x["label"])), F.array().cast("array<string>"))
    n_base = F.coalesce(F.size("p"), F.lit(0)).cast("long")
    return (base.join(found, F.col("__key").eqNullSafe(F.col("k")) & (F.col("__hash") == F.col("h")), "left")
            .select(F.col("__key").alias(key), "n_words", n_base.alias("n_base"),
                    F.get("p", F.lit(0))["i"].alias("first_word"), F.get("p", F.size("p") - 1)["i"].alias("last_word"),
                    F.array_join(F.array_sort(labels), ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union(labels, F.coalesce("t", F.array().cast("array<string>")))), ",").alias("labels"),
                    F.when(n_base > 0, 1.0).otherwise(F.coalesce("c", F.lit(0.0))).alias("score")))
