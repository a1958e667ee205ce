"""License scan: ordered signature rules over normalised texts, native only.

A trie of all keywords decides which texts are looked at, a rule's own keywords
whether it is tried there. Each match is an interval of words. An interval
inside another of higher priority is suppressed, as is one inside a longer one
of the same priority, or with the same words found by an earlier rule.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqspark.llm.license_rules import RULES, Rule

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Marks around a match; neither can be part of a word.
OPEN, CLOSE = "\x01", "\x02"
#: Fixed phrases and labels of the registered query.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
PHRASE_WEIGHT = 0.5


def normal_words(text: Column) -> Column:
    """Words of ASCII letters, digits and whatever is beyond ASCII, as `` a B c ``.

    Null and wordless texts give one blank. The case stays: few texts need it
    folded, and counting words does not.
    """
    bare = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "))
    return F.when(bare == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), bare, F.lit(" ")))


def small_letters(words: Column) -> Column:
    """A-Z as a-z, nothing else."""
    return F.translate(words, UPPER, LOWER)


def blanks(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def any_of(words: Iterable[str]) -> str:
    """Pattern for any of the strings, as a trie: few branches at each letter."""
    tree: dict = {}
    for word in words:
        node = tree
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        if "" in node:  # a shorter word suffices
            return ""
        parts = [re.escape(char) + pattern(below) for char, below in sorted(node.items())]
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"

    return pattern(tree)


def places(words: Column, regex: Column) -> Column:
    """First and last word (from 0) of each match of ``regex`` in a normalised text."""
    marked = F.regexp_replace(
        words, F.concat(F.lit(" ("), regex, F.lit(")(?= )")), F.lit(f" {OPEN}$1{CLOSE}")
    )
    each = F.split(F.trim(marked), " ")
    at = lambda mark: F.filter(
        F.transform(each, lambda w, i: F.when(F.contains(w, F.lit(mark)), i)), lambda i: i.isNotNull()
    )
    return F.arrays_zip(at(OPEN).alias("first"), at(CLOSE).alias("last"))


def matches(words: Column, rules: Sequence[Rule]) -> Column:
    """Array of (first, last, priority, number, label, weight) before suppression."""
    listed = [{"number": i, **r._asdict()} for i, r in enumerate(rules)]
    schema = "array<struct<number int, label string, priority int, weight double, keywords array<string>, regex string>>"
    table = F.from_json(F.lit(json.dumps(listed)), schema)
    tried = F.filter(
        table, lambda r: F.exists(r.keywords, lambda k: F.contains(words, F.concat(F.lit(" "), k, F.lit(" "))))
    )
    found = F.transform(
        tried,
        lambda r: F.transform(
            places(words, r.regex),
            lambda p: F.struct(
                p["first"].alias("first"), p["last"].alias("last"), r.priority.alias("priority"),
                r.number.alias("number"), r.label.alias("label"), r.weight.alias("weight"),
            ),
        ),
    )
    return F.flatten(found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """id, n_words, words and detections of each row of ``docs``.

    ``detections`` is the sorted array of (first, last, label, number, weight):
    words from 0, number of the rule. ``words`` is the normalised text where a
    keyword occurs, else null. Each row keeps its row, repeated or not; null and
    empty texts have no words and detections. No rows give no rows. Other columns
    are not read.
    """
    every = any_of(dict.fromkeys(f"{k} " for r in rules for k in r.keywords))
    gate = F.col("_words").rlike(f"(?i) {every}")  # folds ASCII letters only
    read = docs.select(F.col(id_col).alias("id"), normal_words(F.col(text_col)).alias("_words"))
    read = read.select(
        "id",
        F.greatest(blanks(F.col("_words")) - 1, F.lit(0).cast("long")).alias("n_words"),
        F.when(gate, small_letters(F.col("_words"))).alias("words"),
    )
    tried = read.withColumn("_match", F.when(F.col("words").isNotNull(), matches(F.col("words"), rules)))
    # Rows are told apart inside this one pass only, so the numbers may depend on partitions.
    rows = tried.withColumn("_row", F.monotonically_increasing_id())
    listed = rows.select("id", "n_words", "words", "_row", F.posexplode_outer("_match").alias("_at", "_m"))
    listed = listed.withColumn("words", F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("words")))
    m = F.col("_m")
    before = (
        Window.partitionBy("_row")
        .orderBy(m["first"].asc(), m["last"].desc(), m["priority"].desc(), m["number"].asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    levels = sorted({r.priority for r in rules})
    reach = {p: F.max(F.when(m["priority"] >= p, m["last"])).over(before) for p in levels}
    covered = reduce(lambda c, p: F.when(m["priority"] == p, reach[p]).otherwise(c), levels, F.lit(None).cast("int"))
    stays = m.isNotNull() & ~F.coalesce(covered >= m["last"], F.lit(False))
    kept = F.struct(*[m[c].alias(c) for c in ("first", "last", "label", "number", "weight")])
    gathered = listed.withColumn("_kept", F.when(stays, kept)).groupBy("_row")
    return gathered.agg(
        F.first("id").alias("id"),
        F.first("n_words").alias("n_words"),
        F.max("words").alias("words"),
        F.sort_array(F.collect_list("_kept")).alias("detections"),
    ).drop("_row")


def phrase_places(words: Column, phrase: str) -> tuple[Column, Column, Column]:
    """Number of places of a phrase, and its smallest and largest start."""
    regex = f" {phrase}(?= )"
    n = F.coalesce(F.regexp_count(words, F.lit(regex)), F.lit(0)).cast("long")
    first = F.when(n > 0, blanks(F.split(words, regex, 2)[0]))
    last = F.when(n > 0, blanks(F.regexp_extract(words, f"(?s)^(.*) {phrase}(?= )", 1)))
    return n, first, last


def op5_license_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    phrases = tuple(Rule(label, 0, PHRASE_WEIGHT, (phrase,), phrase) for phrase, label in PHRASES)
    found = scan(docs, rules=RULES + phrases)
    counted = [phrase_places(F.col("words"), phrase) for phrase, _ in PHRASES]
    base = F.filter(
        F.array(*[F.when(c[0] > 0, F.lit(label)) for c, (_, label) in zip(counted, PHRASES)]), lambda x: x.isNotNull()
    )
    labels = F.array_distinct(F.concat(base, F.col("detections.label")))
    unsure = F.aggregate(F.col("detections.weight"), F.lit(1.0), lambda x, w: x * (1 - w))
    unsure = F.when(F.size(labels) > 0, F.least(unsure, F.lit(1 - PHRASE_WEIGHT))).otherwise(F.lit(1.0))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        (counted[0][0] + counted[1][0] + counted[2][0]).alias("n_base"),
        F.least(*[c[1] for c in counted]).alias("first_word"),
        F.greatest(*[c[2] for c in counted]).alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(labels), ",").alias("labels"),
        (1 - unsure).alias("score"),
    )
