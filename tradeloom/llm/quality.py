"""Quality rules as a short-circuit cascade.

A rule is a reason to reject a text, written as a SQL condition over features of the text.  A text is
cut into words and lines once.  The cascade is one ``CASE``: the first rule that holds rejects and the
features of later rules are not computed.  The order comes from a sample: each rule is timed on it, and rules are taken greedily by
newly rejected texts per second.  The order changes the work, never the verdict.
"""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD

SAMPLE_ROWS = 1000  # texts on which rules are timed

_BLANKS = r" \t\n\u000B\u000C\r"
_WORDS = f"regexp_extract_all(text, r'{WORD}', 0)"
_LINES = r"filter(split(text, '\n'), line -> line rlike r'[^\x20\x09-\x0D]')"

# Words covered by a 3-word window that the text holds twice or more.  Windows are compared by
# 64-bit hashes; equal ones stand together once sorted by (hash, position).
_REPEATED = """
case when size({words}) < 4 then 0L else
  element_at(transform(array(transform(sequence(0, size({words}) - 3), i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2]))), hashes ->
    case when size(array_distinct(hashes)) = size(hashes) then 0L else
      element_at(transform(array(sort_array(transform(hashes, (h, i) -> struct(h as h, i as i)))), s ->
        element_at(transform(array(sort_array(transform(filter(
            transform(s, (x, i) -> struct(x.i as i, (i > 0 and s[greatest(i - 1, 0)].h = x.h) or (i < size(s) - 1 and s[least(i + 1, size(s) - 1)].h = x.h) as twice)),
            x -> x.twice), x -> x.i))), p ->
          aggregate(transform(p, (at, i) -> if(i = size(p) - 1, 3L, cast(least(3, p[least(i + 1, size(p) - 1)] - at) as bigint))), 0L, (a, b) -> a + b)), 1)), 1)
    end), 1)
end
"""

#: Features by name, as SQL over the columns of ``cut``.
FEATURES = {
    "n_words": "cast(size(words) as bigint)",
    "word_chars": f"cast(length(translate(text, '{_BLANKS}', '')) as bigint)",
    "n_symbols": "cast(length(text) - length(translate(text, '#*$%&|<>', '')) as bigint)",
    "n_lines": "cast(size(lines) as bigint)",
    "n_dup_lines": "cast(size(lines) - size(array_distinct(lines)) as bigint)",
    "n_repeat_words": _REPEATED.format(words="words"),
    "n_upper": r"cast(length(text) - length(regexp_replace(text, r'\p{Lu}+', '')) as bigint)",
}


def _plain(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.struct("*").alias("doc"), text.alias("text"))


def cut(docs: DataFrame) -> DataFrame:
    """The rows as one column ``doc``, with ``text``, its ``words`` and its ``lines`` that hold a word."""
    return _plain(docs).select("doc", "text", F.expr(_WORDS).alias("words"), F.expr(_LINES).alias("lines"))


@dataclass(frozen=True)
class Rule:
    """Rejects a text when ``reject`` holds; names of features stand in braces."""

    name: str
    reject: str

    def sql(self, features: dict[str, str]) -> str:
        return self.reject.format(**{k: f"({v})" for k, v in features.items()})


BASE = (
    Rule("few_words", "{n_words} < 50"),
    Rule("repeated_words", "100 * {n_repeat_words} > 50 * {n_words}"),
)
MORE = (
    Rule("symbols", "10 * {n_symbols} > {n_words}"),
    Rule("repeated_lines", "100 * {n_dup_lines} > 50 * {n_lines}"),
    Rule("word_length", "{word_chars} < 2 * {n_words} or {word_chars} > 20 * {n_words}"),
    Rule("capitals", "100 * {n_upper} > 50 * {word_chars}"),
)
RULES = BASE + MORE

#: Features that the base rules name.
BASE_FEATURES = ("n_words", "n_repeat_words")


def cascade_sql(rules: Sequence[Rule], features: dict[str, str]) -> str:
    """SQL: name of the first rule that rejects a text, null if none does."""
    whens = " ".join(f"when {r.sql(features)} then '{r.name}'" for r in rules)
    return f"case {whens} end" if rules else "cast(null as string)"


def cascade(rules: Sequence[Rule], features: dict[str, str]) -> Column:
    """Name of the first rule that rejects a text, null if none does."""
    return F.expr(cascade_sql(rules, features))


def order_rules(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    sample_rows: int = SAMPLE_ROWS,
    after: Sequence[Rule] = (),
    known: Sequence[str] = (),
) -> list[Rule]:
    """Order rules by newly rejected texts per second of work, measured on a bounded sample.

    The sample is spread by a hash of the text over the first files.  Rules without a rejection in
    it come last, cheapest first.  ``after`` are rules applied before these: what they reject counts
    for nothing.  ``known`` are features computed before these rules, so they cost nothing.  With no
    text left the given order stays.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"))
    rows = texts.where("text is not null and pmod(xxhash64(text), 8) = 0").take(sample_rows) or texts.take(sample_rows)
    if not rows:
        return list(rules)
    sample = cut(spark.createDataFrame([(r.text,) for r in rows], "text string").coalesce(1))
    if after or known:
        # The verdict is a column, not a filter: a filter would cut the text again wherever it names the pieces.
        judged = sample.select(cascade(after, FEATURES).alias("rejected"), "text", *[F.expr(FEATURES[k]).alias(k) for k in known])
        rows = [r[1:] for r in judged.collect() if r.rejected is None]
        if not rows:
            return list(rules)
        schema = ", ".join(["text string", *[f"{k} long" for k in known]])
        sample = cut(spark.createDataFrame(rows, schema).coalesce(1)).select("text", "words", "lines", *[f"doc.{k}" for k in known])

    def seconds(condition: str) -> float:
        started = time.perf_counter()
        sample.agg(F.count_if(F.expr(condition))).collect()
        return time.perf_counter() - started

    conditions = [r.sql(FEATURES | {k: k for k in known}) for r in rules]
    floor = min(seconds("size(words) + size(lines) < 0") for _ in range(2))
    costs = [max(min(seconds(c) for _ in range(2)) - floor, 1e-4) for c in conditions]
    held = sample.select(*[F.coalesce(F.expr(c), F.lit(False)).alias(f"r{i}") for i, c in enumerate(conditions)])
    names = held.columns
    patterns = held.groupBy(*names).count().collect()  # at most 2 ** rules rows
    open_rules, ordered = list(range(len(rules))), []
    while open_rules:
        left = [p for p in patterns if not any(p[f"r{i}"] for i in ordered)]
        gain = {i: sum(p["count"] for p in left if p[f"r{i}"]) / costs[i] for i in open_rules}
        best = min(open_rules, key=lambda i: (-gain[i], costs[i], i))
        open_rules.remove(best)
        ordered.append(best)
    return [rules[i] for i in ordered]


def judge(docs: DataFrame, rules: Sequence[Rule] = MORE, features: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """Features and verdict per row: ``doc_id``, ``features``, ``base_failed``, ``kept``.

    ``features`` are computed for every row, as columns; by default all.  ``rules`` run behind the base
    verdict as a cascade in measured order, and a feature that is no column is computed only for
    texts that reach a rule naming it.  Null and empty texts have zero features and fail the base
    rules.  Texts of any length are read whole.  Repeated rows are judged one by one; other columns
    are ignored; an empty table gives no rows.
    """
    known = list(dict.fromkeys([*BASE_FEATURES, *features]))
    ordered = order_rules(docs, rules, after=BASE, known=known)
    computed = [F.expr(FEATURES[name]).alias(name) for name in known]
    found = cut(docs).select(F.col("doc.doc_id").alias("doc_id"), "text", "words", "lines", *computed)
    columns = FEATURES | {k: k for k in known}
    failed = F.expr(" or ".join(f"({r.sql(columns)})" for r in BASE))
    # AND and CASE stop early: behind the base verdict, and at the first rule that holds.
    kept = ~failed & cascade(ordered, columns).isNull()
    return found.select("doc_id", *features, failed.alias("base_failed"), kept.alias("kept"))


def keep(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows that no rule rejects, with all their columns.  Null and empty texts are rejected."""
    ordered = order_rules(docs, rules)
    # One condition: Spark evaluates the branches of a CASE in order and stops at the first.
    # The pieces are bound to a variable.  As columns they would be put into the filter again for
    # every place that names them, and computed there.
    bound = re.sub(r"\b(words|lines)\b", r"pieces.\1", cascade_sql(ordered, FEATURES))
    pieces = f"array(named_struct('words', {_WORDS}, 'lines', {_LINES}))"
    rejected = F.expr(f"element_at(transform({pieces}, pieces -> {bound}), 1)")
    return _plain(docs).where(rejected.isNull()).select("doc.*")
