"""Spans in texts: match positions by expressions, and how spans are written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def matches_sql(text: str, pattern: str, kind: int, guard: str, value: str = "length(hit) > 0") -> str:
    """SQL: leftmost non-overlapping matches of a pattern as array of ``(s, kind, e, hit)``.

    ``guard`` is a cheap pattern that holds wherever a match counts; other texts are not cut.
    ``value`` is a condition on ``hit`` that drops matches after they are found.  The text is cut
    into gap, match, gap, match, each cut starting where the last one ended, and the lengths in
    code points are added up.  Patterns write a quote as ``\\x27``.
    """
    cut = rf"(?s)\G(.*?)({pattern})"
    empty = "cast(array() as array<struct<s:bigint,kind:int,e:bigint,hit:string>>)"
    return f"""
    case when {text} rlike r'{guard}' then
      filter(aggregate(
        zip_with(regexp_extract_all({text}, r'{cut}', 1), regexp_extract_all({text}, r'{cut}', 2), (g, h) -> struct(g as gap, h as hit)),
        struct(0L as at, {empty} as found),
        (acc, x) -> struct(
          acc.at + length(x.gap) + length(x.hit) as at,
          concat(acc.found, array(struct(acc.at + length(x.gap) as s, {kind} as kind, acc.at + length(x.gap) + length(x.hit) as e, x.hit as hit))) as found),
        acc -> acc.found
      ), m -> {value.replace("hit", "m.hit")})
    else {empty} end"""


def written(spans: str, names: tuple[str, ...]) -> Column:
    """Spans as ``kind:start:end``, by start, then kind, comma-joined."""
    labels = "array(" + ", ".join(f"'{n}'" for n in names) + ")"
    return F.expr(
        f"array_join(transform(sort_array(transform({spans}, x -> struct(x.s as s, x.kind as kind, x.e as e))), "
        f"x -> concat({labels}[x.kind], ':', x.s, ':', x.e)), ',')"
    )
