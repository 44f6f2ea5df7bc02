"""Document fingerprints by winnowing, in DataFrame expressions only.

A word of up to eight code points is a token; a longer one gives a token of eight code points at each
of its places, so tokens slide by one code point inside runs without blanks.  K-grams are runs of four
tokens, hashed.  In every window of twelve consecutive k-grams the smallest hash is kept, the rightmost
of equal ones, with its position.  So two texts that share a passage of ``K + WINDOW - 1`` whole tokens
share a kept hash, at whatever place of a run it begins: that is fifteen words of up to eight code
points, or 22 code points inside a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 4
WINDOW = 12
_C = r"[^\x20\x09-\x0D]"
# One group: eight code points from here, or a whole shorter word.  What is left of a word that has no
# further place of eight is passed over.
TOKEN = rf"(?=({_C}{{8}}|(?<!{_C}){_C}{{1,7}}(?!{_C}))){_C}(?:{_C}{{0,7}}(?!{_C}))?"

BUCKET_ROWS = 128  # documents per bucket of neighbouring ids
MAX_BUCKETS = 1 << 14  # bound of the ids that the driver and the plan hold

# A k-gram's hash without its low bits, and its position counted down there: the smallest value of a
# window is the smallest hash, rightmost first.  Positions wrap after 16 million k-grams, which
# can only change which one of equal hashes is kept.
_PLACE = (1 << 24) - 1


def _minima(name: str, window: int) -> str:
    """SQL: smallest value of every window of an array, by windows of doubled length."""
    expression, span = name, 1
    while span < window:
        step = min(span, window - span)
        expression = (
            f"element_at(transform(array({expression}), a{span} -> transform(sequence(0, size(a{span}) - 1 - {step}), "
            f"i -> least(a{span}[i], a{span}[i + {step}]))), 1)"
        )
        span += step
    return expression


def with_fingerprint(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Add ``<prefix>kept`` (distinct kept hashes) and ``<prefix>print`` (``position:hash`` of each kept k-gram).

    Null counts as empty.  A text without words keeps nothing; one of fewer than ``K`` tokens is one
    k-gram.
    """
    t, h, v, c = (f"{prefix}_{x}" for x in ("tokens", "hashes", "values", "chosen"))
    df = df.withColumn(t, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), F.lit(1)))
    gram = ", ".join(f"{t}[i + {j}]" if j else f"{t}[i]" for j in range(K))
    df = df.withColumn(
        h,
        F.expr(
            f"case when size({t}) = 0 then array() when size({t}) < {K} then array(xxhash64(array_join({t}, ' '))) "
            f"else transform(sequence(0, size({t}) - {K}), i -> xxhash64({gram})) end"
        ).cast("array<bigint>"),
    )
    df = df.withColumn(v, F.expr(f"transform({h}, (x, i) -> (x & {~_PLACE}L) | ({_PLACE}L - (i & {_PLACE}L)))"))
    df = df.withColumn(c, F.expr(f"array_distinct(case when size({v}) = 0 then {v} when size({v}) <= {WINDOW} then array(array_min({v})) else {_minima(v, WINDOW)} end)"))
    # Positions beyond 16 million k-grams are found by counting wraps back from the hash array.
    at = f"cast({_PLACE}L - (x & {_PLACE}L) as int)"
    if_long = f"case when size({h}) <= {_PLACE} then {at} else cast(array_position({v}, x) - 1 as int) end"
    df = df.withColumn(c, F.expr(f"transform({c}, x -> {if_long})"))
    df = df.withColumn(f"{prefix}kept", F.expr(f"array_distinct(transform({c}, p -> {h}[p]))"))
    df = df.withColumn(f"{prefix}print", F.expr(f"array_join(transform({c}, p -> concat(cast(p as string), ':', lower(hex({h}[p])))), ',')"))
    return df.drop(t, h, v, c)


def likeness(a: str, b: str) -> Column:
    """Share of kept hashes that two fingerprints have in common; two empty ones are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def with_next(docs: DataFrame) -> DataFrame:
    """Text of the next document in descending ``doc_id`` order, after the last that of the first.

    Returns ``doc_id, text, next_text`` and the bucket; null ids come last, rows with one id are
    ordered by text.  Documents are dealt to buckets of neighbouring ids; the first one of a bucket
    is also sent to the bucket before it, so the order never meets in one task.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = own.count()
    buckets = max(1, min(MAX_BUCKETS, n // BUCKET_ROWS))
    bounds: list[int] = []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        found = own.agg(F.percentile_approx("doc_id", shares, 20 * buckets)).first()[0]
        bounds = sorted(set(found or []))
    # Bucket: how many bounds are not above the id, by bisection; -1 for null ids.
    steps = max(1, len(bounds)).bit_length()
    if bounds:
        literal = f"array({', '.join(f'cast({b} as bigint)' for b in bounds)})"
        search = (
            f"aggregate(sequence({steps - 1}, 0, -1), 0, (low, s) -> low + if(low + shiftleft(1, s) <= {len(bounds)} "
            f"and {literal}[least(low + shiftleft(1, s), {len(bounds)}) - 1] <= doc_id, shiftleft(1, s), 0))"
        )
        bucket = F.expr(f"if(doc_id is null, -1, {search})")
    else:
        bucket = F.expr("if(doc_id is null, -1, 0)")
    dealt = own.withColumn("bucket", bucket)
    # One row per bucket; the order of buckets is the order of documents.
    first = sorted(((r.bucket, r.first) for r in dealt.select("bucket", "doc_id").groupBy("bucket").agg(F.max("doc_id").alias("first")).collect()), reverse=True)
    before = {b: first[i - 1][0] for i, (b, _) in enumerate(first)}
    size = max([b for b, _ in first], default=0) + 2
    firsts, homes = ["cast(null as bigint)"] * size, ["cast(null as int)"] * size
    for b, i in first:
        firsts[b + 1], homes[b + 1] = f"cast({'null' if i is None else i} as bigint)", str(before[b])
    guest = (
        f"if(doc_id <=> array({', '.join(firsts)})[bucket + 1], array(struct(bucket as b, 0 as guest), "
        f"struct(array({', '.join(homes)})[bucket + 1] as b, 1 as guest)), array(struct(bucket as b, 0 as guest)))"
    )
    sent = dealt.select("doc_id", "text", F.explode(F.expr(guest)).alias("to")).select("doc_id", "text", F.col("to.b").alias("bucket"), "to.guest")
    return sent


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness.

    Columns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.  The edited text is the text with its last half replaced by the beginning of the
    next document (see ``with_next``).  Null texts count as empty; a lone document follows itself.
    Other columns are ignored; an empty table gives no rows.
    """
    sent = with_next(docs).repartition("bucket")
    known = with_fingerprint(sent, "text", "own_")
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    paired = known.select(
        "doc_id", "text", "guest", "own_kept", "own_print",
        F.lead("text").over(order).alias("next_text"),
        F.lead("own_kept").over(order).alias("next_kept"),
    ).where("guest = 0")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    changed = paired.select("doc_id", F.length("text").cast("long").alias("n_chars"), "own_kept", "own_print", "next_kept", edited.alias("edited"))
    both = with_fingerprint(changed, "edited", "edited_")
    return both.select(
        "doc_id", "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("own_print").alias("fingerprint"),
        F.col("edited_print").alias("edited_fingerprint"),
        likeness("own_kept", "edited_kept").alias("near_edited"),
        likeness("own_kept", "next_kept").alias("near_next"),
    )
