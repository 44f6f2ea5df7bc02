"""Secret scans: fixed patterns, and random strings found by a battery of tests, in expressions only.

A candidate is a long run of key characters.  Its encoding is inferred (hex, base32, base36, base64)
and with it the alphabet.  Three tests ask whether it looks like uniform draws from that alphabet:

* chi-squared: counts of the alphabet's characters,
* runs: how often the sequence crosses the middle of the alphabet,
* serial correlation of neighbouring characters.

Their p-values are combined by Fisher's method into ``p_random``.  A second p-value, ``p_natural``, says
how unlikely the string is as a word or name: too few equal pairs of characters, too many digits, and
too many changes of case for natural text, combined in the same way.

Both are held to a rate, not to a level per string, by Benjamini-Hochberg in strata by length: short
strings are many and say little, so they must not spend the rate of long ones.

* Over the battery, the discoveries are strings that are not random: of those, at most
  ``RANDOM_RATE`` are random strings.  A fixed level would lose its share of all keys, however many.
* Over ``p_natural``, the discoveries are the secrets, among strings that the battery leaves:
  at most ``FALSE_DISCOVERIES`` of them are natural.

The procedure needs only counts of p-values in fixed fine steps per stratum, whatever the number of
candidates; a p-value counts as the upper end of its step, so the rates hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .spans import matches_sql, written

KINDS = ("assign", "access", "hex", "random")
FALSE_DISCOVERIES = 1e-3
RANDOM_RATE = 1e-3

_KEY = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
_SET = rf"{_KEY}[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?"
ASSIGN = rf"{_SET}[A-Za-z0-9+/_.=-]+"
ASSIGN_GUARD = rf"{_SET}[A-Za-z0-9+/_.=-]{{6}}"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}"
CANDIDATE = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"

#: Alphabets by encoding, in the order in which they are tried.
ENCODINGS = {
    "hex": ("^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base36": ("^([0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    "base64": ("^.*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
}
STEP = 1 / 64  # p-values are counted in steps of this many powers of ten
STEPS = 6400
_TINY = 1e-250

# The Chebyshev fit of the complementary error function in Numerical Recipes (erfcc),
# whose relative error is below 1.2e-7 everywhere.
_ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def found_spans(docs: DataFrame) -> DataFrame:
    """Base spans and candidates per row: ``row, doc_id, base, candidates``; written, so rows keep their number."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Group 2 is the value; it ends the match, so its length follows from the part before it.
    value = rf"length(hit) - length(regexp_extract(hit, r'^{_SET}', 0)) >= 6"
    spans = own.select(
        "doc_id",
        F.expr(matches_sql("text", ASSIGN, 0, ASSIGN_GUARD, value)).alias("assign"),
        F.expr(matches_sql("text", ACCESS, 1, ACCESS)).alias("access"),
        F.expr(matches_sql("text", HEX, 2, HEX)).alias("hex"),
        F.expr(matches_sql("text", CANDIDATE, 3, CANDIDATE)).alias("random"),
    )
    plain = "transform(concat(assign, access, hex), x -> struct(x.s as s, x.kind as kind, x.e as e))"
    return stored(
        spans.select(
            F.monotonically_increasing_id().alias("row"), "doc_id",
            F.expr(plain).alias("base"),
            F.expr("filter(random, c -> not exists(concat(assign, access, hex), b -> b.s < c.e and c.s < b.e))").alias("candidates"),
        ),
        "secret-spans",
    )


def _upper_tail(z: str) -> str:
    """Normal probability above z, with a small relative error however far out, never 0."""
    x = f"(abs({z}) / sqrt(2D))"
    t = f"(1 / (1 + {x} / 2))"
    fit = "0D"
    for c in reversed(_ERFC):
        fit = f"({c}D + {t} * {fit})"
    half = f"({t} * exp(-{x} * {x} + {fit}) / 2)"
    return f"greatest(if({z} >= 0, {half}, 1 - {half}), {_TINY}D)"


def _two_sided(z: str) -> str:
    return f"least(1D, 2 * {_upper_tail(f'abs({z})')})"


def _fisher(*p: str) -> str:
    """Combined p-value: chi-squared tail with 2 n degrees of freedom, in closed form."""
    half = "(-(" + " + ".join(f"ln({x})" for x in p) + "))"
    terms = {2: f"1 + {half}", 3: f"1 + {half} + {half} * {half} / 2"}[len(p)]
    return f"least(1D, exp(-{half}) * ({terms}))"


def battery(candidates: DataFrame) -> DataFrame:
    """Add ``encoding, p_random, p_natural`` to rows with the string ``hit``.

    Strings of digits alone are numbers and get no encoding.
    """
    body = "rtrim('=', hit)"
    kind = "case " + f"when {body} rlike '^[0-9]*$' then null " + " ".join(f"when {body} rlike '{p}' then '{n}'" for n, (p, _) in ENCODINGS.items()) + " end"
    letters = "case encoding " + " ".join(f"when '{n}' then '{a}'" for n, (_, a) in ENCODINGS.items()) + " end"
    # Codes follow the alphabet; upper case counts as lower where only one case occurs.
    df = candidates.withColumn("body", F.expr(body)).withColumn("encoding", F.expr(kind)).where("encoding is not null")
    df = df.withColumn("letters", F.expr(letters))
    df = df.withColumn("plain", F.expr("translate(if(encoding in ('hex', 'base36'), lower(body), body), '-_', '+/')"))
    df = df.withColumn("n", F.expr("cast(length(plain) as double)")).withColumn("size", F.expr("cast(length(letters) as double)"))
    df = df.withColumn("codes", F.expr("transform(split(plain, ''), c -> instr(letters, c) - 1)"))
    df = df.withColumn("counts", F.expr("transform(split(letters, ''), c -> cast(length(plain) - length(replace(plain, c, '')) as double))"))
    df = df.withColumn("squares", F.expr("aggregate(counts, 0D, (a, c) -> a + c * c)"))
    # Chi-squared of uniform counts: mean size - 1, variance 2 (size - 1) (n - 1) / n, also when sparse.
    df = df.withColumn("z_chi", F.expr("(size / n * squares - n - (size - 1)) / sqrt(2 * (size - 1) * (n - 1) / n)"))
    df = df.withColumn("high", F.expr("transform(codes, c -> if(2 * c >= size, 1D, 0D))"))
    df = df.withColumn("n1", F.expr("aggregate(high, 0D, (a, x) -> a + x)"))
    df = df.withColumn("runs", F.expr("1 + aggregate(sequence(1, size(high) - 1), 0D, (a, i) -> a + abs(high[i] - high[i - 1]))"))
    df = df.withColumn("runs_mean", F.expr("2 * n1 * (n - n1) / n + 1"))
    df = df.withColumn("runs_var", F.expr("greatest((runs_mean - 1) * (runs_mean - 2) / (n - 1), 1e-9D)"))
    df = df.withColumn("z_runs", F.expr("if(n1 = 0 or n1 = n, sqrt(n), (runs - runs_mean) / sqrt(runs_var))"))
    df = df.withColumn("mean", F.expr("aggregate(codes, 0D, (a, c) -> a + c) / n"))
    df = df.withColumn("var", F.expr("greatest(aggregate(codes, 0D, (a, c) -> a + (c - mean) * (c - mean)), 1e-9D)"))
    df = df.withColumn("serial", F.expr("aggregate(sequence(1, size(codes) - 1), 0D, (a, i) -> a + (codes[i] - mean) * (codes[i - 1] - mean)) / var"))
    df = df.withColumn("z_serial", F.expr("serial * sqrt(n)"))
    df = df.withColumn("p_random", F.expr(_fisher(_upper_tail("z_chi"), _two_sided("z_runs"), _two_sided("z_serial"))))
    # Natural strings: equal pairs as in prose, few digits, few changes to upper case.
    df = df.withColumn("pairs", F.expr("(squares - n) / 2")).withColumn("pairs_mean", F.lit(0.0667) * F.expr("n * (n - 1) / 2"))
    df = df.withColumn("digits", F.expr("cast(length(regexp_replace(body, '[^0-9]', '')) as double)"))
    df = df.withColumn("humps", F.expr("cast(size(regexp_extract_all(body, '[a-z0-9][A-Z]', 0)) as double)"))
    df = df.withColumn("z_pairs", F.expr("(pairs_mean - pairs) / sqrt(2 * pairs_mean)"))
    df = df.withColumn("z_digits", F.expr("(digits - 0.05D * n) / sqrt(0.05D * n)"))
    df = df.withColumn("z_humps", F.expr("(humps - 0.08D * n) / sqrt(0.08D * n)"))
    return df.withColumn("p_natural", F.expr(_fisher(*[_upper_tail(z) for z in ("z_pairs", "z_digits", "z_humps")])))


def _step(p: str) -> F.Column:
    return F.least(F.lit(STEPS), F.greatest(F.lit(0), F.floor(-F.log10(p) / STEP))).cast("int")


def _limits(cells: DataFrame, step: str, count: str, of: str, rate: float, name: str) -> DataFrame:
    """The first step of every stratum that Benjamini-Hochberg rejects, if any.

    ``count`` of the p-values in a step may be rejected, ``of`` of them are tested.
    """
    per = cells.groupBy("stratum", step).agg(F.sum(count).alias("k"), F.sum(of).alias("rows"))
    smaller = Window.partitionBy("stratum").orderBy(F.col(step).desc())  # at most STEPS rows each
    ranked = per.withColumn("rank", F.sum("k").over(smaller)).withColumn("m", F.sum("rows").over(Window.partitionBy("stratum")))
    # All strings of a step have p-values up to 10 ** (-step * STEP).
    passing = ranked.where((F.col("rank") > 0) & (F.pow(F.lit(10.0), -F.col(step) * STEP) * F.col("m") <= rate * F.col("rank")))
    return passing.groupBy("stratum").agg(F.min(step).alias(name))


def discoveries(tested: DataFrame, rate: float = FALSE_DISCOVERIES, random_rate: float = RANDOM_RATE) -> DataFrame:
    """Rows of ``battery`` that are secrets: Benjamini-Hochberg per stratum of length, twice.

    First over ``p_random``; what it rejects is not random.  Then over ``p_natural``, where only the
    rest may be discovered, but all strings of the stratum are tested.
    """
    graded = tested.withColumn("stratum", F.floor(F.log2("n")).cast("int"))
    graded = graded.withColumn("order_step", _step("p_random")).withColumn("step", _step("p_natural"))
    cells = graded.groupBy("stratum", "order_step", "step").agg(F.count(F.lit(1)).alias("rows"))
    ordered = _limits(cells, "order_step", "rows", "rows", random_rate, "order_limit")
    random = F.coalesce(F.col("order_step") < F.col("order_limit"), F.lit(True))
    cells = cells.join(ordered, "stratum", "left").withColumn("random", F.when(random, F.col("rows")).otherwise(0))
    natural = _limits(cells, "step", "random", "rows", rate, "limit")
    limits = natural.join(ordered, "stratum", "left")
    return graded.join(limits, "stratum").where((F.col("step") >= F.col("limit")) & random)


def scan(docs: DataFrame) -> DataFrame:
    """Secrets per row: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    Counts and ``base_sha256`` cover the fixed patterns; ``spans`` adds random strings, which never
    overlap them.  Offsets are code points.  Null and empty texts have no spans; repeated rows and
    equal or null ids are kept apart; other columns are ignored; an empty table gives no rows.
    """
    found = found_spans(docs)
    candidates = found.select("row", F.explode("candidates").alias("c")).select("row", "c.s", "c.kind", "c.e", "c.hit")
    tested = stored(battery(candidates).select("row", "s", "kind", "e", "n", "p_random", "p_natural"), "secret-tests")
    more = discoveries(tested).groupBy("row").agg(F.collect_list(F.struct("s", "kind", "e")).alias("more"))
    joined = found.select("row", "doc_id", "base").join(more, "row", "left")
    joined = joined.withColumn("every", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more")))

    def n(kind: int) -> F.Column:
        return F.expr(f"cast(size(filter(base, x -> x.kind = {kind})) as bigint)")

    return joined.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(written("base", KINDS).cast("binary"), 256).alias("base_sha256"),
        written("every", KINDS).alias("spans"),
    )
