"""Secrets: fixed patterns, and tokens that a battery of randomness tests can't tell from
random; DataFrame operations only.

Base kinds (leftmost, non-overlapping per kind): ``assign`` (a name such as password, a
separator and a value of 12 characters or more), ``access`` (AKIA and capitals or digits,
18 or more) and ``hex`` (16 or more of 0-9a-f). The battery adds kind ``random``.

Battery. A token is a run of 20 or more of A-Z a-z 0-9 + / or of A-Z a-z 0-9 _ - (and = at
its end). As a key may stand behind or before words of a path, the parts between the marks
+ / _ - are tokens as well: from the begin of each part, and back from the end of each, the
shortest sequence of parts with 20 characters that no mark of the other class splits. A
token that holds no letter or is all 0-9a-f (a base kind) is not tested. Its encoding is
inferred from the characters it uses: letters of either or both cases, hexadecimal capitals,
base 32, base 36 of either case, base 62 or base 64. The letters of one case are ordered
with vowels and rare letters first, so that words alternate between halves.
Under the hypothesis that each character is drawn uniformly from that alphabet, three
tests give p-values: chi-squared of the character counts (upper tail, normal with the exact
moments, as counts are small), Wald-Wolfowitz runs of characters above and below the
middle of the alphabet, and lag-one serial correlation of the character values (both two-
sided). Fisher's rule combines them (six degrees of freedom).

Discovery control. Rejecting the hypothesis says "not random". In each stratum of token
length (its power of two; tokens of letters alone apart) the Benjamini-Hochberg step-up at rate ``rate`` rejects; strata
are controlled apart because long tokens are told from random far more surely than short
ones and would otherwise set the threshold for them. What is not rejected is a secret;
secrets that overlap are one span. The step-up reads a histogram of p (steps of 1/32 in -ln p), some hundred rows per stratum at
most, made by a grouped count over all tokens of all documents.

Positions are code points, end exclusive: Java's split and match lists alternate, so a
running sum of their lengths within a document gives each match its place.

Defined results: a null text counts as empty; a document without spans has counts 0, empty
``spans`` and the digest of the empty string. Repeated rows each give a row. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickcredit.llm.shared import id_and_text, written

# The base patterns and the least lengths of what they must match.
ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # what is left of the runs [0-9a-f]+ after dropping shorter ones
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "random")
RANDOM = KINDS.index("random")


def _run(marks: str) -> str:
    return f"[A-Za-z0-9{marks}]{{20,}}={{0,2}}"


def _parts(marks: str) -> str:
    """Group 1: the shortest sequence of parts from here that is long enough and is no whole
    run. Only its first character is consumed, so that the next may overlap it."""
    return (f"(?<![A-Za-z0-9])(?=([A-Za-z0-9][A-Za-z0-9{marks}]{{18,}}?[A-Za-z0-9])(?![A-Za-z0-9]))"
            f"(?:(?<=[{marks}])|(?=\\1[{marks}]))[A-Za-z0-9]")


ALPHABETS = {
    "LETTERS": "AEIOUYQJXZWVKBCDFGHLMNPRST",
    "letters": "aeiouyqjxzwvkbcdfghlmnprst",
    "Letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
LETTERS = 64  # added to the stratum of tokens of letters alone
STEPS = 32  # histogram steps per unit of -ln p
MAX_LOG = 40.0


def _found(text: Column, source: int, kind: int, pattern: str, group: int = 0, least: int = 0,
           holds: str = "", part: bool = False, back: bool = False) -> Column:
    """Array of (source, kind, gap, size, ahead, ok, body) of all matches: ``gap`` characters
    lie between the last match and this one, and its span has ``ahead`` characters, for a
    ``part`` those of the group. ``back`` is for a reversed text."""
    gaps, whole = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value"))
    rows = F.transform(pieces, lambda x: F.struct(
        F.lit(source).alias("source"), F.lit(kind).alias("kind"), F.length(x["gap"]).alias("gap"),
        F.length(x["whole"]).alias("size"), F.length(x["value"] if part else x["whole"]).alias("ahead"),
        ((F.length(x["value"]) >= least) & x["value"].rlike(holds)).alias("ok"),
        ((F.reverse(x["value"]) if back else x["value"]) if kind == RANDOM
         else F.lit(None).cast("string")).alias("body")))
    # Most texts have no match: test before the four passes that positions need.
    return F.when(text.rlike(pattern), rows).otherwise(F.array().cast(
        "array<struct<source:int,kind:int,gap:int,size:int,ahead:int,ok:boolean,body:string>>"))


BACK = 7  # the first source that reads the reversed text


def _all_found(text: Column) -> Column:
    """Every token once: what holds no mark is of the class + /."""
    back = F.reverse(text)
    return F.concat(
        _found(text, 0, 0, ASSIGN, 2, ASSIGN_LEAST), _found(text, 1, 1, ACCESS, 0, ACCESS_LEAST),
        _found(text, 2, 2, HEX),
        _found(text, 3, RANDOM, _run("+/")), _found(text, 4, RANDOM, _run("_-"), holds="[_-]"),
        _found(text, 5, RANDOM, _parts("+/"), 1, part=True),
        _found(text, 6, RANDOM, _parts("_-"), 1, holds="[_-]", part=True),
        _found(back, BACK, RANDOM, _parts("+/"), 1, part=True, back=True),
        _found(back, BACK + 1, RANDOM, _parts("_-"), 1, holds="[_-]", part=True, back=True))


def _two_sided(z: Column) -> Column:
    """Two-sided tail of the normal distribution (rational approximation, error < 2e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(poly * F.exp(-x * x), F.lit(1e-300))


def _with_tests(tokens: DataFrame) -> DataFrame:
    """Adds the combined p of each token ``body``; null if it is no candidate."""
    body = F.regexp_replace("body", "=+$", "")
    plain = (F.col("kind") == RANDOM) & F.col("ok") & F.col("body").rlike("[A-Za-z]") & \
        ~F.col("body").rlike("^[0-9a-f]+$")
    encoding = (F.when(~plain, F.lit(None)).when(body.rlike("^[A-Z]+$"), "LETTERS")
                .when(body.rlike("^[a-z]+$"), "letters").when(body.rlike("^[A-Za-z]+$"), "Letters")
                .when(body.rlike("^[0-9A-F]+$"), "HEX")
                .when(body.rlike("^[A-Z2-7]+$"), "base32").when(body.rlike("^[A-Z0-9]+$"), "BASE36")
                .when(body.rlike("^[a-z0-9]+$"), "base36")
                .when(body.rlike("^[A-Za-z0-9]+$"), "base62").when(body.rlike("^[A-Za-z0-9+/]+$"), "base64")
                .when(body.rlike("^[A-Za-z0-9_-]+$"), "base64url"))
    alphabet = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])[F.col("encoding")]
    rows = (tokens.withColumn("encoding", encoding)
            .withColumn("alphabet", alphabet)
            .withColumn("chars", F.when(F.col("encoding").isNotNull(), F.split(body, "")))
            .withColumn("values", F.transform("chars", lambda c: F.instr(F.col("alphabet"), c).cast("double") - 1)))
    n, k = F.size("chars").cast("double"), F.length("alphabet").cast("double")
    square = F.aggregate(F.transform(F.array_distinct("chars"), lambda c: F.pow(
        F.size(F.filter("chars", lambda x: x == c)).cast("double"), 2.0)), F.lit(0.0), lambda t, x: t + x)
    chi = (square * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    uneven = F.when(chi > 0, _two_sided(chi) / 2).otherwise(1 - _two_sided(chi) / 2)

    above = F.transform("values", lambda v: (v >= k / 2).cast("int"))
    changes = F.aggregate(F.zip_with(F.slice("above", 2, F.size("above")), F.slice("above", 1, F.size("above") - 1),
                                     lambda a, b: (a != b).cast("int")), F.lit(0), lambda t, x: t + x)
    high = F.aggregate("above", F.lit(0), lambda t, x: t + x).cast("double")
    mean_runs = 2 * high * (n - high) / n + 1
    var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    runs = F.when(var_runs > 0, _two_sided((changes + 1 - mean_runs) / F.sqrt(var_runs))).otherwise(F.lit(1e-300))

    mean = F.aggregate("values", F.lit(0.0), lambda t, x: t + x) / n
    centred = F.transform("values", lambda v: v - F.col("mean"))
    power = F.aggregate("centred", F.lit(0.0), lambda t, x: t + x * x)
    product = F.aggregate(F.zip_with(F.slice("centred", 2, F.size("centred")),
                                     F.slice("centred", 1, F.size("centred") - 1), lambda a, b: a * b),
                          F.lit(0.0), lambda t, x: t + x)
    serial = F.when(power > 0, _two_sided((product / power + 1 / n) * F.sqrt(n))).otherwise(F.lit(1e-300))

    rows = (rows.withColumn("above", above).withColumn("mean", mean).withColumn("centred", centred)
            .withColumn("half", -(F.log(uneven) + F.log(runs) + F.log(serial))))
    half = F.col("half")
    # Fisher: -2 sum ln p is chi-squared with six degrees of freedom.
    log_p = half - F.log1p(half + half * half / 2)
    return (rows.withColumn("step", F.floor(F.least(F.greatest(log_p, F.lit(0.0)), F.lit(MAX_LOG)) * STEPS))
            .withColumn("stratum", F.when(F.col("encoding").isNotNull(), F.floor(F.log2(n)) + F.when(
                F.lower("encoding") == "letters", LETTERS).otherwise(0)))
            .drop("alphabet", "chars", "values", "above", "mean", "centred", "half", "body"))


def _least_rejected(tokens: DataFrame, rate: float) -> DataFrame:
    """(stratum, cut): the step from which tokens are rejected as not random."""
    counts = (tokens.where("stratum IS NOT NULL").groupBy("stratum", "step")
              .agg(F.count(F.lit(1)).alias("n")))
    by_step = Window.partitionBy("stratum").orderBy(F.desc("step"))
    all_steps = Window.partitionBy("stratum")
    ranked = counts.withColumn("i", F.sum("n").over(by_step)).withColumn("m", F.sum("n").over(all_steps))
    # The largest p of a step is exp(-step / STEPS).
    return (ranked.where(F.exp(-F.col("step") / STEPS) <= F.col("i") / F.col("m") * rate)
            .groupBy(F.col("stratum").alias("cut_stratum")).agg(F.min("step").alias("cut")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.05) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random of each row."""
    texts = id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    matches = texts.select("row", "doc_id", F.length("text").alias("n"), _all_found(F.col("text")).alias("found")).select(
        "row", "doc_id", "n", F.posexplode_outer("found").alias("at", "x")).select("row", "doc_id", "n", "at", "x.*")
    before = Window.partitionBy("row", "source").orderBy("at")
    back = F.col("source") >= BACK
    # Tested before the shuffle, so token texts stay behind.
    placed = (_with_tests(matches).withColumn("from", F.sum(F.col("gap") + F.col("size")).over(before) - F.col("size"))
              .withColumn("start", F.when(back, F.col("n") - F.col("from") - F.col("ahead")).otherwise(F.col("from")))
              .withColumn("end", F.col("start") + F.col("ahead")))
    # A sequence of parts found from both its ends is one token.
    same = Window.partitionBy("row", "kind", "start", "end").orderBy(F.desc("ok"), "source")
    placed = written(placed.withColumn("turn", F.row_number().over(same)).select(
        "row", "doc_id", "kind", "start", "end", "ok", "step",
        F.when(F.col("turn") == 1, F.col("stratum")).alias("stratum")), "spans")
    # At most one row per power of two of a token's length, for letters apart: below 128 rows.
    cuts = F.broadcast(_least_rejected(placed, rate))
    judged = placed.join(cuts, F.col("stratum") == F.col("cut_stratum"), "left").withColumn(
        "is_span", F.coalesce(F.when(F.col("kind") == RANDOM, F.col("stratum").isNotNull() & (
            F.col("cut").isNull() | (F.col("step") < F.col("cut")))).otherwise(F.col("ok")), F.lit(False)))
    # Random spans that overlap are one: a span begins where all before it have ended.
    in_order = Window.partitionBy("row", "kind", "is_span").orderBy("start", "end")
    first = F.coalesce(F.col("start") >= F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    judged = (judged.withColumn("first", ~F.col("is_span") | (F.col("kind") != RANDOM) | first)
              .withColumn("island", F.sum(F.col("first").cast("int")).over(in_order.rowsBetween(
                  Window.unboundedPreceding, 0)))
              .groupBy("row", "kind", "is_span", "island").agg(
                  F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end")))
    span = F.when(F.col("is_span"), F.struct("start", "kind", "end"))

    def joined(spans: Column) -> Column:
        names = F.array(*[F.lit(x) for x in KINDS])
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    count = lambda k: F.coalesce(F.sum((F.col("is_span") & (F.col("kind") == k)).cast("long")), F.lit(0))
    by_row = judged.groupBy("row").agg(  # within a document
        F.first("doc_id").alias("doc_id"), *[count(k).alias(f"n_{x}") for k, x in enumerate(KINDS)],
        F.array_sort(F.collect_list(span)).alias("all"))
    base = F.filter("all", lambda s: s["kind"] != RANDOM)
    return by_row.select("doc_id", "n_assign", "n_access", "n_hex",
                         F.sha2(joined(base), 256).alias("base_sha256"),
                         joined(F.col("all")).alias("spans"), "n_random")
