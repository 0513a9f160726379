"""Secret scan: fixed formats, and random-looking tokens found by statistical tests.

Tokens that could be keys (letters and digits, long enough) get an inferred
encoding. Three tests against a uniformly random string of that alphabet give
two-sided p-values: chi-squared uniformity of the characters, the number of
runs above and below the middle of the alphabet, and lag-one serial
correlation. A Benjamini-Hochberg cut per (encoding, length class) rejects
randomness for ordinary tokens; what it does not reject is reported. Short
tokens, on which the tests have no power, are not tested.

DataFrame functions only. The cut is taken from p-value histograms (at most
``P_BINS`` rows for each encoding and length class), so it is the same however
many tokens there are, and no task sees them all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm.common import SPANS, joined, let, of_kind, outside, spans_of, table

ASSIGN = (r"""(?:(?i)password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""")
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+"

#: encoding -> (pattern, alphabet), the first that fits holds.
ENCODINGS = {
    "hex": ("^[0-9a-f]+$", "0123456789abcdef"),
    "HEX": ("^[0-9A-F]+$", "0123456789ABCDEF"),
    "base32": ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base36": ("^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    "base64": ("^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    "base64url": ("^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
}

#: Least information of a tested token, in bits, and the false-discovery rate of the cut.
MIN_BITS, FDR = 80, 0.05
#: Bins of -log10 p, ten to a power of ten; the last holds all smaller p.
P_BINS = 300


def base_spans(text: Column) -> Column:
    """Spans of the fixed formats by start, then kind: assign, access, hex."""
    # one cheap scan each keeps the offset work to texts that can match
    kinds = [
        spans_of(text, ASSIGN, "assign", lambda g: F.length(g) >= 12, group=1),
        spans_of(text, ACCESS, "access", lambda g: F.length(g) >= 18),
        spans_of(text, HEX, "hex"),
    ]
    return in_order(F.concat(*kinds), ("assign", "access", "hex"))


def in_order(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``spans`` sorted by start, then by the place of their kind in ``kinds``."""
    order = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(spans, lambda s: F.struct(
        s.start.alias("start"), F.array_position(order, s.kind).alias("o"), s.end.alias("end"),
        s.kind.alias("kind"), s.hit.alias("hit")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(
        s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end"), s.hit.alias("hit"))).cast(SPANS)


def encoding_of(token: Column) -> Column:
    """Name of the inferred encoding, NULL for tokens that are not tested."""
    out = F.lit(None).cast("string")
    for name, (pattern, alphabet) in reversed(ENCODINGS.items()):
        enough = F.length(token) >= math.ceil(MIN_BITS / math.log2(len(alphabet)))
        out = F.when(token.rlike(pattern), F.when(enough, F.lit(name))).otherwise(out)
    return F.when(token.rlike("[0-9]") & token.rlike("[A-Za-z]"), out)


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a normal variable, by a logistic approximation (error below 2e-4)."""
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def two_sided(z: Column) -> Column:
    return 2 * upper_tail(F.abs(z))


def randomness_p(token: Column, alphabet: Column) -> Column:
    """struct<uniform, runs, serial, p>: the p-values and their Bonferroni combination."""
    def stats(x: Column) -> Column:
        n, k = F.size(x.v).cast("double"), F.length(x.alphabet).cast("double")
        chi = F.aggregate(x.used, F.lit(0.0), lambda a, c: let(
            (F.length(x.token) - F.length(F.replace(x.token, c, F.lit("")))).cast("double"),
            lambda m: a + m * m)) * k / n - n
        df = k - 1
        z_chi = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        high = F.transform(x.v, lambda v: (v * 2 > k).cast("int"))
        ones = F.aggregate(high, F.lit(0), lambda a, b: a + b).cast("double")
        zeros = n - ones
        runs = 1 + F.aggregate(F.zip_with(F.slice(high, 1, F.size(high) - 1), F.slice(high, 2, F.size(high) - 1),
                                          lambda a, b: (a != b).cast("int")), F.lit(0), lambda a, b: a + b).cast("double")
        mean_runs = 1 + 2 * ones * zeros / n
        var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
        s1 = F.aggregate(x.v, F.lit(0.0), lambda a, v: a + v)
        s2 = F.aggregate(x.v, F.lit(0.0), lambda a, v: a + v * v)
        lag = F.aggregate(F.zip_with(x.v, F.concat(F.slice(x.v, 2, F.size(x.v) - 1), F.slice(x.v, 1, 1)),
                                     lambda a, b: (a * b).cast("double")), F.lit(0.0), lambda a, b: a + b)
        spread = n * s2 - s1 * s1
        z_serial = ((n * lag - s1 * s1) / spread + 1 / (n - 1)) / F.sqrt(n * (n - 3) / ((n + 1) * (n - 1) * (n - 1)))
        return F.struct(two_sided(z_chi).alias("uniform"),
                        F.when(var_runs > 0, two_sided((runs - mean_runs) / F.sqrt(var_runs))).otherwise(0.0).alias("runs"),
                        F.when(spread > 0, two_sided(z_serial)).otherwise(0.0).alias("serial"))

    chars = F.split(token, "")
    p = let(F.struct(token.alias("token"), alphabet.alias("alphabet"), F.array_distinct(chars).alias("used"),
                     F.transform(chars, lambda c: F.call_function("instr", alphabet, c)).alias("v")), stats)
    return let(p, lambda x: F.struct(x.uniform.alias("uniform"), x.runs.alias("runs"), x.serial.alias("serial"),
                                     F.least(F.lit(1.0), 3 * F.least(x.uniform, x.runs, x.serial)).alias("p")))


def random_tokens(tokens: DataFrame) -> DataFrame:
    """Distinct (token, encoding, p) of ``tokens(token, encoding)`` that look random."""
    alphabet = F.create_map(*[F.lit(x) for name, (_, a) in ENCODINGS.items() for x in (name, a)])
    tested = (tokens.groupBy("token", "encoding").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("p", randomness_p(F.col("token"), alphabet[F.col("encoding")]).p)
              .withColumn("length_class", F.floor(F.log2(F.length("token").cast("double"))).cast("int"))
              .withColumn("bin", F.least(F.lit(P_BINS), F.floor(-10 * F.log10(F.greatest("p", F.lit(1e-300))))).cast("int")))
    tested = table(tested.select("token", "encoding", "length_class", "p", "bin"), "secret-tokens")
    stratum = ["encoding", "length_class"]
    bins = tested.groupBy(*stratum, "bin").agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy(*stratum).orderBy(F.desc("bin"))
    whole = Window.partitionBy(*stratum)
    # a bin is rejected if its largest p is at most FDR * (tokens with such p) / (all tokens)
    cut = (bins.withColumn("below", F.sum("n").over(up)).withColumn("all", F.sum("n").over(whole))
           .where(F.pow(F.lit(10.0), -F.col("bin") / 10) <= FDR * F.col("below") / F.col("all"))
           .groupBy(*stratum).agg(F.min("bin").alias("cut")))
    return (tested.join(cut, stratum, "left").where(F.col("cut").isNull() | (F.col("bin") < F.col("cut")))
            .select("token", "encoding", "p"))


def find_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``base`` and ``spans`` (arrays of kind, start, end, hit) of every row.

    A NULL or empty text has no spans. Rows that repeat an id, and rows with a
    NULL id, are scanned one by one. Other columns of ``docs`` are left out.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    token = spans_of(F.col("_text"), TOKEN, "random")
    scanned = docs.select(F.col(f"`{id}`").alias("id"), body.alias("_text")).select(
        "id", F.concat_ws("-", F.col("id").cast("string"), F.xxhash64("_text"), F.length("_text")).alias("row"),
        base_spans(F.col("_text")).alias("base"),
        F.filter(token, lambda s: encoding_of(s.hit).isNotNull()).alias("tokens"))
    # all tokens count for the cut, but only those that no base span holds are reported
    scanned = table(scanned.withColumn("free", outside(F.col("tokens"), F.col("base"), inside=True)), "secret-scan")
    tokens = scanned.where(F.size("tokens") > 0).select("row", F.explode("tokens").alias("s")).select(
        F.col("s.hit").alias("token"), encoding_of(F.col("s.hit")).alias("encoding"))
    free = scanned.where(F.size("free") > 0).select("row", F.explode("free").alias("s")).select(
        "row", "s", F.col("s.hit").alias("token"), encoding_of(F.col("s.hit")).alias("encoding"))
    more = (free.join(random_tokens(tokens), ["token", "encoding"]).groupBy("row").agg(F.collect_set("s").alias("more")))
    plain = scanned.where(F.size("tokens") == 0).withColumn("more", F.array().cast(SPANS))
    rest = scanned.where(F.size("tokens") > 0).join(more, "row", "left")
    spans = in_order(F.concat("base", F.coalesce("more", F.array().cast(SPANS))), ("assign", "access", "hex", "random"))
    out = plain.select("id", "base", "more").unionByName(rest.select("id", "base", "more"))
    return out.select(F.col("id").alias(id), "base", spans.alias("spans"))


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    n = [of_kind(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *n, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
