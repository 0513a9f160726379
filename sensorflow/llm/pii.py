"""Personal data: base formats, and identifiers found through learned contexts.

The base formats give the seeds, whole spans of one word or more. They and every
identifier-like token (a run of adjoining digit words, or a word with a digit or
an ``@``) are instances; the word before one, and the two words before it, are
its lexical patterns. A pattern's score is the mean score of its distinct
instances, smoothed; an instance's score is 1 for seeds, else the noisy-or of
its trusted patterns. After ``ROUNDS`` rounds over this graph, instances of a
high score that are no seeds are reported as ``context`` spans.

A pattern that identifiers follow most of the time, and that stays trusted when
all words after it count, opens to words without a digit or ``@`` too. Such
words, and tokens of under four digits, are ordinary words in many places, so
most of their occurrences must follow trusted patterns.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import SPANS, cut, joined, let, of_kind, outside, pieces_of, replaced, running, spans_of, table

#: Possessive forms of the base patterns: the same matches in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A word with a digit or an @, and a scan that tells whether a text has one.
TOKEN, ANY = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+", "[0-9@]"
KINDS = ("email", "ip", "card", "phone")

#: A run of digit words with single spaces between, else a word as above.
_DIGITS = r"\(?+[0-9](?:[0-9()/.-]*[0-9)])?"
RUN = rf"(?<!\S)(?>\+?+{_DIGITS})(?:\x20(?>{_DIGITS})(?=[^\s\w(+]*+(?!\S)))++\S*+|{TOKEN}"
#: Where a word begins after white space.
WORDS = r"(?<=\s)(?=\S)"

#: Rounds, instances that a pattern needs, and the least scores of patterns and instances.
ROUNDS, MIN_SUPPORT, PATTERN_SCORE, INSTANCE_SCORE = 3, 5, 0.9, 0.95
#: Share of a pattern's occurrences that identifiers take if it opens to any word, and
#: share of an ordinary-looking instance's occurrences that follow trusted patterns.
OPEN_SHARE, INSTANCE_SHARE = 0.5, 0.5


def _octets(hit: Column) -> Column:
    """All parts at most 255, whatever their leading zeros."""
    return F.forall(F.split(hit, r"\."), lambda p: let(
        F.regexp_replace(p, "^0+", ""), lambda d: (F.length(d) < 3) | ((F.length(d) == 3) & (d <= "255"))))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    """13 to 19 digits that pass Luhn's check."""
    return let(F.reverse(_digits(hit)), lambda d: F.length(d).between(13, 19) & (F.aggregate(
        F.sequence(F.lit(1), F.least(F.length(d), F.lit(19))), F.lit(0),
        lambda a, i: a + let(F.substring(d, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
                             lambda v: F.when(v > 9, v - 9).otherwise(v))) % 10 == 0))


def base_spans(text: Column) -> Column:
    """Spans of the base formats by kind, then start."""
    phone = lambda hit: F.length(_digits(hit)).between(9, 15)
    return F.when(text.rlike(ANY), F.concat(
        spans_of(text, EMAIL, "email"), spans_of(text, IP, "ip", _octets),
        spans_of(text, CARD, "card", _luhn), spans_of(text, PHONE, "phone", phone),
    )).otherwise(F.array().cast(SPANS))


CONTEXT = "array<struct<start:int,end:int,hit:string,one:string,two:string,seed:boolean>>"


def _word(w: Column) -> Column:
    """Lower-cased letters of a context word; a word with a digit stands for its class."""
    return F.when(w.rlike("[0-9@]"), "<id>").otherwise(F.regexp_replace(F.lower(w), r"[^\p{L}]", ""))


def _name(hit: Column) -> Column:
    """An instance in lower case, without marks at its ends."""
    return F.regexp_replace(F.lower(hit), r"^[^\p{L}\p{N}+]+|[^\p{L}\p{N}]+$", "")


def _patterns(one: Column, two: Column) -> Column:
    return F.array(F.concat(F.lit("1 "), one), F.concat(F.lit("2 "), two))


def _blank(text: Column, base: Column) -> Column:
    """``text`` with a control character in place of each one inside a base span, so that no run of words crosses it."""
    return replaced(text, base, lambda s, at: F.repeat(F.lit("\x01"), F.greatest(s.end - F.greatest(s.start, at), F.lit(0))))


def _before(pieces: Column, start: Column) -> Column:
    """Text before ``start`` from at least the two words on that end there, if there are two; the word around ``start`` is left out."""
    def left(width: int, more: Column) -> Column:
        a = F.greatest(start - width, F.lit(0))
        return let(cut(pieces, a, start), lambda x: F.when((a == 0) | x.rlike(r"\s\S++\s++\S++\s++\S*+\z"), x).otherwise(more))
    # most often a few characters hold both words
    whole = left(128, left(4096, cut(pieces, F.lit(0), start)))
    return F.regexp_replace(whole, r"\S+\z", "")


def identifiers(text: Column, base: Column) -> Column:
    """Base spans (seeds) and the identifier-like tokens beside them, with the one and the two words before their first word."""
    def context(pieces: Column, s: Column, seed: bool) -> Column:
        return let(F.split(F.regexp_replace(_before(pieces, s.start), r"^\s+|\s+\z", ""), r"\s+"), lambda w: let(
            _word(F.element_at(w, -1)), lambda one: F.struct(
                s.start.alias("start"), s.end.alias("end"), _name(s.hit).alias("hit"), one.alias("one"),
                F.concat(F.when(F.size(w) > 1, _word(F.try_element_at(w, F.lit(-2)))).otherwise(""), F.lit(" "), one).alias("two"),
                F.lit(seed).alias("seed"))))
    tokens = outside(let(_blank(text, base), lambda x: spans_of(x, RUN, "context")), base, inside=False)
    return F.when(text.rlike(ANY), let(pieces_of(text), lambda p: F.concat(
        F.transform(base, lambda s: context(p, s, True)), F.transform(tokens, lambda s: context(p, s, False))))
        .cast(CONTEXT)).otherwise(F.array().cast(CONTEXT))


def _learn(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Instances of a high score that are no seeds, and the trusted patterns, from edges(pattern, instance, seed, times).

    One row per pattern and instance, so common patterns do not repeat. Scores
    move over the edges with two grouped sums a round.
    """
    scored = edges.withColumn("score", F.col("seed").cast("double"))
    for _ in range(ROUNDS):
        patterns = (scored.groupBy("pattern").agg(
            (F.sum("score") / (F.count(F.lit(1)) + 0.5)).alias("trust"), F.sum("score").alias("sum"),
            F.count(F.lit(1)).alias("n"), F.sum("times").alias("times"),
            F.sum(F.col("seed").cast("int")).alias("seeds"))
            .where((F.col("trust") >= PATTERN_SCORE) & (F.col("n") >= MIN_SUPPORT) & (F.col("seeds") > 0)))
        patterns = table(patterns, "pii-patterns")
        linked = edges.join(patterns.select("pattern", "trust"), "pattern", "left")
        instances = linked.groupBy("instance").agg(
            F.max("seed").alias("seed"),
            _noisy_or(F.coalesce("trust", F.lit(0.0))).alias("score"), _after(F.col("trust").isNotNull()).alias("after"),
            F.sum(F.when(F.col("pattern").startswith("1 "), F.col("times"))).alias("times"))
        instances = table(instances.withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.col("score"))), "pii-instances")
        scored = edges.join(instances.select("instance", "score"), "instance")
    # a word with an @ or four digits is an identifier by its form wherever it stands
    form = F.col("instance").contains("@") | (F.length(F.regexp_replace("instance", "[^0-9]", "")) >= 4)
    found = instances.where(~F.col("seed") & (F.col("score") >= INSTANCE_SCORE)
                            & (form | (F.col("after") >= INSTANCE_SHARE * F.col("times"))))
    return found.select("instance", "score"), patterns


def _noisy_or(trust: Column) -> Column:
    return 1 - F.exp(F.sum(F.log(1 - F.least(trust, F.lit(0.999)))))


def _after(trusted: Column) -> Column:
    """Occurrences of an instance after trusted patterns; each has one pattern of one word and one of two."""
    of = lambda k: F.sum(F.when(trusted & F.col("pattern").startswith(k), F.col("times")).otherwise(0))
    return F.greatest(of("1 "), of("2 "))


def _starts(pieces: Column) -> Column:
    """Offset of each piece."""
    return running(F.transform(pieces, F.length), F.lit(0), lambda a, b: a + b)


def _words(docs: DataFrame, id: str, text: str, start: Column | None = None) -> DataFrame:
    """row, word, one, two (and start) of every word of every text."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    split = docs.select(row_key(F.col(f"`{id}`"), body).alias("row"), F.split(body, WORDS).alias("pieces"))
    norm = split.select("row", "pieces", F.transform("pieces", _word).alias("norm"))
    parts = [F.col("pieces").alias("piece"), F.concat(F.array(F.lit("")), "norm").alias("one"),
             F.concat(F.array(F.lit(""), F.lit("")), "norm").alias("before")]
    if start is not None:
        parts.append(start.alias("start"))
    word = norm.select("row", F.explode(F.arrays_zip(*parts)).alias("w")).select("row", "w.*").where(F.col("piece").isNotNull())
    return (word.withColumn("word", F.regexp_extract("piece", r"^\S*", 0)).where("word != ''")
            .withColumn("two", F.concat("before", F.lit(" "), "one")).drop("piece", "before"))


def _open(docs: DataFrame, id: str, text: str, patterns: DataFrame) -> DataFrame | None:
    """row, start, end, instance of words without a digit or ``@`` that trusted patterns vouch for; None without such patterns."""
    if patterns.isEmpty():
        return None
    at = _patterns(F.col("one"), F.col("two"))
    count = F.count(F.lit(1))
    all_ = _words(docs, id, text).select(F.explode(at).alias("pattern")).join(patterns.select("pattern"), "pattern")
    opened = all_.groupBy("pattern").agg(count.alias("all")).join(patterns, "pattern").where(F.col("times") >= OPEN_SHARE * F.col("all"))
    opened = table(opened.drop("all"), "pii-opened")
    if opened.isEmpty():
        return None
    plain = lambda w: w.where(~F.col("word").rlike(ANY)).withColumn("instance", _name(F.col("word"))).where("instance != ''")
    words = plain(_words(docs, id, text))
    edges = table(words.select(F.explode(at).alias("pattern"), "instance").join(opened.select("pattern"), "pattern")
                  .groupBy("pattern", "instance").agg(count.alias("times")), "pii-open-edges")
    more = edges.groupBy("pattern").agg(count.alias("more"))
    sure = (opened.join(more, "pattern").withColumn("trust", F.col("sum") / (F.col("n") + F.col("more") + 0.5))
            .where(F.col("trust") >= PATTERN_SCORE).select("pattern", "trust"))
    likely = table(edges.join(sure, "pattern").groupBy("instance").agg(_noisy_or(F.col("trust")).alias("score"), _after(F.lit(True)).alias("after"))
                   .where(F.col("score") >= INSTANCE_SCORE), "pii-likely")
    total = words.select("instance").join(likely.select("instance"), "instance").groupBy("instance").agg(count.alias("all"))
    found = table(likely.join(total, "instance").where(F.col("after") >= INSTANCE_SHARE * F.col("all")).select("instance"), "pii-open-found")
    placed = plain(_words(docs, id, text, _starts(F.col("pieces"))))
    return placed.join(found, "instance").select("row", "start", (F.col("start") + F.length("word")).alias("end"), "instance")


def _scan(docs: DataFrame, id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    scanned = docs.select(F.col(f"`{id}`").alias("id"), body.alias("_text")).select(
        "id", "_text", row_key(F.col("id"), F.col("_text")).alias("row"), base_spans(F.col("_text")).alias("base")).select(
        "id", "row", "base", identifiers(F.col("_text"), F.col("base")).alias("tokens"))
    return table(scanned, "pii-scan")


def row_key(id: Column, text: Column) -> Column:
    return F.concat_ws("-", id.cast("string"), F.xxhash64(text), F.length(text))


def _context(scanned: DataFrame, docs: DataFrame, id: str, text: str) -> tuple[DataFrame, bool]:
    """row -> spans of discovered identifiers, and whether texts without a digit or ``@`` may have some."""
    seen = scanned.where(F.size("tokens") > 0).select("row", F.explode("tokens").alias("t"))
    edges = (seen.select(F.explode(_patterns(F.col("t.one"), F.col("t.two"))).alias("pattern"),
                         F.col("t.hit").alias("instance"))
             .where(F.length("instance") > 0).groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("times")))
    known = seen.groupBy(F.col("t.hit").alias("instance")).agg(F.max("t.seed").alias("seed"))
    found, patterns = _learn(table(edges.join(known, "instance"), "pii-edges"))
    hits = (seen.where(~F.col("t.seed")).select("row", "t.start", "t.end", F.col("t.hit").alias("instance"))
            .join(found.select("instance"), "instance").select("row", "start", "end", "instance"))
    more = _open(docs, id, text, patterns)
    if more is not None:
        hits = hits.unionByName(more)
    span = F.struct(F.lit("context").alias("kind"), "start", "end", F.col("instance").alias("hit"))
    return hits.groupBy("row").agg(F.array_sort(F.collect_set(span)).cast(SPANS).alias("more")), more is not None


def find_pii(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``base`` and ``spans`` (arrays of kind, start, end, hit) of every row.

    A NULL or empty text has no spans. Rows that repeat an id, and rows with a
    NULL id, are scanned one by one; equal rows get equal spans. Other columns
    of ``docs`` are left out.
    """
    scanned = _scan(docs, id, text)
    context, anywhere = _context(scanned, docs, id, text)
    may = F.lit(True) if anywhere else F.size("tokens") > 0
    rest = scanned.where(may).join(context, "row", "left")
    plain = scanned.where(~may).withColumn("more", F.array().cast(SPANS))
    out = plain.select("id", "base", "more").unionByName(rest.select("id", "base", "more"))
    return out.select(F.col("id").alias(id), "base", F.concat("base", F.coalesce("more", F.array().cast(SPANS))).alias("spans"))


def redact(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``[KIND]`` in place of every span in ``text``; all else stays.

    Overlapping spans become one, named after the first. A NULL text stays
    NULL. ``n_chars``, if there is one, is counted anew for changed texts.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"))  # helper columns beside it clash with none of its names
    was = F.col("r").getField(text)
    touched = F.coalesce(was.rlike(ANY), F.lit(False))
    scanned = _scan(docs.where(F.coalesce(F.col(f"`{text}`").rlike(ANY), F.lit(False))), id, text)
    context, anywhere = _context(scanned, docs, id, text)
    if anywhere:
        touched = was.isNotNull()
    none = F.array().cast(SPANS)
    spans = (scanned.select("row", "base").join(context, "row", "full" if anywhere else "left").groupBy("row")
             .agg(F.first(F.concat(F.coalesce("base", none), F.coalesce("more", none))).alias("spans")).where(F.size("spans") > 0))
    masked = replaced(was, F.col("spans"), lambda s, at: F.when(s.start < at, "").otherwise(F.concat(F.lit("["), F.upper(s.kind), F.lit("]"))))
    key = row_key(F.col("r").getField(id), F.coalesce(was, F.lit("")))
    new = (rows.where(touched).withColumn("row", key).join(spans, "row", "left")
           .withColumn("hit", F.col("spans").isNotNull()).withColumn("text", F.when(F.col("hit"), masked).otherwise(was)))

    def value(c: str) -> Column:
        if c == text:
            return F.col("text").alias(c)
        old = F.col("r").getField(c)
        return (F.when(F.col("hit"), F.length("text").cast(docs.schema[c].dataType)).otherwise(old) if c == "n_chars" else old).alias(c)
    return rows.where(~touched).select("r.*").unionByName(new.select(*[value(c) for c in docs.columns]))


def op1_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    n = [of_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *n, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
