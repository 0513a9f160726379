"""Helpers shared by the operators: shared work tables, minima of hot groups, spans."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts into which every group is dealt before a join on its key.
SALTS = 64


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors share.

    Where the setting is unset: a scratch folder for ``local[..]`` masters
    (tests, one process), else a folder in the warehouse, which is shared too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master == "local" or master.startswith("local["):
            root = tempfile.mkdtemp(prefix="sensorflow-work-")
            spark.conf.set("spark.checkpoint.dir", root)
        else:
            root = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_work")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there.

    ``batch``: rows that go to a Python function at once while it is written.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    before = spark.conf.get(ARROW_ROWS)
    try:
        if batch:
            spark.conf.set(ARROW_ROWS, str(batch))
        df.write.parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task; when it has ended, what it held goes back to the machine.

    Workers live on for the tasks of later stages, and would otherwise keep the
    free memory of the largest one.
    """
    @functools.wraps(run)
    def inner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            import pyarrow

            gc.collect()
            pyarrow.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass
    return inner


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spread_join(big: DataFrame, small: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """``big`` joined with ``small``, which has one row per ``key``; no key fills a task.

    Each key is dealt over ``SALTS`` join keys by the hash of ``by``, and
    ``small`` is repeated for the salts that occur. NULL keys match nothing.
    """
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(F.col(by)), F.lit(SALTS)).cast("int"))
    used = salted.where(F.col(key).isNotNull()).groupBy(key, "_salt").agg(F.lit(1).alias("_one")).drop("_one")
    return salted.join(used.join(small, key), [key, "_salt"], how).drop("_salt")


def group_min(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``df`` with the least ``value`` of its ``key`` group in ``out``.

    Rows without a key get NULL, and rows without a value do not count. A group of any size is spread over
    ``SALTS`` join keys, and aggregated per (key, salt) first, so that no task
    gets a whole group.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(value)), F.lit(SALTS)).cast("int"))
    parts = salted.where(F.col(key).isNotNull()).groupBy(key, "_salt").agg(F.min(value).alias("_m"))
    mins = (parts.groupBy(key).agg(F.min("_m").alias(out), F.collect_set("_salt").alias("_salts"))
            .select(key, out, F.explode("_salts").alias("_salt")))
    return salted.join(mins, [key, "_salt"], "left").drop("_salt")


def running(values: Column, zero: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For each of ``values`` the fold by ``op`` of ``zero`` and all before it.

    Folded in about sqrt(n) chunks, since an array grows by being copied: n ** 1.5
    steps, so hundreds of thousands of values take a second or two.
    """
    def fold(chunk: Column, start: Column) -> Column:
        return F.aggregate(chunk, F.struct(start.alias("at"), F.slice(F.array(start), 1, 0).alias("all")),
                           lambda a, x: F.struct(op(a.at, x).alias("at"), F.concat(a.all, F.array(a.at)).alias("all")), lambda a: a.all)

    def build(x: Column) -> Column:
        size = F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(x).cast("double"))).cast("int"))
        chunks = let(size, lambda k: F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / k).cast("int")), lambda c: F.slice(x, c * k + 1, k)))
        return let(chunks, lambda c: F.flatten(F.zip_with(c, fold(F.transform(c, lambda y: F.aggregate(y, zero, lambda a, b: op(a, b))), zero), fold)))

    return let(values, lambda x: F.when(F.size(x) > 0, build(x)).otherwise(F.slice(F.array(zero), 1, 0)))


#: Code points of a piece of a text.
PIECE = 1024


def pieces_of(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points, so that a place in it is found without a walk from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of a text in pieces."""
    def part(c: Column) -> Column:
        return let(F.greatest(start - c * PIECE, F.lit(0)), lambda a: F.substring(
            F.element_at(pieces, c + 1), a + 1, F.least(end - c * PIECE, F.lit(PIECE)) - a))
    place = lambda x: F.floor(x / PIECE).cast("int")
    return F.when(end > start, F.concat_ws("", F.transform(F.sequence(place(start), place(end - 1)), part))).otherwise(F.lit(""))


def replaced(text: Column, spans: Column, by: Callable[[Column, Column], Column]) -> Column:
    """``text`` with ``by(span, covered)`` in place of each span; ``covered``: how far earlier spans reach, which may be into it or beyond."""
    def build(x: Column) -> Column:
        reach = running(F.transform(x.spans, lambda s: s.end), F.lit(0), F.greatest)
        parts = F.zip_with(x.spans, reach, lambda s, at: F.concat(cut(x.pieces, at, s.start), by(s, at)))
        last = F.array_max(F.transform(x.spans, lambda s: s.end))
        return F.concat(F.concat_ws("", parts), cut(x.pieces, last, x.n))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind"))))
    return F.when(F.size(spans) > 0, let(F.struct(pieces_of(text).alias("pieces"), F.length(text).alias("n"), ordered.alias("spans")), build)).otherwise(text)


def outside(spans: Column, base: Column, inside: bool) -> Column:
    """The spans that no base span overlaps (``inside``: that no base span holds whole), in order.

    One sorted pass over both; a span is hidden if the base spans that begin
    in time (before its end, or not after its start) reach far enough.
    """
    none = F.lit("")
    ours = lambda s: F.struct((s.start if inside else s.end).alias("at"), F.lit(1 if inside else 0).alias("o"),
                              s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind"), s.hit.alias("hit"))
    theirs = lambda b: F.struct(b.start.alias("at"), F.lit(0 if inside else 1).alias("o"),
                                b.start.alias("start"), b.end.alias("end"), none.alias("kind"), none.alias("hit"))
    span = F.lit(1 if inside else 0)

    def build(e: Column) -> Column:
        reach = running(F.transform(e, lambda x: F.when(x.o == span, F.lit(-1)).otherwise(x.end)), F.lit(-1), F.greatest)
        seen = F.filter(F.zip_with(e, reach, lambda x, r: F.struct(x.alias("x"), r.alias("reach"))),
                        lambda y: (y.x.o == span) & ((y.reach < y.x.end) if inside else (y.reach <= y.x.start)))
        return F.transform(seen, lambda y: F.struct(y.x.kind.alias("kind"), y.x.start.alias("start"), y.x.end.alias("end"), y.x.hit.alias("hit"))).cast(SPANS)

    return let(spans, lambda s: F.when((F.size(s) > 0) & (F.size(base) > 0), let(
        F.array_sort(F.concat(F.transform(s, ours), F.transform(base, theirs))), build)).otherwise(s))


def spans_of(text: Column, pattern: str, kind: str, keep: Callable[[Column], Column] | None = None,
             group: int | None = None) -> Column:
    """array<struct<kind, start, end, hit>> of the leftmost non-overlapping matches.

    Offsets count code points, the end is exclusive. The text between matches
    (``split``) and the matches together give the offsets. ``keep`` judges the
    text of ``group`` (the whole match by default); matches it rejects are
    dropped without another try.
    """
    def build(x: Column) -> Column:
        parts = F.slice(x.parts, 1, F.size(x.hits))
        before = running(F.zip_with(parts, x.hits, lambda p, h: F.length(p) + F.length(h)), F.lit(0), lambda a, b: a + b)
        step = F.zip_with(before, parts, lambda b, p: b + F.length(p))
        rows = F.transform(F.arrays_zip(x.hits.alias("hit"), step.alias("start"), x.judged.alias("judged")),
                           lambda r: F.struct(F.lit(kind).alias("kind"), r["start"].alias("start"),
                                              (r["start"] + F.length(r["hit"])).alias("end"),
                                              r["hit"].alias("hit"), r["judged"].alias("judged")))
        kept = F.filter(rows, lambda r: keep(r.judged)) if keep else rows
        return F.transform(kept, lambda r: F.struct(r.kind.alias("kind"), r.start.alias("start"),
                                                    r.end.alias("end"), r.hit.alias("hit")))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    empty = F.array().cast(SPANS)
    return F.when(text.rlike(pattern), let(
        F.struct(F.split(text, pattern, -1).alias("parts"), hits.alias("hits"), judged.alias("judged")),
        lambda x: build(x).cast(SPANS))).otherwise(empty)


SPANS = "array<struct<kind:string,start:int,end:int,hit:string>>"


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))))


def of_kind(spans: Column, kind: str) -> Column:
    """Number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")


def components(links: DataFrame) -> DataFrame:
    """node and comp (the least node reachable) of every node that ``links(u, v)`` name.

    Labels are lowered to the least label of the neighbours and jump to the
    label of their label, until none changes; each round is a written table. A
    node with a third of all links, and a label that a third of all nodes have,
    are spread over join keys.
    """
    both = F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b")))
    edges = table(links.where("u <> v").select(F.explode(both).alias("e")).select("e.a", "e.b").distinct(), "links")
    labels = table(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        near = spread_join(edges, labels.withColumnRenamed("a", "b"), "b", "a").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, "a").select("a", "label", F.least("label", "near").alias("new"))
        far = labels.select(F.col("a").alias("new"), F.col("label").alias("far"))
        moved = table(spread_join(step, far, "new", "a", "left").select(
            "a", "label", F.least("new", F.coalesce("far", "new")).alias("new")), "labels")
        labels = moved.select("a", F.col("new").alias("label"))
        if moved.where("new <> label").isEmpty():
            return labels.select(F.col("a").alias("node"), F.col("label").alias("comp"))
