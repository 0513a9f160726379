"""Main text of web pages by equivalence classes of template tokens.

1. Every page becomes structural tokens (start tags with the path of their
   ancestors) and text tokens (a path and the hash of its text). Per host, each
   token's occurrence vector over all pages of the host is folded into a
   fingerprint (number of pages, number of occurrences, XOR of the hashes of
   page and count), a partial aggregate without any page list.
2. Tokens of a host with equal vectors form an equivalence class. Classes that
   most pages have, with one occurrence a page, are valid frames; nested by
   their paths they are the template. What lies between two neighbours of a
   template is a slot.
3. Slots are judged by their role: tag and class names, text mass, share of
   link text. The frame around the main slot, the frames inside it that hold
   other matter, and the classes of text that repeat over the pages go to the
   extraction, which reads every page once more.

A host with few pages takes the template of all pages together; a page that
lacks the frame is judged by the tags of its own.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import table
from sensorflow.llm.url_filter import host_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math object xmp".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th
thead tr ul""".split())
#: A start tag on the left ends an open element on the right, up to the next element that bounds it.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDS = frozenset("ul ol dl table tbody thead tfoot div section article aside main nav header footer form body select".split())

#: Elements that never hold main text, and words of class, id and role that say so.
NOT_MAIN = frozenset("head nav footer aside form script style noscript iframe template svg button select menu dialog textarea object".split())
NOT_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs byline comment comments consent
contentinfo cookie cookies disqus feedback foot footer form head header login masthead menu modal nav navbar navigation newsletter notice notices
overlay pager pagination popup promo promotion recommended related replies reply respond search share sharing sidebar side signup social
sponsor sponsored subscribe subscription tags toolbar topbar widget widgets alert gdpr""".split())
MAIN_TAGS = ("article", "main")
MAIN_WORDS = frozenset("article post entry content main story text".split())

#: Pages that a host needs for a template of its own, and the share of them that a frame needs.
MIN_PAGES, SUPPORT = 3, 0.6
#: Share of the main frame's text from which repeated text is copies of an article, no template.
COPIED = 0.5
#: Host under which the template of all pages goes.
ALL = "*"

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


def _sign(name: str, attrs: str) -> str:
    """Element name with the words of its class, id and role; digits do not count."""
    if "=" not in attrs:
        return name
    words = sorted({w for m in _ATTR.finditer(attrs) for w in _WORD.findall((m[2] or m[3] or m[4] or "").lower())})
    return f"{name}.{'.'.join(words)}" if words else name


def events(page: str) -> Iterator[tuple[str, str]]:
    """('open', signature), ('close', name), ('void', name) and ('text', raw text) in page order; raw elements stay empty."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:]
            return
        if lt > at:
            yield "text", page[at:lt]
        m = _TAG.match(page, lt)
        if not m:
            yield "text", "<"
            at = lt + 1
            continue
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        attrs = (m[3] if m[2] else m[6]) or ""
        if m[1] or m[4]:
            yield "close", name
        elif name in VOID or attrs.endswith("/") and name not in BLOCK:
            yield "void", name
        else:
            yield "open", _sign(name, attrs)
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else n
                yield "close", name


def walk(page: str) -> Iterator[tuple[str, tuple[str, ...], str]]:
    """('start', path, '') for each element, ('text', path, text) for each text, ('break', path, '') at block borders."""
    names: list[str] = []
    path: tuple[str, ...] = ()

    def pop(k: int) -> bool:
        nonlocal path
        block = any(x in BLOCK for x in names[k:])
        del names[k:]
        path = path[:k]
        return block

    for kind, what in events(page):
        if kind == "text":
            yield "text", path, what
        elif kind == "void":
            if what == "br":
                yield "text", path, "\n"
            elif what in BLOCK:
                yield "break", path, ""
        elif kind == "close":
            for k in range(len(names) - 1, -1, -1):
                if names[k] == what:
                    if pop(k):
                        yield "break", path, ""
                    break
        else:
            name = what.partition(".")[0]
            ends = ENDS.get(name, set()) | ({"p"} if name in BLOCK else set())
            for k in range(len(names) - 1, -1, -1):
                if names[k] in ends:
                    pop(k)
                    break
                if names[k] in BOUNDS:
                    break
            names.append(name)
            path = (*path, what)
            if name in BLOCK:
                yield "break", path, ""
            yield "start", path, ""


def blocks(page: str) -> Iterator[tuple[tuple[str, ...], str]]:
    """(path of its first text, text) of each block that has any, in page order; references decoded, white space single."""
    parts: list[str] = []
    where: tuple[str, ...] = ()
    for kind, path, text in walk(page):
        if kind == "text":
            if not parts or not where and text.strip():
                where = path
            parts.append(text)
        elif kind == "break" and parts:
            if joined := " ".join(entities.unescape("".join(parts)).split()):
                yield where, joined
            parts, where = [], ()
    if joined := " ".join(entities.unescape("".join(parts)).split()):
        yield where, joined


def barred(sign: str) -> bool:
    """Whether an element's own name or words say that it holds no main text."""
    name, *words = sign.split(".")
    return name in NOT_MAIN or bool(NOT_WORDS.intersection(words) and name not in ("html", "body", *MAIN_TAGS))


def _outer(path: tuple[str, ...]) -> bool:
    """Barred anywhere; a page header is barred outside an article."""
    inside = False
    for s in path:
        name = s.partition(".")[0]
        if barred(s) or name == "header" and not inside:
            return True
        inside |= name in MAIN_TAGS
    return False


def text_token(text: str) -> int:
    """Token of a text: an odd number, so never 0."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1 | 1


TOKENS = "host string, page long, path string, token long, n int, chars long, linked long, place int"


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each structural token (token 0) and each text token of a page."""
    for pdf in batches:
        rows = []
        for host, key, page in zip(pdf["host"], pdf["key"], pdf["html"]):
            starts: Counter = Counter()
            first: dict = {}
            for kind, path, _ in walk(page or ""):
                if kind == "start":
                    starts[path] += 1
                    first.setdefault(path, len(first))
            chars, linked, texts = defaultdict(int), defaultdict(int), Counter()
            for path, text in blocks(page or ""):
                chars[path] += len(text)
                linked[path] += len(text) if any(s.partition(".")[0] == "a" for s in path) else 0
                texts[path, text_token(text), len(text)] += 1
            for path, n in starts.items():
                rows.append((host, key, ">".join(path), 0, n, chars[path], linked[path], first[path]))
            for (path, h, size), n in texts.items():
                rows.append((host, key, ">".join(path), h, n, n * size, 0, first.get(path, 0)))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in TOKENS.split(", ")])


def frames(rows: pd.DataFrame, pages: int) -> list[list[tuple[str, ...]]]:
    """Valid equivalence classes: paths with one vector, once on each page that has them, in page order, larger classes first."""
    valid = rows[(rows["token"] == 0) & (rows["df"] == rows["total"]) & (rows["df"] >= SUPPORT * pages)]
    classes = [[tuple(p.split(">")) for p in g.sort_values(["place", "path"])["path"]] for _, g in valid.groupby(["df", "total", "fp"])]
    return sorted(classes, key=lambda c: (-len(c), c[0]))


def main_frame(rows: pd.DataFrame, pages: int) -> tuple[str, list[str]]:
    """Path of the frame around the main slot, and the frames in it that hold other matter. Empty without a template."""
    nested = sorted({p for c in frames(rows, pages) for p in c}, key=lambda p: (len(p), p))
    open_ = [p for p in nested if not _outer(p)]
    if not open_:
        return "", []
    mass: dict[tuple[str, ...], float] = {}
    link: dict[tuple[str, ...], float] = {}
    for r in rows.itertuples():
        path = tuple(r.path.split(">"))
        if r.token == 0:
            mass[path], link[path] = r.chars, r.linked

    def held(p: tuple[str, ...]) -> float:
        """Text in the slots of a frame, but for links and barred parts."""
        return sum(m - link[q] for q, m in mass.items() if q[:len(p)] == p and not _outer(q))

    def role(p: tuple[str, ...]) -> int:
        name, *words = p[-1].split(".")
        return 2 if name in MAIN_TAGS else 1 if MAIN_WORDS.intersection(words) else 0

    whole = max(held(open_[0]), 1e-9)
    rich = [p for p in open_ if held(p) >= 0.5 * whole]
    if not rich:
        return "", []
    # the most telling name, then the innermost frame that still has nearly all of the text
    best_role = max(role(p) for p in rich)
    named = [p for p in rich if role(p) == best_role]
    best = named[-1] if best_role else max((p for p in rich if held(p) >= 0.9 * whole), key=len)
    other = [p for p in nested if p[:len(best)] == best and len(p) > len(best)
             and (barred(p[-1]) or mass.get(p, 0) and link.get(p, 0) > 0.8 * mass[p] and p[-1].split(".")[0] in ("div", "section", "ul", "ol"))]
    return ">".join(best), sorted({">".join(p) for p in other})


def constant(rows: pd.DataFrame, pages: int, frame: str) -> list[str]:
    """Text tokens of the template, as ``token path``: classes of texts on most pages.

    A class that is half of the text of the frame or more, by page, is an
    article that the host has several times, and so are classes that are half
    of it together.
    """
    inside = (rows["path"] == frame) | rows["path"].str.startswith(f"{frame}>") if frame else rows["path"].notna()
    mass = rows.loc[inside & (rows["token"] == 0), "chars"].sum() / pages
    texts = rows[(rows["token"] != 0) & (rows["df"] >= max(MIN_PAGES, SUPPORT * pages))].assign(inside=inside)
    out, held = [], 0.0
    for (df, _, _), g in texts.groupby(["df", "total", "fp"]):
        size = g.loc[g["inside"], "chars"].sum() / df
        if size < COPIED * mass or size == 0:
            held += size
            out += [(bool(i), f"{t} {p}") for t, p, i in zip(g["token"], g["path"], g["inside"])]
    return sorted(x for i, x in out if not i or held < COPIED * mass)


def _template(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    pages = int(rows["pages"].iloc[0])
    frame, other = main_frame(rows, pages)
    return pd.DataFrame({"host": [key[0]], "frame": [frame], "other": [other], "same": [constant(rows, pages, frame)]})


def templates(pages: DataFrame) -> DataFrame:
    """host, frame, other, same for each host of pages(host, key, html) with ``MIN_PAGES`` pages, and for ``ALL``.

    Tokens are counted over all pages. Only those on enough pages reach the
    deduction of a host, so its group is bounded by the length of a page.
    """
    seen = pages.mapInPandas(_tokens, TOKENS)
    vector = F.xxhash64("page", "n")
    by_host = table(seen.groupBy("host", "path", "token").agg(
        F.count(F.lit(1)).alias("df"), F.sum(F.col("n").cast("long")).alias("total"), F.bit_xor(vector).alias("fp"),
        F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.min("place").alias("place")), "html-tokens")
    sums = [F.sum("df").alias("df"), F.sum("total").alias("total"), F.bit_xor("fp").alias("fp"), F.sum("chars").alias("chars"),
            F.sum("linked").alias("linked"), F.min("place").alias("place")]
    of_all = by_host.where("token = 0").groupBy("path", "token").agg(*sums).withColumn("host", F.lit(ALL))
    counts = table(pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "html-hosts")
    total = counts.agg(F.sum("pages").alias("pages")).withColumn("host", F.lit(ALL))
    counts = counts.where(F.col("pages") >= MIN_PAGES).unionByName(total.where("pages > 0"))
    frequent = by_host.unionByName(of_all).join(counts, "host").where(
        (F.col("df") >= SUPPORT * F.col("pages")) | (F.col("token") == 0) & (F.col("chars") * 100 * F.col("pages") >= F.col("df")) & (F.col("df") * 20 >= F.col("pages")))
    return frequent.groupBy("host").applyInPandas(_template, "host string, frame string, other array<string>, same array<string>")


def extract(page: str | None, frame: str | None, other, same=None) -> str:
    """Text of the slots inside ``frame`` but those in ``other`` frames; without the frame, what the page's own tags give.

    Texts in ``same`` belong to the template and are left out wherever they lie.
    """
    fixed = frozenset(same if same is not None else ())
    found = [(p, t) for p, t in blocks(page or "") if not fixed or f"{text_token(t)} {'>'.join(p)}" not in fixed]
    if not found:
        return ""
    cut = [tuple(x.split(">")) for x in (other if other is not None else [])]
    if frame:
        f = tuple(frame.split(">"))
        kept = [t for p, t in found if p[:len(f)] == f and not any(barred(s) for s in p[len(f):]) and not any(p[:len(c)] == c for c in cut)]
        if kept or any(p == f for k, p, _ in walk(page) if k == "start"):
            return "\n".join(kept)
    for tag in MAIN_TAGS:
        kept = [t for p, t in found if any(s.partition(".")[0] == tag for s in p) and not _outer(p)]
        if kept:
            return "\n".join(kept)
    return "\n".join(t for p, t in found if not _outer(p))


def main_text(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``id``, ``url`` and text of every row, from its whole html.

    NULL and empty pages give an empty text. A NULL url counts to the host ''.
    Rows that repeat are extracted alike (each counts as a page of its host).
    An empty table gives an empty result; other columns are left out.
    """
    read = pages.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"),
                        host_of(F.col(f"`{url}`")).alias("host"))
    found = table(templates(read.select("host", F.xxhash64("id", "url").alias("key"), "html")), "html-templates")
    rest = found.where(F.col("host") == ALL).agg(F.max(F.struct("frame", "other")).alias("a"))  # one row
    fallback = rest.first()["a"]
    own = read.join(found.where(F.col("host") != ALL), "host", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = [extract(h, f, o, s) if isinstance(f, str) else extract(h, fallback and fallback["frame"], fallback and fallback["other"])
                    for h, f, o, s in zip(pdf["html"], pdf["frame"], pdf["other"], pdf["same"])]
            yield pd.DataFrame({"id": pdf["id"].astype("Int64"), "url": pdf["url"], "text": text})

    out = own.select(F.col("id").cast("long").alias("id"), "url", "html", "frame", "other", "same").mapInPandas(run, "id long, url string, text string")
    return out.select(F.col("id").alias(id), F.col("url").alias(url), "text")


def op3_main_text(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return main_text(pages).withColumn("n_chars", F.length("text").cast("long"))
