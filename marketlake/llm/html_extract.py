"""Main text of web pages: what a suffix array of the host's pages shows as repeated goes, unique runs stay."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import grams, ship, written

#: Words of the shortest run that counts as repeated.
RUN = 8
#: A run is boilerplate on more than this share of a host's different pages, and on so many at least: fewer cannot tell
#: a template from a quotation.
SHARE, LEAST = 0.5, 3
#: Characters of pages (on average) that one suffix array is made of; a larger host has several.
PART_CHARS = 1_000_000
#: Boilerplate runs, of 8 bytes each and their host, up to which they are sent to all tasks.
BROADCAST_RUNS = 200_000
_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][\w:-]*)([^>]*)>|<[!?][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HOST = re.compile(r"^\s*\w[\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")
#: Elements whose content is no text.
_RAW = {"script", "style", "title", "textarea", "template", "noscript", "iframe", "svg", "math", "object", "canvas", "select", "video", "audio"}
#: Of these, the ones that hide the rest of a page if they are not closed.
_TO_END = {"script", "style", "title", "textarea"}
_NOISE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "label", "head"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody",
    "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Words of a class, id or role that mark an element as something other than the article.
_NOISE_WORDS = {
    "ad", "ads", "adv", "advert", "advertisement", "adverts", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "complementary", "consent",
    "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
    "overlay", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "search", "share", "sharing", "sidebar", "signup", "skip", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
#: Of these, the ones that also say so of an article element, whose classes often name what it has beside its text.
_OTHER_ARTICLES = {"ad", "ads", "advert", "advertisement", "comment", "comments", "reply", "replies", "sponsored"}
#: What behind a noise word leaves a name's meaning as it is (sidebar-left); what before it says that the element only
#: goes with such a thing (layout with-sidebar); and what may have a header or widget of its own (section-header).
_BOXES = {
    "area", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "col", "column", "container", "content", "form", "group", "holder", "icons", "inner", "item", "items",
    "left", "link", "links", "list", "main", "module", "outer", "panel", "posts", "primary", "right", "section", "secondary", "slot", "stories", "text", "title", "top", "unit", "wrap", "wrapper",
}
_GOES_WITH = {"with", "without", "no", "not", "non", "has", "have", "is", "hide", "hidden", "show", "after", "before", "below", "above", "beside"}
_PARTS, _OWN = {"header", "widget"}, {"article", "body", "chapter", "content", "entry", "main", "post", "section", "story", "text"}


_HEADING, _HEADER_OF = re.compile("h[1-6]"), "header of "


@dataclass
class Block:
    """A block's text and where it stands: in an article, in the main element (or an article there), in noise, in what only
    its name calls noise (named), or open (nothing says)."""

    text: str
    zone: str


def _says(name: str, words: set[str]) -> bool:
    """Whether one class, id or role is one of the words: as a whole, or by its main part (its last word, or the first
    if only boxes and numbers follow)."""
    parts = [w for w in re.split(r"[^a-z0-9]+", name) if w]
    at = next((i for i, w in enumerate(parts) if w in _GOES_WITH), len(parts))
    parts = [w for w in parts[:at] if not w.isdigit()]
    while len(parts) > 1 and parts[-1] in _BOXES and parts[-1] not in words:
        parts.pop()
    if not parts or parts[-1] not in words:
        return False
    return not (parts[-1] in _PARTS and any(w in _OWN for w in parts[:-1]))


def _zone(name: str, attributes: str, outer: str) -> str:
    marks = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
    names = [w for k in ("class", "id", "role") for w in marks.get(k, "").split()]
    noise = _OTHER_ARTICLES if name == "article" else _NOISE_WORDS
    if outer.startswith(_HEADER_OF):  # the head of a story: its title belongs to the story
        return outer.removeprefix(_HEADER_OF) if _HEADING.fullmatch(name) else "noise" if name in _NOISE else outer
    if name == "header" and outer in ("article", "main article"):
        return _HEADER_OF + outer
    if name in _NOISE:
        return "form" if name == "form" and outer != "noise" else "noise"
    if outer == "noise":
        return outer
    if name not in ("html", "body", "main") and any(_says(w, noise) for w in names):
        # class words may be wrong about a wrapper, so an article below it counts, unless it stands in an article
        inside = outer in ("article", "main article") or any(_says(w, _OTHER_ARTICLES) for w in names)
        return "noise" if inside else "noise in main" if outer in ("main", "noise in main") else "noise by name"
    if name == "article" or marks.get("itemprop") == "articlebody":
        return "main article" if outer in ("main", "main article", "noise in main") else "article"
    if (name == "main" or marks.get("role") == "main") and outer not in ("article", "main article"):
        return "main"
    return outer


def blocks(page: str) -> list[Block]:
    """The blocks of text of a page in their order, character references decoded, white space made single spaces."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    zone, buffer, at, n = "open", [], 0, len(page)

    def flush() -> None:
        if buffer:
            text = " ".join("".join(map(html.unescape, buffer)).split())
            if text:
                out.append(Block(text, "named" if zone == "noise by name" else "noise" if zone in ("form", "noise in main") or zone.startswith(_HEADER_OF) else zone))
            buffer.clear()

    while at < n:
        tag = _MARKUP.search(page, at)
        if tag is None:
            buffer.append(page[at:])
            break
        buffer.append(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        closing = tag[1] or tag[4]
        if not closing and name in _RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n if name in _TO_END else at
            continue
        if name == "br":
            buffer.append(" ")
        elif name in _BLOCK:
            flush()
        attributes = tag[3] or tag[6] or ""
        if closing:
            if name in _BLOCK or name == "span":
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        flush()
                        del stack[i:]
                        break
        elif name in _BLOCK and name not in _VOID:
            while stack and stack[-1][0] in ("p", "span"):  # a block ends an open paragraph
                stack.pop()
            if name == "li" and stack and stack[-1][0] == "li":
                stack.pop()
            stack.append((name, _zone(name, attributes, stack[-1][1] if stack else "open")))
        elif name == "span" and _zone(name, attributes, "open") == "noise":
            flush()
            stack.append((name, "noise"))
        zone = stack[-1][1] if stack else "open"
    flush()
    return out


def roles(page: str | None) -> list[tuple[str, str, bool]]:
    """The blocks of a page: text, role and whether repeats of it count.

    Roles: "noise" by its own markup; "text", of which only boilerplate goes; "beside" a main element or article. What
    stands inside these does not count as repeated: articles quote each other, menus do not stand in them. A name alone
    makes noise only of a part of a page: where all other text is noise, the runs decide on what is named too.
    """
    found = blocks(page or "")
    only_named = all(b.zone in ("noise", "named") for b in found)
    found = [Block(b.text, "open" if only_named else "noise") if b.zone == "named" else b for b in found]
    zones = {b.zone for b in found}
    own = {"main", "main article"} if zones & {"main", "main article"} else {"article"} & zones
    role = {z: "noise" if z == "noise" else "beside" if own and z == "open" else "text" for z in zones}
    return [(b.text, role[b.zone], b.zone not in own) for b in found]


def sorted_suffixes(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of a sequence of numbers, by prefix doubling as far as the first `depth` of each suffix: the order
    of its suffixes, and the rank of each, which those share that begin with the same `depth` numbers.

    Which suffixes share `depth` numbers, and so every repeat of that length or more, does not depend on what follows.
    A suffix that is shorter counts as filled up with a number below all others.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    known = 1
    while known < depth:
        step = min(known, depth - known)
        behind = np.zeros_like(rank)
        behind[:-step] = rank[step:]
        rank = np.unique(rank * (len(tokens) + 2) + behind, return_inverse=True)[1].astype(np.int64) + 1
        known += step
    return np.argsort(rank, kind="stable"), rank


def _hashed(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def run_hashes(words: list[str]) -> np.ndarray:
    """A hash (int64) of each run of RUN words."""
    return grams(_hashed(words), RUN).view(np.int64)


def frequent_runs(streams: list[str], share: float = SHARE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of RUN words on more than share of the streams, and on how many each is.

    The streams are concatenated, a number of its own between any two, and their suffixes sorted; suffixes with one
    rank are a run's places.
    """
    each = [s.split(" ") for s in streams]
    text = pa.array([w for words in each for w in words], pa.large_string()).dictionary_encode()
    hashes = _hashed(text.dictionary.to_pylist())
    sizes = np.array([len(words) for words in each], dtype=np.int64)
    ends = np.cumsum(sizes) + np.arange(len(each))  # where the numbers between streams stand
    tokens = np.insert(text.indices.to_numpy().astype(np.int64), np.cumsum(sizes), len(hashes) + np.arange(len(each)))
    page = np.repeat(np.arange(len(each)), sizes + 1)
    order, rank = sorted_suffixes(tokens, RUN)
    order = order[order + RUN <= ends[page[order]]]  # runs that end in their stream
    if not len(order):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # places of one run stand side by side, by stream
    new_run = np.r_[True, np.diff(rank[order]) > 0]
    begins = np.flatnonzero(new_run)
    pages = np.add.reduceat(new_run | np.r_[True, np.diff(page[order]) > 0], begins, dtype=np.int64)
    kept = pages > share * len(each)
    at = order[begins[kept]]
    runs = np.array([grams(hashes[tokens[i : i + RUN]], RUN)[0] for i in at.tolist()], dtype=np.uint64)
    return runs.view(np.int64), pages[kept]


def without_runs(found: list[tuple[str, str]], boilerplate: np.ndarray) -> str:
    """The text of blocks (text, role) of a page without the boilerplate.

    Runs go over the borders of blocks, as menus are many short ones. A block that they cover goes; of any other
    only what a run inside it covers does, and its unique words stay. A block beside the text stays if it is long
    enough to be known as unique.
    """
    words = [t.split(" ") for t, _ in found]
    begins = np.isin(run_hashes([w for each in words for w in each]), boilerplate)
    n = sum(map(len, words))
    covered = _covered(begins, n)
    kept, at = [], 0
    for (text, role), own in zip(found, words):
        end = at + len(own)
        n_covered = int(covered[at:end].sum())
        if role == "beside" and (n_covered or len(own) < RUN) or role == "noise" or n_covered == len(own):
            text = ""
        elif n_covered:
            inside = _covered(begins[at : max(at, end - RUN + 1)], len(own))
            text = " ".join(w for w, c in zip(own, inside) if not c)
        if text:
            kept.append(text)
        at = end
    return "\n".join(kept)


def _covered(begins: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a run that begins at one of the marked."""
    steps = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(begins)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + RUN, -1)
    return np.cumsum(steps[:n]) > 0


def boilerplate_runs(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of found (host, key, stream; one row for each different page): the boilerplate runs (host, run), and the hosts
    that have LEAST pages (host, n_pages, parts).

    A large host is dealt into parts of bounded size, each with a suffix array of its own. A run on more than SHARE of
    all pages is on more than SHARE of some part's, so what is frequent in a part is all that can be; those runs are
    then counted in every part, which makes the counts exact.
    """
    sizes = found.groupBy("host").agg(F.count("*").alias("n_pages"), F.ceil(F.sum(F.length("stream").cast("long")) / PART_CHARS).alias("parts"))
    hosts = written(sizes.where(F.col("n_pages") >= LEAST).withColumn("parts", F.greatest(F.col("parts"), F.lit(1)).cast("int")), "hosts")
    # dealt by part explicitly: after a join by host Spark would leave a host's parts together
    dealt = found.join(hosts, "host").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).repartition("host", "part")

    def frequent(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        runs, pages = frequent_runs(pdf["stream"].tolist())
        return pd.DataFrame({"host": key[0], "run": runs, "pages": pages})

    def counted(key: tuple, pdf: pd.DataFrame, runs: pd.DataFrame) -> pd.DataFrame:
        wanted = runs["run"].to_numpy()
        here = [np.unique(h[np.isin(h, wanted)]) for h in (run_hashes(s.split(" ")) for s in pdf["stream"])]
        run, pages = np.unique(np.concatenate(here) if here else np.empty(0, np.int64), return_counts=True)
        return pd.DataFrame({"host": key[0], "run": run, "pages": pages})

    schema = "host string, run bigint, pages bigint"
    known = written(dealt.groupBy("host", "part").applyInPandas(frequent, schema).join(hosts, "host"), "frequent")
    several = known.where("parts > 1").select("host", "run", "parts").distinct()
    asked = several.select("host", "run", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    again = dealt.where("parts > 1").groupBy("host", "part").cogroup(asked.groupBy("host", "part")).applyInPandas(counted, schema)
    sums = again.groupBy("host", "run").agg(F.sum("pages").alias("pages")).join(hosts, "host")
    exact = known.where("parts = 1").select("host", "run", "pages", "n_pages").union(sums.select("host", "run", "pages", "n_pages"))
    return exact.where((F.col("pages") >= LEAST) & (F.col("pages") > F.col("n_pages") * SHARE)).select("host", "run"), hosts


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages (page_id, url, html); other columns are ignored.

    Blocks that say themselves what they are (menus, headers, footers, sidebars, notices, adverts, forms, comments;
    by element, or by the words of class, id and role) are no text, nor are scripts and styles. Of all others, the
    host's pages decide: their token streams are concatenated and the suffixes sorted; runs of RUN words or more that
    stand on more than SHARE of the host's different pages (LEAST at least) are boilerplate and taken out wherever
    they stand, unique runs are kept. A main element or article tells two things more: what repeats inside it is no
    sign of boilerplate, and blocks beside it are kept only where the host's pages show them to be unique.

    A host with a third of all pages is dealt into parts of about PART_CHARS. Pages are only shuffled for their suffix
    arrays, one of each kind and what counts of it; runs come to the pages, up to BROADCAST_RUNS of them in all.

    Defined cases: null and empty html give an empty text; pages of a host with the same blocks are one page, so that
    copies do not make each other boilerplate; a null or broken url is a host of its own name ""; repeated rows are
    each returned, null ids too.
    """
    ship(pages.sparkSession)
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for begin in range(0, len(pdf), 512):
                part = pdf.iloc[begin : begin + 512]
                rows = []
                for url, page in zip(part["url"], part["html"]):
                    found = roles(page if isinstance(page, str) else None)
                    host = _HOST.match(url) if isinstance(url, str) else None
                    key = xxhash.xxh64_intdigest("\n".join(t for t, _, _ in found)) - (1 << 63)
                    rows.append((host[1].lower() if host else "", key, [{"text": t, "role": r, "counts": c} for t, r, c in found]))
                out = pd.DataFrame(rows, columns=["host", "key", "blocks"])
                out.insert(0, "page_id", part["page_id"].astype("Int64").to_numpy())
                out.insert(1, "url", part["url"].to_numpy())
                yield out

    schema = "page_id bigint, url string, host string, key bigint, blocks array<struct<text:string,role:string,counts:boolean>>"
    found = written(slim.mapInPandas(parse, schema).withColumn("row", F.monotonically_increasing_id()), "pages")
    stream = F.array_join(F.transform(F.filter("blocks", lambda b: b["counts"]), lambda b: b["text"]), " ")
    streams = written(found.select("host", "key", stream.alias("stream")).groupBy("host", "key").agg(F.first("stream").alias("stream")), "streams")
    runs, hosts = boilerplate_runs(streams)
    runs = written(runs, "boilerplate")

    marked = runs.select("host").distinct().withColumn("cut", F.lit(True))
    # written, so that its size is known before pages are joined: Spark broadcasts it up to its threshold
    all_pages = found.join(written(hosts.join(marked, "host", "left"), "marked"), "host", "left")
    whole = all_pages.where(F.col("cut").isNull()).select("page_id", "url", _text(F.col("n_pages") >= LEAST).alias("text"))
    to_cut = all_pages.where("cut")
    rest = _cut_here(to_cut, runs) if runs.count() <= BROADCAST_RUNS else _cut_by_part(to_cut, runs.join(hosts, "host"))
    return whole.union(rest).withColumn("n_chars", F.length("text").cast("long"))


def _cut_here(pages: DataFrame, runs: DataFrame) -> DataFrame:
    """page_id, url and text without the runs, which are sent to all tasks; pages stay where they are."""
    sent = pages.sparkSession.sparkContext.broadcast({r["host"]: np.sort(np.array(r["runs"], np.int64)) for r in runs.groupBy("host").agg(F.collect_list("run").alias("runs")).collect()})

    @F.pandas_udf("string")
    def cut(host: pd.Series, blocks: pd.Series) -> pd.Series:
        return pd.Series([without_runs([(b["text"], b["role"]) for b in each], sent.value[h]) for h, each in zip(host, blocks)], dtype=object)

    return pages.select("page_id", "url", cut("host", "blocks").alias("text"))


def _cut_by_part(pages: DataFrame, runs: DataFrame) -> DataFrame:
    """The same with pages dealt out by host and part, each part with its host's runs (host, run, parts)."""

    def cut(key: tuple, pdf: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        boilerplate = own["run"].to_numpy()
        text = [without_runs([(b["text"], b["role"]) for b in each], boilerplate) for each in pdf["blocks"]]
        return pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"].astype(object), "text": pd.Series(text, pdf.index, dtype=object)})

    dealt = pages.select("page_id", "url", "blocks", "host", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("part")).repartition("host", "part")
    asked = runs.select("host", "run", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return dealt.groupBy("host", "part").cogroup(asked.groupBy("host", "part")).applyInPandas(cut, "page_id bigint, url string, text string")


def _text(compared: Column) -> Column:
    """Text of a page whose host has no boilerplate; blocks beside it if the host's pages were compared."""
    unique = lambda b: (b["role"] == "beside") & F.coalesce(compared, F.lit(False)) & (F.size(F.split(b["text"], " ")) >= RUN)
    return F.array_join(F.transform(F.filter("blocks", lambda b: (b["role"] == "text") | unique(b)), lambda b: b["text"]), "\n")
