"""Main text of web pages: templates deduced from tokens that occur alike on the pages of a host, text from their slots."""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, fields, in_arrow, made, slices

#: Fixed values of HTML: elements without an end, with text that isn't markup, that stand in a line, and the ends that a start implies.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object select option button".split())
#: Of these the elements whose text is never markup. Without an end tag, script and style go on to the end of the page; the others are read like any element, which ends with its parent.
PLAIN = frozenset("script style textarea title iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {
    "p": frozenset(["p"]),
    "li": frozenset(["li", "p"]),
    "dt": frozenset(["dt", "dd", "p"]),
    "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]),
    "td": frozenset(["td", "th", "p"]),
    "th": frozenset(["td", "th", "p"]),
}
SCOPES = frozenset("body article main section div aside nav header footer table ul ol dl blockquote figure form".split())
ASIDE = frozenset("nav footer aside form head menu dialog".split()) | RAW
#: Whole class names, ids and roles that label a template's slot as what the article is without.
KINDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus_thread footer header masthead menu modal nav navbar navigation newsletter notice notification pagination "
    "popup promo promoted related replies respond share sharing sidebar social sponsor sponsored subscribe widget".split()
)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"'/]|/(?!>)|\"[^\"]*\"|'[^']*')*)(/?)>|<[!?/][^>]*>", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
LETTERS = re.compile(r"[^a-z_]+")
#: What this share of a host's pages (of different ones, three at least) has is part of the template: a token, or a text at one place.
REPEATED = 0.5
#: Bytes of all templates up to which they are broadcast.
BROADCAST_BYTES = 64 << 20


class Page:
    """tokens: each path of elements that opens, with how often, in order of first places; blocks: (path, text, characters in links), in order.
    A name on a path is the tag and its whole class names, ids and roles, without digits."""

    def __init__(self, source: str) -> None:
        self.tokens: Counter[str] = Counter()
        self.blocks: list[tuple[str, str, int]] = []
        self._open: list[tuple[str, str]] = []
        self._text: list[tuple[str, bool]] = []
        self._at = ""
        at, end = 0, len(source)
        while at < end:
            m = TOKEN.search(source, at)
            self._say(source[at : m.start() if m else end])
            if not m:
                break
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                self._close(tag)
                continue
            self._start(tag, m[3])
            if tag in RAW and m[4]:
                self._close(tag)
            elif tag in PLAIN:
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                if stop or tag in ("script", "style"):
                    at = stop.end() if stop else end
                    self._close(tag)
        self._flush()

    def _say(self, text: str) -> None:
        if text:
            self._text.append((text, any(t == "a" for t, _ in self._open)))

    def _path(self) -> str:
        return "/".join(n for t, n in self._open if t not in INLINE)

    def _flush(self) -> None:
        text = " ".join(html.unescape("".join(t for t, _ in self._text)).split())
        if text:
            self.blocks.append((self._at, text, sum(len(t) for t, link in self._text if link)))
        self._text, self._at = [], self._path()

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag == "wbr" or tag == "img":
            self._text.append((" ", False))
        if tag not in INLINE:
            self._flush()
            closes = CLOSES.get(tag, frozenset(["p"]) if tag not in VOID else frozenset())
            for k in range(len(self._open) - 1, -1, -1):
                if self._open[k][0] in closes:
                    del self._open[k:]
                    closes = closes if tag in ("tr", "li", "dd", "dt", "td", "th") else frozenset()
                elif self._open[k][0] in SCOPES:
                    break
        if tag in VOID:
            return
        named: dict[str, str] = {}
        for a, b, c, d in ATTRIBUTE.findall(attributes):
            named.setdefault(a.lower(), (b or c or d or "").lower())
        # the word hidden stands for the attribute only
        words = {LETTERS.sub("-", w).strip("-") for k in ("class", "id", "role") for w in named.get(k, "").split()} - {"", "hidden"}
        words = sorted(words | ({"hidden"} if "hidden" in named else set()))
        self._open.append((tag, ".".join([tag, *words])))
        if tag not in INLINE:
            self._at = self._path()
            self.tokens[self._at] += 1

    def _close(self, tag: str) -> None:
        for k in range(len(self._open) - 1, -1, -1):
            if self._open[k][0] == tag:
                if tag not in INLINE:
                    self._flush()
                del self._open[k:]
                if tag not in INLINE:
                    self._at = self._path()
                return
            if tag in INLINE and self._open[k][0] not in INLINE:
                return  # an inline element doesn't end beyond its block


@functools.lru_cache(maxsize=100_000)
def outside(path: str, root: str) -> bool:
    """Whether a path at or below root leads through an element that HTML says isn't the article's, or that is hidden."""
    in_article = any(n.split(".")[0] in ("article", "main") for n in root.split("/"))
    for name in path[len(root) :].strip("/").split("/"):
        tag, *words = name.split(".")
        if tag in ASIDE or "hidden" in words or tag == "header" and not in_article:
            return True
        in_article |= tag in ("article", "main")
    return False


def labelled(path: str) -> bool:
    """Whether the last element of a path names itself as one of KINDS."""
    tag, *words = path.rpartition("/")[2].split(".")
    return tag not in ("html", "body", "article", "main") and not KINDS.isdisjoint(words)


def ancestors(path: str) -> Iterator[str]:
    """A path and those above it, from the longest."""
    while path:
        yield path
        path = path.rpartition("/")[0]


def roots_of(stats: list[tuple[str, float]]) -> str:
    """The container of the article among (path, characters of text outside links and furniture): an article or main element if one
    holds most text of them all, else the deepest container with most of it."""
    total: Counter[str] = Counter()
    for path, chars in stats:
        parts = path.split("/")
        for k in range(1, len(parts) + 1):
            total["/".join(parts[:k])] += chars
    if not total:
        return ""
    named = [p for p in total if p.rpartition("/")[2].split(".")[0] in ("article", "main") and total[p] > 0]
    if named:
        return max(named, key=lambda p: (total[p], p.count("/"), p))
    most = max(total.values())
    return max((p for p in total if total[p] >= 0.7 * most and p.rpartition("/")[2].split(".")[0] in SCOPES), key=lambda p: (p.count("/"), total[p], p), default="")


HOST = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:@]*)")


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else ""


def mark(path: str, text: str) -> int:
    """The number of a text at its place."""
    return xxhash.xxh3_64_intdigest(f"{path}\n{text}".encode()) >> 1


def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each host and token of a partition: pages, occurrences, the most on a page, two fingerprints of the occurrence vector (sums
    over pages of occurrences times a number of 30 bits drawn for the page), the sum of its places among the page's tokens, and characters outside and in links; for texts
    likewise, one token for each path, text and different page (page: digest of its source), and one with text -1 for the page."""
    held: dict[tuple[str, str, int, int], list[int]] = {}
    for sources, rows in slices(batches, "html"):
        for url, source in zip(rows.column("url").to_pylist(), sources):
            page, host = Page(source), host_of(url)
            drawn = xxhash.xxh3_128_intdigest(f"{url}\n{source}".encode())
            one, two = drawn & 0x3FFFFFFF, drawn >> 64 & 0x3FFFFFFF
            chars: dict[str, list[int]] = {}
            texts: Counter[tuple[str, int]] = Counter()
            for path, text, links in page.blocks:
                x = chars.setdefault(path, [0, 0])
                x[0] += max(0, len(text) - links)
                x[1] += min(len(text), links)
                texts[path, mark(path, text)] += 1
            digest = xxhash.xxh3_64_intdigest(source.encode()) >> 1
            for place, (path, n) in enumerate(page.tokens.items()):
                x = held.setdefault((host, path, 0, 0), [0] * 8)
                x[0] += 1
                x[1] += n
                x[2] = max(x[2], n)
                x[3] += n * one
                x[4] += n * two
                x[5] += place
                if path in chars:
                    x[6] += chars[path][0]
                    x[7] += chars[path][1]
            for (path, text), n in [*texts.items(), (("", -1), 1)]:
                x = held.setdefault((host, path, text, digest), [0] * 8)
                x[0] += 1
                x[1] += n
            if len(held) > 100_000:
                yield counted(held)
                held = {}
    yield counted(held)


def counted(held: dict[tuple[str, str, int, int], list[int]]) -> pa.RecordBatch:
    keys, values = [*zip(*held)] or [()] * 4, [*zip(*held.values())] or [()] * 8
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
    columns = {n: pa.array(v, k) for n, v, k in zip(("host", "path", "text", "page"), keys, kinds)}
    return made(**columns, **{n: pa.array(v, pa.int64()) for n, v in zip(COUNTS, values)})


COUNTS = ("pages", "n", "most", "one", "two", "places", "chars", "links")


@dataclass
class Template:
    """root: the article's container; order: tokens that stand once on a page, in the order of their places; dropped: slots below root that
    aren't the article's."""

    root: str
    order: list[str]
    dropped: list[str]


def deduce(tokens: list[dict], rows: int) -> Template | None:
    """The template of a host of so many pages, from its tokens (path, pages, n, most, one, two, places, chars, links) on REPEATED of them or more.

    Tokens with equal occurrence vectors are an equivalence class. A class is valid if it nests: all its topmost tokens hang below one token
    of a valid class (or stand at the top), so that it fills one slot of that. Classes are taken from the top of the page down. The valid
    class of tokens that stand once on every page of theirs is the skeleton; each token of a valid class opens a slot, whose text is what stands at
    it or below it, but not below another. The root is the article or main element of the skeleton with most text outside links, else the deepest of
    the skeleton with REPEATED of its host's text and more than any beside it. Below it go the slots that label themselves as one of KINDS and those whose text is mostly links.
    """
    classes: dict[tuple[int, int, int], list[dict]] = {}
    for t in tokens:
        if t["pages"] >= REPEATED * rows:
            classes.setdefault((t["one"], t["two"], t["n"]), []).append(t)
    valid: dict[str, dict] = {}
    for held in sorted(classes.values(), key=lambda c: min((t["path"].count("/"), t["path"]) for t in c)):
        mine = {t["path"] for t in held}
        tops = [p for p in mine if not any(q in mine for q in ancestors(p.rpartition("/")[0]))]
        parents = {next((q for q in ancestors(p.rpartition("/")[0]) if q in valid), "") for p in tops}
        if len(parents) == 1:
            valid |= {t["path"]: t for t in held}
    skeleton = {p for p, t in valid.items() if t["most"] == 1}
    if not skeleton:
        return None
    slot = lambda path: next((q for q in ancestors(path) if q in valid), "")
    chars, links, below = Counter(), Counter(), Counter()
    for t in tokens:
        if outside(t["path"], "") or any(labelled(q) for q in ancestors(t["path"]) if q in valid):
            continue
        chars[slot(t["path"])] += t["chars"]
        links[slot(t["path"])] += t["links"]
    for path, n in chars.items():
        for q in ancestors(path):
            below[q] += n
    frames = [p for p in skeleton if p.rpartition("/")[2].split(".")[0] in SCOPES and below[p]]
    named = [p for p in frames if p.rpartition("/")[2].split(".")[0] in ("article", "main")]
    if named:
        root = max(named, key=lambda p: (below[p], p.count("/"), p))
    else:
        most = max((below[p] for p in frames), default=0)
        root = max((p for p in frames if below[p] >= 0.7 * most), key=lambda p: (p.count("/"), below[p], p), default="")
    if not root:
        return None
    inner = [p for p in valid if p.startswith(root + "/")]
    linked, plain = Counter(), Counter()
    for t in tokens:
        for q in ancestors(t["path"]):
            if q in valid and q != root:
                linked[q] += t["links"]
                plain[q] += t["chars"]
    dropped = [p for p in inner if labelled(p) or linked[p] > plain[p] and p.rpartition("/")[2].split(".")[0] in MENUS]
    order = sorted(skeleton, key=lambda p: (valid[p]["places"] / valid[p]["pages"], p))
    return Template(root, order, sorted(dropped))


#: Elements that make up menus where links are most of their text.
MENUS = frozenset("div section ul ol dl table aside nav".split())


def templates(pages: DataFrame) -> DataFrame:
    """For each host with three different pages or more its template, as deduce() says, and the texts (repeated) that REPEATED of its different
    pages have at one place. All pages count; of a host only what stands on half of its pages is gathered, which is at most twice what a page has."""
    numbers = ", ".join(f"{c} long" for c in COUNTS)
    stats = in_arrow(pages, occurrences, f"host string, path string, text long, page long, {numbers}")
    stats = stats.groupBy("host", "path", "text", "page").agg(*((F.max if c == "most" else F.sum)(c).alias(c) for c in COUNTS))
    stats = durable(stats, "occurrences")
    # copies of a page are one page where texts are counted
    size = stats.where("text = -1").groupBy("host").agg(F.count("*").alias("whole"), F.sum("pages").alias("rows")).where("whole >= 3")
    # tokens that are rarer give their text to the slot above them
    joined = stats.where("text = 0").join(size, "host").withColumn("often", F.col("pages") >= REPEATED * F.col("rows"))
    frequent = joined.where("often").select("host", "rows", "path", *COUNTS)
    above = F.expr("transform(sequence(1, size(split(path, '/')) - 1), k -> array_join(slice(split(path, '/'), 1, k), '/'))")
    rare = joined.where("NOT often AND chars + links > 0 AND path LIKE '%/%'").select("host", "chars", "links", F.col("path").alias("own"), F.posexplode(above).alias("at", "path"))
    held = rare.join(frequent.select("host", "path"), ["host", "path"]).groupBy("host", "own").agg(F.max_by(F.struct("path", "chars", "links"), "at").alias("x"))
    held = held.groupBy("host", "x.path").agg(F.sum("x.chars").alias("more"), F.sum("x.links").alias("more_links"))
    frequent = frequent.join(held, ["host", "path"], "left").withColumns({"chars": F.expr("chars + coalesce(more, 0)"), "links": F.expr("links + coalesce(more_links, 0)")})
    tokens = frequent.groupBy("host", "rows").agg(F.array_sort(F.collect_list(F.struct("path", *COUNTS))).alias("tokens"))

    def deduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [deduce(t, n) for t, n in zip(batch.column("tokens").to_pylist(), batch.column("rows").to_pylist())]
            texts = pa.list_(pa.string())
            yield made(
                host=batch.column("host"),
                root=pa.array([t.root if t else None for t in found], pa.string()),
                order=pa.array([t.order if t else None for t in found], texts),
                dropped=pa.array([t.dropped if t else None for t in found], texts),
            )

    found = in_arrow(tokens, deduced, "host string, root string, order array<string>, dropped array<string>").where("root IS NOT NULL")
    shared = stats.where("text > 0").groupBy("host", "path", "text").agg(F.count("*").alias("pages")).where("pages >= 3")
    shared = shared.join(size, "host").where(f"pages >= {REPEATED} * whole").groupBy("host").agg(F.collect_list("text").alias("repeated"))
    return durable(found.join(shared, "host", "left").select("host", "root", "order", "dropped", F.coalesce("repeated", F.array().cast("array<bigint>")).alias("repeated")), "templates")


def fits(page: Page, template: Template) -> bool:
    """Whether a page has the root once and the skeleton's tokens, as far as it has them, once each and in the template's order (ancestors first where
    places tie): else it is another kind of page."""
    if page.tokens.get(template.root) != 1:
        return False
    place = {path: k for k, path in enumerate(page.tokens)}
    mine = [place[p] for p in template.order if p in place]
    return 2 * len(mine) >= len(template.order) and all(a < b for a, b in zip(mine, mine[1:]))


def main_text(source: str, template: Template | None = None, repeated: frozenset[int] = frozenset()) -> str:
    """The article's blocks, joined by two newlines: those in the slots that the template leaves below its root. A page that doesn't fit its host's
    template, or has no text there, is judged alone, by the elements of HTML and the deepest container of most text. Repeated
    texts are left out at their places below root, but never at the place with most text outside links, or below it."""
    page = Page(source)
    if template and fits(page, template):
        root, dropped = template.root, frozenset(template.dropped)
        kept = [x for x in page.blocks if (x[0] == root or x[0].startswith(root + "/")) and not outside(x[0], root) and dropped.isdisjoint(ancestors(x[0]))]
        if repeated and kept and root.rpartition("/")[2].split(".")[0] not in ("article", "main"):
            chars: Counter[str] = Counter()
            for path, text, links in kept:
                chars[path] += max(0, len(text) - links)
            slot = max(chars, key=lambda p: (chars[p], p))
            kept = [x for x in kept if x[0] == slot or x[0].startswith(slot + "/") or mark(x[0], x[1]) not in repeated]
        if kept:
            return "\n\n".join(text for _, text, _ in kept)
    hidden = lambda path, root: outside(path, root) or any(labelled(p) for p in ancestors(path) if len(p) > len(root))
    root = roots_of([(p, float(max(0, len(t) - links))) for p, t, links in page.blocks if not hidden(p, "")])
    return "\n\n".join(t for p, t, _ in page.blocks if (not root or p == root or p.startswith(root + "/")) and not hidden(p, root))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) as page_id, url, text and n_chars (code points, long).

    A null or empty page has an empty text; a null or broken url belongs to the host "". Repeated pages get equal texts; ids of any type are handed
    on as they are. Templates come from all pages of a host; up to BROADCAST_BYTES of them are broadcast, more are joined by host, where a hot host's
    pages may be split, as its template is one row. Nothing inside the article is dropped or capped. Other columns are left out.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    found = templates(rows.select("url", "html"))
    size = found.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
    found = F.broadcast(found) if size <= BROADCAST_BYTES else found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for sources, part in slices(batches, "html"):
            texts = []
            for k, (source, host) in enumerate(zip(sources, part.column("host").to_pylist())):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    root, order, dropped, repeated = (part.column(c)[k].as_py() for c in ("root", "order", "dropped", "repeated"))
                    known[host] = (Template(root, order, dropped), frozenset(repeated)) if root else ()
                texts.append(main_text(source, *known[host]))
            yield made(page_id=part.column("page_id"), url=part.column("url"), text=pa.array(texts, pa.string()), n_chars=pa.array([len(t) for t in texts], pa.int64()))

    host = F.coalesce(F.lower(F.regexp_extract("url", "^" + HOST.pattern, 1)), F.lit(""))
    joined = rows.withColumn("host", host).join(found, "host", "left").select("page_id", "url", "html", "host", "root", "order", "dropped", "repeated")
    return in_arrow(joined, run, fields(rows, "page_id", "url") + ", text string, n_chars long")
