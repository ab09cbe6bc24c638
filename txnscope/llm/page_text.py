"""Main text of web pages by equivalence classes of tokens across the pages of a host.

Pages of one host come from one template, and a template's tokens occur together: those
with equal occurrence vectors over the host's pages form a class (Arasu and
Garcia-Molina, "Extracting structured data from web pages", 2003).  A class counts when
it is large and frequent, its tokens keep one order on the pages, and its spans nest in
those of other classes without crossing.  The valid classes, nested, are the template;
what stands between their tokens are the slots, and the article is read from these.

* A token is a tag with its class, id and role, or the text of a whole block, each with the names of the elements around it.
* The vectors are never built: a token carries the xor, over the host's distinct pages, of a hash of (page, count), with
  the number of pages and of occurrences.  Equal vectors have equal marks.  Marks are added up in the tasks first, and pages
  of equal bytes count once, so a host that shows one page many times does not pass it off as a template.
* Elements that the standard or their class names set apart (menus, headers, forms, comments ...) are never read.  Where a page
  has an article or main element, its slots are read, else the slots in which the host's pages have their prose.

Token tables hold eight bytes a token; pages themselves are not shuffled unless templates outgrow a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.llm.html_blocks import MAIN, PLAIN, Block, page_blocks
from txnscope.llm.tables import relaxed
from txnscope.llm.vectors import Scratch
from txnscope.llm.words import mix

#: a host with fewer distinct pages has no template
LEAST_PAGES = 8
#: a class is frequent on at least this share of the host's pages, and large with at least so many tokens
SHARE, LEAST_TOKENS = 0.5, 3
#: share of the pages on which a class may be out of order or cross another
CROSSED = 0.1
#: text inside an article is the template's only if nearly every page has it
FIXED_SHARE = 0.95
#: share of the host's prose that makes a slot part of the article on pages without an article element
SLOT_SHARE = 0.1
#: templates up to so many tokens (eight bytes each) are broadcast
BROADCAST_TOKENS = 2_000_000

_GAPS = 1 << 20
_HOST = r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/:?#\s]+)"


class Template:
    """Valid classes of one host: place of every token, and what is read."""

    def __init__(self, pages: int, classes: list[dict], slots: list[int] | None):
        self.places = {t: (c, r) for c, one in enumerate(classes) for r, t in enumerate(one["tokens"])}
        self.sizes = [len(one["tokens"]) for one in classes]
        self.fixed = [one["support"] >= FIXED_SHARE * pages for one in classes]
        self.slots = frozenset(slots or ())

    def read(self, tokens: list[int]) -> tuple[dict[int, int], dict[int, int], set[int]]:
        """(matched, slot, crossed): class of every template token by its place, slot of every other place, and
        the classes that are out of order or cross another on this page.  Classes come by falling support."""
        matched: dict[int, int] = {}
        slot: dict[int, int] = {}
        crossed: set[int] = set()
        open_: list[list[int]] = []  # class, rank of its last token
        for at, token in enumerate(tokens):
            place = self.places.get(token)
            if place is None:
                slot[at] = open_[-1][0] * _GAPS + open_[-1][1] if open_ else -1
                continue
            c, rank = place
            if rank == 0:
                if any(o[0] == c for o in open_):
                    crossed.add(c)
                    continue
                open_.append([c, 0])
            else:
                deep = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == c), None)
                if deep is None or open_[deep][1] != rank - 1:
                    crossed.add(c)
                    continue
                over = [o[0] for o in open_[deep + 1:]]
                if over and min(over) < c:  # a more frequent class is open inside: this one crosses it
                    crossed.add(c)
                    continue
                crossed.update(over)
                del open_[deep + 1:]
                open_[deep][1] = rank
            matched[at] = c
            if open_[-1][1] == self.sizes[c] - 1:
                open_.pop()
        crossed.update(o[0] for o in open_)
        return matched, slot, crossed


def article(page: str | None, template: Template | None) -> str:
    """Blocks of the article, joined by two line feeds."""
    tokens, blocks = page_blocks(page)
    if not blocks:
        return ""
    matched, slot = {}, {}
    if template:
        matched, slot, crossed = template.read([_signed(t) for t in tokens])
        matched = {at: c for at, c in matched.items() if c not in crossed}
    zone = max(b.zone for b in blocks.values())

    def wanted(at: int, block: Block) -> bool:
        if block.zone != zone or zone < PLAIN:
            return False
        if zone >= MAIN:
            return not (at in matched and template.fixed[matched[at]])
        if at in matched:
            return False
        if template and template.slots and not block.heading:
            return slot.get(at, -1) in template.slots
        return block.prose

    return "\n\n".join(b.text for at, b in blocks.items() if wanted(at, b))


def _signed(token: int) -> int:
    return token - (1 << 64) if token >> 63 else token


def _host(url_col: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url_col}`"), F.lit("")), _HOST, 1))


def _parsed(df: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """Distinct pages of each host: host, page (hash of the bytes), tokens, sizes (characters of blocks, negative for what
    is not prose; 0 for tags)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, sizes = [], []
            for cell in batch.column("html"):
                found, blocks = page_blocks(cell.as_py())
                size = np.zeros(len(found), dtype=np.int32)
                for at, b in blocks.items():
                    size[at] = len(b.text) if b.prose else -len(b.text)
                tokens.append(np.array(found, dtype=np.uint64).view(np.int64))
                sizes.append(size)
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("page"), pa.array(tokens, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))],
                                             names=["host", "page", "tokens", "sizes"])

    source = df.where(F.col(f"`{html_col}`").isNotNull()).select(_host(url_col).alias("host"), F.xxhash64(F.col(f"`{html_col}`")).alias("page"),
                                                                 F.col(f"`{html_col}`").alias("html"))
    parsed = source.mapInArrow(parse, "host string, page long, tokens array<long>, sizes array<int>")
    return parsed.groupBy("host", "page").agg(F.first("tokens").alias("tokens"), F.first("sizes").alias("sizes"))


def _marks(pages: DataFrame) -> DataFrame:
    """(host, token, mark, support, total, first): the mark of the occurrence vector, the pages and occurrences behind it, and
    the token's first place on the page with the smallest hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = batch.column("host").dictionary_encode()
            lists = batch.column("tokens")
            lengths = np.diff(lists.offsets.to_numpy())
            page = np.repeat(batch.column("page").to_numpy(), lengths)
            row = np.repeat(np.arange(batch.num_rows), lengths)
            host = np.repeat(hosts.indices.to_numpy(), lengths)
            token = lists.flatten().to_numpy()
            place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            if not len(token):
                continue
            order = np.lexsort((place, token, row))
            row, token, page, host, place = row[order], token[order], page[order], host[order], place[order]
            new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (token[1:] != token[:-1])])
            times = np.diff(np.r_[new, len(row)])
            token, page, host, place = token[new], page[new], host[new], place[new]
            with np.errstate(over="ignore"):
                mark = mix(page.view(np.uint64) ^ mix(times.astype(np.uint64))).view(np.int64)
            order = np.lexsort((page, token, host))
            token, page, host, place, mark, times = (a[order] for a in (token, page, host, place, mark, times))
            new = np.flatnonzero(np.r_[True, (host[1:] != host[:-1]) | (token[1:] != token[:-1])])
            yield pa.RecordBatch.from_arrays([hosts.dictionary.take(pa.array(host[new])), pa.array(token[new]), pa.array(np.bitwise_xor.reduceat(mark, new)),
                                              pa.array(np.diff(np.r_[new, len(token)])), pa.array(np.add.reduceat(times, new)),
                                              pa.array(page[new]), pa.array(place[new].astype(np.int32))],
                                             names=["host", "token", "mark", "support", "total", "page", "place"])

    parts = pages.select("host", "page", "tokens").mapInArrow(count, "host string, token long, mark long, support long, total long, page long, place int")
    return parts.groupBy("host", "token").agg(F.bit_xor("mark").alias("mark"), F.sum("support").alias("support"), F.sum("total").alias("total"),
                                              F.min(F.struct("page", "place")).alias("first"))


def _classes(pages: DataFrame) -> DataFrame:
    """(host, pages, classes): large and frequent classes by falling support, each with its tokens in order."""
    hosts = pages.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    frequent = _marks(pages).where(F.col("support") >= LEAST_PAGES).join(hosts, "host").where(F.col("support") >= SHARE * F.col("pages"))
    classes = (frequent.groupBy("host", "pages", "mark", "support", "total")
               .agg(F.sort_array(F.collect_list(F.struct(F.col("first.place").alias("place"), "token"))).alias("members"))
               .where(F.size("members") >= LEAST_TOKENS))
    one = F.struct((-F.col("support")).alias("rank"), F.col("members.place").alias("places"), "support", F.col("members.token").alias("tokens"))
    return classes.groupBy("host", "pages").agg(F.sort_array(F.collect_list(one)).alias("classes"))


def _attached(df: DataFrame, templates: DataFrame) -> DataFrame:
    """``df`` with its host's template: broadcast within a measured size, else by a join that Spark divides where a host is hot."""
    tokens = templates.agg(F.sum(F.aggregate("classes", F.lit(0), lambda n, c: n + 4 + F.size(c["tokens"])))).first()[0] or 0
    right = templates.withColumnRenamed("host", "template_host")
    if tokens <= BROADCAST_TOKENS:
        right = F.broadcast(right)
    return df.join(right, F.col("host") == F.col("template_host"), "left").drop("template_host")


def _templates_of(batch: pa.RecordBatch) -> Iterator[Template | None]:
    """The template of every row; one object a host."""
    made: dict[str, Template | None] = {}
    for i, host in enumerate(batch.column("host").to_pylist()):
        if host not in made:
            classes = batch.column("classes")[i].as_py()
            slots = batch.column("slots")[i].as_py() if "slots" in batch.schema.names else None
            made[host] = Template(batch.column("pages")[i].as_py(), classes, slots) if classes else None
        yield made[host]


def _valid(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """Templates with the classes that are in order and nested on nearly all pages that have them."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[str, int], list[int]] = {}
            hosts = batch.column("host").to_pylist()
            for i, template in enumerate(_templates_of(batch)):
                if template is None:
                    continue
                matched, _, crossed = template.read(batch.column("tokens")[i].as_py())
                for c in crossed | set(matched.values()):
                    n = seen.setdefault((hosts[i], c), [0, 0])
                    n[0] += 1
                    n[1] += c in crossed
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int32()),
                                              pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.int64())],
                                             names=["host", "at", "n", "bad"])

    attached = _attached(pages.select("host", "tokens"), templates)
    counts = attached.mapInArrow(judge, "host string, at int, n long, bad long").groupBy("host", "at").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    bad = counts.where(F.col("bad") > CROSSED * F.col("n")).groupBy("host").agg(F.collect_list("at").alias("bad"))
    joined = templates.join(bad, "host", "left")
    kept = F.filter("classes", lambda c, i: F.col("bad").isNull() | ~F.array_contains(F.col("bad"), i))
    return joined.select("host", "pages", kept.alias("classes"))


def _slots(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """Templates with the slots that hold the host's prose."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars: dict[tuple[str, int], list[int]] = {}
            hosts = batch.column("host").to_pylist()
            for i, template in enumerate(_templates_of(batch)):
                if template is None:
                    continue
                sizes = batch.column("sizes")[i].as_py()
                _, slot, _ = template.read(batch.column("tokens")[i].as_py())
                for at, place in slot.items():
                    if sizes[at]:
                        n = chars.setdefault((hosts[i], place), [0, 0])
                        n[0] += max(sizes[at], 0)
                        n[1] += abs(sizes[at])
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in chars], pa.string()), pa.array([k[1] for k in chars], pa.int64()),
                                              pa.array([v[0] for v in chars.values()], pa.int64()), pa.array([v[1] for v in chars.values()], pa.int64())],
                                             names=["host", "slot", "prose", "chars"])

    measured = _attached(pages.select("host", "tokens", "sizes"), templates).mapInArrow(measure, "host string, slot long, prose long, chars long")
    by_slot = measured.groupBy("host", "slot").agg(F.sum("prose").alias("prose"), F.sum("chars").alias("chars"))
    by_host = by_slot.groupBy("host").agg(F.sum("prose").alias("prose"), F.collect_list(F.struct("slot", "prose", "chars")).alias("slots"))
    full = F.filter("slots", lambda s: (2 * s["prose"] >= s["chars"]) & (s["prose"] >= SLOT_SHARE * F.col("prose")) & (s["prose"] > 0))
    return templates.join(by_host.select("host", F.transform(full, lambda s: s["slot"]).alias("slots")), "host", "left")


def page_templates(df: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each host with at least ``LEAST_PAGES`` distinct pages: host, pages, classes, slots (written tables)."""
    scratch = Scratch(df.sparkSession, "page-templates")
    parsed_path, pages = scratch.write(_parsed(df, url_col, html_col))
    first_path, first = scratch.write(_classes(pages))
    valid_path, valid = scratch.write(_valid(pages, first))
    _, templates = scratch.write(_slots(pages, valid))
    for path in (parsed_path, first_path, valid_path):
        scratch.drop(path)
    return templates


def extract_text(df: DataFrame, url_col: str = "url", html_col: str = "html", templates: DataFrame | None = None) -> DataFrame:
    """All columns but the page itself, and ``text``: the article's blocks in page order, joined by two line feeds.

    Character references are decoded, white space inside a block becomes one space.  ``templates`` may come from
    ``page_templates`` of another table.

    Odd rows: a null or empty page, one without text, or one whose text is all menus and the like has an empty text;
    a null or unreadable url belongs to the host ''.  Cut-off tags and unclosed elements are read to the end.  Repeated
    rows give equal rows.  A column named text is replaced; others keep their names, whatever these are.
    """
    templates = page_templates(df, url_col, html_col) if templates is None else templates
    columns = [c for c in df.columns if c != html_col]
    source = df.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]).alias("row"),
                       F.col(f"`{html_col}`").alias("html"), _host(url_col).alias("host"))
    joined = _attached(source, templates)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column("html")
            texts = [article(pages[i].as_py(), template) for i, template in enumerate(_templates_of(batch))]
            yield pa.RecordBatch.from_arrays([relaxed(batch.column("row")), pa.array(texts, pa.string())], names=["row", "found"])

    out = joined.mapInArrow(read, f"row {source.schema['row'].dataType.simpleString()}, found string")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns) if c != "text"], F.col("found").alias("text"))
