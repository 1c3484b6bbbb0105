"""HTML extraction (operator 3): article blocks by structure, boilerplate elsewhere by suffix arrays over each host's pages."""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import rounds
from tessella.llm import textscan as ts

MAIN, NEUTRAL, CHROME, SUSPECT = 0, 1, 2, 3
RUN = 0

#: Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea".split())
DROPPED = frozenset("noscript template svg iframe object canvas math select head".split())
HEAD_CONTENT = frozenset("base link meta noscript script style template title".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HOLDERS = frozenset(("article", "main"))
CHROME_TAGS = frozenset("nav footer aside form menu dialog button fieldset".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words in class or id that mark menus, notices, adverts, reader comments and the like.
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header "
    "masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related replies respond share sharing sidebar "
    "signup skyscraper social sponsor sponsored subscribe toolbar widget".split()
)

#: Words that may stand beside such a word in a class without changing what it means.
LAYOUT_WORDS = frozenset("area bar bottom box block button buttons container fixed inner item items left link links list outer panel reader row section side site slot sticky top unit user wrap wrapper".split())
#: Elements that are text by themselves, whatever their class is called.
TEXTS = frozenset("h1 h2 h3 h4 h5 h6 hgroup p pre blockquote figure figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What stands above reader comments, with or without their number.
REPLIES = re.compile(r"\(?\d*\)?\s*(?:reader )?(?:comments|responses|replies)\s*\(?\d*\)?|(?:leave|post) a (?:comment|reply)", re.I)

_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_UNQUOTED = re.compile(r"""[^>"']*""")
_MARKED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")


def _mark(tag: str, attributes: str, inside: bool) -> int:
    """CHROME for elements that are by their name, role or class; SUSPECT where only a part of a class is such a word; else MAIN.

    A class counts as a whole, that is, its name has to consist of chrome and layout words ('ad', 'cookie-bar', but not 'ad-hoc' or 'entry-header'). Headings,
    paragraphs and the like inside an article have no class.
    """
    if tag in CHROME_TAGS or tag == "header" and not inside:
        return CHROME
    found = MAIN
    for name, *value in _MARKED.findall(attributes):
        for one in "".join(value).lower().split():
            words = _WORDS.findall(one)
            if name.lower() == "role":
                found = CHROME if one in CHROME_ROLES else found
            elif tag not in HOLDERS and tag not in ("body", "html") and not (inside and tag in TEXTS):
                hits = [w in CHROME_WORDS for w in words]
                whole = any(hits) and all(hit or w in LAYOUT_WORDS for hit, w in zip(hits, words))
                found = CHROME if whole else SUSPECT if any(hits) and found == MAIN else found
    return found


class _Tags:
    """The tags of a page in one pass forward: (start, end, closing, name, attributes); comments and declarations have an empty name.

    Attributes may hold > in quotes. Where quotes run on to the end of the page without a >, they are broken: from there on a tag ends at the next >.
    A tag that never ends is the last one, without a name.
    """

    def __init__(self, page: str) -> None:
        self.page, self.broken = page, False
        self.last = {c: page.rfind(c) for c in "<>\"'"}

    def _end(self, at: int) -> int:
        """The > that ends a tag whose name ends at `at`, or -1."""
        page, k = self.page, at
        while not self.broken:
            k = _UNQUOTED.match(page, k).end()
            if k < len(page) and page[k] == ">":
                return k
            if k >= len(page) or k + 1 > self.last[page[k]]:
                self.broken = True
            else:
                k = page.find(page[k], k + 1) + 1
        return page.find(">", at) if at <= self.last[">"] else -1

    def next(self, at: int):
        page = self.page
        while 0 <= (at := page.find("<", at) if at <= self.last["<"] else -1):
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(page), False, "", ""
            closing = page.startswith("/", at + 1)
            if name := _NAME.match(page, at + 1 + closing):
                end = self._end(name.end())
                return (at, end + 1, closing, name[0].lower(), page[name.end() : end]) if end >= 0 else (at, len(page), False, "", "")
            if page[at + 1 : at + 2] in ("!", "?", "/"):
                end = page.find(">", at) if at <= self.last[">"] else -1
                return at, end + 1 if end >= 0 else len(page), False, "", ""
            at += 1
        return None

    def behind(self, name: str, at: int) -> int:
        """Behind the end tag of a raw element, or the end of the page."""
        found = re.compile(rf"</{name}\b", re.I).search(self.page, at)
        end = self.page.find(">", found.end()) if found and found.end() <= self.last[">"] else -1
        return end + 1 if end >= 0 else len(self.page)


class _Open:
    """The open elements: name, inside an article, mark; and the places of each name."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, int]] = []
        self.places: dict[str, list[int]] = {}
        self.dropped: list[int] = []
        self.blocks: list[int] = []

    def push(self, name: str, inside: bool, mark: int) -> None:
        for kind, places in ((DROPPED, self.dropped), (BLOCK, self.blocks)):
            if name in kind:
                places.append(len(self.stack))
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, inside, mark))

    def cut(self, size: int) -> None:
        """Closes all but the outermost `size` elements."""
        while len(self.stack) > size:
            self.places[self.stack.pop()[0]].pop()
        for places in (self.dropped, self.blocks):
            while places and places[-1] >= size:
                places.pop()

    def leave(self, name: str) -> None:
        self.cut(self.places[name][-1])

    def has(self, name: str) -> bool:
        return bool(self.places.get(name))

    @property
    def top(self) -> tuple[str, bool, int]:
        return self.stack[-1] if self.stack else ("", False, MAIN)


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of every block of a page that has text, in page order; the time is linear in the page's length.

    Any start or end of a block element parts blocks; br is white space. Elements that are left open end with the element
    around them, a head also with the first tag or text that belongs to the body; a cut-off tag at the end is dropped, a cut-off
    character reference stays as it is. What DROPPED and RAW elements hold is no text and parts no blocks. Reader comments without a class are known by
    their place: a section or the like of an article from a heading of REPLIES on, if no more text of an article follows it.
    """
    page = page or ""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    answers: list[list[int]] = []
    open_answers: list[list[int]] = []
    tags, open_, at = _Tags(page), _Open(), 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            _, inside, mark = open_.top
            out.append((CHROME if mark == CHROME else NEUTRAL if not inside else mark, text))

    def done() -> list[tuple[int, str]]:
        last = max((i for i, (kind, _) in enumerate(out) if kind in (MAIN, SUSPECT)), default=-1)
        for _, start, end in answers:
            if last < end:
                out[start:end] = [(CHROME if kind in (MAIN, SUSPECT) else kind, text) for kind, text in out[start:end]]
        return out

    while True:
        while open_answers and len(open_.stack) < open_answers[-1][0]:
            open_answers.pop()[2] = len(out)
        found = tags.next(at)
        text = page[at : found[0]] if found else page[at:]
        if open_.top[0] == "head" and text.strip():
            open_.leave("head")
        if text and not open_.dropped:
            parts.append(text)
        if not found:
            flush()
            for a in open_answers:
                a[2] = len(out)
            return done()
        _, at, closing, name, attributes = found
        if not name:
            continue
        if closing:
            if open_.has(name):
                if name in BLOCK and not open_.dropped:
                    before = len(out)
                    flush()
                    if name in HEADINGS and len(out) > before and out[-1][0] == MAIN and REPLIES.fullmatch(out[-1][1]):
                        open_.leave(name)
                        if open_.top[0] in ("section", "div", "ol", "ul"):
                            open_answers.append([len(open_.stack), before, 0])
                            answers.append(open_answers[-1])
                        continue
                elif name in BLOCK:
                    # the element around a dropped one that was left open
                    k = open_.places[name][-1]
                    if k < open_.dropped[0]:
                        open_.cut(k + 1)
                        flush()
                open_.leave(name)
            elif name in BLOCK and not open_.dropped:
                flush()
            continue
        if open_.has("head") and (name == "body" or open_.top[0] == "head" and name not in HEAD_CONTENT):
            open_.leave("head")
        if name == "br":
            if not open_.dropped:
                parts.append(" ")
            continue
        if name in BLOCK and not open_.dropped:
            flush()
            # a new paragraph or item ends an open one of its own level
            if name in ("p", "li") and open_.blocks and open_.stack[open_.blocks[-1]][0] == name:
                open_.cut(open_.blocks[-1])
        if name in RAW:
            at = tags.behind(name, at)
            continue
        if name in VOID or attributes.rstrip().endswith("/"):
            continue
        _, inside, mark = open_.top
        inside = inside or name in HOLDERS
        own = _mark(name, attributes, inside)
        open_.push(name, inside, CHROME if CHROME in (mark, own) else mark or own)


def visible_text(page: str | None) -> str:
    """All text of a page without tags, comments and raw elements, each tag being white space."""
    page, parts, at = page or "", [], 0
    tags = _Tags(page)
    while found := tags.next(at):
        parts.append(page[at : found[0]])
        _, at, closing, name, _ = found
        if name in RAW and not closing:
            at = tags.behind(name, at)
    return html.unescape(" ".join([*parts, page[at:]]))


def host_of(url: str | None) -> str:
    found = re.search(r"://([^/?#]*)", url or "")
    return found[1].lower() if found else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", run_tokens: int = 8, group_bytes: int | None = None, structure: bool = True) -> DataFrame:
    """The main text of every page.

    All text of a host's pages outside articles makes token streams; their suffixes are sorted into suffix arrays of
    (host, tokens), and a run of `run_tokens` tokens or more that stands on distinct pages of a host is boilerplate (longer
    runs are made of such ones, so sorting to that depth finds them all). A page without an article
    consists of its neutral blocks (no tag or class says what they are), of which boilerplate runs are cut out and the unique runs kept.
    What an article or main element holds, but for navigation, forms, notices, adverts, comments and the like in it, is main text
    and stays whole, repeated or not: articles of one host may quote each other. A block in it whose class only has a chrome word in its name goes if repeated runs
    confirm that, that is, cover all of it. With `structure` false no tag or class counts, and the suffix arrays decide every block.
    Pages are dealt to bounded groups, so one host may hold any share of them; classes of equal runs of different groups meet by their
    64-bit hash.

    Returns one row for each input row: row (struct of the columns other than the html), text (blocks joined by a newline), n_chars
    (code points), n_outside and n_repeated (tokens outside articles, and those of them in repeated runs). Null and empty html
    give an empty text; a null url is the host "". Repeated rows are distinct pages. An empty table gives no rows. A very long page costs a task
    some forty times its size. No column can clash with these names, as all are inside `row`.
    """
    groups, shards = rounds.sizes(pages, html_col, group_bytes)
    others = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != html_col])
    dealt = rounds.by_hash(pages, id_col, html_col, groups, F.struct(others.alias("row"), F.col(url_col).cast("string").alias("url")))
    zero = F.lit(0).cast("long")
    schema = pages.select(others.alias("row"), F.lit("").alias("text"), zero.alias("n_chars"), zero.alias("n_outside"), zero.alias("n_repeated")).schema

    def scan(table: pa.Table):
        """Blocks of every page; hash of each repeated-run candidate, its first token and page, and the first token of each page."""
        urls = table["row"].combine_chunks().field("url").to_pylist()
        found = [blocks(h) if structure else [(NEUTRAL, t) for _, t in blocks(h)] for h in table["text"].to_pylist()]
        outside = pa.array(["\n".join(t for kind, t in page if kind != MAIN) for page in found], pa.large_string())
        data, offsets = ts.text_bytes(outside)
        starts, ends, rows = ts.word_spans(data, offsets, ~ts.SPACE)
        tokens = ts.word_hashes(data, starts, ends)
        hosts = {h: i for i, h in enumerate(sorted({host_of(u) for u in urls}))}
        host_key = pa.array(sorted(hosts), pa.large_string())
        host_data, host_at = ts.text_bytes(host_key)
        host_hash = ts.span_hashes(ts.prefix_sums(ts.BYTE_VALUES[host_data]), host_at[:-1], host_at[1:])
        host = np.array([hosts[host_of(u)] for u in urls], np.int64)
        size = np.diff(rows)
        page = np.repeat(np.arange(len(size)), size)
        first = np.flatnonzero(np.arange(len(tokens)) + run_tokens <= rows[1:][page]) if len(tokens) else np.zeros(0, np.int64)
        order, group = _suffix_array(tokens, host[page[first]] if len(first) else first, first, run_tokens)
        runs = ts.span_hashes(ts.prefix_sums(tokens), first, first + run_tokens) if len(first) else np.zeros(0, np.uint64)
        keys = ts.mix(runs ^ host_hash[host[page[first]]]) if len(first) else runs
        heads = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
        pages_of = page[first[order]]
        low, high = (np.minimum.reduceat(pages_of, heads), np.maximum.reduceat(pages_of, heads)) if len(heads) else (heads, heads)
        return found, rows, first, order, heads, keys[order[heads]], low != high

    def runs(g: int, table: pa.Table, _) -> pa.Table:
        return rounds.packed(g, RUN, np.unique(scan(table)[5]), shards, 8)[0]

    def cut(g: int, table: pa.Table, replies: pa.Table) -> pa.Table:
        found, rows, first, order, heads, keys, many = scan(table)
        distinct, inverse = np.unique(keys, return_inverse=True)
        repeated = many | (rounds.answered(replies, RUN, rounds.packed(0, RUN, distinct, shards, 8)[1])[inverse] > 0)
        size = np.diff(np.append(heads, len(order)))
        gone = ts.covered(first[order[np.repeat(repeated, size)]], run_tokens, int(rows[-1]))
        texts, outside, covered = [], [], []
        for i, page in enumerate(found):
            mine = gone[rows[i] : rows[i + 1]]
            outside.append(len(mine))
            covered.append(int(mine.sum()))
            texts.append("\n".join(_main_text(page, mine)))
        row = table["row"].combine_chunks().field("row")
        return pa.table([row, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(outside, pa.int64()), pa.array(covered, pa.int64())], names=["row", "text", "n_chars", "n_outside", "n_repeated"])

    answers = rounds.answer(rounds.ask(dealt, None, runs), lambda kind, b: rounds.elsewhere(b, 8))
    return rounds.ask(dealt, answers, cut, schema)


def _main_text(page: list[tuple[int, str]], repeated: np.ndarray) -> list[str]:
    """The blocks of a page's article, or else the unique runs of its neutral blocks. repeated: marks of all tokens outside MAIN blocks."""
    article = any(kind in (MAIN, SUSPECT) for kind, _ in page)
    out, at = [], 0
    for kind, text in page:
        if kind == MAIN:
            out.append(text)
            continue
        words = [w.decode() for w in text.encode().split()]
        mine = repeated[at : at + len(words)]
        at += len(words)
        if kind == SUSPECT and not mine.all():
            out.append(text)
        elif kind == NEUTRAL and not article:
            out.append(" ".join(w for w, m in zip(words, mine) if not m))
    return [t for t in out if t]


def _suffix_array(tokens: np.ndarray, host: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of (host, first `depth` tokens), as places in `starts`, and the class of each sorted suffix."""
    order = np.argsort(host, kind="stable")
    group = np.searchsorted(host[order], host[order])
    active = np.arange(len(starts))
    for at in range(depth):
        if not len(active):
            break
        word = tokens[starts[order[active]] + at]
        by = np.lexsort((word, group[active]))
        order[active], word, old = order[active][by], word[by], group[active]
        new = np.ones(len(active), bool)
        new[1:] = (word[1:] != word[:-1]) | (old[1:] != old[:-1])
        heads = np.flatnonzero(new)
        group[active] = active[heads][np.cumsum(new) - 1]
        size = np.diff(np.append(heads, len(active)))
        active = active[np.repeat(size > 1, size)]
    return order, group


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages."""
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.select(F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), "text", "n_chars", "n_repeated")


def brute_force(rows: list[tuple], read, run_tokens: int = 8) -> list[tuple]:
    """(page_id, url, text, n_chars, n_repeated) in plain Python, for small fixtures. read: page -> its blocks (kind, text)."""
    pages = [read(h) for _, _, h in rows]
    streams = [[w for kind, t in page if kind != MAIN for w in t.encode().split()] for page in pages]
    seen: dict[tuple, set[int]] = {}
    for i, ((_, url, _), words) in enumerate(zip(rows, streams)):
        for k in range(len(words) - run_tokens + 1):
            seen.setdefault((host_of(url), *words[k : k + run_tokens]), set()).add(i)
    out = []
    for (page_id, url, _), page, words in zip(rows, pages, streams):
        gone = set()
        for k in range(len(words) - run_tokens + 1):
            if len(seen[(host_of(url), *words[k : k + run_tokens])]) > 1:
                gone.update(range(k, k + run_tokens))
        kinds = {kind for kind, _ in page}
        main, at = [], 0
        for kind, t in page:
            w = [] if kind == MAIN else t.encode().split()
            if kind == MAIN or (kind == SUSPECT and any(at + j not in gone for j in range(len(w)))):
                main.append(t)
            if kind == NEUTRAL and not kinds & {MAIN, SUSPECT}:
                main.append(" ".join(x.decode() for j, x in enumerate(w) if at + j not in gone))
            at += len(w)
        text = "\n".join(t for t in main if t)
        out.append((page_id, url, text, len(text), len(gone)))
    return out
