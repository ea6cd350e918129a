"""HTML main-text extraction with site template removal.

1. Each page is parsed once to a compact tree: elements, the text pieces of each block, and a
   hash of each element's subtree (names, classes, texts; digits count as 0).
2. Spark counts the subtree hashes per host, each once a page; copies of a page (equal trees,
   digits count as 0) are one page. A subtree on at least ``SHARE`` of the host's pages, and on at
   least ``MIN_PAGES``, is a template of the site.
3. Each page's tree is read again without its templates. Elements that say what they are
   (navigation, footers, forms, scripts, adverts, comments ...) go too; of the rest, the article
   is kept if there is one, else the main element, else the content element, else the body. A later
   one of these with more than twice the text goes before an earlier one (a teaser).

Templates are looked for inside articles as well (in an article or main element, or in the innermost element that holds four
fifths of a page's paragraphs): whole paragraphs, lists, tables, figures and boxes, not headings and parts of
those. There a subtree counts once for each distinct article, so an article may repeat on its site; and
where at least half of an article's paragraphs would go, it is a near copy of others, and its prose stays. An
element that holds half of the paragraphs of its article or page is no template.

Names go by their first and last words: where one of them says advert, comments, cookies and the like (``STRONG``), the
element goes, whatever it is but for ids of headings. Other marks count for containers: outside of articles any
word, inside only a name that says nothing else, so no "entry-header" and no "search-results".

A host has at most (mean subtrees a page) / SHARE templates, so they travel as one array a host; the
join is salted over ``SALTS`` copies for hosts with many pages.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respawn.llm.common import stored

SHARE = 0.3
MIN_PAGES = 5
SALTS = 32
#: Compression of stored trees: they take most of the disk.
LEVEL = 6

#: Fixed values of HTML: elements without content, with raw text, and that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
#: What an opening tag closes when it is still open (up to the element that must hold it).
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"})}
ENDS_P = BLOCK - {"body", "caption", "dd", "dt", "frameset", "head", "html", "legend", "li", "optgroup", "option", "tbody", "td", "tfoot", "th", "thead", "tr"} | {"li", "dd", "dt"}
#: Elements that hold no main text.
BOILERPLATE = frozenset(
    "nav footer aside form script style noscript template iframe svg canvas object embed button select textarea input dialog menu head title search "
    "audio video xmp noembed noframes datalist".split())
#: Words of a class, id or role that mark an element that holds no main text.
MARKS = frozenset(
    "ad ads adbox advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner popup modal overlay "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars widget widgets rail "
    "header masthead topbar footer bottombar cookie cookies consent gdpr notice notices alert comment comments commentlist disqus respond replies reply "
    "share sharing social related recommended recommendations newsletter subscribe subscription signup login search "
    "skip tags toolbar copyright legal disclaimer contentinfo complementary".split())
#: Marks that leave no doubt as the first or last word of a name.
STRONG = frozenset(
    "ad ads adbox advert adverts advertisement advertisements advertising sponsor sponsored promo promotion popup modal breadcrumb breadcrumbs "
    "pagination pager sidebar sidebars cookie cookies consent gdpr notice notices comment comments commentlist disqus newsletter "
    "subscribe subscription".split())
#: Words that say nothing beside a mark: "related-posts" is marked as a whole, "search-results" isn't.
WITH_MARKS = frozenset(
    "area articles bar block bottom box button buttons container form group icons inner item items left link links list media "
    "outer panel posts right section stories thread top widget wrap wrapper".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th caption figure figcaption b i em strong a span code q br".split())
#: Of these, what can be a template as a whole, and what a name without doubt must mark.
WHOLE_PROSE = frozenset("p ul ol dl table figure blockquote pre".split())
LISTS = frozenset("ul ol dl table figure".split())
#: Elements whose text is a page's prose for certain.
PARAGRAPHS = frozenset("p pre blockquote".split())
CONTENT = frozenset("content maincontent article articlebody post entry story main".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPLIT = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z])(?=[A-Z])")


def _marked(attrs: dict[str, str]) -> set[str]:
    """Words of class, id and role; "has-sidebar" and the like say nothing of the element itself."""
    names = f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}".split()
    words = ([w.lower() for w in _SPLIT.split(n) if w] for n in names)
    return {w for own in words if own and own[0] not in ("has", "no", "with", "without", "is") for w in (*own, "".join(own))}


def _wholly_marked(attrs: dict[str, str]) -> bool:
    """Whether a whole class, id or role is marks and words that add nothing; a header may be a title's."""
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}".split():
        own = {w.lower() for w in _SPLIT.split(name) if w}
        if own <= MARKS | WITH_MARKS and own & MARKS and "header" not in own:
            return True
    return False


def _strongly_marked(tag: str, attrs: dict[str, str]) -> bool:
    """Whether a class, id or role of few words begins or ends with a mark that leaves no doubt; headings' ids are slugs of their text."""
    heading = tag[0] == "h" and tag[1:].isdigit()
    names = [(n, 3) for n in f"{attrs.get('class', '')} {attrs.get('role', '')}".split()] + [(n, 2) for n in attrs.get("id", "").split() if not heading]
    for name, most in names:
        own = [w.lower() for w in _SPLIT.split(name) if w]
        if own and len(own) <= most and own[0] not in ("has", "no", "with", "without", "is") and (own[0] in STRONG or own[-1] in STRONG):
            return True
    return False


class Tree:
    """Elements in page order: names, parents, marks and subtree hashes; and the blocks' texts."""

    def __init__(self, page: str):
        self.tag, self.parent, self.drop, self.content = ["#"], [-1], [False], [False]
        self.hash: list[int] = [0]
        self.pieces: list[tuple[int, int, str]] = []  # block, element, text
        self.parts: list[list[str]] = [[]]
        self.stack, self.block = [0], 0
        self._parse(page)
        while len(self.stack) > 1:
            self._close()
        self.hash[0] = xxhash.xxh64_intdigest("\x1f".join(self.parts[0]))
        del self.parts, self.stack

    def _close(self) -> None:
        n = self.stack.pop()
        if self.tag[n] in BLOCK:
            self.block += 1
        self.hash[n] = own = xxhash.xxh64_intdigest("\x1f".join(self.parts[n]))
        self.parts[self.stack[-1]].append(f"{own:x}")
        self.parts[n] = []

    def _open(self, tag: str, attrs: str) -> int:
        found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)} if attrs else {}
        words = _marked(found) if found else set()
        drop = tag in BOILERPLATE or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
        inside = any(self.tag[n] in ("article", "main") for n in self.stack)
        if found and tag not in ("html", "body", "main"):
            if inside or tag in PROSE:
                drop = drop or _strongly_marked(tag, found) or (tag not in PROSE or tag in LISTS) and _wholly_marked(found)
            else:
                drop = drop or not words.isdisjoint(MARKS)
        if tag == "header":
            drop = drop or not inside
        self.tag.append(tag)
        self.parent.append(self.stack[-1])
        self.drop.append(drop)
        self.content.append(not words.isdisjoint(CONTENT))
        self.hash.append(0)
        self.parts.append([tag, found.get("class", ""), found.get("id", "")])
        if tag in BLOCK:
            self.block += 1
        self.stack.append(len(self.tag) - 1)
        return self.stack[-1]

    def _text(self, raw: str) -> None:
        if raw.strip():
            text = html.unescape(raw)
            self.pieces.append((self.block, self.stack[-1], text))
            self.parts[self.stack[-1]].append(re.sub(r"\d", "0", " ".join(text.lower().split())))
        elif raw:
            self.pieces.append((self.block, self.stack[-1], " "))

    def _end(self, tag: str, within: set[str] | None = None, names: set[str] | None = None) -> None:
        """Close up to the innermost open ``tag`` (or any of ``names``), not past ``within``."""
        for k in range(len(self.stack) - 1, 0, -1):
            own = self.tag[self.stack[k]]
            if own == tag or names and own in names:
                while len(self.stack) > k:
                    self._close()
                if not names:
                    return
            elif within and own in within:
                return

    def _parse(self, page: str) -> None:
        at, size = 0, len(page)
        while at < size:
            m = _TAG.search(page, at)
            if m is None:
                self._text(page[at:])
                return
            if m.start() > at:
                self._text(page[at:m.start()])
            at = m.end()
            if m[1]:
                tag = m[1].lower()
                if tag == "br":
                    self.pieces.append((self.block, self.stack[-1], " "))
                elif tag not in VOID:
                    self._end(tag, {"article", "table", "body"} - {tag} if tag in ("p", "b", "i", "li", "span", "a") else None)
            elif name := m[2] or m[4]:
                tag, attrs = name.lower(), m[3] if m[2] else m[5]
                if tag in ENDS_P:
                    self._end("p", {"article", "table", "td", "th", "div", "section", "body", "main", "button", "li", "blockquote"})
                if tag in CLOSES:
                    names, within = CLOSES[tag]
                    self._end("", within, names)
                if tag in VOID:
                    self.pieces.append((self.block, self.stack[-1], " ")) if tag == "br" else None
                    self.block += tag == "hr"
                    continue
                self._open(tag, attrs)
                if tag in RAW:
                    end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                    if tag == "textarea" or tag == "title":
                        self._text(page[at:end.start() if end else size])
                    at = end.end() if end else size
                    self._close()
                elif attrs.rstrip().endswith("/") and tag in ("svg", "path", "circle", "rect", "use"):
                    self._close()

    def _scopes(self) -> tuple[list[int], list[bool], list[int]]:
        """Of each element: the article, main element or innermost element with nearly all of the page's paragraphs that it lies in (0: none), whether
        it holds half of that one's (or the page's) paragraphs, and the length of its own paragraphs' text."""
        size = len(self.tag)
        gone, told, scope, own = [False] * size, [False] * size, [0] * size, [0] * size
        for n in range(1, size):  # parents come first
            p = self.parent[n]
            gone[n] = gone[p] or self.drop[n]
            told[n] = told[p] or self.tag[n] in PARAGRAPHS
            scope[n] = p if self.tag[p] in ("article", "main") else scope[p]
        for _, n, text in self.pieces:
            if told[n] and not gone[n]:
                own[n] += len(text.strip())
        prose = list(own)
        for n in range(size - 1, 0, -1):
            prose[self.parent[n]] += prose[n]
        most = [prose[n] > 0 and 2 * prose[n] >= prose[scope[n]] for n in range(size)]
        wraps = (n for n in range(size - 1, 0, -1) if self.tag[n] not in PROSE and self.tag[n] not in ("html", "body"))
        home = next((n for n in wraps if prose[n] > 0 and 5 * prose[n] >= 4 * prose[0]), None)
        for n in range(1, size):
            p = self.parent[n]
            if not scope[n] and (p == home or scope[p] == home and home is not None):
                scope[n] = home
        return scope, most, own

    def packed(self) -> tuple[bytes, list[int], list[int], int]:
        """The tree for a second reading, the distinct hashes that may be templates, then others that may equal them, of the former
        the hash of what each counts once for (its article or the page), and the page's hash. The tree holds places of these hashes, not
        the hashes once more: pages of a site share them, so a column of them takes less than each page's own."""
        size = len(self.tag)
        holds = [False] * size  # holds an article or main element
        for n in range(size - 1, 0, -1):
            if holds[n] or self.tag[n] in ("article", "main"):
                holds[self.parent[n]] = True
        scope, most, own = self._scopes()
        part = PROSE - WHOLE_PROSE
        counted = [not holds[n] and self.tag[n] not in ("#", "html", "body", "article", "main") and not (scope[n] and self.tag[n] in part) for n in range(size)]
        open_ = [c and not m for c, m in zip(counted, most)]
        hashes = np.array(self.hash, dtype=np.uint64).view(np.int64)
        pairs = sorted({(int(hashes[n]), int(hashes[scope[n]])) for n in range(size) if open_[n] or counted[n] and self.tag[n] in PROSE})
        known = [h for h, _ in pairs]
        place = {h: i for i, h in enumerate(known)}
        for n in range(size):
            if counted[n] and int(hashes[n]) not in place:
                place[int(hashes[n])] = len(known)
                known.append(int(hashes[n]))
        places = [place[int(hashes[n])] if counted[n] else -1 for n in range(size)]
        state = self.tag, self.parent, self.drop, self.content, self.pieces, places, open_, scope, own
        return zlib.compress(pickle.dumps(state, protocol=5), LEVEL), known, [k for _, k in pairs], int(hashes[0])


def parse(page: str | None) -> tuple[bytes, list[int], list[int], int]:
    return Tree(page or "").packed()


def main_text(tree: bytes, templates: set[int], hashes: Sequence[int] = ()) -> str:
    """The blocks' texts, one a line, without boilerplate and templates (found among the page's ``hashes``)."""
    tag, parent, drop, content, pieces, places, open_, scope, own = pickle.loads(zlib.decompress(tree))
    gone, home = [False] * len(tag), {"article": [False] * len(tag), "main": [False] * len(tag), "content": [False] * len(tag)}
    marked = [h in templates for h in hashes]
    known = [bool(marked) and p >= 0 and marked[p] for p in places]
    kept = _near_copies(tag, parent, drop, known, scope, own) if True in known else frozenset()
    for n in range(1, len(tag)):  # parents come first
        p = parent[n]
        gone[n] = gone[p] or drop[n] or (known[n] and open_[n] and not (scope[n] in kept and tag[n] in PROSE))
        for name, inside in home.items():
            inside[n] = inside[p] or (not gone[n] and (content[n] and tag[n] in ("div", "section", "td") if name == "content" else tag[n] == name))

    def text(keep) -> str:
        blocks: dict[int, list[str]] = {}
        for block, n, piece in pieces:
            if keep(n):
                blocks.setdefault(block, []).append(piece)
        lines = (" ".join("".join(b).split()) for b in blocks.values())
        return "\n".join(line for line in lines if line)

    best = ""
    for inside in home.values():
        if any(inside) and (found := text(lambda n: inside[n] and not gone[n])):  # noqa: B023
            if not best or len(found) > 2 * len(best):
                best = found
    return best or text(lambda n: not gone[n])


def _near_copies(tag: list[str], parent: list[int], drop: list[bool], known: list[bool], scope: list[int], own: list[int]) -> set[int]:
    """The articles (and the like) at least half of whose paragraphs' text is in templates."""
    gone, told = [False] * len(tag), [False] * len(tag)
    total: dict[int, int] = {}
    flagged: dict[int, int] = {}
    for n in range(1, len(tag)):
        p = parent[n]
        gone[n] = gone[p] or drop[n]
        told[n] = scope[n] == scope[p] and told[p] or known[n]
        if scope[n] and own[n] and not gone[n]:
            total[scope[n]] = total.get(scope[n], 0) + own[n]
            flagged[scope[n]] = flagged.get(scope[n], 0) + own[n] * told[n]
    return {k for k, n in total.items() if 2 * flagged[k] >= n}


def host_of(url):
    """The lower-case host of a url; null if it has none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def site_templates(trees: DataFrame, share: float = SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, templates): hashes of subtrees that recur on many distinct pages (in articles: in many distinct articles) of the host."""
    trees = trees.where("host IS NOT NULL").select("host", "page", "hashes", "scopes")
    pages = trees.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    counted = F.slice("hashes", F.lit(1), F.size("scopes")).alias("hashes")
    seen = trees.select("host", counted, "scopes").select("host", F.explode(F.arrays_zip("hashes", "scopes")).alias("s")).select("host", F.col("s.hashes").alias("hash"), "s.scopes").distinct()
    seen = seen.groupBy("host", "hash").agg(F.count("*").alias("n"))
    often = seen.where(F.col("n") >= min_pages).join(pages, "host").where(F.col("n") >= F.col("pages") * share)
    return often.groupBy("host").agg(F.collect_list("hash").alias("templates"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", share: float = SHARE,
            min_pages: int = MIN_PAGES) -> DataFrame:
    """(id_col, url_col, text, n_chars, host, n_templates), one row for each row of ``pages``.

    Null and empty pages have an empty text. Pages without a host (null or relative urls) share
    no templates. Copies of a page count as one page of its host. Equal ids are no matter. An empty
    table gives no rows; other columns aren't read.
    """
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.iloc[lo:lo + 512]
                found = [parse(page) for page in part["body"].tolist()]
                tree, hashes, scopes, own = zip(*found)
                yield pd.DataFrame({"id": part["id"], "url": part["url"], "host": part["host"], "tree": list(tree), "hashes": list(hashes),
                                    "scopes": list(scopes), "page": list(own)})

    kind = dict(pages.dtypes)[id_col]
    source = pages.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("body"))
    trees = stored(source.mapInPandas(build, "id string, url string, host string, tree binary, hashes array<long>, scopes array<long>, page long"), "trees", wide=True)
    templates = stored(site_templates(trees, share, min_pages), "templates")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known: dict = {}
            texts, used = [], []
            for host, tree, hashes, n, own in zip(batch["host"], batch["tree"], batch["hashes"], batch["n"], batch["templates"]):
                if host not in known:
                    known[host] = set(own.tolist()) if own is not None else set()
                texts.append(main_text(tree, known[host], hashes.tolist() if known[host] else ()))
                used.append(len(known[host].intersection(hashes[:n].tolist())) if known[host] else 0)
            yield pd.DataFrame({"id": batch["id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts], "host": batch["host"], "n_templates": used})

    salted = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = trees.withColumn("salt", F.pmod(F.xxhash64("tree"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    out = dealt.select("id", "url", "host", "tree", "hashes", F.size("scopes").alias("n"), "templates").mapInPandas(read, "id string, url string, text string, n_chars long, host string, n_templates int")
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
