"""Main text of pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of nodes: block-level tags and text.  Wrapper inference:

* Strings that stand at one path on at least ``min_pages`` distinct pages of a
  host, and on half of the host's pages that have the path, are its anchors.
  They are counted over all pages (exact copies of a page once).
* A page's stream is first folded: a run of equal neighbouring groups (list
  items, paragraphs) becomes one repeated group ``( ... )+``.  An anchor equals
  the same anchor only; of other text blocks the strings are not compared.
* Wrappers of one host are aligned two by two.  Equal nodes stay; where the
  streams mismatch, a group that goes on a run of the other side becomes
  repeated, and what only one side has becomes an optional group ``( ... )?``.
  The result is again such an expression, so alignment goes on with page after
  page, in any order.  So anchors are the fixed nodes, all other text is a slot.
* Each partition of pages aligns its own pages host by host, then partial
  wrappers are aligned in two rounds of bounded groups.  A hot host therefore
  gives one small row per partition, and all pages take part.

Reading, on every host: a page is matched against its host's wrapper.  What
falls on a fixed node that at least ``min_pages`` distinct pages show at that
place is left out; text in slots, repeated or not, and strings that fewer pages
show there are taken.  Tags and classes are a check after it: places under
menus, headers, footers, sidebars, notices, adverts, forms and comments are left
out, by element and by whole class, id or role (an article or main element is
never left out for its own marks or for those around it, only read after the
unmarked ones: where a page has no other), and on hosts with an ``article`` or
``main`` element what lies outside of it.

Edge cases: null html and null urls give an empty text / the host ''; cut-off
pages and unclosed elements are read as far as they go; repeated rows are
extracted each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.llm.html_tokens import blocks
from txnscope.session import materialize

#: Elements that hold no main text.
BOILERPLATE = frozenset("head title nav menu header footer aside form button select option fieldset legend dialog "
                        "script style noscript template label".split())
MAIN = frozenset(("article", "main"))
#: Words of a class, id or role that mark text beside the main text.
MARKS = re.compile(
    r"(?:ads?|advert\w*|advertising|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice\w*|alert|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|signup|login|nav|navbar|navigation|menu\w*|breadcrumbs?|header|footer|masthead|"
    r"sidebar\w*|aside|rail|widget\w*|related|recommended|share|sharing|social|comments?|commentlist|replies|reply|disqus|"
    r"discussion|respond|form|search|toolbar|complementary|contentinfo|hidden)\Z")
#: Names that are marks as a whole, and words that may stand beside a mark in one name (site-header).
NAMES = frozenset(("side-bar", "skip-link"))
PLAIN = frozenset("site main page top bottom left right list links link box bar block section area container wrapper "
                  "buttons button posts post items item".split())


def marked(name: str) -> bool:
    """Does this class, id or role mark text beside the main text?  Every part must be a mark or plain: not no-sidebar."""
    if name in NAMES:
        return True
    parts = [x for x in re.split(r"[-_]+", name) if x]
    marks = [MARKS.match(x) is not None for x in parts]
    return any(marks) and all(m or x in PLAIN for m, x in zip(marks, parts))


def beside(label: str) -> bool:
    """Is an element with this label outside of the main text?  What holds article or main is decided by the caller."""
    name, _, more = label.partition("[")
    if name in BOILERPLATE:
        return True
    names = (x for part in more[:-1].split(";") for x in part.rpartition("=")[2].split())
    return bool(more) and name not in ("html", "body") and any(map(marked, names))


# --- wrappers: lists of nodes.  ["b", path, text or None, pages, anchor] a text block, distinct pages (hashes, as many
# as are asked for) that show this text in it, and if the text counts where nodes are compared; ["r", nodes] repeated;
# ["o", nodes] optional.
#: Default: distinct pages from which on a string is template.
MIN_PAGES = 5

def shape(nodes: list) -> str:
    """Nodes without their strings, repeats and options written out."""
    return "".join((f"<{n[1]}={n[2].replace(chr(60), chr(0))}>" if n[4] else f"<{n[1]}>") if n[0] == "b" else f"({shape(n[1])}){'+' if n[0] == 'r' else '?'}" for n in nodes)


def _blend(a: list, b: list, most: int = MIN_PAGES) -> list:
    """Two nodes of one shape as one: differing strings become slots."""
    if a[0] == "b":
        same = a[2] is not None and a[2] == b[2]
        return ["b", a[1], a[2] if same else None, sorted({*a[3], *b[3]})[:most] if same else [], a[4]]
    return [a[0], [_blend(x, y, most) for x, y in zip(a[1], b[1])]]


def fold(nodes: list, longest: int = 4, most: int = MIN_PAGES) -> list:
    """Runs of equal neighbouring groups of up to ``longest`` nodes as repeated groups."""
    out = nodes
    for width in range(1, longest + 1):
        nxt, i = [], 0
        marks = [shape([n]) for n in out]
        while i < len(out):
            j = i + width
            while marks[i:i + width] == marks[j:j + width] and j + width <= len(out):
                j += width
            if j > i + width:
                group = [list(n) for n in out[i:i + width]]
                for k in range(i + width, j, width):
                    group = [_blend(a, b, most) for a, b in zip(group, out[k:k + width])]
                nxt.append(group[0] if width == 1 and group[0][0] == "r" else ["r", group])
                i = j
            else:
                nxt.append(out[i])
                i += 1
        out = nxt
    return out


def _bare(node: list) -> str:
    """Shape of a node without its outer repeat or option: what a mismatch is resolved on."""
    while node[0] in "ro" and len(node[1]) == 1:
        node = node[1][0]
    return shape(node[1]) if node[0] in "ro" else shape([node])


def _merge(a: list, b: list, most: int) -> list:
    """Nodes of one bare shape as one; it repeats or may be missing if either does."""
    inner, kinds = [], ""
    for n in (a, b):
        seen = n
        while seen[0] in "ro":
            kinds += seen[0]
            if len(seen[1]) > 1 or seen[1][0][0] == "b":
                break
            seen = seen[1][0]
        inner.append(seen[1] if seen[0] in "ro" else [seen])
    body = [_merge(x, y, most) if shape([x]) != shape([y]) else _blend(x, y, most) for x, y in zip(*inner)]
    out = body[0] if len(body) == 1 and not kinds else None
    if "r" in kinds:
        out = ["r", body]
    if "o" in kinds:
        out = ["o", [out] if out else body]
    return out if out else ["r", body]


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence, by one bit row of ``b`` for each of ``a``."""
    where: dict[str, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)                              # a zero bit: one more in common than without this item of b
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        elif i > 1 and not rows[i - 2] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def align(a: list, b: list, most: int = MIN_PAGES) -> list:
    """The expression both wrappers match: a longest common subsequence of nodes, the rest optional."""
    ka, kb = [_bare(n) for n in a], [_bare(n) for n in b]
    lead = 0
    while lead < min(len(a), len(b)) and ka[lead] == kb[lead]:
        lead += 1
    tail = 0
    while tail < min(len(a), len(b)) - lead and ka[-1 - tail] == kb[-1 - tail]:
        tail += 1
    ma, mb = a[lead:len(a) - tail], b[lead:len(b) - tail]
    xa, xb = ka[lead:len(a) - tail], kb[lead:len(b) - tail]
    out = [_merge(x, y, most) for x, y in zip(a[:lead], b[:lead])]
    i = j = 0
    for u, v in [*_common(xa, xb), (len(ma), len(mb))]:
        out += [n if n[0] == "o" else ["o", [n]] for n in (*ma[i:u], *mb[j:v])]
        if u < len(ma):
            out.append(_merge(ma[u], mb[v], most))
        i, j = u + 1, v + 1
    out += [_merge(x, y, most) for x, y in zip(a[len(a) - tail:], b[len(b) - tail:])] if tail else []
    return fold(out, most=most)


def _mark(text: str) -> str:
    """Stands for a string where only equality counts."""
    return text if len(text) <= 160 else hashlib.sha1(text.encode("utf-8", "surrogatepass")).hexdigest()


def _hash(text: str) -> int:
    """64-bit hash, for columns and counts."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def page_nodes(page: str | None, anchors: frozenset[int] | None = None) -> list:
    """Folded nodes of a page; a text block carries its path and string.  With ``anchors`` other strings are slots."""
    seen, out = [_hash(page or "")], []
    for path, text in blocks(page or ""):
        at, text = "/".join(path), _mark(text)
        fixed = anchors is not None and _hash(f"{at}\0{text}") in anchors
        out.append(["b", at, text, seen, fixed] if fixed or anchors is None else ["b", at, None, [], False])
    return fold(out)


def anchor_strings(pages: DataFrame, min_pages: int) -> DataFrame:
    """(host, anchors): hashes of the strings on ``min_pages`` distinct pages and half of those with their path."""
    def work(batches):
        for b in batches:
            out = []
            for host, page in zip(b["host"], b["html"]):
                found, page_hash = set(), _hash(page or "")
                for path, text in blocks(page or ""):
                    at = "/".join(path)
                    found |= {(_hash(at), None), (_hash(at), _hash(f"{at}\0{_mark(text)}"))}
                out += [(host, page_hash, a, k) for a, k in found]
                if len(out) >= 200_000:
                    yield _frame(out)
                    out = []
            if out:
                yield _frame(out)

    def _frame(out):
        frame = pd.DataFrame(out, columns=["host", "page", "path", "string"], dtype=object)
        return frame.astype({"page": "int64", "path": "int64"}).assign(string=frame["string"].astype("Int64"))

    rows = pages.select("host", "html").mapInPandas(work, "host string, page bigint, path bigint, string bigint").distinct()
    counts = materialize(rows.groupBy("host", "path", "string").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages),
                         "wrapper-strings")
    there = counts.where("string is null").select("host", "path", F.col("n").alias("of"))
    return counts.where("string is not null").join(there, ["host", "path"]).where(F.col("n") * 2 >= F.col("of")) \
        .groupBy("host").agg(F.sort_array(F.collect_list("string")).alias("anchors"))


def leaves(nodes: list) -> Iterator[list]:
    """The text blocks of a wrapper, in order."""
    for n in nodes:
        if n[0] == "b":
            yield n
        else:
            yield from leaves(n[1])


def host_of(url: Column) -> Column:
    """Lower-cased (A-Z) host of a url: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; else ''."""
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.when(at > 0, host), F.lit(""))


WRAPPER = "host string, wrapper string, pages bigint"


def _join(parts: Iterator[tuple[str, int]], most: int) -> tuple[list, int]:
    """Aligns wrappers one after the other; equal ones only count."""
    seen: dict[str, int] = {}
    for text, n in parts:
        seen[text] = seen.get(text, 0) + n
    whole: list | None = None
    for text in sorted(seen):
        w = json.loads(text)
        whole = w if whole is None else align(whole, w, most)
    return whole or [], sum(seen.values())


def infer_wrappers(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, wrapper as JSON, rows) from all rows of ``pages`` (host, html)."""
    anchored = materialize(anchor_strings(pages, min_pages), "wrapper-anchors")

    def per_partition(batches):
        found: dict[str, list] = {}
        known: dict[str, frozenset[int]] = {}
        for b in batches:
            for host, page, anchors in zip(b["host"], b["html"], b["anchors"]):
                if host not in known:
                    known[host] = frozenset(() if anchors is None else (int(x) for x in anchors))
                nodes = page_nodes(page, known[host])
                got = found.get(host)
                if got is None:
                    found[host] = [nodes, 1]
                else:
                    got[0], got[1] = align(got[0], nodes, min_pages), got[1] + 1
        yield pd.DataFrame([(h, json.dumps(w), n) for h, (w, n) in found.items()], columns=["host", "wrapper", "pages"])

    def together(group: pd.DataFrame) -> pd.DataFrame:
        w, n = _join(zip(group["wrapper"], group["pages"]), min_pages)
        return pd.DataFrame([(group["host"].iloc[0], json.dumps(w), n)], columns=["host", "wrapper", "pages"])

    parts = pages.select("host", "html").join(anchored, "host", "left").mapInPandas(per_partition, WRAPPER)
    first = parts.groupBy("host", F.pmod(F.xxhash64("wrapper"), F.lit(64)).alias("salt")) \
        .applyInPandas(together, WRAPPER)
    return first.groupBy("host").applyInPandas(together, WRAPPER)


class Matcher:
    """Finds the nodes of a wrapper that the text blocks of a page fall on."""

    def __init__(self, nodes: list):
        self.leaves: list[list] = []
        self.back: list[int] = []                    # last leaf of the outermost repeated group around a leaf
        self._walk(nodes, False)
        self.at: dict[tuple[str, str | None], list[int]] = {}
        for k, n in enumerate(self.leaves):
            self.at.setdefault((n[1], n[2] if n[4] else None), []).append(k)

    def _walk(self, nodes: list, repeated: bool) -> None:
        for n in nodes:
            if n[0] == "b":
                self.back.append(len(self.leaves))
                self.leaves.append(n)
            else:
                start = len(self.leaves)
                self._walk(n[1], repeated or n[0] == "r")
                if n[0] == "r" and not repeated:
                    self.back[start:] = [len(self.leaves)] * (len(self.leaves) - start)

    def match(self, items: list[tuple[str, str | None]]) -> list[int]:
        """The leaf of each item, -1 where none: as many items as can be matched in the order of the expression."""
        best: list[int] = [0] * (len(self.leaves) + 1)          # items matched so far, the last on leaf k - 1
        links: list[tuple | None] = [None] * len(best)
        for i, item in enumerate(items):
            new = []
            for k in self.at.get(item, ()):
                upto = max(k, self.back[k]) + 1                 # leaves before this one, or of its repeated group
                n = max(best[:upto])
                new.append((k + 1, n + 1, (i, k, links[best.index(n, 0, upto)])))
            for k, n, link in new:
                if n > best[k]:
                    best[k], links[k] = n, link
        out, link = [-1] * len(items), links[best.index(max(best))]
        while link:
            out[link[0]], link = link[1], link[2]
        return out


#: Elements of headings.
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Where a path lies: in article or main; in one that has or is in an element with a mark, read where a page has no
#: other; outside, read on pages without article and main; in an element that holds no main text.
MAIN_TEXT, DOUBTFUL, OUTSIDE, NEVER = range(4)


class Reader:
    """Reads main text with one host's wrapper."""

    def __init__(self, wrapper: str | None, min_pages: int):
        self.matcher, self.min_pages = Matcher(json.loads(wrapper) if wrapper else []), min_pages
        self.memo: dict[tuple[str, ...], int] = {}
        known = self.matcher.leaves
        # Each string that is an anchor: True or False if it is template at all or at none of its places, else None.
        self.anchors: dict[tuple[str, str], bool | None] = {}
        for n in known:
            if n[4]:
                fixed, key = len(n[3]) >= min_pages, (n[1], n[2])
                self.anchors[key] = fixed if self.anchors.get(key, fixed) is fixed else None

    @staticmethod
    def _region(path: tuple[str, ...]) -> int:
        at = [i for i, e in enumerate(path) if e.partition("[")[0] in MAIN or "role=main" in e]
        if not at:
            return NEVER if any(map(beside, path)) else OUTSIDE
        inner = path[at[-1] + 1:]
        # An article's own header holds its title, whatever its class.
        if any(beside(e) and e.partition("[")[0] != "header" for e in inner):
            return NEVER
        return DOUBTFUL if any(map(beside, path[:at[-1] + 1])) else MAIN_TEXT

    def region(self, path: tuple[str, ...]) -> int:
        if path not in self.memo:
            self.memo[path] = self._region(path)
        return self.memo[path]

    def free(self, found: list[tuple[tuple[str, ...], str]]) -> list[bool]:
        """Which text blocks of a page fall on slots, or on strings that too few pages show at that place."""
        items = [("/".join(path), _mark(text)) for path, text in found]
        items = [x if x in self.anchors else (x[0], None) for x in items]
        fixed = [False if x[1] is None else self.anchors[x] for x in items]
        if None in fixed:                            # only then places matter
            leaves = self.matcher.leaves
            on = self.matcher.match(items)
            fixed = [k >= 0 and len(leaves[k][3]) >= self.min_pages if f is None else f for f, k in zip(fixed, on)]
        return [not f for f in fixed]

    def read(self, page: str | None) -> str:
        """Main text of a page: what is free in its article or main, or outside where the page has neither.

        Headings inside an article or main are its own, however many pages have them.  Where under a tenth
        of its words is free, the pages that share the others are copies of one article, and nothing is template."""
        found = list(blocks(page or ""))
        got: dict[int, list[tuple[str, bool]]] = {}
        has_main = False
        for (path, text), free in zip(found, self.free(found)):
            region = self.region(path)
            inside = any(e.partition("[")[0] in MAIN or "role=main" in e for e in path)
            has_main = has_main or inside
            heading = inside and path[-1].partition("[")[0] in HEADINGS
            got.setdefault(region, []).append((text, free or heading))
        for region in (MAIN_TEXT, DOUBTFUL) if has_main else (OUTSIDE,):
            own = got.get(region, [])
            words = [len(t.split()) for t, _ in own]
            kept = sum(n for n, (_, free) in zip(words, own) if free)
            copies = has_main and kept * 10 < sum(words)
            text = [t for t, free in own if free or copies]
            if text:
                return "\n".join(text)
        return ""


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text (main text, '' if none) for every row of ``pages`` (page_id, url, html)."""
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    wrappers = materialize(infer_wrappers(rows, min_pages), "wrappers")

    def read(batches):
        readers: dict[str, Reader] = {}
        for b in batches:
            out = []
            for host, w, page in zip(b["host"], b["wrapper"], b["html"]):
                if host not in readers:
                    if len(readers) >= 1000:
                        readers.clear()
                    readers[host] = Reader(w, min_pages)
                out.append(readers[host].read(page))
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": out})
    schema = f"page_id {dict(rows.dtypes)['page_id']}, url string, text string"
    return rows.join(wrappers, "host").mapInPandas(read, schema)
