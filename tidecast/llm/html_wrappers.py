"""Main text of web pages by union-free wrapper inference.

A page is read as a stream of block elements and text slots; inline tags belong to the
slot. Repeated neighbouring elements become one repeated group, so a page has a short
structure. The structures of one host are aligned one after another: equal tokens stay,
elements that only some pages have become optional, elements that some pages repeat
become repeated groups, and texts that differ become slots. The result is a union-free
regular expression, the host's wrapper. Each of its text slots is judged over all pages
of the host: by the containers it stands in (menu, header, footer, sidebar, notice,
advert, form, comments), by whether its text differs between pages, and by its share of
link text. A page's text is that of the slots that hold the article.

Scale: pages are reduced in each task to distinct structures with counts per slot, which
is all that is shuffled; structures of a host are aligned in salted groups of bounded
size, group by group, so a host with very many structures is no single task. Wrapper
verdicts are joined back to the pages' texts by host and structure, an equi-join that AQE
can split on a hot host.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.schemas import plus, unused
from tidecast.session import cut_lineage

GROUP = 256  # structures that one task aligns

# Fixed values of HTML: elements without content, inline elements, elements whose content
# is no text of the page, elements that end an open paragraph, and what closes what.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
                   "sub sup time tt u var wbr math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mspace "
                   "mpadded mphantom semantics".split())
RAW = "script style noscript template textarea title iframe".split()  # without an end tag, to the end of the page
SKIPPED = "svg select object canvas audio video button datalist annotation annotation-xml".split()  # without an end tag, an element like others
NOT_IN_P = frozenset("address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hgroup hr li main menu nav ol p pre search section table ul tr td th tbody thead tfoot caption".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
KEEPS_OPEN = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Names of containers that hold no article text, as elements, roles, and words of classes and ids.
BOILER_TAGS = frozenset("nav footer aside form menu dialog head search fieldset".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
BOILER_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adbox sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr "
                         "notice notices alert popup modal overlay newsletter subscribe subscription paywall nav navbar navigation menu submenu breadcrumb breadcrumbs "
                         "sidebar related recommended recommendations share sharing social comment comments commentlist disqus respond reply replies footer masthead "
                         "pagination pager login signin signup register widget widgets toolbar skip copyright disclaimer".split())
WHOLE_TAGS = frozenset("html body main article".split())  # class words of these tell of the page, not of a container
MAIN_WORDS = frozenset("content article post entry story main body".split())

_RAW, _SKIPPED = "|".join(RAW), "|".join(SKIPPED)
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})(?=[\s/>])[^>]*(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    rf"|<(?P<skip>{_SKIPPED})(?=[\s/>])[^>]*(?:/>|>.*?</(?P=skip)\s*>)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[/!?][^>]*>?|<[a-zA-Z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)", re.S | re.I)
ATTR = re.compile(r"(?<![\w-])(class|id|role|style|hidden|itemprop|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?(?![\w-])", re.I)
PARTS = re.compile(r"[a-z]+")


@lru_cache(maxsize=4096)
def _kind(name: str, attrs: str, in_main: bool) -> tuple[str, bool, str | None]:
    """Token of an element ("!" at its end marks boilerplate, so that it never equals one that is
    none), whether its content is boilerplate, and its claim to hold the article."""
    given = {m[1].lower(): (m[2] or "").strip("\"'").lower() for m in ATTR.finditer(attrs)} if "=" in attrs or "hidden" in attrs.lower() else {}
    words = PARTS.findall(given.get("class", "") + " " + given.get("id", ""))
    telling = () if name in WHOLE_TAGS else words
    boiler = name in BOILER_TAGS or given.get("role") in BOILER_ROLES or not BOILER_WORDS.isdisjoint(telling)
    boiler = boiler or "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "")
    boiler = boiler or (name == "header" or "header" in telling) and not in_main
    main = None
    if not boiler:
        main = ("article" if name == "article" or given.get("itemprop") == "articlebody" else
                "main" if name == "main" or given.get("role") == "main" else
                "content" if name in ("div", "section", "td") and not MAIN_WORDS.isdisjoint(words) else None)
    token = name + "".join("." + w for w in PARTS.findall(given.get("class", "")))
    return token + "!" * boiler, boiler, main


class Page:
    """``tokens``: structure; ``texts``: (slot, text, characters in links, boilerplate, article, main, content) in page order."""

    __slots__ = ("tokens", "texts")

    def __init__(self, source: str | None):
        self.tokens, self.texts = parse(source or "")


def _flat(children: list[tuple[tuple[str, ...], int, list]]) -> tuple[list[str], int, list]:
    """One stream of some neighbouring elements; equal neighbours (alone, in twos, ...) become a repeated group."""
    if len(children) == 1:
        return list(children[0][0]), children[0][1], children[0][2]
    out: list[tuple[tuple[str, ...], int, list]] = []  # tokens, slots, texts
    for tokens, slots, texts in children:
        out.append((tokens, slots, texts))
        again = True
        while again:
            again = False
            for period in range(1, min(8, len(out) // 2) + 1):
                a, b = out[-2 * period:-period], out[-period:]
                if all(_once(x[0]) == _once(y[0]) and x[0][0] != "#" for x, y in zip(a, b)) or (period == 1 and len(out) > 1 and _open(out[-2][0], out[-1][0])):
                    merged = _repeat(a, b)
                    out[-2 * period:] = merged
                    again = period == 1
                    break
    stream: list[str] = []
    total, all_texts = 0, []
    for tokens, slots, texts in out:
        stream.extend(tokens)
        all_texts += [(t[0] + total, *t[1:]) for t in texts]
        total += slots
    return stream, total, all_texts


def _once(tokens: tuple[str, ...]) -> tuple[str, ...]:
    return (tokens[0].lstrip("+"), *tokens[1:])


def _open(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
    """Whether ``b`` is one more turn of the repeated group ``a`` of one element."""
    return a[0].startswith("+") and _once(a) == _once(b)


def _repeat(a: list, b: list) -> list:
    """The first of two equal runs, marked as repeated, with the texts of both in page order."""
    if len(a) == 1:
        (tokens, slots, texts), (_, _, more) = a[0], b[0]
        texts += more  # same slot numbers; the list is the element's own
        return [(("+" + tokens[0].lstrip("+"), *tokens[1:]), slots, texts)]
    tokens, slots, texts = _flat_plain(a)
    _, _, more = _flat_plain(b)
    return [(("+(", *tokens, ">"), slots, texts + more)]


def _flat_plain(run: list) -> tuple[tuple[str, ...], int, list]:
    stream: list[str] = []
    total, texts = 0, []
    for tokens, slots, own in run:
        stream.extend(tokens)
        texts += [(t[0] + total, *t[1:]) for t in own]
        total += slots
    return tuple(stream), total, texts


def parse(source: str) -> tuple[list[str], list]:
    """Structure tokens ("+" marks repeated; element opening, "#" slot, ">" closing) and texts of a page.

    Missing end tags are closed as browsers do for paragraphs, list items and table
    cells; what is left open at the end is closed there. Elements without text have no token.
    """
    # an open element: [name, token, boilerplate, claim, children, header inside the article]
    stack: list[list] = [["", "", False, None, [], False]]
    run: list[str] = []
    links = [0, 0, 0]  # open links, characters inside links of the run, boilerplate inline depth
    state = {"boiler": 0, "article": 0, "main": 0, "content": 0, "header": 0, "heading": 0}

    def flush() -> None:
        if run:
            raw = "".join(run)
            text = " ".join(html.unescape(raw).split()) if raw and not raw.isspace() else ""
            if text:
                boiler = state["boiler"] > 0 or state["header"] > 0 and not state["heading"]
                item = (0, text, links[1], boiler, state["article"] > 0, state["main"] > 0, state["content"] > 0)
                stack[-1][4].append((("#",), 1, [item]))
            run.clear()
        links[1] = 0

    def count(el: list, by: int) -> None:
        state["boiler"] += by * el[2]
        if el[3]:
            state[el[3]] += by
        state["header"] += by * el[5]
        state["heading"] += by * (el[0] in HEADINGS)

    def close() -> None:
        flush()
        el = stack.pop()
        count(el, -1)
        stream, slots, texts = _flat(el[4])
        if slots:
            stack[-1][4].append(((el[1], *stream, ">"), slots, texts))

    for m in TOKEN.finditer(source):
        text = m["text"]
        if text is not None:
            run.append(text)
            if links[0]:
                links[1] += len(text.strip())
            continue
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["close"]:
            if name in INLINE:
                if name == "a":
                    links[0] = max(0, links[0] - 1)
                if stack[-1][0] == name:  # an inline element that stood for a container
                    close()
            elif name == "br" or name == "p" and not any(e[0] == "p" for e in stack):
                flush()
            else:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        while len(stack) > k:
                            close()
                        break
                links[0] = 0
            continue
        attrs = m["attrs"] or ""
        if name == "br":
            run.append(" ")
            continue
        if name in INLINE:
            if name == "a":
                links[0] = 1
            if attrs and name not in VOID and not attrs.rstrip().endswith("/"):
                token, boiler, _ = _kind(name, attrs, bool(state["article"] or state["main"]))
                if boiler:
                    flush()
                    stack.append([name, token, True, None, [], False])
                    count(stack[-1], 1)
            continue
        if name in VOID:
            flush()
            continue
        if name in NOT_IN_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    while len(stack) > k:
                        close()
                    break
                if stack[k][0] not in INLINE:
                    break
        if name in CLOSED_BY:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in KEEPS_OPEN[name]:
                    break
                if stack[k][0] in CLOSED_BY[name]:
                    while len(stack) > k:
                        close()
                    if name != "tr":
                        break
        flush()
        links[0] = 0
        in_main = bool(state["article"] or state["main"])
        token, boiler, main = _kind(name, attrs, in_main)
        stack.append([name, token, boiler, main, [], in_main and name == "header"])
        count(stack[-1], 1)
        if attrs.rstrip().endswith("/"):
            close()
    while len(stack) > 1:
        close()
    flush()
    stream, _, texts = _flat(stack[0][4])
    return stream, texts


# ---- wrappers -------------------------------------------------------------------------

# Statistics of a slot: pages, least and greatest text hash, characters, characters in
# links, pages with boilerplate, article, main and content containers, least and greatest
# hash of the page.
def _add(a: list, b: list) -> list:
    return [a[0] + b[0], min(a[1], b[1]), max(a[2], b[2]), *(x + y for x, y in zip(a[3:9], b[3:9])), *map(min, a[9:10], b[9:10]), *map(max, a[10:], b[10:])]


def _end(tokens: list[str], i: int) -> int:
    """Place after the element or slot that starts at ``i``."""
    if tokens[i].lstrip("+?") == "#":
        return i + 1
    depth, k = 1, i + 1
    while depth:
        t = tokens[k]
        depth += -1 if t == ">" else 0 if t.lstrip("+?") == "#" else 1
        k += 1
    return k


def _bare(token: str) -> str:
    return token.lstrip("+?")


def align(wrapper: list[str], w_stats: list[list], page: list[str], p_stats: list[list]) -> tuple[list[str], list[list], list[int]]:
    """The wrapper that also fits the page's structure, its slot statistics, and the slot
    of the new wrapper for each slot of the page.

    At a mismatch the next sibling that agrees is looked for on both sides; the nearer one
    wins, and what is passed over becomes optional. "?" marks optional, "+" repeated.
    """
    out: list[str] = []
    stats: list[list] = []
    slots: list[int] = []
    i = j = wi = pi = 0

    def take(tokens: list[str], begin: int, end: int, own: list[list], at: int, optional: bool, of_page: bool) -> int:
        for k in range(begin, end):
            token = tokens[k]
            if _bare(token) == "#":
                stats.append(own[at])
                if of_page:
                    slots.append(len(stats) - 1)
                at += 1
            out.append("?" + token if optional and k == begin and not token.startswith("?") else token)
        return at

    while i < len(wrapper) or j < len(page):
        w = wrapper[i] if i < len(wrapper) else ">"
        p = page[j] if j < len(page) else ">"
        if _bare(w) == _bare(p):
            marks = ("?" if "?" in w[:2] else "") + ("+" if "+" in w[:2] or "+" in p[:2] else "") if w != ">" else ""
            if _bare(w) == "#":
                stats.append(_add(w_stats[wi], p_stats[pi]))
                slots.append(len(stats) - 1)
                wi, pi = wi + 1, pi + 1
            out.append(marks + _bare(w))
            i, j = i + 1, j + 1
            continue
        skip_w, skip_p = _siblings(wrapper, i, p), _siblings(page, j, w)
        if p == ">" or w != ">" and skip_w is not None and (skip_p is None or skip_w[1] <= skip_p[1]):
            end = skip_w[0] if p != ">" else _end(wrapper, i)
            while i < end:
                nxt = _end(wrapper, i)
                wi = take(wrapper, i, nxt, w_stats, wi, True, False)
                i = nxt
        elif w == ">" or skip_p is not None:
            end = skip_p[0] if w != ">" else _end(page, j)
            while j < end:
                nxt = _end(page, j)
                pi = take(page, j, nxt, p_stats, pi, True, True)
                j = nxt
        else:
            nxt = _end(wrapper, i)
            wi = take(wrapper, i, nxt, w_stats, wi, True, False)
            i = nxt
            nxt = _end(page, j)
            pi = take(page, j, nxt, p_stats, pi, True, True)
            j = nxt
    return out, stats, slots


def _siblings(tokens: list[str], i: int, wanted: str) -> tuple[int, int] | None:
    """(place, siblings passed) of the next sibling that agrees with a token, if there is one."""
    if wanted == ">":
        return None
    passed, bare = 0, _bare(wanted)
    while i < len(tokens) and tokens[i] != ">":
        if _bare(tokens[i]) == bare:
            return i, passed
        i = _end(tokens, i)
        passed += 1
    return None


def regular_expression(wrapper: list[str]) -> str:
    """A wrapper as text: ``( ... )?`` optional, ``( ... )+`` repeated, ``#`` text."""
    out: list[str] = []
    marks: list[str] = []
    for token in wrapper:
        if token == ">":
            mark = marks.pop()
            out.append(f"){mark}" if mark else ")")
        elif _bare(token) == "#":
            out.append("#" + ("?" if token.startswith("?") else ""))
        else:
            mark = ("+" if "+" in token[:2] else "") + ("?" if "?" in token[:2] else "")
            marks.append({"+?": "*"}.get(mark, mark))
            out.append(f"({_bare(token).lstrip('(')}")
    return " ".join(out)


def fold(rows: list[tuple[list[str], list[list]]]) -> tuple[list[str], list[list]]:
    """Aligns structures, the most frequent first, into one wrapper."""
    rows = sorted(rows, key=lambda r: (-max((s[0] for s in r[1]), default=0), r[0]))
    wrapper, stats = rows[0]
    for tokens, own in rows[1:]:
        wrapper, stats, _ = align(wrapper, stats, tokens, own)
    return wrapper, stats


def verdicts(slots: list[list], own: list[list]) -> str:
    """For each slot of a structure 1 (article text) or 0, given the statistics of its
    slots in the wrapper and in the structure itself.

    Boilerplate containers never count. If the structure has an article element, its slots
    count; else those of a main element, else of a container named like content, else all
    slots whose text differs between pages and is not mostly link text. In a container
    named like content or main too, a text that is the same on several pages and mostly
    link text does not count.
    """
    clean = [s[5] * 2 <= s[0] for s in slots]
    for claim in (6, 7, 8):
        region = [c and o[claim] > 0 and o[5] == 0 for c, o in zip(clean, own)]
        if any(region):
            linked = [claim > 6 and s[4] * 2 > s[3] and _fixed(s) for s in slots]
            return "".join("1" if r and not x else "0" for r, x in zip(region, linked))
    return "".join("1" if c and o[5] == 0 and not _fixed(s) and s[4] * 2 <= s[3] else "0" for c, s, o in zip(clean, slots, own))


def _fixed(s: list) -> bool:
    """Whether a slot holds one text on all of several pages; copies of a page are one page."""
    return s[9] < s[10] and s[1] == s[2]


# ---- Spark ----------------------------------------------------------------------------

def _sig(tokens: list[str]) -> int:
    return xxhash.xxh64_intdigest(" ".join(tokens).encode()) - (1 << 63)


def _structures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct structures of a task's pages with their slot statistics."""
    found: dict[tuple[str, int], tuple[list[str], list[list]]] = {}

    def flush() -> pa.RecordBatch:
        keys = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
             pa.array([" ".join(found[k][0]) for k in keys], pa.string()), pa.array([json.dumps(found[k][1]) for k in keys], pa.string())],
            ["host", "sig", "tokens", "stats"])

    for batch in batches:
        for host, source in zip(batch.column(0), batch.column(1)):
            page = Page(source.as_py())
            if not page.texts:
                continue
            slots: dict[int, list] = {}
            whole = zlib.crc32((source.as_py() or "").encode())
            for slot, text, link, *flags in page.texts:
                h = zlib.crc32(text.encode())
                s = slots.get(slot)
                own = [1, h, h, len(text), link, *map(int, flags), whole, whole]
                slots[slot] = own if s is None else [1, min(s[1], h), max(s[2], h), s[3] + own[3], s[4] + own[4], *(max(a, b) for a, b in zip(s[5:], own[5:]))]
            stats = [slots[k] for k in range(len(slots))]
            key = (host.as_py(), _sig(page.tokens))
            old = found.get(key)
            found[key] = (page.tokens, stats if old is None else [_add(a, b) for a, b in zip(old[1], stats)])
            if len(found) >= 2000:
                yield flush()
                found.clear()
    if found:
        yield flush()


def _read(table: pa.Table) -> list[tuple[list[str], list[list]]]:
    return [(t.as_py().split(" "), json.loads(s.as_py())) for t, s in zip(table.column("tokens"), table.column("stats"))]


def _sum_stats(table: pa.Table) -> pa.Table:
    """One row per structure."""
    found: dict[int, tuple[str, list[list]]] = {}
    for sig, tokens, stats in zip(*(table.column(c).to_pylist() for c in ("sig", "tokens", "stats"))):
        old = found.get(sig)
        found[sig] = (tokens, json.loads(stats) if old is None else [_add(a, b) for a, b in zip(old[1], json.loads(stats))])
    n = len(found)
    return pa.table({"host": pa.array([table.column("host")[0].as_py()] * n, pa.string()), "sig": pa.array(list(found), pa.int64()),
                     "tokens": pa.array([t for t, _ in found.values()], pa.string()), "stats": pa.array([json.dumps(s) for _, s in found.values()], pa.string())})


def _fold_group(table: pa.Table) -> pa.Table:
    wrapper, stats = fold(_read(table))
    return pa.table({"host": table.column("host")[:1], "tokens": pa.array([" ".join(wrapper)]), "stats": pa.array([json.dumps(stats)])})


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for tokens, stats, wrapper, w_stats in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5))):
            own, whole = json.loads(stats), json.loads(w_stats)
            zero = [[0, 1 << 40, -1, 0, 0, 0, 0, 0, 0, 1 << 40, -1] for _ in own]
            _, merged, slots = align(wrapper.split(" "), whole, tokens.split(" "), zero)
            kept.append(verdicts([m if m[0] else o for m, o in zip((merged[k] for k in slots), own)], own))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.string())], ["host", "sig", "kept"])


def _texts(carried: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [Page(s.as_py()) for s in batch.column(carried + 1)]
            slots = pa.array([[t[0] for t in p.texts] for p in pages], pa.list_(pa.int32()))
            texts = pa.array([[t[1] for t in p.texts] for p in pages], pa.list_(pa.string()))
            sigs = pa.array([_sig(p.tokens) if p.texts else None for p in pages], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:carried + 1], sigs, slots, texts], names)

    return run


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(structures, wrappers): (host, sig, tokens, stats) per distinct page structure, and
    (host, tokens, stats) per host. ``regular_expression`` writes a wrapper's tokens."""
    rows = pages.select(_host(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))
    parts = rows.mapInArrow(_structures, "host string, sig long, tokens string, stats string")
    kinds = cut_lineage(parts.withColumn("salt", F.pmod("sig", F.lit(1024))).groupBy("host", "salt")
                        .applyInArrow(_sum_stats, "host string, sig long, tokens string, stats string"))
    wrappers = kinds.select("host", "tokens", "stats")
    while True:  # groups of about `group` rows, until each host has one wrapper
        sizes = wrappers.groupBy("host").agg(F.count("*").alias("n"))
        most = sizes.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return kinds, wrappers
        dealt = wrappers.join(sizes, "host").withColumn("salt", F.pmod(F.xxhash64("tokens"), F.ceil(F.col("n") / group)))
        wrappers = cut_lineage(dealt.groupBy("host", "salt").applyInArrow(_fold_group, "host string, tokens string, stats string"))


def _host(url_col: str):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url_col).cast("string"), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1), F.lit("")))


def extract_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` without the html, then ``out``: the main text, blocks in page order joined
    by two line feeds, white space inside a block turned into one space, character
    references decoded.

    A null or empty page, and one without article text, has an empty text. Pages without
    a host (null or odd urls) share one wrapper. One output row per input row, repeated
    rows included; a column named like ``out`` is replaced, others stay.
    """
    carried = [c for c in pages.columns if c not in (html_col, out)]
    kinds, wrappers = infer_wrappers(pages, url_col, html_col)
    both = kinds.join(wrappers.select("host", F.col("tokens").alias("wrapper"), F.col("stats").alias("whole")), "host")
    judged = both.select("host", "sig", "tokens", "stats", "wrapper", "whole").mapInArrow(_judge, "host string, sig long, kept string")
    host, sig, slots, found, kept, html_ = unused([*pages.columns, out], "_host", "_sig", "_slots", "_texts", "_kept", "_html")
    source = pages.select(*carried, _host(url_col).alias(host), F.col(html_col).cast("string").alias(html_))
    schema = plus(source.drop(html_).schema, f"{sig} long, {slots} array<int>, {found} array<string>")
    texts = source.mapInArrow(_texts(len(carried), [*carried, host, sig, slots, found]), schema)
    joined = texts.join(judged.select(F.col("host").alias(host), F.col("sig").alias(sig), F.col("kept").alias(kept)), [host, sig], "left")
    blocks = F.filter(F.arrays_zip(slots, found), lambda x: F.substring(F.col(kept), x[slots] + 1, F.lit(1)) == "1")
    text = F.array_join(F.transform(blocks, lambda x: x[found]), "\n\n")
    return joined.select(*carried, F.coalesce(text, F.lit("")).alias(out))
