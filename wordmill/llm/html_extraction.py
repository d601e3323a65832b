"""Main text of web pages by wrappers inferred from pages of the same host.

A page becomes a stream of tokens: block tags and text. Pages of one host are aligned with the
host's wrapper one after the other, element by element, and the wrapper is a union-free regular
expression of such tokens: where a page and the wrapper differ in text, the text becomes a slot;
where one has elements that the other has not, they become optional; elements alike in a row
become a repeated group, and where more than ``ROW`` unlike ones stand side by side, or alike ones
come again later, all of them become one repeated group of optional elements. Text that most
different pages have in one place is template, places that hold mostly links are menus, and what
the slots of a place hold in all pages together says where the content is. How many different pages
have a text or a place is counted by Spark over all pages of the host.

A list of elements is at most twice ``ROW`` long or has every key once, so two wrappers are aligned
in time linear in their size, and a wrapper grows with the places of a host, not with its pages.

Every map task aligns the pages it reads and sends one wrapper per host; wrappers are aligned
with each other in the same way, so no task gathers the pages of a host. Pages are then read
again: what the page's own markup says is content or not is where the search starts, and template
texts, inside article as elsewhere, and menus outside of it are left out by the wrapper.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wordmill.sources.checkpoints import materialise

MIN_PAGES = 4  # pages of different main text that have to agree in a text before it counts as template
MIN_SHARE = 0.5  # and their share of all such pages of the host
ROW = 12  # more elements side by side than this are a group
KEYS = 64  # and a group of more classes than this goes by tags alone
DEPTH = 48  # elements further in share the place of the one around them
FAN_IN = 64
HOSTS_PER_TASK = 2000  # wrappers a task holds before it sends them on
_FOUND = {"host": "object", "wrapper": "object", "path": "object", "text": "Int64", "main": "Int64"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|xmp|noembed|noframes)\b[^>]*+>.*?(?:</\1\s*+[^>]*+>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[/]?[a-zA-Z][^>]*+>"
    r"|[^<]++|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# How HTML names its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAVES = frozenset("p li dt dd td th tr h2 h3 h4 h5 h6 blockquote pre figcaption".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

# Elements, roles and words in class and id that are never part of an article.
DROPPED = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea iframe object svg math "
    "canvas audio video menu dialog search".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "popup modal overlay newsletter subscribe subscription signup login sidebar rail menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead topbar toolbar comment comments commentlist disqus reply replies respond share sharing social "
    "related recommended recommendations widget pagination pager skip copyright legal disclaimer".split()
)
# "header" is dropped outside of these only, as articles have headers of their own.
CONTENT = frozenset(["article", "main"])


class Block:
    """A run of text between block tags."""

    __slots__ = ("path", "inside", "dropped", "text", "menu")

    def __init__(self, path, inside, dropped, text, menu=False):
        self.path, self.inside, self.dropped, self.text, self.menu = path, inside, dropped, text, menu


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)}


def _unwanted(tag: str, raw: str, inside: str) -> bool:
    if tag in DROPPED or (tag == "header" and not inside):
        return True
    if not raw or raw.isspace() or tag in ("html", "body", "article", "main"):
        return False
    attributes = _attributes(raw)
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True
    if attributes.get("role", "").lower() in DROPPED_ROLES:
        return True
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    words = {word.lower() for word in _NAME.findall(named)}
    return bool(words & DROPPED_NAMES) or ("header" in words and not inside)


def _key(tag: str, raw: str) -> str:
    found = _attributes(raw).get("class", "").split() if "class" in raw or "CLASS" in raw else ()
    return f"{tag}.{found[0]}" if found else tag


def parse(html: str) -> tuple[list[Block], list[str]]:
    """The blocks of a page, and its stream of block tags, with ``#`` for text."""
    blocks, stream, stack, pieces, linked = [], [], [], [], []
    opened = Counter()
    in_link = False

    def flush():
        nonlocal in_link
        in_link = False  # a link that was never closed ends with its block
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            in_links = " ".join(unescape("".join(linked)).split())
            pieces.clear()
            linked.clear()
            if text:
                path, inside, dropped = stack[-1][1:4] if stack else ("", "", False)
                menu = 2 * len(in_links) > len(text) and path.rsplit("/", 1)[-1].split(".")[0] not in HEADINGS
                blocks.append(Block(path, inside, dropped, text, menu))
                stream.append("#")

    def pop(to: int):
        flush()
        while len(stack) > to:
            tag, _, _, _, key = stack.pop()
            opened[tag] -= 1
            if key:
                stream.append("/" + key)

    def push(*entry):
        stack.append(entry)
        opened[entry[0]] += 1

    def find(names, stops=()):
        if not any(opened[name] for name in names):
            return -1
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                return k
            if stack[k][0] in stops:
                return -1
        return -1

    # What follows the last tag end is text; searching it for tags would take quadratic time.
    end = html.rfind(">") + 1
    for m in _TOKEN.finditer(html, 0, end):
        tag = m[3]
        if tag is None:
            token = m[0]
            if m[1] and m[1].lower() in ("textarea", "xmp"):
                continue
            if token[0] != "<" or token == "<":
                pieces.append(token)
                if in_link:
                    linked.append(token)
            continue
        tag = tag.lower()
        block = tag in BLOCKS
        if tag == "a":
            in_link = not m[2]
            linked.append(" ")
        if m[2]:
            if block or opened[tag]:
                at = find({tag})
                if at >= 0:
                    pop(at)
                elif block:
                    flush()
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if block:
            flush()
            at = find(SIBLINGS[tag], ENDS[tag]) if tag in SIBLINGS else -1
            if at < 0 and tag not in ("html", "body"):
                at = find({"p"}, {"td", "th", "li", "table", "button"}) if tag != "p" or stack else -1
            if at >= 0:
                pop(at)
        path, inside, dropped = stack[-1][1:4] if stack else ("", "", False)
        unwanted = dropped or _unwanted(tag, m[4], inside)
        if not block:
            # Inline elements only matter where they drop text.
            if unwanted:
                if not dropped:
                    flush()
                push(tag, path, inside, True, "")
            continue
        key = _key(tag, m[4])
        within = tag if tag in CONTENT and inside != "article" else inside
        if not within and 'role="main"' in m[4]:
            within = "main"
        if len(stack) >= DEPTH:
            push(tag, path, within, unwanted, "")
            continue
        push(tag, f"{path}/{key}", within, unwanted, key)
        stream.append(key)
    pieces.append(html[end:].split("<!--", 1)[0])
    pop(0)
    return blocks, stream


def _marked(blocks: list[Block]) -> list[Block]:
    """The blocks the page's own markup says are content, or all that it doesn't say are not."""
    left = [b for b in blocks if not b.dropped]
    return [b for b in left if b.inside == "article"] or [b for b in left if b.inside] or left


def _main_hash(blocks: list[Block]) -> int:
    """A number that copies of a page share, whatever stands around their main text."""
    text = "\n".join(b.text for b in _marked(blocks))
    return int.from_bytes(hashlib.blake2b(text.encode(errors="surrogatepass"), digest_size=8).digest(), signed=True)


def _digest(path: str, text: str) -> int:
    whole = f"{path}\n{text}".encode(errors="surrogatepass")
    return int.from_bytes(hashlib.blake2b(whole, digest_size=8).digest(), signed=True)


class Place:
    """An element or text of the wrapper, with the elements in it.

    ``repeated`` and ``optional`` are as in regular expressions; in a ``group`` the elements inside
    come in any order and number. ``text`` is the digest of the only text seen here, and ``varies``
    says that there were others. ``chars`` of text were seen in all pages, ``linked`` of them in
    blocks that are mostly links. ``shown`` is the first text, for people.
    """

    __slots__ = ("key", "repeated", "optional", "group", "shown", "text", "varies", "chars", "linked", "inner")

    def __init__(self, key, repeated=False, optional=False, group=False, shown="", text=None, varies=False, chars=0, linked=0, inner=()):
        self.key, self.repeated, self.optional, self.group, self.shown = key, repeated, optional, group, shown
        self.text, self.varies, self.chars, self.linked, self.inner = text, varies, chars, linked, list(inner)

    def dump(self) -> list:
        inner = [place.dump() for place in self.inner]
        return [self.key, self.repeated, self.optional, self.group, self.shown, self.text, self.varies, self.chars, self.linked, inner]

    @classmethod
    def load(cls, dumped: list) -> Place:
        *head, inner = dumped
        return cls(*head, map(cls.load, inner))

    def take(self, other: Place):
        """Be the place of what ``other`` is the place of, too."""
        self.repeated |= other.repeated
        self.optional |= other.optional
        self.chars += other.chars
        self.linked += other.linked
        # Where one has a text and the other none, its block was dropped there.
        self.varies |= other.varies or self.text != other.text
        self._align(other)

    def _align(self, other: Place):
        mine, theirs = self.inner, other.inner
        if not mine and not theirs:
            return
        if self.group or other.group:
            self._grouped([*mine, *theirs])
            return
        if [place.key for place in mine] == [place.key for place in theirs]:
            for place, its in zip(mine, theirs):
                place.take(its)
            return
        # The longest common run of keys in order; at most twice ROW times ROW comparisons.
        best = [[0] * (len(theirs) + 1) for _ in range(len(mine) + 1)]
        for i in range(len(mine) - 1, -1, -1):
            for j in range(len(theirs) - 1, -1, -1):
                same = mine[i].key == theirs[j].key
                best[i][j] = best[i + 1][j + 1] + 1 if same else max(best[i + 1][j], best[i][j + 1])
        merged, i, j = [], 0, 0
        while i < len(mine) or j < len(theirs):
            if i < len(mine) and j < len(theirs) and mine[i].key == theirs[j].key:
                mine[i].take(theirs[j])
                merged.append(mine[i])
                i, j = i + 1, j + 1
                continue
            from_mine = j == len(theirs) or (i < len(mine) and best[i + 1][j] >= best[i][j + 1])
            merged.append(mine[i] if from_mine else theirs[j])
            merged[-1].optional = True
            i, j = i + from_mine, j + (not from_mine)
        self.inner = merged
        if len(merged) > 2 * ROW:
            self._grouped(merged)

    def _grouped(self, places: list[Place]):
        self.group = True
        by_tag = len({place.key for place in places}) > KEYS or any(place.key.endswith(".*") for place in places)
        found = {}
        for place in places:
            if by_tag and place.key != "#":
                place.key = place.key.split(".")[0] + ".*"
            place.optional = True
            if place.key in found:
                place.repeated = True
                found[place.key].take(place)
            else:
                found[place.key] = place
        self.inner = list(found.values())

    def fold(self):
        """Make repeated groups of the elements of a page."""
        if len(self.inner) < 2:
            return
        folded, last = [], None
        for place in self.inner:
            shape = [inner.key for inner in place.inner]
            alike = folded and folded[-1].key == place.key
            if alike and (shape == last or place.key.split(".")[0] in LEAVES or "." in place.key):
                folded[-1].repeated = True
                folded[-1].take(place)
            else:
                folded.append(place)
            last = shape
        self.inner = folded
        if len(folded) < 3:  # alike ones have to have another between them to come again
            return
        again = Counter(place.key for place in folded)
        if len(folded) > ROW or any(n > 1 and (key == "#" or "." in key or key in LEAVES) for key, n in again.items()):
            self._grouped(folded)

    def tokens(self, optional: bool = False) -> list[str]:
        optional = optional or self.optional
        if self.key == "#":
            token = json.dumps(self.shown, ensure_ascii=False) if self.shown and not self.varies else "#"
        elif self.key.split(".")[0] in LEAVES and [inner.key for inner in self.inner] == ["#"]:
            token = f"({self.key} # /{self.key})"
        elif self.repeated or self.group:
            within = " ".join(token for inner in self.inner for token in inner.tokens())
            token = f"({self.key} {f'({within})+' if self.group else within} /{self.key})"
        else:
            tokens = [self.key, *(token for inner in self.inner for token in inner.tokens(optional)), "/" + self.key]
            return [f"({tokens[0]})?", *tokens[1:-1], f"({tokens[-1]})?"] if optional else tokens
        token = f"{token}+" if self.repeated else token
        return [f"({token})?" if optional else token]

    def walk(self, path: str = ""):
        """All texts inside, each with the path that leads to it."""
        for inner in self.inner:
            if inner.key == "#":
                yield path, inner
            else:
                yield from inner.walk(f"{path}/{inner.key}")


class Wrapper:
    """A host's expression, from ``pages`` pages, as a tree of places."""

    def __init__(self, pages: int = 0, root: Place | None = None):
        self.pages, self.root = pages, root or Place("")

    def _take(self, root: Place, pages: int):
        if self.pages:
            self.root.take(root)
        else:
            self.root = root
        self.pages += pages

    def add_page(self, blocks: list[Block], stream: list[str]):
        at, stack = 0, [Place("")]
        for token in stream:
            if token[0] == "/":
                stack.pop().fold()
                continue
            place = Place(token)
            stack[-1].inner.append(place)
            if token != "#":
                stack.append(place)
                continue
            block = blocks[at]
            at += 1
            if not block.dropped:
                place.chars = len(block.text)
                place.linked = place.chars if block.menu else 0
                place.text = _digest(block.path, block.text)
                place.shown = block.text if len(block.text) <= 40 else ""
        stack[0].fold()
        self._take(stack[0], 1)

    def add(self, other: Wrapper):
        self._take(other.root, other.pages)

    def dump(self) -> str:
        return json.dumps([self.pages, self.root.dump()], ensure_ascii=False)

    @classmethod
    def load(cls, dumped: str) -> Wrapper:
        pages, root = json.loads(dumped)
        return cls(pages, Place.load(root))

    def expression(self) -> str:
        """The wrapper as a regular expression over tokens, for people to read."""
        return " ".join(token for place in self.root.inner for token in place.tokens())

    def rules(self, shared: list[tuple[str, bool, bool, list[int]]]) -> str:
        """What extraction needs: template texts, menu places, and the path that holds most content.

        ``shared`` is what the different pages of the host share, of all of them: paths, whether enough
        pages have the path, whether all texts there are template, and which texts are.
        """
        common = {path for path, often, _, _ in shared if often}
        whole = {path for path, _, known, _ in shared if known}
        template = {text for *_, texts in shared for text in texts}
        menus, mass = set(), Counter()
        for path, place in self.root.walk():
            if path in common and 2 * place.linked > place.chars:
                menus.add(path)
            if place.chars and path not in whole:
                # A place's content counts for all elements around it, less the further out.
                steps = path.split("/")
                for depth in range(1, len(steps)):
                    mass["/".join(steps[: depth + 1])] += place.chars
        total = max(mass.values(), default=0)
        holding = [path for path, chars in mass.items() if chars >= 0.6 * total and path.rsplit("/", 1)[-1].split(".")[0] not in LEAVES]
        region = max(holding, key=lambda p: (p.count("/"), mass[p], p), default="")
        return json.dumps({"template": sorted(template), "menus": sorted(menus), "region": region}, ensure_ascii=False)


def extract(html: str, rules: dict | None = None) -> str:
    """The main text of a page, blocks joined by line ends.

    The search starts in article, else in main, else everywhere. Left out is what is never content
    by its markup, then, outside of article, blocks that are mostly links in a menu place of the
    host or beside the path that holds most text of its pages, unless that is all there is, and
    then the host's template texts, unless they are more than half of what is left.
    """
    rules = rules or {}
    left = [block for block in parse(html)[0] if not block.dropped]
    chosen = [b for b in left if b.inside == "article"]
    if not chosen:
        chosen = [b for b in left if b.inside] or left
        menus, region = set(rules.get("menus", ())), rules.get("region", "")

        def is_menu(b):
            beside = region and not b.inside and b.path != region and not b.path.startswith(region + "/")
            return b.menu and (beside or b.path in menus)

        chosen = [b for b in chosen if not is_menu(b)] or chosen
    template = set(rules.get("template", ()))
    content = [b.text for b in chosen if _digest(b.path, b.text) not in template] if template else [b.text for b in chosen]
    # What all pages of a host share may be what copies of one page share.
    if 2 * sum(map(len, content)) < sum(len(b.text) for b in chosen):
        content = [b.text for b in chosen]
    return "\n".join(content)


def _infer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A wrapper per host, and a row per block of a page: its path and text, and the page's main text."""
    wrappers: dict[str, Wrapper] = {}

    def sent():
        rows = pd.DataFrame({"host": list(wrappers), "wrapper": [w.dump() for w in wrappers.values()]})
        wrappers.clear()
        return rows.reindex(columns=list(_FOUND)).astype(_FOUND)

    for rows in batches:
        seen = {}
        for host, html in zip(rows["host"], rows["html"]):
            blocks, stream = parse(html)
            wrappers.setdefault(host, Wrapper()).add_page(blocks, stream)
            main = _main_hash(blocks)
            seen[host, None, None, main] = None
            for block in blocks:
                seen[host, block.path, None if block.dropped else _digest(block.path, block.text), main] = None
            if len(wrappers) > HOSTS_PER_TASK:
                yield sent()
        found = pd.DataFrame(list(seen), columns=["host", "path", "text", "main"], dtype=object)
        yield found.reindex(columns=list(_FOUND)).astype(_FOUND)
    if wrappers:
        yield sent()


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    whole = Wrapper()
    for dumped in sorted(rows["wrapper"]):
        whole.add(Wrapper.load(dumped))
    return pd.DataFrame({"host": rows["host"].iloc[:1], "wrapper": [whole.dump()]})


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))
    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))


def wrappers(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``host, wrapper`` of all hosts, each from all of its pages, and ``host, path, text, main`` of their blocks, kept.

    Of the latter, each page also has a row without a path.
    """
    schema = "host string, wrapper string"
    found = _with_host(pages).select("host", "html").mapInPandas(_infer, f"{schema}, path string, text bigint, main bigint")
    found = materialise(found, "found")
    parts = found.where("wrapper IS NOT NULL").select("host", "wrapper")
    dealt = parts.withColumn("piece", F.pmod(F.xxhash64("wrapper"), F.lit(FAN_IN)))
    merged = dealt.groupBy("host", "piece").applyInPandas(_merge, schema)
    blocks = found.where("wrapper IS NULL").select("host", "path", "text", "main")
    return materialise(merged.groupBy("host").applyInPandas(_merge, schema), "wrappers"), blocks


def shared_places(blocks: DataFrame) -> DataFrame:
    """What different pages of a host share: ``host, shared``, an array of ``path, often, whole, texts``.

    All pages count, copies of a page once. ``often`` says that enough pages have the path, ``texts``
    are the texts that enough pages have there, ``whole`` says that there are no others. Paths with
    neither are left out, so a host has no more of them than twice those of its average page.
    """
    blocks = blocks.distinct()
    pages = blocks.where("path IS NULL").groupBy("host").agg(F.count("*").alias("pages"))
    enough = F.greatest(F.lit(float(MIN_PAGES)), MIN_SHARE * F.col("pages"))
    texts = blocks.where("path IS NOT NULL").groupBy("host", "path", "text").agg(F.count("*").alias("met")).join(pages, "host")
    is_text = F.col("text").isNotNull()
    known = is_text & (F.col("met") >= enough)
    by_text = texts.groupBy("host", "path").agg(
        F.collect_list(F.when(known, F.col("text"))).alias("texts"),
        (F.bool_or(known) & ~F.bool_or(is_text & ~known)).alias("whole"),
    )
    met = blocks.where("path IS NOT NULL").select("host", "path", "main").distinct().groupBy("host", "path").agg(F.count("*").alias("met"))
    often = met.join(pages, "host").select("host", "path", (F.col("met") >= enough).alias("often"))
    places = by_text.join(often, ["host", "path"]).where((F.size("texts") > 0) | F.col("often"))
    return places.groupBy("host").agg(F.to_json(F.collect_list(F.struct("path", "often", "whole", "texts"))).alias("shared"))


@F.pandas_udf(StringType())
def _rules(dumped: pd.Series, shared: pd.Series) -> pd.Series:
    def places(text):
        return [(p["path"], p["often"], p["whole"], p["texts"]) for p in json.loads(text)] if text else []

    return pd.Series([Wrapper.load(one).rules(places(text)) for one, text in zip(dumped, shared)], dtype=object)


@F.pandas_udf(StringType())
def _extract(html: pd.Series, rules: pd.Series) -> pd.Series:
    known = {text: json.loads(text) for text in rules.dropna().unique()}
    return pd.Series([extract(page, known.get(text)) for page, text in zip(html, rules)], dtype=object)


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    Null html is an empty page, whose text is empty; pages without a host are a host of their
    own. Repeated rows come out repeatedly. Other columns are not read.
    """
    found, blocks = wrappers(pages)
    known = found.join(shared_places(blocks), "host", "left")
    rules = materialise(known.select("host", _rules("wrapper", "shared").alias("rules")), "rules")
    text = _with_host(pages).join(rules, "host", "left").select("page_id", "url", _extract("html", "rules").alias("text"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
