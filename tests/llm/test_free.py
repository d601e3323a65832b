"""SimHash, decontamination, substring dedup, WARC, extraction and toxicity, by brute force."""

import gzip
import hashlib
import json
import math
import random
import re
import time
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm import cases
from wordmill.llm import components, decontamination, html_extraction, simhash, substring_dedup, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reference_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    w = WORD.findall(lower)
    if not w:
        return 0
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(n, linked):
    root = list(range(n))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def test_components_by_fingerprints(spark):
    found = cases.rows()
    rows = simhash.near_duplicates(cases.documents(spark, found)).collect()
    prints = [reference_fingerprint(t) for _, t in found]
    n = len(found)
    groups = classes(n, [(a, b) for a in range(n) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])
    least = {g: min((i for (i, _), h in zip(found, groups) if h == g and i is not None), default=None) for g in groups}
    expected = Counter((i, f"{p:016x}", least[g]) for (i, _), p, g in zip(found, prints, groups))
    assert Counter(map(tuple, rows)) == expected
    assert simhash.near_duplicates(cases.empty(spark)).isEmpty()


@pytest.mark.parametrize("piece", [4, simhash.PIECE])
def test_anchors_find_every_link(spark, piece):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(200)}
    centre = rng.getrandbits(64)
    prints |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(200)}
    chain = rng.getrandbits(64)
    for _ in range(60):  # three bits from one to the next
        for bit in rng.sample(range(64), 3):
            chain ^= 1 << bit
        prints.add(chain)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    pairs = simhash.links(nodes, piece)
    roots = {r.node: r.root for r in components.components(pairs).collect()}
    groups = classes(len(prints), [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])
    least = {}
    for g, p in zip(groups, signed):
        least[g] = min(least.get(g, p), p)
    assert [roots.get(p, p) for p in signed] == [least[g] for g in groups]


def test_first_of_each_group_stays(spark):
    found = [(5, "a b c d"), (3, "A b c d"), (9, "x y z"), (9, "x y z"), (None, "q r s"), (None, "q r s"), (7, None), (8, "")]
    docs = cases.documents(spark, found)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(3, "A b c d"), (9, "x y z"), (None, "q r s"), (7, None)])
    assert simhash.keep_first(cases.empty(spark)).isEmpty()


def test_every_component_shape(spark):
    pairs = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (-5, 300), (300, 301), (-5, 301)]
    out = components.components(spark.createDataFrame(pairs, "u long, v long"))
    expected = {k: 1 for k in range(2, 41)} | {k: 100 for k in range(101, 140)} | {300: -5, 301: -5}
    assert {r.node: r.root for r in out.collect()} == expected


def slow_alignment(item, words):
    best, table = 0, [[0] * (len(words) + 1) for _ in range(len(item) + 1)]
    for a in range(1, len(item) + 1):
        for b in range(1, len(words) + 1):
            pair = table[a - 1][b - 1] + (2 if item[a - 1] == words[b - 1] else -1)
            table[a][b] = max(0, pair, table[a - 1][b] - 1, table[a][b - 1] - 1)
            best = max(best, table[a][b])
    return best / (2 * len(item))


def test_alignment_is_smith_waterman():
    rng = random.Random(2)
    for _ in range(60):
        item, words = rng.choices("abcdef", k=rng.randint(1, 9)), rng.choices("abcdefg", k=rng.randint(0, 14))
        assert decontamination.best_alignment(item, words)[0] == pytest.approx(slow_alignment(item, words))


def leaks(rng, items):
    found, planted = [], set()
    for k, item in enumerate(items):
        host, at = cases.words(rng, 200), rng.randrange(200)
        body = item.split()
        if k % 3 == 1:  # edited: every seventh word replaced, one left out
            body = ["new" if j % 7 == 3 else w for j, w in enumerate(body)][:-1]
        if k % 3 == 2:  # a short quotation is no leak
            body = body[:6]
        else:
            planted.add((k, k))
        found.append((k, " ".join(host[:at] + [w.upper() + "," for w in body] + host[at:])))
    return found, planted


def test_copies_and_edited_copies_are_found(spark):
    rng = random.Random(3)
    items = [" ".join(f"{w}{rng.randrange(30)}" for w in cases.words(rng, rng.randint(20, 45))) for _ in range(12)]
    found, planted = leaks(rng, items)
    found += [(50 + k, " ".join(cases.words(rng, 150))) for k in range(20)] + cases.rows()[-12:]
    found += [(k, found[0][1]) for k in range(200, 260)]  # one item in a great share of all documents
    table = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (92, "too short")], "item_id long, text string").withColumn("n", F.lit(1))
    docs = cases.documents(spark, found)
    out = decontamination.contaminated(docs, table).collect()
    assert {(r.doc_id, r.item_id) for r in out} == planted | {(k, 0) for k in range(200, 260)}
    assert all(r.score == 1 for r in out if r.doc_id % 3 == 0 and r.doc_id < 50)
    left = decontamination.without_items(docs, table)
    gone = {i for i, _ in planted} | set(range(200, 260))
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, _ in found if i not in gone)
    assert decontamination.contaminated(cases.empty(spark), table).isEmpty()
    assert decontamination.contaminated(docs, table.limit(0)).isEmpty()


def test_many_edited_copies_of_one_item_are_found(spark):
    rng = random.Random(8)
    item = [f"{w}{k}" for k, w in enumerate(cases.words(rng, 40))]
    # Words 18 to 20 differ in all copies, so the runs there are in no document; all others are in a hundred.
    edited = " ".join("new" if 18 <= k <= 20 else w for k, w in enumerate(item))
    found = [(k, " ".join([*cases.words(rng, 60), edited, *cases.words(rng, 60)])) for k in range(100)]
    found += [(100, " ".join(item))] + [(200 + k, " ".join(cases.words(rng, 150))) for k in range(20)]
    table = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = cases.documents(spark, found)
    assert {r.doc_id for r in decontamination.contaminated(docs, table).collect()} == set(range(101))
    assert {r.doc_id for r in decontamination.without_items(docs, table).collect()} == set(range(200, 220))


def brute_substrings(found):
    cut = [(i, WORD.findall(t or "")) for i, t in found]
    least = {}
    for i, w in cut:
        for k in range(len(w) - 12 if i is not None else 0):
            key = tuple(w[k : k + 13])
            least[key] = min(least.get(key, i), i)
    for i, w in cut:
        gone = {k + j for k in range(len(w) - 12 if i is not None else 0) if least[tuple(w[k : k + 13])] < i for j in range(13)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        yield i, len(w), len(gone), kept


def substring_rows(seed):
    rng = random.Random(seed)
    base = cases.words(rng, 400)
    found = cases.rows(seed)
    for k in range(30):  # cuts of one long text at all offsets, of lengths around the window
        at, size = rng.randrange(300), rng.choice([11, 12, 13, 14, 20, 60])
        found.append((rng.randrange(500), " ".join(cases.words(rng, 9) + base[at : at + size] + cases.words(rng, 9))))
    return found + [(2**60 + 1, " ".join(base)), (2**60, " ".join(base))]


@pytest.mark.parametrize("seed", [1, 2])
def test_words_that_repeat_smaller_documents_go(spark, seed, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PART_BYTES", 3000)
    found = substring_rows(seed)
    docs = cases.documents(spark, found)
    expected = list(brute_substrings(found))
    digests = Counter((i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in expected)
    assert Counter(map(tuple, substring_dedup.substring_dedup(docs).collect())) == digests
    assert Counter(map(tuple, substring_dedup.deduplicated(docs).collect())) == Counter((i, kept) for i, _, _, kept in expected)


def test_no_documents_and_no_repeats(spark):
    assert substring_dedup.substring_dedup(cases.empty(spark)).isEmpty()
    out = substring_dedup.substring_dedup(cases.documents(spark, [(1, "a b c"), (None, None)])).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed) for r in out) == {(1, 3, 0): 1, (None, 0, 0): 1}


PAGES = [
    (3, "http://a.example/ x\n", "é" * 60),
    (2, None, "é" * 60),
    (9, "u", "é" * 60),
    (9, "u", "é" * 60),
    (4, "u", None),
    (5, "u", ""),
    (6, "u", "small"),
    (7, "u", "small"),
    (8, "u", "WARC/1.1\r\n\r\n" * 30),
    (10, "u", "x" * 3_000_000),
]


def pages_table(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("no", F.lit(1)).repartition(2)


def test_archives_hold_every_page(spark):
    pages = pages_table(spark)
    rows = [tuple(r) for r in warc.archived(pages).collect()]
    connection = duckdb.connect()
    connection.register("pages", pages.toPandas())
    assert Counter(rows) == Counter(connection.sql(warc.SQL).fetchall())
    repeated = warc.archived(pages_table(spark, [(1, "u", "y" * 200)] * 3 + [(None, None, "y" * 200)])).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in repeated) == {(1, "response", None): 1, (1, "revisit", 1): 2, (None, "revisit", 1): 1}
    assert warc.archived(pages.limit(0)).isEmpty()


def test_members_and_sidecars(spark, tmp_path):
    raw, normal = str(tmp_path / "raw"), str(tmp_path / "normal")
    warc.write_archives(pages_table(spark), raw)
    index = warc.normalise(spark, f"file://{raw}", f"file://{normal}").collect()
    for stream in Path(raw).glob("*.gz"):
        whole = gzip.decompress(stream.read_bytes())
        rewritten = Path(normal, stream.name).read_bytes()
        assert gzip.decompress(rewritten) == whole
        lines = [json.loads(line) for line in Path(normal, stream.name + ".idx").read_text().splitlines()]
        members = [gzip.decompress(rewritten[x["at"] : x["at"] + x["size"]]) for x in lines]
        assert b"".join(members) == whole
        assert all(m.startswith(b"WARC/1.1\r\n") and x["record_id"].encode() in m for m, x in zip(members, lines))
        assert len(lines) == sum(r.file.endswith("/" + stream.name) for r in index)


def page(title, body, k):
    return (
        f'<html><head><title>{title}</title><style>p{{}}</style></head><body><header><a href="/">Site</a></header>'
        f'<nav><ul><li>Home</li><li>N{k}</li></ul></nav><div class="cookie-notice">We use cookies {k}</div>'
        f'<div class="wrap"><div class="text-box"><h1>{title}</h1>{body}<p>Follow us on our channels</p></div>'
        f'<div class="sidebar"><p>Also read {k}</p></div><section id="comments"><p>First! {k}</p></section></div>'
        f"<form><p>Search</p></form><script>if (a < b) {{ x('</p>') }}</script><footer>&copy; {k}</footer></body></html>"
    )


def test_wrappers_tell_content_from_template(spark):
    rows = [(k, f"https://Host.example/{k}", page(f"Title {k}", f"<p>Some &lt;text&gt; {k}<p>and\n <b>more</b> of it<br>{k * 7}", k)) for k in range(12)]
    rows += [(50, "https://other.example/", "<p>alone"), (51, None, None), (52, "//x/", ""), (53, "https://Host.example/53", None)]
    out = {r.page_id: r for r in html_extraction.main_text(pages_table(spark, rows)).collect()}
    for k in range(12):
        assert out[k].text == f"Title {k}\nSome <text> {k}\nand more of it {k * 7}"
        assert out[k].n_chars == len(out[k].text) and out[k].url == f"https://Host.example/{k}"
    assert [out[k].text for k in (50, 51, 52, 53)] == ["alone", "", "", ""]
    assert html_extraction.main_text(pages_table(spark, rows).limit(0)).isEmpty()


@pytest.mark.parametrize("around", ["article", "div"])
def test_copies_of_a_page_are_no_template(spark, around):
    def copied(k, quote):
        return f"<html><body><{around}><h1>Title {k}</h1><p>Own text of page {k}</p>{quote}<p>The end of {k}</p></{around}><p>Call us</p></body></html>"

    rows = [(k, f"https://a.example/{k}", copied(k, "")) for k in range(4)]
    rows += [(k, f"https://a.example/{k}", copied(9, "<blockquote>Said once</blockquote>")) for k in range(10, 14)]
    out = {r.page_id: r.text for r in html_extraction.main_text(pages_table(spark, rows)).collect()}
    assert {out[k] for k in range(10, 14)} == {"Title 9\nOwn text of page 9\nSaid once\nThe end of 9"}
    assert [out[k] for k in range(4)] == [f"Title {k}\nOwn text of page {k}\nThe end of {k}" for k in range(4)]


def test_text_beside_the_region_stays(spark):
    def split(k):
        lead = f"Lead {k} " + f"of the story number {k} " * 3
        body = f"Body {k} " + f"and what it says on {k} " * 8
        return (
            f'<div class="box"><div class="top"><h2><a href="/{k}">Title {k}</a></h2><p>{lead}</p></div><div class="text"><p>{body}</p></div>'
            f'<div class="more"><p><a href="/x">Next page {k + 1}</a></p></div></div>',
            f"Title {k}\n{lead.strip()}\n{body.strip()}",
        )

    rows = [(k, f"https://a.example/{k}", split(k)[0]) for k in range(6)]
    out = {r.page_id: r.text for r in html_extraction.main_text(pages_table(spark, rows)).collect()}
    assert out == {k: split(k)[1] for k in range(6)}


def test_wrappers_decide_without_telling_names(spark):
    def untold(k):
        own = f"<h1>Title {k}</h1><p>{f'Own text {k} of this page. ' * 50}</p><p>{k} ends it</p>"
        extra = f"<div><p>Only on some {k}</p></div>" if k % 3 else ""
        return (
            f'<body><div><span>The daily page</span></div><div><div><a href="/a">A{k}</a> <a href="/b">B</a></div></div>'
            f"<div>{own}{extra}<p>Write to the editor</p></div><div><p>{'All rights are with us. ' * 40}</p></div></body>"
        )

    def told(k):
        return f"<article><h2>Title {k}</h2><p>Tell your friends</p><p>Own text {k} of this page</p></article><p>Beside {k}</p>"

    rows = [(k, "https://a.example/", untold(k)) for k in range(12)] + [(k, "https://b.example/", told(k)) for k in range(20, 28)]
    right = {k: f"Title {k}\n{(f'Own text {k} of this page. ' * 50).strip()}\n{k} ends it" + (f"\nOnly on some {k}" if k % 3 else "") for k in range(12)}
    right |= {k: f"Title {k}\nOwn text {k} of this page" for k in range(20, 28)}
    out = {r.page_id: r.text for r in html_extraction.main_text(pages_table(spark, rows)).collect()}
    assert out == right
    assert all(html_extraction.extract(html) != right[k] for k, _, html in rows)


def test_wrappers_grow_with_places_not_with_pages():
    chosen = random.Random(5)
    kinds = ["<div><p>a{}</p></div>", "<div>b{}</div>", "<h2>c{}</h2>", "<div><ul><li>{}<li>y</ul><p>t</div>", "<section><div><p>{}</section>", '<div class="x{}"><p>w</div>']

    def varied(rows):
        return html_extraction.parse("<body>" + "".join(chosen.choice(kinds).format(chosen.randrange(10**6)) for _ in range(rows)))

    wrapper, sizes = html_extraction.Wrapper(), []
    for _ in range(3):
        for _ in range(300):
            wrapper.add_page(*varied(30))
        sizes.append(len(list(wrapper.root.walk())))
    assert sizes[2] == sizes[0] < 50
    long, start = html_extraction.Wrapper(), time.perf_counter()
    for _ in range(2):
        long.add_page(*varied(20_000))
    assert time.perf_counter() - start < 30 and len(list(long.root.walk())) < 50
    deep = "<div>" * 50_000 + "x"
    assert html_extraction.extract(deep) == "x"
    long.add_page(*html_extraction.parse(deep))
    assert html_extraction.Wrapper.load(long.dump()).dump() == long.dump()


def test_alignment_keeps_the_longest_common_run():
    def longest(a, b):
        if not a or not b:
            return 0
        return max(longest(a[1:], b), longest(a, b[1:]), 1 + longest(a[1:], b[1:]) if a[0] == b[0] else 0)

    def within(keys, places):
        rest = iter(places)
        return all(any(place.key == key for place in rest) for key in keys)

    chosen = random.Random(6)
    for _ in range(300):
        a, b = ([chosen.choice("uvwx") for _ in range(chosen.randrange(6))] for _ in range(2))
        whole = html_extraction.Place("div", inner=map(html_extraction.Place, a))
        whole.take(html_extraction.Place("div", inner=map(html_extraction.Place, b)))
        assert len(whole.inner) == len(a) + len(b) - longest(a, b)
        assert within(a, whole.inner) and within(b, whole.inner)
        assert sum(not place.optional for place in whole.inner) == longest(a, b)


def test_wrappers_are_regular_expressions():
    wrapper = html_extraction.Wrapper()
    for text in ("<div>Hello</div><p>a<p>b", "<div>Hello</div><hr><p>c", "<div>Hello</div><ul><li>x<li>y</ul><p>d"):
        wrapper.add_page(*html_extraction.parse(text))
    assert wrapper.expression() == 'div "Hello" /div (ul)? ((li # /li)+)? (/ul)? (p # /p)+'
    again = html_extraction.Wrapper.load(wrapper.dump())
    other = html_extraction.Wrapper()
    other.add_page(*html_extraction.parse("<div>Bye</div><p>e"))
    again.add(other)
    assert again.expression() == "div # /div (ul)? ((li # /li)+)? (/ul)? (p # /p)+" and again.pages == 4


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<br>b</p><p title='x > y'>c", "a b\nc"),
        ("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article><p>out</p>", "T\nx"),
        ("<main><p>m</p></main><p>out</p>", "m"),
        ("<p>a <span class='ad'>buy</span> b</p><!-- <p>no</p> --><p>c", "a\nb\nc"),
        ("<p>1 < 2 <", "1 < 2 <"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<p>x" + " <a" * 100_000, "x" + " <a" * 100_000),
    ],
)
def test_pages_alone(html, text):
    assert html_extraction.extract(html) == text


def toxic_corpus(seed, n):
    rng = random.Random(seed)
    stems = ["grolt", "snerk", "blimfor"]
    found = []
    for k in range(n):
        toxic = k % 4 == 0
        lines = [" ".join(cases.words(rng, 9)) for _ in range(rng.randint(3, 12))]
        if toxic:
            at = rng.randrange(len(lines))
            lines[at] += f" {rng.choice(stems)}{rng.choice(cases.SYLLABLES)} {rng.choice(stems)}"
        found.append((k, ". ".join(lines), int(toxic)))
    return found


def test_held_out_documents_are_told_apart(spark):
    found = toxic_corpus(4, 600)
    docs = cases.documents(spark, [(i, t) for i, t, _ in found] + [(1000, None), (1001, ""), (None, "x"), (3, found[3][1])])
    labels = spark.createDataFrame([(i, y) for i, _, y in found] + [(None, 1), (1000, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 604
    truth = {i: (t, y) for i, t, y in found}
    tested = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(tested) > 80 and sum(r.predicted == truth[r.doc_id][1] for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert {r.score for r in rows if r.doc_id in (1000, 1001)} == {0.0}
    for r in tested:
        if r.predicted and truth[r.doc_id][1]:
            assert re.search("grolt|snerk|blimfor", " ".join(truth[r.doc_id][0][s.start : s.end] for s in r.sentences))


def test_without_labels_or_documents(spark):
    docs = cases.documents(spark, [(1, "a b"), (2, None)])
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.toxicity(docs, labels.limit(0)).collect()] == [0, 0]
    assert toxicity.toxicity(cases.empty(spark), labels).isEmpty()


def test_labels_of_the_held_out_are_not_learned(spark):
    found = toxic_corpus(6, 300)
    docs = cases.documents(spark, [(i, t) for i, t, _ in found])
    labels = spark.createDataFrame([(i, y) for i, _, y in found], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, labels) == toxicity.train(docs, turned)


def test_long_documents_are_not_toxic_by_length(spark):
    rng = random.Random(7)
    found = toxic_corpus(7, 600)
    clean = ". ".join(" ".join(cases.words(rng, 9)) for _ in range(30_000))
    assert len(clean) > 1_000_000
    docs = cases.documents(spark, [*[(i, t) for i, t, _ in found], (1000, clean), (1001, f"{clean}. grolta snerk ka. {clean}")])
    labels = spark.createDataFrame([(i, y) for i, _, y in found], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity(docs, labels).where("doc_id >= 1000").collect()}
    assert out[1000].score < 0.5 and not out[1000].sentences
    assert out[1001].score >= 0.5 and len(out[1001].sentences) == 1


def test_long_documents_are_trained_on(spark):
    rng = random.Random(9)
    found = [(i, t + ". " + ". ".join(" ".join(cases.words(rng, 9)) for _ in range(700)), y) for i, t, y in toxic_corpus(9, 200)]
    assert min(len(t) for _, t, _ in found) > 20_000
    labels = spark.createDataFrame([(i, y) for i, _, y in found], "doc_id long, toxic int")
    assert len(toxicity.train(cases.documents(spark, [(i, t) for i, t, _ in found]), labels)) > 1


def test_a_score_is_the_noisy_or_of_its_sentences():
    rng = random.Random(3)
    for _ in range(50):
        sums, bias = [rng.choice([0.0, rng.uniform(-4, 9)]) for _ in range(rng.randint(0, 12))], rng.uniform(-6, 0)
        total, alone = toxicity.noisy_or(np.array(sums), bias)
        weighed, clean = [x for x in sums if x], 1.0
        for x in weighed:
            clean *= 1 - 1 / (1 + math.exp(-(x + bias - math.log(len(weighed)))))
        assert total == pytest.approx(1 - clean)
        assert alone.tolist() == pytest.approx([1 / (1 + math.exp(-(x + bias))) if x else 0.0 for x in sums])


def test_training_lowers_the_loss_of_the_score_it_is_judged_by():
    """Loss of whole documents by the noisy-or, document by document, against worse models."""
    found = toxic_corpus(4, 300)
    texts, toxic = [t for _, t, _ in found], np.array([y == 1 for _, _, y in found])
    weights, bias = toxicity.fit(texts, toxic, np.ones(len(texts)))

    def loss(weights, bias):
        total = 0.0
        for text, y in zip(texts, toxic):
            sums = [sum(weights.get(f, 0.0) for word in words for f in toxicity.features(word)) for _, _, words in toxicity.sentences(text)]
            p = min(max(toxicity.noisy_or(np.array(sums), bias)[0], 1e-9), 1 - 1e-9)
            total -= math.log(p if y else 1 - p)
        return total / len(texts)

    trained = loss(weights, bias)
    assert trained < 0.1
    assert trained < loss({}, bias) and trained < loss({f: -w for f, w in weights.items()}, bias) and trained < loss(weights, bias - 9)


def test_long_excerpts_of_longer_items(spark):
    rng = random.Random(21)
    item = [f"i{k}" for k in range(400)]
    around = lambda part: " ".join([*cases.words(rng, 60), *part, *cases.words(rng, 60)])
    found = [(1, around(item[100:170])), (2, around(item[200:240])), (3, around(item)), (4, around([]))]
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    rows = decontamination.contaminated(cases.documents(spark, found), items).collect()
    assert {(r.doc_id, r.item_id, r.score) for r in rows} == {(1, 7, 0.175), (3, 7, 1.0)}


def test_template_counts_come_from_all_pages_of_a_host(spark):
    # The shares of two texts in 120 different pages are just over and just under a half.
    rows = []
    for k in range(120):
        notes = ["Most pages say this."] if k < 61 else []
        notes += ["Fewer pages say this."] if k < 59 else []
        body = "".join(f"<p>{note}</p>" for note in notes)
        rows.append((k, "http://h/x", f"<article><h1>Title {k}</h1><div>{f'Words of page {k}. ' * 20}</div>{body}</article>"))
    out = {r.page_id: r.text for r in html_extraction.main_text(pages_table(spark, rows)).collect()}
    assert not any("Most pages" in text for text in out.values())
    assert [k for k in sorted(out) if "Fewer pages" in out[k]] == list(range(59))
