"""Quality rules, personal data, sharding and mixing against their definitions."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from llm import cases
from wordmill.llm import mixing, pii, quality_rules, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def native(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search(r"Python|Pandas|Arrow|Cartesian", plan)


def measures(text):
    w = WORD.findall(text or "")
    triples = Counter(zip(w, w[1:], w[2:]))
    repeated = {k + j for k, t in enumerate(zip(w, w[1:], w[2:])) if triples[t] > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated)


JUNK = [
    (200, "### word $$$ word <b> | x " * 20),
    (201, "the same line\n" * 40),
    (202, "a b c a b c x y z a b"),
    (203, "the cat and the dog of a house in the street " * 1 + " ".join(f"w{k} of the t{k}" for k in range(30))),
]


def test_measures_and_verdicts(spark):
    found = cases.rows() + JUNK
    docs = cases.documents(spark, found)
    out = quality_rules.quality(docs)
    assert native(out)
    got = Counter(tuple(r)[:8] for r in out.collect())
    bases = []
    for doc_id, text in found:
        m = measures(text)
        bases.append((doc_id, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert Counter(row[:7] for row in got.elements()) == Counter(bases)
    verdict = {r.doc_id: (r.kept, r.broken) for r in out.collect()}
    assert verdict[203] == (True, [])
    assert verdict[200][0] is False and "symbols" in verdict[200][1]
    assert "same_lines" in verdict[201][1] and verdict[100] == (False, ["too_short"])
    assert all(not (r.kept and r.base_failed) for r in out.collect())


def test_verdicts_are_those_of_the_sql(spark):
    found = cases.rows() + JUNK
    out = quality_rules.quality(cases.documents(spark, found)).withColumn("broken", F.concat_ws(",", "broken"))
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", found)
    assert Counter(map(tuple, out.collect())) == Counter(connection.sql(quality_rules.SQL).fetchall())


def test_kept_rows_are_as_they_were(spark):
    docs = cases.documents(spark, cases.rows() + JUNK)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and native(kept)
    good = {r.doc_id for r in quality_rules.quality(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == good and 203 in good
    assert kept.exceptAll(docs).isEmpty()
    assert quality_rules.keep_good(cases.empty(spark)).isEmpty() and quality_rules.quality(cases.empty(spark)).isEmpty()


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def only_digits(match):
    return re.sub("[^0-9]", "", match)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(only_digits(m)) <= 19 and luhn(only_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(only_digits(m)) <= 15),
]

PERSONAL = [
    "a@b.co_x@y.com 1.2.3.4.5.6.7.8 010.1.1.1 999.1.1.1 \U0001f600 a@b.c",
    "4111 1111 1111 1111, 4111-1111-1111-1112 +1 (743) 555-3824-- +49 30 1234567 x",
    "IBAN DE89 3704 0044 0532 0130 00, iban DE89370400440532013001 and ssn 123-45-6789, 123-45-6789",
    "+1" + "2 " * 30 + "a@b.c@d.e.f..g@h.i 00000000000000 1.2.3 1.2.3.0000255 1.2.3.256",
    "x@y " * 5 + "@a.b a@.b a@b. a@b.-",
]


def test_spans_are_those_of_the_plain_patterns(spark):
    found = cases.rows() + [(300 + k, text) for k, text in enumerate(PERSONAL)]
    out = pii.personal_data(cases.documents(spark, found))
    assert native(out)
    expected = []
    for doc_id, text in found:
        spans = {kind: [m.span() for m in re.finditer(p, text or "") if ok(m.group())] for kind, p, ok in BASE}
        listed = ",".join(f"{kind}:{a}:{b}" for kind, _, _ in BASE for a, b in spans[kind])
        expected.append((doc_id, *[len(spans[kind]) for kind, _, _ in BASE], hashlib.sha256(listed.encode()).hexdigest()))
    rows = out.collect()
    assert Counter(tuple(r)[:6] for r in rows) == Counter(expected)
    by_id = {r.doc_id: r for r in rows}
    # The checksum finds one account number; the context before both numbers lifts them.
    assert [s for s in by_id[302].spans.split(",") if s[:4] in ("iban", "ssn:")] == ["iban:5:32", "ssn:70:81", "ssn:83:94"]
    assert by_id[101].spans == "" and pii.personal_data(cases.empty(spark)).isEmpty()


def test_long_runs_take_linear_time(spark):
    long = [(1, "x" * 300_000), (2, "1" * 300_000), (3, "1." * 150_000), (4, "a.b@" * 75_000), (5, "+1" * 150_000)]
    assert pii.personal_data(cases.documents(spark, long)).count() == 5


def test_context_on_both_sides(spark):
    far, number = "x" * 40, "123-45-6789"
    texts = [
        f"{number} is my ssn",  # after it
        f"ssn {number}",
        f"ssn {far} {number} {far} ssn",  # too far away
        number,
        f"{number} and {number}, social security",  # the words after the second are only its own
    ]
    rows = pii.personal_data(cases.documents(spark, list(enumerate(texts)))).collect()
    spans = {r.doc_id: r.spans for r in rows}
    assert spans == {0: "ssn:0:11", 1: "ssn:4:15", 2: "", 3: "", 4: "ssn:16:27"}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 200_000])
def test_very_many_matches_in_one_text(spark, n):
    rng = random.Random(n)
    text = "".join(f"{'é' * rng.randrange(4)}a{k}@b.c, " for k in range(n))
    before = time.monotonic()
    row = pii.personal_data(cases.documents(spark, [(1, text)])).first()
    assert time.monotonic() - before < 60  # some 5 s where nothing else runs
    spans = [m.span() for m in re.finditer(BASE[0][1], text)]
    listed = ",".join(f"email:{a}:{b}" for a, b in spans)
    assert row.n_email == n and row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and row.spans == listed


def shards_of(spark, found, shards=8):
    return sharding.shard(cases.documents(spark, found), shards).collect()


@pytest.mark.parametrize("found", [cases.rows(), [(k, "same") for k in range(50)] + [(k, f"t{k // 2}") for k in range(100)]], ids=["prose", "all linked"])
def test_shards_are_even_and_keep_groups(spark, found):
    rows = shards_of(spark, found)
    whole = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in found]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(whole)
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(8)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    groups = defaultdict(Counter)
    for r in rows:
        groups[r.text_crc32, r.size][r.shard] += 1
    room = len(rows) // 8
    # Where no document is free to make room, some small groups find none.
    small = [g for g in groups.values() if 1 < sum(g.values()) <= room]
    assert sum(len(g) > 1 for g in small) <= len(small) // 2
    # A group larger than a shard gathers in one as far as that has room.
    assert all(max(g.values()) >= 0.6 * room for g in groups.values() if sum(g.values()) > room)


def test_a_large_group_settles(spark):
    # Twelve rounds leave the group in eight or nine shards of ten.
    found = [(k, "hot") for k in range(300)] + [(k, f"pair{k // 2}") for k in range(120)] + [(k, f"single{k}") for k in range(180)]
    out = sharding.shard(spark.createDataFrame(found, "doc_id long, text string"), shards=10).collect()
    assert Counter(Counter(r.shard for r in out).values()) == {60: 10}
    assert len({r.shard for r in out if r.text_crc32 == zlib.crc32(b"hot")}) <= 7


def test_few_rows_and_none(spark):
    assert sharding.shard(cases.empty(spark)).isEmpty()

    assert Counter(r.shard for r in shards_of(spark, [(1, "a"), (1, "a"), (None, None)])) == {0: 1, 1: 1, 2: 1}


def test_quotas_never_overfill():
    quotas = sharding._quotas({(0, 1): 10, (1, 0): 4, (2, 1): 5}, [0, 3, 0])
    assert quotas == {(0, 1): 7, (1, 0): 4, (2, 1): 0}


SOURCES = [(k, "x " * (10 + k % 7), "abcd"[min(3, k % 11)] if k % 13 else None) for k in range(400)] + [(5, "x y z", "e"), (6, None, "f"), (6, "", "f")]


def mixed_docs(spark, rows=SOURCES):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("tokens", F.lit(1)).repartition(3)


def test_mixture_is_that_of_the_sql(spark):
    docs = mixed_docs(spark)
    out = mixing.mixture(docs)
    assert native(out)
    connection = duckdb.connect()
    connection.register("documents", docs.toPandas())
    # The two documents with number 6 have no token; the last source has none at all.
    assert Counter(map(tuple, out.collect())) == Counter(connection.sql(mixing.SQL).fetchall())


def test_limits_hold_and_every_document_is_shown(spark):
    docs = mixed_docs(spark)
    rows = mixing.mixture(docs, max_repeats=3.0).collect()
    assert {(r.doc_id, r.source) for r in rows} == {(i, s) for i, _, s in SOURCES}
    tokens, shown = Counter(), Counter()
    for _, text, source in SOURCES:
        tokens[source] += len((text or "").split())
    for r in rows:
        shown[r.source] += r.n_tokens
    repeats = [shown[s] / tokens[s] for s in tokens if tokens[s]]
    assert 1 <= min(repeats) and 2 < max(repeats) <= 3.01
    sources = mixing.source_tokens(mixing._tokens(docs))
    assert mixing.find_exponent(sources, 1e9) == 0.0
    assert 0.5 < mixing.find_exponent(sources, None, 1.2) <= 1.0


def test_mixed_rows_are_as_they_were(spark):
    docs = mixed_docs(spark)
    out = mixing.mix(docs)
    assert out.columns == docs.columns and native(out)
    counted = Counter((r.doc_id, r.source) for r in mixing.mixture(docs).collect())
    assert Counter((r.doc_id, r.source) for r in out.collect()) == counted
    assert mixing.mix(docs.limit(0)).isEmpty() and mixing.mixture(docs.limit(0)).isEmpty()
