"""URL filter, fingerprints and near-duplicate groups against brute force."""

import hashlib
import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from vintagemill.llm import bottomk, order_minhash, url_filter
from vintagemill.llm.components import connected

DOCS = "doc_id long, text string"


def components_of(pairs, nodes):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_random_graphs(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)]
    pairs += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(80)] + [(7, 7), (None, 3), (4, None)]
    whole = [p for p in pairs if None not in p]
    expected = components_of(whole, {n for p in whole for n in p})
    found = {r.node: r.component for r in connected(spark.createDataFrame(pairs * 2, "u long, v long")).collect()}
    linked = {n for a, b in whole if a != b for n in (a, b)}
    assert found == {n: c for n, c in expected.items() if n in linked}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


PAGES = [
    (1, "http://a.example.org/x", '<LINK href="http://b.example.net/fr/1#z" REL=canonical>'),
    (2, "https://B.example.net/fr/1?q#f", None),
    (3, "http://c.org", "<meta http-equiv='refresh' content='0; url=/q?a=1&amp;b'>"),
    (4, "http://c.org/q?a=1&b#k", ""),
    (5, None, None),
    (6, "nope", "<link rel=canonical href=/x>"),
    (7, "http://d.org/1", "<link rel='canonical' href='http://www.example.com/en/a'>"),
    (8, "http://d.org/2", "<link rel='canonical' href='http://d.org/1'><meta http-equiv=refresh content='1;URL=http://x.example.com/en/b'>"),
    (9, "http://x.COM/a", "<link rel=canonical href='http://e.net/fr/2'>"),
    (9, "http://x.COM/a", "<link rel=canonical href='http://e.net/fr/2'>"),
]
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/fr/")]


def test_url_filter(spark, frame):
    found = url_filter.judge_urls(frame(PAGES, "page_id int, url string, html string"), url_filter.rule_table(spark, RULES)).collect()
    got = {(r.page_id, r.host, r.path, r["rule"], r.verdict) for r in found}
    assert got == {
        (1, "a.example.org", "/x", None, "block"),  # its canonical URL is blocked
        (2, "b.example.net", "/fr/1", "net/fr/", "block"),
        (3, "c.org", "", None, "allow"), (4, "c.org", "/q", None, "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"),
        (7, "d.org", "/1", None, "allow"), (8, "d.org", "/2", None, "allow"),  # one member is allowed by a rule: no block spreads
        (9, "x.com", "/a", "com/", "allow"),  # an explicit allow stands, and spreads no block to itself
    }
    by = {r.page_id: r for r in found}
    assert by[1].by_alias and not by[2].by_alias and len(found) == len(PAGES)
    assert by[3].alias_of == by[4].alias_of == "c.org/" and by[7].alias_of == by[8].alias_of


LINK_FORMS = [
    (1, "http://a.org/1", '<link rel="nofollow  Canonical" href="http://z.net/fr/">', "block"),  # rel is a list
    (2, "http://p.net/de/y/z?k", '<link rel=canonical href="../../fr/x">', "block"),  # dot segments
    (3, "http://a.org/3", '<link data-href="http://z.net/fr/" rel=canonical href="http://ok.org/3">', "allow"),
    (4, "http://a.org/4", '<link data-href="http://ok.org/4" rel=canonical href="http://z.net/fr/4">', "block"),
    (5, "http://a.org/5", '<!-- <link rel=canonical href="http://z.net/fr/"> --><p>', "allow"),
    (6, "http://a.org/6", '<!-- x --><link title="a rel=canonical" rel=next href="http://z.net/fr/"><!-- <link', "allow"),
    (7, "http://q.org", '<link rel=canonical href="http://z.net/fr/7">', "block"),
    (8, "http://q.org/", None, "block"),  # an empty path is / in links
    (9, "http://a.org/9", "<meta content=\" 0 ; URL='http://z.net/./fr/9' \" http-equiv=' Refresh '>", "block"),
    (10, "http://a.org/10", '<link rel=canonical href="mailto:x@z.net/fr/"><link rel="canonical" href="http://z.net/fr/10">', "allow"),  # the first canonical link counts, and is no URL
    (11, "http://a.org/11", '<link rel=canonical href><link rel=canonical href="" ><link href= "\n http://z.net/fr/11 " rel=canonical/>', "allow"),
    (12, "http://a.org/../a.org/./12", '<link rel=canonical href="..">', "allow"),
    (13, "http://a.org/13", '<link rel="canonical" href="http://z.net/fr/13', "allow"),  # no tag without its end
    (14, "http://a.org/14", "<link href= '\n http://z.net/fr/14 ' rel=canonical>", "block"),
    (15, "http://a.org/15", "<link " + "a" * 300_000 + " " * 300_000 + "rel=canonical " + "x='" * 50_000 + "canonical>", "allow"),
    (16, "http://a.org/16", "<link rel=canonical " + "<!--" * 100_000 + "<link rel=canonical href=http://z.net/fr/", "allow"),
]


def test_url_filter_forms_of_links(spark, frame):
    rows = [r[:3] for r in LINK_FORMS]
    found = url_filter.judge_urls(frame(rows, "page_id int, url string, html string"), url_filter.rule_table(spark, RULES)).collect()
    assert {r.page_id: r.verdict for r in found} == {i: verdict for i, _, _, verdict in LINK_FORMS}
    assert {r.page_id: r.path for r in found}[12] == "/../a.org/./12"


def test_dot_segments(spark):
    cases = {"": "/", "/": "/", "/a/./b/": "/a/b/", "/a/../b": "/b", "/a/..": "/", "/a/b/..": "/a/", "/../../x": "/x", "/a//../b": "/a/b", "/a/.": "/a/", "/a..b/.c": "/a..b/.c"}
    rows = spark.createDataFrame([(p,) for p in cases], "path string")
    assert {r.path: r.to for r in rows.select("path", url_filter._resolved(F.col("path")).alias("to")).collect()} == cases


def test_url_filter_without_links_and_empty(spark, frame):
    rules = url_filter.rule_table(spark, RULES)
    page = [(1, "http://net/fr/", "<p>"), (2, "http://a.b.net/fr/x", None), (3, "http://xnet/fr/", None), (4, "://", None)]
    schema = "page_id int, url string, html string"
    found = {r.page_id: (r.verdict, r["rule"]) for r in url_filter.judge_urls(frame(page, schema), rules).collect()}
    assert found == {1: ("block", "net/fr/"), 2: ("block", "net/fr/"), 3: ("allow", None), 4: ("allow", None)}
    assert url_filter.judge_urls(frame([], schema), rules).count() == 0


def some_texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    texts = ["", None, " \n\t ", "one", "one two", "One  two"]
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randrange(3, 80))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(5)):
            other = list(base)
            for _ in range(rng.randrange(1, 4)):
                other[rng.randrange(len(other))] = rng.choice(words)
            texts.append(" ".join(other))
    texts += [texts[10], texts[10].upper(), " ".join(["again"] * 400), " ".join(["again"] * 900), "long " * 30_000]
    return list(enumerate(texts, 100))


def plain_signature(text, k, tuple_size, size, spark):
    words = (text or "").split()
    if not words:
        return []
    grams = [words[i: i + k] for i in range(max(1, len(words) - k + 1))]
    hashes = spark.createDataFrame([(g,) for g in grams], "g array<string>").select(F.xxhash64(*[F.get("g", F.lit(j)) for j in range(k)]))
    base = [r[0] >> 24 & (1 << 40) - 1 for r in hashes.collect()]
    seen, pairs = {}, []
    for i, h in enumerate(base):
        occ = seen[h] = seen.get(h, -1) + 1
        pairs.append((h, occ, i))
    later = spark.createDataFrame([(h, o) for h, o, _ in pairs], "h long, o int").select(F.xxhash64("h", "o")).collect()
    keyed = sorted(((h if o == 0 else x[0] >> 24 & (1 << 40) - 1) ^ 1 << 39, i) for (h, o, i), x in zip(pairs, later))
    out = []
    for c in range(size):
        start = c * ((1 << 40) // size)
        at = sum(h <= start for h, _ in keyed)
        picked = sorted(keyed[(at + j) % len(keyed)][1] for j in range(tuple_size))
        out.append([base[i] for i in picked])
    rows = spark.createDataFrame([(x,) for x in out], "a array<long>").select(F.shiftright(F.xxhash64("a"), 32).cast("int"))
    return [r[0] for r in rows.collect()]


@pytest.mark.parametrize("k,tuple_size", [(2, 2), (3, 3), (1, 1)])
def test_signature_against_plain_form(spark, k, tuple_size):
    texts = ["a b c d e f a b c a b", "x", "x y", "the cat the cat the cat sat", " ".join(str(i % 7) for i in range(200)), "été 漢 \U0001f600 b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r.text: list(r.sig) for r in order_minhash.with_fingerprint(df, "text", "sig", k, tuple_size, 16).collect()}
    assert found == {t: plain_signature(t, k, tuple_size, 16, spark) for t in texts}


def test_edited_by_next(spark, frame):
    rows = some_texts()
    found = {r.doc_id: r for r in order_minhash.edited_by_next(frame(rows, DOCS).repartition(5)).collect()}
    ordered = [(i, t or "") for i, t in sorted(rows, reverse=True)]
    for n, (i, text) in enumerate(ordered):
        following = ordered[(n + 1) % len(ordered)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        assert found[i].n_chars == len(text) and found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[i].near_edited <= 1 and 0 <= found[i].near_next <= 1
        if edited == text:
            assert found[i].near_edited == 1
    assert found[110].fingerprint == next(r.fingerprint for i, r in found.items() if dict(rows)[i] == dict(rows)[110])
    assert len(found) == len(rows)


def test_order_changes_the_fingerprint(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [(0, " ".join(words)), (1, " ".join(words[100:] + words[:100])), (2, " ".join(reversed(words)))]
    df = order_minhash.with_fingerprint(spark.createDataFrame(texts, DOCS), "text", "sig")
    sig = {r.doc_id: list(r.sig) for r in df.collect()}
    alike = [sum(a == b for a, b in zip(sig[0], sig[i])) / 64 for i in (1, 2)]
    assert 0.3 < alike[0] < 0.9 and alike[1] == 0


def test_single_repeated_null_and_no_documents(spark, frame):
    one = order_minhash.edited_by_next(frame([(1, "a b c")], DOCS)).first()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"a b a").hexdigest()
    rows = [(5, "x y z"), (5, "x y z"), (5, "a"), (None, "q"), (3, None)]
    assert order_minhash.edited_by_next(frame(rows, DOCS)).count() == 5
    assert order_minhash.edited_by_next(frame([], DOCS)).count() == 0


def shingle_set(text):
    words = [w for w in re.split(r"[ \t-\r]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]
    return {tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, components_of(links, sets)


@pytest.mark.parametrize("block", [2_000, 3])
def test_near_duplicates(spark, frame, monkeypatch, block):
    monkeypatch.setattr(bottomk.in_blocks, "__defaults__", (block, None))
    rng = random.Random(9)
    rows = some_texts()
    base = [rng.choice(["p", "q", "r", "s"]) + str(rng.randrange(60)) for _ in range(120)]
    for i in range(40):  # one group of varied likeness, and a passage many share
        other = list(base)
        for _ in range(rng.randrange(1, 6)):
            other[rng.randrange(len(other))] = f"new{rng.randrange(1000)}"
        rows.append((1000 + i, " ".join(other)))
        rows.append((2000 + i, " ".join([f"own{i}-{j}" for j in range(60)] + base[:30])))
    sets, component = brute_groups(rows)
    found = {r.doc_id: r for r in bottomk.near_duplicates(frame(rows, DOCS).repartition(4)).collect()}
    assert {i: r.component_id for i, r in found.items()} == component
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (i == r.component_id) for i, r in found.items())


def test_near_duplicates_of_odd_tables(spark, frame):
    assert bottomk.near_duplicates(frame([], DOCS)).count() == 0
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A B C D E F"), (7, None), (8, "")]
    found = sorted((r.doc_id or 0, r.component_id, r.kept) for r in bottomk.near_duplicates(frame(rows, DOCS)).collect())
    assert found == [(0, None, True), (4, 4, True), (4, 4, True), (7, 7, True), (8, 8, True), (9, 4, False)]


def test_rows_without_near_duplicates(spark, frame):
    a = " ".join(f"w{i}" for i in range(30))
    near, other = a + " end", " ".join(f"v{i}" for i in range(30))
    rows = [(1, a), (1, a), (2, a), (2, other), (3, near), (None, a), (4, None), (4, None), (5, ""), (6, other)]
    kept = bottomk.without_near_duplicates(frame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (2, other), (None, a), (4, None), (4, None), (5, "")], key=str)
    own = frame([(1, a, "x", 9), (2, a, "y", 8)], "doc_id long, text string, _class0 string, _id0 long")
    assert [(r.doc_id, r._class0, r._id0) for r in bottomk.without_near_duplicates(own).collect()] == [(1, "x", 9)]
    assert bottomk.without_near_duplicates(frame([], "doc_id long, text string")).count() == 0
