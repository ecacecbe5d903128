"""Alignment, whitening and segment-tree encoding against brute force and the libraries."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vintagemill.llm import alignment, queries, tree_bpe, whitening
from vintagemill.llm.memory import ByteMemory
from vintagemill.llm.tokens import tokenizer_path

DOCS = "doc_id long, text string"
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
ODD = ["", " ", "  ", "a  b", "a   b", " a", "a ", "x\n y", "x\n \ny", "\n\n a", "a\t b", "don't  can't 12 345", "a\xa0b c　d", "\x1c a \x1f b",
       "<|endoftext|> a", "a<|endoftext|><|endoftext|>b", "<s> a </s> <unk>", "é ́a Aİ ΣΑΣ", "a\nb c, d. e.\nf", "a \r\n b", "▁ a▁b", "<0x41>",
       "\U0001f600 漢字", "w" * 5000, "漢字" * 900, "ab" * 900 + "漢", "՘a1", "\x00 a", "of the same of the same, the end"]


def library(special_as_text=False):
    found = Tokenizer.from_file(tokenizer_path(A))
    found.encode_special_tokens = special_as_text
    return found


def texts(seed, n):
    rng = random.Random(seed)
    parts = ["ab", "\xe9", " ", " ", "\n", ",", ".", "7", "'s", "B", "\t", "漢", " the", "́", "<|endoftext|>", "tion"]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_tree_encoder_gives_the_library_ids(monkeypatch):
    encoder, some = tree_bpe.TreeEncoder(tokenizer_path(A)), texts(1, 1500)
    expected = [np.array(e.ids, "<u4").tobytes() for e in library().encode_batch(some, add_special_tokens=False)]
    assert encoder.encode(some) == expected and encoder.encode(some) == expected
    encoder.memory = ByteMemory(2000)
    assert [encoder.encode([t])[0] for t in some] == expected and encoder.memory.held <= 2000
    monkeypatch.setattr(tree_bpe, "_IN_STEP", 1)  # every word by a tree of its own
    assert tree_bpe.TreeEncoder(tokenizer_path(A)).encode(some) == expected


def test_pair_tree_finds_the_leftmost_least():
    rng = random.Random(2)
    for n in (1, 2, 3, 8, 13):
        ranks = [rng.randrange(5) for _ in range(n)]
        tree = tree_bpe.PairTree(ranks)
        for _ in range(200):
            assert tree.first_least() == (min(ranks), ranks.index(min(ranks)))
            at = rng.randrange(n)
            ranks[at] = rng.randrange(5)
            tree.set(at, ranks[at])


def test_pre_tokens_of_every_sign():
    """One text a sign, so that the classes of signs are the library's."""
    encoder = tree_bpe.TreeEncoder(tokenizer_path(A))
    for c in [*range(0x3000), 0xFEFF, 0x1F600, 0x20000, 0x10940]:
        text = "a{0}1{0}!{0}{0} {0}a".format(chr(c))
        assert encoder.pre_tokens(text) == [text[a:b] for _, (a, b) in encoder.split_by_library(text)]


def test_tree_query_rows(spark, frame):
    rows = list(enumerate(texts(3, 60))) + [(5, "again"), (5, "again"), (None, "null id"), (900, None)]
    df = frame(rows, DOCS)
    found = tree_bpe.decode(tree_bpe.encode(df)).collect()
    own, expected = library(), []
    for doc, text in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids
        expected.append((doc, own.decode(ids, skip_special_tokens=False), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))
    assert Counter(map(tuple, found)) == Counter(expected)
    assert tree_bpe.decode(tree_bpe.encode(df.limit(0))).count() == 0
    lone = spark.createDataFrame([(1, bytearray(np.array([224], "<u4").tobytes())), (2, None)], "doc_id long, ids binary")
    assert [(r.doc_id, r.n_tokens) for r in tree_bpe.decode(lone).orderBy("doc_id").collect()] == [(1, 1), (2, 0)]


def plain_alignment(rows):
    own, pieces = library(True), sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))
    a_bytes, b_bytes = tree_bpe.TreeMerges(tokenizer_path(A)).spelled, alignment.piece_bytes(tokenizer_path(B))
    out, counts = [], Counter()
    for doc, text in rows:
        a, b = own.encode(" " + (text or ""), add_special_tokens=False).ids, pieces.encode(text or "")
        raw = (" " + (text or "")).encode()
        if not text or any(b"".join(s[i] for i in ids) != raw for s, ids in ((a_bytes, a), (b_bytes, b))):
            out.append((doc, 0, 0, "", []))
            continue
        ends = [np.cumsum([len(s[i]) for i in ids]).tolist() for s, ids in ((a_bytes, a), (b_bytes, b))]
        groups, links, at = [], [], (0, 0)
        for end in sorted(set(ends[0]) & set(ends[1])):
            upto = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(",".join(map(str, a[at[0]: upto[0]])) + "|" + ",".join(map(str, b[at[1]: upto[1]])))
            links.append((a[upto[0] - 1], b[upto[1] - 1]))
            at = upto
        counts.update(links)
        out.append((doc, len(a), len(b), ";".join(groups), links))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return Counter((doc, n_a, n_b, len(links), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(groups.encode()).hexdigest() if groups else "", groups) for doc, n_a, n_b, groups, links in out)


@pytest.mark.parametrize("broadcast_bytes, hot", [(16 << 20, 100_000), (400, 3), (400, 10**6)])
def test_alignment(spark, frame, monkeypatch, broadcast_bytes, hot):
    monkeypatch.setattr("vintagemill.session.BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(alignment, "HOT_ROWS", hot)
    rows = list(enumerate(texts(4, 80))) + [(5, "again"), (5, "again"), (None, "null id"), (900, None)]
    found = alignment.align(frame(rows, DOCS).repartition(3), with_groups=True).collect()
    assert Counter(tuple(r[c] or "" if c == "groups" else r[c] for c in r.asDict()) for r in found) == plain_alignment(rows)


def test_alignment_of_no_documents(spark, frame):
    assert alignment.align(frame([], DOCS)).count() == 0
    assert [tuple(r) for r in alignment.align(frame([(1, None), (2, "▁")], DOCS)).orderBy("doc_id").collect()] == [(i, *[0] * 6, "") for i in (1, 2)]


SPECTRA = [[1, 1, 1, 2, 2], list(np.linspace(1, 100, 40)), [1] * 20 + [1 + 1e-6] * 20, [10.0**-i for i in range(12)] + [1e-3 + 1e-9 * i for i in range(20)],
           [0] * 30 + [1, 1, 2, 3], [0.0], [0, 0, 0], [7.0]]


@pytest.mark.parametrize("spectrum", SPECTRA)
def test_refined_eigenvectors(spectrum):
    n, rng = len(spectrum), np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(n, n)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(n) - q.T @ q / 2)
    a = (q * np.array(spectrum, np.longdouble)) @ q.T
    a, size = (a + a.T) / 2, max(spectrum)
    values, vectors = whitening.eigen(a)
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 2e-15
    assert np.abs(values - np.sort(spectrum)[::-1]).max() <= 4e-16 * size
    exact = vectors.astype(np.longdouble)
    assert np.abs(a @ exact - exact * values).max() <= 4e-15 * size / 2


def plain_whitening(rows):
    kept = [(i, np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000) for i, v in rows
            if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.unique([v for _, v in kept], axis=0)
    n, s = len(x), x.sum(0)
    d = x - s / n
    e, v = np.linalg.eigh(d.T @ d / n)
    e, v = e[::-1], v[:, ::-1]
    return kept, n, s, e, v


def vectors(seed, n, width):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, width)) * np.linspace(1, 3, width)).astype(np.float32).tolist()


@pytest.mark.parametrize("width", [3, 20])
def test_whitening(spark, frame, width):
    own = vectors(6, 300, width)
    rows = [*enumerate(own), (7, own[7]), (7, own[7]), *[(1000 + i, own[0]) for i in range(200)], (None, own[3]), (2000, None), (2001, []),
            (2002, [None] * width), (2003, [float("nan")] * width), (2004, [float("inf")] + [0.0] * (width - 1))]
    found = whitening.whiten(frame(rows, "vec_id long, embedding array<float>").repartition(4)).toPandas()
    kept, n, s, e, v = plain_whitening(rows)
    k = min(16, width)
    assert n == 300 and (found["n"] == n).all() and len(found) == len(kept) * k and found["identity_error"].max() < 1e-9
    signs = {}
    for i, x in dict(kept).items():
        if i is None:
            continue
        part = found[found["vec_id"] == i].drop_duplicates("component").sort_values("component")
        expected = (x - s / n) @ v[:, :k] / np.sqrt(e[:k])
        got = part["whitened"].to_numpy()
        signs.setdefault("all", np.sign(got * expected))
        assert np.allclose(got * signs["all"], expected, atol=1e-9) and np.allclose(part["explained"], e[:k] / e.sum(), rtol=1e-9)
        assert set(map(int, part["deviation"])) == {sum((n * int(c) - int(t)) ** 2 for c, t in zip(x, s))}


def test_whitening_of_equal_and_no_vectors(spark, frame):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(frame(rows, schema)).count() == 0
    flat = whitening.whiten(frame([(i, [float(i), 1.0, 2.0 * i]) for i in range(5)], schema)).toPandas()
    assert set(flat["component"]) == {1} and flat["explained"].round(12).eq(1).all()
    with pytest.raises(ValueError):
        whitening.whiten(frame([(1, [1.0]), (2, [1.0, 2.0])], schema))


def test_deviations_beyond_a_long():
    fitted = whitening.Whitening(1 << 40, np.array([1_000_000 << 40, 5], object), np.zeros((2, 0)), np.zeros(0), 0.0)
    x = np.array([[1_000_000 + (1 << 30), 3], [0, 0]])
    assert fitted.deviations(x) == [sum((int(c) * fitted.n - s) ** 2 for c, s in zip(row, fitted.sums)) for row in x.tolist()]


def test_new_queries_are_registered():
    assert {"op11_tokenizer_alignment", "op12_whitening", "op13_segment_tree_bpe"} <= set(queries.QUERIES)
