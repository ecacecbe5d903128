"""Token files, packing, counts, pieces, personal data, quality and vectors against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from vintagemill.llm import (
    addressable_codes,
    cap_filters,
    disclosure,
    merge_dropout,
    packing,
    pu_quality,
    trie_counts,
)
from vintagemill.llm.memory import AgingMemory
from vintagemill.llm.tokens import WordMemory, tokenizer_path
from vintagemill.session import fresh_path

DOCS = "doc_id long, text string"
ODD = ["", " ", "  ", "a  b", "a   b", " a", "a ", "a  ", "x\n y", "x\n \ny", "\n\n a", "a\t b", "don't  can't 12 345", "a\xa0b c　d",
       "\x1c a \x1f b", "<|endoftext|> a", "é ́a Aİ ΣΑΣ", "a\nb c, d. e.\nf", "a\n\nb", " , .", "x,. y.,", "1, 2.",
       "Stra\xdfe \xc9T\xc9.", "\U0001f600 漢字", "w" * 5000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_memory_gives_the_library_ids(name, monkeypatch):
    memory = WordMemory(tokenizer_path(name))
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(["ab", "\xe9", " ", " ", "\n", ",", ".", "7", "'s", "B"]) for _ in range(40)) for _ in range(300)]
    expected = [np.array(e.ids, "<u4").tobytes() for e in memory.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert memory.encode(texts) == expected and memory.encode(texts) == expected
    led = [np.array(e.ids, "<u4").tobytes() for e in memory.tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert memory.encode(texts, after_space=True) == led
    monkeypatch.setattr("vintagemill.llm.tokens.MEMORY_BYTES", 4000)
    memory = WordMemory(tokenizer_path(name))
    assert [memory.encode([t])[0] for t in texts] == expected
    assert memory.first.held <= 4000 and memory.later.held <= 4000 and max(map(len, memory.later.known)) <= 64


def test_words_come_back_from_the_older_half():
    memory = AgingMemory(4000)
    for i in range(200):
        memory.keep({f"w{i}": b"%d" % i, "often": b"x"} if not i else {f"w{i}": b"%d" % i, **memory.recall({"often"})})
        assert memory.recall({"often", f"w{i}", "never"}) == {"often": b"x", f"w{i}": b"%d" % i}
        assert memory.held <= 2000 and len(memory.known) + len(memory.older) < 20
    assert memory.recall({"w1"}) == {}


def test_codes_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for ids in ([], [0], [255, 256, 70_000, 2**32 - 1, 5], rng.integers(0, 50_000, 5000), rng.integers(0, 200, 1500), [0] * 512):
        ids = np.array(ids, np.uint32)
        codes = addressable_codes.Codes(addressable_codes.encode(ids))
        assert len(codes) == len(ids) and (codes.ids(0, len(ids)) == ids).all() and [codes[i] for i in range(len(ids))] == ids.tolist()
        for _ in range(40):
            a, b = sorted(rng.integers(0, len(ids) + 1, 2))
            assert (codes.ids(a, b) == ids[a:b]).all()
    with pytest.raises(ValueError):
        addressable_codes.Codes(b"none")


@pytest.mark.parametrize("shard_ids", [1, 50, 1 << 18])
def test_code_files(spark, frame, shard_ids):
    rows = [(i * 3 % 29, t) for i, t in enumerate(ODD)] + [(None, "z"), (None, "y"), (40, None), (40, "b"), (40, "b")]
    path = fresh_path(spark, "codes")
    addressable_codes.write_codes(frame(rows, DOCS).repartition(3), path, shard_ids=shard_ids)
    found = addressable_codes.read_documents(spark, path).collect()
    memory, at, expected = WordMemory(tokenizer_path("byte_bpe_50k.json")), 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = memory.encode([text or ""])[0] + bytes(4)
        expected.append((doc, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected


def test_code_files_of_no_documents(spark, frame):
    path = fresh_path(spark, "codes")
    addressable_codes.write_codes(frame([], DOCS), path)
    assert addressable_codes.read_documents(spark, path).count() == 0


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= n]
        room = min(fitting) if fitting else capacity
        if fitting:
            rooms.remove(room)
        rooms.append(room - n)
    return sorted(rooms)


def test_best_fit_plan_equals_item_by_item():
    rng = random.Random(2)
    for _ in range(300):
        capacity = rng.choice([1, 7, 16, 50])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(90))]
        fill = Counter()
        for length, _, per_bin, bins, first, offset in packing.best_fit_plan(Counter(lengths), capacity):
            for b in range(first, first + bins):
                assert fill[b] == offset
                fill[b] += per_bin * length
        assert sorted(capacity - v for v in fill.values()) == plain_best_fit(lengths, capacity)


def test_packing(spark, frame):
    rng = random.Random(3)
    texts = ODD + [None, "x"] + [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(70))) for _ in range(150)] + ["same text"] * 90
    rows = list(enumerate(texts)) + [(0, "again"), (None, "null id")]
    placed = packing.pack(frame(rows, DOCS).repartition(5), capacity=32, with_ids=True)
    found = placed.collect()
    memory = WordMemory(tokenizer_path("word_bpe_49k.json"))
    ids = {i: np.frombuffer(memory.encode([t or ""])[0] + bytes(4), "<u4") for i, t in enumerate(texts) if i}
    by_doc = {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, own in ids.items():
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in parts] == [(k, 32 * k, min(32, len(own) - 32 * k)) for k in range(-(-len(own) // 32))]
        assert all(r.ids_crc32 == zlib.crc32(own[r.start: r.start + r.length].tobytes()) and list(r.ids) == own[r.start: r.start + r.length].tolist() for r in parts)
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 32
    assert len(by_sequence) == len(plain_best_fit([r.length for r in found], 32)) and None in by_doc
    whole = packing.sequences(placed).collect()
    assert sum(len(r.ids) for r in whole) == sum(r.length for r in found) and max(len(r.ids) for r in whole) <= 32
    assert packing.pack(frame([], DOCS)).count() == 0


def test_packing_with_little_memory_for_words(spark, frame, monkeypatch):
    import corpus_pipeline

    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(200))) for i in range(60)]
    docs = frame(rows, DOCS).coalesce(1)
    pack = packing.pack
    assert sorted(pack(docs, memory_bytes=1 << 14).collect()) == sorted(pack(docs).collect())
    given = []
    monkeypatch.setattr(packing, "pack", lambda docs, **how: given.append(how) or pack(docs, **how))
    corpus_pipeline.pack_sequences(spark, docs, "")
    assert given[0]["memory_bytes"] <= 80 << 20  # workers live on beside the other stages


def test_trie_counts(spark, frame):
    scores = trie_counts.zipf_scores(tokenizer_path("piece_bpe_32k.model"))
    longest, byte = max(map(len, scores)), min(scores.values()) - 10

    def brute(word):
        word = "▁" + word
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            n = len(word[end - 1].encode())
            options = [(best[end - 1][0] + n * byte, best[end - 1][1] - n)]
            options += [(best[i][0] + scores[word[i:end]], best[i][1] - 1) for i in range(max(0, end - longest), end) if word[i:end] in scores]
            best.append(max(options))
        return -best[-1][1]

    rows = [*enumerate(ODD), (None, "the theatre then"), (3, None), (3, "the")]
    found = Counter((r.doc_id, r.n_words, r.n_tokens) for r in trie_counts.token_counts(frame(rows, DOCS)).collect())
    assert found == Counter((i, len((t or "").split()), sum(map(brute, (t or "").split()))) for i, t in rows)
    trie = trie_counts.PrefixTrie(scores)
    trie.learn({"then", "the", "theatre"})
    assert trie.nodes == len("▁theatre") + len("n") and trie.terminal["the"] == brute("the")
    assert trie_counts.token_counts(frame([], DOCS)).count() == 0


def test_merges_in_step_equal_the_agenda_and_vary():
    pieces = merge_dropout.MergePieces(tokenizer_path("piece_bpe_32k.model"))
    rng = random.Random(6)
    words = ["".join(rng.choice(["the", "ation", "er", "\xe9", "x", "漢", "▁", "7"]) for _ in range(rng.randint(0, 20))) for _ in range(400)]
    for dropout in (0.0, 0.1, 0.6):
        for spaced in (True, False):
            some = ["▁" + w if spaced else w for w in words]
            found = [np.frombuffer(x, "<u4").tolist() for x in pieces.segment_many(some, 5, dropout, spaced)]
            assert found == [pieces.segment(w, 5, dropout, spaced) for w in some]
    assert len({tuple(pieces.segment("▁international", key, 0.3, True)) for key in range(20)}) > 3


def test_no_dropout_gives_the_library_ids():
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    segmenter = merge_dropout.Segmenter(merge_dropout.MergePieces(path), 0.0, 0)
    texts = ["The theatre, then.", "line one\nline two", "漢字 \U0001f600 x", "Stra\xdfe"]
    assert [np.frombuffer(x, "<u4").tolist() for x in segmenter.encode(texts, ["n"] * 4)] == [model.encode(t) for t in texts]


def test_merge_dropout_round_trip(spark, frame):
    rows = [*enumerate(ODD + ["▁", "a▁b", " ▁ ", "▁x\n▁y"]), (None, "null id"), (3, None), (3, None)]
    encoded = merge_dropout.encode(frame(rows, DOCS), dropout=0.3)
    back = merge_dropout.decode(encoded).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, t or "") for i, t in rows)
    again = merge_dropout.encode(frame(rows, DOCS).repartition(7), dropout=0.3)
    assert Counter(map(tuple, encoded.collect())) == Counter(map(tuple, again.collect()))
    assert merge_dropout.encode(frame([], DOCS)).count() == 0


def test_occurrences_vary_within_a_line_and_keep_the_rate():
    pieces = merge_dropout.MergePieces(tokenizer_path("piece_bpe_32k.model"))
    segmenter = merge_dropout.Segmenter(pieces, 0.1, 17)
    n, word = 20_000, "international"
    text = " ".join([word] * n)
    cut = "".join(chr(x) for x in np.frombuffer(segmenter.encode([text], ["1"])[0], "<u4")).split(chr(pieces.ids["▁international"]))
    # as often whole as by independent keys
    assert abs((len(cut) - 1) / n - np.mean([len(pieces.segment("▁" + word, key, 0.1, True)) == 1 for key in range(5000)])) < 0.03
    assert len(set(cut)) > 20
    by_name = segmenter.encode([text[:500]] * 8, list("abcdefgh"))
    assert len(set(by_name)) == 8 and by_name == merge_dropout.Segmenter(pieces, 0.1, 17).encode([text[:500]] * 8, list("abcdefgh"))
    long = "international" * 9
    assert len({segmenter.encode([long], [str(i)]).pop() for i in range(20)}) > 15


def test_segmentations_by_numbers_equal_one_by_one():
    pieces = merge_dropout.MergePieces(tokenizer_path("piece_bpe_32k.model"))
    rng = random.Random(7)
    words = ["▁" + "".join(rng.choice(["the", "ation", "er", "é", "x", "漢"]) for _ in range(rng.randint(0, 6))) for _ in range(300)]
    paths = [tuple(sorted(rng.sample(range(12), rng.randint(0, 3)))) for _ in words]
    found = pieces.segment_all_by(words, [True] * len(words), paths)
    assert [(np.frombuffer(x, "<u4").tolist(), t) for x, t in found] == [pieces.segment_by(w, True, set(p).__contains__) for w, p in zip(words, paths)]


PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    def luhn(digits):
        return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    tests = [lambda s: True, lambda s: all(int(x) <= 255 for x in s.split(".")),
             lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)), lambda s: 9 <= len(digits(s)) <= 15]
    return [(k, *m.span()) for k, (p, test) in enumerate(zip(PATTERNS, tests)) for m in re.finditer(p, text) if test(m.group())]


def test_personal_spans_equal_the_patterns():
    rng = random.Random(5)
    for _ in range(6000):
        text = "".join(rng.choice("a1.@ -+(9x_%2\xe904") for _ in range(rng.randrange(45)))
        assert disclosure.personal_spans(text) == plain_spans(text)
    known = "call +49 (30) 1234-5678, pay 4111 1111 1111 1111 at 10.0.0.255 or 10.0.0.256, a.b@c.d.e"
    assert Counter(k for k, _, _ in disclosure.personal_spans(known)) == Counter([0, 1, 2, 3])
    assert disclosure.personal_spans("a" * 200_000 + "1" * 200_000 + "+1" + " " * 200_000) == []


def test_disclosing_terms(spark, frame):
    rng = random.Random(8)
    fill = lambda n: " ".join(rng.choice(["river", "stone", "light", "paper", "green", "house"]) for _ in range(n))
    rows = [(i, f"{fill(20)} Quixote wrote to rare{'xyzuv'[i]} boss@firm.org today {fill(20)} again quixote") for i in range(5)]
    rows += [(10 + i, f"{fill(40)}") for i in range(60)]
    rows += [(100 + i, "copied text Zanzibar me@home.net here") for i in range(30)]  # one text, many copies
    rows += [(200, None), (201, ""), (None, "x boss@firm.org"), (202, fill(30_000))]
    found = {r.doc_id: r for r in disclosure.digest(disclosure.find_personal_data(frame(rows, DOCS))).collect()}
    for i, text in rows:
        base = ",".join(f"{disclosure.KINDS[k]}:{a}:{b}" for k, a, b in plain_spans(text or ""))
        assert found[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and found[i].spans.startswith(base)
    text = rows[0][1]
    places = [m.span() for m in re.finditer("(?i)quixote", text)]
    assert {f"term:{a}:{b}" for a, b in places} <= set(found[0].spans.split(","))
    assert "term" not in found[100].spans and not found[10].spans and not found[202].spans
    assert not any(f"term:{text.index(w)}:" in found[0].spans for w in ("rarex",))  # in one text only: no evidence
    clean = {r.doc_id: r for r in disclosure.sanitise(frame(rows, DOCS)).collect()}
    assert all(clean[i].text == t for i, t in rows if "@" not in (t or "")) and len(clean) == len(rows)
    assert "[EMAIL]" in clean[0].text and "uixote" not in clean[0].text and "boss" not in clean[0].text
    assert disclosure.digest(disclosure.find_personal_data(frame([], DOCS))).count() == 0
    own = frame([(1, "at 10.0.0.1", "kept", 7, None)], DOCS + ", _base string, _key0 long, _terms string")
    row = disclosure.sanitise(own).select("text", "_base", "_key0", "_terms").first()
    assert tuple(row) == ("at [IP]", "kept", 7, None)


def test_terms_of_any_length_anywhere_in_the_text(spark, frame):
    rng = random.Random(9)
    fill = lambda n: " ".join(rng.choice(["river", "stone", "light", "paper", "green", "house"]) for _ in range(n))
    rows = [(i, f"Li {fill(40)} 7741 {fill(30)} li@firm{i % 2}.org") for i in range(8)]  # far from the address, short, a number
    rows += [(10 + i, f"Bob Dialtone {fill(30)} +49 30 555 {1000 + i} {fill(3)}") for i in range(8)]  # each value in one text only
    rows += [(100 + i, fill(40)) for i in range(300)]
    found = {r.doc_id: r for r in disclosure.digest(disclosure.find_personal_data(frame(rows, DOCS))).collect()}
    for i, text in rows:
        places = {m.span() for m in re.finditer("Li|7741|Bob|Dialtone", text)}
        assert {tuple(map(int, s.split(":")[1:])) for s in found[i].spans.split(",") if s.startswith("term")} == places


def test_spans_are_counted_by_kind_and_large_ids_stay_exact(spark, frame):
    rows = [(2**60 + 1, "a@b.cc 10.0.0.1 c@d.ee"), (2**60 + 2, "+49 30 1234567 +49 30 1234568"), (2**60 + 3, "10.0.0.1, 4111 1111 1111 1111"),
            (None, "x@y.zz"), (-(2**60) - 3, None), (2**60 + 4, "a@b.cc d@e.ff g@h.ii")]
    found = disclosure.digest(disclosure.find_personal_data(frame(rows, DOCS).coalesce(1))).collect()
    counts = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in found}
    assert len(found) == len(rows) and counts == {
        i: tuple(Counter(k for k, _, _ in plain_spans(text or ""))[k] for k in range(4)) for i, text in rows}


def test_scan_of_a_contact_list_grows_with_the_text(spark, frame):
    lines = 3_000
    text = "\n".join(f"Phone: +49 30 {1000000 + i}" for i in range(lines))
    row = disclosure.scan(frame([(1, text)], DOCS)).first()
    assert len(row.base) == lines and sum(len(w.starts) for w in row.words) == lines and len(row.subjects) == lines + 1


def test_overlapping_spans_are_replaced_whole():
    base = [{"kind": 3, "start": 2, "end": 10}, {"kind": 2, "start": 4, "end": 14}]
    assert disclosure.replaced("ab+123456789012xy", base, [{"start": 15, "end": 17, "gone": True}]) == "ab[PHONE]2"


def quality_tables(frame, n=600):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 > 0
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(40)]
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, int(good), 0))
    return rows, frame(rows, DOCS), labels


def test_quality_on_held_out_rows(spark, frame):
    rows, docs, labels = quality_tables(frame)
    found = {r.doc_id: r for r in pu_quality.quality(docs, frame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    truth = {i: q for i, q, _ in labels}
    held = [(found[i].predicted, q) for i, q in truth.items() if found[i].held_out]
    assert sum(p == q for p, q in held) >= 0.97 * len(held) > 20


def test_quality_never_sees_held_out_labels(spark, frame):
    rows, docs, labels = quality_tables(frame, 200)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, 1) for i, q, _ in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (sorted((r.doc_id, r.score) for r in pu_quality.quality(docs, frame(x, schema)).collect()) for x in (labels, flipped))
    assert a == b


def test_quality_of_odd_tables(spark, frame):
    schema = "doc_id long, quality int, toxic int"
    rows = [(1, None), (2, ""), (None, "a"), (2, "b" * 100_000), (2, "b" * 100_000)]
    for labels in ([], [(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0)], [(2, 1, 0)]):
        found = pu_quality.quality(frame(rows, DOCS), frame(labels, schema)).collect()
        assert len(found) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert pu_quality.quality(frame([], DOCS), frame([], schema)).count() == 0


def test_quality_sample_is_bounded_when_one_id_has_most_rows(spark, frame, monkeypatch):
    rows, _, labels = quality_tables(frame, 60)
    rows += [(3000, f"many texts of one id {i} {i * i}") for i in range(600)] + [(None, f"no id {i}") for i in range(600)] + [(4, "again and again")] * 600
    labels += [(3000, 1, 0)]
    assert zlib.crc32(b"3000") % 3 != 1
    sizes = []
    monkeypatch.setattr(pu_quality, "fit_nnpu", lambda p, u, prior: sizes.append((len(p), len(u))))
    for wanted in (100, 100_000):
        pu_quality.fit(frame(rows, DOCS), frame(labels, "doc_id long, quality int, toxic int"), positives=wanted, unlabelled=wanted)
    assert 50 < sizes[0][0] < 150 and 50 < sizes[0][1] < 150
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1
    assert sizes[1][1] == len({r for r in rows if not held(r[0])})


@pytest.mark.parametrize("block", [2_000, 7])
def test_near_vectors(spark, frame, monkeypatch, block):
    monkeypatch.setattr(cap_filters.in_blocks, "__defaults__", (block, None))
    rng = np.random.default_rng(4)
    vectors = [rng.normal(size=16) for _ in range(60)]
    for i in range(8):
        vectors += [vectors[i] * (j + 1) + rng.normal(size=16) * 0.12 * j for j in range(6)]
    vectors = [v.astype(np.float32).tolist() for v in vectors] + [[0.0] * 16, None, [], [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] * 16, [1.0, 0.0], [2.0, 0.0]]
    rows = list(enumerate(vectors + vectors[:3]))
    found = {r.vec_id: r for r in cap_filters.near_vectors(frame(rows, "vec_id long, embedding array<float>")).collect()}
    fine = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    links = {(a, b) for a in fine for b in fine if a != b and len(fine[a]) == len(fine[b])
             and fine[a] @ fine[b] / np.linalg.norm(fine[a]) / np.linalg.norm(fine[b]) >= 0.9}
    n = Counter(a for a, _ in links)
    assert sum(r.n_links for r in found.values()) >= 0.97 * len(links) and all(r.n_links <= n[i] for i, r in found.items())
    top = {i: i for i, _ in rows}
    for _ in rows:
        for a, b in links:
            top[a] = min(top[a], top[b])
    assert {i: r.component_id for i, r in found.items()} == top
    assert all(r.kept == (r.component_id == i) for i, r in found.items()) and len(found) == len(rows)
    assert cap_filters.near_vectors(frame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("dim", [64, 16, 4])
def test_links_through_filters_against_all_pairs(spark, frame, monkeypatch, dim):
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(300, dim))
    near = base[rng.integers(0, 60, 400)] + rng.normal(size=(400, dim)) * rng.uniform(0.05, 0.6, (400, 1))
    vectors = np.vstack([base, near, base[:40]]).astype(np.float32)
    used, settings = [], cap_filters.settings
    monkeypatch.setattr(cap_filters, "settings", lambda *a: used.append(settings(*a)) or used[-1])
    found = {r.vec_id: r for r in cap_filters.near_vectors(frame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")).collect()}
    assert used and all(size > 1 for size, _ in used)
    units = cap_filters.unit(vectors.astype(np.float64))
    linked = units @ units.T >= 0.9
    np.fill_diagonal(linked, False)
    n = np.array([found[i].n_links for i in range(len(vectors))])
    assert (n <= linked.sum(1)).all() and n.sum() >= 0.98 * linked.sum()
    top = np.arange(len(vectors))
    for _ in range(len(vectors)):
        new = np.minimum(top, np.where(linked, top, len(top)).min(1))
        if (new == top).all():
            break
        top = new
    assert np.mean([found[i].component_id == t for i, t in enumerate(top)]) >= 0.98
    assert all(found[i].component_id >= t for i, t in enumerate(top))


def test_filters_do_not_depend_on_the_batch():
    x = cap_filters.unit(np.random.default_rng(6).normal(size=(700, 50)))
    whole = cap_filters.filters_of(x, 11, 20)
    assert all((cap_filters.filters_of(x[lo: lo + n], 11, 20) == whole[lo: lo + n]).all() for lo, n in [(0, 1), (1, 2), (3, 97), (100, 600)])


def test_filters_of_vectors_at_the_threshold():
    rng = np.random.default_rng(5)
    x = cap_filters.unit(rng.normal(size=(1500, 64)))
    noise = rng.normal(size=x.shape)
    noise = cap_filters.unit(noise - (noise * x).sum(1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * noise
    size = cap_filters.code_size(20_000)
    a, b = (cap_filters.filters_of(v, size, cap_filters.CAPS) for v in (x, y))
    assert np.mean([bool(set(p) & set(q)) for p, q in zip(a.tolist(), b.tolist())]) > 0.95
    rotation, words = cap_filters._code(64, size, cap_filters.SEED)
    s = np.einsum("pd,pcd->pc", (x[0] @ rotation).reshape(4, -1), words)
    every = (s[0][:, None, None, None] + s[1][:, None, None] + s[2][:, None] + s[3]).ravel()
    assert set(a[0].tolist()) == set(np.argsort(-every)[: cap_filters.CAPS].tolist())


@pytest.mark.parametrize("dim,vectors", [(64, 65_000), (64, 1_000_000), (64, 10_500_000), (64, 200_000_000), (16, 1_000_000), (8, 65_000), (8, 1_000_000), (2, 10_000), (64, 500), (16, 40), (4, 2_000)])
def test_recall_at_the_threshold_does_not_fall(dim, vectors):
    size, caps = cap_filters.settings(dim, vectors)
    x, y = cap_filters.pairs_at(0.9, dim, 600, seed=99)
    a, b = (cap_filters.filters_of(v, size, caps).tolist() for v in (x, y))
    assert np.mean([bool(set(p) & set(q)) for p, q in zip(a, b)]) >= 0.97


@pytest.mark.parametrize("size,dim", [(32, 64), (57, 64), (128, 64), (8, 16)])
def test_recall_of_given_code_sizes(size, dim):
    caps = cap_filters.caps_for(size, dim, 0.9)
    x, y = cap_filters.pairs_at(0.9, dim, 600, seed=98)
    a, b = (np.vstack([cap_filters.filters_of(v[lo: lo + 100], size, caps) for lo in range(0, 600, 100)]).tolist() for v in (x, y))
    assert np.mean([bool(set(p) & set(q)) for p, q in zip(a, b)]) >= 0.97


def test_sets_that_share_a_value():
    rng = np.random.default_rng(3)
    sets = [rng.choice(9000, rng.integers(0, 90), replace=False) for _ in range(60)]
    assert cap_filters._share(sets).tolist() == [[i == j and len(p) > 0 and bool(set(p) & set().union(*sets[:i], *sets[i + 1:])) or i != j and bool(set(p) & set(q))
                                                  for j, q in enumerate(sets)] for i, p in enumerate(sets)]


def test_queries_are_registered():
    from vintagemill.llm.queries import ORACLES, QUERIES

    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
