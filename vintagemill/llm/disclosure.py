"""Personal data, and the terms that give it away: patterns, then corpus co-occurrence."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagemill.llm.batches import bound_batches
from vintagemill.session import materialise

KINDS = ("email", "ip", "card", "phone", "term")

#: Share of a subject's information that a term may reveal; terms from REMOVE on go, others are generalised.
DISCLOSURE, REMOVE = 0.8, 0.999
#: Chance that any pair of unrelated subject and term in the whole corpus is taken for related.
LEVEL = 0.05

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# greedy runs of digits are never cut short by what follows them, so they need not be tried again from within
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = r"[\p{L}\p{M}\p{N}]+"
_TERM = regex.compile(_WORD)
_SPAN = "array<struct<kind: int, start: int, end: int>>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address starts where the run before its @ starts, or at the end of the address before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def personal_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of e-mail addresses, IP addresses, card and telephone numbers, in this order.

    Leftmost, non-overlapping within a kind; a match that fails its test is dropped.
    Positions count code points.  Time is linear in the text's length.
    """
    spans = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m.group().split(".")):
                spans.append((1, *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                spans.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                    spans.append((3, *m.span()))
    return spans


def _entity(kind: int, value: str) -> int:
    """One number for each protected value, however it is written."""
    plain = value.lower() if kind == 0 else value if kind == 1 else "".join(_DIGIT.findall(value))
    return int.from_bytes(hashlib.blake2b(f"{kind}:{plain}".encode(), digest_size=8).digest(), "big", signed=True)


def _subjects(text: str, spans: list[tuple[int, int, int]]) -> list[int]:
    """What the spans of a text are about: each value, each kind, and the domain of each e-mail address."""
    found = set()
    for kind, a, b in spans:
        value = text[a:b]
        found |= {_entity(kind, value), _entity(len(KINDS), str(kind))}
        if kind == 0:
            found.add(_entity(len(KINDS), "@" + "".join(value.lower().partition("@")[2])))
    return sorted(found)


def term_places(text: str, spans: list[tuple[int, int, int]]) -> dict[str, list[int]]:
    """Where each term of a text starts.

    Terms are runs of letters and digits of any length, lower-cased; those that touch a span are not looked at.
    """
    taken = sorted((a, b) for _, a, b in spans)
    reach, ends = 0, []
    for _, b in taken:
        reach = max(reach, b)
        ends.append(reach)
    places: dict[str, list[int]] = {}
    skip = 0
    for m in _TERM.finditer(text):
        while skip < len(taken) and ends[skip] <= m.start():
            skip += 1
        word = m.group().lower()
        # a word whose lower case is longer has no place of its own length
        if (skip == len(taken) or taken[skip][0] >= m.end()) and len(word) == m.end() - m.start():
            places.setdefault(word, []).append(m.start())
    return places


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base (spans), subjects, words (each term's places) of every document.

    Subjects and words are empty where there are no spans, and neither is longer than the text.
    """
    bound_batches(docs.sparkSession)
    schema = f"doc_id long, text_key binary, base {_SPAN}, subjects array<long>, words array<struct<term: string, starts: array<int>>>"
    names = ["text_key", "base", "subjects", "words"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text in zip(batch["text_key"].tolist(), batch["text"].tolist()):
                spans = personal_spans(text)
                places = term_places(text, spans) if spans else {}
                out.append((key, [{"kind": k, "start": a, "end": b} for k, a, b in spans], _subjects(text, spans),
                            [{"term": t, "starts": s} for t, s in places.items()]))
            found = pd.DataFrame(out, columns=names)
            found.insert(0, "doc_id", pd.array([i if i is None else int(i) for i in batch["doc_id"].tolist()], dtype="Int64"))
            yield found

    text = F.coalesce("text", F.lit(""))
    # as text, since pandas makes doubles of numbers beside a NULL
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), text.alias("text"), text_key(text).alias("text_key")).mapInPandas(rows, schema)


def text_key(text: Column) -> Column:
    """Equal for equal texts: 16 bytes."""
    return F.unhex(F.md5(text))


def _alike(df: DataFrame, name: str) -> DataFrame:
    """(name, class, docs, texts): values that stand in two texts or more; those of the same texts are one class."""
    sums = [F.sum(F.xxhash64("text_key", F.lit(i)).cast("decimal(38,0)")).alias(f"_s{i}") for i in (0, 1)]
    each = df.groupBy(name).agg(F.sum("copies").alias("docs"), F.count("*").alias("texts"), *sums).where("texts > 1")
    return each.withColumn("class", F.xxhash64("docs", "texts", "_s0", "_s1")).drop("_s0", "_s1")


def disclosing_terms(docs: DataFrame, scanned: DataFrame, threshold: float = DISCLOSURE, level: float = LEVEL) -> DataFrame:
    """(text_key, term, share): terms that reveal at least ``threshold`` of the information of a subject of their text.

    Over all documents, with p(s) the share that holds the subject and p(s|t) the share of
    those with the term that hold it too, anywhere: the term reveals log(p(s|t) / p(s)),
    and the subject's information is -log p(s).  Counts are of documents, copies too, so
    that copying changes neither share.  A term in a subject of every document reveals
    nothing.

    Evidence is counted in different texts: by Hoeffding's bound on the tail of the
    hypergeometric distribution, times the number of subjects and of terms, the chance of
    meeting so often must be ``level`` at most.  In one text everything stands with
    everything, so a value in one text only is judged by its kind and domain.
    """
    copies = scanned.where(F.size("subjects") > 0).groupBy("text_key").agg(F.count("*").alias("copies"))
    first = scanned.where(F.size("subjects") > 0).dropDuplicates(["text_key"])
    texts = materialise(first.join(copies, "text_key").select("text_key", "copies", "subjects", F.col("words.term").alias("terms")), "personal-texts")
    of_text = {name: texts.select("text_key", "copies", F.explode(f"{name}s").alias(name)) for name in ("subject", "term")}
    subjects = materialise(_alike(of_text["subject"], "subject"), "subjects")
    terms = _alike(of_text["term"], "term")
    words = docs.select(F.explode(F.array_distinct(F.transform(
        F.regexp_extract_all("text", F.lit(f"({_WORD})"), F.lit(1)), F.lower))).alias("term"))
    # counted before the join, so that a frequent term is one row when it meets its candidates
    often = words.groupBy("term").agg(F.count("*").alias("term_docs"))
    terms = terms.join(often, "term", "left").withColumn("term_docs", F.greatest("term_docs", "docs"))
    terms = materialise(terms.withColumn("class", F.xxhash64("class", "term_docs")).select("term", "class", "term_docs"), "terms")
    n = scanned.count()
    n_texts = scanned.select("text_key").distinct().count()
    tests = max(1, subjects.count() * terms.count())

    # only terms rare enough for the threshold, whatever they meet, are paired
    left = of_text["subject"].join(subjects.select("subject", F.col("class").alias("of"), F.col("docs").alias("held"), F.col("texts").alias("held_texts")), "subject")
    left = left.select("text_key", "copies", "of", "held", "held_texts").distinct()
    right = of_text["term"].join(terms, "term").select("text_key", "class", "term_docs").distinct()
    most = F.col("held") * F.pow(n / F.col("held"), F.lit(1 - threshold)) * (1 + 1e-9)
    met = materialise(left.join(right, "text_key").where((F.col("held") < n) & (F.col("term_docs") <= most)), "met")
    pairs = met.groupBy("of", "class").agg(
        F.sum("copies").alias("both"), F.count("*").alias("both_texts"), *[F.first(c).alias(c) for c in ("held", "held_texts", "term_docs")])
    info = -F.log(F.col("held") / n)
    share = F.log((F.col("both") / F.col("term_docs")) * n / F.col("held")) / info
    # documents with the term but not the subject are taken to differ, which overstates the term's texts
    k, m, p = F.col("both_texts"), F.col("both_texts") + F.col("term_docs") - F.col("both"), F.least(F.col("held_texts") / n_texts, F.lit(1 - 1e-12))
    a = k / m
    tail = m * (a * F.log(a / p) + F.when(a < 1, (1 - a) * F.log((1 - a) / (1 - p))).otherwise(0.0))
    kept = pairs.withColumn("share", share).where((k > 1) & (F.col("share") >= threshold) & (a > p) & (tail >= math.log(tests / level)))
    found = met.join(kept.select("of", "class", "share"), ["of", "class"]).groupBy("text_key", "class").agg(F.max("share").alias("share"))
    own = of_text["term"].join(terms, "term").select("text_key", "term", "class")
    return own.join(found, ["text_key", "class"]).select("text_key", "term", "share")


def term_spans(scanned: DataFrame, terms: DataFrame, remove: float = REMOVE) -> DataFrame:
    """(text_key, terms): where the disclosing terms of each text's own subjects stand."""
    texts = scanned.where(F.size("words") > 0).dropDuplicates(["text_key"])
    each = texts.select("text_key", F.inline("words")).join(terms, ["text_key", "term"])
    each = each.select("text_key", F.explode("starts").alias("start"), F.char_length("term").alias("n"), (F.col("share") >= remove).alias("gone"))
    span = F.struct(F.col("start"), (F.col("start") + F.col("n")).alias("end"), F.col("gone"))
    return each.groupBy("text_key").agg(F.array_sort(F.collect_list(span)).alias("terms"))


def _joined(spans: Column) -> Column:
    """``kind:start:end`` of spans in order of kind, then start."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame, threshold: float = DISCLOSURE, level: float = LEVEL) -> DataFrame:
    """doc_id, text_key, base, terms of every document; spans are of whole texts.

    One row per input row; a NULL text counts as empty; an empty table gives an empty
    table; other columns than doc_id and text are not looked at.  Spans of different
    kinds may overlap, terms overlap nothing.
    """
    scanned = materialise(scan(docs), "personal-data")
    terms = disclosing_terms(docs.select("text"), scanned, threshold, level)
    found = term_spans(scanned, terms)
    empty = F.array().cast("array<struct<start: int, end: int, gone: boolean>>")
    return scanned.join(found, "text_key", "left").select("doc_id", "text_key", "base", F.coalesce("terms", empty).alias("terms"))


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, a checksum of the base spans and all spans as text."""
    term = F.transform("terms", lambda t: F.struct(F.lit(4).alias("kind"), t["start"].alias("start"), t["end"].alias("end")))

    def count(kind: int) -> Column:
        # a second parameter of the lambda would be the index of the span
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.concat("base", term)).alias("spans"), F.size("terms").cast("long").alias("n_term"))


def replaced(text: str, base: list, terms: list) -> str:
    """The text with spans replaced by their kind in capitals; terms that reveal all are left out.

    Of overlapping spans the one that starts first stands, and of those the longest.
    """
    spans = [(s["start"], -s["end"], f"[{KINDS[s['kind']].upper()}]") for s in base]
    spans += [(t["start"], -t["end"], "" if t["gone"] else "[TERM]") for t in terms]
    out, at = [], 0
    for start, end, word in sorted(spans):
        if start >= at:
            out += [text[at:start], word]
            at = -end
        elif -end > at:  # the rest of an overlapping span is personal data too
            at = -end
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, threshold: float = DISCLOSURE, level: float = LEVEL) -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced in text; all rows and columns stay, as do clean texts.

    A NULL text stays NULL; repeated rows stay; an empty table gives an empty table; columns of any name stay as they are.
    """
    found = find_personal_data(docs, threshold, level)
    # names that no column of the table has
    key, base, terms = (next(x for x in (f"_{c}{i}" for i in range(len(docs.columns) + 1)) if x not in docs.columns) for c in ("key", "base", "terms"))
    dirty = found.where("size(base) + size(terms) > 0").select(
        F.col("text_key").alias(key), F.col("base").alias(base), F.col("terms").alias(terms)).dropDuplicates([key])
    dirty = materialise(dirty, "replacements")

    @F.pandas_udf("string")
    def clean(text: pd.Series, base: pd.Series, terms: pd.Series) -> pd.Series:
        return pd.Series([t if b is None else replaced(t, b, s) for t, b, s in zip(text, base, terms)], dtype=object)

    joined = docs.withColumn(key, text_key(F.col("text"))).join(dirty, key, "left")
    found_any = F.col(base).isNotNull()
    # clean texts do not visit Python
    cleaned = F.when(found_any, clean(F.when(found_any, F.col("text")), base, terms)).otherwise(F.col("text"))
    names = [cleaned.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*names)
