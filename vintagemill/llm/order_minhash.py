"""Document fingerprints by Order MinHash: sensitive to which k-mers a text has and to their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagemill.llm.ordering import with_next

K, TUPLE, SIZE = 2, 2, 64

_POSITION_BITS = 24  # a sort key holds 40 bits of hash above the k-mer's position
_MASK = (1 << _POSITION_BITS) - 1


def _hash_part(x: Column) -> Column:
    return F.shiftrightunsigned(x, _POSITION_BITS)


def _sort_key(hashed: Column, position: Column) -> Column:
    return hashed.bitwiseAND(F.lit(~_MASK)).bitwiseOR(position.cast("long"))


def _position(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_MASK))


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, tuple_size: int = TUPLE, size: int = SIZE) -> DataFrame:
    """Adds ``out``: an array of ``size`` ints, the Order MinHash signature of ``text``.

    Words are what white space separates; a k-mer is ``k`` words in a row, or all words
    of a shorter text.  Each k-mer gets a number for its earlier occurrences, and the
    pair a hash.  One order of the pairs serves all components: component i starts at
    the i-th of ``size`` equidistant points of the circle of hashes and takes the next
    ``tuple_size`` pairs, i.e. the minimal ones under a shifted hash.  Their k-mers, back in text order, are hashed to the component.

    A NULL text counts as empty; without words the signature is empty.  Equal texts have
    equal signatures.  Works on arrays within the row: nothing is shuffled, and the cost
    is one sort of each text's k-mers.  Beyond 16,777,214 words positions tie.
    """
    c = {n: f"_{out}_{n}" for n in ("words", "kmers", "sorted", "again", "occ", "pairs", "idx")}
    keep = df.columns
    words, kmers, ordered, again, occ, pairs, idx = map(F.col, c.values())

    # \s+ leaves an empty string before leading and after trailing white space
    df = df.withColumn(c["words"], F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), ""))
    count = F.greatest(F.size(words) - (k - 1), F.lit(1))
    df = df.withColumn(c["kmers"], F.transform(
        F.slice(words, 1, count),
        lambda w, i: _sort_key(F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]), F.least(i, F.lit(_MASK - 1)))))
    df = df.withColumn(c["sorted"], F.sort_array(kmers)).drop(c["words"])

    # repeated k-mers stand together; those that equal their predecessor are later occurrences
    def repeats(a: Column):
        return lambda x, i: _hash_part(x.bitwiseXOR(F.get(a, i - 1))) == 0

    df = df.withColumn(c["again"], F.filter(ordered, repeats(ordered)))
    n = F.size(again)
    begins = F.filter(F.sequence(F.lit(0), n - 1), lambda j: F.coalesce(
        _hash_part(F.get(again, j).bitwiseXOR(F.get(again, j - 1))) != 0, F.lit(True)))
    numbers = F.transform(F.array(begins), lambda b: F.flatten(F.transform(
        b, lambda a, q: F.sequence(F.lit(1), F.coalesce(F.get(b, q + 1), n) - a))))
    df = df.withColumn(c["occ"], F.when(n > 0, F.get(numbers, F.lit(0))))
    # zip_with, not a lookup of occ in a lambda: the optimizer would move its making into the loop
    later = F.zip_with(again, occ, lambda x, j: _sort_key(F.xxhash64(_hash_part(x), j), _position(x)))
    first = F.filter(ordered, lambda x, i: F.coalesce(~repeats(ordered)(x, i), F.lit(True)))
    df = df.withColumn(c["pairs"], F.when(n == 0, ordered).otherwise(F.sort_array(F.concat(first, later))))

    # equidistant marks sorted in among the pairs; a mark's place less the marks before it is its start
    step = (1 << 64) // size
    marks = F.array(*[F.lit(((i * step - (1 << 63)) & ~_MASK) | _MASK) for i in range(size)])
    marked = F.transform(F.array(F.sort_array(F.concat(pairs, marks))), lambda m: F.filter(
        F.sequence(F.lit(0), F.size(m) - 1), lambda i: _position(F.get(m, i)) == _MASK))
    df = df.withColumn(c["idx"], F.get(marked, F.lit(0)))

    def component(mark: Column, i: Column) -> Column:
        # around the circle; with fewer pairs than a tuple takes, pairs come again
        places = F.sort_array(F.array(*[_position(F.get(pairs, (mark - i + j) % F.size(pairs))) for j in range(tuple_size)]))
        text_order = F.transform(places, lambda at: _hash_part(F.get(kmers, at.cast("int"))))
        return F.shiftright(F.xxhash64(text_order), 32).cast("int")

    signature = F.transform(idx, component)
    return df.select(*keep, F.when(F.size(pairs) > 0, signature).otherwise(F.array().cast("array<int>")).alias(out))


def hex_of(signature: Column) -> Column:
    """The signature as text: eight hexadecimal digits a component."""
    return F.lower(F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal components, 0 to 1; two texts without words are alike, one of them is like no other."""
    same = F.size(F.filter(F.transform(a, lambda x, i: x == F.get(b, i)), lambda x: x))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(same / F.size(a))


def edited_by_next(docs: DataFrame, k: int = K, tuple_size: int = TUPLE, size: int = SIZE) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has the last floor(n_chars / 3) code points replaced by as many from
    the start of the next document's text (all of it, if shorter), in descending doc_id
    order; after the last document comes the first.  Equal doc_ids are ordered by text, NULL
    doc_ids come last.  One row per input row; an empty table gives an empty table;
    other columns than doc_id and text are not looked at.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows, "doc_id", ["text"], {"text": "next_text", "sig": "next_sig"},
                     lambda every: with_fingerprint(every, "text", "sig", k, tuple_size, size))
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    rows = rows.withColumns({"n_chars": n.cast("long"), "cut": cut})
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - F.col("cut")),
                      F.substring(F.col("next_text"), F.lit(1), F.col("cut")))
    rows = rows.withColumn("edited", edited).drop("text", "next_text", "cut")
    rows = with_fingerprint(rows, "edited", "edited_sig", k, tuple_size, size)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        hex_of(F.col("sig")).alias("fingerprint"), hex_of(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
