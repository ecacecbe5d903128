"""Token counts under a unigram model, with scores of shared prefixes computed once."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagemill.llm.batches import bound_batches
from vintagemill.llm.tokens import tokenizer_path

WORD_START = "▁"
#: Terminal counts kept a Python worker; beyond it the memory starts anew, which changes no counts.
MEMORY = 1_500_000

_BYTE_PENALTY = 10.0


def zipf_scores(path: str) -> dict[str, float]:
    """Log-probability of every ordinary piece of a sentencepiece file.

    The public vocabulary ranks its pieces but has no unigram probabilities; a piece's
    probability is taken to be inverse to its rank (Zipf's law), which is a rule, not a
    fit.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    ranked = sorted(ids, key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / r for r in range(1, len(ranked) + 1)))
    return {model.id_to_piece(i): -math.log(r) - total for r, i in enumerate(ranked, 1)}


class PrefixTrie:
    """Counts tokens of the best unigram segmentation of pre-tokens.

    The best score of a prefix does not depend on what follows it.  New pre-tokens are
    inserted in order, which walks their trie depth first: only the path to the current
    node is held, each node is scored once, and terminal nodes leave their count.
    Equal scores go to fewer tokens.  A character no piece covers costs one token a byte.
    """

    def __init__(self, scores: Mapping[str, float]):
        self.scores = dict(scores)
        self.longest = max(map(len, scores), default=1)
        self.byte = min(scores.values(), default=0.0) - _BYTE_PENALTY
        self.terminal: dict[str, int] = {}
        self.nodes = 0

    def insert(self, words: Iterable[str]) -> None:
        """Scores words; each is spelled with the word-start sign before it."""
        path: list[tuple[float, int]] = [(0.0, 0)]  # score and minus the number of tokens of each prefix of the last word
        last = ""
        get, longest = self.scores.get, self.longest
        for plain in sorted(words):
            word = WORD_START + plain
            shared = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                shared += 1
            del path[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                n = len(word[end - 1].encode())
                score, tokens = path[end - 1]
                best = (score + n * self.byte, tokens - n)
                for start in range(max(0, end - longest), end):
                    piece = get(word[start:end])
                    if piece is not None:
                        score, tokens = path[start]
                        best = max(best, (score + piece, tokens - 1))
                path.append(best)
            self.nodes += len(word) - shared
            self.terminal[plain] = -path[-1][1]
            last = word

    def learn(self, words: set[str]) -> None:
        """Inserts the words that are not known, or all after the memory was full."""
        new = words.difference(self.terminal)
        if len(self.terminal) + len(new) > MEMORY:
            self.terminal, new = {}, words
        self.insert(new)


@lru_cache(maxsize=2)
def _trie(path: str) -> PrefixTrie:
    return PrefixTrie(zipf_scores(path))


def token_counts(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, n_words, n_tokens of every whole text.

    Pre-tokens are the words between white space, each with the word-start sign before
    it.  The trie grows over the documents of a task; nothing is shuffled.  A NULL or blank text
    has no words.  One row per input row; an empty table gives an empty table; other
    columns than doc_id and text are not looked at.
    """
    bound_batches(docs.sparkSession)
    path = tokenizer_path(tokenizer)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = _trie(path)
        for batch in batches:
            split = [text.split() for text in batch["text"].tolist()]
            trie.learn(set().union(*split))  # together, so that words of the whole batch share prefixes
            get = trie.terminal.__getitem__
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_words": [len(w) for w in split], "n_tokens": [sum(map(get, w)) for w in split]})

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(count, "doc_id long, n_words long, n_tokens long")
