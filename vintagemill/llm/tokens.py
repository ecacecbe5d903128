"""Token ids of whole texts by the tokenizers library, with repeated words encoded once a task."""

from __future__ import annotations

import os
from array import array
from functools import lru_cache
from unicodedata import category

from vintagemill.llm.memory import AgingMemory

#: About so many bytes of words and their ids are held; this changes no ids.
MEMORY_BYTES = 200 << 20

# byte-level vocabularies write a byte that is no printable Latin-1 sign as the next sign from U+0100 on
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_SIGNS = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file; a full path is taken as it is."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class WordMemory:
    """Encodes texts by the words between single spaces and line ends, each distinct word once.

    A pre-token of the supported vocabularies spans neither, except within a run of white
    space; a text that has such runs is encoded whole.  A comma or full stop after a
    letter is a pre-token of its own.  Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, limit: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # byte-level pre-tokens carry the space before them, word-level ones drop it
        self.lead = " " if len(self._whole(" a")) and self._whole(" a") != self._whole("a") else ""
        self.lowers = self._whole("A") == self._whole("a")
        self.line_end = array("I", self._whole("\n")).tobytes()
        self.ends = {c: array("I", self._whole(c)).tobytes() for c in ",."}
        limit = limit or MEMORY_BYTES
        self.first = AgingMemory(limit // 8)  # ids of a word at the start of a line
        self.later = AgingMemory(limit - limit // 8)  # ids of a word after a space

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, words: set[str], lead: str, memory: AgingMemory) -> dict[str, bytes]:
        known = memory.recall(words)
        words = words.difference(known)
        ended = {w for w in words if w[-1:] in self.ends and w[-2:-1].isalpha()}
        other, found = [], memory.recall({w[:-1] for w in ended})
        model, sign = self.tokenizer.model, lead.translate(_BYTE_SIGNS)
        for word in ({w[:-1] for w in ended} | words - ended).difference(found):
            if word.isalpha() and (word.isascii() or max(word) < "\u0250"):  # one pre-token without composed forms: the model alone decides
                form = word.lower() if self.lowers else word
                spelled = sign + (form if form.isascii() else form.encode().decode("latin-1").translate(_BYTE_SIGNS))
                found[word] = array("I", [t.id for t in model.tokenize(spelled)]).tobytes()
            else:
                other.append(word)
        encoded = self.tokenizer.encode_batch_fast([lead + w for w in other], add_special_tokens=False)
        found.update(zip(other, [array("I", e.ids).tobytes() for e in encoded]))
        found.update([(w, found[w[:-1]] + self.ends[w[-1]]) for w in ended])
        return found | known

    def encode(self, texts: list[str], after_space: bool = False) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; with a space put before it if ``after_space``."""
        memories = (self.first, self.later)
        first, later = self.first.known, self.later.known
        out: list[list[list[bytes]] | None] = []  # for each text the ids of its lines' words
        holes: list[tuple[int, str, list[bytes], int]] = []
        for text in texts:
            lines = []
            for line in text.split("\n"):
                words = line.split(" ")
                ids = list(map(later.get, words))
                led = after_space and not lines
                if not led:
                    ids[0] = first.get(words[0])
                if None in ids:
                    found = [(int(led or i > 0), words[i], ids, i) for i, x in enumerate(ids) if x is None]
                    if any(not w.isalpha() and (w.split() != [w] or category(w[0])[0] == "M") for _, w, _, _ in found):
                        lines = None  # other white space, more of it in a row, or a mark on a space: the cuts may matter
                        break
                    holes += found
                lines.append(ids)
            out.append(lines)
        learned = [self._learn({w for side, w, _, _ in holes if side == of}, lead, memories[of]) for of, lead in enumerate(("", self.lead))]
        for side, word, ids, i in holes:
            ids[i] = learned[side][word]
        for memory, found in zip(memories, learned):
            memory.keep(found)
        space = " " if after_space else ""
        return [array("I", self._whole(space + text)).tobytes() if lines is None else self.line_end.join(map(b"".join, lines))
                for text, lines in zip(texts, out)]


@lru_cache(maxsize=2)
def word_memory(path: str, limit: int | None = None) -> WordMemory:
    """One memory a worker and vocabulary, of this many bytes."""
    return WordMemory(path, limit)


def encode_in_slices(memory: WordMemory, texts: list[str], chars: int = 2_000_000) -> list[bytes]:
    """As ``encode``, with a bounded amount of text at a time."""
    out: list[bytes] = []
    part: list[str] = []
    held = 0
    for text in texts:
        part.append(text)
        held += len(text)
        if held >= chars:
            out += memory.encode(part)
            part, held = [], 0
    return out + (memory.encode(part) if part else [])
