"""Token ids of whole texts by a public tokenizer, at word speed.

White space separates words for this tokenizer, so a text's ids are those of its
words one after the other.  Each Python worker keeps the ids of the words it has
met; a new word of plain letters goes straight to the tokenizer's model, any
other to the tokenizer itself.
"""

from __future__ import annotations

import string
import struct
import unicodedata

from broadsheet.llm.common import worker_cache

TOKENIZER = "word_bpe_49k.json"
#: Words a worker remembers before it starts anew; bounds its memory.
MAX_WORDS = 600_000
LATIN_END = 0x250
#: ASCII characters that are neither letters, digits nor white space.
MARKS = string.punctuation


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokens:
    """``ids(text)``: little-endian unsigned 32-bit token ids of a text, as bytes."""

    def __init__(self, path: str) -> None:
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.seen: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            pattern = json.dumps(json.load(f)["pre_tokenizer"])
        # The short cut below holds for tokenizers that take runs of letters as words.
        self.short_cut = "[\\\\p{L}]+" in pattern

    def _encode(self, word: str) -> bytes:
        return packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _learn(self, word: str) -> bytes:
        if not self.short_cut:
            return self._encode(word)
        head = word.rstrip(MARKS)
        if not head.isalpha():
            return self._encode(word)
        if len(head) < len(word):
            return self._known(head) + self._known(word[len(head) :])
        if word.isascii():
            low = spelled = word.lower()
        else:
            low = "".join(c.lower() for c in unicodedata.normalize("NFC", word))
            if not low.isalpha() or ord(max(low)) >= LATIN_END or ord(max(word)) >= LATIN_END:
                return self._encode(word)
            spelled = "".join(map(self.letters.__getitem__, low.encode()))
        if low != word and low in self.seen:
            return self.seen[low]
        return packed([t.id for t in self.model.tokenize(spelled)])

    def _known(self, word: str) -> bytes:
        found = self.seen.get(word)
        if found is None:
            found = self.seen[word] = self._learn(word)
        return found

    def ids(self, text: str | None) -> bytes:
        if len(self.seen) > MAX_WORDS:
            self.seen.clear()
        words = split_words(text or "")
        for word in set(words).difference(self.seen):
            self._known(word)
        return b"".join(map(self.seen.__getitem__, words))


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def split_words(text: str) -> list[str]:
    """Parts between ASCII white space; other white space is the tokenizer's business."""
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of this Python worker."""
    return worker_cache(f"tokens:{path}", lambda: WordTokens(path))
