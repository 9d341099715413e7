"""Token ids of whole texts, with a memory of words already encoded.

The tokenizer files used here cut a text into words before they merge bytes, and never merge over a single space or
line break between other characters.  A text is therefore cut there, each distinct word is encoded once while a task
remembers it, and the ids are put together again; they equal those of the whole text (tested against the tokenizer
itself).  Texts with other white space are encoded whole.  Words of Latin letters, which no rule of these files cuts or
rewrites further, go to the tokenizer's BPE model directly.
"""
from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_WORDS = 400_000
MEMO_CHARS = 10_000_000
GROUP_CHARS = 3_000_000        # texts of about so many characters are cut together
# white space but single spaces and line breaks between other characters, the two marks below, and a letter that has no
# single lower-case form
OTHER_SPACE = r"[\t\x0b\x0c\r\x1c-\x1f\x01\x02\x{85}\p{Zl}\p{Zp}\x{130}]|[^\P{Zs} ]|[ \n]{2}|\A[ \n]|[ \n]\z"
JOINED = 256                   # new words encoded as one string
MARK = "\x01"                  # stands between them; a token of its own
START = "\x02"                 # before a word that follows no space: a text's first one, or a sentence mark cut off
# sentence marks after a Latin letter and before a space: pieces of their own under the rules of these files
SENTENCE_END = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}])([.,;:!?]+)( |\z)"
LATIN_END = "\u0250"           # letters below it are composed, and their case and class are the same for every library
# Byte-level files write a byte as a character: printable ones as themselves, the others from U+0100 on in order.
PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_CHARS = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - PRINTABLE))}
SPACE = chr(BYTE_CHARS[0x20])
PROBE = ["the", "qzxvkw", "straße", "überraschung", "naïve", "năm", "œuvre"]


class Encoder:
    """encode(texts): the ids of each text as a uint32 array, without special tokens."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.keeps_spaces = type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel"
        self.gap = MARK if self.keeps_spaces else f" {MARK} "
        mark = self._plain([MARK])[0]
        written = [t for t in self.tokenizer.get_vocab() if "\u0101" in t]      # U+0101: how byte-level files write byte 1
        self.joins = len(mark) == 1 and len(written) <= 2
        self.mark = mark[0] if len(mark) else -1
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.direct = (type(self.model).__name__ == "BPE" and all(t.special for t in added)
                       and self._merged(PROBE) == self._plain([self._written(w) for w in PROBE]))
        self._clear()

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _clear(self):
        self.place: dict[str, int] = {}
        self.chars = self.used = 0
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.start, self.size = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)

    def _written(self, word: str) -> str:
        if not self.keeps_spaces or word[0] == "\n":
            return word
        return word[1:] if word[0] == START else " " + word

    def _is_letters(self, word: str) -> bool:
        """Whether the word is of Latin letters only, so that it is one piece, which needs no cutting or normalising."""
        if self.keeps_spaces and word[:1] == START:
            word = word[1:]
        return word.isalpha() and (word.isascii() or max(word) < LATIN_END)

    def _piece(self, word: str) -> str:
        """A word of letters as byte-level files write it."""
        word = self._written(word)
        return word.replace(" ", SPACE) if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARS)

    def _merged(self, words: list[str]) -> list[list[int]]:
        """The ids of words of letters, from the tokenizer's model itself."""
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(p)] for p in map(self._piece, words)]

    def _learn(self, fresh: list[str]):
        letters = [self.direct and self._is_letters(w) for w in fresh]
        simple, fresh = [w for w, x in zip(fresh, letters) if x], [w for w, x in zip(fresh, letters) if not x]
        if simple:
            self._keep(simple, self._merged(simple))
        if not fresh:
            return
        if not self.joins or any(w.startswith(START + "'") for w in fresh):       # a contraction must not follow a mark
            self._keep(fresh, self._plain([self._written(w) for w in fresh]))
        else:
            strings = [self.gap.join(map(self._written, fresh[i:i + JOINED])) + self.gap for i in range(0, len(fresh), JOINED)]
            marked = np.concatenate([np.array(i, dtype=np.uint32) for i in self._plain(strings)])
            self._store(fresh, marked[marked != self.mark], np.diff(np.flatnonzero(marked == self.mark), prepend=-1) - 1)

    def _keep(self, words: list[str], coded: list[list[int]]):
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        self._store(words, np.fromiter(chain.from_iterable(coded), dtype=np.uint32, count=sizes.sum()), sizes)

    def _store(self, words: list[str], flat: np.ndarray, sizes: np.ndarray):
        n, need = len(self.place), self.used + len(flat)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(need - len(self.flat), len(self.flat)), dtype=np.uint32)])
        if n + len(words) > len(self.start):
            grow = np.zeros(max(len(words), len(self.start)), dtype=np.int64)
            self.start, self.size = np.concatenate([self.start, grow]), np.concatenate([self.size, grow])
        self.flat[self.used:need] = flat
        self.size[n:n + len(words)] = sizes
        self.start[n:n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.used = need
        self.place.update(zip(words, range(n, n + len(words))))
        self.chars += sum(map(len, words))

    def encode(self, texts: list):
        """The ids of each text, one after the other."""
        group, held = [], 0
        for text in texts:
            group.append(text or "")
            held += len(group[-1])
            if held >= GROUP_CHARS:
                yield from self._group(group)
                group, held = [], 0
        if group:
            yield from self._group(group)

    def _group(self, texts: list[str]):
        column = pa.array(texts, pa.large_string())
        whole = pc.match_substring_regex(column, OTHER_SPACE).to_numpy(zero_copy_only=False)
        empty = np.fromiter((not t for t in texts), dtype=bool, count=len(texts))
        usual = column.filter(pa.array(~(whole | empty)))
        if self.keeps_spaces:             # a word after a break holds the break; the first word holds a mark
            usual = pc.binary_join_element_wise(pa.scalar(START, pa.large_string()), pc.replace_substring(usual, "\n", " \n"), pa.scalar("", pa.large_string()))
            usual = pc.replace_substring_regex(usual, SENTENCE_END, rf"\1 {START}\2\3")
        else:
            usual = pc.utf8_lower(pc.replace_substring(usual, "\n", " "))      # as the tokenizer itself does first
            usual = pc.replace_substring_regex(usual, SENTENCE_END, r"\1 \2\3")
        lists = pc.split_pattern(usual, " ")
        coded = lists.flatten().dictionary_encode()
        at = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()] if len(coded) else np.zeros(0, dtype=np.int64)
        edges = lists.offsets.to_numpy()
        size = self.size[at]
        ends = np.cumsum(size)
        first = (self.start[at] - ends + size).astype(np.int32)               # a group has under 2^31 ids
        flat = self.flat[np.repeat(first, size) + np.arange(ends[-1], dtype=np.int32)] if len(at) else np.zeros(0, dtype=np.uint32)
        ends = np.concatenate([[0], ends])[edges - edges[0]]
        k = 0
        for text, is_whole, is_empty in zip(texts, whole, empty):
            if is_empty:
                yield np.zeros(0, dtype=np.uint32)
            elif is_whole:
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            else:
                yield flat[ends[k]:ends[k + 1]]
                k += 1

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The number of each distinct word; words not yet known are encoded."""
        if len(self.place) > MEMO_WORDS or self.chars > MEMO_CHARS:
            self._clear()
        at = [self.place.get(w, -1) for w in words]
        fresh = [w for w, k in zip(words, at) if k < 0]
        if fresh:
            self._learn(fresh)
            at = [self.place[w] if k < 0 else k for w, k in zip(words, at)]
        return np.array(at, dtype=np.int64)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for the batches of a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
