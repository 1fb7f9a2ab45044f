"""Whole texts to subword ids with the tokenizers library, by memo of words.

The library spends most of its time in splitting a text and tracking offsets.
The byte-level pattern never joins a non-space character to a space after it,
so a text can be cut before each such space without changing its ids. A line
end before a word is an id by itself, and punctuation after letters a piece of
its own. Words repeat: each distinct one goes to the library's model once, and a
text's ids are the joined ids of its words.

New words go to the model many at a time, joined by the space or line end before
them. No entry of the vocabulary may then reach over such a place, which is
looked up when the vocabulary is read; where one does, words go one by one.
Texts with white space outside ASCII, or with the string of a special token, go
to the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
from tokenizers import Tokenizer

from . import common

#: Characters that some engines count as white space and others do not, or that are white space beyond ASCII.
RARE = [chr(c) for c in (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, *range(0x205F, 0x2065), 0x3000, 0xFEFF)]
UNIT = re.compile(r"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
#: ASCII that the pattern takes as one run after letters. The apostrophe can begin a contraction.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: What the split at single spaces and line ends can't take; substring tests run far faster than a pattern here.
RUNS = ["  ", " \n", "\n ", "\n\n", "\t", "\r", "\x0b", "\x0c", "\0"]
#: The byte-level alphabet's characters for a space and a line end.
SPACE, END = "\u0120", "\u010a"
#: Entries that reach over the place before a space or a line end, or from a line end into a word.
ACROSS = re.compile(f"[^{SPACE}{END}][{SPACE}{END}]|{END}[^{SPACE}{END}]")
#: Characters of texts that are encoded together; words that the model gets at a time.
SLICE, TOGETHER = 1 << 14, 512


class Memo:
    """Word to id bytes in two generations: the memory stays bounded, and
    frequent words stay known when the older generation goes."""

    def __init__(self, most: int):
        self.most, self.now, self.old = most, {}, {}

    def turn(self) -> None:
        if len(self.now) >= self.most:
            self.old, self.now = self.now, {}

    def forget(self, long: list[str]) -> None:
        """Very long words are not worth their room."""
        for word in long:
            self.now.pop(word, None)


class WordEncoder:
    """``encode(text)`` gives the ids of a whole text as little-endian bytes:
    those of the library without special tokens added. A special token's own
    string in a text is read as the library reads it, as that token; with
    ``special_as_text`` it is ordinary text."""

    def __init__(self, path: str, words: int = 500_000, *, special_as_text: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        #: Texts that hold one of these go to the library whole.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.vocab_size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.vocab_size <= 1 << 16 else "<u4")
        # Byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ... in order.
        own = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [b for b in range(256) if b not in own]
        self.table = {b: b if b in own else 256 + rest.index(b) for b in range(256)}
        self.tokenize = self.tokenizer.model.tokenize
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        byte_of = {chr(c): b for b, c in self.table.items()}
        self.together = 1 if any(self._in_words(bytes(byte_of[c] for c in entry if c in byte_of)) for entry in vocabulary if ACROSS.search(entry)) else TOGETHER
        #: Whether an id begins with a space or a line end.
        self.begins = np.zeros(self.vocab_size, dtype=bool)
        self.begins[[k for entry, k in vocabulary.items() if entry[0] in (SPACE, END)]] = True
        #: Words after a space as they are, after a line end with it, at a text's beginning after \0.
        self.words, self.units = Memo(words), Memo(words)
        self.wide = self.dtype.itemsize
        self.marks: dict[str, bytes] = {}

    @staticmethod
    def _in_words(entry: bytes) -> bool:
        """Whether an entry can lie in words of letters with spaces between."""
        try:
            return all(c.isalpha() or c in " \n" for c in entry.decode())
        except UnicodeDecodeError:
            return True

    def _pack(self, ids: Iterable[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _alphabet(self, word: str) -> str:
        return word if word.isascii() else word.encode().decode("latin-1").translate(self.table)

    def _mark(self, run: str) -> bytes:
        """A run of punctuation after letters."""
        if (code := self.marks.get(run)) is None:
            code = self._pack([t.id for t in self.tokenize(run)])
            if len(self.marks) < 10_000 and len(run) < 20:
                self.marks[run] = code
        return code

    def _pieces(self, words: list[str], before: str, into: dict[str, bytes]) -> None:
        """Puts the ids of words that the pattern keeps whole, each with the
        character ``before`` it."""
        plain = list(filter(str.isascii, words))
        others = [] if len(plain) == len(words) else [w for w in words if not w.isascii()]
        for group in (plain, others):
            for at in range(0, len(group), self.together):
                some = group[at : at + self.together]
                joined = before + before.join(some if group is plain else map(self._alphabet, some))
                ids = np.array([t.id for t in self.tokenize(joined)], dtype=self.dtype)
                code = ids.tobytes()
                cuts = [*(np.flatnonzero(self.begins[ids]) * self.wide).tolist(), len(code)] if len(some) > 1 else [0, len(code)]
                into.update(zip(some, map(code.__getitem__, map(slice, cuts[:-1], cuts[1:])), strict=True))

    def _learn(self, words: Iterable[str], memo: Memo) -> None:
        """Puts the ids of new words into the memo."""
        plain: list[str] = []
        begun: list[str] = []
        marked: list[str] = []
        stems: list[str] = []
        memo.turn()
        now, old, marks = memo.now, memo.old, self.marks
        for word in words:
            if (code := old.get(word)) is not None:
                now[word] = code
            elif word.isalpha():
                plain.append(word)
            elif (letters := word.rstrip(PUNCTUATION)).isalpha():
                marked.append(word)
                stems.append(letters)
            elif word[:1] not in ("\n", "\0"):
                now[word] = self._whole(" " + word)
            elif (bare := word[1:]).isalpha():
                begun.append(bare)
            elif (letters := bare.rstrip(PUNCTUATION)).isalpha():
                marked.append(word)
                stems.append(word[0] + letters)
            else:
                now[word] = self._whole(word if word[0] == "\n" else bare)
        for stem in stems:
            if stem in now:
                continue
            if (code := old.get(stem)) is not None:
                now[stem] = code
            elif stem[0] in "\n\0":
                begun.append(stem[1:])
            else:
                plain.append(stem)
        self._pieces(list(dict.fromkeys(plain)), SPACE, now)
        if begun:
            lines: dict[str, bytes] = {}
            self._pieces(list(dict.fromkeys(begun)), END, lines)
            for word, code in lines.items():
                now["\n" + word], now["\0" + word] = code, code[self.wide :]
        for word, stem in zip(marked, stems, strict=True):
            run = word[len(stem) :]
            now[word] = now[stem] + (marks.get(run) or self._mark(run))

    def _codes(self, words: list[str], memo: Memo, learn) -> list[bytes]:
        codes = list(map(memo.now.get, words))
        if new := [k for k, code in enumerate(codes) if code is None]:
            missing = [words[k] for k in new]
            learn(dict.fromkeys(missing), memo)
            for k, code in zip(new, map(memo.now.__getitem__, missing), strict=True):
                codes[k] = code
            memo.forget([word for word in missing if len(word) > 200])
        return codes

    def _learn_units(self, units: Iterable[str], memo: Memo) -> None:
        memo.turn()
        for u in units:
            memo.now[u] = memo.old.get(u) or self._whole(u)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """``encode`` of each text; they are taken together."""
        out = [b""] * len(texts)
        for a, b in common.slices([len(t or "") for t in texts], SLICE) if texts else ():
            words: list[str] = []
            ends: list[tuple[int, int]] = []
            for k in range(a, b):
                if not (text := texts[k]):
                    continue
                if any(c in text for c in (RARE[:4] if text.isascii() else RARE)) or any(t in text for t in self.added):
                    out[k] = self._whole(text)
                elif any(run in text for run in RUNS):
                    out[k] = b"".join(self._codes(UNIT.findall(text), self.units, self._learn_units))
                else:
                    words += ("\0" + text.replace("\n", " \n")).split(" ")
                    ends.append((k, len(words)))
            codes, at = self._codes(words, self.words, self._learn), 0
            for k, end in ends:
                out[k] = b"".join(codes[at:end])
                at = end
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
