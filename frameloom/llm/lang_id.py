"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds all substrings of a bounded sample
of its labelled text. A text is parsed greedily: each phrase is the longest
match that the sample has from there on, and a character that the sample lacks
is a phrase of its own. Few phrases mean a kindred sample. With c phrases over
n characters and a sample of N, the cross entropy is about c * log2(N) / n bits
a character; the language with the least wins, ties go to the name that sorts
first.

The automata are laid out as one double array: a state is a number, its
transition by a symbol lies at that number plus the symbol, with the state it
belongs to. So memory grows with the samples, whatever the alphabet.
Parsing is a look-up a character, done by NumPy for thousands of texts at
a time. Texts of more than ``CHUNK`` characters run in parts: each part is
parsed as if a phrase began there, and then again from the state in which the
part before ends, until both are in the same state, which they share from there
on. That takes a few dozen characters, and the counts are those of the whole.

Training reads text and label only; at most ``docs`` texts a language, spread
over the corpus by a hash of the text, and ``chars`` characters of each. Every
label is a language, and every character of the samples a symbol.

Null texts and texts without letters are ``und``; repeated rows are predicted
each by itself; an empty table, or one without labels, has no languages and
every row of it is ``und``. Carried columns may have any names, but those of
results give way to these.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

CHUNK = 4096
#: Above all symbols: a character is at most 0x10FFFF.
NO_LETTER = 1 << 21
#: Characters encoded and, as symbols, parsed at a time; they bound a worker's memory.
SLICE, TOGETHER = 1 << 19, 1 << 22
UNKNOWN = "und"


def normalise(text: str) -> str:
    """Lower case, everything but letters as single spaces."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def has_letter(text: str) -> bool:
    return text.isalpha() or any(map(str.isalpha, text))


class SuffixAutomaton:
    """Online construction; ``next[state]`` maps symbols to states."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for c in text:
            state = self._state(self.length[last] + 1, {}, 0)
            at = last
            while at >= 0 and c not in self.next[at]:
                self.next[at][c] = state
                at = self.link[at]
            if at >= 0:
                to = self.next[at][c]
                if self.length[to] == self.length[at] + 1:
                    self.link[state] = to
                else:
                    twin = self._state(self.length[at] + 1, dict(self.next[to]), self.link[to])
                    while at >= 0 and self.next[at].get(c) == to:
                        self.next[at][c] = twin
                        at = self.link[at]
                    self.link[to] = self.link[state] = twin
            last = state

    def _state(self, length: int, following: dict[str, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1


#: A cell: the state that it belongs to, how many phrases end there, the state that follows.
OWNER, ENDED, NEXT = 34, 32, (1 << 32) - 1


class Transitions:
    """Transitions of states as a double array: ``state`` has the number that
    each row got, and ``cells[number + symbol]`` is its transition. Where there
    is none the cell belongs to another state or to none (-1).

    A root has a cell for each symbol: one that begins no phrase is a phrase by
    itself, and leads to the root again."""

    #: Places tried for a row before new room is taken.
    TRIES = 64

    def __init__(self, rows: list[dict[int, int]], roots: list[int], symbols: int):
        """``rows``: for each state the symbols (from 1 to ``symbols``) and the
        rows that follow."""
        self.state = np.zeros(len(rows), dtype=np.int64)
        # ``top`` is above all that is used; there always is room for a row after it.
        first = symbols + 1
        floor = top = first + len(roots) * (symbols + 1)
        used, taken, rest = bytearray(b"\1" * top), set(), []
        for k, root in enumerate(roots):
            self.state[root] = first + k * (symbols + 1)
            taken.add(first + k * (symbols + 1))
        for k in sorted(set(range(len(rows))) - set(roots), key=lambda k: (-len(rows[k]), k)):
            own = rows[k]
            if len(own) < 2:
                rest.append(k)
                continue
            low, wide, at = min(own), max(own) - min(own), floor + k * 7919 % (top - floor + 1)
            if len(used) < top + self.TRIES + 2 * symbols:
                used.extend(bytes(len(used) + self.TRIES))
            for _ in range(self.TRIES):
                at = used.find(0, at)
                if at >= top or (at - low not in taken and not any(used[at + c - low] for c in own)):
                    break
                at += 1
            else:
                at = top
            while at - low in taken:
                at += 1
            top = max(top, at + wide + 1)
            self.state[k] = at - low
            taken.add(at - low)
            for c in own:
                used[at + c - low] = 1
        # Rows of one transition take what is free; those of none need a number only.
        free, later = used.find(0, first), []
        for k in rest:
            c = next(iter(rows[k]), 0)
            for j, at in enumerate(later):
                if at - c not in taken:
                    later[j] = later[-1]
                    later.pop()
                    break
            else:
                while True:
                    if free < 0 or free >= len(used):
                        free = len(used)
                        used.extend(bytes(len(used)))
                    at, free = free, used.find(0, free + 1)
                    if at - c not in taken:
                        break
                    if len(later) < 100:
                        later.append(at)
            self.state[k] = at - c
            taken.add(at - c)
            if c:
                used[at] = 1
        self.cells = np.full(max(len(used), int(self.state.max(initial=0)) + 1) + symbols + 1, -1, dtype=np.int64)
        for root in roots:
            at = self.state[root]
            self.cells[at : at + symbols + 1] = at << OWNER | 1 << ENDED | at
        if moves := [(k, c, to) for k, row in enumerate(rows) for c, to in row.items()]:
            k, c, to = (np.array(x, dtype=np.int64) for x in zip(*moves, strict=True))
            self.cells[self.state[k] + c] = self.state[k] << OWNER | self.state[to]


class Parser:
    """Counts phrases of many texts against every language's sample."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        counts = Counter(c for s in samples.values() for c in s)
        # Symbol 0 is whatever no sample has.
        letters = sorted(counts, key=lambda c: (-counts[c], c))
        self.symbol = {c: k + 1 for k, c in enumerate(letters)}
        self.bits = [math.log2(max(2, len(samples[x]))) for x in self.langs]
        rows: list[dict[int, int]] = []
        roots = []
        for lang in self.langs:
            before = len(rows)
            roots.append(before)
            rows += [{self.symbol[c]: before + to for c, to in own.items()} for own in SuffixAutomaton(samples[lang]).next]
        moves = Transitions(rows, roots, len(letters))
        self.cells, self.roots = moves.cells, moves.state[roots]
        # Without a match a phrase ends and the root's way is taken: by symbol and language.
        self.begin = (self.cells[self.roots + np.arange(len(letters) + 1)[:, None]] & ((1 << OWNER) - 1)) + (1 << ENDED)

    @cached_property
    def codes(self) -> np.ndarray:
        """The symbol of each character, -1 if it has none."""
        out = np.full(0x110000, -1, dtype=np.int32)
        for c, k in self.symbol.items():
            out[ord(c)] = k
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "codes"}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all normalised texts, and how many each has."""
        # A line end parts the texts: it is not a letter, and lower() makes none.
        chars = np.frombuffer("\n".join(t.lower().replace("\n", " ") for t in texts).encode("utf-32-le"), dtype="<u4")
        codes = self.codes[chars]
        other = np.unique(chars[codes == -1])
        letter = np.array([chr(c).isalpha() for c in other], dtype=bool)
        lookup = np.zeros(int(other.max(initial=0)) + 1, dtype=np.int32)
        lookup[other[~letter]] = NO_LETTER
        rest = codes == -1
        codes[rest] = lookup[chars[rest]]
        space = (codes == NO_LETTER) | (codes == self.symbol.get(" ", -9))
        ends = np.flatnonzero(chars == 10)
        text_of = np.zeros(len(chars), dtype=np.int32)
        text_of[ends] = 1
        text_of = np.cumsum(text_of, dtype=np.int32)
        # A space counts if a letter of the same text follows and one came before.
        keep = ~space
        after = np.zeros(len(chars), dtype=bool)
        after[:-1] = ~space[1:]
        lead = np.zeros(len(texts), dtype=np.int64)
        where = np.flatnonzero(keep)
        lead[:] = len(chars)
        np.minimum.at(lead, text_of[where], where)
        gap = space & after & (chars != 10) & (np.arange(len(chars)) > lead[text_of])
        codes[space] = self.symbol.get(" ", 0)
        chosen = keep | gap
        return codes[chosen], np.bincount(text_of[chosen], minlength=len(texts))

    def _step(self, at: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after one symbol each, and how many phrases have ended."""
        found = self.cells.take(at + symbols[:, None])
        found = np.where(found >> OWNER == at, found, self.begin.take(symbols, axis=0))
        return found & NEXT, found >> ENDED & 3

    def phrases(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases by text and language."""
        parts = -(-sizes // CHUNK)
        text_of = np.repeat(np.arange(len(sizes)), parts)
        offset = np.arange(len(text_of)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(np.cumsum(sizes) - sizes, parts) + offset * CHUNK
        size = np.minimum(np.repeat(sizes, parts) - offset * CHUNK, CHUNK)
        order = np.argsort(-size, kind="stable")
        n = len(self.langs)
        at = np.tile(self.roots, (len(begin), 1))
        count = np.zeros((len(begin), n), dtype=np.int64)
        # The lanes that reach step t are the first so many, for they are sorted by size.
        upto = np.searchsorted(-size[order], -np.arange(int(size.max(initial=0))), side="left")
        first = begin[order]
        for t in range(len(upto)):
            live = int(upto[t])
            at[:live], ended = self._step(at[:live], symbols[first[:live] + t])
            count[:live] += ended
        at[order], count[order] = at.copy(), count.copy()
        # A part goes on from the state that the one before ends in, which seldom depends on where that began.
        fresh, start, gained = at, np.tile(self.roots, (len(begin), 1)), np.zeros_like(count)
        at = fresh.copy()
        while True:
            wanted = np.where((offset > 0)[:, None], np.roll(at, 1, axis=0), self.roots)
            todo = np.flatnonzero((wanted != start).any(axis=1))
            if not len(todo):
                break
            start[todo] = wanted[todo]
            gained[todo], at[todo] = self._joined(symbols, begin[todo], size[todo], start[todo], fresh[todo])
        count += gained
        last = np.append(offset[1:] == 0, True)[: len(offset)]
        count[last] += (at != self.roots)[last]
        out = np.zeros((len(sizes), n), dtype=np.int64)
        np.add.at(out, text_of, count)
        return out

    def _joined(self, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray, start: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For parts that begin in state ``start``: the phrases that they end
        beyond those from a fresh beginning, and the states that they end in
        (``fresh``, if both ways meet)."""
        gained, end = np.zeros(start.shape, dtype=np.int64), fresh.copy()
        live, a, b, t = np.arange(len(begin)), start, np.tile(self.roots, (len(begin), 1)), 0
        while len(live):
            now = symbols[begin[live] + t]
            (a, x), (b, y) = self._step(a, now), self._step(b, now)
            gained[live] += x - y
            t += 1
            met, over = (a == b).all(axis=1), size[live] <= t
            end[live[over]] = a[over]
            on = ~met & ~over
            live, a, b = live[on], a[on], b[on]
        return gained, end

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text. The score is how far the second
        best language is behind, as a share of its entropy."""
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [k for k, t in enumerate(texts) if t and has_letter(t)] if self.langs else []
        for a, b in common.slices([len(texts[k]) for k in known], TOGETHER // (1 + len(self.langs) // 16)) if known else ():
            own = [texts[k] for k in known[a:b]]
            parts = [self.encode(own[c:d]) for c, d in common.slices(map(len, own), SLICE)]
            symbols, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
            entropy = self.phrases(symbols, sizes) * np.array(self.bits) / np.maximum(sizes, 1)[:, None]
            first = entropy.argmin(axis=1)
            ranked = np.sort(entropy, axis=1)
            second = ranked[:, 1] if len(self.langs) > 1 else np.maximum(ranked[:, 0], math.log2(27))
            score = np.clip(1 - ranked[:, 0] / np.maximum(second, 1e-12), 0, 1)
            for k, x, s in zip(known[a:b], first.tolist(), score.tolist(), strict=True):
                langs[k], scores[k] = self.langs[x], s
        return langs, scores


def sample(docs: DataFrame, learn: Column, *, docs_a_lang: int = 64, chars: int = 400) -> dict[str, str]:
    """Normalised sample text of each language, of labelled rows that
    ``learn`` admits. Each language keeps the text of least hash in each of
    ``docs_a_lang`` hash classes, an aggregation with partial results."""
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("text").alias("h"))
    rows = rows.withColumn("k", F.pmod("h", F.lit(docs_a_lang)))
    # docs_a_lang hashes for each language come to the driver, and go out again to pick the rows.
    least = rows.groupBy("lang", "k").agg(F.min("h").alias("h")).collect()
    if not least:
        return {}
    chosen = docs.sparkSession.createDataFrame(least, "lang string, k long, h long")
    found = rows.join(F.broadcast(chosen), ["lang", "k", "h"]).select("lang", "k", F.substring("text", 1, 4 * chars).alias("text")).distinct().orderBy("lang", "k", "text").collect()
    texts: dict[str, list[str]] = {}
    for lang, _, text in found:
        texts.setdefault(lang, []).append(normalise(text)[:chars])
    return {lang: " ".join(filter(None, own)) for lang, own in texts.items() if any(own)}


def predict(docs: DataFrame, samples: dict[str, str], carry: list[str]) -> DataFrame:
    """The ``carry`` columns with fl_lang (``und`` for null texts and texts
    without letters) and fl_score, one row for each row of ``docs``. Without
    samples every language is ``und``."""
    found = _predicted(docs.select(common.carried(carry), F.col("text").cast("string").alias("fl_text")), samples)
    return found.select(*common.spread(carry, ["fl_lang", "fl_score"]))


def _predicted(rows: DataFrame, samples: dict[str, str]) -> DataFrame:
    """The columns of (.., fl_text) but the text, with fl_lang and fl_score."""

    parser = Parser(samples)  # laid out once and sent along

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = parser.predict(batch.columns[-1].to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names[:-1], "fl_lang", "fl_score"])

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(common.tidy(run), f"{kind}, fl_lang string, fl_score double")


def held_out() -> Column:
    """The third of the documents that training does not see. A null doc_id
    is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def language_id(docs: DataFrame, *, carry: list[str] | None = None, docs_a_lang: int = 64, chars: int = 400) -> DataFrame:
    """Trains on the labelled documents that are not held out and predicts all:
    the ``carry`` columns (doc_id if not given), fl_held_out, fl_lang,
    fl_score."""
    carry = ["doc_id"] if carry is None else carry
    samples = sample(docs, ~held_out(), docs_a_lang=docs_a_lang, chars=chars)
    rows = docs.select(common.carried(carry), held_out().alias("fl_held_out"), F.col("text").cast("string").alias("fl_text"))
    return _predicted(rows, samples).select(*common.spread(carry, ["fl_held_out", "fl_lang", "fl_score"]))
