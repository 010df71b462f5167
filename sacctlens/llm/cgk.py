"""Benchmark decontamination with CGK embeddings and bit-sampling LSH.

Texts are reduced to words: letters lower-cased, ASCII punctuation taken as space, each
character of a script without spaces (Han, kana, Thai, Lao, Khmer, Burmese) a word of
its own.  The CGK embedding of a word string walks along it: step t writes the word at
the current place and moves on if a random bit of (t, word) is 1.  Two strings with few
edits fall back into step, so their embeddings are close in Hamming distance.

A walk that has met many edits is out of step for long, so an item is embedded from
several of its words on, at most about ``STARTS`` of them: a damaged copy is met if
one of its stretches is met.  Documents are embedded from every word on.  Each of
``ROUNDS`` rounds draws new walks and samples ``SAMPLED`` of their steps, 2 to ``REACH``
apart; places of a document that agree with a start of an item in all of them are
candidates (a place leaves the walk at the first sampled step that no start shares; a
start whose samples are not different words takes no part in the round).  Candidates
whose embeddings differ in more than ``FAR`` of ``STEPS`` steps, or whose next
``MIN_WORDS`` words differ in more than ``PIECE_EDITS`` of their characters, are dropped.
The rest place the whole item, which is verified by its exact edit distance to any
stretch of the document's characters around that place: a leak has at most ``MAX_EDITS``
of the item's length.  The recall that all this reaches is measured in the tests.

Items of fewer than ``MIN_WORDS`` words are matched exactly: their words one after
another, or, below ``LONE_WORDS`` words, as the whole text; fewer words turn up anywhere.

The benchmark reaches the tasks in groups of at most ``GROUP_BYTES`` of text, one
pass over the documents for each, so what is broadcast is bounded.

Defined results: null and empty texts and texts without words match nothing, on either
side; equal items each give their row; a document counts once per item, at its closest
place (ties: the first); ``first_word`` is where that place has the item begin; rows
equal in all columns give equal rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sacctlens.llm.textkit import SMALL_STEP, buffers, lean, mix, span_hashes, steps, word_spans

MIN_WORDS = 8
LONE_WORDS = 3
MAX_EDITS = 0.2
ROUNDS = 16
SAMPLED = 3
REACH = 4
STEPS = 16
STARTS = 16
#: The words that follow a start differ in at most this share of their characters.
PIECE_EDITS = 0.3
#: Embeddings of related strings differ in at most this share of the steps.
FAR = 0.75
GROUP_BYTES = 2 << 20
_PAD = np.uint64(0x5BD1E995A3C59AC3)
_ONE = np.uint64(1)

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 0x20
# First bytes of the characters of scripts without spaces.
_DENSE_LEAD = np.zeros(256, bool)
_DENSE_LEAD[[0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0]] = True
_DENSE = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
_SPLIT = re.compile(" (?=[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def walk(place: np.ndarray, bits: np.ndarray, t: int, to: int) -> np.ndarray:
    """Places at step ``to`` of walks that are at ``place`` at step ``t``."""
    for step in range(t, to):
        place = place + ((bits[place] >> np.uint64(step % 64)) & _ONE).view(np.int64)
    return place


def padded_words(texts: pa.Array, pad: int):
    """Word hashes with ``pad`` blanks after each row; word spans; row offsets in words
    and in the padded array; the plain bytes."""
    texts = pc.utf8_lower(texts.cast(pa.large_string()))
    buf, offs = buffers(texts)
    if _DENSE_LEAD[buf].any():
        buf, offs = buffers(pc.replace_substring_regex(texts, f"({_DENSE})", r" \1 "))
    buf = _PLAIN[buf]
    starts, ends, rows = word_spans(buf, offs)
    n = np.diff(rows)
    at = rows + pad * np.arange(len(rows))
    words = np.full(at[-1], _PAD, np.uint64)
    words[np.arange(len(starts)) + pad * np.repeat(np.arange(len(n)), n)] = span_hashes(buf, starts, ends)
    return words, starts, ends, rows, at, buf


def plain_text(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """Words joined by one space, none before characters of scripts without spaces."""
    return _SPLIT.sub("", b" ".join(buf[a:b].tobytes() for a, b in zip(starts, ends)).decode("utf-8", "replace"))


def sequence_keys(words: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    key = np.zeros(len(begins), np.uint64)
    for i in range(n):
        key = mix(key ^ words[begins + i])
    return key


class Index:
    """The items of one group, ready for matching."""

    def __init__(self, items: list[tuple[int, str]], rounds: int = ROUNDS, sampled: int = SAMPLED):
        self.pad = 2 * STEPS
        self.words, starts, ends, rows, at, buf = padded_words(pa.array([text or "" for _, text in items], pa.string()), self.pad)
        self.starts, self.ends, self.rows, self.buf = starts, ends, rows, buf
        self.ids, self.lengths = [i for i, _ in items], np.diff(rows)
        self.plain = [plain_text(buf, starts[a:b], ends[a:b]) for a, b in zip(rows, rows[1:])]
        self.peq: dict[int, dict[str, int]] = {}
        self.pieces: dict[int, tuple[str, dict[str, int]]] = {}
        begin, owner, offset, self.short = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], {}
        for m, n in enumerate(self.lengths.tolist()):
            if n >= MIN_WORDS:
                offs = np.arange(0, n - SAMPLED + 1, max(1, n // STARTS))
                begin.append(at[m] + offs)
                owner.append(np.full(len(offs), m))
                offset.append(offs)
            elif n:
                key = int(sequence_keys(self.words, at[m:m + 1], n)[0])
                self.short.setdefault(n, {}).setdefault(key, []).append(m)
        self.begin, self.owner, self.offset = (np.concatenate(x) for x in (begin, owner, offset))
        self.rounds = []
        for r in range(rounds if len(self.begin) else 0):
            rng = np.random.default_rng([r, sampled])
            at_steps = np.cumsum([rng.integers(0, 3), *rng.integers(2, REACH + 1, sampled - 1)]).tolist()
            bits, place, key, t, seen, chain = self.bits(self.words, r), self.begin, np.zeros(len(self.begin), np.uint64), 0, [], []
            for step in at_steps:
                place, t = walk(place, bits, t, step), step
                seen.append(self.words[place])
                key = mix(key ^ seen[-1])
                chain.append(key)
            sampled_words = np.sort(np.stack(seen), axis=0)
            use = np.flatnonzero((sampled_words[1:] != sampled_words[:-1]).all(axis=0) & (sampled_words != _PAD).all(axis=0))
            levels = []
            for key in chain:
                level = np.zeros(1 << 18, bool)
                level[(key[use] >> np.uint64(46)).astype(np.int64)] = True
                levels.append(np.packbits(level))
            key = key[use]
            order = np.argsort(key, kind="stable")
            self.rounds.append((r, at_steps, levels, key[order], use[order].astype(np.int32)))

    @staticmethod
    def bits(words: np.ndarray, r: int) -> np.ndarray:
        return mix(words ^ np.uint64(0x9E37 + 0x51ED27 * (r + 1)))

    def candidates(self, words: np.ndarray, starts: np.ndarray) -> dict[tuple[int, int], int]:
        """(place, start of an item) pairs that agree in a round and whose embeddings are near, with their distance."""
        found: dict[tuple[int, int], int] = {}
        for r, at_steps, levels, final, order in self.rounds:
            bits, own = self.bits(words, r), None
            begin, place, t = starts, starts, 0
            key = np.zeros(len(begin), np.uint64)
            for level, step in zip(levels, at_steps):
                place, t = walk(place, bits, t, step), step
                key = mix(key ^ words[place])
                live = np.unpackbits(level).view(bool)[(key >> np.uint64(46)).astype(np.int64)]
                begin, place, key = begin[live], place[live], key[live]
            lo = np.searchsorted(final, key)
            n = np.searchsorted(final, key, side="right") - lo
            hit = n > 0
            begin, lo, n = begin[hit], lo[hit], n[hit]
            for some in np.array_split(np.arange(len(begin)), 1 + int(n.sum()) // (1 << 16)):
                b, k, c = begin[some], lo[some], n[some]
                part = order[np.repeat(k - np.cumsum(c) + c, c) + np.arange(c.sum())]
                b = np.repeat(b, c)
                if own is None:
                    own = self.bits(self.words, r)
                p, q, apart, met = b, self.begin[part], np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
                for step in range(STEPS):       # up to the item's end
                    inside = self.words[q] != _PAD
                    met += inside
                    apart += inside & (words[p] != self.words[q])
                    p, q = walk(p, bits, step, step + 1), walk(q, own, step, step + 1)
                near = apart <= FAR * met
                for one, d in zip(zip(b[near].tolist(), part[near].tolist()), apart[near].tolist()):
                    found[one] = min(d, found.get(one, d))
        return found

    def leaks(self, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(row, item_id, distance, item length, first word) of each leak, closest place per row and item."""
        words, starts, ends, rows, at, buf = padded_words(texts, self.pad)
        n = np.diff(rows)
        begins = np.arange(len(starts)) + self.pad * np.repeat(np.arange(len(n)), n)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for size, members in self.short.items():
            keys = sequence_keys(words, begins, size)
            for k in np.flatnonzero(np.isin(keys, np.fromiter(members, np.uint64, len(members)))).tolist():
                row = int(np.searchsorted(at, begins[k], side="right")) - 1
                text = plain_text(buf, starts[k:k + size], ends[k:k + size])
                for m in members[int(keys[k])]:
                    if text == self.plain[m] and (size >= LONE_WORDS or n[row] == size):
                        best.setdefault((row, m), (0, int(begins[k] - at[row])))
        done: dict[tuple[int, int], list[int]] = {}
        # Nearest first: what lies inside a stretch that was looked at needs no second look.
        for (begin, part), _ in sorted(self.candidates(words, begins).items(), key=lambda x: (x[1], x[0])):
            row, m = int(np.searchsorted(at, begin, side="right")) - 1, int(self.owner[part])
            first, length = begin - int(at[row]) - int(self.offset[part]), int(self.lengths[m])
            slack = length // 4 + 1
            if any(abs(first - x) <= slack // 2 for x in done.get((row, m), ())):
                continue
            if part not in self.pieces:
                k, to = int(self.offset[part]), min(length, int(self.offset[part]) + MIN_WORDS)
                piece = plain_text(self.buf, self.starts[self.rows[m] + k:self.rows[m] + to], self.ends[self.rows[m] + k:self.rows[m] + to])
                self.pieces[part] = (piece, masks(piece))
            piece, peq = self.pieces[part]
            here = int(rows[row]) + begin - int(at[row])
            to = min(int(rows[row + 1]), here + MIN_WORDS + MIN_WORDS // 4)
            if closest(piece, peq, plain_text(buf, starts[here:to], ends[here:to])) > PIECE_EDITS * len(piece):
                continue
            done.setdefault((row, m), []).append(first)
            wide = slack + slack // 2
            lo, hi = int(rows[row]) + max(0, first - wide), int(rows[row]) + min(int(n[row]), first + length + wide)
            pattern, text = self.plain[m], plain_text(buf, starts[lo:hi], ends[lo:hi])
            edits = int(MAX_EDITS * len(pattern))
            if m not in self.peq:
                self.peq[m] = masks(pattern)
            distance = closest(pattern, self.peq[m], text)
            if distance <= edits and ((row, m) not in best or (distance, max(0, first)) < best[row, m]):
                best[row, m] = (distance, max(0, first))
        return [(row, self.ids[m], d, len(self.plain[m]), first) for (row, m), (d, first) in sorted(best.items())]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def closest(pattern: str, peq: dict[str, int], text: str) -> int:
    """Smallest edit distance of the pattern to any stretch of the text, by bit vectors."""
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = m
    for c in text:
        eq = peq.get(c, 0)
        vertical = eq | minus
        diagonal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
        best = min(best, score)
    return best


def groups(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The items in lists of about GROUP_BYTES of text."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // GROUP_BYTES))
    for g in range(n):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == g) if n > 1 else items
        yield [(r.item_id, r.text) for r in mine.orderBy("item_id", "text").collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", **options) -> DataFrame:
    """doc_id, item_id, distance, item_chars, first_word: the items each document holds."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("text is not null")
    out = None
    for items in groups(benchmark, item_col, item_text_col):
        index = Index(items, **options)

        @lean
        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi in steps(batch, most=SMALL_STEP):
                    part = batch.slice(lo, hi - lo)
                    got = index.leaks(part.column("text"))
                    cols = list(zip(*got)) if got else [[]] * 5
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                         pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int32())], names=["doc_id", "item_id", "distance", "item_chars", "first_word"])

        found = rows.mapInArrow(search, "doc_id long, item_id long, distance int, item_chars int, first_word int")
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns, without those that hold an item."""
    for items in groups(benchmark, item_col, item_text_col):
        index = Index(items, **options)

        @lean
        def keep(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi in steps(batch, text_col, SMALL_STEP):
                    part = batch.slice(lo, hi - lo)
                    bad = {row for row, *_ in index.leaks(part.column(text_col))}
                    yield part.filter(pa.array([i not in bad for i in range(len(part))], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
