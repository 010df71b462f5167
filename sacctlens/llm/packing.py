"""Packing of tokenized documents into fixed-length sequences, in order, by dynamic programming.

Each task turns its documents, in their order, into one stream of token ids (every
document closed by ``end_id``) and cuts it into sequences of at most ``length``
tokens.  Cuts fall at document ends (free), sentence ends (``SENTENCE_CUT``), or, in
stretches of over ``GRAIN`` tokens without either, every ``GRAIN`` tokens
(``HARD_CUT``); each missing token of a sequence costs 1.  With cost(j) the least cost
of a cut at position p(j),

    cost(j) + p(j) = penalty(j) + length + min over p(i) >= p(j) - length of cost(i) + p(i),

a sliding minimum, which a monotone queue gives in O(1) per position.  The program runs
over lots of ``LOT`` tokens: the cheapest cut within a lot's last sequence length is
kept, and what follows it opens the next lot.  What remains at a task's end is cut
into sequences whose lengths are powers of two, which need no padding.

The tokenizer sees every distinct word of a task once (words split at ASCII white
space, trailing ASCII punctuation apart, A-Z lowered where the tokenizer lowers
anyway); ids of whole texts are put together from these with numpy.  A task remembers
at most ``KNOWN`` words and then starts afresh.  Nothing is shuffled, and no task holds
more than a lot and one document.

Defined results: a null or empty text is ``end_id`` alone; rows without an id, and
repeated rows, are documents of their own; sequence ids are unique (task number and
running number) and depend on the input's partitions only; other columns are ignored.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sacctlens.llm.textkit import buffers, span_hashes, steps, word_spans

LENGTH = 4096
END_ID = 2
SENTENCE_CUT = 4
HARD_CUT = 16
GRAIN = 32
LOT = 1 << 19
KNOWN = 1 << 20
#: New words that go through the tokenizer as one text.
JOINED = 256
STEP_BYTES = 2 << 20

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_TRAILING = np.zeros(256, bool)
_TRAILING[[ord(c) for c in ".,;:!?"]] = True


def lowered(buf: np.ndarray) -> np.ndarray:
    """A-Z as a-z, except before a byte beyond ASCII, which might compose with the letter."""
    if b"<|" in buf.tobytes():                  # special tokens are told apart by case
        return buf
    up = (buf >= 0x41) & (buf <= 0x5A)
    up[:-1] &= buf[1:] < 0x80
    return buf + (up.astype(np.uint8) << 5)


def parts(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of words without trailing punctuation and of that punctuation, and the rows' offsets into them.

    Only punctuation after an ASCII letter is split off: there every tokenizer run ends.
    """
    starts, ends, word_offs = word_spans(buf, offs)
    if not len(starts):
        return starts, ends, word_offs
    # The last byte of each word that is no trailing punctuation.
    other = np.where(_TRAILING[buf], -1, np.arange(len(buf)))
    last = np.maximum.accumulate(other)[ends - 1]
    split = (last >= starts) & (last < ends - 1)
    split[split] = _LETTER[buf[last[split]]]
    cut = last[split] + 1
    where = np.flatnonzero(split)
    n = np.ones(len(starts), np.int64)
    n[where] = 2
    first = np.cumsum(n) - n
    a, b = np.empty(int(n.sum()), np.int64), np.empty(int(n.sum()), np.int64)
    a[first], b[first] = starts, ends
    b[first[where]] = cut
    a[first[where] + 1], b[first[where] + 1] = cut, ends[where]
    return a, b, np.append(first, len(a))[word_offs]


class WordIds:
    """Token ids of the words seen so far: two hashes a word, and the ids in one pool."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task is one core's work
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.ends_word = word_ends(self.tokenizer)
        self.forget()

    def forget(self) -> None:
        self.h1, self.h2 = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.at, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each word's place and number of ids, and the ids.

        Words of letters alone go in as one text, with spaces between them, and are told apart by
        the tokens that end a word; where these are not one a word, each word goes in by itself.
        """
        place, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        joined = [k for k, w in enumerate(words) if w.isalpha()] if self.ends_word.any() else []
        alone, pool, at = np.ones(len(words), bool), [], 0
        some = [joined[lo:lo + JOINED] for lo in range(0, len(joined), JOINED)]
        for mine, ids in zip(some, self.encode([" ".join([words[k] for k in mine]) for mine in some])):
            ids = np.array(ids, np.uint32)
            end = np.flatnonzero(self.ends_word[ids]) + 1
            if len(end) == len(mine) and end[-1] == len(ids):
                start = np.concatenate(([0], end[:-1]))
                place[mine], size[mine] = at + start, end - start
                pool.append(ids)
                at += len(ids)
                alone[mine] = False
        alone = np.flatnonzero(alone)
        found = self.encode([words[k] for k in alone.tolist()])
        size[alone] = np.fromiter(map(len, found), np.int64, len(found))
        place[alone] = at + np.cumsum(size[alone]) - size[alone]
        pool.append(np.fromiter((i for ids in found for i in ids), np.uint32, int(size[alone].sum())))
        return place, size, np.concatenate(pool)

    def ids(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows' texts, and the rows' offsets into them."""
        if len(self.h1) > KNOWN:
            self.forget()
        buf = lowered(buf)
        starts, ends, part_offs = parts(buf, offs)
        h1, h2 = span_hashes(buf, starts, ends, 11), span_hashes(buf, starts, ends, 12)
        distinct, first, of = np.unique(h1, return_index=True, return_inverse=True)
        if (h2[first][of] != h2).any():
            return self._whole(buf, offs)
        place = np.searchsorted(self.h1, distinct)
        inside = place < len(self.h1)
        known = inside.copy()
        known[inside] = self.h1[place[inside]] == distinct[inside]
        if (self.h2[place[known]] != h2[first[known]]).any():
            return self._whole(buf, offs)
        new = np.flatnonzero(~known)
        if len(new):
            raw = buf.tobytes()
            at, size, pool = self.of_words([raw[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            self.at = np.insert(self.at, place[new], len(self.pool) + at)
            self.size = np.insert(self.size, place[new], size)
            self.h2 = np.insert(self.h2, place[new], h2[first[new]])
            self.h1 = np.insert(self.h1, place[new], distinct[new])
            self.pool = np.concatenate((self.pool, pool))
            place = np.searchsorted(self.h1, distinct)
        mine = place[of]
        size = self.size[mine]
        edges = np.concatenate(([0], np.cumsum(size)))
        take = np.arange(int(edges[-1])) + np.repeat(self.at[mine] - edges[:-1], size)
        return self.pool[take], edges[part_offs]

    def _whole(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two words share a hash: the texts go through the tokenizer as they are."""
        raw = buf.tobytes()
        found = self.encode([raw[a:b].decode() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())])
        return np.array([i for ids in found for i in ids], np.uint32), np.concatenate(([0], np.cumsum([len(ids) for ids in found]))).astype(np.int64)


def word_ends(tokenizer) -> np.ndarray:
    """Whether the token of each id ends a word; nowhere, if the tokenizer does not mark that."""
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if suffix:
        ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return ends


def sentence_ends(tokenizer) -> np.ndarray:
    """Whether the token of each id ends with a full stop, exclamation or question mark."""
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    for token, i in vocabulary.items():
        ends[i] = token.removesuffix("</w>").endswith((".", "!", "?"))
    return ends


def cut_places(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut, from 0 on, and the penalty of each."""
    is_end = np.zeros(len(ids) + 1, np.int8)
    is_end[np.flatnonzero(ends_sentence[np.minimum(ids, len(ends_sentence) - 1)]) + 1] = 1
    # No sentence end right before the token that closes its document.
    is_end[doc_ends - 1] = 0
    is_end[doc_ends] = 2
    is_end[0] = 2
    at = np.flatnonzero(is_end)
    gap = np.diff(np.append(at, len(ids)))
    more = np.maximum(0, (gap - 1) // GRAIN)
    extra = np.repeat(at, more) + GRAIN * (np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more) + 1)
    places = np.concatenate((at, extra))
    cost = np.concatenate((np.where(is_end[at] == 2, 0, SENTENCE_CUT), np.full(len(extra), HARD_CUT)))
    order = np.argsort(places)
    return places[order], cost[order]


def best_cuts(places: np.ndarray, penalties: np.ndarray, total: int, length: int) -> list[int]:
    """The cheapest chain of cuts from 0 to a place within the last ``length`` of ``total`` tokens."""
    p, pen = places.tolist(), penalties.tolist()
    score, back = [0] * len(p), [0] * len(p)                # score: cost so far plus position
    queue = deque([0])
    for j in range(1, len(p)):
        low = p[j] - length
        while p[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        back[j] = i
        s = score[j] = score[i] + pen[j] + length
        while queue and score[queue[-1]] >= s:
            queue.pop()
        queue.append(j)
    first = int(np.searchsorted(places, max(0, total - length)))
    j = min(range(first, len(p)), key=lambda k: (score[k] - p[k], -p[k]))
    cuts = []
    while j:
        cuts.append(p[j])
        j = back[j]
    return [0, *reversed(cuts)]


class Packer:
    """A task's stream: documents go in, pieces of finished sequences come out."""

    def __init__(self, ends_sentence: np.ndarray, length: int, first_sequence: int):
        self.ends_sentence, self.length, self.next = ends_sentence, length, first_sequence
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []                          # id, tokens in the stream, tokens before these
        self.size = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append((doc_id, len(ids), 0))
        self.size += len(ids)

    def flush(self, last: bool = False) -> pa.RecordBatch:
        stream = np.concatenate([*self.ids, np.zeros(0, np.uint32)])
        tokens = np.array([d[1] for d in self.docs], np.int64)
        edges = np.concatenate(([0], np.cumsum(tokens)))
        places, penalties = cut_places(stream, edges[1:], self.ends_sentence)
        cuts = best_cuts(places, penalties, len(stream), self.length)
        if last:
            rest = len(stream) - cuts[-1]
            for bit in reversed(range(rest.bit_length())):
                if rest >> bit & 1:
                    cuts.append(cuts[-1] + (1 << bit))
        end = cuts[-1]
        cuts = np.array(cuts)
        bounds = np.unique(np.concatenate((cuts, edges[edges < end])))
        a, b = bounds[:-1], bounds[1:]
        doc, sequence = np.searchsorted(edges, a, side="right") - 1, np.searchsorted(cuts, a, side="right") - 1
        before = np.array([d[2] for d in self.docs], np.int64)
        start = a - edges[doc] + before[doc]
        body = pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(stream.astype("<u4"))])
        out = pa.RecordBatch.from_arrays([
            pa.array([self.docs[k][0] for k in doc.tolist()], pa.int64()), pa.array(start), pa.array(b - a), body,
            pa.array((tokens + before)[doc]), pa.array(sequence + self.next), pa.array(a - cuts[sequence])], schema=_SCHEMA)
        self.next += len(cuts) - 1
        k = int(np.searchsorted(edges, end, side="right")) - 1 if end < len(stream) else len(self.docs)
        if k < len(self.docs):
            doc_id, _, gone = self.docs[k]
            self.docs = [(doc_id, int(edges[k + 1] - end), gone + int(end - edges[k])), *self.docs[k + 1:]]
        else:
            self.docs = []
        self.ids = [stream[end:]]
        self.size = len(stream) - int(end)
        return out


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset: one row per piece of a document.

    ``tokenizer`` is the path of a tokenizer file that every executor can open.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = packer = None
        close = np.array([end_id], np.uint32)
        for batch in batches:
            for lo, hi in steps(batch, most=STEP_BYTES):
                if words is None:
                    words = WordIds(tokenizer)
                    packer = Packer(sentence_ends(words.tokenizer), length, TaskContext.get().partitionId() << 40)
                part = batch.slice(lo, hi - lo)
                ids, offs = words.ids(*buffers(part.column("text")))
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), offs[:-1].tolist(), offs[1:].tolist()):
                    packer.add(doc_id, np.concatenate((ids[a:b], close)))
                if packer.size >= LOT:
                    yield packer.flush()
        if packer is not None and packer.size:
            yield packer.flush(last=True)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, PIECES)
