"""Masked pseudo-likelihood scores from a bidirectional window network.

Words map to ``SYMBOLS`` symbols: the ``TOP`` most frequent of 2^16 hash slots,
counted over all documents, have their own; other slots share the rest by hash;
symbol 0 stands beyond the ends of a text.  The network predicts each word from
``SIDE`` symbols on both of its sides: a tanh layer over one table per place, then
the symbol's class (32 of them) and the symbol within its class.  The word within its
symbol follows from a table of all words' counts, which grows with the corpus and
stays in Spark: p(word | symbol) is the word's share of its symbol's occurrences.
A document's score is the sum of the conditional log-probabilities of its words.

Every task has the counts of the most frequent words (at most ``OFTEN``, whatever the
corpus size) and adds their share itself.  Tasks write their texts' scores and the
numbers of all other words in chunks of bounded size, each with the list of its
distinct other words; these lists, not the texts, are joined to the counts, and what is
found returns to the chunk.

Training covers every word of every document: a task trains on all positions of its
own texts (``every`` thins them out), from the same start; the tasks' parameters are averaged by positions in a tree of shuffles.  What is
gathered (counts and parameters per task) grows with the input; the driver holds
one network of fixed size.

Defined results: a null or empty text has 0 words, sum 0 and a null mean; without
any word in the corpus, the network stays at its start; a word that the table of
counts does not hold counts as half an occurrence; words are told apart by 64-bit
hashes; repeated rows train and
score as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sacctlens.llm.common import materialize
from sacctlens.llm.textkit import buffers, mix, record, span_hashes, steps, word_spans

SLOTS = 1 << 16
SYMBOLS = 1024
TOP = 511
CLASSES = 32
SIDE = 2
HIDDEN = 32
TRAIN_EVERY = 1
BATCH = 2048
RATE = 0.1
SEED = 11
#: Pieces that a network is cut into on its way through the shuffles.
CHUNKS = 64
LOTS = 64
#: Text of one chunk of scores: few enough words for two bytes each.
CHUNK_BYTES = 2 << 20
#: Words whose counts are sent to every task (16 bytes each); all others meet theirs in a join.
OFTEN = 1 << 16
_PLACES = [-k for k in range(SIDE, 0, -1)] + list(range(1, SIDE + 1))


def hashes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the rows' word offsets."""
    buf, offs = buffers(texts)
    starts, ends, rows = word_spans(buf, offs)
    return span_hashes(buf, starts, ends), rows


def slot_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64)


def slots_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash slots of all words, and the rows' word offsets."""
    hashes, rows = hashes_of(texts)
    return slot_of(hashes), rows


def padded(slots: np.ndarray, rows: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols with SIDE zeros around each row, and the place of each word."""
    n = np.diff(rows)
    at = np.arange(len(slots)) + SIDE * (2 * np.repeat(np.arange(len(n)), n) + 1)
    out = np.zeros(len(slots) + 2 * SIDE * len(n), np.int64)
    out[at] = symbol[slots]
    return out, at


def symbol_table(counts: np.ndarray) -> np.ndarray:
    """Symbol of each slot; the frequent ones in order of frequency."""
    table = TOP + 1 + (mix(np.arange(SLOTS, dtype=np.uint64)) % np.uint64(SYMBOLS - TOP - 1)).astype(np.int64)
    order = np.lexsort((np.arange(SLOTS), -counts))[:TOP]
    order = order[counts[order] > 0]
    table[order] = 1 + np.arange(len(order))
    return table


def count_slots(texts: DataFrame) -> np.ndarray:
    """Occurrences of each slot over all documents."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for lo, hi in steps(batch):
                total += np.bincount(slots_of(batch.column("text").slice(lo, hi - lo))[0], minlength=SLOTS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["slot", "n"])

    out = np.zeros(SLOTS, np.int64)
    for r in texts.mapInArrow(counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        out[r.slot] = r.n
    return out


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word (its hash), n: occurrences of every word over all documents, as a written table."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in steps(batch):
                words, n = np.unique(hashes_of(batch.column("text").slice(lo, hi - lo))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    texts = docs.select(F.col(text_col).alias("text")).filter("text is not null")
    return materialize(texts.mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))


def slot_counts(words: DataFrame) -> np.ndarray:
    """Occurrences of each slot, from the table of words."""
    out = np.zeros(SLOTS, np.int64)
    for r in words.groupBy(F.shiftrightunsigned("word", 48).alias("slot")).agg(F.sum("n").alias("n")).collect():
        out[r.slot] = r.n
    return out


def frequent_words(words: DataFrame, most: int = OFTEN) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` of the most frequent words (sorted hashes), and their counts.

    All words from some count on, a 16th of a power of two: no task ranks them.
    """
    step = F.floor(F.log2("n") * 16)
    total, least = 0, None
    for r in sorted(words.groupBy(step.alias("step")).count().collect(), key=lambda r: -r.step):
        total += r["count"]
        if total > most:
            break
        least = r.step
    got = words.filter(step >= least).select("word", "n").collect() if least is not None else []
    hashes, n = np.array([r.word for r in got], np.int64).view(np.uint64), np.array([r.n for r in got], np.int64)
    order = np.argsort(hashes)
    return hashes[order], n[order]


def _softmax(z: np.ndarray) -> np.ndarray:
    """Of each column, in place."""
    z -= z.max(axis=0)
    z = np.exp(z, out=z)
    z /= z.sum(axis=0)
    return z


class Network:
    """tables[place, symbol], bias, class weights, weights within each class."""

    SHAPES = ((2 * SIDE, SYMBOLS, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,),
              (CLASSES, HIDDEN, SYMBOLS // CLASSES), (CLASSES, SYMBOLS // CLASSES))

    def __init__(self, flat: np.ndarray):
        self.flat = flat.astype(np.float32)
        self.parts, at = [], 0
        for shape in self.SHAPES:
            size = int(np.prod(shape))
            self.parts.append(self.flat[at:at + size].reshape(shape))
            at += size

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.SHAPES)

    @classmethod
    def start(cls, symbol_counts: np.ndarray) -> "Network":
        """Small random tables; the output biases hold the log frequencies."""
        rng = np.random.default_rng(SEED)
        net = cls(np.zeros(cls.size(), np.float32))
        for i, scale in ((0, 0.1), (2, 0.1), (4, 0.1)):
            net.parts[i][...] = rng.normal(0, scale, cls.SHAPES[i])
        freq = (symbol_counts + 0.5).reshape(CLASSES, -1)
        net.parts[3][...] = np.log(freq.sum(axis=1) / freq.sum())
        net.parts[5][...] = np.log(freq / freq.sum(axis=1, keepdims=True))
        return net

    def hidden(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = self.parts[0][0].take(symbols[at + _PLACES[0]], axis=0)
        total += self.parts[1]
        for k, place in enumerate(_PLACES[1:], 1):
            total += self.parts[0][k].take(symbols[at + place], axis=0)
        return np.tanh(total, out=total)

    def outputs(self, h: np.ndarray, edge: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of rows sorted by class (those of class k from ``edge[k]`` on): what the softmax over the
        classes, and that within the row's class, are taken of; a column for each row."""
        _, _, w, b, v, c = self.parts
        within = np.empty((SYMBOLS // CLASSES, len(h)), np.float32)
        for k in np.flatnonzero(np.diff(edge)):
            np.matmul(v[k].T, h[edge[k]:edge[k + 1]].T, out=within[:, edge[k]:edge[k + 1]])
        within += c.T.take(cls, axis=1)
        return w.T @ h.T + b[:, None], within

    def log_probabilities(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Conditional log-probability of the symbol at each place, given both sides."""
        width, out = SYMBOLS // CLASSES, np.empty(len(at), np.float64)
        for lo in range(0, len(at), 4096):
            here = at[lo:lo + 4096]
            order, edge = _by_class(symbols[here])
            here = here[order]
            target, total = symbols[here], 0.0
            cls = target // width
            for z, own in zip(self.outputs(self.hidden(symbols, here), edge, cls), (cls, target % width)):
                z -= z.max(axis=0)
                total = total + z[own, np.arange(len(here))] - np.log(np.exp(z, out=z).sum(axis=0))
            out[lo + order] = total
        return out


def _by_class(target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of symbols by class, and where each class begins (CLASSES + 1)."""
    cls = (target // (SYMBOLS // CLASSES)).astype(np.uint16)
    return np.argsort(cls, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(cls, minlength=CLASSES))))


def _summed(rows: np.ndarray, keys: np.ndarray, at_once: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, and the sums of their rows; row i % len(rows) is that of key i."""
    order = np.argsort(keys, kind="stable")
    keys, order = keys[order], order % len(rows)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    count = np.diff(first, append=len(keys))
    # Frequent keys by themselves; the first, second ... rows of all others together, those with more rows first.
    rank = np.argsort(-np.minimum(count, at_once + 1), kind="stable")
    first, count = first[rank], count[rank]
    total = rows[order[first]]
    long = int((count > at_once).sum())
    if long:
        end = np.cumsum(count[:long])
        at = np.arange(end[-1]) + np.repeat(first[:long] - end + count[:long], count[:long])
        total[:long] = np.add.reduceat(rows[order[at]], end - count[:long], axis=0)
    for k in range(1, at_once):
        more = int((count > k).sum())
        total[long:more] += rows[order[first[long:more] + k]]
    return keys[first], total


class Trainer:
    """Adagrad on one task's positions."""

    def __init__(self, net: Network):
        self.net, self.g = net, [np.full(s, 1e-4, np.float32) for s in net.SHAPES]
        self.positions = 0

    def _move(self, part: int, index, grad: np.ndarray) -> None:
        g = self.g[part][index]
        g += grad * grad
        self.g[part][index] = g
        self.net.parts[part][index] -= RATE * grad / np.sqrt(g)

    def learn(self, symbols: np.ndarray, at: np.ndarray) -> None:
        _, _, w, _, v, _ = self.net.parts
        width = SYMBOLS // CLASSES
        for lo in range(0, len(at), BATCH):
            here = at[lo:lo + BATCH]
            n = len(here)
            order, edge = _by_class(symbols[here])
            here = here[order]
            target = symbols[here]
            cls = target // width
            h = self.net.hidden(symbols, here)
            d, e = (_softmax(z) for z in self.net.outputs(h, edge, cls))
            d[cls, np.arange(n)] -= 1
            e[target % width, np.arange(n)] -= 1
            d /= n
            e /= n
            back = (w @ d).T
            of_v, of_c = np.zeros_like(v), np.zeros((CLASSES, width), np.float32)
            seen = np.flatnonzero(np.diff(edge))
            of_c[seen] = np.add.reduceat(e, edge[seen], axis=1).T
            for k in seen:
                mine = slice(edge[k], edge[k + 1])
                back[mine] += (v[k] @ e[:, mine]).T
                np.matmul(h[mine].T, e[:, mine].T, out=of_v[k])
            back = np.ascontiguousarray(back)
            back *= 1 - h * h
            moves = [(2, ..., h.T @ d.T), (3, ..., d.sum(axis=1)), (4, ..., of_v), (5, ..., of_c), (1, ..., back.sum(axis=0))]
            keys, total = _summed(back, np.concatenate([symbols[here + place] + k * SYMBOLS for k, place in enumerate(_PLACES)]).astype(np.uint16))
            moves.append((0, (keys // SYMBOLS, keys % SYMBOLS), total))
            for part, index, grad in moves:
                self._move(part, index, grad)
            self.positions += n


def _average(table: pa.Table) -> tuple[float, np.ndarray]:
    """Positions and the weighted sum of the pieces of one group."""
    total, n = 0.0, 0.0
    for weight, piece in zip(table.column("n").to_pylist(), table.column("piece")):
        total = total + np.frombuffer(piece.as_py(), "<f8")
        n += weight
    return n, total


def train(texts: DataFrame, symbol: np.ndarray, start: Network, every: int = TRAIN_EVERY) -> Network:
    flat = start.flat.copy()

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(Network(flat.copy()))
        for batch in batches:
            for lo, hi in steps(batch):
                slots, rows = slots_of(batch.column("text").slice(lo, hi - lo))
                symbols, at = padded(slots, rows, symbol)
                n = np.diff(rows)
                place = np.arange(len(slots)) - np.repeat(rows[:-1], n) + np.repeat(np.arange(len(n)), n)
                trainer.learn(symbols, at[place % every == 0])
        if trainer.positions:
            pieces = np.array_split(trainer.net.flat.astype("<f8") * trainer.positions, CHUNKS)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(CHUNKS), pa.int32()), pa.array(np.full(CHUNKS, TaskContext.get().partitionId()), pa.int64()),
                pa.array(np.full(CHUNKS, trainer.positions, np.float64)), pa.array([p.tobytes() for p in pieces], pa.binary())],
                names=["chunk", "task", "n", "piece"])

    def add(table: pa.Table) -> pa.Table:
        n, total = _average(table.sort_by("task"))
        return pa.table({"chunk": pa.array([table.column("chunk")[0].as_py()], pa.int32()), "task": pa.array([table.column("task")[0].as_py()], pa.int64()),
                         "n": pa.array([n]), "piece": pa.array([total.tobytes()], pa.binary())})

    shape = "chunk int, task long, n double, piece binary"
    sent = materialize(texts.mapInArrow(local, shape))
    lots = sent.groupBy("chunk", F.pmod("task", F.lit(LOTS)).alias("lot")).applyInArrow(lambda key, t: add(t), shape)
    got = sorted(lots.groupBy("chunk").applyInArrow(add, shape).collect(), key=lambda r: r.chunk)
    if not got:
        return start
    return Network(np.concatenate([np.frombuffer(r.piece, "<f8") / r.n for r in got]))


def fit(docs: DataFrame, text_col: str = "text", every: int = TRAIN_EVERY, words: DataFrame | None = None) -> tuple[np.ndarray, Network]:
    """Symbol table and network, from all documents; ``words`` are their counts, if at hand."""
    texts = docs.select(F.col(text_col).alias("text")).filter("text is not null")
    counts = count_slots(texts) if words is None else slot_counts(words)
    symbol = symbol_table(counts)
    start = Network.start(np.bincount(symbol, weights=counts, minlength=SYMBOLS))
    return symbol, train(texts, symbol, start, every)


def score(docs: DataFrame, symbol: np.ndarray, net: Network, id_col: str = "doc_id", text_col: str = "text", words: DataFrame | None = None,
          often: int = OFTEN) -> DataFrame:
    """doc_id, n_words, log_likelihood, mean_log_likelihood of every document.

    Without ``words``, the likelihood is that of the symbols only.  ``often`` bounds
    the words whose counts every task gets; the result is the same for any.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = _symbol_scores(texts, symbol, net) if words is None else _word_scores(texts, symbol, net, words, often)
    return out.withColumn("mean_log_likelihood", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def _word_scores(texts: DataFrame, symbol: np.ndarray, net: Network, words: DataFrame, often: int) -> DataFrame:
    flat = net.flat
    occurrences = np.bincount(symbol, weights=slot_counts(words), minlength=SYMBOLS)
    frequent, times = frequent_words(words, often)

    def share(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.log(np.maximum(n, 0.5)) - np.log(np.maximum(occurrences[symbol[slot_of(hashes)]], 0.5))

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, number = Network(flat), TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi in steps(batch, most=CHUNK_BYTES):
                part = batch.slice(lo, hi - lo)
                hashes, rows = hashes_of(part.column("text"))
                distinct, at = np.unique(hashes, return_inverse=True)
                place = np.searchsorted(frequent, distinct)
                known = np.append(frequent, np.uint64(0))[place] == distinct
                known &= place < len(frequent)
                within = np.zeros(len(distinct))
                within[known] = share(distinct[known], times[place[known]])
                total = network.log_probabilities(*padded(slot_of(hashes), rows, symbol)) + within[at]
                total = np.concatenate(([0.0], np.cumsum(total)))
                rare, left = distinct[~known], ~known[at]
                of = np.repeat(np.arange(len(part)), np.diff(rows))[left]
                # A sum needs no order: sorted within each text, the differences are small.
                at = np.sort(of << 32 | (np.cumsum(~known) - 1)[at[left]]).astype("<u2" if len(rare) <= 1 << 16 else "<u4")
                at = np.diff(at, prepend=at.dtype.type(0)).view(np.uint8).reshape(len(at), at.itemsize).T
                yield pa.RecordBatch.from_arrays([
                    pa.array([number]), pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([np.diff(rows).tolist()], pa.list_(pa.int64())),
                    pa.array([np.bincount(of, minlength=len(part)).tolist()], pa.list_(pa.int64())),
                    pa.array([(total[rows[1:]] - total[rows[:-1]]).tolist()], pa.list_(pa.float64())),
                    pa.array([rare.view(np.int64)], pa.list_(pa.int64())), pa.array([zlib.compress(at.tobytes(), 1)], pa.binary())],
                    names=["chunk", "doc_ids", "n_words", "n_rare", "scores", "words", "at"])
                number += 1

    def ended(chunks: pa.Table, found: pa.Table) -> pa.Table:
        ids, n_words, n_rare, scores = (chunks.column(c).combine_chunks().flatten() for c in ("doc_ids", "n_words", "n_rare", "scores"))
        hashes = chunks.column("words").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        n = np.zeros(len(hashes))
        n[found.column("k").to_numpy()] = found.column("n").to_numpy()
        within = share(hashes, n)
        kind = np.dtype("<u2" if len(hashes) <= 1 << 16 else "<u4")
        planes = np.frombuffer(zlib.decompress(chunks.column("at")[0].as_py()), np.uint8).reshape(kind.itemsize, -1)
        at = np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)
        rows = np.concatenate(([0], np.cumsum(n_rare.to_numpy())))
        total = np.concatenate(([0.0], np.cumsum(within[at])))
        return pa.table({"doc_id": ids, "n_words": n_words, "log_likelihood": pa.array(scores.to_numpy() + total[rows[1:]] - total[rows[:-1]])})

    sent = materialize(texts.mapInArrow(begun, "chunk long, doc_ids array<long>, n_words array<long>, n_rare array<long>, scores array<double>, words array<long>, at binary"))
    found = sent.select(F.col("chunk").alias("of"), F.posexplode("words").alias("k", "word")).join(words.hint("merge"), "word").select("of", "k", "n")
    return sent.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(ended, "doc_id long, n_words long, log_likelihood double")


def _symbol_scores(texts: DataFrame, symbol: np.ndarray, net: Network) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("log_likelihood", pa.float64())])
    flat = net.flat

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(flat)
        for batch in batches:
            for lo, hi in steps(batch):
                part = batch.slice(lo, hi - lo)
                slots, rows = slots_of(part.column("text"))
                total = np.concatenate(([0.0], np.cumsum(network.log_probabilities(*padded(slots, rows, symbol)))))
                yield record(schema, doc_id=part.column("doc_id"), n_words=np.diff(rows), log_likelihood=total[rows[1:]] - total[rows[:-1]])

    return texts.mapInArrow(scored, "doc_id long, n_words long, log_likelihood double")
