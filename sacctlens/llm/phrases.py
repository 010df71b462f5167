"""Phrase collocations, counted with broadcast double-array tries.

Texts are lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line ends, and
the pieces into words at spaces and tabs.  Everything is per language.

1.  Words are counted (per block in numpy, then summed); words of ``least`` or more
    occurrences get a number.
2.  Texts become runs of these numbers, 0 at a piece's end and for any rarer word,
    which no frequent phrase can hold.  They are written once, many texts a row.
3.  Candidates (Apriori): a pair's words are both frequent; a phrase of three or four
    is proposed where all its pairs are, and goes unless its shorter parts stay.  Tasks
    name what occurs with the number of times; proposals below ``least`` in sum go.
4.  Candidates in lexicographic order are cut into ranges of about ``SHARD`` phrases.
    A task makes each range a double-array trie: a word is spelled with digits of
    ``1 << DIGIT`` values, ``check[base[state] + digit] == state`` is a step.  One trie
    after another is broadcast (its size is bounded by ``SHARD``) and read by all
    tasks: the positions whose word may begin a phrase of the range hold a state each;
    all states advance together, word by word, digit by digit; accepting states are
    bincounted.  The tasks' vectors of counts are added up, ``FAN`` at a time.
5.  Scores, the dropping of parts of longer candidates and the first ``most`` of each
    language are joins and windows over the counts.

The tries of pairs mark the positions where a frequent pair starts; that is where
phrases of three and four are proposed.  A pass costs a task one look at every
position; only the positions of its range go further, so more ranges repeat the
looking, not the walking.  The word numbers themselves reach the tasks in shards of at
most ``WORDS`` words (16 bytes each).  No hot word, language or phrase gathers in one
task: texts are cut by their bytes, sums combine before they shuffle, ranges are even.

Words are told apart by 128 bits of hash (two independent 64-bit hashes) in tasks, and
by their bytes in Spark's sums.

Defined results: a null text is empty, a null language is ``und``; repeated rows count
each; an empty table gives no rows; ids and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sacctlens.llm.common import materialize
from sacctlens.llm.textkit import buffers, mix, span_hashes, steps
from sacctlens.sources.local import local_rows

LEAST = 30
LONGEST = 4
MOST = 2000
#: Phrases of a trie, and words of a dictionary shard, that are broadcast at a time.
SHARD = 1 << 19
WORDS = 1 << 20
DIGIT = 6
STEP_BYTES = 2 << 20
#: Distinct proposals that a task holds before it sends them.
HELD = 1 << 20
#: Counts in one vector that a task sends, and vectors that are added up at a time.
CHUNK = 4096
FAN = 256
#: A longer candidate drops its parts from this share of their count on; scores are per SCALE.
KEPT_SHARE = 80
SALTS = 64
SCALE = 2_000_000

GAP = np.zeros(256, bool)
GAP[[0x20, 0x09]] = True
END = np.zeros(256, bool)
END[[*(ord(c) for c in ".,;:!?"), 0x0A, 0x0B, 0x0C, 0x0D]] = True


def pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of words, their rows, and whether each begins its piece."""
    buf, offs = buffers(texts)
    if not len(buf):
        return (buf, *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, bool))
    buf = buf + ((buf >= 0x41) & (buf <= 0x5A)).astype(np.uint8) * np.uint8(32)
    ends_piece = END[buf]
    solid = ~(GAP[buf] | ends_piece)
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    full = offs[1:] > offs[:-1]
    a, b = offs[:-1][full], offs[1:][full] - 1
    first[a], last[b] = solid[a], solid[b]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offs, starts, side="right") - 1
    piece = np.cumsum(ends_piece, dtype=np.int32 if len(buf) < 1 << 31 else np.int64)[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])
    return buf, starts, ends, row, fresh


def _lang_seeds(langs: list[str]) -> np.ndarray:
    """A 64-bit value per language."""
    buf, offs = buffers(pa.array(langs, pa.string()))
    return span_hashes(buf, offs[:-1], offs[1:], 7)


def word_keys(buf, starts, ends, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each word and the seed of its language."""
    return mix(span_hashes(buf, starts, ends, 21) ^ seeds), mix(span_hashes(buf, starts, ends, 22) + seeds)


def _prepared(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Words of a batch's steps: bytes, starts, ends, language number of each word, beginnings of pieces, languages."""
    for lo, hi in steps(batch, most=STEP_BYTES):
        part = batch.slice(lo, hi - lo)
        coded = part.column("lang").dictionary_encode()
        langs = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy(zero_copy_only=False)
        buf, starts, ends, row, fresh = pieces(part.column("text"))
        yield buf, starts, ends, code[row], fresh, langs


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, word, n: occurrences of every word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for buf, starts, ends, code, _, langs in _blocks(batch):
                if not len(starts):
                    continue
                h1, h2 = word_keys(buf, starts, ends, _lang_seeds(langs)[code])
                order = np.argsort(h1)
                a, b = h1[order], h2[order]
                # Words of equal first hash but other second one part into several rows, which is harmless.
                edge = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
                n = np.diff(np.append(edge, len(order)))
                who = order[edge]
                size = ends[who] - starts[who]
                offs = np.concatenate(([0], np.cumsum(size)))
                at = np.arange(int(offs[-1])) + np.repeat(starts[who] - offs[:-1], size)
                words = pa.LargeStringArray.from_buffers(len(who), pa.py_buffer(offs), pa.py_buffer(buf[at])).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(langs).take(pa.array(code[who])), words, pa.array(n)], names=["lang", "word", "n"])

    return (_prepared(docs, text_col, lang_col).mapInArrow(count, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def numbered(words: DataFrame, shard: int = WORDS) -> DataFrame:
    """lang, word, n, h1, h2, part, place: frequent words in parts of about ``shard``, ordered by hash within them."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            buf, offs = buffers(batch.column("word"))
            seeds = _lang_seeds(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
            h1, h2 = word_keys(buf, offs[:-1], offs[1:], seeds)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))],
                                             names=["lang", "word", "n", "h1", "h2"])

    # Hashes spread evenly, so parts by hash are even; a part's words are numbered within it.
    parts = max(1, -(-words.count() // shard))
    hashed = words.select("lang", "word", "n").mapInArrow(keys, "lang string, word string, n long, h1 long, h2 long")
    ordered = Window.partitionBy("part").orderBy("h1", "h2", "lang", "word")
    return hashed.withColumn("part", F.pmod("h1", F.lit(parts)).cast("int")).withColumn("place", F.row_number().over(ordered) - 1)


def _dictionaries(words: DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per part: the number of its first word, and the sorted hashes."""
    sizes = sorted((r.part, r.n) for r in words.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    first = 1
    for part, n in sizes:
        got = words.filter(F.col("part") == part).select("place", "h1", "h2").toArrow()
        order = np.argsort(got["place"].to_numpy())
        yield part, first, got["h1"].to_numpy()[order].view(np.uint64), got["h2"].to_numpy()[order].view(np.uint64)
        first += n


def with_ids(words: DataFrame) -> DataFrame:
    """The numbered words with their ids, from 1 on: part after part."""
    sizes = words.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    offset = sizes.withColumn("before", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return words.join(offset.select("part", "before"), "part").select((F.col("before") + F.col("place") + 1).cast("int").alias("id"), "lang", "word", "n")


def encode(docs: DataFrame, words: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """runs: binary rows of little-endian 32-bit word numbers, 0 between pieces and for rare words; written as a table.

    One dictionary part after another fills in its numbers; the hashes of the words
    travel along until the last one, when runs of zeros shrink to one.
    """
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for buf, starts, ends, code, fresh, langs in _blocks(batch):
                h1, h2 = word_keys(buf, starts, ends, _lang_seeds(langs)[code])
                # A place of its own before every piece keeps pieces apart.
                at = np.arange(len(h1)) + np.cumsum(fresh)
                keys = np.zeros((2, len(h1) + int(fresh.sum())), np.uint64)
                keys[0, at], keys[1, at] = h1, h2
                yield keys, at

    prepared = _prepared(docs, text_col, lang_col)
    if words.select("part").distinct().count() <= 1:
        # The usual case needs no table of hashes.
        _, first, k1, k2 = next(_dictionaries(words), (0, 1, np.zeros(0, np.uint64), np.zeros(0, np.uint64)))
        held = docs.sparkSession.sparkContext.broadcast((k1, k2))

        def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k1, k2 = held.value
            for keys, at in hashed(batches):
                ids = np.zeros(keys.shape[1], np.int32)
                ids[at] = _look_up(keys[0, at], keys[1, at], k1, k2, first)
                yield from _run_rows(ids)

        out = materialize(prepared.mapInArrow(direct, "runs binary"))
        held.destroy()
        return out

    def to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, _ in hashed(batches):
            if keys.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array([keys[0].tobytes()], pa.binary()), pa.array([keys[1].tobytes()], pa.binary()),
                                                  pa.array([bytes(4 * keys.shape[1])], pa.binary())], names=["k1", "k2", "runs"])

    rows = materialize(prepared.mapInArrow(to_rows, "k1 binary, k2 binary, runs binary"))
    for _, first, k1, k2 in _dictionaries(words):
        held = docs.sparkSession.sparkContext.broadcast((k1, k2))
        rows = materialize(rows.mapInArrow(_filler(held, first), rows.schema))
        held.destroy()

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                yield from _run_rows(np.frombuffer(body.as_buffer(), "<i4"))

    return materialize(rows.select("runs").mapInArrow(shrink, "runs binary"))


def _filler(held, first: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k1, k2 = held.value
        for batch in batches:
            for i in range(batch.num_rows):
                a, b, ids = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in enumerate(("<u8", "<u8", "<i4")))
                ids = np.maximum(ids, _look_up(a, b, k1, k2, first))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([ids.tobytes()], pa.binary())], names=["k1", "k2", "runs"])
    return fill


def _look_up(h1: np.ndarray, h2: np.ndarray, k1: np.ndarray, k2: np.ndarray, first: int) -> np.ndarray:
    """Number of each word in a dictionary part whose hashes are ``k1`` (signed order) and ``k2``; 0 where it has none."""
    out = np.zeros(len(h1), np.int32)
    if not len(k1):
        return out
    signed = k1.view(np.int64)
    distinct, of = np.unique(h1.view(np.int64), return_inverse=True)
    place = np.searchsorted(signed, distinct)
    inside = place < len(k1)
    inside[inside] = signed[place[inside]] == distinct[inside]
    number = np.where(inside, place, -1)[of]
    open_ = np.flatnonzero(number >= 0)
    # Words of one first hash stand side by side; the second tells them apart.
    while len(open_):
        here = k2[number[open_]] == h2[open_]
        out[open_[here]] = number[open_[here]] + first
        open_ = open_[~here]
        number[open_] += 1
        ok = number[open_] < len(k1)
        ok[ok] = k1[number[open_[ok]]] == h1[open_[ok]]
        open_ = open_[ok]
    return out


def _run_rows(ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Numbers with one 0 between runs and no lone words, as one row."""
    live = ids > 0
    padded = np.concatenate(([False], live, [False]))
    kept = live & (padded[:-2] | padded[2:])                 # a word alone begins no phrase
    padded = np.concatenate(([False], kept))
    kept |= padded[:-1] & ~kept                              # the 0 after a run
    out = np.where(live, ids, 0)[kept].astype("<i4")
    if len(out) and out[-1]:
        out = np.append(out, np.int32(0)).astype("<i4")
    if len(out):
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["runs"])


# ---------------------------------------------------------------- double-array tries

class Trie:
    """A double-array trie over rows of word numbers.

    ``alphabet`` are its words in order; a word's place is spelled with ``digits``
    digits.  ``end[state]`` is the number of the phrase that ends in the state, or 0.
    """

    def __init__(self, alphabet, digits, base, check, end, count):
        self.alphabet, self.digits, self.base, self.check, self.end, self.count = alphabet, digits, base, check, end, count

    @classmethod
    def build(cls, rows: np.ndarray) -> Trie:
        """From distinct rows of LONGEST word numbers (0 after the last word), in lexicographic order."""
        words = np.unique(rows)
        words = words[words > 0]
        digits = 1
        while 1 << (DIGIT * digits) < len(words):
            digits += 1
        code = np.searchsorted(words, rows)
        state = np.zeros(len(rows), np.int64)                # number of the node each row stands at
        parents, symbols, accepting = [], [], np.zeros(1, np.int64)
        nodes = 1
        ends = np.zeros(len(rows), np.int64)
        for level in range(rows.shape[1]):
            active = np.flatnonzero(rows[:, level] > 0)
            for d in reversed(range(digits)):
                symbol = (code[active, level] >> (DIGIT * d)) & ((1 << DIGIT) - 1)
                # Rows in lexicographic order: the rows of one child stand side by side.
                key = (state[active] << DIGIT) | symbol
                fresh = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
                parents.append(state[active][fresh])
                symbols.append(symbol[fresh])
                state[active] = nodes - 1 + np.cumsum(fresh)
                nodes += int(fresh.sum())
            done = active[(rows[active, level + 1] == 0) if level + 1 < rows.shape[1] else slice(None)]
            ends[done] = state[done]
        parent, symbol = np.concatenate(parents), np.concatenate(symbols)
        base, slot = _displace(parent, symbol, nodes)
        place = np.concatenate(([0], slot))                  # node -> state of the double array
        size = int(place.max()) + (1 << DIGIT) + 1
        check, new_base, end = np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size, np.int32)
        check[slot] = place[parent]
        new_base[place] = base
        end[place[ends]] = np.arange(1, len(rows) + 1)
        return cls(words.astype(np.int32), digits, new_base, check, end, len(rows))

    def starts(self, ids: np.ndarray, low: int, high: int) -> np.ndarray:
        """Positions whose word is within the first words of the range."""
        return np.flatnonzero((ids >= low) & (ids <= high))

    def walk(self, ids: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Advance the states of all positions ``at`` word by word: per level, the positions left and their states."""
        state = np.zeros(len(at), np.int32)
        step = 0
        while len(at) and step < LONGEST:
            word = ids[at + step]
            code = np.searchsorted(self.alphabet, word)
            ok = (word > 0) & (code < len(self.alphabet))
            ok[ok] = self.alphabet[code[ok]] == word[ok]
            at, state, code = at[ok], state[ok], code[ok]
            for d in reversed(range(self.digits)):
                to = self.base[state] + ((code >> (DIGIT * d)) & ((1 << DIGIT) - 1))
                ok = self.check[to] == state
                at, state, code = at[ok], to[ok].astype(np.int32), code[ok]
            yield at, state
            step += 1

    def pack(self) -> bytes:
        head = np.array([len(self.alphabet), self.digits, len(self.base), self.count], "<i8")
        return b"".join((head.tobytes(), *(x.astype("<i4").tobytes() for x in (self.alphabet, self.base, self.check, self.end))))

    @classmethod
    def unpack(cls, raw: bytes) -> Trie:
        words, digits, size, count = np.frombuffer(raw, "<i8", 4).tolist()
        body = np.frombuffer(raw, "<i4", offset=32)
        return cls(body[:words], digits, *(body[words + k * size:words + (k + 1) * size] for k in range(3)), count)


def _displace(parent: np.ndarray, symbol: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Bases of all nodes such that no two edges share a slot, and the slot of each edge.

    Nodes with many edges get a block of slots each; nodes with a few try random bases,
    all at once, until every one fits; nodes with one edge take the free slots left.
    """
    width = 1 << DIGIT
    edges = len(parent)
    degree = np.bincount(parent, minlength=nodes)
    base = np.zeros(nodes, np.int64)
    order = np.argsort(parent, kind="stable")
    first = np.concatenate(([0], np.cumsum(degree)))
    big = np.flatnonzero(degree > 8)
    base[big] = 1 + np.arange(len(big)) * width              # slot 0 is the root's state
    small = np.flatnonzero((degree > 1) & (degree <= 8))
    area = 1 + len(big) * width
    size = area + 4 * int(degree[small].sum()) + 2 * width
    taken = np.zeros(size + width + int((degree == 1).sum()) + edges, bool)
    taken[0] = True
    mine = np.isin(parent, big)
    taken[base[parent[mine]] + symbol[mine]] = True
    rng = np.random.default_rng(7)
    for count in range(8, 1, -1):
        open_ = small[degree[small] == count]
        while len(open_):
            slots_of = order[first[open_][:, None] + np.arange(count)]
            trial = 1 + rng.integers(0, size - width, len(open_))
            slots = trial[:, None] + symbol[slots_of]
            free = ~taken[slots].any(axis=1)
            # Of nodes that want the same slot, the first one gets it.
            claim = np.full(len(taken), len(open_), np.int32) if len(open_) > 4096 else None
            if claim is not None:
                np.minimum.at(claim, slots[free].ravel(), np.repeat(np.flatnonzero(free), count).astype(np.int32))
                won = free & (claim[slots] == np.arange(len(open_))[:, None]).all(axis=1)
            else:
                flat, owner = slots[free].ravel(), np.repeat(np.flatnonzero(free), count)
                distinct, lead = np.unique(flat, return_index=True)
                won = free.copy()
                won[owner[owner[lead][np.searchsorted(distinct, flat)] != owner]] = False
            base[open_[won]] = trial[won]
            taken[slots[won].ravel()] = True
            open_ = open_[~won]
    single = np.flatnonzero(degree[parent] == 1)
    free = np.flatnonzero(~taken[width:])[:len(single)] + width
    base[parent[single]] = free - symbol[single]
    return base, base[parent] + symbol


def _ranges(phrases: DataFrame, columns: list[str], shard: int) -> DataFrame:
    """shard, low, high, trie, rows: double-array tries of the phrases' ranges, and the rows of each; written as a table."""
    spark = phrases.sparkSession
    parts = max(1, -(-phrases.count() // shard))
    placed = materialize(phrases.select(*columns).repartitionByRange(parts, *columns).withColumn("part", F.spark_partition_id()))
    # Neighbouring partitions share a range while it stays within its bound, however many there are.
    groups, size, group = [], 0, 0
    for part, n in sorted((r.part, r.n) for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()):
        if size and size + n > shard:
            group, size = group + 1, 0
        size += n
        groups.append((part, group))

    def build(table: pa.Table) -> pa.Table:
        rows = np.stack([table[c].to_numpy() for c in columns], axis=1)
        rows = rows[np.lexsort(rows.T[::-1])]
        out = []
        for lo in range(0, len(rows), 2 * shard):            # partitions are cut by estimate: no range outgrows its bound
            part = rows[lo:lo + 2 * shard]
            out.append((int(part[0, 0]), int(part[-1, 0]), Trie.build(part).pack(), part.astype("<i4").tobytes()))
        low, high, trie, body = zip(*out)
        return pa.table({"low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64()), "trie": pa.array(trie, pa.binary()), "rows": pa.array(body, pa.binary())})

    grouped = placed.join(F.broadcast(local_rows(spark, groups or [(0, 0)], "part int, range int")), "part")
    made = materialize(grouped.select("range", *columns).groupBy("range").applyInArrow(build, "low long, high long, trie binary, rows binary"))
    return made.withColumn("shard", F.row_number().over(Window.orderBy("low", "high", F.xxhash64("rows"))))


def _tries(ranges: DataFrame) -> Iterator[tuple]:
    """shard, low, high and a function that broadcasts the trie."""
    sc = ranges.sparkSession.sparkContext
    for r in ranges.select("shard", "low", "high").orderBy("shard").collect():
        yield r.shard, r.low, r.high, lambda shard=r.shard: sc.broadcast(ranges.filter(F.col("shard") == shard).select("trie").first().trie)


def _packed(words: np.ndarray) -> np.ndarray:
    """Rows of 2 or 4 word numbers as one or two 64-bit keys."""
    w = words.astype(np.uint64)
    return np.stack([(w[:, k] << np.uint64(32)) | w[:, k + 1] for k in range(0, w.shape[1], 2)], axis=1)


def _counted(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their numbers of times."""
    order = np.argsort(keys[:, 0]) if keys.shape[1] == 1 else np.lexsort((keys[:, 1], keys[:, 0]))
    keys = keys[order]
    edge = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))) if len(keys) else np.zeros(0, np.int64)
    if times is None:
        return keys[edge], np.diff(np.append(edge, len(keys)))
    return keys[edge], np.add.reduceat(times[order], edge) if len(edge) else times


class Proposals:
    """Keys proposed by a task with their numbers of times, summed up before they are sent."""

    def __init__(self, width: int):
        self.width, self.keys, self.times, self.size = width, [], [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, times = _counted(keys)
        self.keys.append(keys)
        self.times.append(times)
        self.size += len(keys)
        if self.size > HELD:
            keys, times = _counted(np.concatenate(self.keys), np.concatenate(self.times))
            self.keys, self.times, self.size = [keys], [times], len(keys)
            if self.size > HELD // 2:
                yield from self.send()

    def send(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            keys, times = _counted(np.concatenate(self.keys), np.concatenate(self.times))
            self.keys, self.times, self.size = [], [], 0
            for lo in range(0, len(keys), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_arrays([*(pa.array(keys[part, k].astype(np.int64)) for k in range(self.width)), pa.array(times[part])],
                                                 names=["k", "l", "n"] if self.width == 2 else ["k", "n"])


def propose_pairs(runs: DataFrame) -> DataFrame:
    """w1, w2, n of all adjacent frequent words."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Proposals(1)
        for batch in batches:
            for body in batch.column(0):
                ids = np.frombuffer(body.as_buffer(), "<i4")
                at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
                yield from found.add(_packed(np.stack([ids[at], ids[at + 1]], axis=1)))
        yield from found.send()

    return (runs.mapInArrow(work, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
            .select(F.shiftright("k", 32).cast("int").alias("w1"), F.col("k").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("w2"), "n"))


def longer_keys(ids: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Keys of all phrases of three and four (fourth word 0: three) whose pairs are all marked."""
    ok = marks > 0
    three = ok[:-1] & ok[1:]
    at = np.flatnonzero(three)
    more = np.flatnonzero(three[:-1] & ok[2:])
    rows = np.zeros((len(at) + len(more), 4), np.int32)
    for k in range(3):
        rows[:len(at), k], rows[len(at):, k] = ids[at + k], ids[more + k]
    rows[len(at):, 3] = ids[more + 3]
    return _packed(rows)


def propose_longer(runs: DataFrame, pairs: DataFrame, shard: int) -> DataFrame:
    """w1, w2, w3, w4 (0 for phrases of three), n: what occurs with all its pairs frequent.

    One pass per trie of pairs marks the positions where one starts (a byte each, written
    along with the runs between passes); the last pass proposes.
    """
    marked = runs.withColumn("marks", F.lit(None).cast("binary"))
    tries = list(_tries(_ranges(pairs, ["w1", "w2"], shard)))
    proposed = runs.sparkSession.createDataFrame([], "k long, l long, n long")
    for turn, (_, low, high, send) in enumerate(tries, 1):
        held = send()

        def marks_of(batches: Iterator[pa.RecordBatch], low=low, high=high, held=held) -> Iterator[tuple]:
            trie = Trie.unpack(held.value)
            for batch in batches:
                for body, old in zip(batch.column(0), batch.column(1)):
                    ids = np.frombuffer(body.as_buffer(), "<i4")
                    marks = np.frombuffer(old.as_buffer(), np.uint8).copy() if old.is_valid else np.zeros(len(ids), np.uint8)
                    for at, state in trie.walk(ids, trie.starts(ids, low, high)):
                        marks[at[trie.end[state] > 0]] = 1
                    yield body, ids, marks

        def mark(batches: Iterator[pa.RecordBatch], marks_of=marks_of) -> Iterator[pa.RecordBatch]:
            for body, _, marks in marks_of(batches):
                yield pa.RecordBatch.from_arrays([pa.array([body.as_py()], pa.binary()), pa.array([marks.tobytes()], pa.binary())], names=["runs", "marks"])

        def propose(batches: Iterator[pa.RecordBatch], marks_of=marks_of) -> Iterator[pa.RecordBatch]:
            found = Proposals(2)
            for _, ids, marks in marks_of(batches):
                yield from found.add(longer_keys(ids, marks))
            yield from found.send()

        if turn < len(tries):
            marked = materialize(marked.mapInArrow(mark, "runs binary, marks binary"))
            held.destroy()
        else:
            proposed = marked.mapInArrow(propose, "k long, l long, n long")
    part = lambda c, high: (F.shiftright(c, 32) if high else F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))).cast("int")
    return (proposed.groupBy("k", "l").agg(F.sum("n").alias("n"))
            .select(part("k", True).alias("w1"), part("k", False).alias("w2"), part("l", True).alias("w3"), part("l", False).alias("w4"), "n"))


def _summed(vectors: DataFrame) -> DataFrame:
    """shard, chunk, counts: vectors of counts added up over tasks, at most FAN of them in one group at a time."""
    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(v.as_buffer(), "<i8") for v in table["counts"]], axis=0)
        return pa.table({"shard": table["shard"][:1], "chunk": table["chunk"][:1], "task": table["task"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    while True:
        vectors = materialize(vectors.withColumn("task", F.expr(f"cast(task div {FAN} AS int)")).groupBy("shard", "chunk", "task")
                              .applyInArrow(add, "shard int, chunk int, task int, counts binary"))
        if not vectors.agg(F.max("task").alias("task")).first().task:
            return vectors.select("shard", "chunk", "counts")


def count_phrases(runs: DataFrame, candidates: DataFrame, shard: int) -> DataFrame:
    """w1..w4, f: occurrences of every candidate, by one pass per trie."""
    ranges = _ranges(candidates, ["w1", "w2", "w3", "w4"], shard)
    spark, sums = runs.sparkSession, None
    for number, low, high, send in _tries(ranges):
        held = send()

        def work(batches: Iterator[pa.RecordBatch], low=low, high=high, held=held, number=number) -> Iterator[pa.RecordBatch]:
            trie = Trie.unpack(held.value)
            total = np.zeros(trie.count + 1, np.int64)
            for batch in batches:
                for body in batch.column(0):
                    ids = np.frombuffer(body.as_buffer(), "<i4")
                    for _, state in trie.walk(ids, trie.starts(ids, low, high)):
                        total += np.bincount(trie.end[state], minlength=len(total))
            task = TaskContext.get().partitionId()
            for lo in range(0, trie.count, CHUNK):
                part = total[1 + lo:1 + lo + CHUNK]
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([lo // CHUNK], pa.int32()), pa.array([task], pa.int32()),
                                                      pa.array([part.astype("<i8").tobytes()], pa.binary())], names=["shard", "chunk", "task", "counts"])

        got = _summed(runs.select("runs").mapInArrow(work, "shard int, chunk int, task int, counts binary"))
        held.destroy()
        sums = got if sums is None else sums.unionByName(got)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, chunk, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                f = np.frombuffer(body.as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(f), number, np.int32)), pa.array(np.arange(chunk * CHUNK, chunk * CHUNK + len(f), dtype=np.int32)), pa.array(f)],
                                                 names=["shard", "place", "f"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = np.frombuffer(body.as_buffer(), "<i4").reshape(-1, 4)
                for lo in range(0, len(rows), 1 << 16):
                    some = rows[lo:lo + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), number, np.int32)), pa.array(np.arange(lo, lo + len(some), dtype=np.int32)),
                                                      *(pa.array(some[:, k].copy()) for k in range(4))], names=["shard", "place", "w1", "w2", "w3", "w4"])

    names = ranges.select("shard", "rows").mapInArrow(named, "shard int, place int, w1 int, w2 int, w3 int, w4 int")
    if sums is None:
        sums = spark.createDataFrame([], "shard int, chunk int, counts binary")
    counts = sums.mapInArrow(listed, "shard int, place int, f long")
    return names.join(counts, ["shard", "place"]).select("w1", "w2", "w3", "w4", "f")


def phrase_counts(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang", shard: int = SHARD, words_shard: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """Written tables: lang, words (list), f of all phrases of 1 to 4 words with f >= least; and lang, n of all word occurrences."""
    counted = materialize(word_counts(docs, text_col, lang_col))
    totals = materialize(counted.groupBy("lang").agg(F.sum("n").alias("n")))
    words = materialize(numbered(materialize(counted.filter(F.col("n") >= least)), words_shard))
    runs = encode(docs, words, text_col, lang_col)
    pairs = materialize(propose_pairs(runs).filter(F.col("n") >= least))
    longer = materialize(propose_longer(runs, pairs, shard).filter(F.col("n") >= least))
    three, four = longer.filter("w4 = 0"), longer.filter("w4 > 0")
    # A phrase of four whose parts of three are not both proposed cannot be frequent.
    head = three.select("w1", "w2", "w3")
    four = (four.join(head, ["w1", "w2", "w3"], "left_semi")
            .join(head.toDF("w2", "w3", "w4"), ["w2", "w3", "w4"], "left_semi"))
    order = ["w1", "w2", "w3", "w4"]
    candidates = materialize(pairs.select("w1", "w2", F.lit(0).alias("w3"), F.lit(0).alias("w4"))
                             .unionByName(three.select(*order)).unionByName(four.select(*order)))
    counts = count_phrases(runs, candidates, shard).filter(F.col("f") >= least)
    ids = materialize(with_ids(words))
    name = ids.select("id", "word")
    named = counts.join(ids.select(F.col("id").alias("w1"), "lang", F.col("word").alias("a")), "w1")
    for w, c in (("w2", "b"), ("w3", "c"), ("w4", "d")):
        named = named.join(name.toDF(w, c), w, "inner" if w == "w2" else "left")
    listed = named.select("lang", F.array_compact(F.array("a", "b", "c", "d")).alias("words"), "f")
    single = ids.select("lang", F.array("word").alias("words"), F.col("n").alias("f"))
    return materialize(single.unionByName(listed)), totals


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST, text_col: str = "text", lang_col: str = "lang",
                 shard: int = SHARD, words_shard: int = WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best-scoring phrases of two to four words of each language."""
    counts, totals = phrase_counts(docs, least, text_col, lang_col, shard, words_shard)
    # A space joins words without loss: no word holds one.
    counts = counts.select("lang", F.array_join("words", " ").alias("phrase"), F.size("words").alias("size"), "words", "f")
    known = counts.select("lang", "phrase", "f")
    candidates = counts.filter("size > 1")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("""transform(sequence(1, size - 1),
        k -> named_struct('k', k, 'head', array_join(slice(words, 1, k), ' '), 'rest', array_join(slice(words, k + 1, size - k), ' ')))""")).alias("cut"))
    scored = (cuts.select("lang", "phrase", "a", "cut.*")
              .join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
              .join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
              .withColumn("score", F.expr(f"cast(cast({SCALE} AS decimal(38,0)) * a AS decimal(38,0)) div (cast(l AS decimal(38,0)) + r)").cast("long")))
    lowest = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("low"))
    # The count of the most frequent longer candidate that holds a phrase.
    inside = (candidates.filter("size > 2").select("lang", "f", F.explode(F.expr("""flatten(transform(sequence(2, size - 1),
        m -> transform(sequence(1, size - m + 1), s -> array_join(slice(words, s, m), ' '))))""")).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("held")))
    kept = lowest.join(inside, ["lang", "phrase"], "left").filter(
        F.col("held").isNull() | F.expr(f"cast(held AS decimal(38,0)) * 100 < cast(a AS decimal(38,0)) * {KEPT_SHARE}"))
    # The best of each of SALTS shares of a language first: no task sees all of its candidates.
    order = [F.desc("low.score"), F.desc("a"), "phrase"]
    share = Window.partitionBy("lang", "share").orderBy(*order)
    likely = (kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("nth", F.row_number().over(share))
              .filter(F.col("nth") <= most))
    return (likely.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= most)
            .join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("low.l").alias("l"), F.col("low.r").alias("r"), "n", F.col("low.score").alias("score")))
