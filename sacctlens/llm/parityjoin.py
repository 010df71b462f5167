"""N-gram Jaccard join with parity sketches; components of near copies.

A document's set holds its distinct shingles of ``SIZE`` words.  For Jaccard
similarity of at least ``NUM`` / 100 two sets of a and b shingles differ in at most
(100 - NUM)(a + b) / (100 + NUM) shingles.

*Pigeonhole.*  Sets are grouped in size bands.  A band cuts the hash range into
parts; the parity sketch of a part is the exclusive or of the shingle hashes in
it, so a part's sketch changes only if a differing shingle falls into it.  With at
most D differing shingles, the first D + 1 non-empty parts of one of two linked
sets hold one that is untouched in the other; so only these are sent, and every
link shares at least one key.  A set is sent for its own band and, where smaller
partners can lie there, for the band below.

*Candidates.*  Keys are packed per bucket.  A key shared by n sets gives n - 1
candidates (all to the smallest id) and, from three sets on, its member list, for
later.  Sets that are equal form classes first, and one member stands for each.

*Filter and verification.*  A second parity sketch of 1.5 to 3 bits a shingle, and at
least ``SKETCH_BITS``, travels with each set: its Hamming distance never exceeds the
difference, so pairs beyond D are dropped unseen.  The rest are verified on the whole
texts.  At 1.5 bits, two sets of n that differ in 0.5 n are expected 0.36 n apart, beyond
D = 0.29 n, so pairs below a similarity of 0.6 seldom reach their texts.  In long member
lists, whose pairs grow with the square of the list, a sketch of 4 to 8 bits takes its place.

*What the stars left out.*  After the components of the verified pairs are known,
member lists that still span several components get up to ``ROUNDS`` further stars
(fewer if a star leaves nearly all lists as they were), each around another member and
only for members outside its component.  Lists that span several components even then are compared, those with the same smallest
member together and long ones in blocks: all pairs across components, through the same filter and verification.  So no link between
components is lost, and no group is expanded into all its pairs.

Defined results: a null text, or one without words, has an empty set, links with
nothing and is its own component; texts shorter than a shingle have one, the whole
sequence; rows that share an id are one document of the component graph, each row
returned with its own n_shingles; rows without an id take no part in links and get
a null component; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sacctlens.llm.common import few, materialize, spread, unused
from sacctlens.llm.components import components
from sacctlens.llm.textkit import SMALL_STEP, blobs, buffers, lean, mix, span_hashes, steps, word_spans

SIZE = 5
NUM = 75
#: Bands of sets grow by 100 / NUM, so partners lie in the same or the next band.
#: Up to this size every shingle is a part of its own.
SINGLE_PARTS = 256
#: Parts of a larger band, as a share of its largest size.
PART_SHARE = 0.7
BUCKET_KEYS = 1_000_000
#: Bits of the smallest sketches: below, chance lets too many pairs pass.
SKETCH_BITS = 512
#: Bits for two shingles: of the sketches that all pairs meet with, and of those in lists of more than ``LONG_LIST`` members.
COARSE, FINE = 3, 8
LONG_LIST = 64
BLOCK = 2048
#: Memberships of lists with one smallest member that meet in one group.
LOT_MEMBERS = 8192
#: The same of lists that are cut into blocks.
CUT_MEMBERS = 1 << 14
HUB_ROWS = 256
#: Pairs enumerated at once in a task, and bytes of sketches gathered at once for them.
PAIRS_AT_ONCE = 1 << 20
SKETCH_BYTES = 2 << 20
#: From this many pairs on, a group's lists are marked in a table of members by members, strips of so many cells at a time.
MARKED_PAIRS = 1 << 12
MARKED_CELLS = 1 << 22
#: Open pairs that a task gathers before it passes them on.
OPEN_PAIRS = 1 << 19
#: Further stars per member list before its components are compared pair by pair.
ROUNDS = 2
#: Another star follows if it has at most this share of the members to look at that the one before had.
HELPED = 0.9
#: Up to this many ids (8 bytes each) are sent to every task.
SENT_IDS = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def shingle_sets(texts: pa.Array, size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    buf, offs = buffers(texts)
    buf = _LOWER[buf]
    starts, ends, rows = word_spans(buf, offs)
    h = span_hashes(buf, starts, ends)
    n = len(h)
    g = h.copy()
    for j in range(1, size):
        g = g[:n - j] if len(g) > n - j else g
        if len(g):
            g = mix(g) ^ h[j:j + len(g)]
    g = mix(g) if n >= size else g[:0]
    out = []
    for i in range(len(rows) - 1):
        lo, hi = int(rows[i]), int(rows[i + 1])
        if hi - lo >= size:
            out.append(np.unique(g[lo:hi - size + 1]))
        elif hi > lo:
            x = np.array([hi - lo], np.uint64)
            for k in range(lo, hi):
                x = mix(x) ^ h[k]
            out.append(mix(mix(x)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def most_different(total: int, num: int = NUM) -> int:
    """Differing shingles of a linked pair with ``total`` shingles in both sets."""
    return (100 - num) * total // (100 + num)


class Bands:
    """Size bands: band k holds sets of edge[k] <= n < edge[k + 1]."""

    def __init__(self, num: int = NUM):
        self.num, self.edge = num, [1]

    def of(self, n: int) -> int:
        while self.edge[-1] <= n:
            low = self.edge[-1]
            self.edge.append(max(low + 1, -(-low * 100 // self.num)))
        return int(np.searchsorted(self.edge, n, side="right")) - 1

    def parts(self, k: int) -> int:
        top = self.edge[k + 1]
        return 1 << 32 if top <= SINGLE_PARTS else int(top * PART_SHARE)


def keys_of(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys under which a set meets every set that it may be linked with."""
    n, num = len(shingles), bands.num
    k = bands.of(n)
    wanted = [(k, most_different(n + n * 100 // num, num))]
    smaller = bands.edge[k] - 1
    if k and smaller * 100 >= n * num:
        wanted.append((k - 1, most_different(n + smaller, num)))
    high = shingles >> np.uint64(32)
    out = []
    for band, most in wanted:
        part = (high * np.uint64(bands.parts(band))) >> np.uint64(32)     # rises with the sorted hashes
        new = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        parity = np.bitwise_xor.reduceat(shingles, new)[:most + 1]
        out.append(mix(parity ^ mix((np.uint64(band) << np.uint64(40)) ^ part[new[:most + 1]])))
    return np.concatenate(out)


def sketch_of(shingles: np.ndarray, per_two: int = COARSE) -> np.ndarray:
    """Parity bits: each shingle flips one of the bits, ``per_two`` for two shingles (next power of two, at least ``SKETCH_BITS``)."""
    bits = max(SKETCH_BITS, 1 << max(0, per_two * len(shingles) // 2 - 1).bit_length())
    flips = np.bincount((mix(shingles) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little")


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The same set's sketch of ``size`` bytes (both powers of two)."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, size), axis=0) if len(sketch) > size else sketch


def may_link(n_a: int, n_b: int, a: bytes, b: bytes, num: int = NUM) -> bool:
    if min(n_a, n_b) * 100 < max(n_a, n_b) * num:
        return False
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    apart = int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())
    return apart <= most_different(n_a + n_b, num)


def linked(a: np.ndarray, b: np.ndarray, num: int = NUM) -> bool:
    """The exact test on two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= num * (len(a) + len(b) - both) and both > 0


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def describe_sets(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n, s1, s2 (hash of the whole set), sketch, fine."""
    @lean
    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in steps(batch, most=SMALL_STEP):
                part = batch.slice(lo, hi - lo)
                sets = shingle_sets(part.column("text"), size)
                total = lambda seed: pa.array([int(np.add.reduce(mix(s ^ np.uint64(seed)), dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), total(0x51), total(0xA7),
                    *[blobs(sketch_of(s, per_two).tobytes() if len(s) else b"" for s in sets) for per_two in (COARSE, FINE)]],
                    names=["doc_id", "n", "s1", "s2", "sketch", "fine"])

    return docs.mapInArrow(described, "doc_id long, n long, s1 long, s2 long, sketch binary, fine binary")


def shared_keys(docs: DataFrame, buckets: int, size: int = SIZE, num: int = NUM) -> DataFrame:
    """a, b, run: candidate pairs a < b (run null), and members b of the keys (run) that three or more share."""
    @lean
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num)
        for batch in batches:
            for lo, hi in steps(batch):
                part = batch.slice(lo, hi - lo)
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                sets = (s for x, y in steps(part, most=SMALL_STEP) for s in shingle_sets(part.column("text").slice(x, y - x), size))
                found = [(int(i), keys_of(s, bands)) for i, s in zip(ids, sets) if len(s)]
                if not found:
                    continue
                keys = np.concatenate([k for _, k in found])
                owner = np.repeat(np.arange(len(found)), [len(k) for _, k in found])
                bucket = (keys % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                keys, owner, bucket = keys[order], owner[order], bucket[order]
                names = np.array([i for i, _ in found], "<i8")
                edge = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[edge[:-1]].astype(np.int32)), blobs(_pack(names, owner[x:y], keys[x:y]) for x, y in zip(edge[:-1], edge[1:]))],
                    names=["bucket", "blob"])

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("run", pa.int64())])

    def meet(table: pa.Table) -> pa.Table:
        parts = [_unpack(b.as_py()) for b in table.column("blob")]
        doc, key = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.lexsort((doc, key))
        doc, key = doc[order], key[order]
        once = np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
        doc, key = doc[once], key[once]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(first, append=len(key))
        head = np.repeat(doc[first], count)
        star = np.repeat(count, count) > 1
        star[first] = False
        pairs = np.unique(np.column_stack((head[star], doc[star])), axis=0)
        run = np.add.reduceat(mix(doc.astype(np.uint64)), first)      # names a member list, not a key
        _, one = np.unique(run, return_index=True)
        one = one[count[one] > 2]
        member = np.zeros(len(first), bool)
        member[one] = True
        take = np.repeat(member, count)
        many = doc[take]
        return pa.table({"a": pa.array(np.concatenate((pairs[:, 0], many))), "b": pa.array(np.concatenate((pairs[:, 1], many))),
                         "run": pa.concat_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(np.repeat(run, count)[take].view(np.int64))])}, schema=schema)

    return (docs.filter("doc_id is not null and text is not null").mapInArrow(send, "bucket int, blob binary")
            .groupBy("bucket").applyInArrow(meet, "a long, b long, run long"))


def _planes(x: np.ndarray) -> bytes:
    """All first bytes, then all second ones: of small numbers, runs of zeros that the shuffle packs."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _from_planes(blob: bytes, kind: str, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8, size * n, at).reshape(size, n).T).view(kind).ravel()


def _pack(names: np.ndarray, owner: np.ndarray, keys: np.ndarray) -> bytes:
    """Documents with their key counts, then four bytes of every key (in a bucket of a million keys
    about a hundred pairs agree by chance; the filter drops them).

    The more buckets, the fewer keys a document has in one: so ids go as differences, in planes of bytes.
    """
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    count = np.diff(first, append=len(owner)).astype("<u4")
    ids = names[owner[first]]
    return b"".join((np.uint32(len(first)).tobytes(), _planes(np.diff(ids, prepend=ids.dtype.type(0))), _planes(count), (keys >> np.uint64(32)).astype("<u4").tobytes()))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    doc, count = np.cumsum(_from_planes(blob, "<i8", n, 4)), _from_planes(blob, "<u4", n, 4 + 8 * n)
    return np.repeat(doc, count), np.frombuffer(blob, "<u4", -1, 4 + 12 * n)


def named_by(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows whose ``doc_id`` a pair names, found without a shuffle of the rows
    while their ids are few enough to be sent to every task; else all rows."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    if ids.count() > SENT_IDS:
        return rows
    return rows.join(F.broadcast(ids), "doc_id", "left_semi")


def filtered(pairs: DataFrame, sets: DataFrame, num: int = NUM) -> DataFrame:
    """The pairs (a, b) that the sizes and the parity sketches leave open.

    ``pairs`` is read several times: pass a materialised one.
    """
    size_of = lambda x: sets.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"))
    near = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * num)
    # Sizes first: sketches, which are long, travel only for pairs whose sizes can link.
    sized = materialize(few(pairs.join(size_of("a"), "a").join(size_of("b"), "b").filter(near).select("a", "b", "n_a", "n_b").distinct(), pairs.count()))
    sets = named_by(sized, sets)
    of = lambda x: sets.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    rows = sized.join(of("a"), ["a", "n_a"]).join(of("b"), ["b", "n_b"]).select("a", "b", "n_a", "n_b", "s_a", "s_b")

    @lean
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.to_pydict()
            ok = [may_link(*r, num) for r in zip(d["n_a"], d["n_b"], d["s_a"], d["s_b"])]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    # Ids with several texts give a pair several times.
    return rows.mapInArrow(keep, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, size: int = SIZE, num: int = NUM) -> DataFrame:
    """The pairs (a, b) that are links, by their whole texts.

    The texts of b travel to a; a hub's partners are dealt over several tasks,
    each of which gets the hub's text once.  Texts that no pair names stay where
    they are while the pairs are few enough to be sent to every task; beyond
    that, all texts meet the pairs by shuffle.  ``pairs`` is read several times:
    pass a materialised one.
    """
    docs = named_by(pairs, docs)
    # Written first, so that the join below may split a hub's pairs.
    hubs = materialize(few(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_ROWS).cast("int").alias("lots")), pairs.count()))
    partners = pairs.join(hubs, "a").select("a", F.pmod(F.xxhash64("b"), F.col("lots")).cast("int").alias("lot"), "b")
    own = hubs.select("a", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), F.col("a").alias("b"))
    needed = partners.unionByName(own)
    texts = needed.join(docs.withColumnRenamed("doc_id", "b"), "b").select("a", "lot", "b", (F.col("a") == F.col("b")).alias("hub"), "text")
    dealt = texts.repartition(spread(docs), "a", "lot").sortWithinPartitions("a", "lot", F.desc("hub"))

    @lean
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own_sets = None, []
        for batch in batches:
            found_a, found_b = [], []
            for lo, hi in steps(batch, most=SMALL_STEP):
                part = batch.slice(lo, hi - lo)
                sets = shingle_sets(part.column("text"), size)
                for a, lot, b, hub, s in zip(part.column("a").to_pylist(), part.column("lot").to_pylist(), part.column("b").to_pylist(), part.column("hub").to_pylist(), sets):
                    if at != (a, lot):
                        at, own_sets = (a, lot), []
                    if hub:
                        own_sets.append(s)
                    elif any(linked(mine, s, num) for mine in own_sets):
                        found_a.append(a)
                        found_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(test, "a long, b long")


def labelled(runs: DataFrame, labels: DataFrame) -> DataFrame:
    """run, b, label: the members with the components they are in."""
    return materialize(few(runs.join(labels, runs.b == labels.node, "left").select("run", "b", F.coalesce("component", "b").alias("label")), runs.count()))


def star_around(named: DataFrame, nth: int) -> tuple[DataFrame, DataFrame]:
    """The member lists that span several components (run, b, label), and pairs (a, b), a < b, of one
    member of each (another one for each ``nth``) with the members outside its component."""
    most = named.count()
    spans = materialize(few(named.groupBy("run").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                                 F.min(F.struct(F.xxhash64("b", F.lit(nth)).alias("h"), "b", "label")).alias("hub"))
                        .filter("low <> high").select("run", F.col("hub.b").alias("hub"), F.col("hub.label").alias("hub_label")), most))
    rows = named.join(spans, "run")
    pairs = rows.filter("label <> hub_label").select(F.least("b", "hub").alias("a"), F.greatest("b", "hub").alias("b")).distinct()
    return rows.select("run", "b", "label"), pairs


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) after further edges (a, b)."""
    name = labels.withColumnsRenamed({"node": "_n", "component": "_c"})
    lift = lambda e, c: e.join(name, e[c] == name._n, "left").withColumn(c, F.coalesce("_c", c)).drop("_n", "_c")
    most = edges.count()
    joined = components(lift(lift(edges, "a"), "b").filter("a <> b"), most).withColumnsRenamed({"node": "_n", "component": "_c"})
    nodes = (labels.unionByName(joined.select(F.col("_n").alias("node"), F.col("_n").alias("component")))
             .groupBy("node").agg(F.min("component").alias("component")))
    return materialize(few(nodes.join(joined, nodes.component == joined._n, "left").select("node", F.coalesce("_c", "component").alias("component")), labels.count() + 2 * most))


def across(runs: DataFrame, labels: DataFrame, sets: DataFrame, num: int = NUM) -> DataFrame:
    """The pairs (a, b), a < b, between the components that one member list spans (see ``between``)."""
    return between(labelled(runs, labels), sets, num)


def between(named: DataFrame, sets: DataFrame, num: int = NUM) -> DataFrame:
    """The pairs (a, b), a < b, between the components that one member list spans, as far
    as sizes and parity sketches leave them open.

    Lists with the same smallest member share most of their members: they meet together, so that
    a member's sketch is sent, and a pair compared and said, once for all of them.  Members of lists
    of over ``BLOCK`` are cut into blocks of about that many, two of which meet at a time; such lists
    meet together where this sends fewer sketches.
    """
    most = named.count()
    spans = materialize(few(named.groupBy("run").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("members"), F.min("b").alias("head"))
                        .filter("low <> high").select("run", "members", "head", (F.col("members") > LONG_LIST).alias("fine"), (F.col("members") > BLOCK).alias("cut"))
                        .withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")), most))
    short, cut = spans.filter("not cut"), spans.filter("cut")
    all_members = named.join(cut, "run").groupBy("head").agg(F.countDistinct("b").alias("all"))
    heads = (cut.groupBy("head").agg(F.sum("members").alias("members"), F.sum(F.col("members") * F.col("blocks")).alias("apart")).join(all_members, "head")
             .withColumn("blocks", F.ceil(F.col("all") / BLOCK).cast("int"))
             .withColumn("lots", F.ceil(F.col("members") * 2 / F.col("blocks") / CUT_MEMBERS))
             .filter(F.col("all") * F.col("blocks") * F.col("lots") <= F.col("apart")).select("head", F.col("blocks").alias("_blocks"), "lots"))
    cut = materialize(few(cut.join(heads, "head", "left"), most))
    lots = short.groupBy("head", "fine").agg(F.ceil(F.sum("members") / LOT_MEMBERS).alias("lots"))
    together = (short.join(lots, ["head", "fine"]).select("run", "head", "fine", "cut", "blocks", "lots")
                .unionByName(cut.filter("lots is not null").select("run", "head", "fine", "cut", F.col("_blocks").alias("blocks"), "lots"))
                .withColumn("lot", F.pmod(F.xxhash64("run"), F.col("lots")).cast("int")).drop("lots"))
    return _across_heads(named, together, sets, num).unionByName(_across_long(named, cut.filter("lots is null"), sets, num)).distinct()


def _across_heads(named: DataFrame, together: DataFrame, sets: DataFrame, num: int) -> DataFrame:
    """The open pairs of lists, by smallest member, lot of lists and two blocks of members."""
    group = ["head", "fine", "cut", "lot"]
    listed = materialize(few(named.join(together, "run").withColumn("mine", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int")), named.count()))
    lists = listed.groupBy(*group, "blocks", "run", "mine").agg(F.collect_list("b").alias("list"))
    members = listed.select(*group, "blocks", "mine", "b", "label").distinct()
    coarse, fine = members.filter("not fine"), members.filter("fine")
    of = lambda some, sketch: named_by(some.select(F.col("b").alias("a"), "b"), sets).select(F.col("doc_id").alias("b"), "n", F.col(sketch).alias("sketch"))
    rows = (coarse.join(of(coarse, "sketch"), "b").unionByName(fine.join(of(fine, "fine"), "b"))
            .unionByName(lists, allowMissingColumns=True)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"x": F.least("mine", "other"), "y": F.greatest("mine", "other")}).drop("blocks", "other"))
    keys = (*group, "x", "y")
    met = rows.repartition(spread(named), *keys).sortWithinPartitions(*keys, "run", "mine")

    @lean
    def compare_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _once(_grouped(batches, keys, lambda t, start: _open_in_lists(t, start, num)))

    return met.mapInArrow(compare_lists, "a long, b long")


def _across_long(named: DataFrame, spans: DataFrame, sets: DataFrame, num: int) -> DataFrame:
    """The open pairs of lists of over ``BLOCK`` members that meet alone, by two blocks of a list."""
    listed = materialize(few(named.join(spans.select("run", "blocks"), "run"), named.count()))
    of_long = named_by(listed.select(F.col("b").alias("a"), "b"), sets)
    rows = (listed.join(of_long.select(F.col("doc_id").alias("b"), "n", F.col("fine").alias("sketch")), "b")
            .withColumn("mine", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("run", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "b", "label", "n", "sketch"))
    met = rows.repartition(spread(rows), "run", "x", "y").sortWithinPartitions("run", "x", "y", "mine")

    @lean
    def compare_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _once(_grouped(batches, ("run", "x", "y"), lambda t, start: _open_pairs(t, num)))

    return met.mapInArrow(compare_once, "a long, b long")


def _grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], open_pairs) -> Iterator[pa.RecordBatch]:
    """What ``open_pairs`` finds in whole groups, several at a time, of rows sorted by ``keys``."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if held is not None:
            t = pa.concat_tables([held, t])
        if not len(t):
            continue
        start = _group_starts(t, keys)
        held = t.slice(start[-1])           # the last group may go on
        if start[-1]:
            yield from open_pairs(t.slice(0, start[-1]), start[:-1])
    if held is not None and len(held):
        yield from open_pairs(held, np.zeros(1, np.int64))


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same pair is open in many lists: drop what a task has just said."""
    kept, n = [], 0
    for batch in batches:
        kept.append(np.column_stack([c.to_numpy() for c in batch.columns]))
        n += len(batch)
        if n > OPEN_PAIRS:
            kept = [np.unique(np.concatenate(kept), axis=0)]
            n = len(kept[0])
            if n > OPEN_PAIRS // 2:
                yield _pairs(kept[0])
                kept, n = [], 0
    if kept:
        yield _pairs(np.unique(np.concatenate(kept), axis=0))


def _pairs(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _group_starts(t: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    new = np.zeros(len(t) - 1, bool)
    for c in keys:
        x = t.column(c).to_numpy()
        new |= x[1:] != x[:-1]
    return np.flatnonzero(np.concatenate(([True], new)))


class _Sets:
    """Members (rows of a table) with their sketches of each size: a set's own, or folded from the next larger."""

    def __init__(self, t: pa.Table, num: int):
        self.num = num
        self.doc, self.label, self.n = (t.column(c).to_numpy() for c in ("b", "label", "n"))
        raw = [np.frombuffer(s.as_py(), np.uint8) for s in t.column("sketch")]
        self.length = np.array([len(s) for s in raw], np.int64)
        self.place, self.matrix = {}, {}
        for size in np.unique(self.length):
            here = np.flatnonzero((self.length == size) | (self.length == 2 * size))
            self.place[size] = np.full(len(raw), -1)
            self.place[size][here] = np.arange(len(here))
            # By words: the members' first ones, then their second ones.
            self.matrix[size] = np.ascontiguousarray(np.stack([folded(raw[k], size) for k in here]).view("<u8").T)

    def may_meet(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs of members of different components, in sizes that can link."""
        small, large = np.minimum(self.length[i], self.length[j]), np.maximum(self.length[i], self.length[j])
        return ((self.label[i] != self.label[j]) & (self.doc[i] != self.doc[j]) & (large <= 2 * small)
                & (np.minimum(self.n[i], self.n[j]) * 100 >= np.maximum(self.n[i], self.n[j]) * self.num))

    def open(self, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Those of the pairs of members (rows i and j) that the sketches leave open."""
        doc, n, found = self.doc, self.n, []
        small = np.minimum(self.length[i], self.length[j])
        for size in np.unique(small):
            p, q = i[small == size], j[small == size]
            matrix, place = self.matrix[size], self.place[size]
            step, some = max(1, SKETCH_BYTES // int(size)), -(-len(matrix) // 4)
            for k in range(0, len(p), step):
                a, b = p[k:k + step], q[k:k + step]
                most = ((100 - self.num) * (n[a] + n[b]) // (100 + self.num)).astype(np.int32)
                x, y, apart = place[a], place[b], np.zeros(len(a), np.int32)
                # A part of the words tells most pairs to be too far apart; the others go on.
                for lo in range(0, len(matrix), some):
                    for word in matrix[lo:lo + some]:
                        apart += np.bitwise_count(word[x] ^ word[y])
                    near = np.flatnonzero(apart <= most)
                    if len(near) < len(apart):
                        a, b, x, y, most, apart = (c[near] for c in (a, b, x, y, most, apart))
                    if not len(near):
                        break
                if len(a):
                    found.append(np.column_stack((np.minimum(doc[a], doc[b]), np.maximum(doc[a], doc[b]))))
        if found:
            yield _pairs(np.unique(np.concatenate(found), axis=0))


def _chunks(lo: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j): row i with each of the ``count[i]`` rows from ``lo[i]`` on, some at a time."""
    total, at = np.cumsum(count), 0
    while at < len(count):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
        c = count[at:to]
        yield np.repeat(np.arange(at, to), c), np.repeat(lo[at:to] - np.cumsum(c) + c, c) + np.arange(int(c.sum()))
        at = to


def _open_pairs(t: pa.Table, num: int) -> Iterator[pa.RecordBatch]:
    """Pairs across labels, within each group (run, x, y), that the filters leave open."""
    start = _group_starts(t, ("run", "x", "y"))
    x, y, mine = (t.column(c).to_numpy() for c in ("x", "y", "mine"))
    sets, rows = _Sets(t, num), np.diff(start, append=len(t))
    group_end = np.repeat(start + rows, rows)
    # A row meets the rows after it; where two blocks meet, a left row meets the right ones.
    lefts = np.repeat(np.add.reduceat((mine == x).astype(np.int64), start), rows)
    lo = np.where(x == y, np.arange(len(t)) + 1, np.repeat(start, rows) + lefts)
    for i, j in _chunks(lo, np.where((x == y) | (mine == x), group_end - lo, 0)):
        ok = sets.may_meet(i, j)
        yield from sets.open(i[ok], j[ok])


def _open_in_lists(t: pa.Table, start: np.ndarray, num: int) -> Iterator[pa.RecordBatch]:
    """Pairs across labels, within each list of a group, that the filters leave open.

    A row is a member, with its sketch, or a list's members in one block; the members of a
    group are those of all its lists.  Where two blocks meet, a list's left block meets its right one.
    """
    rows = np.diff(start, append=len(t))
    is_list = t.column("list").is_valid().to_numpy()
    lists = t.filter(pa.array(is_list))
    of = np.repeat(np.arange(len(start)), rows)
    at, own = of[is_list], of[~is_list]
    listed = lists.column("list").combine_chunks()
    size = pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64)
    x, y, mine, run = (lists.column(c).to_numpy() for c in ("x", "y", "mine", "run"))
    sets = _Sets(t.filter(pa.array(~is_list)), num)
    names, code = np.unique(sets.doc, return_inverse=True)
    key = own * len(names) + code
    order = np.argsort(key, kind="stable")
    row = order[np.searchsorted(key[order], np.repeat(at, size) * len(names) + np.searchsorted(names, listed.flatten().to_numpy(zero_copy_only=False)))]
    end = np.cumsum(size)
    crossed = np.append((at[1:] == at[:-1]) & (run[1:] == run[:-1]), False) & (x != y) & (mine == x)
    of_next = np.append(end[1:], 0)
    here, of_list = np.arange(len(row)), np.repeat(np.arange(len(size)), size)
    lo = np.where(np.repeat(x == y, size), here + 1, np.repeat(end, size))
    hi = np.repeat(np.where(x == y, end, np.where(crossed, of_next, end)), size)
    # Where a group's lists hold many of its members' pairs, their pairs are marked; of the others, each list is gone through.
    count, first = hi - lo, np.append(np.searchsorted(own, np.arange(len(start))), len(own))
    pairs = np.bincount(np.repeat(at, size), weights=count, minlength=len(start))
    for g in np.flatnonzero((pairs >= MARKED_PAIRS) & (4 * pairs >= np.diff(first) ** 2)):
        here_lists = np.arange(*np.searchsorted(at, (g, g + 1)))
        count[end[here_lists[0]] - size[here_lists[0]]:end[here_lists[-1]]] = 0
        part = lambda k: row[end[k] - size[k]:end[k]]
        marked = [(left := part(k), left if x[k] == y[k] else part(k + 1)) for k in here_lists if x[k] == y[k] or crossed[k]]
        for i, j in _marked(marked, int(first[g]), int(first[g + 1])):
            ok = sets.may_meet(i, j)
            yield from sets.open(i[ok], j[ok])
    for i, j in _chunks(lo, count):
        several = len(i) and of_list[i[0]] != of_list[i[-1]]
        i, j = row[i], row[j]
        ok = sets.may_meet(i, j)
        i, j = i[ok], j[ok]
        if several:                             # a pair of several lists once
            pair = np.unique(np.minimum(i, j) * len(own) + np.maximum(i, j))
            i, j = pair // len(own), pair % len(own)
        yield from sets.open(i, j)


def _marked(lists: list[tuple[np.ndarray, np.ndarray]], lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs (i, j), i < j, of rows from lo to hi that a left and a right side of one of the lists hold, each once."""
    sides = [(np.sort(a - lo), b - lo) for a, b in lists]
    # Two blocks meet both ways, as the smaller row may be on either side.
    sides += [(np.sort(b - lo), a - lo) for a, b in lists if a is not b]
    members = hi - lo
    strip = max(1, MARKED_CELLS // members)
    for at in range(0, members, strip):
        seen = np.zeros((min(strip, members - at), members), bool)
        for left, right in sides:
            left = left[np.searchsorted(left, at):np.searchsorted(left, at + strip)] - at
            if len(left):
                seen[left[:, None], right] = True
        i, j = np.nonzero(seen)
        after = i + at < j
        yield i[after] + (at + lo), j[after] + lo


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, num: int = NUM,
                bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``."""
    texts = _docs(docs, id_col, text_col)
    every = materialize(describe_sets(texts, size))
    # A written table: each later use filters it by the ids it needs (members of classes but the
    # representatives are never named) before anything is shuffled.
    sets = every.filter("doc_id is not null and n > 0")
    classes = sets.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    # One set per id: an id with several texts belongs to several classes.
    shingles, rows = every.agg(F.sum("n"), F.count(F.lit(1))).first()
    members = materialize(few(sets.join(classes, ["n", "s1", "s2"]).select("doc_id", "rep").distinct(), rows))
    equal = members.filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    buckets = max(1, -(-int((shingles or 0) * 0.65) // bucket_keys))
    found = materialize(shared_keys(texts, buckets, size, num))
    most = found.count()
    low, high = members.withColumnsRenamed({"doc_id": "a", "rep": "ra"}), members.withColumnsRenamed({"doc_id": "b", "rep": "rb"})
    pairs = (found.filter("run is null").select("a", "b").distinct().join(low, "a").join(high, "b").filter("ra <> rb")
             .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    pairs = materialize(few(pairs, most))
    known = texts.filter("doc_id is not null and text is not null")
    first = materialize(verified(materialize(few(filtered(pairs, sets, num), pairs.count())), known, size, num).unionByName(equal))
    labels = components(first, first.count())
    # Most lists lie within one component by now; only the others go on, by representatives.
    lists = found.filter("run is not null").select("run", "b")
    spans = materialize(few(lists.join(labels, lists.b == labels.node, "left").groupBy("run")
                        .agg(F.min(F.coalesce("component", "b")).alias("low"), F.max(F.coalesce("component", "b")).alias("high"))
                        .filter("low <> high").select("run"), most))
    if spans.count() <= SENT_IDS:
        spans = F.broadcast(spans)
    runs = materialize(few(lists.join(spans, "run", "left_semi").join(members.withColumnsRenamed({"doc_id": "b"}), "b")
                       .select("run", F.col("rep").alias("b")).distinct(), most))
    before = None
    for step in range(ROUNDS + 1):
        last, named = step == ROUNDS, labelled(runs, labels)
        if not last:
            runs, candidates = star_around(named, step)
            most = named.count()
            named = materialize(few(runs, most))
            members_left = named.count()
            if not members_left:                # every list lies within one component
                break
            runs = named.select("run", "b")
            last, before = before is not None and members_left > HELPED * before, members_left
        if last:
            candidates = materialize(between(named, sets, num))
        else:
            candidates = materialize(few(filtered(materialize(few(candidates, most)), sets, num), most))
        if candidates.limit(1).count():
            labels = merged(labels, materialize(verified(candidates, known, size, num)))
        if last:
            break
    return (every.join(labels, every.doc_id == labels.node, "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, num: int = NUM) -> DataFrame:
    """The documents, all columns, without those that are near copies of a smaller id.

    Rows without an id stay; of several rows with the id that stays, all stay.
    """
    name, = unused(docs.columns, "_gone")
    gone = (near_copies(docs, id_col, text_col, size, num).filter("component_id <> doc_id")
            .select(F.col("doc_id").alias(name)).distinct())
    return docs.join(gone, F.col(id_col).cast("long") == F.col(name), "left_anti")
