"""SimHash near duplicates by a hierarchical index in Gray order.

A text's fingerprint has a bit set where over half of its shingles' hashes have it.  Fingerprints link when they differ in few bits.

* Only distinct fingerprints are compared; copies of a text are one row from the start.
* With ``most`` bits apart, two fingerprints agree in one of ``most + 1`` parts of their bits, so each goes to that many groups, one for
  each part's value.  A group of more than ``GROUP_ROWS`` is split in the same way by the bits that vary in it, up to ``SPLITS`` times, and no pair is lost.  What is
  larger even then lies so close together that it is nearly one component, and the next step opens little of it.
* In a group the index is built: fingerprints in the order of their Gray rank, where neighbours share most bits; each ``FAN`` of them have
  a node that holds the bits in which all agree, and so on up to one root.  The group is joined with itself from the root: a pair
  of nodes adds the differences in bits that both hold and their parents did not, and is given up, with all below it, as soon as it has
  more than ``most``.  Nodes whose members are in one component already are not opened either.
* A group sends a link from each member to the least member of its component, at most as many as it has members.

Defined results: null texts and texts without a word have the fingerprint zero, and are linked like others; with fewer words than a shingle
has, the whole sequence is the one shingle; a component's id is the least doc_id in it, null only where all are null; repeated rows and rows of equal doc_id each
have a result; an empty table gives an empty result; a very long text is hashed whole, in pieces; extra columns are kept, and those called ``fingerprint``,
``class_id`` or ``component_id`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, U64, mix64, read_documents, shared_checkpoint, sheltered, signed
from .components import connected_components

SEED = 42
#: Members of a group beyond which it is split, and how often.
GROUP_ROWS, SPLITS = 1 << 13, 4
#: Children of a node.
FAN = 8
#: Shingles of a text, pairs of nodes and members that are worked on at once.
CHUNK_SHINGLES, CHUNK_PAIRS, CHUNK_ROWS = 100_000, 500_000, 500_000


def simhash(text: str, size: int = 3) -> int:
    """The fingerprint: ASCII letters count as lower-case, words end at the space and U+0009..U+000D."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < size:
        runs = [tuple(words)]
    else:
        runs = zip(*(words[k:] for k in range(size)))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(b" ".join(r), SEED) for r in runs])
    n = len(hashes) // 8
    rows = np.frombuffer(hashes, dtype=np.uint8).reshape(n, 8)
    ones = sum(np.unpackbits(rows[k : k + CHUNK_SHINGLES], axis=1).sum(axis=0, dtype=np.int64) for k in range(0, n, CHUNK_SHINGLES))
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text: str = "text", size: int = 3) -> DataFrame:
    """Adds ``__fp``, the fingerprint as a signed long."""

    @F.arrow_udf("bigint")
    def work(texts: pa.Array) -> pa.Array:
        return pa.array(signed(np.array([simhash(x.as_py() or "", size) for x in texts], dtype=U64)))

    return docs.withColumn("__fp", work(F.col(text)))


def parts_of(free: int, parts: int) -> list[int]:
    """The bits of ``free`` dealt into masks of about equally many bits, in order."""
    bits = [1 << k for k in range(64) if free >> k & 1]
    return [sum(bits[len(bits) * k // parts : len(bits) * (k + 1) // parts]) for k in range(parts)]


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """(key, free, fp) -> a row for each part of the free bits: the key of its value, and the bits that are left."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, free, fp = (batch.column(c).to_numpy().view(U64) for c in ("key", "free", "fp"))
            for bits in np.unique(free):
                at = free == bits
                for k, part in enumerate(parts_of(int(bits), parts)):
                    name = mix64(mix64(key[at] + U64(k + 1)) ^ mix64((fp[at] & U64(part)) + U64(0x9E3779B97F4A7C15)))
                    left = np.full(len(name), int(bits) & ~part, dtype=U64)
                    yield pa.RecordBatch.from_arrays([pa.array(signed(x)) for x in (name, left, fp[at])], ["key", "free", "fp"])

    return rows.mapInArrow(work, "key long, free long, fp long")


def groups(distinct: DataFrame, most: int, limit: int = GROUP_ROWS) -> DataFrame:
    """(key, fp): every two fingerprints (fp) at most ``most`` bits apart share a key.

    A key with more than ``limit`` of them is split by the bits that vary among them, ``SPLITS`` times at most.
    """
    start = distinct.select(F.lit(0).cast("long").alias("key"), F.lit(-1).cast("long").alias("free"), "fp")
    rows, done = dealt(start, most + 1), None
    for _ in range(SPLITS):
        vary = F.expr("bit_or(fp) ^ bit_and(fp)").alias("free")
        hot = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), vary).filter((F.col("n") > limit) & (F.bit_count("free") > most + 1))
        hot = shared_checkpoint(hot.select("key", "free"))
        n = hot.count()
        if not n:
            break
        sent = F.broadcast(hot) if n <= BROADCAST_ROWS else hot
        small = rows.join(sent, "key", "left_anti").select("key", "fp")
        done = small if done is None else done.union(small)
        rows = dealt(shared_checkpoint(rows.select("key", "fp").join(sent, "key").select("key", "free", "fp")), most + 1)
    rows = rows.select("key", "fp")
    return rows if done is None else done.union(rows)


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray order."""
    rank = fp.copy()
    for k in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> U64(k)
    return rank


def least_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> bool:
    """Joins the components of the pairs in ``label`` (each label names the least member); whether any changed."""
    changed = False
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return changed
        changed = True
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label[:] = further


class Level:
    """Nodes of one level: bits in which all members agree, the children and the members of each."""

    def __init__(self, ones: np.ndarray, zeros: np.ndarray, child: np.ndarray, member: np.ndarray):
        self.ones, self.zeros, self.held = ones, zeros, ones | zeros
        #: first child and member of each node; one more entry than nodes
        self.child, self.member = child, member


def levels_of(fp: np.ndarray, group: np.ndarray, fan: int = FAN) -> list[Level]:
    """From the fingerprints up to one root for each group; both arrays are sorted by group, then Gray rank."""
    at = np.arange(len(fp) + 1)
    levels = [Level(fp, ~fp, at, at)]
    while len(group) and (group[1:] == group[:-1]).any():
        low = levels[-1]
        new = np.ones(len(group), dtype=bool)
        new[1:] = group[1:] != group[:-1]
        start = np.flatnonzero(new)
        within = np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))
        first = np.flatnonzero(within % fan == 0)
        child = np.append(first, len(group))
        levels.append(Level(np.bitwise_and.reduceat(low.ones, first), np.bitwise_and.reduceat(low.zeros, first), child, low.member[child]))
        group = group[first]
    return levels


def opened(level: Level, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent pair, child, child) of pairs of nodes; of a node with itself each pair of children once."""
    na, nb = level.child[a + 1] - level.child[a], level.child[b + 1] - level.child[b]
    n = na * nb
    pair = np.repeat(np.arange(len(a)), n)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
    x, y = level.child[a][pair] + k // nb[pair], level.child[b][pair] + k % nb[pair]
    keep = x <= y
    return pair[keep], x[keep], y[keep]


def joined(fp: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """The least member of each fingerprint's component, within its group; both arrays sorted by group, then Gray rank."""
    label = np.arange(len(fp))
    near = np.flatnonzero((group[1:] == group[:-1]) & (np.bitwise_count(fp[1:] ^ fp[:-1]) <= most))
    least_labels(label, near, near + 1)
    levels = levels_of(fp, group)
    top = len(levels) - 1
    roots = np.arange(len(levels[top].held))
    roots = roots[np.diff(levels[top].member) > 1]
    none = np.zeros(len(roots), dtype=U64)
    # what is still to be opened: level, two nodes, differences so far, and the bits in which those were counted
    waiting = [(top, roots, roots, none, none)]
    while waiting:
        at, a, b, apart, seen = waiting.pop()
        if len(a) > CHUNK_PAIRS // FAN**2:
            half = len(a) // 2
            waiting += (at, a[half:], b[half:], apart[half:], seen[half:]), (at, a[:half], b[:half], apart[:half], seen[:half])
            continue
        if at:
            # a node with itself is opened unless it is one component; two nodes unless all members are in the same one
            member, low, high = levels[at].member, [], []
            for nodes in (a, b):
                first = np.column_stack([member[nodes], member[nodes + 1]]).ravel()
                padded = np.append(label, 0)
                low.append(np.minimum.reduceat(padded, first)[::2]), high.append(np.maximum.reduceat(padded, first)[::2])
            mixed = (low[0] != high[0]) | (low[1] != high[1]) | (low[0] != low[1])
            a, b, apart, seen = a[mixed], b[mixed], apart[mixed], seen[mixed]
            pair, a, b = opened(levels[at], a, b)
            apart, seen = apart[pair], seen[pair]
            level = levels[at - 1]
            both = level.held[a] & level.held[b]
            apart = apart + np.bitwise_count((level.ones[a] ^ level.ones[b]) & both & ~seen)
            near = (apart <= most) & ((a != b) | (at > 1))
            if near.any():
                waiting.append((at - 1, a[near], b[near], apart[near], both[near]))
        else:
            least_labels(label, a, b)
    return label


def links_in(groups_: DataFrame, most: int) -> DataFrame:
    """(a, b): each fingerprint's link to the least of its component, for every group."""

    def spanning(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((gray_rank(fp), key))
        key, fp = key[order], fp[order]
        alone = np.ones(len(key), dtype=bool)
        same = key[1:] == key[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        key, fp = key[~alone], fp[~alone]
        label = joined(fp, key, most)
        linked = label != np.arange(len(fp))
        return pa.RecordBatch.from_arrays([pa.array(signed(fp[linked])), pa.array(signed(fp[label[linked]]))], ["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            held.append(np.stack([batch.column(c).to_numpy().view(U64) for c in ("key", "fp")]))
            n += batch.num_rows
            if n >= CHUNK_ROWS:
                rows = np.hstack(held)
                # the last group may go on in the next batch
                end = int(np.argmax(rows[0] == rows[0, -1]))
                if end:
                    yield spanning(rows[0, :end], rows[1, :end])
                held, n = [rows[:, end:]], rows.shape[1] - end
        if n:
            rows = np.hstack(held)
            yield spanning(rows[0], rows[1])

    return groups_.repartition("key").sortWithinPartitions("key").mapInArrow(work, "a long, b long")


def linked(prints: DataFrame, key: str = "doc_id", most: int = 3, limit: int = GROUP_ROWS) -> DataFrame:
    """Adds ``class_id`` (the least id of the same fingerprint) and ``component_id`` to rows with ``__fp``; they are read more than once."""
    distinct = shared_checkpoint(prints.groupBy(F.col("__fp").alias("fp")).agg(F.min(key).alias("class_id")))
    n = distinct.count()
    sent = F.broadcast if n <= BROADCAST_ROWS else lambda df: df
    labels = connected_components(links_in(groups(distinct, most, limit), most))
    classes = distinct.join(sent(labels.withColumnRenamed("node", "fp")), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = classes.groupBy("label").agg(F.min("class_id").alias("component_id"))
    by_print = classes.join(sent(least), "label").select(F.col("fp").alias("__fp"), "class_id", "component_id")
    return prints.join(sent(by_print), "__fp")


def simhash_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 3, most: int = 3) -> DataFrame:
    """Adds ``fingerprint`` (16 hexadecimal digits), ``class_id`` and ``component_id``.  The columns are written to the shared folder once;
    leave out those that aren't needed later, such as the text, by ``with_fingerprints`` and ``linked``."""
    own = ["fingerprint", "class_id", "component_id"]
    inner, held = sheltered(docs)
    found = linked(shared_checkpoint(with_fingerprints(inner, held[text], size)), held[key], most)
    return found.select(*[F.col(held[c]).alias(c) for c in docs.columns if c not in own], hexadecimal().alias("fingerprint"), "class_id", "component_id")


def hexadecimal():
    return F.lower(F.lpad(F.hex("__fp"), 16, "0"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = shared_checkpoint(with_fingerprints(read_documents(spark, sf_dir, "text")).select("doc_id", "__fp"))
    return linked(prints).select("doc_id", hexadecimal().alias("fingerprint"), "component_id")
