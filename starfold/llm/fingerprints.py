"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs.

A text is a multiset of paragraphs: its lines, and a line's sentences-sized spans where a line is long (a span
ends after ``SPAN_WORDS`` words at most, at a word whose hash says so where there is one before, so that an insertion moves
only the nearest borders).  The k-th equal paragraph of a text gets a digest of its own, so a multiset becomes a set.

Each digest goes to three cells, one in each third of the table; a cell holds a count, the xor of digests and the xor of
their checks.  Tables subtract cell by cell; peeling the pure cells of the difference gives the digests that only one text has.
Where peeling stops early, both tables are made again four times as large, until it succeeds.

Likeness is the Jaccard index of the two digest sets, from the number of recovered differences.

Neighbours in descending doc_id order come from blocks of the id range: border ids are ids of the table, and the
document of a border is also sent to the block above it, so that each block is worked through as a stream.

Defined results: a null text counts as empty; an empty text has no paragraphs, and two empty texts are alike 1.0;
rows with a null doc_id stand after all others; rows of equal doc_id stand in text order; a table of one row has itself as next; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Runs, WordBlock, mix64, read_documents

#: Cells of the sketch that is the fingerprint.
BASE_CELLS = 24
SPAN_WORDS = 24
#: A word ends a span with a chance of one in this.
SPAN_ODDS = 8
HASHES = 3
#: Where a table of so many cells for each digest can't be peeled, digests collide and are compared as sets.
MAX_CELLS_PER_DIGEST = 256


def paragraph_digests(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, digests): the digests of text ``d`` are ``digests[first[d]:first[d + 1]]``, all different."""
    block = WordBlock(data, offsets)
    n = len(block.start)
    if not n:
        return np.zeros(len(offsets), dtype=np.int64), np.zeros(0, dtype=U64)
    words = block.hash
    breaks = np.concatenate([[0], np.cumsum(data == 0x0A)])
    line = breaks[block.start]
    doc = np.repeat(np.arange(len(offsets) - 1), block.counts())
    opens = np.ones(n, dtype=bool)
    opens[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1]) | (words[:-1] % U64(SPAN_ODDS) == 0)
    # a span without a border in it is cut after SPAN_WORDS words
    starts = np.flatnonzero(opens)
    since = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    starts = np.flatnonzero(opens | (since % SPAN_WORDS == 0))
    digest = Runs(words).of(starts, np.append(starts[1:], n))
    owner = doc[starts]
    # k-th occurrence within a text
    order = np.lexsort((digest, owner))
    d, o = digest[order], owner[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    nth = np.arange(len(d)) - np.repeat(at, np.diff(np.append(at, len(d))))
    return np.searchsorted(o, np.arange(len(offsets))), mix64(d + nth.astype(U64) * U64(0x9FB21C651E98DF25))


def check_of(digest: np.ndarray) -> np.ndarray:
    return mix64(digest ^ U64(0xB492B66FBE98F273))


def cells_of(digest: np.ndarray, cells: int) -> list[np.ndarray]:
    third = U64(cells // HASHES)
    return [(mix64(digest + U64((j + 1) * 0x9DDFEA08EB382D69 % 2**64)) % third + U64(j) * third).astype(np.int64) for j in range(HASHES)]


def tables(owner: np.ndarray, digest: np.ndarray, sign: np.ndarray, n: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sketches of ``n`` owners: counts, digest xors and check xors, each ``n * cells``."""
    count = np.zeros(n * cells, dtype=np.int64)
    keys, checks = np.zeros(n * cells, dtype=U64), np.zeros(n * cells, dtype=U64)
    check = check_of(digest)
    for at in cells_of(digest, cells):
        at = at + owner * cells
        np.add.at(count, at, sign)
        np.bitwise_xor.at(keys, at, digest)
        np.bitwise_xor.at(checks, at, check)
    return count, keys, checks


def peel(count: np.ndarray, keys: np.ndarray, checks: np.ndarray, n: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Peels the differences of ``n`` pairs at once: owners and digests that were recovered, and which pairs are done."""
    owners, digests = [], []
    look = np.arange(n * cells)
    while len(look):
        pure = look[(np.abs(count[look]) == 1)]
        pure = pure[checks[pure] == check_of(keys[pure])]
        if not len(pure):
            break
        owner, digest, sign = pure // cells, keys[pure], count[pure]
        order = np.lexsort((digest, owner))
        owner, digest, sign = owner[order], digest[order], sign[order]
        one = np.ones(len(owner), dtype=bool)
        one[1:] = (owner[1:] != owner[:-1]) | (digest[1:] != digest[:-1])
        owner, digest, sign = owner[one], digest[one], sign[one]
        owners.append(owner), digests.append(digest)
        check, touched = check_of(digest), []
        for at in cells_of(digest, cells):
            at = at + owner * cells
            np.subtract.at(count, at, sign)
            np.bitwise_xor.at(keys, at, digest)
            np.bitwise_xor.at(checks, at, check)
            touched.append(at)
        look = np.unique(np.concatenate(touched))
    done = ~((count.reshape(n, cells) != 0).any(axis=1) | (keys.reshape(n, cells) != 0).any(axis=1))
    empty = np.zeros(0, dtype=np.int64)
    return (np.concatenate(owners) if owners else empty), (np.concatenate(digests) if digests else empty.astype(U64)), done


def spans(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the digests of ``rows``, and the place in ``rows`` that each belongs to."""
    size = first[rows + 1] - first[rows]
    owner = np.repeat(np.arange(len(rows)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[rows], size), owner


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Jaccard index of the digest sets of text ``d`` of ``a`` and text ``d`` of ``b``, by subtraction and peeling."""
    n = len(a[0]) - 1
    sizes = np.diff(a[0]) + np.diff(b[0])
    differing = np.zeros(n, dtype=np.int64)
    left, cells = np.arange(n), BASE_CELLS
    while len(left):
        pa_, oa = spans(a[0], left)
        pb_, ob = spans(b[0], left)
        digest = np.concatenate([a[1][pa_], b[1][pb_]])
        sign = np.concatenate([np.ones(len(pa_), dtype=np.int64), -np.ones(len(pb_), dtype=np.int64)])
        owner, _, done = peel(*tables(np.concatenate([oa, ob]), digest, sign, len(left), cells), len(left), cells)
        found = np.bincount(owner, minlength=len(left))
        differing[left[done]] = found[done]
        left, cells = left[~done], cells * 4
        if cells > MAX_CELLS_PER_DIGEST * max(1, int(sizes[left].max(initial=0))):  # two digests with equal cells: compare as sets
            for d in left:
                differing[d] = len(np.setxor1d(a[1][a[0][d] : a[0][d + 1]], b[1][b[0][d] : b[0][d + 1]]))
            break
    shared = (sizes - differing) / 2
    return np.where(sizes > 0, shared / np.maximum(shared + differing, 1), 1.0)


def sketch_text(digests: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """The fingerprint: number of paragraphs and the base table, as hexadecimal text."""
    n = len(digests[0]) - 1
    owner = np.repeat(np.arange(n), np.diff(digests[0]))
    count, keys, checks = tables(owner, digests[1], np.ones(len(owner), dtype=np.int64), n, BASE_CELLS)
    cell = np.zeros(n * BASE_CELLS, dtype=[("count", "<u4"), ("key", "<u8"), ("check", "<u4")])
    cell["count"], cell["key"], cell["check"] = count, keys, checks & U64(0xFFFFFFFF)
    raw, width = cell.tobytes(), 16 * BASE_CELLS
    return [f"{int(size):x}:{raw[i * width : (i + 1) * width].hex()}" for i, size in enumerate(np.diff(digests[0]))]


def digests_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "replace") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    return paragraph_digests(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as many code points from the start of ``following``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


#: Code points that are compared at once in a task.
GROUP_CHARS = 1_000_000


def compare_group(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    changed = [edited(t, f) for t, f in zip(texts, following)]
    own, other, after = digests_of(texts), digests_of(changed), digests_of(following)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed], pa.string()),
            pa.array(sketch_text(own), pa.string()),
            pa.array(sketch_text(other), pa.string()),
            pa.array(likeness(own, other), pa.float64()),
            pa.array(likeness(own, after), pa.float64()),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks in (block, descending doc_id) order; a row with ``border`` only follows others."""
    held: tuple | None = None  # (block, id, text) that still waits for its next document
    ids: list = []
    texts: list[str] = []
    following: list[str] = []
    size = 0
    for batch in batches:
        for block, doc, text, border in zip(batch.column("block").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("border").to_pylist()):
            text = text.as_py()
            if held is not None and held[0] == block:
                ids.append(held[1]), texts.append(held[2]), following.append(text)
                size += len(held[2]) + len(text)
                held = None
            if not border:
                held = (block, doc, text)
            if size >= GROUP_CHARS:
                yield compare_group(ids, texts, following)
                ids, texts, following, size = [], [], [], 0
    if ids:
        yield compare_group(ids, texts, following)


def block_of(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are less than ``key`` (0 for NULL): first among every so many of them, then among those between."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    below = lambda values: F.size(F.filter(values, lambda c: c < key))
    begin = F.greatest(below(F.lit(cuts[::step])) - 1, F.lit(0)) * step
    return F.when(key.isNull(), 0).otherwise(begin + below(F.slice(F.lit(cuts), begin + 1, F.lit(step))))


def versions(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Compares each document with its edited text and with the next document (see the module's text)."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks or 8 * partitions
    base = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)] or [0.5], 10 * blocks).alias("cuts"), F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    if not found["n"]:
        return spark.createDataFrame([], SCHEMA)
    top = found["top"]
    cuts = sorted(set(found["cuts"] or []) - {top})
    # block k holds (cuts[k - 1], cuts[k]]; a null id is the lowest.  The document at cuts[k] also follows block k + 1's last.
    block = block_of(F.col("doc_id"), cuts)
    is_border = F.coalesce(F.get(F.lit(cuts), block) == F.col("doc_id"), F.lit(False)) if cuts else F.lit(False)
    follows = F.when(is_border, block + 1).when(F.col("doc_id").eqNullSafe(F.lit(top).cast("long")), F.lit(0))
    places = F.filter(F.array(F.struct(block.alias("block"), F.lit(False).alias("border")), F.struct(follows.alias("block"), F.lit(True).alias("border"))), lambda x: x["block"].isNotNull())
    rows = base.select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", "p.block", "p.border")
    ordered = rows.repartition(partitions, "block").sortWithinPartitions("block", "border", F.col("doc_id").desc_nulls_last(), "text")
    return ordered.mapInArrow(compare_stream, SCHEMA)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions(read_documents(spark, sf_dir, "text"))
