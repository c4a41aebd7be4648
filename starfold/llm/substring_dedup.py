"""Substring dedup: seed and extend.

Seeds are winnowed anchors: of every ``min_words - SEED_WORDS + 1`` consecutive seeds (runs of ``SEED_WORDS`` words) the
rightmost of least hash is an anchor, so two equal runs of ``min_words`` words have an anchor at the same place.  Documents are
joined on their anchors by a sort on (anchor, context), where the context is the anchor extended to both sides as far as a
window that holds it can reach:

* places with equal context match all over it: it is repeated as a whole, whatever the number of copies (within one document this
  is settled before the sort);
* of places with equal anchor but different contexts, the first and last of each context are extended window by
  window, and windows that occur at two places are repeated.  Copies of one context add nothing to this.

No pairs of places are made.  Repeated windows that touch join into maximal repeats.

Defined results: null and empty texts have no words; rows of equal doc_id are documents of their own unless their texts
are equal too; a row that occurs twice repeats the other; ids may be null; an empty table gives an empty result;
extra columns are kept by :func:`substring_dedup` (its own names win).
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, Runs, WordBlock, arrow_map, list_array, mix64, read_documents, shared_checkpoint, sheltered, signed, text_blocks

MIN_WORDS = 35
SEED_WORDS = 10
_KEY = ["__id", "__sig"]
_KEY_SCHEMA = "__id long, __sig long"


def winnow(seed: np.ndarray, window: int) -> np.ndarray:
    """Place of the rightmost least value in each run of ``window`` values, by doubling."""
    at, size = np.arange(len(seed)), 1
    while size < window:
        step = min(size, window - size)
        if len(at) <= step:
            return at[:0]
        a, b = at[:-step], at[step:]
        at = np.where(seed[b] <= seed[a], b, a)
        size += step
    return at


def anchors(words: np.ndarray, first: np.ndarray, min_words: int, seed_words: int) -> tuple[np.ndarray, ...]:
    """(place, document, hash, context hash) of the anchors of a block of documents."""
    docs, reach = len(first) - 1, min_words - seed_words
    doc = np.repeat(np.arange(docs), np.diff(first))
    if len(words) < min_words:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(U64), none.astype(U64)
    end = first[1:][doc]
    runs = Runs(words)
    places = np.arange(len(words) - seed_words + 1)
    seed = runs.of(places, places + seed_words)
    least = winnow(seed, reach + 1)
    chosen = np.zeros(len(seed), dtype=bool)
    whole = np.flatnonzero(np.arange(len(least)) + min_words <= end[: len(least)])
    chosen[least[whole]] = True
    at = np.flatnonzero(chosen)
    lo, hi = np.maximum(first[:-1][doc[at]], at - reach), np.minimum(end[at], at + seed_words + reach)
    context = Runs(words, 1).of(lo, hi) + mix64(((at - lo) * 4096 + (hi - at)).astype(U64))
    return at, doc[at], seed[at], context


def within(doc: np.ndarray, seed: np.ndarray, context: np.ndarray, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(own, seed): which anchors stand twice in their document with equal context, which is known without others.

    Only the first of such a run keeps its hash for the others to meet; the rest get hashes of their own, so that a text that
    repeats itself sends no more than one row to one place.
    """
    order = np.lexsort((at, context, seed, doc))
    same = (np.diff(doc[order]) == 0) & (np.diff(seed[order]) == 0) & (np.diff(context[order]) == 0)
    again, followed = np.zeros(len(at), dtype=bool), np.zeros(len(at), dtype=bool)
    again[order[1:]], followed[order[:-1]] = same, same
    alone = mix64(keys[doc] + at.astype(U64) * U64(0x8EBC6AF09C88C6E3))
    return again | followed, np.where(again, alone, seed)


def flagged(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Booleans for ``range(n)`` that are true in some ``[lo, hi)``."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, lo, 1)
    np.add.at(step, hi, -1)
    return np.cumsum(step[:-1]) > 0


def list_offsets(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column; a null list is empty."""
    if column.null_count:
        column = pa.array([x if x is not None else [] for x in column.to_pylist()], type=column.type)
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)


def find_repeats(base: DataFrame, min_words: int, seed_words: int) -> tuple[DataFrame, DataFrame]:
    """``base`` has __id, __sig, __text.  Gives marks (places of anchors: covered, extended) and starts of repeated windows."""
    reach = min_words - seed_words

    def seeds(batch: pa.RecordBatch) -> pa.RecordBatch:
        places, hashes, contexts, owns, sizes = [], [], [], [], []
        keys = mix64(batch.column("__id").to_numpy().astype(U64)) + batch.column("__sig").to_numpy().astype(U64)
        for lo, hi, data, offsets in text_blocks(batch.column("__text")):
            block = WordBlock(data, offsets)
            at, doc, seed, context = anchors(block.hash, block.first, min_words, seed_words)
            own, seed = within(doc, seed, context, at, keys[lo:hi])
            places.append(at - block.first[doc]), hashes.append(seed), contexts.append(context), owns.append(own)
            sizes.append(np.bincount(doc, minlength=len(offsets) - 1))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        lists = [list_array(offsets, np.concatenate(places), pa.int32()), list_array(offsets, signed(np.concatenate(hashes)), pa.int64()), list_array(offsets, signed(np.concatenate(contexts)), pa.int64()), list_array(offsets, np.concatenate(owns), pa.bool_())]
        return pa.RecordBatch.from_arrays([batch.column(c) for c in _KEY] + lists, [*_KEY, "p", "a", "c", "own"])

    found = arrow_map(base, seeds, f"{_KEY_SCHEMA}, p array<int>, a array<long>, c array<long>, own array<boolean>")
    rows = found.select(*_KEY, F.inline(F.arrays_zip("p", "a", "c", "own")))
    near = Window.partitionBy("a").orderBy("c", *_KEY, "p")
    before, after = F.lag("c").over(near), F.lead("c").over(near)
    covered = F.col("own") | F.coalesce(before == F.col("c"), F.lit(False)) | F.coalesce(after == F.col("c"), F.lit(False))
    extended = F.coalesce(before != F.col("c"), F.lit(False)) | F.coalesce(after != F.col("c"), F.lit(False))
    marked = rows.select(*_KEY, "p", covered.alias("covered"), extended.alias("extended")).filter("covered or extended")
    own = lambda flag: F.collect_list(F.when(F.col(flag), F.col("p"))).alias(flag)
    marks = shared_checkpoint(marked.groupBy(*_KEY).agg(own("covered"), own("extended")))

    def windows(batch: pa.RecordBatch) -> pa.RecordBatch:
        offsets_p, places = list_offsets(batch.column("extended"))
        starts, one, two, sizes = [], [], [], []
        for lo, hi, data, offsets in text_blocks(batch.column("__text")):
            block = WordBlock(data, offsets)
            words, first = block.hash, block.first
            place = places[offsets_p[lo] : offsets_p[hi]]
            doc = np.repeat(np.arange(hi - lo), np.diff(offsets_p[lo : hi + 1]))
            at = place + first[doc]
            begin = np.maximum(first[doc], at - reach)
            end = np.minimum(at, first[doc + 1] - min_words) + 1
            s = np.flatnonzero(flagged(len(words), begin, np.maximum(begin, end)))
            owner = np.searchsorted(first, s, side="right") - 1
            starts.append(s - first[owner]), one.append(Runs(words).of(s, s + min_words)), two.append(Runs(words, 1).of(s, s + min_words))
            sizes.append(np.bincount(owner, minlength=hi - lo))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        lists = [list_array(offsets, np.concatenate(starts), pa.int32()), list_array(offsets, signed(np.concatenate(one)), pa.int64()), list_array(offsets, signed(np.concatenate(two)), pa.int64())]
        return pa.RecordBatch.from_arrays([batch.column(c) for c in _KEY] + lists, [*_KEY, "s", "h", "g"])

    text = base.repartition(*_KEY)
    wanted = text.join(marks.filter(F.size("extended") > 0).select(*_KEY, "extended"), _KEY)
    opened = arrow_map(wanted, windows, f"{_KEY_SCHEMA}, s array<int>, h array<long>, g array<long>").select(*_KEY, F.inline(F.arrays_zip("s", "h", "g")))
    same = Window.partitionBy("h", "g").orderBy(*_KEY, "s")
    twice = opened.select(*_KEY, "s", (F.lag("s").over(same).isNotNull() | F.lead("s").over(same).isNotNull()).alias("twice")).filter("twice")
    starts = twice.groupBy(*_KEY).agg(F.collect_list("s").alias("starts"))
    return marks, starts


def repeated_words(block: WordBlock, covered: tuple, starts: tuple, lo: int, hi: int, min_words: int, seed_words: int) -> np.ndarray:
    """Booleans for the words of a block: covered by a repeated window."""
    reach, first = min_words - seed_words, block.first
    at = covered[1][covered[0][lo] : covered[0][hi]]
    doc = np.repeat(np.arange(hi - lo), np.diff(covered[0][lo : hi + 1]))
    at = at + first[doc]
    begin, end = [np.maximum(first[doc], at - reach)], [np.minimum(first[doc + 1], at + seed_words + reach)]
    s = starts[1][starts[0][lo] : starts[0][hi]]
    doc = np.repeat(np.arange(hi - lo), np.diff(starts[0][lo : hi + 1]))
    begin.append(s + first[doc]), end.append(s + first[doc] + min_words)
    return flagged(len(block.start), np.concatenate(begin), np.concatenate(end))


def substring_dedup(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, seed_words: int = SEED_WORDS, digest: bool = False) -> DataFrame:
    """Removes every word that is covered by a run of ``min_words`` words which occurs twice.

    Adds ``n_words``, ``n_removed``, ``spans`` (maximal repeats: first word, end word) and the new text, in which the
    rest stands as it stood.  With ``digest`` the text is replaced by ``kept_sha256``, of the kept words joined by one space.
    """
    made = ["n_words", "n_removed", "spans", "kept_sha256" if digest else text]
    inner, held = sheltered(docs)
    kept = [c for c in docs.columns if c != text and c not in made]
    key = {"__id": F.coalesce(F.col(held["doc_id"]).cast("long"), F.lit(-(2**63))), "__sig": F.xxhash64("__text")}
    keyed = inner.withColumn("__text", F.coalesce(F.col(held[text]), F.lit(""))).withColumns(key).select(*_KEY, *[held[c] for c in kept], "__text")
    base = keyed.select(*_KEY, "__text")
    marks, starts = find_repeats(base, min_words, seed_words)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        covered, begun = list_offsets(batch.column("covered")), list_offsets(batch.column("starts"))
        n_words, n_removed, spans, out = [], [], [], []
        column = batch.column("__text")
        for lo, hi, data, offsets in text_blocks(column):
            block = WordBlock(data, offsets)
            gone = repeated_words(block, covered, begun, lo, hi, min_words, seed_words)
            raw = data.tobytes()
            for i in range(hi - lo):
                a, b = block.first[i], block.first[i + 1]
                mask = gone[a:b]
                n_words.append(b - a)
                removed = int(mask.sum())
                n_removed.append(removed)
                edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]))).reshape(-1, 2) if removed else np.zeros((0, 2), dtype=np.int64)
                spans.append([{"first": int(x), "end": int(y)} for x, y in edge])
                own = raw[offsets[i] : offsets[i + 1]]
                if digest:
                    words = own.split()
                    out.append(hashlib.sha256(b" ".join(compress(words, ~mask) if removed else words)).hexdigest())
                elif removed:
                    begins = np.append(block.start[a:b], offsets[i + 1]) - offsets[i]
                    parts, at = [], 0
                    for x, y in edge:
                        parts.append(own[at : begins[x]])
                        at = begins[y]
                    out.append(b"".join([*parts, own[at:]]).decode("utf-8", "replace"))
                else:
                    out.append(column[lo + i].as_py())
        span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, span), pa.array(out, pa.string())]
        return pa.RecordBatch.from_arrays([batch.column(held[c]) for c in kept] + columns, [*kept, *made])

    text_part = base.repartition(*_KEY) if set(kept) <= {"doc_id"} else keyed
    joined = text_part.join(marks.select(*_KEY, "covered"), _KEY, "left").join(starts, _KEY, "left")
    if text_part is not keyed:
        joined = joined.withColumn(held["doc_id"], F.nullif("__id", F.lit(-(2**63))).cast(dict(docs.dtypes)["doc_id"]))
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "n_words long, n_removed long, spans array<struct<first: int, end: int>>", f"`{made[3]}` string"])
    return arrow_map(joined.select(*[held[c] for c in kept], "__text", "covered", "starts"), cut, schema)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(read_documents(spark, sf_dir, "text"), digest=True)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")
