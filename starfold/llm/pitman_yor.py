"""LM scoring by a hierarchical Pitman-Yor model of words after the word before them.

Every word (and the start of a text) is a context with a restaurant of the words that follow it, the end of a text among them.  The
parent of all of these is the restaurant of words; its parent is a spelling model: restaurants of symbols after the last three, two, one
and no symbols of the word, each the parent of those with one symbol more, over a flat base.  Symbols are classes of bytes, so the
spelling model has a bounded size; of the longest contexts only what was seen is kept.

Seating is sampled by Gibbs sweeps at all levels.  In a sweep each dish's customers leave and are seated again one after another by the
Chinese-restaurant rule, given the number of the restaurant's tables and the parent's probabilities; every table then sends one customer
to the parent.  The restaurant of words is seated first, given the tables of the sweep before, then the contexts, given its new
probabilities.  Dishes are reseated in parallel; large dishes in growing steps (a binomial draw of new tables in each).  After
``BURN_IN`` sweeps the predictive probabilities are averaged over ``SAMPLES`` sweeps.

A word that the training texts lack has the share of a new table of words that its own spelling gets, so that the probabilities of all
strings after a context sum to 1.

Words and contexts live at a home by hash of the word.  Tasks gather the texts of their input, some megabytes at a time, and send one
packed row to each home: its words, and for its contexts there the words that follow, so a pair that occurs once costs a few bytes.  Homes
send each other one array a sweep: tables up, probabilities down.  For scoring, texts are dealt into blocks; a block asks each home once and
is answered with the counts and tables that its words and pairs have there, small numbers from which it makes the probabilities itself.
Homes keep their words and pairs sorted, and draws depend on the sweep and the home only, so results don't depend on how rows are dealt.

Defined results: a null text counts as empty and is its end alone; without learnable texts every count is 0 and every
probability 1; repeated rows are scored alike and counted each; null ids are learned from; a text is worked on whole, a long one is a
block's part like any other; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, U64, WordBlock, is_held_out, read_documents, release, shared_checkpoint

BURN_IN, SAMPLES = 2, 3
#: Bytes of text that are packed, and scored, at once.
BLOCK_TEXT = 16_000_000
# Discounts of the contexts of 0, 1, 2 and 3 symbols, and the strength of all restaurants.
SPELL_DISCOUNT = (0.3, 0.5, 0.6, 0.7)
STRENGTH = 1.0
#: Rows between blocks and homes, and what they hold.  Samples have the kinds WORDS + k and CONTEXTS + k.
ROWS = "home int, frm int, kind int, data binary"
STATE, LINK, TABLES, PLACES, CHANCES, SPELLING, TOTALS, ASKED, ANSWER = range(9)
WORDS, CONTEXTS = 100, 200

# The classes of bytes.  The last two symbols are the end and the start of a word.
SYMBOLS = [bytes([c]) for c in range(97, 123)] + [b"0123456789"] + [bytes([c]) for c in b".,!?|'-"]
SYMBOLS += [bytes(c for c in range(128) if not any(c in s for s in SYMBOLS))]
SYMBOLS += [b"\xc3", bytes(c for c in range(0xC0, 0xE0) if c != 0xC3), bytes(range(0xE0, 0x100))]
SYMBOLS += [bytes(range(c, c + 8)) for c in range(0x80, 0xC0, 8)]
END, START = len(SYMBOLS), len(SYMBOLS) + 1
SIZE = len(SYMBOLS) + 2
_SYMBOL = np.zeros(256, dtype=np.int64)
_WITHIN = np.zeros(SIZE)
for _k, _bytes in enumerate(SYMBOLS):
    _SYMBOL[list(_bytes)] = _k
    _WITHIN[_k] = -np.log(len(_bytes))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def seat(customers: np.ndarray, base: np.ndarray, discount: float, draw: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers sit down one by one; ``base`` is the weight of a new table."""
    tables = np.minimum(customers, 1).astype(np.float64)
    active, seated = np.flatnonzero(customers > 1), 1
    while len(active):
        step = np.minimum(max(1, seated // 8), customers[active] - seated)
        weight = base[active]
        tables[active] += draw.binomial(step, weight / (weight + seated - discount * tables[active]))
        seated += max(1, seated // 8)
        active = active[customers[active] > seated]
    return tables


def spell_keys(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, within, first): for each symbol of each word (its end included) the three symbols before it and itself as
    one number, the log-probability of the byte within its class, and where each word begins."""
    sizes = np.array([len(w) for w in words], dtype=np.int64) + 1
    first = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    symbol = np.full(total, END, dtype=np.int64)
    ends = np.zeros(total, dtype=bool)
    ends[first + sizes - 1] = True
    symbol[~ends] = _SYMBOL[np.frombuffer(b"".join(words), dtype=np.uint8)]
    since = np.arange(total) - np.repeat(first, sizes)
    key = symbol.copy()
    for k in range(1, 4):
        before = np.full(total, START, dtype=np.int64)
        before[k:] = symbol[:-k] if total > k else symbol[:0]
        key += np.where(since >= k, before, START) * SIZE**k
    return key, _WITHIN[symbol], first


def spell(words: list[bytes], log_p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log-probability of each word's spelling, keys, first)."""
    if not words:
        return np.zeros(0), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    key, within, first = spell_keys(words)
    return np.add.reduceat(log_p[key] + within, first), key, first


def spelled_in(words: list[bytes], samples: list[Sample]) -> list[np.ndarray]:
    """Probability of each word's spelling in each sample."""
    if not words:
        return [np.zeros(0)] * len(samples)
    key, within, first = spell_keys(words)
    return [np.exp(np.add.reduceat(s.spelling.log_table()[key] + within, first)) for s in samples]


@dataclass
class Spelling:
    """Restaurants of symbols.  ``levels`` are predictive probabilities after 0, 1 and 2 symbols; after three, ``keys`` (sorted) are the seen
    dishes, ``own`` what their tables give and ``share`` the part of each context that its parent gives.  ``opened`` are the tables of each
    context of each level, for the next sweep."""

    levels: list[np.ndarray]
    keys: np.ndarray
    own: np.ndarray
    share: np.ndarray
    opened: list[np.ndarray]

    @classmethod
    def flat(cls) -> Spelling:
        levels = [np.full(SIZE ** (k + 1), 1 / (SIZE - 1)) for k in range(3)]
        return cls(levels, np.zeros(0, dtype=np.int64), np.zeros(0), np.ones(SIZE**3), [np.ones(SIZE**k) for k in range(4)])

    def log_table(self) -> np.ndarray:
        """Log-probabilities by the four symbols' number, made where they are looked up."""
        p = np.repeat(self.share.astype(np.float32), SIZE)
        p *= np.tile(self.levels[2].astype(np.float32), SIZE)
        p[self.keys] += self.own.astype(np.float32)
        return np.log(np.maximum(p, 1e-38))

    def sent(self) -> Spelling:
        """What tasks need."""
        return Spelling([None, None, self.levels[2].astype(np.float32)], self.keys.astype(np.int32), self.own.astype(np.float32), self.share.astype(np.float32), [])


def sample_spelling(keys: np.ndarray, customers: np.ndarray, before: Spelling, draw: np.random.Generator) -> Spelling:
    """One Gibbs sweep over the restaurants of symbols, longest contexts first; ``customers`` of the sorted dishes ``keys`` come from the words' tables."""
    d, count = SPELL_DISCOUNT[3], customers.astype(np.int64)
    above = before.levels[2][keys % SIZE**3]
    tables = seat(count, (STRENGTH + d * before.opened[3][keys // SIZE]) * above, d, draw)
    seated, opened = (np.bincount(keys // SIZE, x, SIZE**3) for x in (count, tables))
    own, share = np.maximum(count - d * tables, 0) / (STRENGTH + seated[keys // SIZE]), (STRENGTH + d * opened) / (STRENGTH + seated)
    held, all_opened = [], [opened]
    came = np.bincount(keys % SIZE**3, tables, SIZE**3).astype(np.int64)
    for k in (2, 1, 0):
        d, dishes, t = SPELL_DISCOUNT[k], np.flatnonzero(came), np.zeros(len(came))
        above = before.levels[k - 1][dishes % SIZE**k] if k else np.full(len(dishes), 1 / (SIZE - 1))
        t[dishes] = seat(came[dishes], (STRENGTH + d * before.opened[k][dishes // SIZE]) * above, d, draw)
        held.append((came, t))
        all_opened.append(t.reshape(-1, SIZE).sum(axis=1))
        came = np.bincount(np.arange(len(t)) % SIZE**k, t, SIZE**k).astype(np.int64)
    levels, below = [], np.full(SIZE, 1 / (SIZE - 1))
    for k, (c, t) in enumerate(reversed(held)):
        d = SPELL_DISCOUNT[k]
        seated, opened = c.reshape(-1, SIZE).sum(axis=1), t.reshape(-1, SIZE).sum(axis=1)
        below = (np.maximum(c - d * t, 0) + np.repeat(STRENGTH + d * opened, SIZE) * np.tile(below, len(c) // len(below))) / np.repeat(STRENGTH + seated, SIZE)
        levels.append(below)
    return Spelling(levels, keys, own, share, all_opened[::-1])


def packed(*parts) -> bytes:
    """Arrays go as byte planes: all their lowest bytes, then the next ones, which are nearly constant for small numbers."""
    held = [(x.dtype.str, np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()) if isinstance(x, np.ndarray) else [x] for x in parts]
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(held, 5))


def unpacked(data: bytes) -> list:
    out = []
    for x in pickle.loads(zstandard.ZstdDecompressor().decompress(data)):
        if isinstance(x, list):
            out.append(x[0])
        else:
            kind = np.dtype(x[0])
            planes = np.frombuffer(x[1], dtype=np.uint8).reshape(kind.itemsize, -1)
            out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
    return out


def joined(words: list[bytes]) -> tuple[int, bytes]:
    """Words have no spaces; the empty one is the end of a text, or its start as a context."""
    return len(words), b" ".join(words)


def parted(words: tuple[int, bytes]) -> list[bytes]:
    return words[1].split(b" ") if words[0] else []


def homes(words: list[bytes], blocks: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % blocks for w in words), dtype=np.int64, count=len(words))


def numbered(key: np.ndarray, bits: int, whole: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the first of each, number of each key's value, count of each) of the distinct values, in order.

    ``key`` has at most ``bits`` bits.  It is sorted together with its place, which is much faster than sorting places by it.  With
    ``whole``, keys are the leading bits of these values; if they don't tell them apart, the values themselves are sorted.
    """
    n = len(key)
    low = max(1, n.bit_length())
    if bits + low <= 63:
        both = np.sort(key.astype(np.int64) << low | np.arange(n))
        at, key = both & ((1 << low) - 1), both >> low
        new = np.append(True, key[1:] != key[:-1])[:n]
        if whole is None or not ((whole[at][1:] != whole[at][:-1]) & ~new[1:]).any():
            first = np.flatnonzero(new)
            number = np.empty(n, dtype=np.int32)
            number[at] = np.cumsum(new, dtype=np.int32) - 1
            return at[first], number, np.diff(np.append(first, n))
    _, first, number, count = np.unique(key if whole is None else whole, return_index=True, return_inverse=True, return_counts=True)
    return first, number, count


@dataclass
class Block:
    """Tokens of some texts as indices into their sorted words; the empty word, a text's end, is the first."""

    words: list[bytes]
    sizes: np.ndarray
    word: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, texts: Iterable[bytes]) -> Block:
        """Words are told apart by 64-bit hashes."""
        texts = list(texts)
        data = b"".join(texts).translate(_LOWER)
        offsets = np.cumsum([0, *map(len, texts)], dtype=np.int64)
        raw = np.frombuffer(data, dtype=np.uint8)
        starts, ends, hashes, counts, lo = [], [], [], [], 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK_BYTES, side="right")) - 1)
            part = WordBlock(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            starts.append(part.start + offsets[lo]), ends.append(part.end + offsets[lo]), hashes.append(part.hash), counts.append(part.counts())
            lo = hi
        none = np.zeros(0, dtype=np.int64)
        count, found = np.concatenate([none, *counts]), np.concatenate([none.astype(U64), *hashes])
        del hashes
        first, number, _ = numbered(found >> U64(23), 41, found)
        del found
        words = [data[a:b] for a, b in zip(np.concatenate([none, *starts])[first].tolist(), np.concatenate([none, *ends])[first].tolist())]
        del starts, ends, raw, data
        order = sorted(range(len(words)), key=words.__getitem__)
        rank = np.empty(len(words), dtype=np.int32)
        rank[order] = np.arange(1, len(words) + 1)
        sizes = count + 1
        last = np.cumsum(sizes) - 1
        word = np.zeros(int(sizes.sum()), dtype=np.int32)
        inside = np.ones(len(word), dtype=bool)
        inside[last] = False
        word[inside] = rank[number]
        # a text's first word comes after the empty word, which ended the text before it
        return cls([b"", *(words[k] for k in order)], sizes, word, np.roll(word, 1))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(context, word, count) of the distinct pairs, in order, and each token's pair."""
        key = self.before.astype(np.int64) * len(self.words) + self.word
        first, at, n = numbered(key, (len(self.words) ** 2).bit_length())
        return self.before[first], self.word[first], n, at


def by_home(rows: DataFrame, blocks: int, work: Callable[[int, list[tuple[int, int, bytes]]], Iterator[tuple[int, int, int, bytes]]]) -> DataFrame:
    """``work`` for each home on its rows (frm, kind, data), in a fixed order."""

    def run(table: pa.Table) -> pa.Table:
        got = sorted(zip(table.column("frm").to_pylist(), table.column("kind").to_pylist(), table.column("data").to_pylist()), key=lambda r: r[:2])
        return pa.table(as_rows(list(work(table.column("home")[0].as_py(), got))), ["home", "frm", "kind", "data"])

    return rows.repartition(blocks, "home").groupBy("home").applyInArrow(lambda t: run(t), ROWS)


def deal(docs: DataFrame, blocks: int) -> DataFrame:
    """Rows with their text and ``block``.  Copies of one row are dealt by the part of the input that they come from."""
    text = F.coalesce("text", F.lit(""))
    block = F.pmod(F.xxhash64("doc_id", text, F.spark_partition_id()), F.lit(blocks)).cast("int")
    return docs.select("doc_id", text.alias("text"), block.alias("block")).repartition(blocks, "block")


def messages(block: Block, blocks: int, frm: int, counted: bool) -> list[tuple[int, int, int, bytes]]:
    """For each home: the words there, and for each of them, as a context, the words that follow; ``counted`` with their counts."""
    own = homes(block.words, blocks)
    context, word, times, _ = block.pairs()
    n = np.bincount(block.word, minlength=len(block.words))
    by_word, by_pair = np.argsort(own, kind="stable"), np.argsort(own[context], kind="stable")
    word_edges, pair_edges = (np.searchsorted(x, np.arange(blocks + 1)) for x in (own[by_word], own[context][by_pair]))
    out = []
    for home in np.flatnonzero(np.diff(word_edges)):
        here, pair = by_word[word_edges[home] : word_edges[home + 1]], by_pair[pair_edges[home] : pair_edges[home + 1]]
        after, at = np.unique(word[pair], return_inverse=True)
        sizes = np.bincount(np.searchsorted(here, context[pair]), minlength=len(here)).astype(np.int32)
        more = (n[here].astype(np.int32), times[pair].astype(np.int32)) if counted else ()
        out.append((int(home), frm, ASKED, packed(joined([block.words[k] for k in here]), sizes, joined([block.words[k] for k in after]), at.astype(np.int32), *more)))
    return out


def as_rows(out: list[tuple[int, int, int, bytes]]) -> list[pa.Array]:
    columns = list(zip(*out)) if out else [()] * 4
    return [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))]


def counted_pairs(docs: DataFrame, blocks: int) -> DataFrame:
    """What tasks send of their own texts to the homes, ``BLOCK_TEXT`` bytes at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, size = [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(as_rows(messages(Block.of(texts), blocks, -1, True)), ["home", "frm", "kind", "data"])

        for batch in batches:
            for text in batch.column("text"):
                texts.append((text.as_py() or "").encode("utf-8", "replace"))
                size += len(texts[-1])
                if size >= BLOCK_TEXT:
                    yield flush()
                    texts, size = [], 0
        if texts:
            yield flush()

    return docs.select("text").mapInArrow(work, ROWS)


def asked_pairs(placed: DataFrame, blocks: int) -> DataFrame:
    """What blocks ask the homes."""

    def work(table: pa.Table) -> pa.Table:
        block = Block.of(t.as_py().encode("utf-8", "replace") for t in table.column("text"))
        return pa.table(as_rows(messages(block, blocks, table.column("block")[0].as_py(), False)), ["home", "frm", "kind", "data"])

    return placed.groupBy("block").applyInArrow(lambda t: work(t), ROWS)


def settled(blocks: int):
    """Adds up what the blocks sent: a home's words, and its contexts' pairs in order of (context, home of the word, word)."""

    def work(home: int, rows: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        index: defaultdict[bytes, int] = defaultdict(count().__next__)
        follow: defaultdict[bytes, int] = defaultdict(count().__next__)
        of, n, context, after, times = [], [], [], [], []
        for _, _, data in rows:
            words, sizes, others, at, own, c = unpacked(data)
            here = np.fromiter(map(index.__getitem__, parted(words)), dtype=np.int64, count=words[0])
            of.append(here), n.append(own)
            context.append(np.repeat(here, sizes)), times.append(c)
            after.append(np.fromiter(map(follow.__getitem__, parted(others)), dtype=np.int64, count=others[0])[at])
        words, names = list(index), list(follow)
        order = sorted(range(len(words)), key=words.__getitem__)
        place = np.empty(len(words), dtype=np.int64)
        place[order] = np.arange(len(words))
        words = [words[k] for k in order]
        total = np.bincount(place[np.concatenate(of)], np.concatenate(n), len(words)).astype(np.int64)
        at_home = homes(names, blocks)
        order = sorted(range(len(names)), key=lambda k: (at_home[k], names[k]))
        rank = np.empty(len(names), dtype=np.int64)
        rank[order] = np.arange(len(names))
        key = place[np.concatenate(context)] * len(names) + rank[np.concatenate(after)]
        first, back, _ = numbered(key, (len(words) * max(1, len(names))).bit_length())
        pair = key[first]
        c = np.bincount(back, np.concatenate(times), len(pair)).astype(np.int64)
        at, sizes = (pair % max(1, len(names))).astype(np.int32), np.bincount(pair // max(1, len(names)), minlength=len(words)).astype(np.int32)
        edges = np.searchsorted(at_home[order], np.arange(blocks + 1))
        names = [names[k] for k in order]
        yield home, home, STATE, packed(joined(words), total, sizes, joined(names), edges, at, c)
        yield home, home, TOTALS, packed(int(total.sum()), len(words), int((c == 1).sum()), int((c == 2).sum()))
        tables = np.bincount(at, minlength=len(names))
        for g in np.flatnonzero(np.diff(edges)):
            yield int(g), home, LINK, packed(joined(names[edges[g] : edges[g + 1]]), tables[edges[g] : edges[g + 1]].astype(np.int32))

    return work


def linked(home: int, rows: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
    """The places, among a home's words, of the words that other homes send tables of; and the first tables."""
    words, total = unpacked(next(data for _, kind, data in rows if kind == STATE))[:2]
    index = {w: k for k, w in enumerate(parted(words))}
    places, c = [], np.zeros(words[0])
    for frm, kind, data in rows:
        if kind == LINK:
            names, tables = unpacked(data)
            at = np.fromiter(map(index.__getitem__, parted(names)), dtype=np.int32, count=names[0])
            places.append((frm, at))
            np.add.at(c, at, tables)
            yield home, frm, TABLES, packed(tables)
    yield home, home, PLACES, packed(words, total, places)
    yield home, home, TOTALS, packed(int(c.sum()), int((c == 1).sum()), int((c == 2).sum()))


@dataclass
class Sample:
    """A kept sweep of the restaurant of words: what it began with, and the tables, spelling mass of the known words and customers it ended with."""

    spelling: Spelling
    begun: float
    tables: float
    known: float
    customers: float


@dataclass
class Model:
    rows: DataFrame | None
    blocks: int
    discount: float
    #: Of the contexts.
    pair_discount: float
    train_tokens: int
    distinct: int
    samples: list[Sample]

    def new_table(self, sample: Sample) -> float:
        return (STRENGTH + self.discount * sample.tables) / (STRENGTH + sample.customers)

    @property
    def unknown(self) -> float:
        """Probability of all words that the training texts lack."""
        return sum(self.new_table(s) * max(1 - s.known, 1e-9) for s in self.samples) / len(self.samples) if self.samples else 1.0


def reseated(home: int, counts: np.ndarray, spelled: np.ndarray, tables: float, discount: float, sweep: int) -> np.ndarray:
    """One sweep over a home's dishes of the restaurant of words; its draws depend on the sweep and the home only."""
    return seat(counts, (STRENGTH + discount * tables) * spelled, discount, np.random.default_rng([sweep, home]))


def seat_words(sent, tables: float, discount: float, sweep: int):
    def work(home: int, rows: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        words, _, places = unpacked(next(data for _, kind, data in rows if kind == PLACES))
        came = {frm: unpacked(data)[0] for frm, kind, data in rows if kind == TABLES}
        c = np.zeros(words[0], dtype=np.int64)
        for frm, at in places:
            np.add.at(c, at, came[frm])
        spelled, key, first = spell(parted(words), sent.value.log_table())
        spelled = np.exp(spelled)
        t = reseated(home, c, spelled, tables, discount, sweep)
        sums = np.bincount(key, np.repeat(t, np.diff(np.append(first, len(key)))), SIZE**4)
        at = np.flatnonzero(sums)
        yield home, home, SPELLING, packed(np.append(at, [-1, -2, -3]), np.append(sums[at], [t.sum(), spelled.sum(), c.sum()]))
        yield home, home, WORDS, packed(c)
        own = np.maximum(c - discount * t, 0)
        for frm, at in places:
            yield frm, home, CHANCES, packed(own[at].astype(np.float32), spelled[at].astype(np.float32))

    return work


def seat_contexts(fresh: float, customers: float, discount: float, sweep: int):
    """Seats the pairs given the probabilities (own + fresh * spelled) / (STRENGTH + customers) of their words."""

    def work(home: int, rows: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        _, _, sizes, names, edges, at, c = unpacked(next(data for _, kind, data in rows if kind == STATE))
        p = np.zeros(names[0])
        for frm, kind, data in rows:
            if kind == CHANCES:
                own, spelled = unpacked(data)
                p[edges[frm] : edges[frm + 1]] = (own + fresh * spelled.astype(np.float64)) / (STRENGTH + customers)
        context = np.repeat(np.arange(len(sizes)), sizes)
        before = next((unpacked(data)[0] for _, kind, data in rows if kind == CONTEXTS), None)
        opened = np.bincount(context, before, len(sizes))
        t = seat(c, (STRENGTH + discount * opened[context]) * p[at], discount, np.random.default_rng([sweep, home, 1])).astype(np.int32)
        yield home, home, CONTEXTS, packed(t)
        tables = np.bincount(at, t, names[0]).astype(np.int32)
        for g in np.flatnonzero(np.diff(edges)):
            yield int(g), home, TABLES, packed(tables[edges[g] : edges[g + 1]])

    return work


def spelling_sums(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in unpacked(data)], ["key", "n"])

    found = rows.filter(F.col("kind") == SPELLING).select("data").mapInArrow(work, "key long, n double").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    return found.column("key").to_numpy(), found.column("n").to_numpy()


def totals(rows: DataFrame) -> np.ndarray:
    return np.array([unpacked(r.data) for r in rows.filter(F.col("kind") == TOTALS).select("data").collect()]).sum(axis=0)


def discount_of(one: int, two: int) -> float:
    return float(min(0.95, max(0.05, one / (one + 2 * two)))) if one else 0.5


def learn(docs: DataFrame) -> Model:
    """Fits on all rows of (doc_id, text, learn) with ``learn``."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_TEXT))
    made = shared_checkpoint(by_home(counted_pairs(docs.filter("learn"), blocks), blocks, settled(blocks)))
    if not made.limit(1).count():
        return Model(None, blocks, 0.5, 0.5, 0, 0, [])
    tokens_, distinct, *few = totals(made)
    links = shared_checkpoint(by_home(made.filter(F.col("kind").isin(STATE, LINK)), blocks, linked))
    _, *few_tables = totals(links)
    model = Model(None, blocks, discount_of(*few_tables), discount_of(*few), int(tokens_), int(distinct), [])
    made = shared_checkpoint(made.filter(F.col("kind") == STATE))
    places, came, seated = links.filter(F.col("kind") == PLACES), links.filter(F.col("kind") == TABLES), None
    kept = [made, places]
    spelling, tables = Spelling.flat(), float(distinct)
    for sweep in range(BURN_IN + SAMPLES):
        sent = spark.sparkContext.broadcast(spelling.sent())
        words = shared_checkpoint(by_home(places.union(came), blocks, seat_words(sent, tables, model.discount, sweep)))
        key, n = spelling_sums(words)
        begun, tables, customers = tables, float(n[key == -1].sum()), float(n[key == -3].sum())
        rows = words.filter(F.col("kind") == CHANCES).union(made)
        rows = rows if seated is None else rows.union(seated)
        seats = shared_checkpoint(by_home(rows, blocks, seat_contexts(STRENGTH + model.discount * tables, customers, model.pair_discount, sweep)))
        came, seated = seats.filter(F.col("kind") == TABLES), seats.filter(F.col("kind") == CONTEXTS)
        if sweep >= BURN_IN:
            k = len(model.samples)
            model.samples.append(Sample(spelling.sent(), begun, tables, float(n[key == -2].sum()), customers))
            own = [x.filter(F.col("kind") == c).withColumn("kind", F.lit(c + k).cast("int")) for x, c in ((words, WORDS), (seats, CONTEXTS))]
            kept.append(shared_checkpoint(own[0].union(own[1])))
            del own
        order = np.argsort(key)
        key, n = key[order], n[order]
        spelling = sample_spelling(key[key >= 0], n[key >= 0], spelling, np.random.default_rng(sweep))
        sent.unpersist()
        del words, seats, rows
        release(spark)
    model.rows = kept[0]
    for x in kept[1:]:
        model.rows = model.rows.union(x)
    return model


def word_tables(model: Model, samples: list[Sample], home: int, rows: dict[int, bytes]) -> tuple[list[bytes], np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(words, counts, customers and tables in each sample) of a home's part of the restaurant of words."""
    words, n, _ = unpacked(rows[PLACES])
    words, customers, tables = parted(words), [], []
    for k, (sample, spelled) in enumerate(zip(samples, spelled_in(words, samples))):
        c = unpacked(rows[WORDS + k])[0]
        customers.append(c)
        tables.append(reseated(home, c, spelled, sample.begun, model.discount, BURN_IN + k).astype(np.int64))
    return words, n, customers, tables


def word_chances(model: Model, samples: list[Sample], words: list[bytes], customers: list[np.ndarray], tables: list[np.ndarray]) -> np.ndarray:
    """Probabilities of words in each sample, given their customers and tables there (0 of a word that the training texts lack)."""
    p = np.zeros((len(samples), len(words)))
    for k, (sample, spelled) in enumerate(zip(samples, spelled_in(words, samples))):
        own = np.maximum(customers[k] - model.discount * tables[k], 0) / (STRENGTH + sample.customers)
        p[k] = own + model.new_table(sample) * spelled
    return p


def without_rows(model: Model) -> Model:
    """The scalars that tasks need; samples are sent by broadcast."""
    return Model(None, model.blocks, model.discount, model.pair_discount, model.train_tokens, model.distinct, [])


def predictive(model: Model) -> DataFrame:
    """(word, n, p): counts and averaged predictive probabilities of the words of the training texts, without a context."""
    sent, plain = model.rows.sparkSession.sparkContext.broadcast(model.samples), without_rows(model)

    def work(table: pa.Table) -> pa.Table:
        rows = dict(zip(table.column("kind").to_pylist(), table.column("data").to_pylist()))
        words, n, *seats = word_tables(plain, sent.value, table.column("home")[0].as_py(), rows)
        p = word_chances(plain, sent.value, words, *seats)
        return pa.table([pa.array(words, pa.binary()), pa.array(n), pa.array(p.mean(axis=0))], ["word", "n", "p"])

    rows = model.rows.filter((F.col("kind") == PLACES) | F.col("kind").between(WORDS, CONTEXTS - 1))
    return rows.groupBy("home").applyInArrow(lambda t: work(t), "word binary, n long, p double")


def answered(model: Model, sent):
    """For what a block asks, in its order: of words the count, and customers and tables in each sample; of words as contexts the customers, and
    the tables in each sample; of pairs the count and the tables of all samples together.  What isn't known has 0."""

    def work(home: int, rows: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        held = {kind: data for _, kind, data in rows if kind != ASKED}
        index, follow, pair = {}, {}, np.zeros(0, dtype=np.int64)
        of_words, of_pairs = [np.zeros(1, dtype=np.int32)] * (2 + 3 * len(sent.value)), [np.zeros(1, dtype=np.int32)] * 2
        if held:
            words, n, customers, tables = word_tables(model, sent.value, home, held)
            index = {w: k for k, w in enumerate(words)}
            _, _, sizes, names, _, at, c = unpacked(held[STATE])
            follow = {w: k for k, w in enumerate(parted(names))}
            context = np.repeat(np.arange(len(sizes)), sizes)
            pair, seats = context * len(follow) + at, [unpacked(held[CONTEXTS + k])[0] for k in range(len(sent.value))]
            of_words = [n, np.bincount(context, c, len(sizes)), *customers, *tables, *(np.bincount(context, t, len(sizes)) for t in seats)]
            of_pairs = [c, sum(seats, np.zeros(len(c), dtype=np.int64))]
            # the last place is for what isn't known
            of_words, of_pairs = ([np.append(x, 0).astype(np.int32) for x in xs] for xs in (of_words, of_pairs))
        for frm, kind, data in rows:
            if kind != ASKED:
                continue
            words, sizes, names, at = unpacked(data)
            here = np.fromiter((index.get(w, -1) for w in parted(words)), dtype=np.int64, count=words[0])
            after = np.fromiter((follow.get(w, -1) for w in parted(names)), dtype=np.int64, count=names[0])[at]
            before = np.repeat(here, sizes)
            wanted = np.where((before >= 0) & (after >= 0), before * len(follow) + after, -1)
            place = np.searchsorted(pair, wanted)
            place = np.where((place < len(pair)) & (np.append(pair, -2)[place] == wanted), place, -1)
            yield frm, home, ANSWER, packed(*(x[here] for x in of_words), *(x[place] for x in of_pairs))

    return work


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row of ``docs`` (doc_id, text)."""
    blocks, plain = model.blocks, without_rows(model)
    release(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model.samples)
    placed = deal(docs, blocks)
    asked = asked_pairs(placed, blocks)
    answers = by_home(asked if model.rows is None else asked.union(model.rows), blocks, answered(plain, sent)).withColumnRenamed("home", "block")
    below = model.train_tokens + 0.1 * (model.distinct + 1)

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        samples = sent.value
        block = Block.of(t.as_py().encode("utf-8", "replace") for t in left.column("text"))
        context, _, _, at = block.pairs()
        own = homes(block.words, blocks)
        of = own[context]
        by_word, by_pair = np.zeros((2 + 3 * len(samples), len(own)), dtype=np.int64), np.zeros((2, len(context)), dtype=np.int64)
        for home, data in zip(right.column("frm").to_pylist(), right.column("data").to_pylist()):
            parts = unpacked(data)
            by_word[:, own == home], by_pair[:, of == home] = parts[: len(by_word)], parts[len(by_word) :]
        n, customers = by_word[0], STRENGTH + by_word[1]
        of_sample = [by_word[2 + k * len(samples) : 2 + (k + 1) * len(samples)] for k in range(3)]
        logs = np.zeros(len(block.word))
        if samples:
            # the average of the samples' chances at a new table, and what the pair's own tables give
            p = (np.maximum(len(samples) * by_pair[0] - plain.pair_discount * by_pair[1], 0) / len(samples) / customers[context])[at]
            chance = word_chances(plain, samples, block.words, *of_sample[:2])
            for k in range(len(samples)):
                share = (STRENGTH + plain.pair_discount * of_sample[2][k]) / customers
                p += share[block.before] * chance[k][block.word] / len(samples)
            logs = np.log10(np.maximum(p, 1e-300))
        base, first = np.log10((n + 0.1) / below), np.cumsum(block.sizes) - block.sizes
        known = np.add.reduceat(n[block.word] > 0, first, dtype=np.int64)
        columns = [left.column("doc_id"), pa.array(block.sizes), pa.array(known), pa.array(np.add.reduceat(base[block.word], first)), pa.array(np.add.reduceat(logs, first))]
        return pa.table(columns, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda a, b: work(a, b), "doc_id long, n_tokens long, n_known long, base_score double, score double")


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir, "text")
    model = learn(docs.withColumn("learn", ~is_held_out("doc_id", 10, 0)))
    found = score(docs, model).withColumn("train_tokens", F.lit(model.train_tokens).cast("long"))
    return found.select("doc_id", is_held_out("doc_id", 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
