"""Ranked search: document-at-a-time merging of compressed postings, shard by shard.

``build_index`` cuts each input partition into shards of bounded size without a shuffle.  A shard's documents are numbered in the order of doc_id;
each term has one row with its postings, (document, frequency) pairs as differences in variable-length bytes, and one row (the empty term) has
the documents' ids and lengths.

``search`` sends a block of queries to the shards.  Within a shard a heap holds the next document of each of a query's terms; the least document is
taken from all lists that have it and scored.  The best documents are in a bounded heap by score, then doc_id, which a task keeps from shard to
shard.  Terms whose largest possible contributions together stay below the worst result kept can't bring in a document by themselves: they leave
the merge and are only looked up for documents that come from other lists, as long as they can still reach the worst result.  So every document that could rank is scored in full.
What the tasks keep is merged in two steps.

Defined results: null or empty texts, or those without a term, have no postings and never rank; a query without terms, or whose terms all have weight
0, has no results; rows of equal doc_id are documents of their own, and a null doc_id comes last among equal scores; queries that repeat id and text
count once; an empty table gives an empty result; extra columns are not read.  A very long text is indexed whole, as the last document of a shard.
"""

from __future__ import annotations

import heapq
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, shared_checkpoint

#: Bytes of text of a shard, but for a longer single document.
SHARD_BYTES = 32 << 20
#: Terms, counted once for each query, that go to the tasks at once.
BLOCK_TERMS = 200_000
TOP = 20
NO_ID = 2**63 - 1

# Fixed: terms are runs of ASCII letters, digits and anything beyond ASCII; all other bytes separate them.
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

INDEX = "shard long, term string, df int, data binary"


def terms(text: str | None) -> list[bytes]:
    """The text's terms in order, ASCII letters in lower case."""
    return (text or "").encode().translate(_TABLE).split()


def packed_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each number begins): seven bits a byte, the low ones first; the last byte of a number is below 128."""
    values = values.astype(np.int64)
    size = 1 + sum((values >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    first = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), dtype=np.uint8)
    for k in range(5):
        at = np.flatnonzero(size > k)
        out[first[at] + k] = (values[at] >> 7 * k & 127) | np.where(size[at] > k + 1, 128, 0)
    return out, first


def unpacked_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, dtype=np.int64)
    end = np.flatnonzero(raw < 128)
    first = np.concatenate([[0], end[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(first, end - first + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << 7 * place, first)


def shard_rows(shard: int, ids: list, texts: list[str | None]) -> pa.RecordBatch | None:
    """The index rows of one shard: first its documents, then its terms."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    number: dict[bytes, int] = {}
    term_of, times, documents, kept, length = array("I"), array("I"), array("I"), [], []
    for i in order:
        counts = Counter(terms(texts[i]))
        if not counts:
            continue
        term_of.extend([number.setdefault(t, len(number)) for t in counts])
        times.extend(counts.values())
        documents.append(len(counts))
        kept.append(NO_ID if ids[i] is None else ids[i])
        length.append(sum(counts.values()))
    if not kept:
        return None
    term_of, times = np.frombuffer(term_of, dtype=np.uint32), np.frombuffer(times, dtype=np.uint32)
    doc = np.repeat(np.arange(len(kept)), np.frombuffer(documents, dtype=np.uint32))
    by_term = np.argsort(term_of, kind="stable")
    term_of, times, doc = term_of[by_term], times[by_term], doc[by_term]
    first = np.searchsorted(term_of, np.arange(len(number) + 1))
    step = np.diff(doc, prepend=0)
    step[first[:-1]] = doc[first[:-1]]
    data, at = packed_numbers(np.column_stack([step, times]).ravel())
    head = np.array(kept, dtype=np.int64).tobytes() + np.array(length, dtype=np.int64).tobytes()
    cuts = np.concatenate([[0], np.append(at[::2], len(data))[first] + len(head)]).astype(np.int64)
    blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(number) + 1, [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(head + data.tobytes())]).cast(pa.binary())
    names = pa.array([b"", *number], pa.binary()).cast(pa.string())
    df = np.concatenate([[len(kept)], np.diff(first)]).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(df), shard)), names, pa.array(df), blobs], ["shard", "term", "df", "data"])


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(shard, term, df, data) in the shared folder; the rows of a shard are together, its documents (empty term) first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, held = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        texts: list[str | None] = []

        def flush() -> Iterator[pa.RecordBatch]:
            rows = shard_rows(part << 24 | made, ids, texts)
            # rows go out in small pieces, as the JVM holds each whole
            for k in range(0, rows.num_rows if rows else 0, 5000):
                yield rows.slice(k, 5000)

        for batch in batches:
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = value.as_py()
                ids.append(i), texts.append(value)
                held += len(value or "")
                if held >= shard_bytes:
                    yield from flush()
                    ids, texts, held, made = [], [], 0, made + 1
        yield from flush()

    return shared_checkpoint(docs.select(F.col(key).cast("long"), text).mapInArrow(work, INDEX))


def totals(index: DataFrame) -> tuple[int, int]:
    """N, the documents with a term, and L, all their terms."""

    @F.arrow_udf("bigint")
    def lengths(data: pa.Array) -> pa.Array:
        return pa.array([int(np.frombuffer(x.as_py(), dtype=np.int64)[len(x.as_py()) // 16 :].sum()) for x in data], pa.int64())

    row = index.filter("term = ''").agg(F.sum("df").alias("n"), F.sum(lengths("data")).alias("l")).collect()[0]
    return row["n"] or 0, row["l"] or 0


def weighted(queries: DataFrame, index: DataFrame, n: int, key: str = "item_id", text: str = "text") -> DataFrame:
    """(query, term, w): a row for each distinct term of each query that some document holds, w with the term's repeats in the query."""

    @F.arrow_udf("array<string>")
    def split(texts: pa.Array) -> pa.Array:
        return pa.array([[t.decode() for t in terms(x.as_py())] for x in texts], pa.list_(pa.string()))

    asked = queries.select(F.col(key).alias("query"), text).distinct()
    opened = asked.select("query", F.explode(split(text)).alias("term")).groupBy("query", "term").agg(F.count(F.lit(1)).alias("times"))
    opened = shared_checkpoint(opened)
    vocabulary = opened.select("term").distinct()
    if opened.count() <= BROADCAST_ROWS:
        vocabulary = F.broadcast(vocabulary)
    df = index.select("term", "df").join(vocabulary, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    # Fixed: the weight is floor(1000 ln((2 N + 2) / (2 df + 1))), in doubles
    w = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1).cast("double")))
    return opened.join(df, "term").select("query", "term", (w * F.col("times")).alias("w")).filter("w > 0")


class Results:
    """The best documents of a query: a heap of (score, -doc_id), the worst on top."""

    __slots__ = ("heap", "size")

    def __init__(self, size: int):
        self.heap: list[tuple[int, int]] = []
        self.size = size

    def least(self) -> int:
        """A score below this can't enter."""
        return self.heap[0][0] if len(self.heap) == self.size else 1

    def add(self, score: int, doc_id: int) -> bool:
        if len(self.heap) < self.size:
            heapq.heappush(self.heap, (score, -doc_id))
            return True
        if (score, -doc_id) > self.heap[0]:
            heapq.heapreplace(self.heap, (score, -doc_id))
            return True
        return False


def merge(lists: list[tuple[array, array, int]], doc_ids: list[int], results: Results) -> None:
    """Merges (documents, contributions, weight) lists of one query document at a time into its results."""
    # by their largest contributions; ``reach[k]`` is what the first k can give together
    lists = sorted(lists, key=lambda x: max(x[1]) * x[2])
    count = len(lists)
    reach = [0]
    for _, gain, w in lists:
        reach.append(reach[-1] + max(gain) * w)
    docs, gains, weights = ([x[k] for x in lists] for k in range(3))
    ends, place = [len(x) for x in docs], [0] * count
    least = results.least()

    def essential() -> int:
        k = 0
        while k < count and reach[k + 1] < least:
            k += 1
        return k

    own = essential()
    queue = [docs[k][0] * count + k for k in range(own, count)]
    heapq.heapify(queue)
    replace, pop = heapq.heapreplace, heapq.heappop
    while queue:
        doc, k = divmod(queue[0], count)
        score, stop = 0, (doc + 1) * count
        while queue and queue[0] < stop:
            k = queue[0] - doc * count
            at = place[k]
            score += gains[k][at] * weights[k]
            at += 1
            place[k] = at
            if at < ends[k]:
                replace(queue, docs[k][at] * count + k)
            else:
                pop(queue)
        k = own
        while k and score + reach[k] >= least:
            k -= 1
            at = place[k] = bisect_left(docs[k], doc, place[k])
            if at < ends[k] and docs[k][at] == doc:
                score += gains[k][at] * weights[k]
        if k or score < least or not results.add(score, doc_ids[doc]):
            continue
        least = results.least()
        now = essential()
        if now > own:
            own = now
            queue = [x for x in queue if x % count >= own]
            heapq.heapify(queue)


def searched(index: DataFrame, asked: dict, n: int, total: int, top: int) -> DataFrame:
    """(query number, part, doc_id, score) of one block of queries: the best of each task."""
    vocabulary = sorted({t for _, query in asked.values() for t, _ in query})
    spark = index.sparkSession
    sent = spark.sparkContext.broadcast(list(asked.values()))
    wanted = F.broadcast(spark.createDataFrame([(t,) for t in ["", *vocabulary]], "term string"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found = [Results(top) for _ in sent.value]
        shard, doc_ids, m = None, [], None
        postings: dict[str, tuple[array, array]] = {}

        def run() -> None:
            for results, (_, query) in zip(found, sent.value):
                lists = [(*postings[t], w) for t, w in query if t in postings]
                if lists:
                    merge(lists, doc_ids, results)

        for batch in batches:
            for s, term, data in zip(batch.column("shard").to_pylist(), batch.column("term").to_pylist(), batch.column("data")):
                data = data.as_py()
                if s != shard:
                    run()
                    shard, postings = s, {}
                if not term:
                    both = np.frombuffer(data, dtype=np.int64)
                    doc_ids = both[: len(both) // 2].tolist()
                    # Fixed: a document's m and each frequency's gain, in 64-bit integers
                    m = 100 - 25 + 25 * both[len(both) // 2 :] * n // total
                    continue
                pairs = unpacked_numbers(data)
                doc, tf = np.cumsum(pairs[::2]), pairs[1::2]
                gain = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
                postings[term] = array("i", doc.astype(np.int32).tobytes()), array("i", gain.astype(np.int32).tobytes())
        run()
        rows = [(q, -d, score) for q, results in enumerate(found) for score, d in results.heap]
        part = TaskContext.get().partitionId()
        columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays([columns[0], pa.array([part] * len(rows), pa.int64()), *columns[1:]], ["q", "part", "doc_id", "score"])

    # the rows of a shard stay together and in order: they are filtered by broadcast, never shuffled
    return index.select("shard", "term", "data").join(wanted, "term", "left_semi").select("shard", "term", "data").mapInArrow(work, "q long, part long, doc_id long, score long")


def best(rows: DataFrame, group: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(index: DataFrame, queries: DataFrame, key: str = "item_id", text: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(query, rank, doc_id, score): each query's ``top`` documents with a score above 0, equal scores by ascending doc_id.

    Queries go to the tasks in blocks of a bounded number of terms, however many there are.
    """
    n, total = totals(index)
    rows = shared_checkpoint(weighted(queries, index, n, key, text))
    blocks = 1 + rows.count() // block_terms
    kind = dict(queries.dtypes)[key]
    parts = []
    for b in range(blocks):
        block = rows.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b)
        asked: dict = {}
        for r in block.select(F.to_json(F.struct("query")).alias("name"), "query", "term", "w").collect():
            asked.setdefault(r["name"], (r["query"], []))[1].append((r["term"], r["w"]))
        if not asked:
            continue
        found = searched(index, asked, n, total, top)
        names = index.sparkSession.createDataFrame([(k, q) for k, (q, _) in enumerate(asked.values())], f"q long, query {kind}")
        few = best(found.withColumn("part", F.floor(F.col("part") / 64)), ["q", "part"], top)
        last = best(few, ["q"], top).join(F.broadcast(names), "q")
        parts.append(last.select("query", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score"))
    if not parts:
        return index.sparkSession.createDataFrame([], f"query {kind}, rank int, doc_id long, score long")
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return search(build_index(docs), items).withColumnRenamed("query", "item_id")


ORACLE = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
n as (select r, doc_id, len(terms)::bigint as n from d where len(terms) > 0),
facts as (select count(*)::bigint as docs, sum(n)::bigint as total from n),
tf as (select r, term, count(*)::bigint as tf from (select r, unnest(terms) as term from d) group by all),
items as (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from (select distinct item_id, text from benchmark)),
asked as (select item_id, term, count(*)::bigint as times from items group by all),
w as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, facts where term in (select term from asked) group by term, docs),
hits as (select item_id, n.doc_id, n.r, sum(times * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (100 - 25 + (25 * n.n * docs) // total)))) as score
  from asked join w using (term) join tf using (term) join n on n.r = tf.r, facts group by all),
ranked as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as rank from hits where score > 0)
select item_id, rank::int as rank, doc_id, score::bigint as score from ranked where rank <= 20
"""
