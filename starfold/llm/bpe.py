"""BPE encoding and decoding.

Encoding keeps the symbols of a word in a doubly linked list and the candidate merges in a priority
queue ordered by (merge rank, position).  An entry whose symbols have changed since it was queued is stale
and skipped.  Decoding concatenates the byte strings of the vocabulary.

The vocabulary is the JSON file of a public byte-level tokenizer; its *path* is a parameter, the file is
read on each worker.  Nothing is trained.

Work for each text: it is cut before every space that follows a non-space (the pre-tokenizer's pattern
never joins characters across such a place), so equal pieces have equal ids wherever they stand, and a
bounded memo of pieces serves nearly all of a corpus.  Special tokens are cut out first, as the file says.

Defined results: null text counts as empty (0 tokens, digest of no bytes); every input row gives one output row,
repeated rows included; extra columns are dropped by the query, kept by :func:`encode`.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from array import array
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, read_documents

_SPACE_RUN = regex.compile(r"\s(?: |\Z)")
#: Pieces a worker remembers; beyond it the memo starts anew, so that memory stays bounded.
MEMO_PIECES = 300_000
#: The same for pre-tokens, which repeat more.
MEMO_TOKENS = 900_000


def default_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merge ranks and byte strings of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        as_bytes = lambda token: bytes(alphabet[c] for c in token)
        ids = {as_bytes(token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings: list[bytes] = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.strings[i] = token
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        #: left id * size + right id -> merge rank, and the id that each rank makes
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = map(as_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            self.ranks.setdefault(ids[left] * len(self.strings) + ids[right], rank)
            self.merged.append(ids[left + right])
        import public_tokenizers

        self.words = regex.compile(public_tokenizers.PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def merge_word(self, word: bytes) -> list[int]:
        """Ids of one pre-token: queue of ranks over a doubly linked list, stale entries skipped."""
        ids = [self.byte_id[b] for b in word]
        n = len(ids)
        if n < 2:
            return ids
        size, ranks, merged = len(self.strings), self.ranks.get, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            rank = ranks(ids[i] * size + ids[i + 1])
            if rank is not None:
                queue.append(rank * n + i)
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            rank, i = divmod(pop(queue), n)
            j = after[i]
            if j >= n or ids[i] < 0 or ranks(ids[i] * size + ids[j]) != rank:
                continue  # stale: one of the two symbols has grown or gone since
            ids[i], ids[j] = new, _ = merged[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = ranks(new * size + ids[k])
                if rank is not None:
                    push(queue, rank * n + i)
            k = before[i]
            if k >= 0:
                rank = ranks(ids[k] * size + new)
                if rank is not None:
                    push(queue, rank * n + k)
        return [x for x in ids if x >= 0]

    def decode(self, ids) -> bytes:
        """The bytes of the ids' vocabulary strings, one after another."""
        strings = self.strings
        return b"".join([strings[i] for i in ids])


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, with a bounded memo of pieces."""

    def __init__(self, vocabulary: Vocabulary, encode_piece: Callable[[str], list[int]] | None = None, memo: int = MEMO_PIECES):
        self.vocabulary, self.memo_size = vocabulary, memo
        #: Ids of a piece by its text after the one space before it.
        self.after_space: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}
        self.encode_piece = encode_piece

    def piece(self, piece: str) -> bytes:
        if self.encode_piece is not None:
            out = array("I", self.encode_piece(piece)).tobytes()
        else:
            out = b"".join(map(self.token, self.vocabulary.words.findall(piece)))
        return out

    def token(self, token: str) -> bytes:
        out = self.tokens.get(token)
        if out is None:
            out = array("I", self.vocabulary.merge_word(token.encode())).tobytes()
            if len(self.tokens) >= MEMO_TOKENS:
                self.tokens.clear()
            if len(token) <= 64:
                self.tokens[token] = out
        return out

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        parts = text.split(" ")
        if len(parts) < 2:
            return self.piece(text)
        if _SPACE_RUN.search(text):
            return self.spaced(parts)
        head = self.piece(parts[0]) if parts[0] else b""
        del parts[0]
        found = list(map(self.after_space.get, parts))
        if None in found:
            found = [x if x is not None else self.miss(part) for x, part in zip(found, parts)]
        return head + b"".join(found)

    def miss(self, part: str) -> bytes:
        out = self.after_space.get(part)
        if out is None:
            out = self.piece(" " + part)
            if len(self.after_space) >= self.memo_size:
                self.after_space.clear()
            if len(part) <= 64:
                self.after_space[part] = out
        return out

    def spaced(self, parts: list[str]) -> bytes:
        """A text in which a space follows white space, or that ends in it: such a piece takes the next one along."""
        out, held = [], parts[0]
        for part in parts[1:]:
            if held and not held[-1].isspace():
                out.append(self.miss(held[1:]) if held[0] == " " else self.piece(held))
                held = ""
            held += " " + part
        out.append(self.piece(held))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        cut = self.vocabulary.cut
        if cut is None or not any(s in text for s in self.vocabulary.special):
            return self.plain(text)
        special = self.vocabulary.special
        return b"".join(special[part].to_bytes(4, "little") if part in special else self.plain(part) for part in cut.split(text) if part)


_READY: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, ranks: str = "") -> Encoder:
    """The worker's encoder.  With ``ranks``, the same vocabulary as a rank file, pieces that are not in the memo go
    through the compiled library that reads such files: the same ids for callers that only consume them."""
    if (path, ranks) not in _READY:
        piece = None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            piece = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
        _READY[path, ranks] = Encoder(Vocabulary(path), piece)
    return _READY[path, ranks]


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds ``ids`` (array<int>) and ``decoded`` (the text that the ids decode to) to every row."""
    from pyspark.sql import functions as F

    @F.pandas_udf(f"struct<{ids}: array<int>, {decoded}: string>")
    def run(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import numpy as np

        own = encoder(path)
        for column in columns:
            found = [np.frombuffer(own.encode(x or ""), dtype="<u4").astype(np.int32) for x in column]
            yield pd.DataFrame({ids: found, decoded: [own.vocabulary.decode(x).decode("utf-8", "replace") for x in found]})

    made = docs.withColumn("__bpe", run(F.col(text)))
    return made.select(*[c for c in docs.columns if c not in (ids, decoded)], f"__bpe.{ids}", f"__bpe.{decoded}")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """Digest form of :func:`encode` for (doc_id, text): ids and decoded text are made, hashed and let go in the task."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        import numpy as np

        own = encoder(path)
        n, ids, decoded = [], [], []
        for text in batch.column("text"):
            raw = own.encode(text.as_py() or "")
            n.append(len(raw) // 4)
            ids.append(hashlib.sha256(raw).hexdigest())
            text_again = own.vocabulary.decode(np.frombuffer(raw, dtype="<u4").tolist()).decode("utf-8", "replace")
            decoded.append(hashlib.sha256(text_again.encode()).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow_map(docs.select("doc_id", "text"), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(read_documents(spark, sf_dir, "text"), default_vocabulary())
