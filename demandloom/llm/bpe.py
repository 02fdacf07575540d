"""Byte-level BPE encoding and decoding with a two-tier lookup.

A pre-token that is itself in the vocabulary is found by a minimal perfect hash: one hash
names a bucket, and the bucket's seed the one slot it can be in. Any other is split into bytes, which
are linked in a list; a heap holds the mergeable neighbours by rank and place, and the merges
that the ranks allow are made in that order. Each task remembers the recent pre-tokens, a bounded number.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import textbytes as tb


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class PerfectHash:
    """Minimal perfect hash over the tokens: as many slots as tokens, one probe for a lookup."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        n = self.size = max(len(ranks), 1)
        self.buckets = n // 3 + 1
        groups: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for token in ranks:
            groups[xxhash.xxh3_64_intdigest(token, 1) % self.buckets].append(token)
        self.shift = [0] * self.buckets
        self.tokens: list[bytes | None] = [None] * n
        self.ranks = [-1] * n
        order = sorted(range(self.buckets), key=lambda b: -len(groups[b]))
        free = 0
        for b in order:
            group = groups[b]
            if len(group) > 1:
                seed = 2
                while True:
                    slots = {xxhash.xxh3_64_intdigest(t, seed) % n for t in group}
                    if len(slots) == len(group) and all(self.tokens[s] is None for s in slots):
                        break
                    seed += 1
                self.shift[b] = seed
                for t in group:
                    self._put(xxhash.xxh3_64_intdigest(t, seed) % n, t, ranks[t])
            elif group:  # a single token goes to the next free slot, named directly
                while self.tokens[free] is not None:
                    free += 1
                self.shift[b] = -free - 1
                self._put(free, group[0], ranks[group[0]])

    def _put(self, slot: int, token: bytes, rank: int) -> None:
        self.tokens[slot], self.ranks[slot] = token, rank

    def get(self, token: bytes) -> int:
        """Rank of a token, -1 if it is not in the vocabulary."""
        shift = self.shift[xxhash.xxh3_64_intdigest(token, 1) % self.buckets]
        if shift < 0:
            slot = -shift - 1
        else:
            slot = xxhash.xxh3_64_intdigest(token, shift) % self.size
        return self.ranks[slot] if self.tokens[slot] == token else -1


class Tokenizer:
    """Vocabulary and split pattern; every single byte must have a rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.table = PerfectHash(ranks)
        self.pattern = pattern
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self._start()

    def _start(self) -> None:
        self.split = regex.compile(self.pattern).findall
        self.pairs = _Pairs(self)
        self.texts = {str(rank): token for rank, token in self.bytes.items()}
        self.memo = _Memo(self)

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("table", "pattern", "bytes", "single")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._start()

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is not in the vocabulary."""
        ranks = self.pairs
        ids = [self.single[b] for b in piece]
        n = len(ids)
        # ahead[i]: rank of the symbol at i joined with the next one
        ahead = [ranks[a << 32 | b] for a, b in zip(ids, ids[1:])]
        heap = [rank << 32 | i for i, rank in enumerate(ahead) if rank >= 0]
        if not heap:
            return ids
        ahead.append(-1)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            rank, i = top >> 32, top & 0xFFFFFFFF
            if ahead[i] != rank:  # one of the two has been merged meanwhile
                continue
            ids[i] = rank
            j = following[i]
            ahead[j] = -2
            after = following[i] = following[j]
            if after < n:
                before[after] = i
                joined = ahead[i] = ranks[rank << 32 | ids[after]]
                if joined >= 0:
                    heapq.heappush(heap, joined << 32 | i)
            else:
                ahead[i] = -1
            back = before[i]
            if back >= 0:
                joined = ahead[back] = ranks[ids[back] << 32 | rank]
                if joined >= 0:
                    heapq.heappush(heap, joined << 32 | back)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = following[i]
        return out

    def piece(self, text: str) -> str:
        """Ids of one pre-token, joined by commas."""
        raw = text.encode()
        rank = self.table.get(raw)
        return str(rank) if rank >= 0 else ",".join(map(str, self.merge(raw)))

    def encode_joined(self, text: str) -> str:
        """Ids of a text as decimals joined by commas."""
        return ",".join(map(self.memo.__getitem__, self.split(text)))

    def encode(self, text: str) -> list[int]:
        joined = self.encode_joined(text)
        return list(map(int, joined.split(","))) if joined else []

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode_joined(self, joined: str) -> bytes:
        return b"".join(map(self.texts.__getitem__, joined.split(","))) if joined else b""


class _Pairs(dict):
    """Ranks of neighbours joined, -1 if they can't be; asked of the perfect hash once."""

    def __init__(self, tokenizer: Tokenizer, limit: int = 500_000) -> None:
        super().__init__()
        self.bytes, self.table, self.limit = tokenizer.bytes, tokenizer.table, limit

    def __missing__(self, pair: int) -> int:
        if len(self) >= self.limit:
            self.clear()
        rank = self[pair] = self.table.get(self.bytes[pair >> 32] + self.bytes[pair & 0xFFFFFFFF])
        return rank


class _Memo(dict):
    """Recent pre-tokens: when the young half is full it becomes the old one, which is let go."""

    def __init__(self, tokenizer: Tokenizer, limit: int = 300_000) -> None:
        super().__init__()
        self.tokenizer, self.limit, self.old = tokenizer, limit, {}

    def __missing__(self, text: str) -> str:
        found = self.old.get(text)
        if found is None:
            found = self.tokenizer.piece(text)
        if len(text) <= 64:  # long ones are rare, and would make the bound loose
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[text] = found
        return found


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_documents(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``doc_id`` and ``ids``, the token ids of each row's whole text; a NULL text has none."""
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in tb.slices(batches):
            ids = pa.array([shipped.value.encode(t.decode()) for t in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), ids], ["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``doc_id`` and ``bytes``, the decoded bytes of each row's ``ids``; NULL ids decode to none."""
    shipped = encoded.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [shipped.value.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def token_digests(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row: encoded, then decoded from the ids.

    A NULL or empty text has no tokens and the digests of nothing. Repeated rows and NULL ids are
    rows like others, very long texts are worked on one at a time, extra columns are ignored, and
    an empty table gives no rows.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shipped.value
        for rows, texts in tb.slices(batches):
            counts, ids, back = [], [], []
            for text in texts:
                joined = coder.encode_joined(text.decode())
                counts.append(joined.count(",") + 1 if joined else 0)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                back.append(hashlib.sha256(coder.decode_joined(joined)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(back)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
