"""Byte-level BPE: encoding by a priority queue of merge ranks over a doubly linked symbol list, and
decoding by concatenating vocabulary strings.

The vocabulary file (``tokenizers`` JSON) is a parameter; nothing is trained. Encoding equals the
library's with ``add_special_tokens=False``: special-token strings in a text become their ids, the
rest is cut by the pre-tokenizer's pattern and each piece is merged on its own. Null text counts as
empty; an empty text has no ids and decodes to the empty string. Texts of any length are encoded in
blocks of units that no piece crosses (see ``units``), so memory follows the ids of a few documents.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .tables import held, trim
from .units import BLOCK, Units, gather
from .words import slices

#: Fixed value: the published pre-tokenizer pattern of this kind of vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes encoded at a time.
BLOCK_CHARS = BLOCK


@lru_cache(1)
def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary's strings."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def packed(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings as one array, with the start and the length of each."""
    size = np.array([len(x) for x in strings], dtype=np.int64)
    return np.frombuffer(b"".join(strings), dtype=np.uint8), np.cumsum(size) - size, size


class Bpe:
    """An encoder and decoder over one vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        chars = byte_chars()
        of_char = {c: b for b, c in chars.items()}
        self.byte_id = [vocab[chars[b]] for b in range(256)]
        #: left id << 20 | right id -> rank; the id that the merge of a rank makes.
        self.rank_of: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            x, y = pair.split(" ") if isinstance(pair, str) else pair
            self.rank_of[vocab[x] << 20 | vocab[y]] = rank
            self.made.append(vocab[x + y])
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.special = special
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.bytes_of: list[bytes] = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for s, i in vocab.items():
            self.bytes_of[i] = bytes(of_char[c] for c in s) if all(c in of_char for c in s) else s.encode()
        for s, i in special.items():
            self.bytes_of[i] = s.encode()
        self.pieces = regex.compile(PATTERN)
        self.units = Units(self.fresh)
        self.strings, self.string_at, self.string_size = packed(self.bytes_of)
        #: Each id in decimal, a comma after it.
        self.decimals, self.decimal_at, self.decimal_size = packed([b"%d," % i for i in range(len(self.bytes_of))])

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece. A queue entry is rank << 32 | position; it is stale, and skipped, once its
        left symbol is gone or no longer starts a pair of that rank."""
        of_byte = self.byte_id
        ids = [of_byte[b] for b in piece]
        n = len(ids)
        if n < 2:
            return ids
        rank_of, made, pop, push = self.rank_of.get, self.made, heapq.heappop, heapq.heappush
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [r << 32 | i for i in range(n - 1) if (r := rank_of(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            entry = pop(queue)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if ids[i] < 0 or j < 0 or rank_of(ids[i] << 20 | ids[j]) != entry >> 32:
                continue
            ids[i] = merged = made[entry >> 32]
            ids[j] = -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank_of(merged << 20 | ids[k])) is not None:
                    push(queue, r << 32 | i)
            h = before[i]
            if h >= 0 and (r := rank_of(ids[h] << 20 | merged)) is not None:
                push(queue, r << 32 | h)
        return [x for x in ids if x >= 0]

    def fresh(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that go through the pattern as they are, and how many each has."""
        ids, ends = array("I"), [0]
        for u in units:
            for part in self._parts(u):
                ids.extend(part)
            ends.append(len(ids))
        return np.array(ids, dtype=np.uint32), np.diff(ends)

    def _parts(self, text: str) -> Iterator[list[int]]:
        for part in self.at_special.split(text) if self.at_special and any(s in text for s in self.special) else (text,):
            if part in self.special:
                yield [self.special[part]]
            else:
                for piece in self.pieces.findall(part):
                    yield self.merge(piece.encode())

    def encode_all(self, texts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts (UTF-8 bytes), one after the other, and how many each has."""
        return self.units.ids(texts, BLOCK_CHARS)

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([np.frombuffer((text or "").encode(), dtype=np.uint8)])[0].tolist()

    def decoded(self, ids: np.ndarray) -> bytes:
        """The vocabulary strings of the ids, concatenated."""
        return gather(self.strings, self.string_at[ids], self.string_size[ids]).tobytes()

    def decode(self, ids: Iterable[int]) -> str:
        return self.decoded(np.array(list(ids), dtype=np.int64)).decode("utf-8", "replace")


def load(path: str) -> Bpe:
    """One encoder for each worker process."""
    return held(("bpe", path), lambda: Bpe(path))


def encode_documents(docs: DataFrame, vocab: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of token ids in place of any of that name.

    Other columns, nulls in them included, never leave the JVM; a null text has no ids. An empty table
    gives an empty table. Rows that repeat are encoded each.
    """

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(vocab)
        for column in columns:
            got, counts = zip(*(bpe.encode_all(part) for part in slices(column)), strict=True) if len(column) else ((), ())
            offsets = np.concatenate(([0], *counts)).cumsum().astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(got).view(np.int32) if got else np.empty(0, np.int32)))
            got = counts = ()
            trim()

    encoded = F.arrow_udf(run, ArrayType(IntegerType()))
    rest = docs.drop(ids)
    return rest.withColumn(ids, encoded(F.col(text).cast("string")))


def digests(docs: DataFrame, vocab: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, then decode, every whole text: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``ids_sha256`` is of the decimal ids joined by commas, ``decoded_sha256`` of the decoded text.
    Null and empty texts have no ids; a null doc_id stays null; repeated rows give repeated rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocab)
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for part in slices(batch.column(1)):
                ids, counts = bpe.encode_all(part)
                at = 0
                for count in counts.tolist():
                    a, b = hashlib.sha256(), hashlib.sha256()
                    own = ids[at : at + count]
                    for k in range(0, count, BLOCK_CHARS):
                        some = own[k : k + BLOCK_CHARS]
                        decimal = gather(bpe.decimals, bpe.decimal_at[some], bpe.decimal_size[some])
                        a.update(decimal[: len(decimal) - (k + len(some) == count)].tobytes())
                        b.update(bpe.decoded(some))
                    n.append(count)
                    of_ids.append(a.hexdigest())
                    of_text.append(b.hexdigest())
                    at += count
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
