"""Cost-balanced packing of tokenised documents into sequences."""

from __future__ import annotations

import functools
import heapq
import math
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.shared import read_table, written

SEQUENCE = 2048
#: Appended to every document.
END_ID = 1
#: Pieces up to this length carry their ids, so that they may be cut to fill a sequence.
FILLER = 256
#: Sequences of one packing group; a group is one task's work.
GROUP = 2048
#: Pieces of a group at most, about (a group is one task's rows; a table of empty texts has one token each).
GROUP_PIECES = 1 << 17
#: Attention cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_to long"


class Encoder:
    """Token ids of whole texts by a ``tokenizers`` file of a byte-level BPE.

    Latin texts, nearly all of them, take a faster encoder that is built from the
    file's own vocabulary; texts with other characters, whose classes two regex
    engines might see differently, or with the content of an added token go
    through the tokenizer itself. The tests hold both against each other.
    """

    #: Fixed value: how the byte-level pre-tokenizer splits texts.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    #: Characters outside the Latin ranges that both engines class alike.
    OTHER = "[^\t\n\r -~\u00A1-\u024F\u2010-\u2027\u2030-\u205E\u20AC]"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.other = re.compile("|".join([self.OTHER, *added]))
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if all(c in byte_of for c in token)}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        ids = (self.tokenizer.encode(t, add_special_tokens=False).ids if self.other.search(t) else self.fast.encode_ordinary(t) for t in texts)
        return [array("I", x).tobytes() for x in ids]


@functools.cache
def encoder_of(path: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path)


def cut_pieces(batches: Iterator[pa.RecordBatch], path: str, slice_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of at most SEQUENCE tokens of each document."""
    encoder = encoder_of(path)
    end = np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        at = 0
        while at < len(texts):
            part, size = [], 0
            while at + len(part) < len(texts) and (size < slice_bytes or not part):
                part.append(texts[at + len(part)].as_py() or "")
                size += len(part[-1])
            out: list[list] = [[] for _ in range(6)]
            for doc, raw in zip(ids.slice(at, len(part)).to_pylist(), encoder.encode(part), strict=True):
                raw += end
                n = len(raw) // 4
                for start in range(0, n, SEQUENCE):
                    piece = raw[start * 4 : (start + SEQUENCE) * 4]
                    length = len(piece) // 4
                    for column, x in zip(out, (doc, start, length, zlib.crc32(piece), n, piece if length <= FILLER else None), strict=True):
                        column.append(x)
            at += len(part)
            kinds = (pa.int64(),) * 5 + (pa.binary(),)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])


def cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def place(lengths: list[int], divisible: list[bool]) -> list[list[tuple[int, int, int, int]]]:
    """Assign pieces, longest first, to the cheapest sequence with room: (sequence, offset, from, length) parts of each piece.

    As many sequences as the tokens need are open from the start. A piece that
    fits nowhere opens a new sequence, or is cut if it is divisible.
    """
    n = max(1, math.ceil(sum(lengths) / SEQUENCE))
    room = [SEQUENCE] * n
    spent = [0.0] * n
    cheap = [(0.0, b) for b in range(n)]
    waiting: list[tuple[int, int]] = []  # sequences too full for the pieces so far, roomiest first
    parts: list[list[tuple[int, int, int, int]]] = [[] for _ in lengths]

    def put(i: int, b: int, at: int, length: int) -> None:
        parts[i].append((b, SEQUENCE - room[b], at, length))
        room[b] -= length
        spent[b] += cost(length)
        if room[b]:
            heapq.heappush(cheap, (spent[b], b))

    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at, left = 0, lengths[i]
        while left:
            while waiting and -waiting[0][0] >= left:
                b = heapq.heappop(waiting)[1]
                heapq.heappush(cheap, (spent[b], b))
            while cheap and room[cheap[0][1]] < left:
                b = heapq.heappop(cheap)[1]
                heapq.heappush(waiting, (-room[b], b))
            if cheap:
                b, length = heapq.heappop(cheap)[1], left
            elif divisible[i] and waiting:
                b = heapq.heappop(waiting)[1]
                length = room[b]
            else:
                room.append(SEQUENCE)
                spent.append(0.0)
                b, length = len(room) - 1, left
            put(i, b, at, length)
            at, left = at + length, left - length
    return parts


def pack_group(key: tuple, table: pa.Table) -> pa.Table:
    rows = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]).to_pylist()
    parts = place([r["length"] for r in rows], [r["ids"] is not None for r in rows])
    used: dict[int, int] = {}
    for p in parts:
        for b, _, _, n in p:
            used[b] = used.get(b, 0) + n
    out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_to")}
    for r, p in zip(rows, parts, strict=True):
        for b, offset, at, n in p:
            crc = r["ids_crc32"] if n == r["length"] else zlib.crc32(r["ids"][at * 4 : (at + n) * 4])
            padded = used[b] if used[b] & (used[b] - 1) == 0 else SEQUENCE
            for k, x in zip(out, (r["doc_id"], r["start"] + at, n, crc, r["doc_tokens"], (key[0].as_py() << 32) + b, offset, padded), strict=True):
                out[k].append(x)
    return pa.table({k: pa.array(x, pa.int64()) for k, x in out.items()})


def pack(docs: DataFrame, tokenizer: str, seed: int = 0) -> DataFrame:
    """Pack all documents into sequences of at most SEQUENCE tokens.

    A document's ids end with END_ID; a null or empty text is END_ID alone. Each
    document is cut into pieces of SEQUENCE tokens and a remainder. Pieces are
    dealt by hash to groups of about GROUP sequences, or GROUP_PIECES pieces where
    texts are short; in a group the longest
    piece goes first, each to the sequence of the lowest attention cost that has
    room. Pieces of up to FILLER tokens are cut where they would open a new
    sequence. A sequence is padded to SEQUENCE unless its length is a power of
    two (``padded_to``). Repeated rows and null ids are packed as documents of
    their own; other columns are ignored; an empty table gives no rows. A group's
    size doesn't depend on any key of the data, so hot sources or copies don't
    gather in a task.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = written(rows.mapInArrow(lambda it: cut_pieces(it, tokenizer), PIECES), "pieces")
    total, n = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    groups = max(1, math.ceil(total / (SEQUENCE * GROUP)), math.ceil(n / GROUP_PIECES))
    group = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", F.monotonically_increasing_id()), F.lit(groups))
    return pieces.groupBy(group.alias("g")).applyInArrow(pack_group, PLACED)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_pack(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), tokenizer or default_tokenizer())
