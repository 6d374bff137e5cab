"""Packing token sequences by shortest-pack-first over the length histogram.

Documents become byte-level BPE ids followed by one end id, are cut into pieces
of at most ``max_len`` and packed: lengths are placed longest first, each time
into the pattern with the most room left, and only the counts of patterns are
updated. The histogram has at most ``max_len`` bins, so planning is driver work
of a fixed size; documents meet the patterns again by their rank among pieces
of equal length.

What happens in special cases:

* a null text is an empty text: one piece that holds the end id;
* rows that share an id are packed as separate documents (their pieces carry
  the same id);
* the order among pieces of equal length is that of (salt, id, start, crc), so
  reruns agree; fully equal rows are interchangeable;
* other columns of the input are not carried; an empty table gives an empty
  result.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.llm.memory import held, release_memory
from presslens.shared import materialise

MAX_LEN = 1024
END_ID = 0
#: Pieces of one length are ranked in groups of about so many, so that a frequent length is no single task.
RANKED = 250_000
#: Groups of a length at least, so that copies of one length spread at any size.
LEAST_GROUPS = 64
#: Bytes of chunks whose ids a worker remembers, about; the memory starts again beyond it.
CACHE_BYTES = 48 << 20
PUNCTUATION = ".,;:!?"
#: Chunks on which both libraries must agree before the faster one fills the memory.
SAMPLES = (" tokenization", "Straße,", " éèàçü", " 12345.67", "don't", " \u4e2d\u6587\u5b57", " \u0440\u0443\u0441\u0441\u043a\u0438\u0439", "!!!???", " \U0001f600\u200d", "\u0e44\u0e17\u0e22", " unbelievableness", "_x9_", "\u00ad\u0301")


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    The tokenizer splits at single spaces and single line breaks in any case,
    so the ids of a text are those of its space-separated chunks in a row, and
    a chunk's ids are remembered. Texts with other white space, runs of white
    space or special tokens go through the tokenizer in one piece.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.newline = self.whole("\n")
        self.ranks = self._ranks()
        self.held = 0
        self.first = _Chunks(self, "")
        self.after_space = _Chunks(self, " ")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _ranks(self):
        """The same vocabulary for the faster library, or None if it isn't byte-level BPE merged in the order of ids."""
        import public_tokenizers
        import tiktoken

        shown = {chr(b): b for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
        hidden = [b for b in range(256) if b not in shown.values()]
        shown |= {chr(256 + k): b for k, b in enumerate(hidden)}
        try:
            ranks = {bytes(shown[c] for c in token): i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token not in self.special}
            fast = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            same = all(fast.encode_ordinary(x) == self.tokenizer.encode(x, add_special_tokens=False).ids for x in SAMPLES)
        except (KeyError, ValueError):
            return None
        return fast if same else None

    def chunk(self, text: str) -> bytes:
        if self.ranks is None:
            return self.whole(text)
        return np.array(self.ranks.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if "\n\n\n" in text or text.endswith("\n\n") or any(s in text for s in self.special):
            return self.whole(text)
        out: list[bytes] = []
        first, after_space = self.first, self.after_space
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(self.newline)
            if line:
                chunks = line.split(" ")
                if chunks != line.split():
                    return self.whole(text)
                out.append(first[chunks[0]])
                out.extend(map(after_space.__getitem__, chunks[1:]))
        if self.held > CACHE_BYTES:
            first.clear()
            after_space.clear()
            self.held = 0
        return b"".join(out)


class _Chunks(dict):
    """Ids of chunks that follow ``before``."""

    def __init__(self, encoder: Encoder, before: str):
        super().__init__()
        self.encoder, self.before = encoder, before

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) > 1 and chunk[-1] in PUNCTUATION and chunk[-2].isalpha():
            ids = self[chunk[:-1]] + self.encoder.first[chunk[-1]]  # letters and marks are never merged
        else:
            ids = self.encoder.chunk(self.before + chunk)
        self[chunk] = ids
        self.encoder.held += 160 + 2 * len(chunk) + len(ids)
        return ids


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; what other operators kept goes."""
    release_memory(("encoder", path))
    return held(("encoder", path), lambda: Encoder(path))


def _cut(batches: Iterator[pa.RecordBatch], path: str, max_len: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encode, end, width = encoder(path).encode, np.array([end_id], "<u4").tobytes(), 4 * max_len
    for batch in batches:
        rows, start, length, crc, tokens = [], [], [], [], []
        for row in range(batch.num_rows):
            ids = encode(batch.column(1)[row].as_py() or "") + end
            for at in range(0, len(ids), width):
                piece = ids[at : at + width]
                rows.append(row)
                start.append(at // 4)
                length.append(len(piece) // 4)
                crc.append(zlib.crc32(piece))
                tokens.append(len(ids) // 4)
        columns = [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, length, crc, tokens)]]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: documents as token pieces of at most ``max_len``."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")]])
    return docs.select(id_col, text_col).mapInArrow(lambda batches: _cut(batches, tokenizer, max_len, end_id), schema)


def plan(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with their counts, by shortest-pack-first (most room left first)."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        space = max_len
        while left:
            while space >= length and not room[space]:
                space -= 1
            if space < length:
                pattern, count = (), left
            else:
                pattern, count = room[space].pop()
            take = min(left, count)
            if count > take:
                room[space].append((pattern, count - take))
            rest = (max_len if space < length else space) - length
            room[rest].append(((*pattern, length), take))
            left -= take
            space = max(space, rest)
    return [x for space in sorted(room) for x in room[space]]


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Per length a run of slots; a slot takes the next ``count`` ranks into consecutive sequences at one offset."""
    by_length: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            by_length[length].append((count, sequence, offset))
            offset += length
        sequence += count
    rows, first, at = [], {}, 0
    for length in sorted(by_length):
        first[length] = at
        for count, base, offset in by_length[length]:
            rows.append((at, base, offset))
            at += count
    starts, bases, offsets = np.array(rows, np.int64).reshape(-1, 3).T
    return {"first": first, "starts": starts, "bases": bases, "offsets": offsets}


def pack(cut: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces."""
    cut = materialise(cut, "pack-pieces")
    found = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most max_len rows
    groups = {length: max(LEAST_GROUPS, -(-n // RANKED)) for length, n in found.items()}
    salts = F.broadcast(cut.sparkSession.createDataFrame(sorted(groups.items()), "g_length long, salts long"))
    cut = cut.join(salts, F.col("length") == F.col("g_length")).drop("g_length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.col("salts"))).drop("salts")
    slots = _slots(plan(found, max_len))
    # A group's ranks follow those of the groups before it; groups of a length stand in a row.
    place_of, first = np.zeros(max_len + 1, np.int64), np.zeros(sum(groups.values()), np.int64)
    at = 0
    for length in sorted(groups):
        place_of[length] = at
        at += groups[length]
    counts = {(r["length"], r["salt"]): r["count"] for r in cut.groupBy("length", "salt").count().collect()}  # at most max_len * LEAST_GROUPS rows, and one for RANKED pieces
    for length, n in groups.items():
        before = slots["first"][length]
        for salt in range(n):
            first[place_of[length] + salt] = before
            before += counts.get((length, salt), 0)
    shared = cut.sparkSession.sparkContext.broadcast((place_of, first, slots["starts"], slots["bases"], slots["offsets"]))
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")).cast("long"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place_of, first, starts, bases, offsets = shared.value
        for batch in batches:
            length, salt, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "salt", "rank"))
            at = first[place_of[length] + salt] + rank - 1
            slot = np.searchsorted(starts, at, "right") - 1
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(bases[slot] + at - starts[slot]), pa.array(offsets[slot])], names=[*names, "sequence_id", "offset"])

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = T.StructType([*[cut.schema[c] for c in names], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)
