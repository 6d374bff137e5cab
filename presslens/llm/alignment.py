"""Alignment of two tokenizers' tokens over a corpus, by external spill counting.

A text is encoded by a byte-level BPE (A, with a space before it) and by a piece
BPE (B, which adds the space itself); an A and a B token that end at the same
byte are linked. How often a pair of ids is linked in the whole corpus is
counted outside memory:

* each task turns documents into records (B id, A id, document, times), already
  added up within a document, and when it holds ``RUN`` of them it deals them by
  a radix of the B id and writes each part as a run: records in side-major order
  (B id, A id, document), cut into blocks of zstd frames. Runs are rows of a
  table in the shared folder, so a lost executor costs no counts;
* the runs of a radix are merged by a heap over their blocks: the block that ends
  first says up to which pair all runs can be read. As the order is side-major,
  a pair's count is complete when the next pair comes, a B id's highest count when
  the next B id comes, and then the records behind it are streamed back as
  contributions to their documents;
* a radix of more than ``MERGED`` records (a frequent B id, or a large corpus) is
  sliced by runs: the slices' counts are merged first and added up by Spark, and
  a second merge of each slice, beside the corpus-wide counts of its own pairs,
  streams the contributions back.

Memory of a task is bounded by RUN and MERGED records; what documents get back
is added up by document within each slice before it is shuffled.

Texts are split at single spaces and line breaks, where neither vocabulary has a
token that goes across, so that the tokens of a chunk are found once; texts with
other white space are encoded in one piece.

What happens in special cases:

* null and empty texts, and texts whose tokens' bytes differ from a space and
  the text (as with U+2581, which B reads as a space), have no tokens: all
  figures are 0 and the digest is ``''``;
* strings of special tokens are plain text;
* rows that share an id, or are equal, count as documents of their own;
* other columns of the input are not carried; an empty table gives an empty
  result.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.llm.memory import held, release_memory
from presslens.llm.packing import Encoder
from presslens.shared import materialise

#: Radices of B ids.
RADICES = 32
#: Records that a task holds before it writes runs.
RUN = 1 << 20
#: Records in a block.
BLOCK = 1 << 14
#: Records of a slice, about; a radix with more is sliced by runs.
MERGED = 4_000_000
#: Bytes of chunks that a worker remembers, about.
CACHE_BYTES = 192 << 20
#: Documents, and characters, encoded at a time.
AT_ONCE, AT_ONCE_CHARS = 256, 1 << 20
ID_BITS = 24
SPACE = "▁"


class Side:
    """Byte strings and encoders of both vocabularies."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        shown = {chr(b): b for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
        shown |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown.values())}
        self.a_bytes: list[bytes] = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(shown[c] for c in token) if all(c in shown for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in said], np.int64) for said in (self.a_bytes, self.b_bytes))
        # Ids as text with each mark that may follow: 2 for A, then 3 for B.
        self.b_marked = 3 * len(self.b_bytes)
        self.marked = [f"{i}{mark}" for i in range(len(self.a_bytes)) for mark in ",|"] + [f"{i}{mark}" for i in range(len(self.b_bytes)) for mark in (",", ";", "\n")]
        self.quick = Encoder(a_path).ranks
        # Chunks can be encoded apart if no piece goes across a space or line break.
        self.apart = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces)

    def a_ids(self, texts: list[str]) -> list[list[int]]:
        if self.quick is not None:  # the same vocabulary in a faster library; both agree on samples
            return [self.quick.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """A ids of a space and each text, and B ids of each text."""
        return self.a_ids([" " + t for t in texts]), self.b.encode(texts, num_threads=1)

    def encode_inner(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of texts that follow a line break."""
        return self.a_ids(texts), [ids[2:] for ids in self.b.encode(["\n" + t for t in texts], num_threads=1)]


#: Groups as text, linked keys, tokens of A and of B, groups.
Aligned = tuple[str, np.ndarray, int, int, int]


def aligned(side: Side, wholes: list[bytes], a: list[list[int]], b: list[list[int]]) -> list[Aligned | None]:
    """The tokens of stretches of text that both sides cover byte by byte; None for others.

    All stretches are laid end to end, so ends of tokens are compared in one go.
    """
    good = [b"".join([side.a_bytes[i] for i in x]) == w == b"".join([side.b_bytes[i] for i in y]) for w, x, y in zip(wholes, a, b, strict=True)]
    a, b = [x for x, g in zip(a, good, strict=True) if g], [y for y, g in zip(b, good, strict=True) if g]
    if not a:
        return [None] * len(wholes)
    a_ids, b_ids = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
    a_ends, b_ends = np.cumsum(side.a_sizes[a_ids]), np.cumsum(side.b_sizes[b_ids])
    a_cuts, b_cuts = np.isin(a_ends, b_ends, assume_unique=True), np.isin(b_ends, a_ends, assume_unique=True)
    keys = b_ids[b_cuts] << ID_BITS | a_ids[a_cuts]
    a_last, b_last = np.cumsum([len(x) for x in a]) - 1, np.cumsum([len(y) for y in b]) - 1
    # Tokens in the order of the text, each with the mark that follows it.
    a_marks, b_marks = a_cuts.astype(np.int64), b_cuts.astype(np.int64)
    b_marks[b_last] = 2
    order = np.argsort(np.concatenate([2 * (np.cumsum(a_cuts) - a_cuts), 2 * (np.cumsum(b_cuts) - b_cuts) + 1]), kind="stable")
    said = np.concatenate([2 * a_ids + a_marks, 3 * b_ids + b_marks + len(side.marked) - side.b_marked])[order]
    groups = "".join([side.marked[k] for k in said.tolist()]).split("\n")
    ends = np.cumsum(a_cuts)[a_last].tolist()
    found = zip(groups, [keys[x:y].copy() for x, y in zip([0, *ends], ends, strict=False)], map(len, a), map(len, b), np.diff(ends, prepend=0).tolist(), strict=False)
    return [next(found) if g else None for g in good]


class Aligner:
    """Aligns texts; remembers chunks."""

    def __init__(self, a_path: str, b_path: str):
        self.side = Side(a_path, b_path)
        # Two generations: when the younger is full, the elder goes; chunks in use have moved to the younger by then.
        self.known: dict[str, Aligned | None] = {}
        self.elder: dict[str, Aligned | None] = {}
        self.held = 0

    def _learn(self, chunks: set[str]) -> None:
        """Chunks begin with a space, or follow a line break; a line break is a chunk itself."""
        led = [c for c in chunks if c[0] == " "]
        inner = [c for c in chunks if c[0] != " "]
        for some, ids in ((led, self.side.encode([c[1:] for c in led])), (inner, self.side.encode_inner(inner))):
            for chunk, found in zip(some, aligned(self.side, [c.encode() for c in some], *ids), strict=True):
                self._hold(chunk, found)

    def _hold(self, chunk: str, found: Aligned | None) -> None:
        self.known[chunk] = found
        self.held += 400 + 3 * len(chunk) + (len(found[0]) + 8 * found[4] if found else 0)

    def _cut(self, text: str) -> list[str] | None:
        """The chunks of a text, or None if it can't be cut."""
        if not self.side.apart or "\n\n\n" in text or text.endswith("\n\n") or text[0] == "\n":
            return None
        out: list[str] = []
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append("\n")
            if line:
                chunks = line.split(" ")
                if chunks != line.split():
                    return None
                out.append(chunks[0] if k else " " + chunks[0])
                out.extend([" " + c for c in chunks[1:]])
        return out

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
        """n_a, n_b, n_groups, digest, linked keys and their times, of each text."""
        cuts = [self._cut(t) if t else None for t in texts]
        if self.held > CACHE_BYTES / 2:
            self.known, self.elder, self.held = {}, self.known, 0
        new = set().union(*[c for c in cuts if c]).difference(self.known)
        for chunk in new & self.elder.keys():
            self._hold(chunk, self.elder[chunk])
        self._learn(new.difference(self.known))
        for text, cut in zip(texts, cuts, strict=True):
            if not text:
                parts = []
            elif cut is not None:
                parts = [self.known[c] for c in cut]
            else:
                parts = aligned(self.side, [(" " + text).encode()], *self.side.encode([text]))
            if not parts or None in parts:
                yield 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
                continue
            groups, keys, n_a, n_b, n_groups = zip(*parts, strict=True)
            found, times = np.unique(np.concatenate(keys), return_counts=True)
            yield sum(n_a), sum(n_b), sum(n_groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), found, times


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner; what other operators kept goes."""
    key = ("aligner", a_path, b_path)
    release_memory(key)
    return held(key, lambda: Aligner(a_path, b_path))


def radix(keys: np.ndarray) -> np.ndarray:
    """Radix of the keys' B ids; the ids are mixed, as frequent ones stand together."""
    return (((keys >> ID_BITS) * 2654435761 & 0xFFFFFFFF) >> 16) % RADICES


def pack_block(keys: np.ndarray, docs: np.ndarray, times: np.ndarray) -> bytes:
    """A block as one zstd frame: differences of keys and documents, and times."""
    import zstandard

    said = [np.diff(keys, prepend=0), np.diff(docs.astype(np.int64), prepend=0).astype("<i4"), times.astype("<u4")]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.astype(x.dtype.newbyteorder("<")).tobytes() for x in said))


def unpack_block(frame: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(frame)
    n = len(raw) // 16
    return np.cumsum(np.frombuffer(raw, "<i8", n)), np.cumsum(np.frombuffer(raw, "<i4", n, 8 * n).astype(np.int64)), np.frombuffer(raw, "<u4", n, 12 * n).astype(np.int64)


class Runs:
    """Records of a task, written out as runs by radix when there are enough."""

    def __init__(self, block: int) -> None:
        self.held: list[tuple[np.ndarray, int, np.ndarray]] = []
        self.block, self.n, self.written = block, 0, 0

    def add(self, keys: np.ndarray, doc: int, times: np.ndarray) -> None:
        self.held.append((keys, doc, times))
        self.n += len(keys)

    def flush(self) -> Iterator[tuple[int, int, int, list[bytes]]]:
        """(radix, run, records, blocks) of what is held."""
        if not self.n:
            return
        keys = np.concatenate([k for k, _, _ in self.held])
        docs = np.repeat(np.array([d for _, d, _ in self.held], np.int64), [len(k) for k, _, _ in self.held])
        times = np.concatenate([t for _, _, t in self.held])
        of = radix(keys)
        order = np.argsort((of << (2 * ID_BITS)) | keys, kind="stable")  # documents stay in order
        keys, docs, times, of = keys[order], docs[order], times[order], of[order]
        starts = np.searchsorted(of, np.arange(RADICES + 1))
        for r, (lo, hi) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
            if lo < hi:
                cuts = [slice(at, min(at + self.block, hi)) for at in range(lo, hi, self.block)]
                yield r, self.written, hi - lo, [pack_block(keys[c], docs[c], times[c]) for c in cuts]
        self.held, self.n, self.written = [], 0, self.written + 1


def merge(runs: list[Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, run numbers, documents, times) in order of keys, from runs of blocks in order of keys.

    One heap holds where the runs' open blocks end, the other where they go on.
    The block that ends first bounds what can be read: no run has a smaller key
    behind its open block. A key may go on in the next batch.
    """
    blocks: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    ends: list[tuple[int, int]] = []
    heads: list[tuple[int, int]] = []

    def step(run: int) -> None:
        block = next(runs[run], None)
        if block is not None:
            blocks[run] = block
            heapq.heappush(ends, (int(block[0][-1]), run))
            heapq.heappush(heads, (int(block[0][0]), run))

    for run in range(len(runs)):
        step(run)
    while ends:
        end, _ = ends[0]
        taken = []
        while heads and heads[0][0] <= end:
            _, run = heapq.heappop(heads)
            keys, docs, times = blocks[run]
            n = int(np.searchsorted(keys, end, "right"))
            taken.append((keys[:n], np.full(n, run), docs[:n], times[:n]))
            if n < len(keys):
                blocks[run] = (keys[n:], docs[n:], times[n:])
                heapq.heappush(heads, (int(keys[n]), run))
        done = []
        while ends and ends[0][0] == end:
            done.append(heapq.heappop(ends)[1])
        for run in done:
            step(run)
        keys, of, docs, times = (np.concatenate(x) for x in zip(*taken, strict=True))
        order = np.argsort(keys, kind="stable")
        yield keys[order], of[order], docs[order], times[order]


def by_side(batches: Iterator[tuple[np.ndarray, ...]], shift: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Batches cut so that no value of keys >> shift is divided."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        side = batch[0] >> shift
        cut = int(np.searchsorted(side, side[-1], "left"))
        if held and cut == 0 and (held[-1][0][-1] >> shift) == side[0]:
            held.append(batch)
            continue
        if held and (held[-1][0][-1] >> shift) != side[0]:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held = []
        if cut:
            held.append(tuple(x[:cut] for x in batch))
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held = []
        held.append(tuple(x[cut:] for x in batch))
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


class Back:
    """Contributions to documents, added up by document."""

    def __init__(self) -> None:
        self.rows: list[np.ndarray] = []
        self.n = 0

    def add(self, docs: np.ndarray, sums: np.ndarray, best: np.ndarray) -> None:
        self.rows.append(np.stack([docs, sums, best]))
        self.n += len(docs)
        if self.n > 2 * BLOCK and self.n > 2 * len(self.rows[0][0]):
            self._fold()

    def _fold(self) -> None:
        docs, sums, best = np.concatenate(self.rows, axis=1)
        order = np.argsort(docs, kind="stable")
        docs = docs[order]
        starts = np.flatnonzero(np.diff(docs, prepend=-1))
        self.rows = [np.stack([docs[starts], np.add.reduceat(sums[order], starts), np.add.reduceat(best[order], starts)])]
        self.n = len(starts)

    def table(self) -> pa.Table:
        if self.rows:
            self._fold()
        docs, sums, best = self.rows[0] if self.rows else np.zeros((3, 0), np.int64)
        return pa.table({"row": docs, "count_sum": sums, "n_best": best})


def _opened(group: pa.Table) -> tuple[list[Iterator], np.ndarray]:
    """The runs of a group as iterators of blocks, and the first row number of each run's task."""
    blocks = group.column("blocks")
    return [map(unpack_block, (frame.as_py() for frame in blocks[k])) for k in range(len(group))], group.column("base").to_numpy()


def whole_sides(group: pa.Table) -> pa.Table:
    """Contributions from all runs of a radix: counts and maxima as they pass, then the records behind them."""
    runs, base = _opened(group)
    back = Back()
    for keys, of, docs, times in by_side(merge(runs), ID_BITS):
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        counts = np.add.reduceat(times, starts)
        sides = np.flatnonzero(np.diff(keys[starts] >> ID_BITS, prepend=-1))
        highest = np.repeat(np.maximum.reduceat(counts, sides), np.diff(sides, append=len(starts)))
        reach = np.diff(starts, append=len(keys))
        back.add(base[of] + docs, times * np.repeat(counts, reach), times * np.repeat(counts == highest, reach))
    return back.table()


def slice_counts(group: pa.Table) -> pa.Table:
    """Counts of the pairs of a slice."""
    runs, _ = _opened(group)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for keys, _, _, times in by_side(merge(runs), 0):
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        found.append((keys[starts], np.add.reduceat(times, starts)))
    keys, counts = (np.concatenate(x) for x in zip(*found, strict=True))
    radix_, slice_ = (np.full(len(keys), group.column(c)[0].as_py()) for c in ("radix", "slice"))
    return pa.table({"radix": radix_, "slice": slice_, "pair": keys, "n": counts})


def slice_back(group: pa.Table, book: pa.Table) -> pa.Table:
    """Contributions of a slice's records, beside the corpus-wide counts of its pairs."""
    runs, base = _opened(group)
    pairs, totals, best = (book.column(c).to_numpy() for c in ("pair", "total", "best"))
    order = np.argsort(pairs)
    pairs, totals, best = pairs[order], totals[order], best[order]
    back = Back()
    for keys, of, docs, times in merge(runs):
        at = np.searchsorted(pairs, keys)
        back.add(base[of] + docs, times * totals[at], times * best[at])
    return back.table()


def spill(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, run: int = RUN, block: int = BLOCK) -> DataFrame:
    """A table with one row a document (its figures) and one a run (``radix, run, base, n, blocks``)."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *[T.StructField(c, T.LongType()) for c in ("row", "n_a", "n_b", "n_groups")], T.StructField("groups_sha256", T.StringType())])
    schema = T.StructType([*schema.fields, *[T.StructField(c, T.LongType()) for c in ("radix", "run", "base", "n")], T.StructField("blocks", T.ArrayType(T.BinaryType()))])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, runs, n = aligner(a_path, b_path), Runs(block), 0
        part = TaskContext.get().partitionId()
        base = part << 32

        def spilled() -> Iterator[pa.RecordBatch]:
            for r, nth, size, blocks in runs.flush():
                one = [*[pa.nulls(1, t) for t in kinds[:6]], *[pa.array([x], pa.int64()) for x in (r, base | nth, base, size)], pa.array([blocks], kinds[10])]
                yield pa.RecordBatch.from_arrays(one, names=names)

        for batch in batches:
            kinds, names = [batch.schema.field(0).type, *[pa.int64()] * 4, pa.string(), *[pa.int64()] * 4, pa.list_(pa.binary())], schema.names
            for at in _slices(batch.column(1)):
                some = batch.slice(at.start, at.stop - at.start)
                found = []
                for n_a, n_b, n_groups, digest, keys, times in known.align(some.column(1).to_pylist()):
                    runs.add(keys, n, times)
                    found.append((base | n, n_a, n_b, n_groups, digest))
                    n += 1
                columns = [pa.array(x, t) for x, t in zip(zip(*found, strict=True), kinds[1:6], strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(0), *columns, *[pa.nulls(len(some), t) for t in kinds[6:]]], names=names)
                if runs.n >= run:
                    yield from spilled()
        if runs.n:
            yield from spilled()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(write, schema)


def _slices(texts: pa.Array) -> Iterator[slice]:
    """Stretches of rows of AT_ONCE rows and about AT_ONCE_CHARS characters at most."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
    first = held = 0
    for k, size in enumerate(sizes):
        if k > first and (k - first >= AT_ONCE or held + size > AT_ONCE_CHARS):
            yield slice(first, k)
            first, held = k, 0
        held += size
    if first < len(sizes):
        yield slice(first, len(sizes))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", merged: int = MERGED, run: int = RUN, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    stored = materialise(spill(docs, a_path, b_path, id_col, text_col, run, block), "align-runs")
    runs = stored.filter("radix IS NOT NULL").select("radix", "run", "base", "n", "blocks")
    sizes = {r["radix"]: r["n"] for r in runs.groupBy("radix").agg(F.sum("n").alias("n")).collect()}  # RADICES rows at most
    sliced = {r: -(-n // merged) for r, n in sizes.items() if n > merged}
    schema = "row long, count_sum long, n_best long"
    back = runs.filter(~F.col("radix").isin(list(sliced))).groupBy("radix").applyInArrow(whole_sides, schema)
    if sliced:
        parts = F.create_map(*[F.lit(x) for pair in sliced.items() for x in pair])
        cut = runs.filter(F.col("radix").isin(list(sliced))).withColumn("slice", F.pmod(F.xxhash64("run"), F.element_at(parts, F.col("radix"))))
        counts = materialise(cut.groupBy("radix", "slice").applyInArrow(slice_counts, "radix long, slice long, pair long, n long"), "align-counts")
        totals = counts.groupBy("pair").agg(F.sum("n").alias("total"))
        totals = materialise(totals.withColumn("side", F.shiftright("pair", ID_BITS)), "align-totals")
        highest = totals.groupBy("side").agg(F.max("total").alias("highest"))  # a row a B id
        flagged = totals.join(highest, "side").select("pair", "total", (F.col("total") == F.col("highest")).cast("long").alias("best"))
        book = counts.select("radix", "slice", "pair").join(flagged, "pair")
        back = back.union(cut.groupBy("radix", "slice").cogroup(book.groupBy("radix", "slice")).applyInArrow(slice_back, schema))
    per = back.groupBy(F.col("row").alias("b_row")).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    rows = stored.filter("radix IS NULL").select("doc_id", "row", "n_a", "n_b", "n_groups", "groups_sha256")
    joined = rows.join(per, F.col("row") == F.col("b_row"), "left")
    zero = F.lit(0).cast("long")
    return joined.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
