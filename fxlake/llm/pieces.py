"""SentencePiece encoding with seeded merge-dropout, and decoding.

The vocabulary of a merge-type model (its path is a parameter) is read on the
driver and broadcast; it has a fixed size. A text is cut where no piece can
reach over: before each run of spaces and around newlines. Within a chunk an
agenda merges the best adjacent pair first; each candidate merge is skipped
when a keyed hash of (seed, document, place of the chunk, pair, place in the
chunk) falls under ``dropout``, so every occurrence of a word is segmented on
its own while the whole is reproducible. Characters that the model lacks become
byte pieces, a literal U+2581 too, so decoding gives the text back exactly.

Chunks of up to ``WIDTHS[-1]`` symbols are merged many at a time as rows of
arrays, longer ones by the agenda itself; both give the same pieces.

Cases: a null text stays null; an empty text has the pieces of the leading
space that every text gets; a null id counts as the id -1 for the hash;
repeated rows get equal pieces.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from fxlake.llm.text import U64, buffer, mix, released, slices, small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED, DROPOUT = 17, 0.1
SPACE = "▁"
#: Widths of the arrays that chunks are merged in, and cells of one such array.
WIDTHS, ROW_CELLS = (5, 8, 12, 18, 40, 96), 1 << 18
#: Bytes of text worked through at once; one text is never cut.
SLICE = 1 << 18


@dataclass
class Vocabulary:
    ids: dict[str, int]
    rank: dict[int, float]
    byte_ids: list[int]
    surface: list[bytes]
    piece: dict[int, str]


def load(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, rank, byte_ids, surface = {}, {}, [0] * 256, []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            value = int(piece[3:-1], 16)
            byte_ids[value] = k
            surface.append(bytes([value]))
        elif model.is_control(k) or model.is_unknown(k):
            surface.append(b"")
        else:
            ids[piece], rank[k] = k, model.get_score(k)
            surface.append(piece.replace(SPACE, " ").encode())
    if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in ids):
        raise ValueError("a piece reaches over a space or a newline: chunks would not be independent")
    return Vocabulary(ids, rank, byte_ids, surface, {k: p for p, k in ids.items()})


def symbols_of(chunk: str, vocabulary: Vocabulary) -> list[int]:
    """Ids of single characters, and of the bytes of characters that the model lacks."""
    out = []
    for c in chunk:
        k = None if c == SPACE else vocabulary.ids.get(SPACE if c == " " else c)
        out.extend([k] if k is not None else [vocabulary.byte_ids[x] for x in c.encode()])
    return out


def encode_chunk(chunk: str, vocabulary: Vocabulary, key: int, threshold: int) -> list[int]:
    return merge_symbols(symbols_of(chunk, vocabulary), vocabulary, key, threshold)


def merge_symbols(ids: list[int], vocabulary: Vocabulary, key: int, threshold: int) -> list[int]:
    """Merge the best pair first; skip a candidate when its keyed hash is below ``threshold`` of 2^20."""
    ids = list(ids)
    strings = [vocabulary.piece.get(k) for k in ids]
    n = len(ids)
    pieces, rank = vocabulary.ids, vocabulary.rank
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    agenda: list = []

    def propose(a: int, b: int) -> None:
        left, right = strings[a], strings[b]
        if left is None or right is None:
            return
        k = pieces.get(left + right)
        if k is None:
            return
        if threshold:
            h = (key ^ (ids[a] * 0x9E3779B1) ^ (ids[b] * 0x85EBCA77) ^ (a * 0xC2B2AE3D)) * 0x27D4EB2F165667C5 & 0xFFFFFFFFFFFFFFFF
            if (h >> 29 ^ h >> 43) & 0xFFFFF < threshold:
                return
        heapq.heappush(agenda, (-rank[k], a, b, k, len(left) + len(right)))

    for a in range(n - 1):
        propose(a, a + 1)
    while agenda:
        _, a, b, k, size = heapq.heappop(agenda)
        left, right = strings[a], strings[b]
        if left is None or right is None or after[a] != b or len(left) + len(right) != size:
            continue
        strings[a], ids[a] = left + right, k
        strings[b] = None
        ids[b] = -1
        c = after[a] = after[b]
        if c < n:
            before[c] = a
            propose(a, c)
        p = before[a]
        if p >= 0:
            propose(p, a)
    return [k for k in ids if k >= 0]


class PairTable:
    """Every pair of pieces that joins to a piece, for look-ups by the array; fixed by the vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        ids = vocabulary.ids
        found = [(ids[p[:k]] * (1 << 32) + ids[p[k:]], ids[p]) for p in ids for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        pair = np.array([k for k, _ in found], np.int64)
        joined = np.array([k for _, k in found], np.int32)
        # An open table with few pairs a slot: most look-ups end at the first probe.
        self.bits = max(10, int(4 * len(pair)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.joined = np.full(1 << self.bits, -1, np.int32)
        for k, to in zip(pair.tolist(), joined.tolist()):
            slot = int(self._slot(np.array([k], np.int64))[0])
            while self.keys[slot] >= 0:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.keys[slot], self.joined[slot] = k, to
        # Best first; position in this order stands for the score.
        self.order = np.full(len(vocabulary.surface), 1 << 30, np.int32)
        best = sorted(vocabulary.rank, key=lambda k: -vocabulary.rank[k])
        scores = [vocabulary.rank[k] for k in best]
        place = np.concatenate(([0], np.cumsum(np.diff(scores) != 0))) if scores else np.zeros(0)
        self.order[best] = place
        self.points = np.full(0x110000, -1, np.int32)
        for piece, k in ids.items():
            if len(piece) == 1 and piece != SPACE:
                self.points[ord(piece)] = k
        self.points[0x20] = ids[SPACE]

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        return ((pair.view(U64) * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The joined piece of each pair, -1 where there is none."""
        pair = (left.astype(np.int64) << 32) + right
        slot = self._slot(pair)
        held = self.keys[slot]
        out = np.where(held == pair, self.joined[slot], -1)
        rest = np.flatnonzero((held != pair) & (held >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)
            held = self.keys[slot[rest]]
            hit = held == pair[rest]
            out[rest[hit]] = self.joined[slot[rest[hit]]]
            rest = rest[~hit & (held >= 0)]
        return out


NONE = 1 << 30


def _skipped(key: np.ndarray, left: np.ndarray, right: np.ndarray, at: np.ndarray, threshold: int) -> np.ndarray:
    """Whether each candidate merge is skipped: the same keyed hash as in ``encode_chunk``."""
    h = (key ^ (left.astype(U64) * U64(0x9E3779B1)) ^ (right.astype(U64) * U64(0x85EBCA77))
         ^ (at.astype(U64) * U64(0xC2B2AE3D))) * U64(0x27D4EB2F165667C5)
    return ((h >> U64(29)) ^ (h >> U64(43))) & U64(0xFFFFF) < U64(threshold)


def encode_many(ids: np.ndarray, sizes: np.ndarray, table: PairTable, keys: np.ndarray | None = None, threshold: int = 0,
                seen: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``encode_chunk`` for many chunks at once. ids: a row of symbols each, padded; keys: one a row. Returns rows and sizes.

    ``seen`` receives every candidate that came up, as arrays of row, left, right and place.
    """
    n, width = ids.shape
    ids = ids.copy()
    place = np.broadcast_to(np.arange(width, dtype=np.int32), ids.shape).copy()
    out, out_sizes = ids.copy(), sizes.copy()
    active = np.arange(n)

    def propose(row, left, right, at, key):
        joined = table.join(left, right)
        rank = np.where(joined >= 0, table.order[joined], NONE)
        if seen is not None:
            k = np.flatnonzero(joined >= 0)
            seen.append((row[k], left[k], right[k], at[k]))
        if threshold:
            rank[_skipped(key, left, right, at, threshold)] = NONE
        return rank

    if width > 1:
        keys = np.zeros(n, U64) if keys is None else keys
        rank = np.full((n, width), NONE, np.int32)
        r, c = np.nonzero(np.arange(1, width) < sizes[:, None])
        rank[r, c] = propose(r, ids[r, c], ids[r, c + 1], place[r, c], keys[r])
        while len(active):
            at = rank.argmin(axis=1)
            rows = np.arange(len(active))
            live = rank[rows, at] < NONE
            if not live.all():
                done = ~live
                out[active[done], :width], out_sizes[active[done]] = ids[done], sizes[done]
                active, ids, place, rank, sizes, at, keys = (x[live] for x in (active, ids, place, rank, sizes, at, keys))
                rows = np.arange(len(active))
            if not len(active) or width == 1:
                break
            ids[rows, at] = table.join(ids[rows, at], ids[rows, at + 1])
            # Every row loses its right partner, so the arrays get one column narrower.
            keep = np.ones((len(active), width), bool)
            keep[rows, at + 1] = False
            width -= 1
            ids, place, rank = (x[keep].reshape(len(active), width) for x in (ids, place, rank))
            sizes = sizes - 1
            rank[rows, at] = NONE
            rank[rows, sizes - 1] = NONE
            k = np.flatnonzero(at + 1 < sizes)
            rank[k, at[k]] = propose(active[k], ids[k, at[k]], ids[k, at[k] + 1], place[k, at[k]], keys[k])
            k = np.flatnonzero(at > 0)
            rank[k, at[k] - 1] = propose(active[k], ids[k, at[k] - 1], ids[k, at[k]], place[k, at[k] - 1], keys[k])
    return out, out_sizes


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of all ranges behind each other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Chunks:
    """The chunks of a column of texts: symbols, ranges, text and place of each.

    A chunk is a newline, or spaces with what follows them up to the next space
    or newline. Every text gets a leading space. A character of the vocabulary
    is one symbol, any other one a symbol a byte.
    """

    def __init__(self, texts: pa.Array, encoder: "Encoder"):
        raw, offsets = buffer(texts)
        lead = np.asarray(texts.is_valid().to_numpy(zero_copy_only=False), np.int64)
        shift = np.cumsum(lead)
        self.bounds = offsets + np.concatenate(([0], shift))
        data = np.full(int(self.bounds[-1]), 0x20, np.uint8)
        sizes = np.diff(offsets)
        data[np.arange(len(raw)) + np.repeat(shift, sizes)] = raw
        self.data = data
        n = len(data)
        space, line = data == 0x20, data == 0x0A
        begin = line.copy()
        begin[1:] |= line[:-1] | (space[1:] & ~space[:-1])
        begin[self.bounds[:-1][self.bounds[:-1] < self.bounds[1:]]] = True
        self.starts = np.flatnonzero(begin)
        self.ends = np.append(self.starts[1:], n) if len(self.starts) else self.starts
        first = np.searchsorted(self.starts, self.bounds)
        self.of_text = first
        self.text = np.repeat(np.arange(len(sizes)), np.diff(first))
        self.place = np.arange(len(self.starts)) - first[:-1][self.text]
        lead_byte = (data & 0xC0) != 0x80
        char = np.cumsum(lead_byte) - 1
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        known = encoder.table.points[points]
        own = known[char] if n else np.zeros(0, np.int32)
        keep = lead_byte | (own < 0)
        self.symbols = np.where(own < 0, encoder.byte_ids[data], own)[keep].astype(np.int32)
        total = np.concatenate(([0], np.cumsum(keep)))
        self.sym_starts, self.sym_sizes = total[self.starts], total[self.ends] - total[self.starts]


class Encoder:
    """Encodes columns of texts.

    Per slice the chunks' dropout-free merges are worked out once for each
    distinct chunk, with the candidates that come up in them. A chunk in which
    its own key skips none of these has that answer; all others are merged
    with their own key. Keys come from seed, document and the chunk's place.
    """

    def __init__(self, vocabulary: Vocabulary, seed: int = SEED, dropout: float = DROPOUT, table: PairTable | None = None):
        self.vocabulary, self.seed, self.threshold = vocabulary, seed, int(dropout * (1 << 20))
        self.table = table or PairTable(vocabulary)
        self.byte_ids = np.array(vocabulary.byte_ids, np.int32)
        self.surface = np.frombuffer(b"".join(vocabulary.surface), np.uint8)
        ends = np.cumsum([len(x) for x in vocabulary.surface])
        self.surface_sizes = np.diff(np.concatenate(([0], ends)))
        self.surface_starts = ends - self.surface_sizes

    def keys(self, docs: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The key of the chunk at ``place`` of each document."""
        own = mix(np.array([self.seed], np.int64).view(U64))
        return mix(place.astype(U64) + mix(docs.astype(np.int64).view(U64) + own))

    def _merge(self, symbols, starts, sizes, keys=None, seen=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of the chunks at symbols[starts:starts + sizes]: flat ids in some order, and where each chunk's begin and how many they are."""
        flat, begin, count, at = [], np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), 0
        low = 0
        for width in WIDTHS:
            some = np.flatnonzero((sizes <= width) & (sizes > low))
            low = width
            for take in np.array_split(some, max(1, -(-len(some) * width // ROW_CELLS))):
                if not len(take):
                    continue
                cols = np.arange(width)
                inside = cols < sizes[take][:, None]
                rows = np.where(inside, symbols[np.minimum(starts[take][:, None] + cols, len(symbols) - 1)], -1)
                mine = [] if seen is not None else None
                got, got_sizes = encode_many(rows, sizes[take], self.table, None if keys is None else keys[take],
                                             0 if keys is None else self.threshold, mine)
                if seen is not None:
                    seen.extend((take[r], left, right, place) for r, left, right, place in mine)
                flat.append(got[np.arange(width) < got_sizes[:, None]])
                begin[take], count[take] = at + np.cumsum(got_sizes) - got_sizes, got_sizes
                at += len(flat[-1])
        for k in np.flatnonzero(sizes > WIDTHS[-1]).tolist():
            ids = merge_symbols(symbols[starts[k]: starts[k] + sizes[k]].tolist(), self.vocabulary, 0 if keys is None else int(keys[k]),
                                0 if keys is None else self.threshold)
            flat.append(np.array(ids, np.int32))
            begin[k], count[k] = at, len(ids)
            at += len(ids)
        return np.concatenate(flat) if flat else np.zeros(0, np.int32), begin, count

    def _altered(self, kind: np.ndarray, keys: np.ndarray, seen: list, n_kinds: int) -> np.ndarray:
        """Whether a chunk's key skips a candidate of its dropout-free merges."""
        row, left, right, at = (np.concatenate([s[c] for s in seen]) if seen else np.zeros(0, np.int64) for c in range(4))
        order = np.argsort(row, kind="stable")
        left, right, at = left[order], right[order], at[order]
        count = np.bincount(row, minlength=n_kinds)
        first = np.cumsum(count) - count
        out = np.zeros(len(kind), bool)
        for a in range(0, len(kind), 1 << 14):
            k, key = kind[a: a + (1 << 14)], keys[a: a + (1 << 14)]
            spot = _gather(first[k], count[k])
            whose = np.repeat(np.arange(len(k)), count[k])
            skip = _skipped(key[whose], left[spot], right[spot], at[spot], self.threshold)
            out[a + whose[skip]] = True
        return out

    def encode(self, texts: pa.Array, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, Chunks]:
        """The ids of all texts behind each other, and where each text's begin."""
        chunks = Chunks(texts, self)
        if not len(chunks.starts):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64), chunks
        offsets = np.append(chunks.starts, len(chunks.data)).astype(np.int64)
        column = pa.Array.from_buffers(pa.large_binary(), len(chunks.starts), [None, pa.py_buffer(offsets), pa.py_buffer(chunks.data)])
        kind = column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n_kinds = int(kind.max()) + 1
        first = np.zeros(n_kinds, np.int64)
        first[kind[::-1]] = np.arange(len(kind))[::-1]
        seen: list | None = [] if self.threshold else None
        flat, begin, count = self._merge(chunks.symbols, chunks.sym_starts[first], chunks.sym_sizes[first], seen=seen)
        starts, sizes = begin[kind], count[kind]
        if self.threshold:
            keys = self.keys(np.asarray(docs)[chunks.text], chunks.place)
            change = np.flatnonzero(self._altered(kind, keys, seen, n_kinds) | (chunks.sym_sizes > WIDTHS[-1]))
            more, begin, count = self._merge(chunks.symbols, chunks.sym_starts[change], chunks.sym_sizes[change], keys[change])
            starts[change], sizes[change] = len(flat) + begin, count
            flat = np.concatenate((flat, more))
        ids = flat[_gather(starts, sizes)].astype(np.int32)
        total = np.concatenate(([0], np.cumsum(sizes)))
        return ids, total[chunks.of_text], chunks

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts with their leading spaces, and where each text's begin."""
        sizes = self.surface_sizes[ids]
        total = np.concatenate(([0], np.cumsum(sizes)))
        return self.surface[_gather(self.surface_starts[ids], sizes)], total[offsets]


_tables: dict[str, PairTable] = {}


def _encoder(vocabulary: Vocabulary, path: str, seed: int, dropout: float) -> Encoder:
    """A task's encoder; only the pair table, which the model fixes, stays in the worker process."""
    if path not in _tables:
        _tables[path] = PairTable(vocabulary)
    return Encoder(vocabulary, seed, dropout, _tables[path])


def _lists(ids: np.ndarray, offsets: np.ndarray, gone: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()), mask=gone)


def _same(chunks: Chunks, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each text's bytes are those of ``data`` between ``bounds``."""
    if np.array_equal(bounds, chunks.bounds):
        out = np.ones(len(bounds) - 1, bool)
        out[np.searchsorted(bounds, np.flatnonzero(data != chunks.data), "right") - 1] = False
        return out
    return np.array([np.array_equal(data[a:z], chunks.data[b:y]) for a, z, b, y in zip(bounds[:-1], bounds[1:], chunks.bounds[:-1], chunks.bounds[1:])], bool)


def encode(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL, seed: int = SEED,
           dropout: float = DROPOUT) -> DataFrame:
    """``documents`` as a struct ``row`` and ``ids``, an array of integers."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(load(path))
    df = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col(text_col).alias("text"),
                          F.coalesce(F.col(id_col).cast("long"), F.lit(-1).cast("long")).alias("doc"))
    schema = StructType([df.schema["row"]]).add("ids", ArrayType(IntegerType()))

    @released
    def run(batches):
        encoder = _encoder(shared.value, path, seed, dropout)
        for b in slices(batches, "text", SLICE):
            ids, offsets, _ = encoder.encode(b.column(1), b.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([b.column(0), _lists(ids, offsets, b.column(1).is_null())], ["row", "ids"])

    return df.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(path).surface)
    schema = StructType([*encoded.schema.fields]).add("decoded", StringType())
    at = encoded.columns.index("ids")

    @released
    def run(batches):
        surface = shared.value
        for b in batches:
            texts = [None if ids is None else b"".join([surface[k] for k in ids])[1:].decode() for ids in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], schema=pa.schema(
                [*b.schema, pa.field("decoded", pa.string())]))

    return encoded.mapInArrow(run, schema)


def round_trip(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL, seed: int = SEED,
               dropout: float = DROPOUT) -> DataFrame:
    """Encode and decode in one pass: ``id_col``, n_pieces, ids_sha256, lossless and ids.

    ``ids_sha256`` is the digest of the ids as little-endian 32-bit integers; a
    null text has null ids, no pieces and no digest.
    """
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(load(path))
    df = documents.select(id_col, F.col(text_col).alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(-1).cast("long")).alias("doc"))
    schema = (StructType([df.schema[id_col]]).add("n_pieces", "long").add("ids_sha256", "string").add("lossless", "boolean")
              .add("ids", ArrayType(IntegerType())))

    @released
    def run(batches):
        encoder = _encoder(shared.value, path, seed, dropout)
        for b in slices(batches, "text", SLICE):
            gone = b.column(1).is_null()
            ids, offsets, chunks = encoder.encode(b.column(1), b.column(2).to_numpy())
            same = _same(chunks, *encoder.decode(ids, offsets))
            body = memoryview(ids.astype("<i4")).cast("B")
            digests = [None if null else hashlib.sha256(body[4 * a: 4 * z]).hexdigest()
                       for null, a, z in zip(gone.to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(digests, pa.string()), pa.array(same),
                                              _lists(ids, offsets, gone)], schema.names)

    return df.mapInArrow(run, schema)
