"""Encoding and decoding with merge-type (BPE) SentencePiece vocabularies.

A text becomes symbols, one for each character, after spaces are replaced by the marker U+2581 and
one marker is put in front. An agenda holds the adjacent pairs of symbols whose concatenation is a
piece; the pair of the best score, the leftmost on ties, is merged again and again. Symbols that
are no piece in the end fall back to their UTF-8 bytes.

No piece of the vocabulary has a marker after another character (checked when it is loaded), so no
merge crosses the place before such a marker: a text is encoded as its independent chunks, a run of
markers followed by other characters. The distinct chunks of an Arrow batch are encoded together:
their agendas are rows of one array of pair scores, and each step merges the best pair of every row.
Every distinct chunk is then checked against the sentencepiece library, ids and decoded text; a
difference fails the job.

Defined cases: a null text is the empty text, which has no ids and decodes to the empty text; U+2581
in a text counts as a space, as in the library; very long chunks are encoded alone; an empty table
gives an empty result; extra columns are ignored and ids may be null or repeated.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import bound_batches

MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
#: Distinct chunks remembered by a Python worker.
CACHE_ENTRIES = 300_000
#: Characters of text that a Python worker encodes at once.
BATCH_CHARS = 1 << 20
#: Chunks of more characters get an agenda of their own.
LONG_CHUNK = 200
#: Symbols in the arrays of one joint agenda.
AGENDA_SYMBOLS = 1 << 18


class Codec:
    """A vocabulary with its merge table; ``encode_chunks`` and ``decode`` work without the library."""

    def __init__(self, model: bytes):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        probe = "  a\ufb01 \u2460\tb "
        if sp.decode(sp.encode(probe)) != probe or sp.encode("a", out_type=str)[0][0] != MARK:
            raise ValueError("only vocabularies with byte fallback, a marker in front and no normalisation are supported")
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(size)]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p, s in zip(pieces, special, strict=True) if not s):
            raise ValueError("a piece has a marker after another character; texts can't be cut into chunks")
        self.id_of = {p: i for i, p in enumerate(pieces) if not special[i]}
        self.byte_ids = np.zeros(256, np.int64)
        self.bytes_of: list[bytes] = []
        self.marked = [p.startswith(MARK) for p in pieces]
        for i, piece in enumerate(pieces):
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:-1], 16)]))
            elif sp.is_control(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        if any(c not in self.id_of for p in self.id_of for c in p):
            raise ValueError("a piece has a character that is no piece itself")
        # Symbols of known characters are their ids; those of unknown ones are below -1.
        self.symbol_of = -2 - np.arange(0x110000, dtype=np.int64)
        for piece, i in self.id_of.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        # Ranks order merges: better scores first; equal scores share a rank, so the leftmost wins.
        scores = np.array([sp.get_score(i) for i in range(size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        left, right, merged = [], [], []
        for piece, i in self.id_of.items():
            for cut in range(1, len(piece)):
                a, b = self.id_of.get(piece[:cut]), self.id_of.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(i)
        keys = np.array(left, np.int64) * size + np.array(right, np.int64)
        self.size = size
        self.merge_of = {(a, b): m for a, b, m in zip(left, right, merged, strict=True)}
        slots = 1 << (max(16, len(keys).bit_length() + 2))
        self.slots = slots
        self.pair_key, self.pair_id = np.full(slots, -1, np.int64), np.zeros(slots, np.int64)
        todo, step = np.arange(len(keys)), 0
        while len(todo):  # open addressing, all keys that are left at once
            at = (self._slot(keys[todo]) + step) & (slots - 1)
            free = self.pair_key[at] < 0
            first = np.zeros(len(todo), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.pair_key[at[put]], self.pair_id[at[put]] = keys[todo[put]], np.array(merged)[todo[put]]
            todo, step = todo[~put], step + 1
        self.probes = step

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) & (self.slots - 1)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two adjacent symbols merge into; -1 if there is none."""
        keys = np.where((left >= 0) & (right >= 0), left * self.size + right, -2)
        out = np.full(len(keys), -1, np.int64)
        slot, open_ = self._slot(keys), np.arange(len(keys))
        for step in range(self.probes):
            at = (slot[open_] + step) & (self.slots - 1)
            held = self.pair_key[at]
            hit = held == keys[open_]
            out[open_[hit]] = self.pair_id[at[hit]]
            open_ = open_[~hit & (held >= 0)]
            if not len(open_):
                break
        return out

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after another, number of ids of each chunk)."""
        parts, counts, first = [], [], 0
        while first < len(chunks):
            last, held = first, 0
            while last < len(chunks) and (last == first or held + len(chunks[last]) <= AGENDA_SYMBOLS):
                held += len(chunks[last])
                last += 1
                if held > LONG_CHUNK * 64 and len(chunks[last - 1]) > LONG_CHUNK:
                    break
            group = chunks[first:last]
            long = [len(c) > LONG_CHUNK for c in group]
            row, symbols = self._agenda([c if not x else "" for c, x in zip(group, long, strict=True)])
            if any(long):
                alone = [(k, self._agenda_of_one(c)) for k, (c, x) in enumerate(zip(group, long, strict=True)) if x]
                row = np.concatenate([row, *[np.full(len(a), k) for k, a in alone]])
                symbols = np.concatenate([symbols, *[a for _, a in alone]])
            order = np.argsort(row, kind="stable")
            row, symbols = self._with_bytes(row[order], symbols[order])
            parts.append(symbols)
            counts.append(np.bincount(row, minlength=len(group)))
            first = last
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(parts), np.concatenate(counts)

    def _agenda(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows and symbols after all merges; each step merges the best pair of every row that has one."""
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
        symbols = self.symbol_of[codes]
        row = np.repeat(np.arange(len(chunks)), [len(c) for c in chunks])
        n = len(row)
        if n == 0:
            return row, symbols
        never = len(self.rank) + 1
        merged = np.full(n, -1, np.int64)
        inside = np.flatnonzero(row[1:] == row[:-1])
        merged[inside] = self.pair(symbols[inside], symbols[inside + 1])
        score = np.where(merged >= 0, self.rank[merged], never)
        done_rows, done_symbols = [], []
        while len(row):
            starts = np.concatenate([[0], np.flatnonzero(row[1:] != row[:-1]) + 1])
            best = np.minimum.reduceat(score * n + np.arange(len(row)), starts)
            live = best < never * n
            lengths = np.diff(np.append(starts, len(row)))
            keep = np.repeat(live, lengths)
            done_rows.append(row[~keep])
            done_symbols.append(symbols[~keep])
            at = best[live] % n
            symbols[at] = merged[at]
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            row, symbols, merged, score = row[keep], symbols[keep], merged[keep], score[keep]
            at = moved[at]
            touched = np.concatenate([at, at[at > 0] - 1])
            right = np.minimum(touched + 1, len(row) - 1)
            same = (right > touched) & (row[touched] == row[right]) if len(row) else np.zeros(0, bool)
            found = np.full(len(touched), -1, np.int64)
            found[same] = self.pair(symbols[touched[same]], symbols[right[same]])
            merged[touched] = found
            score[touched] = np.where(found >= 0, self.rank[found], never)
        return np.concatenate(done_rows), np.concatenate(done_symbols)

    def _agenda_of_one(self, chunk: str) -> np.ndarray:
        """Symbols of one long chunk after all merges, from a heap of pairs over a linked list."""
        symbols = self.symbol_of[np.frombuffer(chunk.encode("utf-32-le"), np.uint32)]
        pairs = self.pair(symbols[:-1], symbols[1:])
        symbols = symbols.tolist()
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(int(self.rank[p]), i, symbols[i], symbols[i + 1], int(p)) for i, p in enumerate(pairs.tolist()) if p >= 0]
        heapq.heapify(agenda)
        while agenda:
            _, i, left, right, piece = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # a part of this pair has been merged since
            symbols[i], symbols[j] = piece, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and symbols[a] >= 0 and symbols[b] >= 0:
                    p = self.merge_of.get((symbols[a], symbols[b]))
                    if p is not None:
                        heapq.heappush(agenda, (int(self.rank[p]), a, symbols[a], symbols[b], p))
        return np.array([s for s in symbols if s != -1], np.int64)

    def _with_bytes(self, row: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters replaced by the ids of their UTF-8 bytes."""
        unknown = np.flatnonzero(symbols < 0)
        if not len(unknown):
            return row, symbols
        encoded = [chr(-2 - s).encode() for s in symbols[unknown].tolist()]
        times = np.ones(len(symbols), np.int64)
        times[unknown] = [len(e) for e in encoded]
        out = np.repeat(symbols, times)
        out[out < 0] = self.byte_ids[np.frombuffer(b"".join(encoded), np.uint8)]
        return np.repeat(row, times), out

    def decode_bytes(self, ids) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def decode(self, ids) -> str:
        """The text of some ids, without the space that the marker in front stands for."""
        text = self.decode_bytes(ids).decode(errors="sentencepiece_bytes")
        first = next((i for i in ids if self.bytes_of[i]), None)
        return text[1:] if first is not None and self.marked[first] else text


#: A byte that is not part of valid UTF-8 decodes to one replacement character.
codecs.register_error("sentencepiece_bytes", lambda e: ("\ufffd" * (e.end - e.start), e.end))


class Cache:
    """Encoded distinct chunks of one Python worker: their ids in one array, decoded bytes."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.decoded: list[bytes] = []

    def add(self, chunks: list[str]) -> None:
        """Encode chunks that are new, and check each against the library; a difference is an error."""
        codec, first = self.codec, len(self.index)
        ids, counts = codec.encode_chunks(chunks)
        ends = np.cumsum(counts)
        flat = ids.tolist()
        decoded = [codec.decode_bytes(flat[e - c : e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
        check = [k for k, c in enumerate(chunks) if len(c) > 1]  # a marker alone is not a text of its own
        texts = [chunks[k][1:].replace(MARK, " ") for k in check]
        expected = codec.library.encode(texts, num_threads=1)
        back = codec.library.decode(expected)
        for k, text, want, said in zip(check, texts, expected, back, strict=True):
            if flat[ends[k] - counts[k] : ends[k]] != want or decoded[k] != b" " + said.encode() or said != text:
                raise ValueError(f"the agenda and the library differ on {text[:80]!r}")
        self.index.update((c, first + k) for k, c in enumerate(chunks))
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.counts = np.concatenate([self.counts, counts])
        self.starts = np.cumsum(self.counts) - self.counts
        self.decoded += decoded

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(ids of all texts, number of ids of each, decoded texts in UTF-8)."""
        if len(self.index) > CACHE_ENTRIES:
            self.clear()
        cut = [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = {c for chunks in cut for c in chunks if c not in self.index}
        if new:
            self.add(sorted(new))
        index, decoded = self.index, self.decoded
        places = [[index[c] for c in chunks] for chunks in cut]
        flat = np.array([k for p in places for k in p], np.int64)
        sizes = self.counts[flat]
        where = np.repeat(self.starts[flat] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int64)]
        back = [b"".join([decoded[k] for k in p])[1:] for p in places]
        return self.ids[where], np.diff(ends), back


_WORKER: dict[str, Cache] = {}


def _cache(model: bytes) -> Cache:
    key = hashlib.sha256(model).hexdigest()
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Cache(Codec(model))
    return _WORKER[key]


def _run(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(model)
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            first = 0
            while first < len(texts):
                last, held, part = first, 0, []
                while last < len(texts) and held < BATCH_CHARS:
                    part.append(texts[last].as_py() or "")
                    held += len(part[-1])
                    last += 1
                ids, counts, decoded = cache.encode(part)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), lists, pa.array(decoded, pa.binary()).cast(pa.string())], names=["id", "ids", "decoded"])
                first = last

    return run


def encode(df: DataFrame, model_path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, ``ids`` and ``decoded`` (the text that the ids decode to).

    The model file is read on the driver and sent to the executors, which need not have it.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    bound_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_run(model), f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)


def _run_decode(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _cache(model).codec
        for batch in batches:
            texts = [codec.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "decoded"])

    return run


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id and ``decoded``, the text of the ids; null ids give the empty text."""
    with open(model_path, "rb") as file:
        model = file.read()
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(_run_decode(model), f"id {kind}, decoded string").withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of encoded rows."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
