"""BPE encoding and decoding with content-defined chunk reuse (operator 5).

Texts are cut into *chunks* where a rolling hash of the last bytes has a fixed
pattern, so the same passage is cut alike in every document. A chunk is encoded
once per worker and its ids are reused wherever it comes again (a bounded cache:
what falls out is encoded again, with the same ids). A cut may fall inside a word,
so each join is *repaired*: the words around it are encoded again as they stand in
the document, and so is a wider window; if the wider one does not agree exactly
with what stands left and right, the repaired part grows until it does.

Ids are those of the tokenizers library with the given vocabulary file, without
special tokens added; decoding is the byte strings of the ids, in order.

A null text is empty and has no ids; every row is encoded by itself, repeated or
null ids included; an empty table gives an empty table. Extra columns are carried
as they are.
"""

from __future__ import annotations

import itertools
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeshore.llm import textkit as tk

VOCABULARY = "byte_bpe_50k.json"
#: A cut every so many bytes, on average; the hash sees the last 8 bytes.
CHUNK_BYTES = 1024
#: Bounds of the worker's caches: pieces, and bytes of chunks (the chunks used least
#: recently go first; each byte takes some four more for its ids).
CACHE_PIECES, CACHE_BYTES = 400_000, 12 << 20
LONG_PIECE = 128
#: Bytes of new pieces that go to the library as one text.
RUN_BYTES = 4096

_SPACES = ~tk.NOT_SPACE
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[0x21:0x7F] = True
_TAIL = np.zeros(256, dtype=bool)
_TAIL[0x80:0xC0] = True
_LEAD2 = np.zeros(256, dtype=bool)
_LEAD2[0xC3:0xE0] = True
_LEAD3 = np.zeros(256, dtype=bool)
_LEAD3[0xE4:0xF0] = True
#: A random number per byte, for the rolling hash.
_GEAR = tk.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def vocabulary_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def safe_cuts(buf: np.ndarray) -> np.ndarray:
    """True where a text may be cut without changing its ids: before white space
    that follows a character which is none. (No token of a byte-level vocabulary
    goes on from the one into the other, and none looks back.) Characters whose
    class is not plain from their bytes allow no cut."""
    n = len(buf)
    ok = np.zeros(n, dtype=bool)
    if n < 2:
        return ok
    before = _PLAIN[buf[:-1]].copy()
    tail = _TAIL[buf]
    before[1:] |= tail[1:-1] & _LEAD2[buf[:-2]]
    before[2:] |= tail[2:-1] & tail[1:-2] & _LEAD3[buf[:-3]]
    ok[1:] = before & _SPACES[buf[1:]]
    return ok


def chunk_cuts(buf: np.ndarray, every: int = CHUNK_BYTES) -> np.ndarray:
    """True where a chunk starts by the hash of the 8 bytes before; never inside a
    character."""
    out = np.zeros(len(buf), dtype=bool)
    if len(buf) < 9:
        return out
    h = _GEAR[buf]
    for step, factor in ((1, 3), (2, 9), (4, 81)):
        h = h[:-step] * np.uint64(factor) + h[step:]
    hit = (tk.mix(h) % np.uint64(every)) == 0
    out[8:] = hit[:-1]
    return out & ~_TAIL[buf]


class Pieces:
    """Encodes runs of text piece by piece; a piece is the text between two safe
    cuts. Pieces repeat a lot (they are mostly words), so each is looked up first."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.id_bytes = np.array([len(b) for b in token_bytes(path)], dtype=np.int64)
        self._clear()

    def _clear(self):
        self.known: dict[bytes, int] = {}
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.at = np.zeros(1 << 16, dtype=np.int64)
        self.size = np.zeros(1 << 16, dtype=np.int64)
        self.count = 0

    def library(self, texts: list[bytes]) -> list[list[int]]:
        """Ids of whole texts straight from the library."""
        texts = [t.decode("utf-8", "replace") for t in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def each(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all pieces, one after the other, and the number of each. Pieces
        that may stand side by side (cuts between them are safe) go to the library
        as one text; the bytes of the ids say where each ends."""
        length = np.array([len(p) for p in pieces], dtype=np.int64)
        ends = np.cumsum(length)
        buf = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        # runs of pieces with safe cuts between them, of bounded length
        cut = ~safe_cuts(buf)[ends[:-1]] if len(pieces) > 1 else np.zeros(0, bool)
        cut |= ends[:-1] // RUN_BYTES != ends[1:] // RUN_BYTES
        last = np.append(np.flatnonzero(cut), len(pieces) - 1)
        first = np.append(0, last[:-1] + 1)
        begin = ends - length
        data = buf.tobytes()
        coded = self.library([data[s:e] for s, e in zip(begin[first].tolist(), ends[last].tolist())])
        ids = np.fromiter(itertools.chain.from_iterable(coded), dtype=np.uint32, count=sum(map(len, coded)))
        reach = np.concatenate([[0], np.cumsum(self.id_bytes[ids])])
        stop = np.searchsorted(reach, ends)
        if len(reach) and (reach[np.minimum(stop, len(reach) - 1)] != ends).any():
            coded = self.library(pieces)  # bytes that are no text: one by one
            return (np.fromiter(itertools.chain.from_iterable(coded), dtype=np.uint32),
                    np.array([len(c) for c in coded], dtype=np.int64))
        return ids, np.diff(np.concatenate([[0], stop]))

    def _add(self, pieces: list[bytes]) -> range:
        if not pieces:
            return range(0)
        ids, size = self.each(pieces)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.count + len(size) > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        places = range(self.count, self.count + len(size))
        self.pool[self.used:self.used + len(ids)] = ids
        self.at[places.start:places.stop] = self.used + np.cumsum(size) - size
        self.size[places.start:places.stop] = size
        self.used += len(ids)
        self.count += len(size)
        return places

    def encode(self, buf: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the pieces that start at ``begins`` (sorted; the first is 0) and
        the number of ids of each."""
        if self.count > CACHE_PIECES or self.used > 8 * CACHE_PIECES:
            self._clear()
            tk.give_back_memory()
        offsets = np.append(begins, len(buf)).astype(np.int64)
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buf))])
        coded = column.dictionary_encode()
        _, ends, data = coded.dictionary.buffers()  # much faster than to_pylist
        ends, data = np.frombuffer(ends, dtype=np.int64).tolist(), data.to_pybytes()
        pieces = [data[s:e] for s, e in zip(ends[:len(coded.dictionary)], ends[1:])]
        place = [self.known.get(p, -1) for p in pieces]
        missing = [k for k, x in enumerate(place) if x < 0]
        for k, x in zip(missing, self._add([pieces[k] for k in missing])):
            place[k] = x
            if len(pieces[k]) <= LONG_PIECE:
                self.known[pieces[k]] = x
        where = np.array(place, dtype=np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        size = self.size[where]
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return self.pool[np.repeat(self.at[where], size) + inside], size

    def documents(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of all documents of a buffer and the number of ids of each."""
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        edge = safe_cuts(buf)
        edge[offsets[:-1][offsets[:-1] < len(buf)]] = True
        begins = np.flatnonzero(edge)
        ids, size = self.encode(buf, begins)
        total = np.concatenate([[0], np.cumsum(size)])
        return ids, np.diff(total[np.searchsorted(begins, offsets)])


_WORKER: dict = {}


def pieces_of(path: str) -> Pieces:
    """The worker's encoder for a vocabulary file: loaded once, caches kept."""
    if path not in _WORKER:
        _WORKER[path] = Pieces(path)
    return _WORKER[path]


class _Chunk:
    """An encoded chunk: ids, and bytes and ids of each of its pieces."""

    __slots__ = ("ids", "bytes", "sizes")

    def __init__(self, ids, lengths, sizes):
        self.ids, self.bytes, self.sizes = ids, lengths, sizes


class Chunks:
    """Encodes documents by chunks (see the module)."""

    def __init__(self, path: str, every: int = CHUNK_BYTES):
        self.pieces = pieces_of(path)
        self.every = every
        self.known: dict[bytes, _Chunk] = {}
        self.held = 0
        self.reused = self.encoded = self.widened = 0

    def _chunks(self, buf: np.ndarray, begins: np.ndarray) -> list[_Chunk]:
        ends = np.append(begins[1:], len(buf))
        data = buf.tobytes()
        texts = [data[s:e] for s, e in zip(begins.tolist(), ends.tolist())]
        new = []
        for t in dict.fromkeys(texts):
            chunk = self.known.pop(t, None)
            if chunk is None:
                new.append(t)
            else:
                self.known[t] = chunk  # the last to go
        self.encoded += len(new)
        self.reused += len(texts) - len(new)
        if self.held > CACHE_BYTES:  # those that were not used for longest go
            use = set(texts)
            for t in list(itertools.takewhile(lambda t: t not in use, self.known)):
                if self.held <= CACHE_BYTES // 2:
                    break
                del self.known[t]
                self.held -= len(t)
            tk.give_back_memory()
        if new:
            flat = np.frombuffer(b"".join(new), dtype=np.uint8)
            size = np.array([len(t) for t in new])
            first = np.cumsum(size) - size
            edge = safe_cuts(flat)
            edge[first] = True
            starts = np.flatnonzero(edge)
            ids, count = self.pieces.encode(flat, starts)
            length = np.diff(np.append(starts, len(flat)))
            p = np.append(np.searchsorted(starts, first), len(starts))
            t = np.concatenate([[0], np.cumsum(count)])[p]
            for k, text in enumerate(new):
                self.known[text] = _Chunk(*(x.astype(np.uint32) for x in (  # copies: no big array stays for a slice
                    ids[t[k]:t[k + 1]], length[p[k]:p[k + 1]], count[p[k]:p[k + 1]])))
            self.held += len(flat)
        return [self.known[t] for t in texts]

    def documents(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of all documents of a buffer and the number of ids of each."""
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        edge = chunk_cuts(buf, self.every)
        starts = offsets[:-1][offsets[:-1] < len(buf)]
        edge[starts] = True
        begins = np.flatnonzero(edge)
        chunks = self._chunks(buf, begins)
        # all pieces of the buffer as the chunks have them
        ids = np.concatenate([c.ids for c in chunks])
        length = np.concatenate([c.bytes for c in chunks]).astype(np.int64)
        size = np.concatenate([c.sizes for c in chunks]).astype(np.int64)
        first_byte = np.concatenate([[0], np.cumsum(length)])
        first_id = np.concatenate([[0], np.cumsum(size)])
        doc_piece = np.searchsorted(first_byte, offsets)  # the first piece of each document
        n_pieces = np.array([len(c.bytes) for c in chunks])
        chunk_piece = np.cumsum(n_pieces) - n_pieces
        inner = np.ones(len(begins), dtype=bool)
        inner[np.searchsorted(begins, starts)] = False
        joins = chunk_piece[inner]  # piece j - 1 and piece j meet at a cut
        regions = self._repair(buf, ids, first_byte, first_id, doc_piece, joins)
        # new ids for the repaired pieces, the chunks' ids elsewhere
        out, at = [], 0
        n_ids = np.diff(first_id).copy()
        for s, e, found in regions:
            out.append(ids[first_id[at]:first_id[s]])
            out.append(np.array(found, dtype=np.uint32))
            n_ids[s:e] = 0
            n_ids[s] = len(found)
            at = e
        out.append(ids[first_id[at]:])
        total = np.concatenate([[0], np.cumsum(n_ids)])
        return np.concatenate(out), np.diff(total[doc_piece])

    def _repair(self, buf, ids, first_byte, first_id, doc_piece, joins):
        """[(first piece, end, ids)] in order, for all joins."""
        data = memoryview(np.ascontiguousarray(buf))
        todo = [(int(j) - 1, int(j) + 1) for j in joins]
        low = doc_piece[np.searchsorted(doc_piece, joins, side="right") - 1] if len(joins) else joins
        high = doc_piece[np.searchsorted(doc_piece, joins, side="right")] if len(joins) else joins
        todo = [(s, e, int(a), int(b)) for (s, e), a, b in zip(todo, low, high)]
        done = []
        while todo:
            merged = []
            for r in sorted(todo + [d[0] for d in done]):
                if merged and r[0] < merged[-1][1]:  # windows that overlap are one
                    merged[-1] = (merged[-1][0], max(merged[-1][1], r[1]), *r[2:])
                else:
                    merged.append(r)
            kept = {d[0]: d for d in done}
            done = [kept[r] for r in merged if r in kept]
            open_ = [r for r in merged if r not in kept]
            text = lambda s, e: bytes(data[first_byte[s]:first_byte[e]])
            inner = self.pieces_flat([text(s, e) for s, e, _, _ in open_])
            wide = [(max(s - 1, a), min(e + 1, b)) for s, e, a, b in open_]
            outer = self.pieces.library([text(s, e) for s, e in wide])
            todo = []
            for r, w, (ws, we), o in zip(open_, inner, wide, outer):
                left = ids[first_id[ws]:first_id[r[0]]].tolist()
                right = ids[first_id[r[1]]:first_id[we]].tolist()
                if left + w + right == o:
                    done.append((r, w))
                else:
                    self.widened += 1
                    todo.append((max(r[0] - 1, r[2]), min(r[1] + 1, r[3]), r[2], r[3]))
                    if (r[0], r[1]) == (r[2], r[3]):  # the whole document: the library's own ids
                        todo.pop()
                        done.append((r, o))
        return [(r[0], r[1], w) for r, w in sorted(done)]

    def pieces_flat(self, texts: list[bytes]) -> list[list[int]]:
        """ids of each text, word by word (each starts and ends at a safe cut)."""
        if not texts:
            return []
        size = np.array([len(t) for t in texts])
        offsets = np.concatenate([[0], np.cumsum(size)])
        ids, count = self.pieces.documents(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets)
        ends = np.cumsum(count).tolist()
        ids = ids.tolist()
        return [ids[e - c:e] for e, c in zip(ends, count.tolist())]


def _chunker(path: str, every: int) -> Chunks:
    key = (path, every)
    if key not in _WORKER:
        _WORKER[key] = Chunks(path, every)
    return _WORKER[key]


def encode_documents(docs: DataFrame, vocabulary: str | None = None, text_col: str = "text",
                     ids_col: str = "ids", every: int = CHUNK_BYTES, keep: list[str] | None = None,
                     decoded_col: str | None = None) -> DataFrame:
    """The ``keep`` columns (all by default) and the array of ids of the text, with
    ``decoded_col`` also the text that the ids decode to. One narrow pass, no
    shuffle."""
    path = vocabulary_path(vocabulary)

    def run(batch: pa.RecordBatch):
        coder = _chunker(path, every)
        buf, offsets = tk.texts_of(batch.column(0))
        flat, counts = [], [np.zeros(0, np.int64)]
        for _, _, b, o in tk.passes(buf, offsets, 1 << 20):
            ids, n = coder.documents(b, o)
            flat.append(ids)
            counts.append(n)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        ids = pa.array(np.concatenate(flat).astype(np.int32) if flat else np.zeros(0, np.int32))
        out = [batch.column(1), pa.ListArray.from_arrays(pa.array(ends), ids)]
        if decoded_col:
            out.append(decode(out[1], path))
        yield pa.RecordBatch.from_arrays(out, ["rest", "ids", "text"][:len(out)])

    names = keep if keep is not None else docs.columns
    src = docs.select(F.col(f"`{text_col}`").alias("text"),
                      F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("rest"))
    more = "ids array<int>" + (", text string" if decoded_col else "")
    out = tk.map_batches(src, run, tk.schema_with(src.schema["rest"].dataType, "", more))
    return out.select(*[F.col(f"rest.`{c}`") for c in names], F.col("ids").alias(ids_col),
                      *([F.col("text").alias(decoded_col)] if decoded_col else []))


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary file."""
    model = json.load(open(path, encoding="utf-8"))
    # the usual printable stand-ins: visible bytes are themselves, the others follow from 256
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    vocab = dict(model["model"]["vocab"])
    out = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in model["added_tokens"])]))
    for token, i in vocab.items():
        out[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    for t in model["added_tokens"]:
        out[t["id"]] = t["content"].encode()
    return out


def decode(ids: pa.ListArray, path: str) -> pa.Array:
    """Texts of lists of ids."""
    if ("bytes", path) not in _WORKER:
        _WORKER["bytes", path] = token_bytes(path)
    table = _WORKER["bytes", path]
    ends = ids.offsets.to_pylist()
    flat = ids.values.to_numpy(zero_copy_only=False)
    return pa.array([b"".join(map(table.__getitem__, flat[s:e].tolist())).decode("utf-8", "replace")
                     for s, e in zip(ends[:-1], ends[1:])], pa.string())


def decode_documents(rows: DataFrame, vocabulary: str | None = None, ids_col: str = "ids",
                     text_col: str = "decoded") -> DataFrame:
    """All columns and the text of the ids (null ids give an empty text)."""
    path = vocabulary_path(vocabulary)

    def run(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([batch.column(1), decode(batch.column(0), path)], ["rest", "text"])

    names = rows.columns
    src = rows.select(F.coalesce(F.col(f"`{ids_col}`"), F.array().cast("array<int>")).alias("ids"),
                      F.struct(*[F.col(f"`{c}`") for c in names]).alias("rest"))
    out = tk.map_batches(src, run, tk.schema_with(src.schema["rest"].dataType, "", "text string"))
    return out.select(*[F.col(f"rest.`{c}`") for c in names], F.col("text").alias(text_col))


def digest_columns() -> list[Column]:
    """n_tokens, ids_sha256 and decoded_sha256 of the columns ids and decoded."""
    listed = F.regexp_replace(F.to_json("ids"), r"[\[\]]", "")
    return [F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
            F.sha2("decoded", 256).alias("decoded_sha256")]


def op5_bpe_roundtrip(spark, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_documents(docs, keep=["doc_id"], decoded_col="decoded").select("doc_id", *digest_columns())
