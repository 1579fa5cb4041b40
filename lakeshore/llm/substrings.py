"""Substring dedup by relative Lempel-Ziv parsing (operator 2).

A word is removed if a window of ``k`` consecutive words that covers it also
starts in a document with a smaller id. Documents are parsed into factors, passages
copied from an earlier document, against reference blocks that hold the phrases of
all documents; a symbol of the parse is a window, so a factor of n windows is a
passage of n + k - 1 words, and no factor is shorter than ``k`` words:

1. Each window has an *anchor*, the smallest hash of its 5-word grams; equal
   windows have equal anchors, and runs of neighbouring windows share one. Anchors
   alone, in blocks by hash, show which phrases occur in several documents.
2. Only those phrases (runs of windows with one anchor) go to the block of their
   anchor. Its index has, for every window, the places in earlier documents.
3. Each phrase is parsed greedily against its block (:func:`parse`): the source is
   the earlier place that goes on longest over the next windows (of equals the one
   in the smallest document), and the factor goes on along it until the words differ
   or the source's phrase stops. There the next window is looked up again, also if
   it lies across the joint of two factors.
4. A document's factors from all blocks are joined at their boundaries where they go
   on along one source; together they cover exactly the words to remove.

Before each shuffle a map batch is parsed against itself in the same way, so that
only windows without an earlier document in the batch travel: a passage that a third
of all documents share sends a row per batch, not per document. Windows are told
apart by 96 bits of hashes: for 10^13 distinct windows some 10^-3 pairs are expected to
clash by chance.

A null or empty text has no words. A row with a null id is no source and loses
nothing; rows that repeat an id are no source for each other (only smaller ids
count) and each is reported; an empty table gives an empty table. Extra columns
are carried only if named in ``carry``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from lakeshore.llm import textkit as tk
from lakeshore.llm.store import blocks, written

#: Words of an anchor gram.
GRAM = 5
#: Rows of a map batch: what is met within one needs no shuffle.
BATCH = 2048

ASK, KNOWN, TELL = 0, 1, 2


def _code(anchor: np.ndarray) -> np.ndarray:
    """32 bits of an anchor, apart from those that choose its block. Step 1 may ask
    for a phrase too many, never for one too few."""
    return (tk.mix(anchor) >> np.uint64(32)).astype(np.uint32)


def _bucket(ids: np.ndarray, n_blocks: int) -> np.ndarray:
    return (tk.mix(ids.view(np.uint64)) % np.uint64(n_blocks)).astype(np.int64)


class _Windows:
    """Windows of k words of the documents in one buffer: start (word index in the
    document), document, anchor; ``words`` for the rest."""

    def __init__(self, buf, offsets, k: int):
        self.words = w = tk.Words(buf, offsets, tk.NOT_SPACE)
        self.k = k
        n = max(0, len(w) - k + 1)
        self.at = np.flatnonzero(w.left()[:n] >= k)
        self.doc = w.doc()[self.at]
        self.pos = self.at - w.first[:-1][self.doc] if len(self.at) else self.at
        if not len(self.at):
            self.anchor = np.zeros(0, np.uint64)
            return
        low = tk.rolling(w.hashes(0), min(GRAM, k))
        width, have = k - min(GRAM, k) + 1, 1
        while have < width:  # minimum of `width` neighbours by doubling
            step = min(have, width - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        self.anchor = low[self.at]

    def hashes(self) -> np.ndarray:
        if not len(self.at):
            return np.zeros(0, np.uint64)
        return tk.rolling(self.words.hashes(1), self.k, 1)[self.at]


def _first_of_runs(*keys: np.ndarray) -> np.ndarray:
    """Positions where any of the (sorted or neighbouring) keys changes."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for x in keys:
            new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _least(keys: tuple[np.ndarray, ...], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the smallest and the largest id among rows with equal keys."""
    order = np.lexsort((ids, *keys[::-1]))
    runs = _first_of_runs(*[x[order] for x in keys])
    size = np.diff(np.append(runs, len(order)))
    low, high = np.empty_like(ids), np.empty_like(ids)
    low[order] = np.repeat(ids[order][runs], size)
    high[order] = np.repeat(ids[order][runs + size - 1], size) if len(runs) else ids[:0]
    return low, high


def _rows(block: np.ndarray, kind: int, arrays: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per block: the block's part of each array as bytes."""
    order = np.argsort(block, kind="stable")
    block = block[order]
    runs = _first_of_runs(block)
    ends = np.append(runs, len(block))[1:]
    cols = [pa.array(block[runs].astype(np.int32)), pa.array(np.full(len(runs), kind, np.int32))]
    for a in arrays.values():
        a = a[order]
        cols.append(pa.array([a[s:e].tobytes() for s, e in zip(runs, ends)], pa.binary()))
    return pa.RecordBatch.from_arrays(cols, ["block", "kind", *arrays])


def _column(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), dtype=dtype)


def _symbols(anchor: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Equal numbers for equal windows."""
    order = np.lexsort((hashes, anchor))
    runs = _first_of_runs(anchor[order], hashes[order])
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(order))))
    return out


def _sources(ids: np.ndarray, sym: np.ndarray, left: np.ndarray, horizon: int) -> np.ndarray:
    """For every window the place in an earlier document whose next ``horizon`` windows
    equal its own the longest, the first such place of the smallest id; -1 if none.

    Places with equal next t windows form a class, split by the next symbol for t + 1;
    a class of one document leaves. Places are in order of ids, so a class's first is
    its earliest document."""
    src = np.full(len(sym), -1, dtype=np.int64)
    at, key, base = np.arange(len(sym)), sym, int(sym.max()) + 1 if len(sym) else 1
    for t in range(1, horizon + 1):
        if not len(at):
            break
        order = np.argsort(key, kind="stable")
        runs = _first_of_runs(key[order])
        size = np.diff(np.append(runs, len(order)))
        first = np.empty_like(at)
        first[order] = np.repeat(at[order][runs], size)
        part = np.empty_like(at)
        part[order] = np.repeat(np.arange(len(runs)), size)
        later = ids[first] < ids[at]
        src[at[later]] = first[later]
        shared = np.zeros(len(runs), dtype=bool)
        shared[part[later]] = True
        on = shared[part] & (left[at] > t)
        at, part = at[on], part[on]
        key = part * base + sym[at + t]
    return src


def parse(ids: np.ndarray, sym: np.ndarray, left: np.ndarray,
          horizon: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy relative Lempel-Ziv parse of runs of windows against all of them:
    (place, windows, place of the source) of every factor.

    ``ids`` are in ascending order, ``left`` counts the windows to the end of the run
    (the last has 1). A run of up to ``horizon`` windows gets the longest factors; in
    a longer one the source is chosen by the next ``horizon`` windows and followed as
    far as it goes. All runs are parsed side by side, a stretch along one source at a
    time."""
    src = _sources(ids, sym, left, horizon)
    hits = np.flatnonzero(src >= 0)
    if not len(hits):
        return hits, hits, hits
    # the last place of the stretch in which sources go on one by one
    goes = np.zeros(len(src), dtype=bool)
    goes[:-1] = (src[:-1] >= 0) & (src[1:] == src[:-1] + 1) & (left[:-1] > 1) & (left[src[:-1]] > 1)
    stops = np.flatnonzero(~goes)
    far = np.repeat(stops, np.diff(np.concatenate([[-1], stops])))

    def next_hit(place: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first hit from ``place`` on, or -1 if it is not before ``end``."""
        i = np.searchsorted(hits, place)
        found = hits[np.minimum(i, len(hits) - 1)]
        return np.where((i < len(hits)) & (found < end), found, -1)

    heads = np.flatnonzero(np.concatenate([[True], left[:-1] == 1]))
    begin = next_hit(heads, heads + left[heads])
    begin = begin[begin >= 0]
    place, source = begin, src[begin]
    out = []
    while len(begin):
        jump = np.where(src[place] == source, far[place] - place, 0)
        place, source = place + jump, source + jump
        on = (left[place] > 1) & (left[source] > 1)
        on[on] = sym[place[on] + 1] == sym[source[on] + 1]
        ended = ~on
        b, e = begin[ended], place[ended]
        out.append((b, e - b + 1, source[ended] - (e - b)))
        fresh = next_hit(e + 1, e + left[e])
        fresh = fresh[fresh >= 0]
        begin = np.concatenate([begin[on], fresh])
        place = np.concatenate([place[on] + 1, fresh])
        source = np.concatenate([source[on] + 1, src[fresh]])
    return tuple(np.concatenate(x) for x in zip(*out))


def _left(new: np.ndarray) -> np.ndarray:
    """Windows to the end of the run, from the flags of the runs' first windows."""
    start = np.flatnonzero(new)
    ends = np.append(start, len(new))[1:]
    return np.repeat(ends, ends - start) - np.arange(len(new))


def _horizon(k: int) -> int:
    """Windows that one place of an anchor gram can have; longer phrases repeat themselves."""
    return k - min(GRAM, k) + 1


_ANSWER = pa.schema([("bucket", pa.int32()), ("found", pa.binary())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("found", pa.binary())])


def _answers(rows: np.ndarray, n_blocks: int) -> pa.Table:
    """One row per bucket of documents: a block's answers (a record per answer, with
    ``doc`` and ``th``) go back in as many rows as there are buckets."""
    bucket = _bucket(np.ascontiguousarray(rows["doc"]), n_blocks)
    order = np.argsort(bucket, kind="stable")
    bucket, rows = bucket[order], rows[order]
    runs = _first_of_runs(bucket)
    ends = np.append(runs, len(bucket))[1:]
    return pa.Table.from_arrays(
        [pa.array(bucket[runs].astype(np.int32)),
         pa.array([rows[s:e].tobytes() for s, e in zip(runs, ends)], pa.binary())], schema=_ANSWER)


def _gather(answers: DataFrame, kind: np.dtype) -> DataFrame:
    """(doc_id, th, found) per document: the values of its answers from all blocks."""
    values = np.dtype([(n, kind[n].str) for n in kind.names if n not in ("doc", "th")])

    def run(table: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(table["found"].to_pylist()), dtype=kind)
        ids, th = rows["doc"], rows["th"]
        order = np.lexsort((th, ids))
        ids, th = ids[order], th[order]
        flat = np.empty(len(ids), dtype=values)
        for v in values.names:
            flat[v] = rows[v][order]
        runs = _first_of_runs(ids, th)
        ends = np.append(runs, len(ids))[1:]
        return pa.Table.from_arrays(
            [pa.array(ids[runs]), pa.array(th[runs]),
             pa.array([flat[s:e].tobytes() for s, e in zip(runs, ends)], pa.binary())], schema=_FOUND)

    return answers.groupBy("bucket").applyInArrow(run, "doc_id long, th long, found binary")


def _int64(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.int64()).to_numpy(zero_copy_only=False)


def _anchors(docs: DataFrame, k: int, n_blocks: int) -> DataFrame:
    """(block, kind, doc_ids, ths, anchors): each document's distinct anchors."""
    def run(batch: pa.RecordBatch):
        ids, th = _int64(batch.column(0)), _int64(batch.column(1))
        buf, offsets = tk.texts_of(batch.column(2))
        ds, anchors = [], []
        for i, _, b, o in tk.passes(buf, offsets):
            w = _Windows(b, o, k)
            runs = _first_of_runs(w.doc, w.anchor)
            ds.append(w.doc[runs] + i)
            anchors.append(w.anchor[runs])
        if not ds or not sum(map(len, ds)):
            return
        d, a = np.concatenate(ds), np.concatenate(anchors)
        order = np.lexsort((a, d))
        d, a = d[order], a[order]
        once = _first_of_runs(d, a)
        d, a = d[once], a[once]
        i, t = ids[d], th[d]
        low, high = _least((a,), i)
        block = (a % np.uint64(n_blocks)).astype(np.int64)
        shared = low != high
        # met here already: the answer is known; the smallest id tells the block
        tell = shared & (i == low)
        spread = np.full(len(i), hash((int(i[0]), int(a[0]))) % n_blocks)
        for kind, rows, where in ((ASK, ~shared, block), (KNOWN, shared, spread), (TELL, tell, block)):
            if rows.any():
                yield _rows(where[rows], kind, {"doc_ids": i[rows], "ths": t[rows],
                                                "anchors": _code(a[rows])})

    return tk.map_batches(docs, run, "block int, kind int, doc_ids binary, ths binary, anchors binary",
                          rows=BATCH)


_SHARED = np.dtype([("doc", "<i8"), ("th", "<i8"), ("code", "<u4")])


def _shared_anchors(rows: DataFrame, n_blocks: int) -> DataFrame:
    """(bucket, found): anchors of documents that stand in others as well."""
    def run(table: pa.Table) -> pa.Table:
        kind = table["kind"].to_numpy()
        part = lambda mask: table.filter(pa.array(mask))
        known, rest = part(kind == KNOWN), part(kind != KNOWN)
        i, t, a = (_column(rest, c, d) for c, d in (("doc_ids", "i8"), ("ths", "i8"), ("anchors", "u4")))
        sizes = np.array([len(x) // 8 for x in rest["doc_ids"].to_pylist()], dtype=np.int64)
        ask = np.repeat(kind[kind != KNOWN] == ASK, sizes)
        low, high = _least((a,), i)
        # a teller's batch has the anchor under two ids, one of which is not the asker's
        hit = ask & ((low != high) | np.isin(a, a[~ask]))
        n = int(hit.sum())
        out = np.empty(n + len(_column(known, "anchors", "u4")), dtype=_SHARED)
        for field, name, mine, kind_ in (("doc", "doc_ids", i, "i8"), ("th", "ths", t, "i8"), ("code", "anchors", a, "u4")):
            out[field][:n], out[field][n:] = mine[hit], _column(known, name, kind_)
        return _answers(out, n_blocks)

    return rows.groupBy("block").applyInArrow(run, "bucket int, found binary")


_SOURCE = np.dtype([("source", "<i8"), ("source_pos", "<u4")])
_RUN = np.dtype([("doc", "<u2"), ("pos", "<u4"), ("n", "<u4"), ("anchor", "<u4")])


def _phrases(docs: DataFrame, k: int, n_blocks: int) -> DataFrame:
    """(block, kind, docs, runs, hashes): candidate windows, a run per phrase; with
    kind KNOWN the factors from earlier documents of this batch, with their sources."""
    def run(batch: pa.RecordBatch):
        unpack = zstandard.ZstdDecompressor().decompress
        ids, th = _int64(batch.column(0)), _int64(batch.column(1))
        texts = [unpack(z) for z in batch.column(2).to_pylist()]
        shared = [np.frombuffer(x, dtype="u4").astype(np.uint64) for x in batch.column(3).to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
        parts = []
        for i, j, b, o in tk.passes(buf, offsets):
            w = _Windows(b, o, k)
            salt = np.uint64(0x9E3779B97F4A7C15)
            salts = np.arange(j - i, dtype=np.uint64) * salt
            want = np.concatenate([tk.mix(s + x) for x, s in zip(salts, shared[i:j])])
            # a superset: a clash of hashes only asks for a window too many
            code = _code(w.anchor).astype(np.uint64)
            is_in = np.isin(tk.mix(code + w.doc.astype(np.uint64) * salt), want)
            parts.append((w.doc[is_in] + i, w.pos[is_in], w.anchor[is_in], w.hashes()[is_in]))
        if not parts:
            return
        d, pos, a, h = (np.concatenate(x) for x in zip(*parts))
        if not len(d):
            return
        order = np.argsort(ids[d], kind="stable")
        d, pos, a, h = d[order], pos[order], a[order], h[order]
        new = np.ones(len(d), dtype=bool)
        new[1:] = (d[1:] != d[:-1]) | (pos[1:] != pos[:-1] + 1)
        left = _left(new)
        place, length, source = parse(ids[d], _symbols(a, h), left, _horizon(k))
        known = np.zeros(len(d) + 1, dtype=np.int64)
        known[place] += 1
        np.add.at(known, place + length, -1)
        ask = np.flatnonzero(np.cumsum(known)[:-1] == 0)
        for kind in (ASK, KNOWN):
            if kind == ASK:
                x, p, y, z = d[ask], pos[ask], a[ask], h[ask]
                cut = np.ones(len(x), dtype=bool)
                cut[1:] = (x[1:] != x[:-1]) | (p[1:] != p[:-1] + 1) | (y[1:] != y[:-1])
                start = np.flatnonzero(cut)
                n = np.diff(np.append(start, len(x)))
                block = (y[start] % np.uint64(n_blocks)).astype(np.int64)
            else:
                x, p, y, n, start = d[place], pos[place], a[place], length, np.arange(len(place))
                origin = np.empty(len(place), dtype=_SOURCE)
                origin["source"], origin["source_pos"] = ids[d[source]], pos[source]
                block = _bucket(ids[x], n_blocks)
            if not len(start):
                continue
            order = np.argsort(block, kind="stable")
            block, start, n = block[order], start[order], n[order]
            runs = np.empty(len(start), dtype=_RUN)
            runs["pos"], runs["n"], runs["anchor"] = p[start], n, _code(y[start])
            row = _first_of_runs(block)
            ends = np.append(row, len(block))[1:]
            cols = [[], [], [], []]
            for s, e in zip(row, ends):
                docs_here, at = np.unique(x[start[s:e]], return_inverse=True)
                runs["doc"][s:e] = at
                cols[0].append(int(block[s]))
                cols[1].append(np.stack([ids[docs_here], th[docs_here]], axis=1).tobytes())
                cols[2].append(runs[s:e].tobytes())
                if kind == KNOWN:
                    cols[3].append(origin[start[s:e]].tobytes())
                    continue
                inside = np.arange(n[s:e].sum()) - np.repeat(np.cumsum(n[s:e]) - n[s:e], n[s:e])
                cols[3].append(z[np.repeat(start[s:e], n[s:e]) + inside].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array([kind] * len(cols[0]), pa.int32()),
                 *[pa.array(c, pa.binary()) for c in cols[1:]]],
                ["block", "kind", "docs", "runs", "hashes"])

    return tk.map_batches(docs, run, "block int, kind int, docs binary, runs binary, hashes binary",
                          rows=BATCH)


_FACTOR = np.dtype([("doc", "<i8"), ("th", "<i8"), ("pos", "<u4"), ("n", "<u4"), *_SOURCE.descr])
_COPY = np.dtype(_FACTOR.descr[2:])


def _factors(rows: DataFrame, k: int, n_blocks: int) -> DataFrame:
    """(bucket, found): factors of documents (first window, number of windows, the
    source's document and its first window)."""
    def load(table: pa.Table):
        docs = [np.frombuffer(x, "i8").reshape(-1, 2) for x in table["docs"].to_pylist()]
        runs = [np.frombuffer(x, _RUN) for x in table["runs"].to_pylist()]
        if not docs:
            return np.zeros((0, 2), "i8"), np.zeros(0, _RUN)
        pairs = np.concatenate([d[r["doc"]] for d, r in zip(docs, runs)])
        return pairs, np.concatenate(runs)

    def run(table: pa.Table) -> pa.Table:
        kind = table["kind"].to_numpy()
        asked = table.filter(pa.array(kind == ASK))
        pairs, runs = load(asked)
        n = runs["n"].astype(np.int64)
        first = np.cumsum(n) - n
        order = np.lexsort((runs["pos"], pairs[:, 1], pairs[:, 0]))
        pairs, runs, n, first = pairs[order], runs[order], n[order], first[order]
        of = np.repeat(np.arange(len(runs)), n)
        inside = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        hashes = _column(asked, "hashes", "u8")[first[of] + inside]
        ids, pos = pairs[of, 0], runs["pos"].astype(np.int64)[of] + inside
        place, length, source = parse(ids, _symbols(runs["anchor"][of], hashes), n[of] - inside, _horizon(k))
        known = table.filter(pa.array(kind == KNOWN))
        known_pairs, known_runs = load(known)
        origin = _column(known, "hashes", _SOURCE)
        out = np.empty(len(place) + len(known_runs), dtype=_FACTOR)
        for field, mine, met in (("doc", ids[place], known_pairs[:, 0]), ("th", pairs[of[place], 1], known_pairs[:, 1]),
                                 ("pos", pos[place], known_runs["pos"]), ("n", length, known_runs["n"]),
                                 ("source", ids[source], origin["source"]),
                                 ("source_pos", pos[source], origin["source_pos"])):
            out[field][:len(place)], out[field][len(place):] = mine, met
        return _answers(out, n_blocks)

    return rows.groupBy("block").applyInArrow(run, "bucket int, found binary")


def _joined(found: np.ndarray) -> np.ndarray:
    """Factors by position; those that go on along one source become one."""
    found = found[np.lexsort((found["n"], found["pos"]))]
    pos, n = found["pos"].astype(np.int64), found["n"].astype(np.int64)
    at = found["source_pos"].astype(np.int64)
    new = np.ones(len(found), dtype=bool)
    new[1:] = ((pos[1:] != pos[:-1] + n[:-1]) | (found["source"][1:] != found["source"][:-1])
               | (at[1:] != at[:-1] + n[:-1]))
    start = np.flatnonzero(new)
    out = found[start]
    if len(start):
        out["n"] = np.add.reduceat(n, start)
    return out


def _cut(text: bytes, found: bytes | None, k: int):
    """(kept text, n_words, n_removed, spans [start, end) in words, factors). What is
    cut reaches from its first word to the next kept word; all else stays as it is."""
    raw = np.frombuffer(text, dtype=np.uint8)
    w = tk.Words(raw, np.array([0, len(raw)]), tk.NOT_SPACE)
    edge = np.zeros(len(w) + 1, dtype=np.int64)
    parts = _joined(np.frombuffer(found or b"", _COPY))
    pos, words = parts["pos"].astype(np.int64), parts["n"].astype(np.int64) + k - 1
    np.add.at(edge, pos, 1)
    np.add.at(edge, pos + words, -1)  # n windows cover n + k - 1 words
    copies = np.stack([pos, words, parts["source"], parts["source_pos"].astype(np.int64)], axis=1)
    gone = np.cumsum(edge)[:-1] > 0
    turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    bound = np.append(w.starts, len(text))
    spans = turn.reshape(-1, 2)
    at = np.concatenate([[0], bound[spans].ravel(), [len(text)]]).reshape(-1, 2)
    return (b"".join(text[s:e] for s, e in at.tolist()), len(w), int(gone.sum()), spans.tolist(), copies.tolist())


def dedup_substrings(docs: DataFrame, k: int = 13, id_col: str = "doc_id", text_col: str = "text",
                     carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, kept (its text without the removed words),
    n_words, n_removed, spans (removed words, array of [start, end)), factors (array of
    [first word, words, source's id, first word in the source]; neighbours may overlap
    by k - 1 words), and ``rest``, a struct of the ``carry`` columns."""
    n_blocks = blocks(docs)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.xxhash64(F.col(f"`{text_col}`")).alias("th"),
                      F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                      F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carry or []]).alias("rest"))
    sources = src.where("doc_id is not null").select("doc_id", "th", "text")
    shared = _gather(_shared_anchors(_anchors(sources, k, n_blocks), n_blocks), _SHARED)

    def pack(batch: pa.RecordBatch):
        press = zstandard.ZstdCompressor(level=1).compress
        z = pa.array([press(x) for x in batch.column(2).cast(pa.binary()).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), z, batch.column(3)],
                                         ["doc_id", "th", "z", "rest"])

    rest = src.schema["rest"].dataType
    packed = tk.map_batches(src, pack, tk.schema_with(rest, "doc_id long, th long, z binary", ""))
    held = written(packed.join(shared, ["doc_id", "th"], "left"), "phrases", "uncompressed")
    asking = held.where("found is not null").select("doc_id", "th", "z", "found")
    factors = _gather(_factors(_phrases(asking, k, n_blocks), k, n_blocks), _FACTOR)
    final = (held.where("found is not null").drop("found").join(factors, ["doc_id", "th"], "left")
             .unionByName(held.where("found is null")))

    def cut(batch: pa.RecordBatch):
        unpack = zstandard.ZstdDecompressor().decompress
        got = [_cut(unpack(z), f, k) for z, f in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        kept, n, gone, spans, copies = zip(*got) if got else ((), (), (), (), ())
        lists = pa.list_(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
             pa.array(gone, pa.int64()), pa.array(spans, lists), pa.array(copies, lists), batch.column(3)],
            ["doc_id", "kept", "n_words", "n_removed", "spans", "factors", "rest"])

    return tk.map_batches(final.select("doc_id", "z", "found", "rest"), cut,
                          tk.schema_with(rest, "doc_id long, kept string, n_words long, n_removed long, "
                                               "spans array<array<bigint>>, factors array<array<bigint>>", ""))


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words of every document that stay when repeated 13-word passages go."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_substrings(docs, k=13).select("doc_id", "n_words", "n_removed", words_sha256("kept"))


def words_sha256(column: str):
    """Digest of a text's words joined by one space each."""
    joined = F.trim(F.regexp_replace(column, r"[\x20\x09-\x0D]+", " "))
    return F.sha2(joined, 256).alias("kept_sha256")


#: Every 13-word window with the smallest document that has it.
OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
dup AS (
  SELECT doc_id, i FROM win JOIN (SELECT s, min(doc_id) AS least FROM win GROUP BY s) USING (s)
  WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM dup, (SELECT unnest(generate_series(0, 12)) AS j)),
pos AS (SELECT doc_id, w[p] AS x, p FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM d)),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
  FROM pos ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
