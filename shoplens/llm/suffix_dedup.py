"""Removal of repeated byte strings with a logarithmic family of suffix arrays.

A byte is removed if a string of ``width`` bytes that covers it also starts in a document with a
smaller id. Each such string (window) is assigned to the least hashed gram inside it, its anchor, so
equal windows have equal anchors wherever they stand. Anchors that only one document has can be
passed over; the windows of the others meet in the shard of their anchor. There they come in batches
of ascending ids. Each batch gets a suffix array of its windows, which is merge-scanned against the
levels that hold the windows of smaller ids; it then becomes a level itself, and levels of equal
size are merged.

Documents travel as compressed segments of consecutive rows. A segment reports an anchor and an
equal context once, however many of its documents have it, so that texts with very many copies cost
a shard no more than one record for each segment.

An anchor with very many contexts, such as that at the end of a header that all documents share, is
hot. Its windows do not meet in the shard of the anchor but each in that of a hash of its own bytes.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, LongType, StringType, StructField, StructType,
)
from xxhash import xxh3_64_intdigest

from shoplens.llm.elias_fano import pack, unpack
from shoplens.llm.memory import release, released
from shoplens.llm.words import mixed

WIDTH = 50
SEGMENT_BYTES = 4 << 20
# text whose anchors and windows meet in one shard
SHARD_BYTES = 8 << 20
PIECE = 1 << 15
POSITION_BITS = 24
BATCH_WINDOWS = 1 << 14
# contexts of a key that are counted as they are, and those that make it hot
FEW_CONTEXTS = 8
HOT_CONTEXTS = 4096
SPAN = StructType([StructField("start", LongType()), StructField("length", LongType())])
FOUND = StructType(
    [
        StructField("n_bytes", LongType()),
        StructField("removed", ArrayType(SPAN)),
        StructField("kept", BinaryType()),
    ]
)
TEXT = StructField("kept_text", StringType())
LAST = np.iinfo(np.int64).max
BASE = 0x9E3779B97F4A7C15
BYTE_HASHES = np.random.default_rng(50).integers(0, 1 << 64, 256, np.uint64)
POSITION = np.uint64((1 << POSITION_BITS) - 1)


def gram_length(width: int) -> int:
    """Long grams repeat rarely, short ones give fewer anchors; at most 19 grams fit a window."""
    return max(width - 18, (width + 1) // 2)


def rolling(raw: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """For each length the hash of so many bytes from each position on.

    The hash is a polynomial over random numbers for the bytes; that of twice as many bytes comes
    from two of the shorter ones.
    """
    h = BYTE_HASHES[raw]
    done: list[np.ndarray | None] = [None] * len(lengths)
    sizes, width = [0] * len(lengths), 1
    while True:
        for k, n in enumerate(lengths):
            if n & width:
                done[k] = h if done[k] is None else _joined(done[k], sizes[k], h, width)
                sizes[k] += width
        if width * 2 > max(lengths):
            return done
        h = _joined(h, width, h, width)
        width *= 2


def _joined(first: np.ndarray, size: int, second: np.ndarray, width: int) -> np.ndarray:
    room = max(min(len(first), len(second) - size), 0)
    out = first[:room] * np.uint64(pow(BASE, width, 1 << 64))
    out += second[size : size + room]
    return out


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    done, size, width = None, 0, 1
    while True:
        if n & width:
            if done is None:
                done, size = x, width
            else:
                room = max(len(x) - size, 0)
                done = np.minimum(done[:room], x[size : size + room])
                size += width
        if width * 2 > n:
            return done
        room = max(len(x) - width, 0)
        x = np.minimum(x[:room], x[width:])
        width *= 2


@dataclass
class Anchors:
    """The windows of a segment as runs that share an anchor: from ``first`` on, ``more`` others.

    ``ahead`` is how far the anchor stands behind the first window, ``context`` a hash of all
    bytes of the run.
    """

    doc: np.ndarray
    first: np.ndarray
    more: np.ndarray
    ahead: np.ndarray
    key: np.ndarray
    context: np.ndarray


def find_anchors(raw: np.ndarray, ends: np.ndarray, width: int) -> Anchors:
    """``raw`` holds the documents of a segment one after the other, which end at ``ends``."""
    gram = gram_length(width)
    crossing = np.zeros(len(raw) + 1, np.int32)
    np.add.at(crossing, np.maximum(ends - width + 1, 0), 1)
    np.add.at(crossing, ends, -1)
    inside = np.cumsum(crossing[:-1], out=crossing[:-1]) == 0
    del crossing
    place = np.arange(PIECE + width, dtype=np.uint64)
    parts = []
    for at in range(0, len(raw), PIECE):
        piece = raw[at : at + PIECE + width - 1]
        if len(piece) < width:
            break
        hashed, full = rolling(piece, gram, width)
        hashed &= ~POSITION
        hashed |= place[: len(hashed)]
        least = sliding_min(hashed, width - gram + 1)
        window = np.flatnonzero(inside[at : at + len(least)])
        if not len(window):
            continue
        least = least[window]
        edge = np.flatnonzero(least[1:] != least[:-1]) + 1
        begin = np.concatenate(([0], edge))
        first, last = window[begin], window[np.append(edge, len(window)) - 1]
        more, least = last - first, least[begin]
        ahead = (least & POSITION).astype(np.int64) - first
        context = mixed(full[first] + mixed(full[last])) + (more * 64 + ahead).astype(np.uint64)
        parts.append((
            (first + at).astype(np.int32), more.astype(np.uint8), ahead.astype(np.uint8),
            least >> np.uint64(POSITION_BITS), mixed(context),
        ))
    if not parts:
        parts = [tuple(np.zeros(0, t) for t in (np.int32, np.uint8, np.uint8, "u8", "u8"))]
    first, more, ahead, key, context = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    doc = np.searchsorted(ends, first, side="right").astype(np.int32)
    return Anchors(doc, first, more, ahead, key, context)


def _shards_of(key: np.ndarray, shards: int) -> np.ndarray:
    return ((mixed(key) >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _compress(arrays: list[np.ndarray]) -> bytes:
    return zstandard.compress(pack(arrays), 1)


def _expand(blob: bytes) -> list[np.ndarray]:
    return unpack(zstandard.decompress(blob))


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, int, int]]:
    edges = np.flatnonzero(np.diff(shard.astype(np.int64), prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(shard[a]), int(a), int(b)


class Segment:
    """Consecutive documents: their bytes, their ids and the columns that travel with them."""

    def __init__(self, texts: list[bytes], rest: pa.Table) -> None:
        self.texts, self.rest = texts, rest
        self.ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        ids = rest["doc_id"].to_pandas()
        self.ids = np.array([LAST if pd.isna(x) else x for x in ids], np.int64)

    @property
    def name(self) -> int:
        """From the content, so that a segment that is built again has the same name."""
        rows = xxh3_64_intdigest(self.ids.tobytes() + self.ends.tobytes())
        return xxh3_64_intdigest(self.raw.tobytes(), seed=rows) - (1 << 63)

    def to_row(self) -> dict:
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, self.rest.schema) as out:
            out.write_table(self.rest)
        lengths = np.array([len(t) for t in self.texts])
        blob = zstandard.compress(pack([lengths, self.raw]), 3)
        return {"name": self.name, "texts": blob, "rest": zstandard.compress(sink.getvalue(), 3)}

    @classmethod
    def from_row(cls, row) -> Segment:
        lengths, raw = _expand(row["texts"])
        ends, raw = np.cumsum(lengths), raw.tobytes()
        texts = [raw[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
        return cls(texts, pa.ipc.open_stream(zstandard.decompress(row["rest"])).read_all())

    def keys(self, shards: int, width: int) -> Keys:
        anchors = find_anchors(self.raw, self.ends, width)
        order = np.argsort(anchors.key)
        ordered = anchors.key[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
        shard = _shards_of(ordered[starts], shards).astype(np.uint32)
        return Keys(anchors, order, starts, ordered[starts], np.argsort(shard, kind="stable"), shard)

    def classes(self, bits: pd.DataFrame, shards: int, width: int) -> tuple[Classes, Classes]:
        """The runs of windows whose anchors other documents have, equal ones as one class.

        The second ones are those of hot anchors.
        """
        keys = self.keys(shards, width)
        anchors = keys.anchors
        answers = dict(zip(bits["shard"], bits["answer"], strict=True))
        answered = np.zeros((2, len(keys.key)), bool)
        for number, a, b in _by_shard(keys.shard[keys.dealt]):
            for k, own in enumerate(_expand(answers[number])):
                answered[k, a:b] = np.unpackbits(own, count=b - a)
        repeated, hot = np.zeros((2, len(keys.key)), bool)
        repeated[keys.dealt], hot[keys.dealt] = answered
        if len(keys.starts):
            docs = anchors.doc[keys.order]
            first = np.minimum.reduceat(docs, keys.starts)
            repeated |= first != np.maximum.reduceat(docs, keys.starts)
        return self._classes(keys, repeated & ~hot), self._classes(keys, repeated & hot)

    def _classes(self, keys: Keys, chosen: np.ndarray) -> Classes:
        anchors = keys.anchors
        sizes = np.diff(keys.starts, append=len(keys.order))
        run = keys.order[np.repeat(chosen, sizes)]
        place = np.repeat(keys.shard[chosen], sizes[chosen])
        ids = self.ids[anchors.doc[run]]
        order = np.lexsort((ids, anchors.context[run], anchors.key[run], place))
        run, ids, place = run[order], ids[order], place[order]
        new = np.diff(anchors.key[run], prepend=~anchors.key[run][:1]) != 0
        new |= np.diff(anchors.context[run], prepend=~anchors.context[run][:1]) != 0
        return Classes(anchors, run, ids, np.cumsum(new) - 1, np.flatnonzero(new), place[new])

    def hot_windows(self, hot: Classes, shards: int, width: int) -> HotWindows:
        """The different windows of hot classes, each once with its smallest id."""
        head = hot.run[hot.heads]
        n = hot.anchors.more[head].astype(np.int64) + 1
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(hot.anchors.first[head].astype(np.int64), n) + nth
        ids = np.repeat(hot.ids[hot.heads], n)
        windows = _windows(self.raw, start, width)
        order = np.lexsort((ids, windows))
        new = np.append(True, windows[order[1:]] != windows[order[:-1]])[: len(order)]
        first = order[new]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        key = np.zeros(len(first), np.uint64)
        for k in range(0, len(first), PIECE):
            text = self.raw[start[first[k : k + PIECE], None] + np.arange(width)]
            for column in text.T:
                key[k : k + PIECE] *= np.uint64(BASE)
                key[k : k + PIECE] += BYTE_HASHES[column]
        place = _shards_of(key, shards).astype(np.uint32)
        dealt = np.argsort(place, kind="stable")
        return HotWindows(start[first], ids[first], place, dealt, number, ids, nth)

    def contexts_by_key(self, keys: Keys) -> tuple[np.ndarray, np.ndarray]:
        """Which keys have more than ``FEW_CONTEXTS`` runs, and how many contexts these have."""
        sizes = np.diff(keys.starts, append=len(keys.order))
        many = sizes > FEW_CONTEXTS
        context = keys.anchors.context[keys.order[np.repeat(many, sizes)]]
        key = np.repeat(np.flatnonzero(many), sizes[many])
        order = np.lexsort((context, key))
        context, key = context[order], key[order]
        new = np.append(True, (context[1:] != context[:-1]) | (key[1:] != key[:-1]))[: len(key)]
        counts = np.zeros(len(sizes), np.uint32)
        counts += np.bincount(key[new], minlength=len(sizes)).astype(np.uint32)
        return many, counts


@dataclass
class HotWindows:
    """Windows from ``start`` on with their smallest id, and the ``shard`` in whose order ``dealt``.

    For each window of each class, ``number`` is which of them it is, ``ids`` the id of its class
    and ``nth`` its place there.
    """

    start: np.ndarray
    least: np.ndarray
    shard: np.ndarray
    dealt: np.ndarray
    number: np.ndarray
    ids: np.ndarray
    nth: np.ndarray

    def masks(self, answers: list[np.ndarray]) -> np.ndarray:
        """For each class, a bit for each of its windows that a smaller id has."""
        known = np.zeros(len(self.start), bool)
        known[self.dealt] = np.concatenate((*answers, np.zeros(0, bool)))
        found = known[self.number] | (self.ids > self.least[self.number])
        bits = found.astype(np.uint32) << self.nth.astype(np.uint32)
        begins = np.flatnonzero(self.nth == 0)
        return np.bitwise_or.reduceat(bits, begins) if len(begins) else bits


@dataclass
class Keys:
    """A segment's anchors and their different keys.

    ``order`` sorts the anchors by key, ``starts`` is where each of the keys ``key`` begins there,
    and ``dealt`` orders the keys by ``shard``.
    """

    anchors: Anchors
    order: np.ndarray
    starts: np.ndarray
    key: np.ndarray
    dealt: np.ndarray
    shard: np.ndarray


@dataclass
class Classes:
    """Runs ordered by class and id: ``heads`` are the first of each class, of shard ``place``."""

    anchors: Anchors | None
    run: np.ndarray
    ids: np.ndarray
    number: np.ndarray
    heads: np.ndarray
    place: np.ndarray


def _segments(batches: Iterator[pa.RecordBatch], kept: list[str]) -> Iterator[Segment]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0)
        group = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64) // SEGMENT_BYTES
        edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            part = table.slice(a, b - a)
            texts = [t.encode() if t else b"" for t in part["text"].to_pylist()]
            yield Segment(texts, part.select(kept))


def _emit(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


BLOCKS = pa.schema([("name", pa.int64()), ("shard", pa.int32()), ("block", pa.binary())])
WHOLE = pa.schema([("name", pa.int64()), ("texts", pa.binary()), ("rest", pa.binary())])


def _report_keys(shards: int, width: int, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in released(_segments(batches, kept)):
            keys = segment.keys(shards, width)
            key = keys.key[keys.dealt]
            many, counts = (x[keys.dealt] for x in segment.contexts_by_key(keys))
            rows = []
            for s, a, b in _by_shard(keys.shard[keys.dealt]):
                at = np.flatnonzero(many[a:b]).astype(np.uint32)
                block = _compress([_narrow(key[a:b]), at, counts[a:b][at]])
                rows.append({"name": segment.name, "shard": s, "block": block})
            yield _emit(rows, BLOCKS)

    return run


def _narrow(rising: np.ndarray) -> np.ndarray:
    steps = np.diff(rising, prepend=np.uint64(0))
    return steps.astype(np.min_scalar_type(int(steps.max(initial=0))))


def _whole_segments(kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in _segments(batches, kept):
            yield _emit([segment.to_row()], WHOLE)

    return run


def _repeated_keys(group: pd.DataFrame) -> pd.DataFrame:
    """For each segment's keys, which of them another segment has as well, and which are hot."""
    sizes, keys, many, more = [], [], [], []
    for block in group["block"]:
        steps, at, counts = _expand(block)
        keys.append(np.cumsum(steps.astype(np.uint64)))
        sizes.append(len(steps))
        many.append(keys[-1][at])
        more.append(counts.astype(np.int64) - 1)
    key = np.concatenate(keys)
    del keys
    order = np.argsort(key)
    again = key[order[1:]] == key[order[:-1]]
    several = np.zeros(len(key), bool)
    several[order[1:][again]] = True
    several[order[:-1][again]] = True
    hot = np.zeros(len(key), bool)
    candidates, place = np.unique(np.concatenate(many), return_inverse=True)
    excess = np.zeros(len(candidates), np.int64)
    np.add.at(excess, place, np.concatenate(more))
    if len(group) > HOT_CONTEXTS:
        # so many segments may make a key hot with few contexts each
        starts = np.flatnonzero(np.append(True, ~again))
        often = starts[np.diff(starts, append=len(key)) > HOT_CONTEXTS]
        candidates = np.append(candidates, key[order[often]])
        excess = np.append(excess, np.full(len(often), HOT_CONTEXTS))
    del again
    # a key stands once in a segment at most
    for k, n in zip(candidates, excess.tolist(), strict=True):
        if n + len(group) > HOT_CONTEXTS:
            low, high = (np.searchsorted(key, k, side, sorter=order) for side in ("left", "right"))
            hot[order[low:high]] |= n + high - low > HOT_CONTEXTS
    ends = np.cumsum(sizes)
    answers = [
        _compress([np.packbits(x[e - n : e]) for x in (several, hot)])
        for n, e in zip(sizes, ends, strict=True)
    ]
    return pd.DataFrame({"name": group["name"], "shard": group["shard"], "answer": answers})


def _report_contexts(shards: int, width: int):
    def run(segments: pd.DataFrame, bits: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in segments.to_dict("records"):
            segment = Segment.from_row(row)
            c, hot = segment.classes(bits, shards, width)
            a, head = c.anchors, c.run[c.heads]
            raw = segment.raw
            w = segment.hot_windows(hot, shards, width)
            cold = {s: (low, high) for s, low, high in _by_shard(c.place)}
            dealt = {s: (low, high) for s, low, high in _by_shard(w.shard[w.dealt])}
            for s in sorted(cold.keys() | dealt.keys()):
                low, high = cold.get(s, (0, 0))
                own = head[low:high]
                length = a.more[own].astype(np.int64) + width
                at = np.repeat(a.first[own] - np.cumsum(length) + length, length)
                text = raw[at + np.arange(length.sum())]
                block = [a.key[own], a.context[own], c.ids[c.heads[low:high]],
                         a.more[own], text]
                mine = w.dealt[slice(*dealt.get(s, (0, 0)))]
                block += [w.least[mine], raw[w.start[mine, None] + np.arange(width)].ravel()]
                out.append((row["name"], s, _compress(block)))
            del segment, c, hot, a, head, raw, w
            release()
        return pd.DataFrame(out, columns=["name", "shard", "block"])

    return run


class Levels:
    """Sorted windows with the smallest id of each, in levels of geometrically growing size."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which windows also have a smaller id; ids must not fall from one batch to the next."""
        order = np.lexsort((ids, windows))
        array, own = windows[order], ids[order]
        new = np.append(True, array[1:] != array[:-1])
        number = np.cumsum(new) - 1
        array, least = array[new], own[new]
        known = least.copy()
        for level, level_ids in self.levels:
            at = np.minimum(np.searchsorted(level, array), len(level) - 1)
            known = np.where(level[at] == array, np.minimum(level_ids[at], known), known)
        found = np.empty(len(windows), bool)
        found[order] = own > known[number]
        self._insert(array, known)
        return found

    def _insert(self, array: np.ndarray, ids: np.ndarray) -> None:
        while self.levels and len(self.levels[-1][0]) <= len(array):
            level, level_ids = self.levels.pop()
            array, ids = np.concatenate((level, array)), np.concatenate((level_ids, ids))
            order = np.argsort(array, kind="stable")
            array, ids = array[order], ids[order]
            new = np.append(True, array[1:] != array[:-1])
            array, ids = array[new], np.minimum.reduceat(ids, np.flatnonzero(new))
        self.levels.append((array, ids))


def _removed_windows(width: int):
    """For each context of a shard, a bit for each of its windows that a smaller id has.

    For each window of a hot anchor, whether a smaller id has it.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        blocks = [_expand(b) for b in group["block"]]
        hot = _found_windows([b[5] for b in blocks], [b[6] for b in blocks], width)
        key, context, ids, more, text = (
            np.concatenate([b[k] for b in blocks]) for k in range(5)
        )
        sizes = [len(b[0]) for b in blocks]
        del blocks
        more = more.astype(np.int64)
        begin = np.cumsum(more + width) - more - width
        everything = (np.uint64(2) << more.astype(np.uint64)) - np.uint64(1)
        order = np.lexsort((ids, context, key))
        new_key = np.diff(key[order], prepend=~key[order][:1]) != 0
        new = new_key | (np.diff(context[order], prepend=~context[order][:1]) != 0)
        number = np.cumsum(new) - 1
        head = order[np.flatnonzero(new)]
        mask = np.zeros(len(key), np.uint64)
        later = ids[order] > ids[head][number]
        mask[order[later]] = everything[order[later]]

        # contexts of a key that differ may still share windows
        of_key = np.cumsum(new_key[new]) - 1
        compared = head[np.bincount(of_key)[of_key] > 1]
        compared = compared[np.argsort(ids[compared], kind="stable")]
        levels, partial = Levels(), np.zeros(len(key), np.uint64)
        ends = np.cumsum(more[compared] + 1)
        for part in np.split(compared, np.flatnonzero(np.diff(ends // BATCH_WINDOWS)) + 1):
            if not len(part):
                continue
            n = more[part] + 1
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = np.repeat(begin[part], n) + nth
            found = levels.add(_windows(text, start, width), np.repeat(ids[part], n))
            bits = found.astype(np.uint64) << nth.astype(np.uint64)
            partial[part] = np.bitwise_or.reduceat(bits, np.cumsum(n) - n)
        # copies of a head, of the same id, share its answer
        mask[order[~later]] |= partial[head][number[~later]]
        answers = [
            _compress([mask[e - n : e].astype(np.uint32), np.packbits(h)])
            for n, e, h in zip(sizes, np.cumsum(sizes), hot, strict=True)
        ]
        return pd.DataFrame({"name": group["name"], "shard": group["shard"], "answer": answers})

    return run


def _found_windows(
    ids: list[np.ndarray], texts: list[np.ndarray], width: int
) -> list[np.ndarray]:
    """For the windows of each block, whether a smaller id has them."""
    own, text = np.concatenate(ids), np.concatenate(texts)
    levels, found = Levels(), np.zeros(len(own), bool)
    order = np.argsort(own, kind="stable")
    for k in range(0, len(order), BATCH_WINDOWS):
        part = order[k : k + BATCH_WINDOWS]
        found[part] = levels.add(_windows(text, part * width, width), own[part])
    return np.split(found, np.cumsum([len(x) for x in ids])[:-1])


def _windows(text: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Byte strings that numpy sorts; all have the same length, so padding cannot matter."""
    return text[start[:, None] + np.arange(width)].view(f"S{width}").ravel()


def _cleaned(shards: int, width: int, schema_names: list[str]):
    def run(segments: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        bits, masks = answers[~answers["windows"]], answers[answers["windows"]]
        out = [
            _clean(Segment.from_row(row), bits, masks, shards, width, schema_names)
            for row in segments.to_dict("records")
        ]
        release()
        found = pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=schema_names)
        return found[schema_names]

    return run


def _clean(
    segment: Segment, bits, masks, shards: int, width: int, names: list[str]
) -> pd.DataFrame:
    c, hot = segment.classes(bits, shards, width)
    answer = {s: _expand(b) for s, b in zip(masks["shard"], masks["answer"], strict=True)}
    own = [answer[s][0] for s, _, _ in _by_shard(c.place)]
    mask = np.concatenate(own) if own else np.zeros(0, np.uint32)
    w = segment.hot_windows(hot, shards, width)
    known = [
        np.unpackbits(answer[s][1], count=b - a).astype(bool)
        for s, a, b in _by_shard(w.shard[w.dealt])
    ]
    change = np.zeros(len(segment.raw) + 1, np.int32)
    _mark_removed(change, c, mask, width)
    _mark_removed(change, hot, w.masks(known), width)
    del c, hot, w
    gone = np.cumsum(change[:-1], out=change[:-1]) > 0
    del change
    # runs end where documents end
    starts = np.concatenate(([0], segment.ends[:-1]))
    stays = ~gone
    edge = np.diff(gone.view(np.int8), prepend=0) > 0
    filled = starts[starts < segment.ends]
    edge[filled] |= gone[filled]
    run_starts = np.flatnonzero(edge)
    run_doc = np.searchsorted(segment.ends, run_starts, side="right")
    # a run lasts until the next byte that stays, or to the end of its document
    stay = np.append(np.flatnonzero(stays), len(gone))
    run_ends = np.minimum(stay[np.searchsorted(stay, run_starts)], segment.ends[run_doc])
    removed: list[list] = [[] for _ in segment.texts]
    for d, a, b in zip(run_doc.tolist(), run_starts.tolist(), run_ends.tolist(), strict=True):
        removed[d].append((a - int(starts[d]), b - a))
    kept = []
    for text, spans in zip(segment.texts, removed, strict=True):
        parts, at = [], 0
        for start, length in spans:
            parts.append(text[at:start])
            at = start + length
        kept.append(b"".join((*parts, text[at:])))
    found = segment.rest.to_pandas()
    found["n_bytes"] = segment.ends - starts
    found["removed"] = [[{"start": a, "length": n} for a, n in spans] for spans in removed]
    found["kept"] = kept
    if TEXT.name in names:
        found[TEXT.name] = [b.decode("utf-8", "ignore") for b in kept]
    return found


def _mark_removed(change: np.ndarray, c: Classes, mask: np.ndarray, width: int) -> None:
    """Adds where removed windows begin, and takes off where they end; ``mask`` is by class."""
    first, more = (x[c.run].astype(np.int64) for x in (c.anchors.first, c.anchors.more))
    c.anchors = None
    whole = (1 << (more + 1)) - 1
    mask = np.where(c.ids > c.ids[c.heads][c.number], whole, mask[c.number].astype(np.int64))
    for k in range(int(more.max(initial=-1)) + 1):
        at = first[(mask >> k) & 1 == 1] + k
        np.add.at(change, at, 1)
        np.add.at(change, at + width, -1)


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, keep: tuple[str, ...] = ("doc_id",),
    shards: int | None = None, with_text: bool = False,
) -> DataFrame:
    """The columns ``keep`` of each row of ``docs`` with ``n_bytes, removed, kept`` of its text.

    Texts are UTF-8 bytes; NULL is empty. A byte is removed if it lies in a string of ``width``
    bytes that also starts in a document with a smaller ``doc_id``; strings are judged on the input
    and never run across documents. ``removed`` are the maximal runs removed (``start``, ``length``
    in bytes), ``kept`` the other bytes, which may cut a character; ``with_text`` adds the whole
    characters among them as ``kept_text``. Rows with the same ``doc_id``
    take nothing from each other; a NULL id comes last. ``keep`` must hold ``doc_id``; columns
    called like a result are replaced. There is a shard for each ``SHARD_BYTES`` of text, however
    many tasks share them, unless ``shards`` says otherwise. The rows
    of ``docs`` are read three times and must come in the same order, as those of files do; the
    text is also measured first.
    """
    if shards is None:
        size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        shards = max(1, -(-size // SHARD_BYTES))
    results = FOUND.fields + [TEXT] * with_text
    kept = [c for c in keep if c not in [f.name for f in results]]
    own = docs.select(*dict.fromkeys((*kept, "doc_id", "text")))
    schema = StructType([own.schema[c] for c in kept] + results)
    block, answer = "name long, shard int, block binary", "name long, shard int, answer binary"

    carried = list(dict.fromkeys((*kept, "doc_id")))
    segments = own.mapInArrow(_whole_segments(carried), "name long, texts binary, rest binary")
    keys = own.mapInArrow(_report_keys(shards, width, carried), block)
    bits = keys.groupBy("shard").applyInPandas(_repeated_keys, answer)
    contexts = (
        segments.groupBy("name").cogroup(bits.groupBy("name"))
        .applyInPandas(_report_contexts(shards, width), block)
    )
    masks = contexts.groupBy("shard").applyInPandas(_removed_windows(width), answer)
    answers = bits.withColumn("windows", F.lit(False)).unionAll(
        masks.withColumn("windows", F.lit(True))
    )
    again = own.mapInArrow(_whole_segments(carried), "name long, texts binary, rest binary")
    return (
        again.groupBy("name").cogroup(answers.groupBy("name"))
        .applyInPandas(_cleaned(shards, width, schema.names), schema)
    )
