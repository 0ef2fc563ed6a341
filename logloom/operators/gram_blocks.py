"""Positions of an n-gram model, packed for one move and counted in groups.

A position is a word ``g0`` with the words before it (``g1`` the last of them, ...).
Whatever an interpolated model asks about a gram of two or more words is a sum
over grams that share its ``g1``, so all positions with one ``g1`` go to one bucket
and only counts of single words come from elsewhere. A block of texts has its words
once and numbers for their places, written once; it sends a bucket its positions as one row.
Numbers are stored as compressed byte planes, the most frequent word of a block as 0.

A word that would fill more than a bucket is split into buckets by ``g2``. Contexts of
two and more words stay whole there; the counts of its bigrams are added up over
its buckets like those of single words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words of a block, and positions a bucket gets on average.
BLOCK = 3_500_000
BUCKET = 3_000_000
CODEC = "zstd"
COUNTED = "bucket int, before string, word string, raw bigint, kept bigint"


def block_fields(kind: str) -> str:
    """Columns of a block: its texts, number of words, words with their counts, numbers of all texts."""
    return f"keys array<{kind}>, n bigint, words array<string>, counts array<bigint>, sizes binary, codes binary"


def to_blocks(most: int):
    """``key, words`` -> blocks of ``most`` words and more, at least a text. Words may be a list or parted by single spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            if not pa.types.is_list(batch.column(1).type):
                batch = pa.RecordBatch.from_arrays([batch.column(0), _parted(batch.column(1))], ["key", "words"])
            sizes = _sizes(batch.column(1))
            first, until = 0, np.cumsum(sizes)
            while first < len(sizes):
                done = int(until[first - 1]) if first else 0
                last = min(int(np.searchsorted(until, done + most - n)) + 1, len(sizes))
                waiting.append(batch.slice(first, last - first))
                n += int(until[last - 1]) - done
                first = last
                if n >= most:
                    yield _block(pa.Table.from_batches(waiting))
                    waiting, n = [], 0
        if waiting:
            yield _block(pa.Table.from_batches(waiting))

    return run


def _parted(texts: pa.Array) -> pa.Array:
    """Lists of words; the empty text has none."""
    lists = pc.split_pattern(texts, " ")
    sizes = np.where(pc.equal(texts, "").to_numpy(zero_copy_only=False), 0, _sizes(lists))
    values = lists.flatten()
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values.filter(pc.not_equal(values, "")))


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _block(texts: pa.Table) -> pa.RecordBatch:
    keys, lists = (_one(texts.column(i)) for i in (0, 1))
    found = lists.flatten().dictionary_encode()
    codes = found.indices.to_numpy()
    counts = np.bincount(codes, minlength=len(found.dictionary))
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    return pa.RecordBatch.from_pydict({
        "keys": _list(keys),
        "n": pa.array([len(codes)], pa.int64()),
        "words": _list(found.dictionary.take(pa.array(order))),
        "counts": _list(pa.array(counts[order], pa.int64())),
        "sizes": pa.array([pack([_sizes(lists)])], pa.binary()),
        "codes": pa.array([pack([rank[codes]])], pa.binary()),
    })


def _list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def pack(columns: list[np.ndarray]) -> bytes:
    planes = [c.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel() for c in columns]
    return pa.compress(np.concatenate(planes).tobytes(), CODEC, asbytes=True)


def unpack(packed: pa.Scalar, many: int, n: int) -> list[np.ndarray]:
    if not n:
        return [np.zeros(0, np.int32)] * many
    planes = np.frombuffer(pa.decompress(packed.as_buffer(), n * 4 * many, CODEC), np.uint8).reshape(many, 4, n)
    return [np.ascontiguousarray(p.T).view("<i4").ravel() for p in planes]


def pack_words(words: pa.Array) -> bytes:
    lengths, data = pc.binary_length(words).to_numpy(zero_copy_only=False), "".join(words.to_pylist()).encode()
    sizes = pack([lengths])
    return b"".join(len(x).to_bytes(8, "little") for x in (sizes, data)) + sizes + pa.compress(data, CODEC, asbytes=True)


def unpack_words(packed: pa.Scalar, n: int) -> pa.Array:
    raw = packed.as_py()
    cut, size = (int.from_bytes(raw[i : i + 8], "little") for i in (0, 8))
    (lengths,) = unpack(pa.scalar(raw[16 : 16 + cut], pa.binary()), 1, n)
    data = pa.decompress(raw[16 + cut :], size, CODEC) if size else pa.py_buffer(b"")
    return pa.StringArray.from_buffers(n, pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32).tobytes()), data)


def to_texts(key: str):
    """Blocks -> ``key, words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, n, words, _, sizes, codes = (batch.column(c)[i] for c in range(6))
                (sizes,), (codes,) = unpack(sizes, 1, len(keys)), unpack(codes, 1, n.as_py())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), words.values.take(pa.array(codes)))
                yield pa.RecordBatch.from_arrays([keys.values, lists], [key, "words"])

    return run


def to_buckets(width: int, parts: int, split: dict[str, tuple[int, int]], start: str):
    """Blocks -> ``bucket, keys, n, n_words, words, places``; ``split`` has the first bucket and number of buckets of a split word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _dealt([batch.column(c)[i] for c in range(6)], width, parts, split, start)

    return run


def _dealt(block: list[pa.Scalar], width: int, parts: int, split: dict, start: str) -> Iterator[pa.RecordBatch]:
    (sizes,), (codes,) = unpack(block[4], 1, len(block[0])), unpack(block[5], 1, block[1].as_py())
    if not len(codes):
        return
    keys, words = block[0].values, block[2].values
    mark = words.index(pa.scalar(start, words.type)).as_py()
    if mark < 0:
        mark, words = len(words), pa.concat_arrays([words, pa.array([start], words.type)])
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    grams = [codes]
    for k in range(1, width):
        before = np.full(len(codes), mark, np.int32)
        before[1:] = grams[-1][:-1]
        before[starts] = mark
        grams.append(before)
    names = words.to_pylist()
    crc = np.array([zlib.crc32(x.encode()) for x in names], np.int64)
    bucket = (crc % parts).astype(np.int32)[grams[1]]
    for number, name in enumerate(names):
        if name in split:
            first, many = split[name]
            of_split = np.flatnonzero(grams[1] == number)
            bucket[of_split] = first + crc[grams[2][of_split]] % many
    order = _order(bucket.astype(np.int64) * len(words) + grams[1])
    bucket, doc, grams = bucket[order], doc[order], [g[order] for g in grams]
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
    for a, b in zip(cuts, cuts[1:]):
        of_words, at_words = _used([g[a:b] for g in grams], len(words))
        of_docs, (at_docs,) = _used([doc[a:b]], len(sizes))
        new = np.diff(at_words[1], prepend=-1) != 0
        columns = [np.diff(at_words[1], prepend=0), np.where(new, at_docs, np.diff(at_docs, prepend=0)), at_words[0], *at_words[2:]]
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array([bucket[a]], pa.int32()),
            "keys": _list(keys.take(pa.array(of_docs))),
            "n": pa.array([b - a], pa.int64()),
            "n_words": pa.array([len(of_words)], pa.int64()),
            "words": pa.array([pack_words(words.take(pa.array(of_words)))], pa.binary()),
            "places": pa.array([pack(columns)], pa.binary()),
        })


def _order(key: np.ndarray) -> np.ndarray:
    """A stable order, by 16 bits at a time, which numpy sorts in linear time."""
    order = np.argsort((key & 0xFFFF).astype(np.uint16), kind="stable")
    most, shift = int(key.max()), 16
    while most >> shift:
        order = order[np.argsort(((key[order] >> shift) & 0xFFFF).astype(np.uint16), kind="stable")]
        shift += 16
    return order


def _one(column: pa.ChunkedArray) -> pa.Array:
    joined = column.combine_chunks()
    return pa.concat_arrays(joined.chunks) if isinstance(joined, pa.ChunkedArray) else joined


def _used(columns: list[np.ndarray], n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The numbers below ``n`` that occur, and their places among them."""
    seen = np.zeros(n, bool)
    for c in columns:
        seen[c] = True
    place = np.cumsum(seen, dtype=np.int32) - 1
    return np.flatnonzero(seen), [place[c] for c in columns]


def _ids(columns: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each different combination of numbers below ``n``, and which one every place has."""
    key, most = columns[0].astype(np.int64), n
    for c in columns[1:]:
        if most * n >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            most = len(key) + 1
        key, most = key * n + c, most * n
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    return first, which.astype(np.int32)


class Bucket:
    """The different grams of a bucket with their counts. Rows are opened one by one; a position keeps its gram and text."""

    def __init__(self, table: pa.Table, width: int):
        self.width, sizes, many_words = width, table.column("n").to_pylist(), table.column("n_words").to_pylist()
        found = pa.concat_arrays([unpack_words(w, n) for w, n in zip(table.column("words"), many_words)]).dictionary_encode()
        self.words, places = found.dictionary, found.indices.to_numpy()
        self.keys, ends = _one(table.column("keys")), np.concatenate([[0], np.cumsum(many_words)])
        packed, parts, self.rows, many = table.column("places"), [], [], 0
        for i, n in enumerate(sizes):
            mid, doc, last, *others = unpack(packed[i], width + 1, n)
            starts = np.flatnonzero(np.concatenate([[True], mid[1:] != 0]))
            sums = np.cumsum(doc)
            doc = sums - np.repeat((sums - doc)[starts], np.diff(np.append(starts, n)))
            grams = [last, np.cumsum(mid), *others]
            first, which = _ids(grams, many_words[i])
            place = places[ends[i] : ends[i + 1]]
            parts.append([place[g[first]] for g in grams] + [np.bincount(which).astype(np.int32)])
            self.rows.append((doc.astype(np.int32), which, many))
            many += len(first)
        *grams, counts = (np.concatenate(x) for x in zip(*parts))
        del parts
        first, self.which = _ids(grams, len(self.words))
        self.grams = [g[first] for g in grams]
        self.counts = np.bincount(self.which, weights=counts)

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First place and number of the grams of the last ``k`` words."""
        if k == self.width:
            return (np.arange(len(self.counts)),) * 2
        return _ids(self.grams[:k], len(self.words))


def counted(width: int, parts: int):
    """Rows of a bucket -> counts of its last words; by word before them if that word is split."""

    def run(table: pa.Table) -> pa.Table:
        bucket, at = Bucket(table, width), table.column("bucket")[0].as_py()
        first, pair = bucket.level(2)
        last, before = bucket.grams[0], None
        if at < parts:
            raw, kept = np.bincount(last, weights=bucket.counts), np.bincount(last[first], minlength=last.max() + 1)
            used = np.flatnonzero(kept)
            raw, kept = raw[used], kept[used]
        else:
            used, before = last[first], bucket.words[int(bucket.grams[1][0])].as_py()
            raw, kept = np.bincount(pair, weights=bucket.counts), np.bincount(pair[bucket.level(3)[0]])
        n = len(used)
        return pa.table({
            "bucket": pa.array(np.full(n, at, np.int32)),
            "before": pa.array([before] * n, pa.string()),
            "word": bucket.words.take(pa.array(used)).cast(pa.string()),
            "raw": pa.array(raw.astype(np.int64)),
            "kept": pa.array(kept.astype(np.int64)),
        })

    return run


def scored(width: int, top: int, parts: int, total: int, discount: float, fields: pa.Schema):
    """Rows of a bucket and the counts for its words -> per text the number of its positions here and their logarithms of orders 1 to ``top``."""

    def run(table: pa.Table, stats: pa.Table) -> pa.Table:
        bucket, is_split = Bucket(table, width), table.column("bucket")[0].as_py() >= parts
        row = pc.fill_null(pc.index_in(bucket.words, value_set=_one(stats.column("word")).cast(bucket.words.type)), 0).to_numpy()
        given = {c: stats.column(c).to_numpy().astype(np.float64) for c in stats.column_names if c not in ("bucket", "word")}
        single = {c: np.maximum(given[c] - discount, 0.0) + discount * given["known"] / (given["known"] + 1) for c in ("word_raw", "word_kept")}
        lower, below = (single["word_kept"] / given["total_kept"])[row], bucket.grams[0]
        logs = [np.log(single["word_raw"] / total)[row][below]]
        levels = {k: bucket.level(k) for k in range(2, top + 1)}
        for k, (first, which) in levels.items():
            context = _ids(bucket.grams[1:k], len(bucket.words))[1]
            own, kinds = context[first], np.bincount(context[first])
            if k == 2 and is_split:
                mine = row[bucket.grams[0][first]]
                raw, raws, kinds, kept, kepts = (given[c][mine] for c in ("raw", "raws", "kinds", "kept", "kepts"))
            else:
                raw, raws, kinds = np.bincount(which, weights=bucket.counts), np.bincount(context, weights=bucket.counts)[own], kinds[own]
                if k < top:
                    further = levels[k + 1][0]
                    kept, kepts = np.bincount(which[further]), np.bincount(context[further])[own]
            rest = kinds * discount * lower[below[first]]
            logs.append(np.log((np.maximum(raw - discount, 0.0) + rest) / raws)[which])
            if k < top:
                lower, below = (np.maximum(kept - discount, 0.0) + rest) / kepts, which
        out = []
        offsets = bucket.keys.offsets.to_numpy()
        for i, (doc, which, many) in enumerate(bucket.rows):
            keys = bucket.keys.values[int(offsets[i]) : int(offsets[i + 1])]
            gram = bucket.which[many + which]
            sums = [np.bincount(doc, weights=x[gram], minlength=len(keys)) for x in logs]
            out.append(pa.Table.from_arrays([keys, pa.array(np.bincount(doc, minlength=len(keys)).astype(np.int64)), *map(pa.array, sums)], schema=fields))
        return pa.concat_tables(out)

    return run
