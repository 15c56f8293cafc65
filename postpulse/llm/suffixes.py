"""Repeated passages by a difference cover of the suffixes, sorted over the whole corpus.

Every pair of places has a common shift, below PERIOD, that takes both to sampled places: places
whose number modulo PERIOD lies in COVER. So two suffixes that agree in ``length`` bytes agree in
the triple of blocks at some sampled place of both.

* First copies that are long are taken out: texts are cut into stretches at places that their bytes
  choose, and equal stretches get one name and the smallest document that has it. A stretch that
  an earlier document has is removed whole; of each name only the earliest stretches go on.
* Sort the sampled triples of these: their names are fingerprints, dealt to ranges and sorted
  there. A suffix whose prefix holds only triples of one stretch is unique and is discarded.
  A prefix of ``length`` bytes is too short to hold a second sampled triple
  of its class, so names of names decide nothing more and recursion ends here.
* Merge the remaining suffixes, sampled or not: their prefixes are sorted by range, and adjacent
  ones compared. Runs of equal prefixes learn the smallest document that has one.

Documents are stored once, in chunks, and only questions and answers move; ranges answer each chunk in the order of its question, and the number
of ranges follows the bytes of the corpus. Neither copies nor frequent passages meet in one task,
as a chunk asks once for what it has often.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..scratch import shared_folder
from .chunks import own_list, own_type, text_chunks, with_own
from .ngrams import bucket_ends, packed, packed_keys, unpacked, unpacked_keys
from .rows import reach_workers, stored, without

LENGTH = 50
# A perfect difference set: every remainder is a difference of two of its members.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
BLOCK = 10
CHUNK_BYTES = 6 << 20
BUCKET_BYTES = 8 << 20
# Texts are kept in buckets of about so many bytes, one task each.
TASK_BYTES = 16 << 20
# Places are worked on in windows of so many bytes.
WINDOW = 1 << 20
# Fingerprints are made of so many places at once, which stay in a core's cache.
AT_ONCE = 1 << 14
# Names keep so many leading bits more than the corpus has places; equal bits of different triples
# only keep a suffix in the race.
SPARE_BITS = 7
# Prefixes keep so many more in their first fingerprint, beside 32 bits in the second.
PREFIX_BITS = 24
LAST = np.int64(2**63 - 1)
ADDED = ("n_bytes", "n_removed", "n_spans", "spans", "kept")
_TRIPLE, _STRETCH, _PREFIX, _REMOVED, _WAITING = range(5)
# Bytes of a second name.
_SECOND = {_STRETCH: "<u8", _PREFIX: "<u4"}
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(32))) * _M2
    keys = (keys ^ (keys >> np.uint64(29))) * _M1
    return keys ^ (keys >> np.uint64(32))


def _mix(keys: np.ndarray) -> None:
    """As :func:`_mixed`, in place."""
    keys ^= keys >> np.uint64(32)
    keys *= _M2
    keys ^= keys >> np.uint64(29)
    keys *= _M1
    keys ^= keys >> np.uint64(32)


def _factors(count: int) -> np.ndarray:
    """Odd factors, one for each word of a string."""
    return _mixed(np.arange(1, count + 1, dtype=np.uint64) * _M1) | np.uint64(1)


def _sampled_before(places: np.ndarray) -> np.ndarray:
    """How many sampled places are less than each place."""
    row, rest = np.divmod(places, PERIOD)
    return row * len(COVER) + np.searchsorted(COVER, rest)


def packed_longs(numbers: np.ndarray) -> bytes:
    planes = numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked_longs(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()


def _ordered(keys: np.ndarray, spare: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order, where each was, and where each different one begins.

    Where the ``spare`` low bits of all keys, which are zero, hold a place, key and place are sorted as one number.
    """
    count = len(keys)
    if count >> spare == 0:
        ordered = keys | np.arange(count, dtype=np.uint64)
        ordered.sort()
        mask = np.uint64((1 << spare) - 1)
        order = (ordered & mask).astype(np.int64)
        ordered &= ~mask
    else:
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    new = np.ones(count, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return ordered, order, np.flatnonzero(new)


def _ranges(low: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` numbers from each ``low`` on."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - low, counts)


class Places:
    """The bytes of a chunk's documents in a row, and what starts at each place."""

    def __init__(self, raw: bytes, sizes: np.ndarray, length: int, name_bits: int = 64):
        self.raw, self.length, self.size = raw, length, len(raw)
        self.dropped = np.uint64(64 - name_bits)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        padded = raw + bytes(length + 16)
        #: The eight bytes from each place on.
        self.words = np.ndarray((len(raw) + length + 8,), "<u8", padded, strides=(1,))

    def documents(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, side="right")

    def fingerprints(self, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Two of the ``size`` bytes from each place on; at least eight. The second has 32 bits."""
        out, second = np.full(len(places), _M2, np.uint64), np.zeros(len(places), np.uint64)
        offsets = [*range(0, size - 8, 8), size - 8]
        for i in range(0, len(places), AT_ONCE):
            own, one, two = places[i : i + AT_ONCE], out[i : i + AT_ONCE], second[i : i + AT_ONCE]
            for at, factor in zip(offsets, _factors(len(offsets)), strict=True):
                words = self.words[own + at]
                one ^= words
                _mix(one)
                one += _M1
                words *= factor
                two += words
            _mix(two)
        second >>= np.uint64(32)
        return out, second

    def triples(self) -> tuple[np.ndarray, np.ndarray]:
        """Sampled places and the names of their triples, where one fits before the document ends."""
        return self.triples_within(self.starts, self.ends - 3 * BLOCK + 1)[:2]

    def triples_within(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Sampled places from each start up to its end, names of their triples, and which start it is.

        Different triples may have equal names: what is named is compared once more.
        """
        rows = -(-self.size // PERIOD)
        names = np.empty((rows, len(COVER)), np.uint64)
        offsets = [*range(0, 3 * BLOCK - 8, 8), 3 * BLOCK - 8]
        factors = _factors(len(offsets))
        step = max(1, WINDOW // PERIOD)
        for at in range(0, rows, step):
            many = min(step, rows - at)
            for column, shift in enumerate(COVER):
                own = np.zeros(many, np.uint64)
                for offset, factor in zip(offsets, factors, strict=True):
                    first = at * PERIOD + shift + offset
                    own += self.words[first : first + (many - 1) * PERIOD + 1 : PERIOD] * factor
                _mix(own)
                names[at : at + many, column] = own
        low = _sampled_before(starts)
        counts = np.maximum(_sampled_before(np.maximum(ends, starts)) - low, 0)
        index = _ranges(low, counts)
        sampled = (np.arange(rows)[:, None] * PERIOD + np.array(COVER)).ravel()
        own = names.ravel()[index] >> self.dropped << self.dropped
        return sampled[index], own, np.repeat(np.arange(len(starts)), counts)

    def stretches(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the stretches: cut where the next eight bytes say so, and at documents."""
        cuts, step = [self.starts[self.ends > self.starts]], min(WINDOW, AT_ONCE)
        for at in range(0, self.size, step):
            words = self.words[at : min(at + step, self.size)] + _M1
            _mix(words)
            cuts.append(np.flatnonzero(words < np.uint64(1 << 57)) + at)
        starts = np.sort(np.concatenate(cuts), kind="stable")
        starts = starts[np.diff(starts, prepend=-1) > 0]
        return starts, np.append(starts[1:], self.size) if len(starts) else starts


def stretch_names(places: Places) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, name, second name) of the stretches in which a prefix starts, named with what
    follows as far as their last prefix goes."""
    starts, ends = places.stretches()
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return starts, ends, none, none
    document_end = places.ends[places.documents(starts)]
    reach = np.minimum(ends + places.length - 1, document_end)
    fits = reach - starts >= places.length
    starts, ends, reach = starts[fits], ends[fits], reach[fits]
    view, digest = memoryview(places.raw), xxhash.xxh3_128_digest
    raw = b"".join(digest(view[s:e]) for s, e in zip(starts.tolist(), reach.tolist(), strict=True))
    names = np.frombuffer(raw, "<u8").reshape(-1, 2)
    return starts, np.minimum(ends, reach - places.length + 1), names[:, 0].copy(), names[:, 1].copy()


def _least(keys: np.ndarray, second: np.ndarray, documents: np.ndarray):
    """Different (key, second) in order with their least document, and where each given one is."""
    order = np.argsort(keys)
    ordered, other = keys[order], second[order]
    new = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    changed = other[1:] != other[:-1]
    if (changed > new[1:]).any():
        # Different strings with one key: rare, as keys are long.
        order = np.lexsort((second, keys))
        ordered, other = keys[order], second[order]
        new[1:] = (ordered[1:] != ordered[:-1]) | (other[1:] != other[:-1])
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    first = order[starts]
    least = np.minimum.reduceat(documents[order], starts) if len(starts) else documents
    return keys[first], second[first], least, rank


# --- rounds --------------------------------------------------------------------------

_CHUNK = "chunk bigint, ids binary, sizes binary, bytes binary"
_ASK = "kind int, bucket int, chunk bigint, keys binary, second binary, documents binary"
_ANSWER = "kind int, bucket int, chunk bigint, answer binary"


def _gather(schema: StructType, chunk_bytes: int):
    arrow = to_arrow_schema(schema)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in text_chunks(batches, "words", chunk_bytes):
            texts = [t or b"" for t in rows.column("words").cast(pa.binary()).to_pylist()]
            ids = rows.column("id").combine_chunks().fill_null(int(LAST)).to_numpy()
            values = {
                "chunk": number,
                "ids": packed_longs(ids),
                "sizes": packed(np.array([len(t) for t in texts])),
                "bytes": zstandard.ZstdCompressor(level=3).compress(b"".join(texts)),
            }
            arrays = [
                own_list(rows, f.type) if f.name == "own" else pa.array([values[f.name]], f.type)
                for f in arrow
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return gather


def _chunk(row: dict, length: int, name_bits: int = 64) -> tuple[Places, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(row["bytes"])
    return Places(raw, unpacked(row["sizes"]), length, name_bits), unpacked_longs(row["ids"])


def _questions(number: int, kind: int, buckets: int, keys, second, documents) -> list[tuple]:
    """Second names have no order that could be compressed. Triples have none, and a bit for a document."""
    ends = bucket_ends(keys, buckets).tolist()
    bits = kind == _TRIPLE
    return [
        (
            kind, b, number, packed_keys(keys[i:j]), b"" if bits else second[i:j].astype(_SECOND[kind]).tobytes(),
            np.packbits(documents[i:j]).tobytes() if bits else packed_longs(documents[i:j]),
        )
        for b, (i, j) in enumerate(zip(ends, ends[1:], strict=False))
        if i < j
    ]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _stretch_asker(buckets: int, length: int):
    schema = to_arrow_schema(StructType.fromDDL(_ASK))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            places, ids = _chunk(row, length)
            starts, _, one, two = stretch_names(places)
            one, two, least, _ = _least(one, two, ids[places.documents(starts)])
            yield _batch(_questions(row["chunk"], _STRETCH, buckets, one, two, least), schema)

    return ask


@dataclass
class _Earliest:
    """The stretches of a chunk that no earlier document has, their triples, and the other stretches."""

    places: Places
    starts: np.ndarray
    ends: np.ndarray
    sampled: np.ndarray
    order: np.ndarray
    first: np.ndarray
    names: np.ndarray
    several: np.ndarray
    removed: np.ndarray


def _earliest(row: dict, answers: list[dict], length: int, name_bits: int) -> _Earliest:
    places, ids = _chunk(row, length, name_bits)
    starts, ends, one, two = stretch_names(places)
    own = ids[places.documents(starts)]
    *_, place = _least(one, two, own)
    replies = map(unpacked_longs, _answer_list(answers, _STRETCH))
    least = np.concatenate([np.zeros(0, np.int64), *replies])
    earlier = least[place] < own
    removed = np.column_stack([starts[earlier], ends[earlier] + length - 1])
    starts, ends = starts[~earlier], ends[~earlier]
    # Triples that a prefix from one of these stretches can hold.
    reach = ends + length - 3 * BLOCK
    reach[:-1] = np.minimum(reach[:-1], starts[1:])
    sampled, names, at = places.triples_within(starts, reach)
    ordered, order, first = _ordered(names, int(places.dropped))
    # Places and so stretches of equal names are in order.
    last = np.append(first[1:], len(order))[: len(first)] - 1
    several = at[order[first]] < at[order[last]]
    return _Earliest(places, starts, ends, sampled, order, first, ordered[first], several, removed)


def _chunk_row(chunk: pa.Table) -> dict:
    return {n: chunk.column(n)[0].as_py() for n in ("chunk", "ids", "sizes", "bytes")}


def _triple_asker(buckets: int, length: int, name_bits: int):
    schema = to_arrow_schema(StructType.fromDDL(_ASK))

    def ask(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        row = _chunk_row(chunk)
        own = _earliest(row, answers.to_pylist(), length, name_bits)
        asked = _questions(row["chunk"], _TRIPLE, buckets, own.names, None, own.several)
        return pa.Table.from_batches([_batch(asked, schema)])

    return ask


def _shared(keys: list[np.ndarray], several: np.ndarray) -> np.ndarray:
    """Whether a name is there twice, or one of several stretches."""
    joined = np.concatenate(keys)
    low = int(np.bitwise_or.reduce(joined))
    _, order, first = _ordered(joined, (low & -low).bit_length() - 1 if low else 0)
    counts = np.diff(first, append=len(joined))
    found = (counts > 1) | np.logical_or.reduceat(several[order], first)
    shared = np.empty(len(joined), bool)
    shared[order] = np.repeat(found, counts)
    return shared


def _answered(rows: pd.DataFrame) -> pd.DataFrame:
    """Triples: whether two documents have it. Others: the least document that has it."""
    kind = rows["kind"].iloc[0]
    keys = [unpacked_keys(k) for k in rows["keys"]]
    ends = np.cumsum([len(k) for k in keys])
    bounds = list(zip([0, *ends[:-1]], ends, strict=True))
    if kind == _TRIPLE:
        several = [
            np.unpackbits(np.frombuffer(d, np.uint8), count=len(k))
            for d, k in zip(rows["documents"], keys, strict=True)
        ]
        shared = _shared(keys, np.concatenate(several).astype(bool))
        answers = [np.packbits(shared[i:j]).tobytes() for i, j in bounds]
    else:
        second = np.frombuffer(b"".join(rows["second"]), _SECOND[kind]).astype(np.uint64)
        documents = np.concatenate([unpacked_longs(d) for d in rows["documents"]])
        _, _, least, rank = _least(np.concatenate(keys), second, documents)
        answers = [packed_longs(least[rank[i:j]]) for i, j in bounds]
    return rows[["kind", "bucket", "chunk"]].assign(answer=answers)


def _answer_list(answers: list[dict], kind: int) -> list[bytes]:
    own = sorted((r for r in answers if r["kind"] == kind), key=lambda r: r["bucket"])
    return [r["answer"] for r in own]


def _waiter(buckets: int, length: int, name_bits: int):
    """Removed prefixes of stretches that an earlier document has; waiting ones of the others."""
    schema = to_arrow_schema(StructType.fromDDL(_ANSWER))

    def wait(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        row, replies = _chunk_row(chunk), answers.to_pylist()
        own = _earliest(row, replies, length, name_bits)
        sizes = np.diff(bucket_ends(own.names, buckets))
        bits = [
            np.unpackbits(np.frombuffer(a, np.uint8), count=n)
            for a, n in zip(_answer_list(replies, _TRIPLE), sizes[sizes > 0].tolist(), strict=True)
        ]
        found = np.concatenate([np.zeros(0, np.uint8), *bits]).astype(bool)
        shared = np.empty(len(own.order), bool)
        shared[own.order] = np.repeat(found, np.diff(own.first, append=len(own.order)))
        waiting = _prefixes(own.sampled[shared], own.starts, own.ends, length)
        told = [
            (_REMOVED, 0, row["chunk"], packed(own.removed.ravel())),
            (_WAITING, 0, row["chunk"], packed(np.diff(waiting, prepend=0))),
        ]
        return pa.Table.from_batches([_batch(told, schema)])

    return wait


def _prefixes(sampled: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Places in [start, end) from which a prefix of ``length`` bytes holds a whole sampled triple."""
    if not len(sampled) or not len(starts):
        return np.zeros(0, np.int64)
    # Prefixes around each triple, joined where they touch, then cut to the stretches.
    low, high = sampled - (length - 3 * BLOCK), sampled + 1
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > high[:-1]
    first = np.flatnonzero(new)
    low, high = low[first], high[np.append(first[1:], len(high)) - 1]
    # Stretches and runs are both sorted and disjoint: each run meets a range of stretches.
    begin, stop = np.searchsorted(ends, low, side="right"), np.searchsorted(starts, high, side="left")
    counts = np.maximum(stop - begin, 0)
    which = np.repeat(np.arange(len(low)), counts)
    stretch = _ranges(begin, counts)
    left, right = np.maximum(low[which], starts[stretch]), np.minimum(high[which], ends[stretch])
    sizes = np.maximum(right - left, 0)
    return _ranges(left, sizes)


def _merged_keys(row: dict, answers: list[dict], length: int, key_bits: int):
    places, ids = _chunk(row, length)
    dropped = np.uint64(64 - key_bits)
    waiting = np.cumsum(unpacked(_answer_list(answers, _WAITING)[0]))
    one, two = places.fingerprints(waiting, length)
    one = one >> dropped << dropped
    own = ids[places.documents(waiting)]
    return places, waiting, own, _least(one, two, own)


def _prefix_asker(buckets: int, length: int, key_bits: int):
    schema = to_arrow_schema(StructType.fromDDL(_ASK))

    def ask(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        row = _chunk_row(chunk)
        *_, (one, two, least, _) = _merged_keys(row, answers.to_pylist(), length, key_bits)
        asked = _questions(row["chunk"], _PREFIX, buckets, one, two, least)
        return pa.Table.from_batches([_batch(asked, schema)])

    return ask


def _remover(schema: StructType, length: int, key_bits: int):
    arrow = to_arrow_schema(schema)

    def remove(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        row, replies = _chunk_row(chunk), answers.to_pylist()
        places, waiting, own, (*_, rank) = _merged_keys(row, replies, length, key_bits)
        told = map(unpacked_longs, _answer_list(replies, _PREFIX))
        least = np.concatenate([np.zeros(0, np.int64), *told])
        hit = waiting[least[rank] < own]
        removed = unpacked(_answer_list(replies, _REMOVED)[0]).reshape(-1, 2)
        # Removed strings in order, joined where they touch in one document.
        begin = np.concatenate([hit, removed[:, 0]])
        order = np.argsort(begin, kind="stable")
        begin = begin[order]
        end = np.maximum.accumulate(np.concatenate([hit + length, removed[:, 1]])[order])
        of = places.documents(begin)
        new = np.ones(len(begin), bool)
        new[1:] = (begin[1:] > end[:-1]) | (of[1:] != of[:-1])
        first = np.flatnonzero(new)
        span_starts, of = begin[first], of[first]
        span_ends = end[np.append(first[1:], len(end))[: len(first)] - 1]
        steps = np.zeros(places.size + 1, np.int8)
        steps[span_starts] += 1
        steps[span_ends] -= 1
        gone = np.cumsum(steps[:-1], dtype=np.int8).view(bool)
        sizes = places.ends - places.starts
        counts = np.bincount(of, minlength=len(sizes))
        total = np.concatenate([[0], np.cumsum(span_ends - span_starts)])
        spans_before = np.cumsum(counts)
        removed_of = total[spans_before] - total[spans_before - counts]
        span_type = arrow.field("spans").type
        spans = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(x - places.starts[of], pa.int64()) for x in (span_starts, span_ends)],
                fields=list(span_type.value_type),
            ),
        )
        kept = np.frombuffer(places.raw, np.uint8)[~gone].tobytes()
        ends = np.cumsum(sizes - removed_of)
        bounds = zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True)
        values = [
            pa.array(sizes, pa.int64()),
            pa.array(removed_of, pa.int64()),
            pa.array(counts, pa.int64()),
            spans,
            pa.array([kept[a:b] for a, b in bounds] if len(sizes) else [], pa.binary()),
        ]
        own_columns = chunk.column("own").combine_chunks()[0].values.flatten()
        return pa.Table.from_arrays([*own_columns, *values], schema=arrow)

    return remove


def without_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``docs`` without the text, with n_bytes, n_removed, n_spans, spans and kept.

    Texts are UTF-8 bytes; a null is empty. A byte goes if a string of ``length`` bytes over it, of
    the input, also starts in a document with a smaller id. ``spans`` are the maximal removed runs
    (start, end) in bytes, ``kept`` the other bytes, which need not be whole characters. Rows of one
    id are one document, so they take nothing from each other; a null id is larger than any other.
    Matches do not cross documents. Columns named like the added ones, in any case, are replaced;
    all others stay. An empty table stays empty.
    """
    if length < PERIOD - 1 + 3 * BLOCK:
        raise ValueError(f"length: at least {PERIOD - 1 + 3 * BLOCK}")
    spark = docs.sparkSession
    reach_workers(spark)
    kept = without(docs, [text_col, *ADDED])
    read, fields = with_own(docs, kept, text_col)
    read = read.withColumn("id", F.col(f"own_{[c.lower() for c in kept.columns].index(id_col.lower())}").cast("bigint"))
    schema = StructType.fromDDL(_CHUNK).add("own", own_type(fields))
    size = read.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    name_bits = min(64, int(size).bit_length() + SPARE_BITS)
    key_bits = min(64, int(size).bit_length() + PREFIX_BITS)
    # Bucketed by chunk, so that the texts stay where they are and only answers move.
    name = f"suffix_chunks_{uuid.uuid4().hex}"
    writer = read.mapInArrow(_gather(schema, chunk_bytes), schema).write
    writer.bucketBy(max(1, math.ceil(size / TASK_BYTES)), "chunk").option(
        "path", shared_folder(spark, "suffix-chunks")
    ).saveAsTable(name)
    chunks = spark.table(name)

    def answers(asked: DataFrame, name: str) -> DataFrame:
        return stored(asked.groupBy("kind", "bucket").applyInPandas(_answered, _ANSWER), name)

    def beside(told: DataFrame, work, ddl: str | StructType) -> DataFrame:
        return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(work, ddl)

    columns = ["chunk", "ids", "sizes", "bytes"]
    asked = chunks.select(*columns).mapInArrow(_stretch_asker(buckets, length), _ASK)
    stretches = answers(asked, "suffix-stretches")
    triples = answers(beside(stretches, _triple_asker(buckets, length, name_bits), _ASK), "suffix-triples")
    waiter = _waiter(buckets, length, name_bits)
    waiting = stored(beside(stretches.unionByName(triples), waiter, _ANSWER), "suffix-waiting")
    prefixes = answers(beside(waiting, _prefix_asker(buckets, length, key_bits), _ASK), "suffix-prefixes")
    types = "n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
    out = StructType([*fields, *StructType.fromDDL(types)])
    done = beside(waiting.unionByName(prefixes), _remover(out, length, key_bits), out)
    return done.select(*[F.col(f"own_{i}").alias(c) for i, c in enumerate(kept.columns)], *ADDED)
