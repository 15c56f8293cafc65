"""Best-fit packing with certified bin counts.

Pieces are dealt to partitions and packed there by best-fit decreasing. Lower bounds from dual
feasible functions certify a partition's number of bins. Partitions with a gap between bound and
bins deal all documents of bins that are not full anew, certified ones those of their emptiest bin;
they are packed again by best-fit decreasing, round after round until a round saves no bin. One
partition has nobody to exchange with; its bound is returned like any other.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .rows import append_columns, held, reach_workers, runs_of, stored, without

CAPACITY = 4096
END_ID = 1
PIECES_PER_PARTITION = 50_000
CACHED_WORDS = 1_000_000
WORDS_AT_ONCE = 1000


# The tokenizer's own pieces of a text, for lower-cased Latin-1.
_PIECES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d"
    "|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+"
    "|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    "|[^a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe\t-\r \x85\xa0]+"
)


class _Encoder:
    """Token ids of whole texts as little-endian 32-bit words.

    A text is cut at the tokenizer's added tokens first, and the ids of the text between them are
    those of its parts in turn. Parts are remembered, up to a bound, those not used for long
    forgotten first; new ones are encoded many at a time, with a mark between them that is a
    token of its own.
    """

    MARK = "\x00"

    def __init__(self, path: str, cached_words: int | None = None):
        from tokenizers import Tokenizer

        self.most = CACHED_WORDS if cached_words is None else cached_words
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        for token in added.values():
            if token.normalized or token.lstrip or token.rstrip or token.single_word:
                raise ValueError(f"added token {token.content!r} is not matched literally")
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        # The longest token at a place wins.
        literal = "|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))
        self.cut = re.compile(f"({literal})") if literal else None
        (self.mark,) = self.encode(self.MARK)
        # Parts used of late, and those last used before them; each has half the bound.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        # Without the tokens' places in the text, which nobody asks for.
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, "<u4")

    @staticmethod
    def parts(text: str | None) -> list[str]:
        """Latin-1 texts, which need no composition and have simple lower case, in the
        tokenizer's own pieces; others between blanks and line ends, where it always splits."""
        if not text:
            return []
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text.replace("\n", " ").split(" ")
        return _PIECES.findall(text.lower())

    def learn(self, parts: Iterable[str]) -> None:
        plain = [p for p in parts if self.MARK not in p]
        for at in range(0, len(plain), WORDS_AT_ONCE):
            some = plain[at : at + WORDS_AT_ONCE]
            ids = self.encode(f" {self.MARK} ".join(some))
            ends = [*np.flatnonzero(ids == self.mark).tolist(), len(ids)]
            raw, start = ids.tobytes(), 0
            for part, end in zip(some, ends, strict=True):
                self.known[part] = raw[4 * start : 4 * end]
                start = end + 1
        for part in set(parts).difference(plain):
            self.known[part] = self.encode(part).tobytes()

    def whole_ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids as of the tokenizer itself, added tokens in the texts included."""
        # Added tokens stand at the odd places.
        cut = [self.cut.split(t) if self.cut and t else [t] for t in texts]
        plain = self.ids([s for stretches in cut for s in stretches[::2]])
        for stretches in cut:
            yield b"".join(
                self.added[s] if i % 2 else next(plain) for i, s in enumerate(stretches)
            )

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of texts in which no added token stands; ``whole_ids`` cuts these out first."""
        for run in runs_of(texts, 2 * self.most):
            split = [self.parts(t) for t in run]
            new = set().union(*split).difference(self.known)
            if len(self.known) + len(new) > self.most // 2:
                self.older, self.known = self.known, {}
                new = set().union(*split)
            for part in new.intersection(self.older):
                self.known[part] = self.older[part]
            self.learn(new.difference(self.older))
            known = self.known.__getitem__
            for parts in split:
                yield b"".join(map(known, parts))


def encoder(path: str, cached_words: int | None = None) -> _Encoder:
    """One encoder for each Python worker."""
    return held(("encoder", path, cached_words), lambda: _Encoder(path, cached_words))


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """``docs`` without the text, one row for each piece: piece, start, length, ids, ids_crc32.

    A document is its ids and ``end_id``; longer ones are cut every ``capacity`` ids. A null
    or empty text is the end id alone. Added tokens in a text are tokens. ``ids`` are little-endian 32-bit words.
    A Python worker remembers about ``cached_words`` parts of texts: fewer take less memory and more time.
    """
    end = np.array([end_id], "<u4").tobytes()

    def make():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens = encoder(tokenizer_path, cached_words)

        def work(batch: pa.RecordBatch) -> list:
            pieces = []
            for ids in tokens.whole_ids(batch.column(text_col).to_pylist()):
                ids += end
                pieces.append(
                    [
                        {
                            "piece": at // (4 * capacity),
                            "start": at // 4,
                            "length": len(ids[at : at + 4 * capacity]) // 4,
                            "ids": ids[at : at + 4 * capacity],
                        }
                        for at in range(0, len(ids), 4 * capacity)
                    ]
                )
            return [pieces]

        return work

    own = without(docs, ["piece", "start", "length", "ids", "ids_crc32"])
    schema = "__cut array<struct<piece: int, start: bigint, length: bigint, ids: binary>>"
    cut = append_columns(own, schema, make, drop=(text_col,))
    others = [F.col(f"`{c}`") for c in cut.columns if c != "__cut"]
    pieces = cut.select(*others, F.inline("__cut"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece: longest first, into the fullest bin that still holds it."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free room
    rooms: list[int] = []  # sorted, the rooms that some bin has
    count = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        at = bisect_left(rooms, size)
        if at == len(rooms):
            number, room = count, capacity
            count += 1
        else:
            room = rooms[at]
            number = open_bins[room].pop()
            if not open_bins[room]:
                rooms.pop(at)
        bins[i], offsets[i] = number, capacity - room
        room -= size
        if room:
            if not open_bins[room]:
                insort(rooms, room)
            open_bins[room].append(number)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that no packing can do without.

    The largest of three families: the volume; a function that rounds pieces above
    ``capacity - t`` up to a full bin and drops those below ``t``; and one that counts pieces in
    steps of ``1 / (k + 1)``, exact multiples kept as they are.
    """
    if not len(lengths):
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = -(-int(sizes @ counts) // capacity)
    for t in np.unique(sizes[2 * sizes <= capacity]):
        weights = np.where(sizes > capacity - t, capacity, np.where(sizes < t, 0, sizes))
        best = max(best, -(-int(weights @ counts) // capacity))
    for k in range(1, 21):
        whole = (k + 1) * sizes % capacity == 0
        # All weights times k * capacity, to stay with whole numbers.
        weights = np.where(whole, sizes * k, (k + 1) * sizes // capacity * capacity)
        best = max(best, -(-int(weights @ counts) // (k * capacity)))
    return best


def _packer(capacity: int, exchange: bool):
    """Pack one partition; ``open`` marks the bins whose documents go to the exchange.

    ``bins`` and ``bound`` are those of the documents that stay, and of those that are open.
    """

    def pack(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "row"], ascending=[False, True])
        lengths = pieces["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, lengths).astype(np.int64)
        loose = np.zeros(len(fill), bool)
        if exchange:
            gap = len(fill) - lower_bound(lengths, capacity)
            loose[np.argsort(fill, kind="stable")[: len(fill) if gap else 1]] = True
            loose &= fill < capacity
        is_open = loose[bins]
        bounds = [lower_bound(lengths[is_open == side], capacity) for side in (False, True)]
        return pieces.assign(
            part=key[0],
            bin=bins,
            offset=offsets,
            open=is_open,
            bins=np.where(is_open, loose.sum(), (~loose).sum()),
            bound=np.where(is_open, bounds[1], bounds[0]),
        )

    return pack


def _bins_of(packed: DataFrame) -> tuple[int, int]:
    """Bins of all partitions, and how many of them are open."""
    parts = packed.groupBy("part", "open").agg(F.max("bins").alias("bins"))
    sums = parts.agg(F.sum("bins"), F.sum(F.when(F.col("open"), F.col("bins")))).first()
    return sums[0] or 0, sums[1] or 0


def pack(
    pieces: DataFrame,
    *,
    capacity: int = CAPACITY,
    pieces_per_partition: int = PIECES_PER_PARTITION,
    certify: bool = False,
) -> DataFrame:
    """``pieces`` (column ``length``, at most ``capacity``) with sequence_id and offset.

    Rounds go on until the number of bins stops falling; a round that saves none is not taken over.
    ``certify`` adds the certificate of each piece: ``packed_in`` (the round and partition that it
    stayed in, those of its open bins apart), ``packed_bins`` and ``packed_bound``, the bins of the pieces that stayed there and
    the least that they need. Rows that are equal are pieces of their own; an empty table stays
    empty. Columns named like the added ones, in any case, are replaced.
    """
    reach_workers(pieces.sparkSession)
    certificate = ["packed_in", "packed_bins", "packed_bound"] if certify else []
    kept = without(pieces, ["sequence_id", "offset", *certificate])
    named = [F.col(f"`{c}`") for c in kept.columns]
    rows = stored(
        kept.select(F.monotonically_increasing_id().alias("row"), F.struct(*named).alias("own")),
        "pieces",
    )
    schema = (
        "row bigint, length bigint, part bigint, bin bigint, offset bigint, open boolean, "
        "bins bigint, bound bigint"
    )
    waiting = rows.select("row", F.col("own.length").alias("length"))
    count = waiting.count()
    done, before, occupied, number = None, None, 0, 0
    while True:
        parts = max(1, -(-count // pieces_per_partition))
        part = F.pmod(F.xxhash64("row", F.lit(number)), F.lit(parts)).cast("bigint")
        dealt = waiting.withColumn("part", part).groupBy("part")
        packed = stored(dealt.applyInPandas(_packer(capacity, parts > 1), schema), "packed").select(
            "*",
            (F.lit(number).cast("bigint") * F.lit(1 << 56) + F.col("part") * F.lit(1 << 32)).alias("at"),
        )
        bins, opened = _bins_of(packed)
        if before is not None and bins >= occupied:
            # This round saved nothing: its documents stay where they were.
            done = done.unionByName(before)
            break
        closed = packed.filter(~F.col("open"))
        done = closed if done is None else done.unionByName(closed)
        if not opened:
            break
        before, occupied, number = packed.filter("open"), opened, number + 1
        waiting = before.select("row", "length")
        count = waiting.count()
    kept_in = F.col("at") + F.when(F.col("open"), F.lit(1 << 31)).otherwise(F.lit(0))
    placed = done.withColumn("kept_in", kept_in).select(
        "row",
        (F.col("at") + F.col("bin")).alias("sequence_id"),
        "offset",
        *[F.col(c).alias(n) for c, n in zip(("kept_in", "bins", "bound"), certificate, strict=False)],
    )
    # By sorting at any size: the ids move once, into as many partitions as the session asks for.
    joined = rows.join(placed.hint("merge"), "row")
    return joined.select("own.*", "sequence_id", "offset", *certificate)
