"""Alignment of two tokenizers by sparse products of token-byte incidence matrices.

Both tokenizers cut a text at every blank or line end that follows a visible character, so a
text is a list of units, and a chunk of documents tokenises each of its different units once.
Over the bytes of the units stand two incidence matrices in compressed rows, A and B, one row
for each token, one column for each byte. Row products A·Bᵀ (Gustavson) give the pairs of tokens
that share bytes; the products of the token-group incidence give the pairs that share a group,
those of the matrices of last bytes the pairs that end together.

Pair counts over the corpus are plain aggregates of each chunk's counts; they come back to the
chunks by a join, so neither pairs nor documents meet in one place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .chunks import own_list, own_type, text_chunks, with_own
from .ngrams import packed, unpacked
from .rows import held, reach_workers, stored, without

CHUNK_BYTES = 8 << 20
# Units are tokenised so many bytes at a time.
SLAB_BYTES = 1 << 16
# Longer texts are cut into units one by one, not in one list.
LONG_TEXT = 1 << 20
LINKS = ("overlap", "group", "end")
ADDED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")

# White space, visible characters, and on while the next white space is no blank or line feed.
_UNITS = re.compile(r"\s+\S*(?:[^\S \n]\s*\S*)*")
# A unit that stands before every slab, and is taken away again.
_HEAD = " a"


# --- sparse matrices -----------------------------------------------------------------


@dataclass
class Csr:
    """Compressed rows: the columns of row i are columns[starts[i] : starts[i + 1]]."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int


def incidence(first: np.ndarray, size: np.ndarray, width: int) -> Csr:
    """Row i has a one in each of the ``size[i]`` columns from ``first[i]``."""
    starts = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    within = np.arange(starts[-1]) - np.repeat(starts[:-1], size)
    return Csr(starts, np.repeat(first, size) + within, np.ones(starts[-1], np.int64), width)


def transposed(m: Csr) -> Csr:
    rows = np.repeat(np.arange(len(m.starts) - 1), np.diff(m.starts))
    order = np.argsort(m.columns, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(m.columns, minlength=m.width))])
    return Csr(starts.astype(np.int64), rows[order], m.values[order], len(m.starts) - 1)


def product(a: Csr, b: Csr) -> Csr:
    """a·b by rows (Gustavson): each row of ``a`` adds up the rows of ``b`` that it names."""
    sizes = np.diff(b.starts)[a.columns]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    taken = np.arange(total) - np.repeat(ends - sizes, sizes) + np.repeat(b.starts[a.columns], sizes)
    values = np.repeat(a.values, sizes) * b.values[taken]
    rows = np.repeat(np.repeat(np.arange(len(a.starts) - 1), np.diff(a.starts)), sizes)
    place = rows * np.int64(b.width) + b.columns[taken]
    if np.any(place[1:] < place[:-1]):
        order = np.argsort(place, kind="stable")
        place, values = place[order], values[order]
    new = np.concatenate([[True], place[1:] != place[:-1]])[:total]
    at = np.flatnonzero(new)
    place, values = place[at], np.add.reduceat(values, at) if total else values
    starts = np.searchsorted(place, np.arange(len(a.starts)) * np.int64(b.width))
    return Csr(starts, place % max(b.width, 1), values, b.width)


def token_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each token and their number: groups end where tokens of both sides end."""
    cuts = np.intersect1d(ends_a, ends_b)
    return np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), len(cuts)


def linked(kind: str, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of token places (a, b) by kind of link; both sides cover the same bytes."""
    width = int(ends_a[-1]) if len(ends_a) else 0
    if kind == "overlap":
        first_a, first_b = (np.concatenate([[0], e[:-1]]).astype(np.int64) for e in (ends_a, ends_b))
        a, b = incidence(first_a, ends_a - first_a, width), incidence(first_b, ends_b - first_b, width)
    elif kind == "end":
        a, b = (incidence(e - 1, np.ones(len(e), np.int64), width) for e in (ends_a, ends_b))
    else:
        of_a, of_b, count = token_groups(ends_a, ends_b)
        a, b = (incidence(g, np.ones(len(g), np.int64), count) for g in (of_a, of_b))
    found = product(a, transposed(b))
    return np.repeat(np.arange(len(found.starts) - 1), np.diff(found.starts)), found.columns


# --- tokenizers ----------------------------------------------------------------------


def _byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write visible Latin-1 bytes as themselves, the others from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        of = _byte_characters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for p in pieces:
            if "\n" in p or "▁" in p.lstrip("▁"):
                raise ValueError(f"piece {p!r} goes on over the start of a word")
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.sizes_a, self.sizes_b = (
            np.array([len(x) for x in y], np.int64) for y in (self.bytes_a, self.bytes_b)
        )

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text that begins with a blank; None if either side loses bytes."""
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:])
        raw = text.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw:
            return None
        if b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def slab(self, units: list[str]) -> tuple | None:
        """(ids, ends) of A and B over units in a row, their head taken away; None if they don't fit."""
        found = self.encoded(_HEAD + "".join(units))
        if found is None:
            return None
        bounds = len(_HEAD) + np.cumsum([len(u.encode()) for u in units])
        sides = []
        for ids, sizes in zip(found, (self.sizes_a, self.sizes_b), strict=True):
            ends = np.cumsum(sizes[ids])
            if not np.isin(bounds, ends).all() or len(_HEAD) not in ends[:2]:
                return None
            own = ends > len(_HEAD)
            sides += [ids[own], ends[own] - len(_HEAD)]
        return (*sides, bounds - len(_HEAD))


_SEPARATORS = np.array([",", "|", ";", "\n"])


def _group_texts(ids_a, group_a, ids_b, group_b, unit_of_group) -> str:
    """``a1,a2|b1`` for each group, with ``;`` between the groups of a unit and a line for each unit."""
    ids = np.concatenate([ids_a, ids_b])
    place = np.concatenate([2 * group_a, 2 * group_b + 1])
    order = np.argsort(place, kind="stable")
    ids, place = ids[order], place[order]
    group = place >> 1
    unit = unit_of_group[group]
    kind = np.zeros(len(ids), np.int64)
    kind[:-1] = np.where(
        place[1:] == place[:-1],
        0,
        np.where(group[1:] == group[:-1], 1, np.where(unit[1:] == unit[:-1], 2, 3)),
    )
    kind[-1:] = 3
    parts = np.empty(2 * len(ids), object)
    parts[::2], parts[1::2] = list(map(str, ids.tolist())), _SEPARATORS[kind]
    return "".join(parts)


class UnitTable:
    """What each unit of a chunk consists of, unit by unit."""

    def __init__(self, kind: str):
        self.kind = kind
        self.sound: list[np.ndarray] = []
        self.columns: dict[str, list[np.ndarray]] = {
            n: [] for n in ("unit_a", "unit_b", "unit_groups", "link_sizes", "links")
        }
        self.texts: list[str] = []

    def add(self, units: list[str], tokens: Tokenizers) -> None:
        for slab in _slabs(units):
            found = tokens.slab(slab) if not slab[-1][-1].isspace() or len(slab) == 1 else None
            if found is None and len(slab) > 1:
                for unit in slab:
                    self._add([unit], tokens.slab([unit]))
            else:
                self._add(slab, found)

    def _add(self, units: list[str], found: tuple | None) -> None:
        self.sound.append(np.full(len(units), found is not None))
        if found is None:
            for name in ("unit_a", "unit_b", "unit_groups", "link_sizes"):
                self.columns[name].append(np.zeros(len(units), np.int64))
            self.texts.append("\n" * len(units))
            return
        ids_a, ends_a, ids_b, ends_b, bounds = found
        group_a, group_b, groups = token_groups(ends_a, ends_b)
        cuts = np.intersect1d(ends_a, ends_b)
        unit_of_group = np.searchsorted(bounds, cuts)
        at_a, at_b = linked(self.kind, ends_a, ends_b)
        counted = {
            "unit_a": np.searchsorted(bounds, ends_a),
            "unit_b": np.searchsorted(bounds, ends_b),
            "unit_groups": unit_of_group,
            "link_sizes": np.searchsorted(bounds, ends_a[at_a]),
        }
        for name, of in counted.items():
            self.columns[name].append(np.bincount(of, minlength=len(units)))
        self.columns["links"].append(ids_a[at_a] << 32 | ids_b[at_b])
        self.texts.append(_group_texts(ids_a, group_a, ids_b, group_b, unit_of_group))

    def arrays(self) -> dict[str, np.ndarray]:
        return {n: np.concatenate(c) if c else np.zeros(0, np.int64) for n, c in self.columns.items()}


def _slabs(units: list[str]) -> Iterator[list[str]]:
    """Units in a row; one that ends in white space is alone, as only the end of a text has it."""
    slab, size = [], 0
    for unit in units:
        if unit[-1].isspace():
            if slab:
                yield slab
                slab, size = [], 0
            yield [unit]
            continue
        slab.append(unit)
        size += len(unit)
        if size >= SLAB_BYTES:
            yield slab
            slab, size = [], 0
    if slab:
        yield slab


class _Numbers(dict):
    """Numbers in order of first use."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def _unit_numbers(text: str | None, numbers: _Numbers) -> np.ndarray:
    if not text:
        return np.zeros(0, np.uint32)
    spaced = " " + text
    units = _UNITS.findall(spaced) if len(text) < LONG_TEXT else (m[0] for m in _UNITS.finditer(spaced))
    return np.fromiter(map(numbers.__getitem__, units), np.uint32)


def _span_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over consecutive spans of ``values``; empty spans give zero."""
    sums = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


# --- the jobs ------------------------------------------------------------------------

_TABLE = (
    "chunk bigint, sizes binary, units binary, unit_a binary, unit_b binary, unit_groups binary, "
    "link_sizes binary, links binary, texts binary, pairs array<bigint>, counts array<bigint>"
)


def _reader(schema: StructType, a_path: str, b_path: str, kind: str, chunk_bytes: int):
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in text_chunks(batches, "words", chunk_bytes):
            tokens = held(("alignment", a_path, b_path), lambda: Tokenizers(a_path, b_path))
            numbers = _Numbers()
            texts = rows.column("words").combine_chunks()
            lists = [_unit_numbers(t.as_py(), numbers) for t in texts]
            units = list(numbers)
            # In another order than the chunk's, as units that end in white space go alone.
            table = UnitTable(kind)
            order = sorted(range(len(units)), key=lambda i: units[i][-1].isspace())
            table.add([units[i] for i in order], tokens)
            place = np.empty(len(units), np.int64)
            place[order] = np.arange(len(units))
            sound = np.concatenate(table.sound) if table.sound else np.zeros(0, bool)
            lists = [place[x] for x in lists]
            lists = [x if sound[x].all() else x[:0] for x in lists]
            sizes = np.array([len(x) for x in lists], np.int64)
            flat = np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)
            columns = table.arrays()
            pairs, links = np.unique(columns["links"], return_inverse=True)
            used = np.bincount(flat, minlength=len(units))
            counts = np.bincount(links, np.repeat(used, columns["link_sizes"]), len(pairs))
            columns["links"] = links
            values = {
                "chunk": number,
                "sizes": packed(sizes),
                "units": packed(flat),
                **{n: packed(c) for n, c in columns.items()},
                "texts": zstandard.ZstdCompressor(level=1).compress("".join(table.texts).encode()),
                "pairs": pairs,
                "counts": counts.astype(np.int64),
            }
            arrays = [
                own_list(rows, f.type) if f.name == "own" else pa.array([values[f.name]], f.type)
                for f in arrow
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return read


def _finisher(schema: StructType):
    arrow = to_arrow_schema(schema)
    packs = ("sizes", "units", "unit_a", "unit_b", "unit_groups", "link_sizes", "links")

    def finish(chunk: pa.Table) -> pa.Table:
        row = {n: chunk.column(n)[0] for n in chunk.column_names}
        got = {n: unpacked(row[n].as_py()) for n in packs}
        n_of, best_of = (row[n].values.to_numpy() for n in ("n", "best"))
        sizes, units, links = got["sizes"], got["units"], got["links"]
        of_unit = (
            got["unit_a"],
            got["unit_b"],
            got["unit_groups"],
            got["link_sizes"],
            _span_sums(best_of[links], got["link_sizes"]),
            _span_sums(n_of[links], got["link_sizes"]),
        )
        sums = [pa.array(_span_sums(x[units], sizes), pa.int64()) for x in of_unit]
        text = zstandard.ZstdDecompressor().decompress(row["texts"].as_py()).decode()
        lines = text.split("\n")
        ends = np.cumsum(sizes).tolist()
        groups = pa.array(
            (
                ";".join(map(lines.__getitem__, units[e - n : e].tolist()))
                for e, n in zip(ends, sizes.tolist(), strict=True)
            ),
            pa.string(),
        )
        return pa.Table.from_arrays([*row["own"].values.flatten(), *sums, groups], schema=arrow)

    return finish


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    *,
    text_col: str = "text",
    links: str = "end",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``docs`` without the text, with the alignment of the tokens of a blank and the text.

    ``a_path`` is a byte-level BPE, ``b_path`` a sentencepiece model with byte fallback; strings of
    special tokens are plain text. ``groups`` lists the ids of each group, cut where tokens of both
    sides end (``a1,a2|b1;a3|b2,b3``). ``links`` says which token pairs are linked: those that
    overlap, share a group, or end together. ``count_sum`` adds up how often the id pair of each
    link is linked in all documents; ``n_best`` counts the links whose pair no other pair of the
    same B id exceeds. A null or empty text, and one whose bytes either side cannot give back, has
    no tokens: zeros and an empty ``groups``, and it counts for no pair. Equal rows count each.
    Columns named like the added ones, in any case, are replaced; an empty table stays empty.
    """
    if links not in LINKS:
        raise ValueError(f"links: one of {LINKS}")
    reach_workers(docs.sparkSession)
    kept = without(docs, [text_col, *ADDED])
    read, fields = with_own(docs, kept, text_col)
    schema = StructType.fromDDL(_TABLE).add("own", own_type(fields))
    table = stored(
        read.mapInArrow(_reader(schema, a_path, b_path, links, chunk_bytes), schema), "alignment"
    )
    asked = table.select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "own"))
    asked = asked.select("chunk", "at", F.col("own.pairs").alias("pair"), "own.counts")
    totals = stored(asked.groupBy("pair").agg(F.sum("counts").alias("n")), "alignment-pairs")
    b_id = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b_id")
    most = totals.groupBy(b_id).agg(F.max("n").alias("most"))
    judged = totals.select("*", b_id).join(most, "b_id").select(
        "pair", "n", (F.col("n") == F.col("most")).cast("bigint").alias("best")
    )
    answers = (
        asked.join(judged, "pair")
        .groupBy("chunk")
        .agg(F.array_sort(F.collect_list(F.struct("at", "n", "best"))).alias("answer"))
        .select("chunk", F.col("answer.n").alias("n"), F.col("answer.best").alias("best"))
    )
    nothing = F.array().cast("array<bigint>")
    joined = table.drop("pairs", "counts").join(answers, "chunk", "left").select(
        *[c for c in table.columns if c not in ("pairs", "counts")],
        F.coalesce("n", nothing).alias("n"),
        F.coalesce("best", nothing).alias("best"),
    )
    types = ", ".join(f"{c} bigint" for c in ADDED[:-1])
    out = StructType([*fields, *StructType.fromDDL(f"{types}, groups string")])
    done = joined.groupBy("chunk").applyInArrow(_finisher(out), out)
    return done.select(
        *[F.col(f"own_{i}").alias(c) for i, c in enumerate(kept.columns)], *ADDED
    )
