"""Language-model scores by deleted interpolation of bigrams, unigrams and a uniform law.

Documents are read in chunks. A chunk asks for the corpus counts of its own words and bigrams:
its distinct 64-bit keys and training counts go to key buckets as packed arrays, the buckets add
them up and answer in the order of the question. The answers are stored beside the chunk's word
numbers. From this table come the statistics for the mixture weights, each training token deleted
from its own counts; expectation-maximisation finds weights for each frequency class of contexts;
a last pass over the table scores the texts. Nothing is sampled, and only tables of bounded size
(classes, sums) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from .rows import ROWS_AT_ONCE, reach_workers, shuffle_partitions, stored, without

CHUNK_BYTES = 4 << 20
CLASSES = 24  # by log2 of the context's count
STEPS = 200
END, START = 0, 1
# No word holds a blank, so these are no word's key.
_MARKS = [xxhash.xxh64_intdigest(b" end"), xxhash.xxh64_intdigest(b" start")]
_UNIGRAM, _BIGRAM = 0, 1


def packed(numbers: np.ndarray) -> bytes:
    """Small whole numbers, byte by byte of equal weight, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as compressed steps; the upper bytes of a step are mostly zero."""
    planes = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


class Chunk:
    """Texts as numbers of words; words are numbered by key, after the two marks.

    ``tokens`` holds all texts in turn, each closed by END; ``sizes`` the tokens of each.
    """

    def __init__(self, texts: list[str | None], train: np.ndarray):
        numbers: dict[bytes, int] = {}
        lists = []
        for text in texts:
            words = text.encode().lower().split() if text else []
            lists.append([numbers.setdefault(w, len(numbers) + 2) for w in words])
        keys = np.array([*_MARKS, *map(xxhash.xxh64_intdigest, numbers)], np.uint64)
        order = np.argsort(keys[2:], kind="stable")
        rank = np.concatenate([[0, 1], np.empty(len(order), np.int64)]).astype(np.int64)
        rank[order + 2] = np.arange(len(order)) + 2
        self.keys = np.concatenate([keys[:2], keys[2:][order]])
        self.sizes = np.fromiter(map(len, lists), np.int64, len(lists)) + 1
        self.tokens = np.zeros(int(self.sizes.sum()), np.int64)
        inner = np.ones(len(self.tokens), bool)
        inner[np.cumsum(self.sizes) - 1] = False
        flat = np.fromiter((n for x in lists for n in x), np.int64, int(inner.sum()))
        self.tokens[inner] = rank[flat]
        self.train = np.repeat(train, self.sizes)


def previous(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    if len(sizes):
        before[np.cumsum(sizes) - sizes] = START
    return before


def bigrams(tokens, sizes, keys) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of bigrams in order, and which of them each token ends."""
    codes = previous(tokens, sizes) * np.int64(len(keys)) + tokens
    found, inverse = np.unique(codes, return_inverse=True)
    first, second = keys[found // len(keys)], keys[found % len(keys)]
    with np.errstate(over="ignore"):
        mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (first >> np.uint64(31))
        mixed = (mixed + second) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x165667B19E3779F9)
    order = np.argsort(mixed, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return mixed[order], rank[inverse]


def bucket_ends(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted keys, and the end; buckets are equal ranges of keys."""
    number = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(number, np.arange(buckets + 1, dtype=np.uint64))


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int):
    """(number, rows) with about ``chunk_bytes`` of text; equal input gives equal chunks."""
    number = TaskContext.get().partitionId() << 24
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            held.append(part)
            size += part.column("words").nbytes
            if size >= chunk_bytes:
                yield number, pa.Table.from_batches(held).combine_chunks()
                number, held, size = number + 1, [], 0
    if held:
        yield number, pa.Table.from_batches(held).combine_chunks()


def _read(rows: pa.Table) -> Chunk:
    return Chunk(rows.column("words").to_pylist(), np.array(rows.column("train").to_pylist(), bool))


_ASK = "kind int, bucket int, chunk bigint, keys binary, counts binary"


def _asker(buckets: int, chunk_bytes: int):
    schema = to_arrow_schema(StructType.fromDDL(_ASK))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _chunks(batches, chunk_bytes):
            chunk = _read(rows)
            pairs, which = bigrams(chunk.tokens, chunk.sizes, chunk.keys)
            order = np.argsort(chunk.keys, kind="stable")
            sides = (
                (_UNIGRAM, chunk.keys[order], np.bincount(chunk.tokens, chunk.train, len(order))[order]),
                (_BIGRAM, pairs, np.bincount(which, chunk.train, len(pairs))),
            )
            out = [
                (kind, b, number, packed_keys(keys[i:j]), packed(counts[i:j]))
                for kind, keys, counts in sides
                for ends in [bucket_ends(keys, buckets).tolist()]
                for b, (i, j) in enumerate(zip(ends, ends[1:], strict=False))
                if i < j
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)],
                schema=schema,
            )

    return ask


_ANSWER = "kind int, bucket int, chunk bigint, counts binary, check bigint, new_words bigint"


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of one bucket, for each chunk in the order it asked."""
    asked = [unpacked_keys(k) for k in rows["keys"]]
    counts = np.concatenate([unpacked(c) for c in rows["counts"]])
    known, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.bincount(inverse, counts, len(known)).astype(np.int64)
    ends = np.cumsum([len(k) for k in asked])
    answers = [packed(totals[inverse[e - len(k) : e]]) for k, e in zip(asked, ends, strict=True)]
    checks = [int(np.bitwise_xor.reduce(k).view(np.int64)) for k in asked]
    # The bucket's number of words with a training count travels with its first answer.
    new_words = np.zeros(len(rows), np.int64)
    new_words[0] = (totals > 0).sum() if rows["kind"].iloc[0] == _UNIGRAM else 0
    return rows[["kind", "bucket", "chunk"]].assign(
        counts=answers, check=checks, new_words=new_words
    )


def _keeper(schema: StructType, chunk_bytes: int):
    arrow = to_arrow_schema(schema)
    own_names = [f.name for f in schema["own"].dataType.elementType]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _chunks(batches, chunk_bytes):
            chunk = _read(rows)
            fields = [rows.column(n).combine_chunks() for n in own_names]
            own = pa.StructArray.from_arrays(
                [f.cast(t.type) for f, t in zip(fields, arrow.field("own").type.value_type, strict=True)],
                fields=list(arrow.field("own").type.value_type),
            )
            listed = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
            values = {
                "chunk": pa.array([number]),
                "train": pa.array([rows.column("train").to_pylist()]),
                "sizes": pa.array([packed(chunk.sizes)]),
                "tokens": pa.array([packed(chunk.tokens)]),
                "keys": pa.array([chunk.keys.tobytes()]),
                "own": listed,
            }
            yield pa.RecordBatch.from_arrays([values[f.name] for f in arrow], schema=arrow)

    return keep


def _join(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """Counts for each word of a chunk, and for the bigram that each of its tokens ends."""
    row = chunk.iloc[0]
    tokens, sizes = unpacked(row["tokens"]), unpacked(row["sizes"])
    keys = np.frombuffer(row["keys"], np.uint64)
    pairs, which = bigrams(tokens, sizes, keys)
    order = np.argsort(keys, kind="stable")
    found = []
    for kind, asked in ((_UNIGRAM, keys[order]), (_BIGRAM, pairs)):
        own = answers[answers["kind"] == kind].sort_values("bucket")
        counts = np.concatenate([unpacked(c) for c in own["counts"]])
        check = np.bitwise_xor.reduce(own["check"].to_numpy())
        if len(counts) != len(asked) or check != np.bitwise_xor.reduce(asked).view(np.int64):
            raise RuntimeError("the documents were not read alike twice; store them first")
        found.append(counts)
    words = np.empty(len(keys), np.int64)
    words[order] = found[0]
    # START is a context as often as there are training texts, which END counts.
    words[START] = words[END]
    out = chunk.drop(columns=["keys"])
    out["words"], out["pairs"] = [packed(words)], [packed(found[1][which])]
    out["new_words"] = int(answers["new_words"].sum())
    train = np.repeat(np.array(row["train"], bool), sizes)
    out["train_tokens"] = int(train.sum())
    return out


def counted(docs: DataFrame, *, text_col: str, train_col: str, chunk_bytes: int) -> DataFrame:
    """A stored table with one row for each chunk: its tokens and their corpus counts."""
    spark = docs.sparkSession
    reach_workers(spark)
    own = without(docs, [text_col])
    read = docs.select(
        *[F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(own.columns)],
        F.col(text_col).alias("words"),
        F.coalesce(train_col, F.lit(False)).alias("train"),
    )
    fields = StructType(read.schema.fields[: len(own.columns)])
    kept = StructType.fromDDL(
        "chunk bigint, train array<boolean>, sizes binary, tokens binary, keys binary"
    ).add("own", ArrayType(fields))
    buckets = shuffle_partitions(spark)
    answers = (
        read.select("words", "train")
        .mapInArrow(_asker(buckets, chunk_bytes), _ASK)
        .groupBy("kind", "bucket")
        .applyInPandas(_answer, _ANSWER)
    )
    found = StructType.fromDDL("words binary, pairs binary, new_words bigint, train_tokens bigint")
    joined = StructType([*(f for f in kept if f.name != "keys"), *found])
    chunks = read.mapInArrow(_keeper(kept, chunk_bytes), kept)
    return stored(
        chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_join, joined),
        "counted",
    )


def classes(context: np.ndarray) -> np.ndarray:
    """Frequency class of a context: 0 if never seen, else by the bits of its count."""
    bits = np.frexp(np.maximum(context, 0).astype(np.float64))[1]
    return np.minimum(bits, CLASSES - 1)


def _counts(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each token: bigram, context and word counts; and the sizes of the texts."""
    tokens, sizes = unpacked(row["tokens"]), unpacked(row["sizes"])
    words = unpacked(row["words"])
    return unpacked(row["pairs"]), words[previous(tokens, sizes)], words[tokens], sizes


_CELL = "class int, pair_bin int, word_bin int, n bigint, pair_sum double, word_sum double"


def _deleted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Training tokens of a chunk by class, bigram estimate and word count, without themselves."""
    for frame in batches:
        for row in frame.to_dict("records"):
            pair, context, word, sizes = _counts(row)
            train = np.repeat(np.array(row["train"], bool), sizes)
            pair, context, word = (x[train] - 1 for x in (pair, context, word))
            estimate = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
            bins = np.where(estimate > 0, 160 + np.floor(4 * np.log2(np.maximum(estimate, 1e-12))), 0)
            word_bins = np.where(word > 0, 1 + np.floor(2 * np.log2(np.maximum(word, 1))), 0)
            cell = (classes(context) * 256 + bins.astype(np.int64)) * 256 + word_bins.astype(np.int64)
            cells, inverse = np.unique(cell, return_inverse=True)
            yield pd.DataFrame(
                {
                    "class": cells >> 16,
                    "pair_bin": cells >> 8 & 255,
                    "word_bin": cells & 255,
                    "n": np.bincount(inverse, minlength=len(cells)),
                    "pair_sum": np.bincount(inverse, estimate, len(cells)),
                    "word_sum": np.bincount(inverse, word, len(cells)),
                }
            ).astype({"class": "int32", "pair_bin": "int32", "word_bin": "int32"})


def weights(cells: pd.DataFrame, tokens: int, vocabulary: int) -> np.ndarray:
    """(CLASSES, 3): weights of bigram, unigram and uniform law, by expectation-maximisation.

    Half a count for each law keeps every weight above zero. An unseen context has no bigrams.
    """
    out = np.full((CLASSES, 3), 1 / 3)
    for number in range(CLASSES):
        own = cells[cells["class"] == number]
        n = own["n"].to_numpy(dtype=float)
        laws = np.column_stack(
            [
                own["pair_sum"] / np.maximum(n, 1),
                own["word_sum"] / np.maximum(n, 1) / max(1, tokens - 1),
                np.full(len(own), 1 / (vocabulary + 1)),
            ]
        )
        for _ in range(STEPS if len(own) else 0):
            parts = laws * out[number]
            shares = parts / parts.sum(axis=1, keepdims=True)
            expected = n @ shares + 0.5
            out[number] = expected / expected.sum()
    out[0, 0] = 0
    out[0] /= out[0].sum()
    return out


def score(
    docs: DataFrame,
    *,
    train_col: str,
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``docs`` without the text, with n_tokens, n_known, train_tokens, base_score and score.

    Words are lower-cased (A-Z) runs without ASCII white space; an end mark closes each text and
    counts as a token. Rows whose ``train_col`` is true are counted. ``base_score`` is the
    add-one unigram model, ``score`` the interpolated model, both log10. A null or empty text is
    its end mark. Without training rows only the uniform law is left. ``docs`` is read twice and
    must come from stored tables. Columns with the added names are replaced.
    """
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    own = without(docs, added)
    table = counted(own, text_col=text_col, train_col=train_col, chunk_bytes=chunk_bytes)
    tokens, vocabulary = table.agg(F.sum("train_tokens"), F.sum("new_words")).first()
    tokens, vocabulary = tokens or 0, vocabulary or 0
    needed = ["train", "sizes", "tokens", "words", "pairs"]
    cells = (
        table.select(*needed)
        .mapInPandas(_deleted, _CELL)
        .groupBy("class", "pair_bin", "word_bin")
        .agg(*[F.sum(c).alias(c) for c in ("n", "pair_sum", "word_sum")])
        .toPandas()
    )
    mix = weights(cells, tokens, vocabulary)
    uniform, of_all = 1 / (vocabulary + 1), max(1, tokens)

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for row in frame.to_dict("records"):
                pair, context, word, sizes = _counts(row)
                weight = mix[classes(context)]
                p = (
                    weight[:, 0] * pair / np.maximum(context, 1)
                    + weight[:, 1] * word / of_all
                    + weight[:, 2] * uniform
                )
                starts = np.cumsum(sizes) - sizes
                base = np.log10((word + 1) / (tokens + vocabulary + 1))
                out.append(
                    {
                        "n_tokens": sizes,
                        "n_known": np.add.reduceat((word > 0).astype(np.int64), starts),
                        "base_score": np.add.reduceat(base, starts),
                        "score": np.add.reduceat(np.log10(p), starts),
                        "own": row["own"],
                    }
                )
            yield pd.DataFrame(out)

    own_type = table.schema["own"].dataType.simpleString()
    rated = table.select("own", *needed).mapInPandas(
        rate,
        "n_tokens array<bigint>, n_known array<bigint>, base_score array<double>, "
        f"score array<double>, own {own_type}",
    )
    zipped = rated.select(
        F.inline(F.arrays_zip("own", "n_tokens", "n_known", "base_score", "score"))
    )
    names = [c for c in own.columns if c != text_col]
    return zipped.select(
        *[F.col(f"own.own_{i}").alias(c) for i, c in enumerate(names)],
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
