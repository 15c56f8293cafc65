"""Language ID by interpolated Kneser-Ney models of characters, one for each language.

Words are runs of letters without digits beside them, lower-cased and padded with start and end
marks; a model predicts each letter and the end mark from up to three characters before it. N-grams of all languages lie
in sorted hash arrays, one for each order, beside a matrix with a column for each language, so
one binary search serves all models. The language with the lowest cross-entropy per character
wins; a text whose cross-entropy is far from what its language's words have is rejected.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .rows import append_columns, draw_of, held, runs_of, training_sample

ORDER = 4
#: Bounds of the training sample, for each language.
TRAINING_DOCUMENTS = 1500
TRAINING_CHARACTERS = 2_000_000
#: A text is rejected beyond so many standard deviations of a word's cross-entropy.
REJECT_DEVIATIONS = 5.0
CACHED_WORDS = 500_000
WORDS_AT_ONCE = 4096
UNKNOWN = "und"

_START, _END = 2, 3
# Letters beside digits are codes and keys, not words; they count only where nothing else is.
_WORD = r"(?<![\p{L}\p{N}])\p{L}+(?![\p{L}\p{N}])"
_WORDS, _LETTERS = regex.compile(_WORD), regex.compile(r"\p{L}+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """``grams[k]``/``alphas[k]``: hashes of (k+1)-grams and their discounted probabilities;
    ``contexts[k]``/``gammas[k]``: hashes of contexts of k characters and their back-off mass."""

    languages: list[str]
    grams: list[np.ndarray] = field(default_factory=list)
    alphas: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    gammas: list[np.ndarray] = field(default_factory=list)
    base: np.ndarray | None = None
    limits: np.ndarray | None = None
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded words as one array of code points; the predicted positions; the word of each."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + ORDER) - lengths - 1
    codes = np.full(int((lengths + ORDER).sum()), _START, np.uint64)
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    word = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    codes[starts[word] + place] = letters
    codes[starts + lengths] = _END
    word = np.repeat(np.arange(len(words)), lengths + 1)
    place = np.arange(len(word)) - np.repeat(np.cumsum(lengths + 1) - lengths - 1, lengths + 1)
    return codes, starts[word] + place, word


def _hashes(codes: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Hashes of the grams of 1 to ORDER characters that end at the positions ``at``."""
    out, value = [], np.zeros(len(at), np.uint64)
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(ORDER):
            power = power * _MIX
            value = value + (codes[at - k] + np.uint64(1)) * power
            mixed = value ^ (value >> np.uint64(29))
            out.append(mixed * np.uint64(0xBF58476D1CE4E5B9))
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def _kneser_ney(words: list[str], counts: np.ndarray) -> list[tuple]:
    """For each order (grams, alphas, contexts, gammas)."""
    codes, at, word = _codes(words)
    grams, contexts = _hashes(codes, at), _hashes(codes, at - 1)
    weight = counts[word].astype(np.float64)
    tables = []
    for k in range(1, ORDER + 1):
        keys, first, inverse = np.unique(grams[k - 1], return_index=True, return_inverse=True)
        seen = np.bincount(inverse, weight)
        if k < ORDER:
            # Lower orders count the different characters before a gram; none comes before
            # a gram that begins with the start mark, so that one keeps its count.
            _, longer = np.unique(grams[k], return_index=True)
            before = np.bincount(inverse[longer], minlength=len(keys)).astype(np.float64)
            seen = np.where(codes[at[first] - k + 1] == _START, seen, before)
        n1, n2 = (seen == 1).sum(), (seen == 2).sum()
        discount = n1 / (n1 + 2 * n2) if n1 else 0.5
        own = contexts[k - 2][first] if k > 1 else np.zeros(len(keys), np.uint64)
        heads, group = np.unique(own, return_inverse=True)
        total, types = np.bincount(group, seen), np.bincount(group)
        alphas = np.maximum(seen - discount, 0) / total[group]
        tables.append((keys, alphas, heads, discount * types / total))
    return tables


def _merged(tables: list[tuple[np.ndarray, np.ndarray]], default: float):
    """Tables of all languages as one sorted array of hashes and a matrix."""
    keys = np.unique(np.concatenate([k for k, _ in tables]))
    values = np.full((len(keys), len(tables)), default)
    for column, (own, numbers) in enumerate(tables):
        values[np.searchsorted(keys, own), column] = numbers
    return keys, values


def log2_words(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """log2 probability of each word under each language; predicted characters of each."""
    codes, at, word = _codes(words)
    grams, contexts = _hashes(codes, at), _hashes(codes, at - 1)
    p = np.broadcast_to(model.base, (len(at), len(model.languages)))
    for k in range(ORDER):
        row, known = _find(model.grams[k], grams[k])
        alpha = np.where(known[:, None], model.alphas[k][row], 0.0)
        if k:
            row, known = _find(model.contexts[k], contexts[k - 1])
            gamma = np.where(known[:, None], model.gammas[k][row], 1.0)
        else:
            gamma = model.gammas[0]
        p = alpha + gamma * p
    logs = np.log2(p)
    sums = np.stack(
        [np.bincount(word, logs[:, c], len(words)) for c in range(logs.shape[1])], axis=1
    )
    return sums, np.bincount(word, minlength=len(words))


def train(
    docs: DataFrame, *, id_col: str, text_col: str = "text", lang_col: str = "lang"
) -> Model:
    """Fit on at most TRAINING_DOCUMENTS and TRAINING_CHARACTERS of each non-null language.

    Of the sample, drawn by hash, one document in five sets the limit for rejection. Without
    any labelled word the model knows no language and every text is ``und``.
    """
    texts = docs.filter(F.col(lang_col).isNotNull() & (F.octet_length(text_col) > 0))
    sample = training_sample(
        texts,
        texts.select(
            draw_of(id_col, text_col).alias("draw"),
            F.col(lang_col).alias("label"),
            F.length(text_col).alias("size"),
        ),
        id_col=id_col,
        text_col=text_col,
        documents=TRAINING_DOCUMENTS,
        characters=TRAINING_CHARACTERS,
    )
    words = F.explode(F.regexp_extract_all(F.lower("words"), F.lit(f"({_WORD})")))
    counted = (
        sample.select(
            F.col("label").alias("lang"),
            (F.col("n") % 5 == 0).alias("calibrates"),
            words.alias("word"),
        )
        .groupBy("lang", "word")
        .agg(
            F.count_if(~F.col("calibrates")).alias("fit"),
            F.count_if("calibrates").alias("check"),
        )
        .toPandas()
        .sort_values(["lang", "word"])
    )
    groups = [(lang, g) for lang, g in counted.groupby("lang") if g["fit"].sum()]
    model = Model([lang for lang, _ in groups])
    if not groups:
        return model
    fitted = []
    for _, g in groups:
        own = g[g["fit"] > 0]
        fitted.append(_kneser_ney(own["word"].tolist(), own["fit"].to_numpy()))
    for k in range(ORDER):
        grams, alphas = _merged([t[k][:2] for t in fitted], 0.0)
        contexts, gammas = _merged([t[k][2:] for t in fitted], 1.0)
        model.grams.append(grams)
        model.alphas.append(alphas)
        model.contexts.append(contexts)
        model.gammas.append(gammas)
    # One law for all languages below the unigrams: any known character, or an unknown one.
    model.base = np.full(len(groups), 1 / (len(model.grams[0]) + 1))
    limits = []
    for column, (_, g) in enumerate(groups):
        own = g[g["check"] > 0] if g["check"].sum() else g
        weight = own["check"].to_numpy() if g["check"].sum() else own["fit"].to_numpy()
        sums, n = log2_words(model, own["word"].tolist())
        entropy = -sums[:, column] / n
        mean = np.average(entropy, weights=weight)
        spread = np.sqrt(np.average((entropy - mean) ** 2, weights=weight))
        limits.append(mean + REJECT_DEVIATIONS * spread)
    model.limits = np.array(limits)
    return model


class _Scorer:
    """Sums for a text from its parts between white space.

    Parts are remembered, up to a bound, those not used for long forgotten first: ``known`` are
    those used of late, ``older`` those last used before them; each has half the bound.
    """

    def __init__(self, model: Model, cached_words: int = CACHED_WORDS):
        self.model, self.most = model, cached_words
        self.known: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        """What is known becomes what was used before; what was that is gone."""
        self.older = self.known
        self.older_sums = self.sums[: len(self.known)].copy() if self.known else None
        self.known = {}
        self.sums = np.zeros((1024, len(self.model.languages) + 1))

    def added(self, parts: list[str]) -> np.ndarray:
        """A row of zeros for each part, known from now on."""
        base = len(self.known)
        while base + len(parts) > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        self.known.update(zip(parts, range(base, base + len(parts)), strict=True))
        new = self.sums[base : base + len(parts)]
        new[:] = 0
        return new

    def recall(self, parts: list[str]) -> None:
        """Sums of parts that were used before."""
        rows = np.fromiter(map(self.older.__getitem__, parts), np.int64, len(parts))
        self.added(parts)[:] = self.older_sums[rows]

    def learn(self, parts: list[str]) -> None:
        """Sums of new parts; a word that several parts hold is scored once."""
        words, row, owner = {}, [], []
        for i, part in enumerate(parts):
            for word in _WORDS.findall(part.lower()):
                row.append(words.setdefault(word, len(words)))
                owner.append(i)
        new = self.added(parts)
        if words:
            new_words = list(words)
            scored = [
                np.column_stack(log2_words(self.model, new_words[at : at + WORDS_AT_ONCE]))
                for at in range(0, len(new_words), WORDS_AT_ONCE)
            ]
            both = np.concatenate(scored)[row]
            for column in range(both.shape[1]):
                new[:, column] = np.bincount(owner, both[:, column], len(parts))

    def totals(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text log2 probability under each language, then the predicted characters."""
        out = []
        for run in runs_of(texts, 2 * self.most):
            split = [t.split() if t else [] for t in run]
            new = set().union(*split).difference(self.known)
            if len(self.known) + len(new) > self.most // 2:
                self.forget()
                new = set().union(*split)
            if before := list(new.intersection(self.older)):
                self.recall(before)
            if new := list(new.difference(self.older)):
                self.learn(new)
            known = self.known.__getitem__
            for text, parts in zip(run, split, strict=True):
                found = self.sums[np.fromiter(map(known, parts), np.int64, len(parts))].sum(axis=0)
                if not found[-1] and text and (words := _LETTERS.findall(text.lower())):
                    logs, n = log2_words(self.model, words)
                    found = np.append(logs.sum(axis=0), n.sum())
                out.append(found)
        return out


def identify(
    docs: DataFrame,
    model: Model,
    *,
    text_col: str = "text",
    keep_text: bool = True,
    cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """``docs`` with lang_pred, score, cross_entropy (bits a character) and rejected.

    ``und`` with score 0, rejected: a null text or one without a letter. Else the language of
    lowest cross-entropy, ties to the first name, and its posterior with equal priors as score.
    Rows are judged one by one; columns of ``docs`` with the added names are replaced. A Python
    worker remembers about ``cached_words`` parts of texts: fewer take less memory and more time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        scorer = held(
            ("language", model.name, cached_words), lambda: _Scorer(model, cached_words)
        )

        def one(totals: np.ndarray) -> tuple:
            n = totals[-1]
            if not n or not model.languages:
                return UNKNOWN, 0.0, None, True
            best = int(np.argmax(totals[:-1]))
            score = 1 / np.exp2(np.maximum(totals[:-1] - totals[best], -1000)).sum()
            entropy = -totals[best] / n
            return model.languages[best], score, entropy, bool(entropy > model.limits[best])

        def work(batch: pa.RecordBatch) -> list:
            texts = batch.column(text_col).to_pylist()
            rows = list(map(one, scorer.totals(texts) if model.languages else [np.zeros(1)] * len(texts)))
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], [], []]

        return work

    return append_columns(
        docs,
        "lang_pred string, score double, cross_entropy double, rejected boolean",
        make,
        drop=() if keep_text else (text_col,),
    )
