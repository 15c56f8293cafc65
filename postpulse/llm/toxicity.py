"""Toxic spans by a linear-chain conditional random field.

A token is a run without white space; its features are its word, beginnings and endings. The
chain has two labels. Token labels come from document labels: words that meet in many different
neighbourhoods of toxic documents and hardly in clean ones are toxic there. Forward-backward
gives each token's marginal; the marginals make spans and, by a logistic fit, document scores.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .rows import append_columns, draw_of, held, training_sample

#: Bounds of the training sample, for each label.
TRAINING_DOCUMENTS = 2500
TRAINING_CHARACTERS = 4_000_000
#: So many clean texts are searched for mistakes, and so many mistaken ones are learned from.
MINED_DOCUMENTS = 20_000
MINED_CHARACTERS = 60_000_000
MINED_KEPT = 500
#: A stem is a toxic seed if chance has less than exp(-SEED_EVIDENCE) and this share is clean.
SEED_EVIDENCE = 9.0
SEED_CLEAN_SHARE = 0.02
BUCKETS = 1 << 18
STEPS = 60
PIECE = 64
#: Documents are read in windows with so many tokens of context on both sides.
WINDOW, CONTEXT = 256, 32
CACHED_TOKENS = 400_000

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_TOKEN = re.compile(r"\S+")


def stems_of(word: str) -> list[str]:
    """A word of letters and its beginnings of three to eight characters."""
    return [word, *(word[:n] + "-" for n in range(3, 9) if len(word) > n)] if word.isalpha() else []


@dataclass
class Model:
    weights: np.ndarray  # of hashed features, for label 1
    transitions: np.ndarray  # log potentials, from label to label
    start: float = 0.0  # log potential of label 1 at the start
    bias: float = 0.0
    document: np.ndarray = field(default_factory=lambda: np.array([-4.0, 0.0, 0.0, 0.0, 0.0]))
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def token_features(token: str) -> list[int]:
    word = _EDGES.sub("", token.lower()) or token
    found = [f"w{word}"]
    found += [f"p{word[:n]}" for n in range(2, 9) if len(word) > n]
    found += [f"s{word[-n:]}" for n in range(3, 5) if len(word) > n]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % BUCKETS for f in found]


def _ratios(model: Model, emit: np.ndarray, inside: np.ndarray):
    """exp(emissions), forward and backward ratios of label 1 to label 0 in each window."""
    (a00, a01), (a10, a11) = np.exp(model.transitions)
    e = np.exp(np.clip(emit, -40, 40))
    forward, backward = np.empty_like(e), np.ones_like(e)
    forward[0] = e[0] * np.exp(model.start)
    for t in range(1, len(e)):
        r = forward[t - 1]
        forward[t] = e[t] * (a01 + a11 * r) / (a00 + a10 * r)
    for t in range(len(e) - 2, -1, -1):
        x = e[t + 1] * backward[t + 1]
        backward[t] = np.where(inside[t + 1], (a10 + a11 * x) / (a00 + a01 * x), 1.0)
    return e, forward, backward


def marginals(model: Model, emit: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Probability of label 1; rows of ``emit`` are places, columns are windows."""
    _, forward, backward = _ratios(model, emit, inside)
    odds = forward * backward
    return odds / (1 + odds)


def _gradient(model: Model, emit: np.ndarray, inside: np.ndarray, gold: np.ndarray):
    """Of the log-likelihood: by emission, by transition, by start."""
    e, forward, backward = _ratios(model, emit, inside)
    odds = forward * backward
    p = odds / (1 + odds)
    by_emission = np.where(inside, gold - p, 0.0)
    both = inside[1:]
    a = np.exp(model.transitions)
    x = e[1:] * backward[1:]
    joint = np.array(
        [[a[0, 0] * np.ones_like(x), a[0, 1] * x], [a[1, 0] * forward[:-1], a[1, 1] * forward[:-1] * x]]
    )
    joint /= joint.sum(axis=(0, 1))
    expected = (joint * both).sum(axis=(2, 3))
    g0, g1 = gold[:-1] > 0.5, gold[1:] > 0.5
    seen = np.array(
        [[(~g0 & ~g1 & both).sum(), (~g0 & g1 & both).sum()],
         [(g0 & ~g1 & both).sum(), (g0 & g1 & both).sum()]]
    )
    return by_emission, seen - expected, by_emission[0].sum()


class _Sample:
    """Token types of the sampled documents, and their pieces as a padded matrix."""

    def __init__(self, texts: list[str], toxic: np.ndarray):
        self.toxic = toxic
        types: dict[str, int] = {}
        self.docs = [
            np.fromiter((types.setdefault(w, len(types)) for w in t.split()), np.int64)
            for t in texts
        ]
        features, sizes = array("q"), array("q")
        for token in types:
            found = token_features(token)
            features.extend(found)
            sizes.append(len(found))
        self.feature = np.array(features)
        self.owner = np.repeat(np.arange(len(types)), np.array(sizes))
        names: dict[str, int] = {}
        words = (_EDGES.sub("", w.lower()) for w in types)
        self.word = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64)
        self.names = list(names)
        lengths = np.array([len(d) for d in self.docs])
        pieces = -(-lengths // PIECE)
        self.piece_doc = np.repeat(np.arange(len(lengths)), pieces)
        self.ids = np.zeros((PIECE, len(self.piece_doc)), np.int64)
        self.inside = np.zeros((PIECE, len(self.piece_doc)), bool)
        column = 0
        for ids in self.docs:
            for at in range(0, len(ids), PIECE):
                part = ids[at : at + PIECE]
                self.ids[: len(part), column] = part
                self.inside[: len(part), column] = True
                column += 1

    def _neighbourhoods(self, label: int) -> np.ndarray:
        """For each word the different pairs of words around it in texts of one label."""
        wide = len(self.names) + 1
        codes = [np.empty(0, np.int64)]
        for d in np.flatnonzero(self.toxic == label):
            w = np.concatenate([[wide - 1], self.word[self.docs[d]], [wide - 1]])
            codes.append(np.unique((w[1:-1] * wide + w[:-2]) * wide + w[2:]))
        found = np.unique(np.concatenate(codes)) // wide // wide
        return np.bincount(found, minlength=len(self.names))

    def seeds(self) -> np.ndarray:
        """Words whose stem meets in many neighbourhoods of toxic texts and hardly in clean ones.

        Stems are the word and its beginnings. A neighbourhood is the word with those before
        and after it, so a copied passage counts once. As many toxic ones by chance must be
        unlikely, given the share of toxic neighbourhoods in the sample.
        """
        clean, toxic = self._neighbourhoods(0), self._neighbourhoods(1)
        share = toxic.sum() / max(1, toxic.sum() + clean.sum())
        hashes, sizes = array("Q"), array("q")
        for name in self.names:
            stems = [xxhash.xxh64_intdigest(s) for s in stems_of(name)]
            hashes.extend(stems)
            sizes.append(len(stems))
        owner = np.repeat(np.arange(len(self.names)), np.array(sizes))
        stems, inverse = np.unique(np.array(hashes), return_inverse=True)
        of_clean = np.bincount(inverse, clean[owner], len(stems))
        of_toxic = np.bincount(inverse, toxic[owner], len(stems))
        telling = (-of_toxic * np.log(share) >= SEED_EVIDENCE) & (
            of_clean <= SEED_CLEAN_SHARE * of_toxic
        )
        return np.bincount(owner, telling[inverse], len(self.names)) > 0

    def emissions(self, model: Model) -> np.ndarray:
        by_type = np.bincount(self.owner, model.weights[self.feature], self.owner[-1] + 1)
        return by_type + model.bias


def _fit(sample: _Sample, gold: np.ndarray, model: Model) -> Model:
    """Full-batch Adam on the penalised likelihood."""
    sizes = [BUCKETS, 4, 1, 1]
    cuts = np.cumsum(sizes)[:-1]
    theta = np.concatenate([model.weights, model.transitions.ravel(), [model.start], [model.bias]])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        weights, transitions, start, bias = np.split(theta, cuts)
        now = Model(weights, transitions.reshape(2, 2), start[0], bias[0])
        emit = sample.emissions(now)[sample.ids]
        by_emission, by_transition, by_start = _gradient(now, emit, sample.inside, gold)
        by_type = np.bincount(sample.ids.ravel(), by_emission.ravel(), len(sample.word))
        by_feature = np.bincount(sample.feature, by_type[sample.owner], BUCKETS)
        gradient = np.concatenate(
            [by_feature - 0.05 * weights, by_transition.ravel(), [by_start], [by_emission.sum()]]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        rate = 0.3 * (1 - 0.5 * step / STEPS)
        theta = theta + rate * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-8
        )
        theta[cuts[0] : cuts[1]] = np.clip(theta[cuts[0] : cuts[1]], -8, 8)
    weights, transitions, start, bias = np.split(theta, cuts)
    return Model(weights, transitions.reshape(2, 2), float(start[0]), float(bias[0]))


def _document_features(p: np.ndarray) -> tuple[float, ...]:
    """Log odds of the two strongest tokens, the evidence in all, and the length."""
    top = np.clip(np.sort(np.concatenate([[1e-6, 1e-6], p]))[-2:], 1e-6, 1 - 1e-6)
    odds = np.log(top / (1 - top))
    return odds[1], odds[0], float(np.log1p((p * p).sum())), float(np.log1p(len(p)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method with a small penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (y - p) - 0.1 * w)
    return w


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Fit on at most TRAINING_DOCUMENTS and TRAINING_CHARACTERS of each label, drawn by hash.

    Rows without text, id or label teach nothing; of several labels the largest holds. Without
    both labels the model scores every text alike, below one half.
    """
    marks = labels.filter(F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")
    ).agg(F.max(F.col(label_col).cast("int")).alias("mark"))
    texts = docs.filter(F.octet_length(text_col) > 0)
    labelled = texts.select(
        F.col(id_col).alias("id"),
        F.length(text_col).alias("size"),
        draw_of(id_col, text_col).alias("draw"),
    ).join(marks, "id")
    labelled = labelled.select("draw", F.col("mark").alias("label"), "size")
    columns = {"id_col": id_col, "text_col": text_col}
    sample = (
        training_sample(
            texts, labelled, documents=TRAINING_DOCUMENTS, characters=TRAINING_CHARACTERS, **columns
        )
        .select("draw", "label", "words")
        .toPandas()
    )
    if sample["label"].nunique() < 2:
        return Model(np.zeros(BUCKETS), np.zeros((2, 2)))
    model = _trained(sample)
    # Clean texts that the first model takes for toxic teach the second one.
    more = training_sample(
        texts,
        labelled.filter("label = 0"),
        documents=MINED_DOCUMENTS,
        characters=MINED_CHARACTERS,
        **columns,
    )
    mistaken = (
        score(more, model, text_col="words")
        .filter("toxicity >= 0.5")
        .orderBy("draw")
        .limit(MINED_KEPT)
        .select("draw", "label", "words")
        .toPandas()
    )
    both = pd.concat([sample, mistaken]).drop_duplicates("draw")
    return _trained(both) if len(both) > len(sample) else model


def _trained(sample: pd.DataFrame) -> Model:
    """Seeds, three fits of the chain, then the document weights."""
    sample = sample.sort_values("draw")
    toxic = (sample["label"].to_numpy() > 0).astype(int)
    known = _Sample([t if t.split() else "." for t in sample["words"]], toxic)
    in_toxic = known.toxic[known.piece_doc] == 1
    gold = (known.seeds()[known.word][known.ids] & known.inside & in_toxic).astype(float)
    model = Model(np.zeros(BUCKETS), np.zeros((2, 2)))
    # What a fit finds in toxic documents counts as labelled in the next one.
    for _ in range(2):
        model = _fit(known, gold, model)
        p = marginals(model, known.emissions(model)[known.ids], known.inside)
        gold = np.maximum(gold, (p >= 0.3) & known.inside & in_toxic)
    model = _fit(known, gold, model)
    emissions = known.emissions(model)
    features = [
        _document_features(p) for p in window_marginals(model, [emissions[d] for d in known.docs])
    ]
    model.document = _logistic(np.array(features), toxic)
    return model


def window_marginals(model: Model, emissions: list[np.ndarray]) -> list[np.ndarray]:
    """Marginals of whole documents, all windows of all documents at a time.

    Windows overlap by CONTEXT tokens on both sides, over which the chain forgets where it began.
    """
    wide = WINDOW + 2 * CONTEXT
    spots = [(d, at) for d, e in enumerate(emissions) for at in range(0, len(e), WINDOW)]
    emit, inside = np.zeros((wide, len(spots))), np.zeros((wide, len(spots)), bool)
    for c, (d, at) in enumerate(spots):
        part = emissions[d][max(0, at - CONTEXT) : at + WINDOW + CONTEXT]
        emit[: len(part), c] = part
        inside[: len(part), c] = True
    p = marginals(model, emit, inside)
    out = [np.empty(len(e)) for e in emissions]
    for c, (d, at) in enumerate(spots):
        skip = at - max(0, at - CONTEXT)
        size = min(WINDOW, len(emissions[d]) - at)
        out[d][at : at + size] = p[skip : skip + size, c]
    return out


class _Emitter:
    """Emissions of the tokens of a text; tokens are remembered, up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [t.split() if t else [] for t in texts]
        needed = set().union(*split)
        if len(self.known) + len(needed) > CACHED_TOKENS:
            self.known.clear()
        new = list(needed.difference(self.known))
        if new:
            rows = [token_features(w) for w in new]
            sizes = [len(r) for r in rows]
            flat = self.model.weights[np.fromiter((f for r in rows for f in r), np.int64, sum(sizes))]
            sums = np.bincount(np.repeat(np.arange(len(new)), sizes), flat, len(new))
            self.known.update(zip(new, (sums + self.model.bias).tolist(), strict=True))
        known = self.known.__getitem__
        return [np.fromiter(map(known, parts), np.float64, len(parts)) for parts in split]


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of tokens with a marginal of one half or more, as code points from and to."""
    tokens, found, last = list(_TOKEN.finditer(text)), [], None
    for i in np.flatnonzero(p >= 0.5).tolist():
        start, end = tokens[i].span()
        if last == i - 1:
            found[-1]["end"] = end
            found[-1]["score"] = max(found[-1]["score"], float(p[i]))
        else:
            found.append({"start": start, "end": end, "score": float(p[i])})
        last = i
    return found


def score(
    docs: DataFrame, model: Model, *, text_col: str = "text", keep_text: bool = True
) -> DataFrame:
    """``docs`` with toxicity (0 to 1) and toxic_spans (start, end, score).

    A null or empty text has no span and the score of a text without any evidence. Rows are
    scored one by one; columns named toxicity and toxic_spans are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        emitter = held(("toxicity", model.name), lambda: _Emitter(model))

        def work(batch: pa.RecordBatch) -> list:
            texts = batch.column(text_col).to_pylist()
            found = window_marginals(model, emitter(texts))
            x = np.array([_document_features(p) for p in found]).reshape(-1, 4)
            logit = model.document[0] + x @ model.document[1:]
            scores = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            spans = [_spans(t, p) if len(p) and p.max() >= 0.5 else [] for t, p in zip(texts, found)]
            return [scores, spans]

        return work

    return append_columns(
        docs,
        "toxicity double, toxic_spans array<struct<start: int, end: int, score: double>>",
        make,
        drop=() if keep_text else (text_col,),
    )
