"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams, a passage the mean of its words, and
a linear softmax over the passage decides; the document is as toxic as its worst passage, so a
long text does not dilute what one passage says. A misspelling that was never seen still shares
most of its n-grams with the word it disguises.

The model is fitted on at most ``MAX_LABELLED`` labelled rows. Scoring runs over every word of
every text, in tasks; the softmax being linear, each n-gram needs one number there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound of the labelled sample that is brought together to fit the model.
MAX_LABELLED = 8000
_BITS = 18
BUCKETS = 1 << _BITS
DIMENSIONS = 8
GRAMS = (3, 4, 5, 6)
#: Words in a passage.
PASSAGE = 32
#: Words whose value a task remembers at a time.
REMEMBERED = 500_000
_EDGES = ".,;:!?\"'()[]{}<>|*#$%&-_"


def words(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def gram_buckets(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the character n-grams of each word, written between ``<`` and ``>``, and
    the number of the word each belongs to. Punctuation around a word does not count, unless
    there is nothing else. A word has three characters with its marks at least, so one n-gram."""
    marked = [f"<{word.strip(_EDGES) or word}>" for word in found]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    word = np.repeat(np.arange(len(marked), dtype=np.int32), sizes)
    left = np.repeat(sizes.cumsum(), sizes) - np.arange(len(codes))  # characters to the word's end
    buckets, owners, h = [], [], np.zeros(len(codes), np.uint64)
    for n in range(1, GRAMS[-1] + 1):
        if len(codes) < n:
            break
        h = h[: len(codes) - n + 1] * np.uint64(1_000_003) + codes[n - 1 :]
        if n in GRAMS:
            inside = left[: len(h)] >= n
            mixed = (h[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            buckets.append((mixed >> np.uint64(64 - _BITS)).astype(np.int32))
            owners.append(word[: len(h)][inside])
    return np.concatenate(buckets), np.concatenate(owners)


def fit(texts: list[str | None], labels: list[int], steps: int = 100, rate: float = 0.05, decay: float = 2e-5) -> dict:
    """Embeddings and softmax weights for the two classes, by Adam on the cross entropy of each
    document's worst passage. Without any label of a class, or any word, the score is constant."""
    number: dict[str, int] = {}
    tokens, passages, owner = [], [], []
    for d, text in enumerate(texts):
        numbers = [number.setdefault(word, len(number)) for word in words(text)]
        for at in range(0, len(numbers), PASSAGE):
            passages.append(len(tokens) + at)
            owner.append(d)
        tokens.extend(numbers)
    y = np.asarray(labels, dtype=np.float64)
    prior = float((y.sum() + 1) / (len(y) + 2))
    bias = np.log(prior / (1 - prior))
    rng = np.random.default_rng(0)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    if not passages or not 0 < y.sum() < len(y):
        return {"values": np.zeros(BUCKETS, np.float32), "bias": bias, "prior": prior}
    tokens, passages, owner = np.asarray(tokens, np.int32), np.asarray(passages), np.asarray(owner)
    found, step = list(number), 50_000
    parts = [gram_buckets(found[at : at + step]) for at in range(0, len(found), step)]
    buckets = np.concatenate([b for b, _ in parts])
    of_word = np.concatenate([w + np.int32(k * step) for k, (_, w) in enumerate(parts)])
    n_grams, n_words = np.bincount(of_word), np.diff(np.append(passages, len(tokens)))
    docs, first = np.unique(owner, return_index=True)
    used = np.unique(buckets)  # the other rows get no gradient
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    local, parameters = place[buckets], [embedding[used], weights, np.array([0.0, bias])]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    y = y[docs]
    for step in range(1, steps + 1):
        e, w, b = parameters
        word_value = np.bincount(of_word, (e @ (w[:, 1] - w[:, 0]))[local]) / n_grams
        logit = np.add.reduceat(word_value[tokens], passages) / n_words + (b[1] - b[0])
        worst = _first_largest(logit, owner, first)
        error = 1 / (1 + np.exp(-logit[worst])) - y
        share = np.repeat(error / n_words[worst] / len(y), n_words[worst])
        at = np.repeat(passages[worst] - np.append(0, n_words[worst].cumsum()[:-1]), n_words[worst])
        on_words = np.bincount(tokens[at + np.arange(len(at))], share, minlength=len(n_grams))
        on_grams = np.bincount(local, (on_words / n_grams)[of_word], minlength=len(used))
        g = e.T @ on_grams
        gradients = [
            np.outer(on_grams, w[:, 1] - w[:, 0]) + decay * e,
            np.stack([-g, g], axis=1),
            np.array([-error.mean(), error.mean()]),
        ]
        for p, d, (m, v) in zip(parameters, gradients, moments):
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(p.dtype)
    e, w, b = parameters
    values = np.zeros(BUCKETS, np.float32)
    values[used] = e @ (w[:, 1] - w[:, 0])
    return {"values": values, "bias": float(b[1] - b[0]), "prior": prior}


def _first_largest(logit: np.ndarray, owner: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each owner the place of its largest logit, the first of equals."""
    most = np.maximum.reduceat(logit, first)
    sizes = np.diff(np.append(first, len(owner)))
    at = np.flatnonzero(logit == np.repeat(most, sizes))
    return at[np.unique(owner[at], return_index=True)[1]]


def scores(texts: list[str | None], model: dict, known: dict[str, float]) -> np.ndarray:
    """The score of each text. ``known`` remembers the values of words from call to call."""
    found = [words(text) for text in texts]
    new = list({word for each in found for word in each if word not in known})
    if len(known) + len(new) > REMEMBERED:
        known.clear()
        new = list({word for each in found for word in each})
    if new:
        buckets, of_word = gram_buckets(new)
        values = np.bincount(of_word, model["values"][buckets]) / np.bincount(of_word)
        known.update(zip(new, values.tolist()))
    out = np.full(len(texts), model["prior"])
    for d, each in enumerate(found):
        if each:
            values = np.fromiter(map(known.__getitem__, each), np.float64, len(each))
            starts = np.arange(0, len(values), PASSAGE)
            means = np.add.reduceat(values, starts) / np.diff(np.append(starts, len(values)))
            out[d] = 1 / (1 + np.exp(-np.clip(means.max() + model["bias"], -60, 60)))
    return out


def _slices(texts: list[str | None], characters: int = 1_000_000) -> Iterator[list[str | None]]:
    """The texts in runs of about so many characters."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text or "")
        if size >= characters:
            yield run
            run, size = [], 0
    if run:
        yield run


def held_out(doc_id: str = "doc_id"):
    """True for rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")), F.lit(0)) % 4 == 2


def training_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """At most ``most`` labelled rows in the order of a hash of their id; held-out rows, rows
    without a label and ids labelled both ways are left out."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_other"))
        .where("toxic = _other")
        .select("doc_id", "toxic")
    )
    chosen = known.join(docs.select("doc_id").distinct(), "doc_id")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fit_on(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> dict:
    """The model of the labelled sample, fitted in one task: the sample is bounded. Repeated
    documents count once. What comes back is a number for each n-gram bucket."""
    sample = training_sample(docs, labels, most).dropDuplicates(["doc_id"])

    def fit_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [row for batch in batches for row in zip(batch.doc_id, batch.text, batch.toxic)]
        rows.sort(key=lambda row: row[0])
        model = fit([row[1] for row in rows], [int(row[2]) for row in rows])
        yield pd.DataFrame({k: [v.tobytes() if k == "values" else v] for k, v in model.items()})

    fitted = sample.repartition(1).mapInPandas(fit_all, "values binary, bias double, prior double").collect()
    model = fitted[0].asDict() if fitted else fit([], [])
    if fitted:
        model["values"] = np.frombuffer(model["values"], np.float32)
    return model


def scored(docs: DataFrame, model: dict, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text: 0 to 1, higher is likelier toxic. Texts
    without a word, NULL among them, get the share of toxic rows the model has seen.
    A column called ``column`` is replaced."""
    if column == text:
        raise ValueError("the score must not replace the text")
    docs = docs.drop(column)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def score_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, float] = {}
        for batch in batches:
            parts = [scores(run, shared.value, known) for run in _slices(batch.iloc[:, place].tolist())]
            yield batch.assign(**{column: np.concatenate([*parts, np.zeros(0)])})

    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInPandas(score_batches, f"{plain}, `{column}` double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Of each document its id, whether it is held out, its score and the decision."""
    model = fit_on(docs, labels)
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
