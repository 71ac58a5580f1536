"""Toxicity: a factorization machine over hashed terms.

A document is the set of buckets that its words and the beginnings of its
words hash to. Its score is

    sigmoid(bias + sum of w[j] + sum over pairs of <v[i], v[j]>)

so a pair of terms that is harmful only together (an insult and the mention of
a group) has a weight of its own, which additive weights cannot give it. Every
term that enough sampled documents hold has a weight, however it is spread over
the labels by itself; factors belong to the terms of telling pairs, all others'
are zero, so a pair counts the same in a short text and in one of a thousand terms.

Telling pairs are found in what the weights alone leave unexplained. Summed over
documents, the errors times the products of two terms are a matrix over
all terms; subspace iteration, which only ever multiplies it with a few vectors,
gives the terms that stand out in it. Of these, a pair is telling if the errors
with both, one and none of its terms differ by more than chance in the way that no
two additive weights can follow. Terms that always come together (a word and its
beginning) are one term in this. Their factors begin with the leading
eigenvectors of these differences; then weights and factors are learnt together.

Noise is held down by a penalty on weights, not by leaving terms out: a weight
is pulled to zero in proportion to the deviation that its gradient has by
chance, which shrinks with the sample, and the less the larger the weight is.

Labels are learnt from a bounded sample (``fit_rows`` rows, the smallest hashes
of key and text); every document is scored whole.

Edge cases: null and empty texts hold no term and score sigmoid(bias); rows
without key or label are not learnt from; repeated rows are scored one by one;
a table without labelled rows gives the score 0.5 minus nothing learnt, that is
a bias of the smoothed label share; result columns replace columns of the same
name.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.llm.text import add_columns, words


@dataclass(frozen=True)
class FactorSettings:
    """``fit_rows`` bounds the labelled sample, ``bits`` the number of hashed terms.

    A term takes part if ``least_documents`` sampled documents hold it. A weight
    leaves zero where its gradient exceeds ``chance`` standard deviations of an
    uninformative term; at the size ``relief`` the pull back is halved. Of the
    ``candidates`` that stand out, those form telling pairs whose errors differ by
    ``pair_chance`` deviations and by ``least_difference``, with ``least_cell`` documents of each kind.
    """

    bits: int = 18
    factors: int = 6
    stems: tuple[int, ...] = (3, 4, 5, 6)
    fit_rows: int = 12_000
    least_documents: int = 3
    candidates: int = 256
    rounds: int = 6
    pair_chance: float = 6.0
    least_difference: float = 0.2
    least_cell: int = 5
    weight_epochs: int = 12
    epochs: int = 16
    batch: int = 128
    rate: float = 0.5
    chance: float = 4.0
    relief: float = 0.05
    penalty: float = 1e-3
    seed: int = 7


@dataclass(frozen=True)
class FactorModel:
    bits: int
    stems: tuple[int, ...]
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def term_buckets(data: bytes | None, bits: int, stems: tuple[int, ...]) -> np.ndarray:
    """Sorted distinct buckets of a text's words and word beginnings."""
    mask = (1 << bits) - 1
    found = set(words(data))
    buckets = {crc32(w) & mask for w in found}
    for length in stems:
        buckets.update([crc32(s, length) & mask for s in {w[:length] for w in found if len(w) > length}])
    return np.sort(np.fromiter(buckets, np.int64, len(buckets)))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All buckets one after another, and the row each belongs to."""
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return np.concatenate([*rows, np.zeros(0, np.int64)]), of


def _margins(bias: float, weights: np.ndarray, factors: np.ndarray, terms: np.ndarray, of: np.ndarray, n: int):
    """Linear plus pairwise part of each row, and the rows' factor sums."""
    linear = np.bincount(of, weights[terms], n)
    taken = factors[terms]
    sums = np.stack([np.bincount(of, taken[:, f], n) for f in range(factors.shape[1])], axis=1)
    squares = np.bincount(of, (taken * taken).sum(axis=1), n)
    return bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums, taken


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def known_terms(rows: list[np.ndarray], settings: FactorSettings) -> tuple[np.ndarray, np.ndarray]:
    """Which buckets take part, and how many rows hold each bucket."""
    held = np.zeros(1 << settings.bits)
    for start in range(0, len(rows), 1_000):
        held += np.bincount(_flat(rows[start : start + 1_000])[0], minlength=len(held))
    return held >= settings.least_documents, held


def _segment_sums(matrix: np.ndarray, index: np.ndarray, ends: np.ndarray, block: int = 1 << 18) -> np.ndarray:
    """Sums of matrix[index] over consecutive segments, in blocks of bounded memory."""
    result = np.zeros((len(ends), matrix.shape[1]))
    starts = np.concatenate([[0], ends[:-1]])
    first = 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + block, "right")))
        full = np.flatnonzero(ends[first:last] > starts[first:last]) + first
        if len(full):
            taken = matrix[index[starts[first] : ends[last - 1]]]
            result[full] = np.add.reduceat(taken, starts[full] - starts[first], axis=0)
        first = last
    return result


def standing_out(rows: list[np.ndarray], error: np.ndarray, share: np.ndarray, settings: FactorSettings) -> np.ndarray:
    """The terms with the largest part in the leading subspace of the sum of error x (term - share) x (term - share)."""
    number = len(share)
    terms = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int32)
    row_ends = np.cumsum([len(r) for r in rows])
    order = np.argsort(terms, kind="stable")
    of_sorted = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(row_ends, prepend=0))[order]
    term_ends = np.cumsum(np.bincount(terms, minlength=number))
    of_term = _segment_sums(error[:, None], of_sorted, term_ends)[:, 0]
    diagonal = (1 - 2 * share) * of_term + share * share * error.sum()
    basis = np.random.default_rng(settings.seed).normal(size=(number, min(8, number)))
    for _ in range(settings.rounds):
        basis = np.linalg.qr(basis)[0]
        seen = (_segment_sums(basis, terms, row_ends) - share @ basis) * error[:, None]
        basis = _segment_sums(seen, of_sorted, term_ends) - share[:, None] * seen.sum(axis=0) - diagonal[:, None] * basis
    strength = (basis * basis).sum(axis=1)
    return np.argsort(-strength, kind="stable")[: settings.candidates]


def telling_pairs(rows: list[np.ndarray], error: np.ndarray, share: np.ndarray, settings: FactorSettings) -> tuple[np.ndarray, np.ndarray]:
    """Terms of telling pairs, and their first factors."""
    chosen = standing_out(rows, error, share, settings)
    place = np.full(len(share), -1)
    place[chosen] = np.arange(len(chosen))
    has = np.zeros((len(rows), len(chosen)), np.float32)
    for i, row in enumerate(rows):
        at = place[row]
        has[i, at[at >= 0]] = 1.0
    # terms that come together are one: each belongs to the first that it nearly equals
    sizes = has.sum(axis=0)
    both = has.T @ has
    alike = both * both >= 0.9 * np.outer(sizes, sizes)
    head = alike.argmax(axis=0)
    heads = np.flatnonzero(head == np.arange(len(chosen)))
    x = has[:, heads]
    # numbers, errors and squared errors of the rows with both terms, only the first, only the second, and none
    cells = []
    for value in (np.ones(len(error)), error, error * error):
        value = value.astype(np.float32)[:, None]
        together, alone, whole = (x * value).T @ x, (x * value).sum(axis=0), value.sum()
        cells.append((together, alone[:, None] - together, alone[None, :] - together, whole - alone[:, None] - alone[None, :] + together))
    difference, spread, enough = np.zeros_like(cells[0][0]), np.zeros_like(cells[0][0]), np.ones_like(cells[0][0], bool)
    for sign, n, total, square in zip((1, -1, -1, 1), *cells, strict=True):
        count = np.maximum(n, 1)
        difference += sign * total / count
        spread += np.maximum(square / count - (total / count) ** 2, 1e-4) / count
        enough &= n >= settings.least_cell
    telling = enough & (np.abs(difference) >= settings.pair_chance * np.sqrt(spread)) & (np.abs(difference) >= settings.least_difference)
    np.fill_diagonal(telling, False)
    value, vector = np.linalg.eigh(np.where(telling, (difference + difference.T) / 2, 0.0))
    top = np.argsort(-value)[: settings.factors]
    first = np.zeros((len(heads), settings.factors))
    first[:, : len(top)] = vector[:, top] * np.sqrt(np.maximum(value[top], 0.0))
    first[~telling.any(axis=0)] = 0.0
    # a factor is shared out among the terms that are one
    members = np.bincount(head, minlength=len(chosen))
    by_head = np.zeros((len(chosen), settings.factors))
    by_head[heads] = first / members[heads][:, None]
    factors = by_head[head]
    used = np.flatnonzero(factors.any(axis=1))
    return chosen[used], factors[used]


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, settings: FactorSettings) -> FactorModel:
    """Adaptive gradient descent on the penalised log loss, in mini-batches of a fixed order."""
    size, rng, n = 1 << settings.bits, np.random.default_rng(settings.seed), max(1, len(rows))
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    bias = float(np.log(share / (1.0 - share)))
    known, held = known_terms(rows, settings)
    # terms that take part are numbered, so that the penalty reaches all of them at each step
    numbers, number = np.cumsum(known) - 1, int(known.sum())
    rows = [numbers[r[known[r]]] for r in rows]
    weights = np.zeros(number)
    # what the mean gradient of a term that says nothing deviates from zero by chance
    part = held[known] / n
    pull_back = settings.chance * np.sqrt(part * (1.0 - part) * share * (1.0 - share) / n)
    paired, factors = np.zeros(0, np.int64), np.zeros((0, settings.factors))
    place = np.full(number, -1)
    seen_w, seen_b = np.full(number, 1e-3), 1e-3
    seen_v = np.full(factors.shape, 1e-3)
    for epoch in range(settings.weight_epochs + settings.epochs):
        if epoch >= settings.weight_epochs + settings.epochs // 2 and not len(paired):
            break  # weights alone settle sooner
        if epoch == settings.weight_epochs and number and len(rows):
            error = labels - _sigmoid(bias + np.array([weights[r].sum() for r in rows]))
            paired, factors = telling_pairs(rows, error, part, settings)
            place[paired] = np.arange(len(paired))
            seen_v = np.full(factors.shape, 1e-3)
            seen_w[paired] = 1e-3
        order = rng.permutation(len(rows))
        for start in range(0, len(order), settings.batch):
            chosen = order[start : start + settings.batch]
            terms, of = _flat([rows[i] for i in chosen])
            margin = bias + np.bincount(of, weights[terms], len(chosen))
            if len(paired):
                inside = np.flatnonzero(place[terms] >= 0)
                own, own_of = place[terms[inside]], of[inside]
                pairs, sums, taken = _margins(0.0, np.zeros(len(paired)), factors, own, own_of, len(chosen))
                margin = margin + pairs
            error = _sigmoid(margin) - labels[chosen]
            if len(paired):
                pull = error[own_of][:, None] * (sums[own_of] - taken)
                grad_v = np.stack([np.bincount(own, pull[:, f], len(paired)) for f in range(settings.factors)], axis=1)
                grad_v += settings.penalty * np.bincount(own, minlength=len(paired))[:, None] * factors
                seen_v += grad_v * grad_v
                factors = factors - 0.25 * settings.rate * grad_v / np.sqrt(seen_v)
            grad_w = np.bincount(terms, error[of], number)
            seen_w += grad_w * grad_w
            step = settings.rate / np.sqrt(seen_w)
            limit = step * len(chosen) * pull_back * settings.relief / (settings.relief + np.abs(weights))
            limit[paired] = 0.0  # a pair needs the weights of its terms
            moved = weights - step * grad_w
            weights = np.sign(moved) * np.maximum(np.abs(moved) - limit, 0.0)
            grad_b = error.sum()
            seen_b += grad_b * grad_b
            bias -= settings.rate * grad_b / np.sqrt(seen_b)
    all_weights, all_factors = np.zeros(size, np.float32), np.zeros((size, settings.factors), np.float32)
    all_weights[known] = weights
    all_factors[np.flatnonzero(known)[paired]] = factors
    return FactorModel(settings.bits, settings.stems, float(bias), all_weights, all_factors)


def score_rows(model: FactorModel, rows: list[np.ndarray]) -> np.ndarray:
    terms, of = _flat(rows)
    return _sigmoid(_margins(model.bias, model.weights, model.factors, terms, of, len(rows))[0])


def labelled_terms(labelled: DataFrame, key: str, text: str, label: str, settings: FactorSettings) -> DataFrame:
    """(key, label, terms) of at most ``fit_rows`` rows; terms are hashed where the texts are."""
    usable = labelled.filter(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull())
    usable = usable.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").cast("double").alias("label"))
    total = usable.count()
    if total > settings.fit_rows:
        # somewhat more than the bound, whatever the number of labels: the share shrinks as labels grow
        share = int((1 << 30) * (1.2 * settings.fit_rows + 50) / total)
        usable = usable.filter(F.pmod(F.xxhash64("key", "text"), F.lit(1 << 30)) < share)
    bits, stems = settings.bits, settings.stems

    def hashed():
        def run(texts):
            rows = [term_buckets(t, bits, stems) for t in texts]
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            return [pa.ListArray.from_arrays(ends, np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int32))]

        return run

    terms = T.StructType([T.StructField("terms", T.ArrayType(T.IntegerType()))])
    sample = add_columns(usable, "text", hashed, terms, keep=["key", "label"])
    # the bound holds even where one key has most rows
    return sample.orderBy(F.xxhash64("key"), "key", "label", F.xxhash64("terms")).limit(settings.fit_rows)


def fit(labelled: DataFrame, key: str, text: str, label: str, settings: FactorSettings = FactorSettings()) -> FactorModel:
    """Learn from at most ``fit_rows`` rows of ``labelled``, in one task, which sees bucket numbers and no texts."""
    sample = labelled_terms(labelled, key, text, label, settings)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, float, np.ndarray]] = []
        for batch in batches:
            held, ends = batch.column(2).values.to_numpy(), batch.column(2).offsets.to_numpy()
            lists = [held[a:b].copy() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            rows += zip(map(str, batch.column(0).to_pylist()), batch.column(1).to_pylist(), lists, strict=True)
        rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
        model = fit_rows([r[2] for r in rows], np.array([r[1] for r in rows]), settings)
        packed = io.BytesIO()
        np.savez_compressed(packed, bias=model.bias, weights=model.weights, factors=model.factors)
        yield pa.RecordBatch.from_pydict({"model": pa.array([packed.getvalue()], pa.binary())})

    row = sample.repartition(1).mapInArrow(learn, "model binary").first()
    found = np.load(io.BytesIO(bytes(row["model"])))
    return FactorModel(settings.bits, settings.stems, float(found["bias"]), found["weights"], found["factors"])


def score(docs: DataFrame, model: FactorModel, text: str = "text", column: str = "toxic_score", keep=None) -> DataFrame:
    """``docs`` with the probability of label 1 of each whole text."""

    def scorer():
        return lambda texts: [pa.array(score_rows(model, [term_buckets(t, model.bits, model.stems) for t in texts]), pa.float64())]

    return add_columns(docs, text, scorer, T.StructType([T.StructField(column, T.DoubleType())]), keep)


def reject_toxic(docs: DataFrame, model: FactorModel, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The documents whose score stays under ``limit``, with their own columns."""
    scored = score(docs, model, text, "_toxic_score")
    return scored.filter(F.col("_toxic_score") < limit).drop("_toxic_score")
