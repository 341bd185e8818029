"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

The kernel compares letter strings by their common subsequences of three letters that lie within
``SPAN`` letters; each skipped letter costs a factor ``DECAY``. Words with letters put in or left out
therefore stay close to the word they hide. Units of a text are its words without other signs
("i.d.i.o.t"), the pieces between such signs, and runs of single letters ("i d i o t").

The units that mark label 1 in labelled rows are gone through by their surprise; one becomes a landmark
unless its kernel with a landmark is ``COVERED`` or more, so the forms of a frequent word do not
crowd out the words of rarer languages, and no such unit is left uncovered. Clean units whose kernel with
one is ``ALIKE`` or more are landmarks by the same rule: a clean stem is apart from its marking forms only
in a space that holds both. Clean units that make clean training texts look toxic weigh more, by the texts they
do so to, and the machine is trained again. It separates units in the Nyström space they span, and a text is as toxic as its most toxic unit. Because the decision is
linear in the kernel's features, it is folded into one weight per three letters for scoring.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import crc_mod, in_slices, stored

DECAY = 0.6
SPAN = 5
WINDOW = 32
TRAIN_ROWS = 20_000
COVERED, ALIKE = 0.8, 0.7
ROUND_ROWS = 1_000
NEGATIVES = 3_000
ROUNDS, BLAME = 3, 4.0
_BLOCK = 512
_CODES = 32
_SIGNS = re.compile(r"[\W\d_]+")


def units(text: str) -> set[str]:
    """Letter strings of at least three letters; longer than ``WINDOW``: overlapping windows."""
    tokens = text.lower().split()
    found = set()
    for token in set(tokens):
        if token.isalpha():
            found.add(token)
        else:
            pieces = [p for p in _SIGNS.split(token) if p]
            found.update(pieces)
            found.add("".join(pieces))
    single = [k for k, token in enumerate(tokens) if len(token) == 1 and token.isalpha()]
    if len(single) > 2:
        for run in np.split(np.array(single), np.flatnonzero(np.diff(single) != 1) + 1):
            if len(run) > 2:
                found.add("".join(tokens[k] for k in run))
    short = set()
    for unit in found:
        if len(unit) > WINDOW:
            short.update(unit[a : a + WINDOW] for a in range(0, len(unit) - WINDOW // 2, WINDOW // 2))
        elif len(unit) > 2:
            short.add(unit)
    return short


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the words of one length, and their letters as codes 1 to 31."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(sizes):
        if n < 3:
            continue
        at = np.flatnonzero(sizes == n)
        for part in np.array_split(at, -(-len(at) // 20_000)):
            letters = np.frombuffer("".join(words[k] for k in part).encode("utf-32-le", "surrogatepass"), np.uint32)
            letters = letters.reshape(len(part), n)
            latin = (letters >= 97) & (letters <= 122)
            yield part, np.where(latin, letters - 96, 27 + letters % 5).astype(np.int32)


def _features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triples of letters within the span, and the weight of each."""
    n, triples, weights = codes.shape[1], [], []
    for i in range(n - 2):
        for k in range(i + 2, min(n, i + SPAN)):
            for j in range(i + 1, k):
                triples.append((codes[:, i] * _CODES + codes[:, j]) * _CODES + codes[:, k])
                weights.append(DECAY ** (k - i - 2))
    return np.stack(triples, axis=1), np.array(weights)


def _norms(triples: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Square root of each row's kernel with itself; a triple that recurs counts as one feature."""
    order = np.argsort(triples, axis=1, kind="stable")
    rows = np.arange(len(triples))[:, None]
    ordered, w = triples[rows, order], weights[order]
    starts = np.c_[np.ones(len(triples), bool), np.diff(ordered, axis=1) != 0].ravel()
    sums = np.add.reduceat(w.ravel(), np.flatnonzero(starts))
    row_of = np.repeat(np.arange(len(triples)), starts.reshape(triples.shape).sum(axis=1))
    return np.sqrt(np.bincount(row_of, sums * sums, len(triples)))


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel of each word with each landmark."""
    out, at = np.empty((len(words), len(landmarks)), np.float32), 0
    for table in _tables(landmarks, 128):
        out[:, at : at + table.shape[1]] = _against(words, table)
        at += table.shape[1]
    return out


def _tables(landmarks: list[str], columns: int = 256) -> Iterator[np.ndarray]:
    """Tables of the landmarks in turn, each of a bounded size."""
    for at in range(0, max(1, len(landmarks)), columns):
        yield _landmark_table(landmarks[at : at + columns])


def _landmark_table(landmarks: list[str]) -> np.ndarray:
    """Feature weights of each normalised landmark, one column each."""
    table = np.zeros((_CODES**3, len(landmarks)), np.float32)
    for at, codes in _by_length(landmarks):
        triples, weights = _features(codes)
        scale = 1 / _norms(triples, weights)
        for column, row, s in zip(at, triples, scale):
            np.add.at(table, (row, column), (weights * s).astype(np.float32))
    return table


def _against(words: list[str], table: np.ndarray) -> np.ndarray:
    """Normalised feature sums of each word against the columns of ``table``."""
    out = np.zeros((len(words), *table.shape[1:]), np.float32)
    for at, codes in _by_length(words):
        triples, weights = _features(codes)
        total = np.zeros((len(at), *table.shape[1:]), np.float32)
        for k, w in enumerate(weights):
            total += np.float32(w) * table[triples[:, k]]
        norms = _norms(triples, weights).astype(np.float32)
        out[at] = total / norms.reshape(-1, *[1] * (table.ndim - 1))
    return out


@dataclass
class ToxicityModel:
    """``weights``: one per three letters; a text scores sigmoid(slope * most toxic unit + shift)."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    landmarks: list[str]

    def margins(self, texts: list[str]) -> np.ndarray:
        """The largest decision value among each text's units; the bias alone without units."""
        own = [units(t) for t in texts]
        every = list(set().union(*own)) if own else []
        value = dict(zip(every, (_against(every, self.weights) + self.bias).tolist()))
        return np.array([max(map(value.__getitem__, u), default=self.bias) for u in own])

    def worst(self, texts: list[str]) -> list[tuple[str, float]]:
        """The most toxic unit of each text, with its decision value; the first in order of equal ones."""
        own = [sorted(units(t)) for t in texts]
        every = list(set().union(*own)) if own else []
        value = dict(zip(every, (_against(every, self.weights) + self.bias).tolist()))
        best = [max(u, key=value.__getitem__, default="") for u in own]
        return [(u, value.get(u, self.bias)) for u in best]

    def scores(self, texts: list[str]) -> np.ndarray:
        z = np.clip(self.slope * self.margins(texts) + self.shift, -500, 500)
        return 1 / (1 + np.exp(-z))


def _added(blocks: list[np.ndarray], rows: np.ndarray) -> None:
    """Append rows to a matrix held in blocks of ``_BLOCK`` rows, of which only the last may have fewer."""
    if blocks and (room := _BLOCK - len(blocks[-1])) > 0:
        blocks[-1], rows = np.concatenate([blocks[-1], rows[:room]]), rows[room:]
    blocks += [rows[k : k + _BLOCK].copy() for k in range(0, len(rows), _BLOCK)]


def _machine(x: list[np.ndarray], y: np.ndarray, weight: np.ndarray, penalty: float = 1e-5) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps over blocks of rows."""
    dim = x[0].shape[1]
    ridge = np.r_[np.full(dim, penalty), 1e-6]  # of the diagonal
    w, share = np.zeros(dim + 1), weight / weight.sum()
    rows = [slice(k * _BLOCK, k * _BLOCK + len(xb)) for k, xb in enumerate(x)]
    decide = lambda v: np.concatenate([xb @ v[:-1] + v[-1] for xb in x])
    loss = lambda v: (v * ridge) @ v + share @ np.maximum(0, 1 - y * decide(v)) ** 2
    square, product = np.empty((dim + 1, dim + 1)), np.empty((dim + 1, min(_BLOCK, dim + 1)))  # used by all steps
    for _ in range(50):
        on = np.where(y * decide(w) < 1, share, 0.0)
        square.fill(0)
        np.fill_diagonal(square, ridge)
        pull = np.zeros(dim + 1)
        for r, own in zip(rows, x):
            xb = np.c_[own, np.ones(len(own))]
            a = xb * on[r, None]
            for k in range(0, dim + 1, _BLOCK):
                part = a[:, k : k + _BLOCK]
                square[:, k : k + _BLOCK] += np.matmul(xb.T, part, out=product[:, : part.shape[1]])
            pull += a.T @ y[r]
        best = np.linalg.solve(square, pull)
        step = best - w
        rate = 1.0
        while rate > 1e-6 and loss(w + rate * step) > loss(w):
            rate /= 2
        w = w + rate * step
        if np.abs(rate * step).max() < 1e-7:
            break
    return w[:-1], float(w[-1])


def _sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of Platt's scaling with its smoothed targets."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, w = np.c_[margin, np.ones(len(margin))], np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - p) - 1e-6 * w)
        w = w + step * min(1, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _flat(labels: list[int]) -> ToxicityModel:
    """Without both labels in training there is nothing to separate: a constant score."""
    share = (sum(labels) + 1) / (len(labels) + 2)
    return ToxicityModel(np.zeros(_CODES**3, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))), [])


def _landmarks(words: list[str], covered: float) -> list[int]:
    """Positions of the words, in turn, whose kernel with each one chosen before is below ``covered``."""
    chosen: list[int] = []
    for start in range(0, len(words), 256):
        own = words[start : start + 256]
        near = kernel(own, [words[k] for k in chosen]).max(axis=1, initial=0)
        among = kernel(own, own)
        for k in range(len(own)):
            if near[k] < covered:
                chosen.append(start + k)
                near = np.maximum(near, among[:, k])
    return chosen


def fit(
    docs: DataFrame, labels: DataFrame, *, train_rows: int = TRAIN_ROWS, covered: float = COVERED,
    negatives: int = NEGATIVES, round_rows: int = ROUND_ROWS,
) -> ToxicityModel:
    """Train on at most ``train_rows`` labelled documents (``doc_id, toxic``; a fixed hash picks them).

    The caller leaves out rows that must not be learned from. Labels other than 0 and 1 and null
    ids are passed over; of several labels for an id the largest counts. Landmarks are chosen in rounds
    of ``round_rows`` units until each is a landmark or has a kernel of ``covered`` with one.
    """
    spark = docs.sparkSession
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # No more than train_rows ids.
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    train = stored(texts.select("text", F.col("toxic").cast("int").alias("toxic")), "labelled")
    count = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    n1, n0 = count.get(1, 0), count.get(0, 0)
    if not n1 or not n0:
        return _flat([1] * n1 + [0] * n0)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in ((t.as_py(), y.as_py()) for t, y in zip(batch.column(0), batch.column(1))):
                own = list(units(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.string()), pa.array([toxic] * len(own), pa.int32())], ["unit", "toxic"]
                )

    share = F.col("in_toxic") / (F.col("in_toxic") + F.col("in_clean"))
    usage = stored(
        train.mapInArrow(spread, "unit string, toxic int").groupBy("unit").agg(
            F.sum("toxic").alias("in_toxic"), F.sum(1 - F.col("toxic")).alias("in_clean")
        ),
        "unit-usage",
    )
    expected = n1 / (n0 + n1)
    surprise = F.col("in_toxic") * F.log(share / expected) + F.col("in_clean") * F.log(
        F.greatest(1 - share, F.lit(1e-9)) / (1 - expected)
    )
    # Mostly in label 1, and more so than the luckiest of all units would be by chance.
    chance = float(np.log(max(1, usage.count())))
    marking = stored(
        usage.withColumn("surprise", surprise).filter((F.col("surprise") > chance) & (share > max(0.5, expected))), "marking"
    )

    def close_to(landmarks: list[str]):
        def closeness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                near = kernel(batch.column(0).to_pylist(), landmarks).max(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(float))], [*batch.schema.names, "near"])

        return closeness

    names: list[str] = []
    marks: list[str] = []
    left = marking
    while own := [r["unit"] for r in left.orderBy(F.desc("surprise"), "unit").limit(round_rows).collect()]:
        fresh = _landmarks(own, covered)
        names += [own[k] for k in fresh]
        marks += own
        if len(own) < round_rows:
            break
        shape = "unit string, in_toxic long, in_clean long, surprise double"
        near = left.mapInArrow(close_to([own[k] for k in fresh]), f"{shape}, near double")
        left = stored(near.filter(F.col("near") < covered).drop("near"), "uncovered")
    if not marks:
        return _flat([1] * n1 + [0] * n0)
    # Each landmark counts alike, together with the units it covers.
    nearest = kernel(marks, names).argmax(axis=1)
    alike = 1 / (np.bincount(nearest, minlength=len(names))[nearest] * len(names))

    clean = (
        usage.filter("in_clean > 0").filter(share <= max(0.5, expected))
        .mapInArrow(close_to(list(names)), "unit string, in_toxic long, in_clean long, near double")
        .orderBy(F.desc("near"), "unit").limit(negatives)
    ).collect()
    close = [r["unit"] for r in clean if r["near"] >= ALIKE]
    names += [close[k] for k in _landmarks(close, covered)]
    words = marks + [r["unit"] for r in clean]
    y = np.r_[np.ones(len(marks)), -np.ones(len(clean))]
    seen = np.array([r["in_clean"] for r in clean], float)
    weight = np.r_[alike, seen / max(1.0, seen.sum())]
    square = kernel(names, names).astype(float)
    values, vectors = np.linalg.eigh((square + square.T) / 2)
    root = vectors @ np.diag(np.maximum(values, 1e-3) ** -0.5) @ vectors.T
    root = root.astype(np.float32)
    del square, values, vectors  # the driver holds the space in blocks, and no second copy of anything as large
    space: list[np.ndarray] = []
    _added(space, kernel(words, names) @ root)
    place = {unit: k for k, unit in enumerate(words) if y[k] < 0}
    for _ in range(ROUNDS):
        w, bias = _machine(space, y, weight)
        model = _folded(names, root @ w, bias)
        wrong = _blamed(train, model)
        if not wrong:
            break
        # What makes clean texts look toxic weighs more, by the texts it does so to.
        fresh = sorted(set(wrong) - set(place))
        if fresh:
            place.update({unit: len(words) + k for k, unit in enumerate(fresh)})
            words, y = words + fresh, np.r_[y, -np.ones(len(fresh))]
            _added(space, kernel(fresh, names) @ root)
            weight = np.r_[weight, np.zeros(len(fresh))]
        for unit, texts in wrong.items():
            weight[place[unit]] += BLAME * texts / n0
    w, bias = _machine(space, y, weight)
    model = _folded(names, root @ w, bias)
    pairs = _applied(train, model.margins, "text", "margin").select("margin", "toxic").toPandas()  # train_rows rows
    model.slope, model.shift = _sigmoid(pairs["margin"].to_numpy(), pairs["toxic"].to_numpy())
    return model


def _folded(names: list[str], factors: np.ndarray, bias: float) -> ToxicityModel:
    """The decision as one weight per three letters."""
    folded, at = np.zeros(_CODES**3), 0
    for table in _tables(names):
        folded += table @ factors[at : at + table.shape[1]].astype(np.float32)
        at += table.shape[1]
    return ToxicityModel(folded.astype(np.float32), bias, 1.0, 0.0, names)


def _blamed(train: DataFrame, model: ToxicityModel) -> dict[str, int]:
    """Units that make clean training texts look toxic, each with the number of these texts."""

    def worst(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in in_slices(batch.column(0)):
                found = model.worst([t or "" for t in batch.column(0).slice(start, stop - start).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array([u for u, value in found if value > 0], pa.string())], ["unit"])

    rows = train.filter("toxic = 0").select("text").mapInArrow(worst, "unit string").groupBy("unit").count().collect()
    return {r["unit"]: r["count"] for r in rows}  # train_rows rows


def _applied(docs: DataFrame, function, text: str, name: str) -> DataFrame:
    """``docs`` with a double computed from the text, as the last column."""
    at = docs.columns.index(text)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in in_slices(batch.column(at)):
                part = batch.slice(start, stop - start)
                values = function([t or "" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values.astype(float))], [*batch.schema.names, name])

    return docs.mapInArrow(apply, docs.withColumn(name, F.lit(0.0)).schema)


def with_score(docs: DataFrame, model: ToxicityModel, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score, 0 to 1, of each whole text.

    Null texts score as empty ones; a text without units scores by the bias alone. The name must be
    free. Repeated rows score alike; an empty table stays empty.
    """
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {name} already")
    return _applied(docs, model.scores, text, name)


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the ids that is never learned from."""
    return crc_mod(doc_id, 5) == 0
