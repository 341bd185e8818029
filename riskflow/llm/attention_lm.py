"""Language-model scoring by causal self-attention over subword ids.

A token is a word or the end of a text. A word is spelt by subword ids, the longest piece of the vocabulary
that begins it and so on; the first piece carries the space before the word, so ids say where words end. The
probability of a text is the product of those of all its ids, each given by an attention model from the ids
before it. Every id that occurs in the training corpus has a place of its own, with its own embedding and its
own probability; ids that do not share one and its probability in equal parts. Probabilities have two levels:
of the commonest places and the classes of the others, and of a place in its class. Both sum to one, so no id
is left out and an id costs two short sums.

The attention model (one head, one layer, relative position biases) learns from every training text.
In a round, each task takes Adam steps over windows of its own texts, from the weights that all tasks
share; the weights and moments of the tasks are averaged, by windows, into those of the next round. A
text is scored in overlapping windows, the second half of each against all of it, so every id is
scored once, with at least half a window of context once there is as much.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import blocks
from riskflow.llm.common import crc_mod, slices_of, stored

PLACES = 64  # places of the first level: start, end, unseen ids, and the commonest; all other ids lie in classes
DEPTH, STRIDE = 16, 16
STEPS, BATCH = 1_400, 128  # steps over a small corpus; a larger one is gone through once, in as many as it has
ROUNDS, CHUNKS = 8, 64  # averages of the tasks' weights, and rows in which the sum of these reaches the driver
START, END, OTHER = 0, 1, 2
BLOCK_BYTES = 8 << 20
SCORED_AT_ONCE = 400_000  # ids
_END_KEY = xxhash.xxh3_64_intdigest(b"")


def words_of(blob: pa.Buffer, sizes: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct lower-cased words of the texts in ``blob``; the tokens of all texts as their numbers, an end
    (the number behind the last) after each text; and the tokens of each text."""
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    texts = pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(offsets), blob])
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))  # bytes only, as bytes.split
    word, text = pc.list_flatten(split), pc.list_parent_indices(split)
    real = pc.greater(pc.binary_length(word), 0)  # space at an end leaves an empty word
    coded = word.filter(real).dictionary_encode()
    count = np.bincount(text.filter(real).to_numpy(), minlength=len(sizes)) + 1
    names = coded.dictionary.view(pa.binary()).to_pylist()
    flat = np.full(int(count.sum()), len(names), np.int64)
    inner = np.ones(len(flat), bool)
    inner[np.cumsum(count) - 1] = False
    flat[inner] = coded.indices.to_numpy()
    return names, flat, count


class Pieces:
    """The subword ids of a word: each time the longest piece that the rest of it begins with, plus two.

    The first piece begins with a space. A byte that begins no piece is zero; one is the end of a text.
    """

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary
        self.longest = max(map(len, vocabulary), default=1)
        self.known: dict[bytes, bytes] = {}

    def of(self, word: bytes) -> bytes:
        """As 32-bit numbers in turn."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 100_000:
                self.known.clear()
            marked, at, ids = b" " + word, 0, []
            while at < len(marked):
                for stop in range(min(len(marked), at + self.longest), at, -1):
                    piece = self.vocabulary.get(marked[at:stop])
                    if piece is not None:
                        ids.append(piece + 2)
                        at = stop
                        break
                else:
                    ids.append(0)
                    at += 1
            found = np.array(ids, np.int32).tobytes()
            if len(word) < 64:
                self.known[word] = found
        return found

    def spelt(self, names: list[bytes], flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, given as ``words_of`` does, and how many each text has."""
        each = [*map(self.of, names), np.array([1], np.int32).tobytes()]
        count = np.array([len(b) // 4 for b in each], np.int32)
        begin, long = np.r_[0, np.cumsum(count)[:-1]], count[flat]
        ends = np.cumsum(long, dtype=np.int64)
        at = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32)
        at += np.repeat((begin[flat] - ends + long).astype(np.int32), long)
        return np.frombuffer(b"".join(each), np.int32)[at], np.diff(np.r_[0, ends[np.cumsum(sizes) - 1]])


def classes_of(places: int) -> tuple[int, int, int]:
    """Places of the first level, classes of the others, and places of a class; the last class may have room."""
    head = min(places, PLACES)
    classes = int(np.ceil(np.sqrt(places - head)))
    return head, classes, -(-(places - head) // max(1, classes))


def _by_class(targets: np.ndarray, head: int, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each class that targets are in, which these are, and their places in it."""
    late = np.flatnonzero(targets >= head)
    number, place = np.divmod(targets[late] - head, max(1, size))
    order = np.argsort(number, kind="stable")
    late, place = late[order], place[order]
    found, starts = np.unique(number[order], return_index=True)
    for c, s, e in zip(found.tolist(), starts, [*starts[1:], len(late)]):
        yield c, late[s:e], place[s:e]


@dataclass
class Attention:
    """``hidden = embed[x] + softmax(q k' + near) v``, logits ``hidden out + base`` over the first level, and
    ``hidden far[c] + low[c]`` over the places of class c."""

    embed: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    near: np.ndarray  # bias by distance
    out: np.ndarray
    base: np.ndarray
    far: np.ndarray  # by class, depth and place in it
    low: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.query, self.key, self.value, self.near, self.out, self.base, self.far, self.low]

    def score(self, windows: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log probability of each target; places below zero are padding."""
        q, k, v = ((self.embed @ w).astype(np.float32) for w in (self.query, self.key, self.value))
        embed, out, base, far, low = (w.astype(np.float32) for w in (self.embed, self.out, self.base, self.far, self.low))
        head, size = len(base) - len(low), low.shape[1]
        parts, lags = [], _lags(self.near)
        for at in range(0, len(windows), 256):
            x = windows[at : at + 256]
            safe = np.maximum(x, 0)
            weight = _weights(q[safe[:, STRIDE:]], k[safe], lags, x)
            hidden = embed[safe[:, STRIDE:]]
            hidden += weight @ v[safe]
            hidden = hidden.reshape(-1, DEPTH)
            z = hidden @ out
            z += base
            z -= z.max(axis=1, keepdims=True)
            t = np.maximum(targets[at : at + 256], 0).ravel().astype(np.int64)
            hit = z[np.arange(len(t)), _first_level(t, head, size)]
            hit -= np.log(np.exp(z, out=z).sum(axis=1))
            for c, rows, place in _by_class(t, head, size):
                z = hidden[rows] @ far[c]
                z += low[c]
                z -= z.max(axis=1, keepdims=True)
                hit[rows] += z[np.arange(len(rows)), place] - np.log(np.exp(z).sum(axis=1))
            parts.append(hit)
        return np.concatenate(parts).reshape(targets.shape) if parts else np.zeros(targets.shape)


def _first_level(targets: np.ndarray, head: int, size: int) -> np.ndarray:
    """The place of each target in the first level: its own, or that of its class."""
    return np.where(targets < head, targets, head + (targets - head) // max(1, size))


_LAG = np.arange(STRIDE)[:, None] + STRIDE - np.arange(2 * STRIDE)[None, :]


def _lags(near: np.ndarray) -> np.ndarray:
    """The bias of each place in a window for each target; later places are masked."""
    return np.where(_LAG < 0, np.float32(-1e9), near.astype(np.float32)[np.maximum(_LAG, 0)])


def _weights(q: np.ndarray, k: np.ndarray, lags: np.ndarray, x: np.ndarray):
    """Attention of the second half of each window on all of it, later and padded places masked."""
    s = q @ k.transpose(0, 2, 1)
    s *= np.float32(1 / np.sqrt(DEPTH))
    s += lags
    if (x < 0).any():
        s += np.where(x < 0, np.float32(-2e9), np.float32(0))[:, None, :]
    s -= s.max(axis=2, keepdims=True)
    np.exp(s, out=s)
    s /= s.sum(axis=2, keepdims=True)
    return s


def windows_of(places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Windows and targets of whole texts, each given as the places of its tokens, end included.

    A window holds ``STRIDE`` places before, then the inputs of ``STRIDE`` targets; -1 is padding.
    """
    inputs, targets = [], []
    for own in places:
        rows = -(-len(own) // STRIDE)
        t = np.full(rows * STRIDE, -1, np.int32)
        t[: len(own)] = own
        x = np.full((rows + 1) * STRIDE, -1, np.int32)
        x[STRIDE : STRIDE + len(own)] = np.r_[START, own[:-1]]
        halves = x.reshape(-1, STRIDE)
        inputs.append(np.concatenate([halves[:-1], halves[1:]], axis=1))
        targets.append(t.reshape(-1, STRIDE))
    if not places:
        return np.zeros((0, 2 * STRIDE), np.int32), np.zeros((0, STRIDE), np.int32)
    return np.concatenate(inputs), np.concatenate(targets)


def _shapes(places: int) -> list[tuple[int, ...]]:
    head, classes, size = classes_of(places)
    first = head + classes
    return [
        (head + classes * size, DEPTH), *[(DEPTH, DEPTH)] * 3, (2 * STRIDE,), (DEPTH, first), (first,),
        (classes, DEPTH, size), (classes, size),
    ]


class Trainer:
    """Weights, the two moments of Adam, and the steps taken."""

    def __init__(self, counts: np.ndarray, seed: int = 3):
        """Before the first step; ``counts`` are the tokens of each place."""
        rng = np.random.default_rng(seed)
        self.shapes = _shapes(len(counts))
        w = [rng.normal(0, 0.25, s) if len(s) == 2 else np.zeros(s) for s in self.shapes]
        head, classes, size = classes_of(len(counts))
        full = np.zeros(head + classes * size)
        full[: len(counts)] = counts
        inside = full[head:].reshape(classes, size) + 1
        first = np.r_[full[:head] + 1, inside.sum(axis=1)]
        w[6], w[8] = np.log(first / first.sum()), np.log(inside / inside.sum(axis=1, keepdims=True))
        flat = np.concatenate([m.ravel() for m in w])
        self.state = np.r_[flat, np.zeros(2 * len(flat)), 0.0].astype(np.float32)

    def model(self) -> Attention:
        size, at, w = (len(self.state) - 1) // 3, 0, []
        for shape in self.shapes:
            n = int(np.prod(shape))
            w.append(self.state[:size][at : at + n].reshape(shape))
            at += n
        return Attention(*w)

    def step(self, x: np.ndarray, t: np.ndarray, rate: float) -> None:
        """One step of Adam down the cross-entropy of some windows."""
        size = (len(self.state) - 1) // 3
        w, first, second = (self.state[k * size : (k + 1) * size] for k in range(3))
        g = np.concatenate([g.ravel() for g in _gradients(self.model(), x, t)]).astype(np.float32, copy=False)
        self.state[-1] += 1
        done = float(self.state[-1])
        first *= np.float32(0.9)
        second *= np.float32(0.99)
        first += np.float32(0.1) * g
        g *= g
        g *= np.float32(0.01)
        second += g
        np.multiply(second, np.float32(1 / (1 - 0.99**done)), out=g)
        np.sqrt(g, out=g)
        g += np.float32(1e-8)
        np.divide(first, g, out=g)
        g *= np.float32(rate * min(1, done / 50) / (1 - 0.9**done))
        w -= g


def _groups(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of places, and which there are and where each begins in that order."""
    order = np.argsort(x.ravel(), kind="stable")
    return order, *np.unique(x.ravel()[order], return_index=True)


def _by_place(groups: tuple[np.ndarray, np.ndarray, np.ndarray], rows: np.ndarray, places: int) -> np.ndarray:
    """The sum of the rows of each place."""
    order, found, starts = groups
    out = np.zeros((places, DEPTH), np.float32)
    out[found] = np.add.reduceat(rows.reshape(-1, DEPTH)[order], starts, axis=0)
    return out


def _gradients(model: Attention, x: np.ndarray, t: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy, for each array of the model. Rows of one place are summed before anything else."""
    embed, query, key, value, _, out, base, far, low = (w.astype(np.float32, copy=False) for w in model.arrays())
    head, size = len(base) - len(low), low.shape[1]
    places, safe, real = len(embed), np.maximum(x, 0), t.ravel() >= 0
    late = safe[:, STRIDE:]
    q, k, v = (embed @ query)[late], (embed @ key)[safe], (embed @ value)[safe]
    a = _weights(q, k, _lags(model.near), x)
    h = embed[late]
    h += a @ v
    h = h.reshape(-1, DEPTH)
    d = h @ out
    d += base
    d -= d.max(axis=1, keepdims=True)
    np.exp(d, out=d)
    d *= (real / (d.sum(axis=1) * max(1, real.sum()))).astype(np.float32)[:, None]
    share, want = np.float32(1 / max(1, real.sum())), t.ravel().astype(np.int64)
    d[np.flatnonzero(real), _first_level(want[real], head, size)] -= share
    dh, gfar, glow = d @ out.T, np.zeros_like(far), np.zeros_like(low)
    for c, rows, place in _by_class(want, head, size):
        own = h[rows]
        z = own @ far[c]
        z += low[c]
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z *= share / z.sum(axis=1, keepdims=True)
        z[np.arange(len(rows)), place] -= share
        gfar[c], glow[c] = own.T @ z, z.sum(axis=0)
        dh[rows] += z @ far[c].T
    dh = dh.reshape(-1, STRIDE, DEPTH)
    ds = dh @ v.transpose(0, 2, 1)
    ds -= np.einsum("nij,nij->ni", ds, a)[:, :, None]
    ds *= a
    scale = np.float32(1 / np.sqrt(DEPTH))
    all_places, late_places = _groups(safe), _groups(late)
    gk = _by_place(all_places, ds.transpose(0, 2, 1) @ q, places) * scale
    gv = _by_place(all_places, a.transpose(0, 2, 1) @ dh, places)
    gq, gh = _by_place(late_places, ds @ k, places) * scale, _by_place(late_places, dh, places)
    near = np.bincount(np.maximum(_LAG, 0).ravel(), (ds.sum(axis=0) * (_LAG >= 0)).ravel(), 2 * STRIDE)
    return [
        gh + gq @ query.T + gk @ key.T + gv @ value.T, embed.T @ gq, embed.T @ gk, embed.T @ gv, near,
        h.T @ d, d.sum(axis=0), gfar, glow,
    ]


def train(texts: list[np.ndarray], places: int, steps: int = STEPS, seed: int = 3) -> Attention:
    """The model after steps over windows of a few texts, drawn at random."""
    x, t = windows_of(texts)
    trainer, rng = Trainer(np.bincount(t[t >= 0], minlength=places), seed), np.random.default_rng(seed)
    for step in range(steps if len(x) else 0):
        rows = rng.integers(0, len(x), BATCH)
        trainer.step(x[rows], t[rows], 0.01 * (1 - 0.9 * step / steps))
    return trainer.model()


def _summed(parts: pa.Table) -> pa.Table:
    """One row for a chunk of the state: the windows of all tasks and the sum of their chunks, in order of tasks."""
    parts = parts.sort_by("task")
    total = sum(np.frombuffer(b.as_py(), np.float32).astype(np.float64) * n.as_py() for b, n in zip(parts.column("state"), parts.column("windows")))
    total /= pc.sum(parts.column("windows")).as_py()
    return pa.table({"task": parts.column("task")[:1], "chunk": parts.column("chunk")[:1], "windows": parts.column("windows")[:1], "state": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def _few_rows_at_once(job: DataFrame) -> list:
    """The job's rows; its tasks take two rows at a time, as a row has the ids of megabytes of text."""
    conf, name = job.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, "2")
    try:
        return job.collect()
    finally:
        conf.set(name, before)


def learned(leads: DataFrame, place_of: np.ndarray, counts: np.ndarray, steps: int) -> Attention:
    """The model that all texts of ``leads`` (``block, leads, ends``) train, in rounds of one job each.

    Each core trains one copy of the weights in a round; their averages come to the driver once, in chunks.

    Each text is gone through once at least, and as often as it takes for ``steps`` batches in all.
    """
    trainer = Trainer(counts)
    times = -(-steps * BATCH * STRIDE // max(1, int(counts.sum())))  # a lower bound of the windows is enough
    share, repeat = max(1, ROUNDS // times), max(1, -(-times // ROUNDS))
    context = leads.sparkSession.sparkContext
    sent, leads = context.broadcast(place_of), leads.coalesce(max(1, context.defaultParallelism))

    for turn in range(ROUNDS if counts.sum() else 0):

        begun = context.broadcast(trainer.state)

        def steps_of(batches: Iterator[pa.RecordBatch], turn: int = turn, begun=begun) -> Iterator[pa.RecordBatch]:
            seen, trainer = 0, Trainer(counts)
            trainer.state = begun.value.copy()
            for batch in batches:
                for block, own, ends in zip(*batch.columns):
                    own = sent.value[np.frombuffer(own.as_buffer(), _lead_type(len(sent.value)))]
                    ends = np.frombuffer(ends.as_buffer(), np.int64)
                    mine = range((turn + block.as_py()) % share, len(ends), share)
                    x, t = windows_of([own[ends[d - 1] if d else 0 : ends[d]] for d in mine])
                    rng = np.random.default_rng([turn, block.as_py()])
                    for _ in range(repeat):
                        order = rng.permutation(len(x))
                        for at in range(0, len(x), BATCH):
                            rows = order[at : at + BATCH]
                            trainer.step(x[rows], t[rows], 0.01 * (1 - 0.9 * turn / ROUNDS))
                    seen += len(x) * repeat
            if seen:
                task = TaskContext.get().partitionId()
                for chunk, part in enumerate(np.array_split(trainer.state, CHUNKS)):
                    columns = [pa.array([task], pa.int64()), pa.array([chunk], pa.int64()), pa.array([float(seen)]), pa.array([part.tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["task", "chunk", "windows", "state"])

        shape = "task long, chunk long, windows double, state binary"
        told = _few_rows_at_once(leads.mapInArrow(steps_of, shape).groupBy("chunk").applyInArrow(_summed, shape))  # one state
        told.sort(key=lambda r: r["chunk"])
        begun.destroy()
        if told:
            trainer.state = np.concatenate([np.frombuffer(r["state"], np.float32) for r in told])
    sent.destroy()
    return trainer.model()


def _lead_type(leads: int) -> type:
    return np.uint16 if leads <= 1 << 16 else np.uint32


def _counted(asked: pa.Table) -> pa.Table:
    """The sum of each key's counts for every block that asked, and the tokens and distinct tokens of the bucket."""
    parts = [np.frombuffer(b.as_py(), np.uint64) for b in asked.column("keys")]
    count = np.concatenate([np.frombuffer(b.as_py(), np.int64) for b in asked.column("extra")])
    keys, where = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, where, count)
    told, cuts = total[where], np.r_[0, np.cumsum([len(p) for p in parts])]
    rows = [(b.as_py(), "count", n.as_py(), told[s:e].tobytes(), None) for b, n, s, e in zip(asked.column("block"), asked.column("bucket"), cuts, cuts[1:])]
    rows.append((-1, "sums", asked.column("bucket")[0].as_py(), np.array([total.sum(), (total > 0).sum()], np.int64).tobytes(), None))
    types = (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary())
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("block", "kind", "bucket", "reply", "lead"), zip(*rows), types)})


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """Blocks as rows, which of their documents are held out, and their words (as ``words_of``)."""
    for batch in batches:
        at = {n: k for k, n in enumerate(batch.schema.names)}
        for k in range(batch.num_rows):
            row = {n: batch.column(at[n])[k] for n in at}
            held = row["rows"].values.field("held_out").to_numpy(zero_copy_only=False).astype(bool)
            yield row, held, *words_of(row["blob"].as_buffer(), np.array(row["sizes"].as_py(), np.int64))


def _with(batch: pa.RecordBatch, more: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "leads", "ends"])


def scored(
    docs: DataFrame, vocabulary: dict[bytes, int], *, doc_id: str = "doc_id", text: str = "text", divisor: int = 7,
    remainder: int = 2, steps: int = STEPS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every whole text.

    Documents whose crc32 of the id, as text, leaves ``remainder`` modulo ``divisor`` are held out; counts,
    the choice of the places and the attention model come from all tokens of all others. ``base_score`` is the
    add-one unigram score, in which all unknown tokens are one. ``score`` sums the log10 probabilities of all ids
    of the text, so unknown words are spelt.

    Null and empty texts are one end token. Rows whose id is null count as learned from; repeated rows
    count each. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("held_out", crc_mod("doc_id", divisor) == remainder)
    coder = spark.sparkContext.broadcast(vocabulary)  # the size of the vocabulary file
    n_leads = max(vocabulary.values(), default=0) + 3

    packed = blocks.pack(rows, "text", lambda text: 0, block_bytes)
    buckets = blocks.bucket_count(packed, block_bytes)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, digest = Pieces(coder.value), xxhash.xxh3_64_intdigest
        for row, held, names, flat, sizes in _documents(batches):
            block, out = row["block"].as_py(), np.repeat(held, sizes)
            keys = np.array([digest(w) for w in names] + [_END_KEY], np.uint64)
            count = np.bincount(flat[~out], minlength=len(keys))
            order = np.argsort(keys)
            asked = blocks.batch_of(blocks.question(block, "count", keys[order], count[order], buckets))
            yield _with(asked, [pa.nulls(asked.num_rows, pa.binary())] * 2)
            sequence, own = pieces.spelt(names, flat[~out], sizes[~held])
            given = [sequence.astype(_lead_type(n_leads)).tobytes(), np.cumsum(own).tobytes()]
            one = pa.table({"block": [block], "kind": ["leads"], "bucket": pa.array([-1], pa.int32()), "keys": pa.nulls(1, pa.binary()), "extra": pa.nulls(1, pa.binary())})
            yield _with(one.to_batches()[0], [pa.array([b], pa.binary()) for b in given])

    # One pass over the texts gives the questions and, in columns of their own, the training texts as ids.
    questions = stored(packed.select("block", "rows", "sizes", "blob").mapInArrow(ask, f"{blocks.QUESTION}, leads binary, ends binary"), "questions")
    asked = questions.filter("kind = 'count'").select("block", "kind", "bucket", "keys", "extra")
    answers = stored(asked.groupBy("bucket").applyInArrow(_counted, blocks.ANSWER), "counts")

    leads = questions.filter("leads is not null").select("block", "leads", "ends")

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column(1):
                count = np.bincount(np.frombuffer(own.as_buffer(), _lead_type(n_leads)), minlength=1)
                found = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(count[found])], ["id", "n"])

    by_id = np.zeros(n_leads, np.int64)
    for r in leads.mapInArrow(used, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # no more rows than ids
        by_id[r["id"]] = r["n"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [np.frombuffer(reply.as_py(), np.int64) for reply in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([int(t[k]) for t in told], pa.int64()) for k in (0, 1)], ["tokens", "types"])

    total = answers.filter("kind = 'sums'").select("reply").mapInArrow(sums, "tokens long, types long")
    n_train, n_types = (n or 0 for n in total.agg(F.sum("tokens"), F.sum("types")).first())
    common = [i for i in np.argsort(-by_id, kind="stable").tolist() if i > 1 and by_id[i]]
    places = max(PLACES, 3 + len(common))
    place_of = np.full(n_leads, OTHER, np.int32)
    place_of[1] = END
    place_of[common] = np.arange(3, 3 + len(common))
    shared = np.log(256 + n_leads - 2 - len(common))  # ids that share a place; a byte that begins no piece is one of 256
    model = learned(leads, place_of, np.bincount(place_of, by_id, places).astype(np.int64), steps)
    sent = spark.sparkContext.broadcast((place_of, model))  # of the size of the vocabulary

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place_of, attention = sent.value
        pieces, digest = Pieces(coder.value), xxhash.xxh3_64_intdigest
        for row, held, names, flat, sizes in _documents(batches):
            keys = np.array([digest(w) for w in names] + [_END_KEY], np.uint64)
            order = np.argsort(keys)
            told = blocks.of_kind(row["answers"].as_py(), "count")
            known = np.empty(len(keys), np.int64)
            known[order] = np.concatenate([np.frombuffer(told[b][0], np.int64) for b, _ in blocks.ask(keys[order], buckets)])
            seen = known > 0
            base = np.log10((known + 1) / (n_train + n_types + 1))
            starts = np.r_[0, np.cumsum(sizes)[:-1]]
            sequence, own = pieces.spelt(names, flat, sizes)
            place, ends, total = place_of[sequence], np.cumsum(own), np.zeros(len(own))
            for first, stop in slices_of(own, SCORED_AT_ONCE):
                begin = ends[first] - own[first]
                part = place[begin : ends[stop - 1]]
                windows, targets = windows_of(np.split(part, ends[first : stop - 1] - begin))
                ln = attention.score(windows, targets)[targets >= 0].astype(np.float64) - (part == OTHER) * shared
                total[first:stop] = np.add.reduceat(ln, ends[first:stop] - own[first:stop] - begin) / np.log(10)
            columns = [
                row["rows"].values.field("doc_id"), pa.array(held, pa.bool_()), pa.array(sizes),
                pa.array(np.add.reduceat(seen[flat].astype(np.int64), starts)), pa.array(np.full(len(sizes), n_train)),
                pa.array(np.add.reduceat(base[flat], starts)), pa.array(total),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    own_answers = blocks.by_block([answers.filter("kind = 'count'")])
    told = packed.select("block", "rows", "sizes", "blob").join(own_answers, "block")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return told.mapInArrow(
        score,
        f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
