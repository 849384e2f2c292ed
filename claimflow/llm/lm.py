"""Documents scored by masked pseudo-likelihood (operator 1).

A token is a word's bucket: the top 12 bits of its hash. A network with one
hidden layer predicts every token of a text from the two tokens on either
side of it, never from the token itself: their embeddings, side by side, pass
a tanh layer; a softmax over 64 classes (the bucket's upper six bits) and one
over the 64 buckets of the class follow. The sum of the logarithms of all
those conditional probabilities is the text's pseudo-likelihood; divided by
the number of tokens it compares texts of any length.

Training takes all documents of the corpus, in NumPy within Spark's tasks:

1. Token counts over all tokens, summed by Spark, give the softmax biases: the
   network starts as the unigram model.
2. Each task trains the network on every position of its documents, by
   minibatches with Adagrad, all tasks from the same start.
3. The tasks' parameters, weighted by their numbers of positions, are averaged
   by Spark in blocks, in two levels and in a fixed order of the parts.

What is trained and gathered so grows with the corpus; what reaches the driver
is one set of parameters, whatever the corpus.

Words are runs of characters other than ASCII white space. Null and empty
texts have no tokens, a score of 0 and a null mean. Rows that repeat are
scored each. At a text's ends the missing neighbours have zero embeddings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textnum import runs, text_bytes, word_hashes, word_spans

CLASSES = 64
TOKENS = CLASSES * CLASSES
PAD = TOKENS
SIDE, EMBEDDING, HIDDEN = 2, 8, 32
BATCH, RATE = 4096, 0.05
_SHAPES = {"embedding": (TOKENS + 1, EMBEDDING), "w_in": (2 * SIDE * EMBEDDING, HIDDEN), "b_in": (HIDDEN,),
           "w_class": (HIDDEN, CLASSES), "b_class": (CLASSES,), "w_token": (CLASSES, HIDDEN, CLASSES),
           "b_token": (CLASSES, CLASSES)}
#: Numbers of a block in which parameters are averaged, and tasks that share the first level of it.
_BLOCK, _SALTS = 8192, 32

Params = dict[str, np.ndarray]


def start(counts: np.ndarray, seed: int = 0) -> Params:
    """The unigram model: the given token counts, with one added, in the biases."""
    rng = np.random.default_rng(seed)
    p = {k: np.zeros(s, np.float32) for k, s in _SHAPES.items()}
    p["embedding"][:PAD] = rng.normal(0, 0.5, (TOKENS, EMBEDDING))
    p["w_in"][:] = rng.normal(0, 1 / np.sqrt(len(p["w_in"])), p["w_in"].shape)
    table = (counts + 1.0).reshape(CLASSES, CLASSES)
    p["b_class"][:] = np.log(table.sum(1) / table.sum())
    p["b_token"][:] = np.log(table / table.sum(1, keepdims=True))
    return p


def tokens_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, after the last, tokens with SIDE pads before and after every
    text, places of the real ones, bounds of the texts among these)."""
    data, bounds = text_bytes(column)
    for i, j in runs(bounds, 1 << 20):
        part, inner = data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]
        starts, ends, of = word_spans(part, inner)
        buckets = (word_hashes(part, starts, ends) >> np.uint64(52)).astype(np.int32)
        places = np.arange(len(buckets)) + SIDE * (1 + np.repeat(np.arange(j - i), np.diff(of)))
        line = np.full(len(buckets) + SIDE * (j - i + 1), PAD, np.int32)
        line[places] = buckets
        yield i, j, line, places, of


def _context(line: np.ndarray, places: np.ndarray) -> np.ndarray:
    offsets = [o for o in range(-SIDE, SIDE + 1) if o]
    return line[places[:, None] + np.array(offsets)]


def _shift(x: np.ndarray) -> None:
    """Take from each row its greatest value, found by halves: rows are too short for a reduction of each."""
    top, n = x, x.shape[1]
    while n > 1 and n % 2 == 0:
        n //= 2
        top = np.maximum(top[:, :n], top[:, n:])
    x -= top if n == 1 else top.max(1, keepdims=True)


def _log_chosen(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Of each row's log softmax the chosen one; ``x`` is used up."""
    _shift(x)
    at = x[np.arange(len(x)), chosen]
    np.exp(x, out=x)
    return at - np.log(x.sum(1))


def _softmax(x: np.ndarray) -> np.ndarray:
    """In the place of ``x``."""
    _shift(x)
    np.exp(x, out=x)
    x /= x.sum(1, keepdims=True)
    return x


def _logits(h: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = h @ w
    x += b
    return x


def _by_class(target: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The places of each class among sorted targets."""
    edges = np.searchsorted(target, np.arange(CLASSES + 1) * CLASSES).tolist()
    for c in range(CLASSES):
        if edges[c] < edges[c + 1]:
            yield c, slice(edges[c], edges[c + 1])


def _hidden(p: Params, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = p["embedding"][context].reshape(len(context), -1)
    return x, np.tanh(x @ p["w_in"] + p["b_in"])


def log_probabilities(p: Params, line: np.ndarray, places: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """Of the tokens at the places, given their neighbours."""
    out = np.zeros(len(places), np.float64)
    for at in range(0, len(places), block):
        order = np.argsort(line[places[at:at + block]], kind="stable")
        here = places[at:at + block][order]
        target = line[here]
        _, h = _hidden(p, _context(line, here))
        one = _log_chosen(_logits(h, p["w_class"], p["b_class"]), target // CLASSES)
        two = np.zeros(len(here), np.float32)
        for c, which in _by_class(target):
            two[which] = _log_chosen(_logits(h[which], p["w_token"][c], p["b_token"][c]), target[which] % CLASSES)
        out[at + order] = one.astype(np.float64) + two
    return out


def train_step(p: Params, squares: Params, line: np.ndarray, places: np.ndarray) -> None:
    """One minibatch of Adagrad."""
    places = places[np.argsort(line[places], kind="stable")]
    target, context = line[places], _context(line, places)
    n = len(places)
    x, h = _hidden(p, context)
    rows = np.arange(n)
    d = _softmax(_logits(h, p["w_class"], p["b_class"]))
    d[rows, target // CLASSES] -= 1
    d /= n
    g = {"w_class": h.T @ d, "b_class": d.sum(0)}
    dh = d @ p["w_class"].T
    # the tokens' softmaxes and their update are taken for all classes at once; a class without tokens has no gradient
    classes = list(_by_class(target))
    for c, which in classes:
        np.matmul(h[which], p["w_token"][c], out=d[which])
        d[which] += p["b_token"][c]
    _softmax(d)
    d[rows, target % CLASSES] -= 1
    d /= n
    g["w_token"], g["b_token"] = np.zeros_like(p["w_token"]), np.zeros_like(p["b_token"])
    for c, which in classes:
        dc = d[which]
        dh[which] += dc @ p["w_token"][c].T
        np.matmul(h[which].T, dc, out=g["w_token"][c])
        dc.sum(0, out=g["b_token"][c])
    dh *= 1 - h * h
    g["w_in"], g["b_in"] = x.T @ dh, dh.sum(0)
    dx = (dh @ p["w_in"].T).reshape(-1, EMBEDDING)
    at = context.reshape(-1)
    de = np.stack([np.bincount(at, x, TOKENS + 1) for x in np.ascontiguousarray(dx.T)], 1).astype(dx.dtype)
    de[PAD] = 0
    g["embedding"] = de
    for k, v in g.items():
        _adagrad(p[k], squares[k], v)


def _adagrad(value: np.ndarray, square: np.ndarray, gradient: np.ndarray) -> None:
    square += gradient * gradient
    step = np.sqrt(square)
    step += 1e-6
    value -= np.divide(RATE * gradient, step, out=step)


# ---- in Spark --------------------------------------------------------------------------

def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(TOKENS, np.int64)
    for batch in batches:
        for _, _, line, places, _ in tokens_of(batch.column("text")):
            counts += np.bincount(line[places], minlength=TOKENS)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["token", "n"])


def _trained(first: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = {k: v.copy() for k, v in first.items()}
        squares = {k: np.zeros_like(v) for k, v in p.items()}
        seen = 0
        for batch in batches:
            for _, _, line, places, _ in tokens_of(batch.column("text")):
                if len(places):
                    for here in np.array_split(places, -(-len(places) // BATCH)):
                        train_step(p, squares, line, here)
                    seen += len(places)
        if not seen:
            return
        flat = np.concatenate([p[k].ravel() for k in _SHAPES]).astype(np.float64) * seen
        part = TaskContext.get().partitionId()
        for block, at in enumerate(range(0, len(flat), _BLOCK)):
            yield _summed_row(block, part, seen, flat[at:at + _BLOCK])
    return run


_SUMS = "block int, part int, weight double, total binary"


def _summed_row(block: int, part: int, weight: float, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([part], pa.int32()), pa.array([float(weight)]),
         pa.array([values.astype("<f8").tobytes()], pa.binary())], names=["block", "part", "weight", "total"])


def _added(of):
    """Sums the rows of a group as they stream by; ``of`` makes the group from block and part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, weight, total = None, 0.0, None
        for batch in batches:
            for b, p, w, v in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if of(b, p) != group:
                    if group is not None:
                        yield _summed_row(*group, weight, total)
                    group, weight, total = of(b, p), 0.0, 0.0
                weight, total = weight + w, total + np.frombuffer(v, "<f8")
        if group is not None:
            yield _summed_row(*group, weight, total)
    return run


def fit(docs: DataFrame, text: str = "text", seed: int = 0) -> Params:
    """The network trained on all documents."""
    d = docs.select(F.col(text).alias("text"))
    # as many rows as there are buckets, at most
    rows = d.mapInArrow(_counted, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(TOKENS)
    for r in rows:
        counts[r.token] = r.n
    first = start(counts, seed)
    sums = d.mapInArrow(_trained(first), _SUMS).withColumn("salt", F.pmod("part", F.lit(_SALTS)))
    sums = sums.repartition("block", "salt").sortWithinPartitions("block", "salt", "part").drop("salt")
    sums = sums.mapInArrow(_added(lambda b, p: (b, p % _SALTS)), _SUMS)
    sums = sums.repartition("block").sortWithinPartitions("block", "part").mapInArrow(
        _added(lambda b, p: (b, 0)), _SUMS)
    blocks = {r.block: np.frombuffer(r.total, "<f8") / r.weight for r in sums.collect()}   # one set of parameters
    if not blocks:
        return first
    flat = np.concatenate([blocks[b] for b in sorted(blocks)])
    out, at = {}, 0
    for k, shape in _SHAPES.items():
        n = int(np.prod(shape))
        out[k] = flat[at:at + n].astype(np.float32).reshape(shape)
        at += n
    return out


def _scored(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, line, places, of in tokens_of(batch.column("text")):
                logs = np.concatenate(([0.0], np.cumsum(log_probabilities(p, line, places))))
                n, total = np.diff(of), logs[of[1:]] - logs[of[:-1]]
                mean = pa.array(np.divide(total, n, out=np.zeros(j - i), where=n > 0), mask=n == 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(total), mean],
                    names=["doc_id", "n_tokens", "pseudo_log_likelihood", "mean_log_probability"])
    return run


def score(docs: DataFrame, model: Params, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, pseudo_log_likelihood, mean_log_probability."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(d.dtypes)["doc_id"]
    return d.mapInArrow(_scored(model), f"doc_id {kind}, n_tokens bigint, pseudo_log_likelihood double, "
                        "mean_log_probability double")
