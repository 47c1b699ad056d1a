"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A word enters the network as the sum of two learned inputs: its own vector, if it is in the vocabulary of the training
sample, and the mean vector of its character 3- to 5-grams, which also covers words never seen. Two gated recurrent
units read a window of words in both directions, attention pools their states, and a logit comes out. A document's
score is that of its worst window of the whole text, calibrated on the training sample. A window of `WINDOW` words
starts every `STRIDE` words and the last one ends with the text, so every passage of up to WINDOW - STRIDE + 1 words is
whole in a window.

Training is plain numpy on the driver, on at most `SAMPLE` labelled documents of each class and `SAMPLE_BYTES` of text,
with the gradient of the network written out. A label belongs to a document and not to a window, so each epoch trains on every document's worst
window so far, and on a random one of clean documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW, STRIDE = 32, 12
DIM, HIDDEN, GRAMS = 16, 12, 1 << 14
#: The bound of the training sample: documents of each class, chosen by a hash of doc_id.
SAMPLE = 1_000
#: The bound of their texts together, and of one of them; longer ones teach nothing but are scored whole like all.
SAMPLE_BYTES, TEXT_BYTES = 16 << 20, 1 << 20
EPOCHS, BATCH, RATE, DROP, SEED = 14, 64, 0.01, 0.4, 11


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def grams(words: list[bytes], block: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character 3- to 5-grams of all words, one after another, and how many each word has; a block of words at
    a time."""
    if len(words) > block:
        parts = [grams(words[k : k + block]) for k in range(0, len(words), block)]
        return np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])
    wrapped = [b"<" + w + b">" for w in words]
    text = np.frombuffer(b"".join(wrapped), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, wrapped), np.int64, len(wrapped))
    end = np.repeat(np.cumsum(size), size)
    owner = np.repeat(np.arange(len(words)), size)
    h, ids, owners = text.copy(), [], []
    for n in range(2, 6):
        h = h[:-1] * np.uint64(0x100000001B3) + text[n - 1 :] if len(h) > 1 else h[:0]
        if n > 2 and len(h):
            at = np.flatnonzero(np.arange(len(h)) + n <= end[: len(h)])
            ids.append((_mix(h[at] + np.uint64(n)) % np.uint64(GRAMS)).astype(np.int32)), owners.append(owner[at])
    if not ids:
        return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ids[order], np.bincount(owners, minlength=len(words))


def _segment_mean(rows: np.ndarray, count: np.ndarray) -> np.ndarray:
    out = np.zeros((len(count), rows.shape[1]), rows.dtype)
    some = np.flatnonzero(count)
    if len(some):
        at = np.concatenate([[0], np.cumsum(count[some])[:-1]])
        out[some] = np.add.reduceat(rows, at, axis=0) / count[some, None]
    return out


def _rows_added(to: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """``to[rows] += values``, a row as often as it is named."""
    on, place = np.unique(rows, return_inverse=True)
    cell = (place[:, None] * values.shape[1] + np.arange(values.shape[1])).ravel()
    to[on] += np.bincount(cell, values.ravel(), len(on) * values.shape[1]).reshape(len(on), -1).astype(to.dtype)


def inputs(p: dict, rows: np.ndarray, gram_ids: np.ndarray, gram_count: np.ndarray, block: int = 8192) -> np.ndarray:
    """What the network reads of words: their own vectors and the means of their grams' ones, a block at a time."""
    out, at = p["word"][rows], np.concatenate([[0], np.cumsum(gram_count)])
    for k in range(0, len(rows), block):
        n = len(rows[k : k + block])
        out[k : k + n] += _segment_mean(p["gram"][gram_ids[at[k] : at[k + n]]], gram_count[k : k + n])
    return out


def plain(token: str) -> bytes:
    """A word as the network sees it: lower case, without punctuation around it."""
    return (token.lower().strip(".,;:!?\"'()[]{}<>|*#$%&-_«»“”„…/\\") or token).encode()


def start(vocabulary: list[bytes], seed: int = SEED) -> dict:
    rng = np.random.default_rng(seed)
    new = lambda *s, scale=0.3: rng.normal(0, scale, s).astype(np.float32)
    p = {"word": new(len(vocabulary) + 1, DIM, scale=0.1), "gram": new(GRAMS, DIM, scale=0.3)}
    p["word"][0] = 0  # words outside the vocabulary
    for d in "fb":
        p |= {f"W{d}": new(DIM, 3 * HIDDEN), f"U{d}": new(HIDDEN, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
    return p | {"A": new(2 * HIDDEN, HIDDEN), "a": np.zeros(HIDDEN, np.float32), "u": new(HIDDEN), "o": new(2 * HIDDEN), "c": np.zeros(1, np.float32)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _read(gates: Callable[[int], np.ndarray], U: np.ndarray, mask: np.ndarray, back: bool, keep: list | None = None) -> np.ndarray:
    """States (T, B, h) of one direction; gates(t) (B, 3h) is the input's part of a step. ``keep`` gets what backward needs."""
    steps, rows, h = len(mask), mask.shape[1], U.shape[0]
    state, out, full = np.zeros((rows, h), np.float32), np.empty((steps, rows, h), np.float32), mask.all(axis=1)
    for t in reversed(range(steps)) if back else range(steps):
        g, hu, m = gates(t), state @ U, mask[t][:, None]
        zr = g[:, : 2 * h] + hu[:, : 2 * h]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r = zr[:, :h], zr[:, h:]
        n = r * hu[:, 2 * h :]
        n += g[:, 2 * h :]
        np.tanh(n, out=n)
        new = state - n
        new *= z
        new += n
        if keep is not None:
            keep.append((t, state, z, r, n, hu[:, 2 * h :], m))
        state = new if full[t] else np.where(m, new, state)
        out[t] = state
    return out


def _pool(p: dict, states: np.ndarray, mask: np.ndarray) -> tuple:
    """Attention over (T, B, 2h): logits and what backward needs."""
    s = np.tanh(states @ p["A"] + p["a"])
    e = np.where(mask, s @ p["u"], -1e9)
    w = np.exp(e - e.max(axis=0)) * mask
    w /= np.maximum(w.sum(axis=0), 1e-9)
    pooled = (w[:, :, None] * states).sum(axis=0)
    return pooled @ p["o"] + p["c"][0], s, w, pooled


def logits(p: dict, vectors: np.ndarray, ids: np.ndarray, mask: np.ndarray, block: int = 1024) -> np.ndarray:
    """Logits of windows: ids (B, T) index rows of ``vectors`` (words as inputs), mask (B, T) marks words."""
    out = np.empty(len(ids), np.float32)
    gf, gb = vectors @ p["Wf"] + p["bf"], vectors @ p["Wb"] + p["bb"]
    for k in range(0, len(ids), block):
        i, m = ids[k : k + block].T, mask[k : k + block].T
        states = np.concatenate([_read(lambda t: gf[i[t]], p["Uf"], m, False), _read(lambda t: gb[i[t]], p["Ub"], m, True)], axis=2)  # noqa: B023
        out[k : k + block] = _pool(p, states, m)[0]
    return out


def loss_and_gradient(p: dict, word: np.ndarray, gram_ids: np.ndarray, gram_count: np.ndarray, ids: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
    """Mean cross entropy of windows and its gradient. word (U): vocabulary row of each distinct word of the batch;
    gram_ids, gram_count: their character grams; ids (B, T): windows over these words."""
    h = HIDDEN
    vectors = p["word"][word] + _segment_mean(p["gram"][gram_ids], gram_count)
    i, m = ids.T, mask.T
    x = vectors[i]
    tapes: dict = {"f": [], "b": []}
    states = np.concatenate([_read((x @ p[f"W{d}"] + p[f"b{d}"]).__getitem__, p[f"U{d}"], m, d == "b", tapes[d]) for d in "fb"], axis=2)
    logit, s, w, pooled = _pool(p, states, m)
    y = _sigmoid(logit)
    loss = float(-np.mean(label * np.log(y + 1e-9) + (1 - label) * np.log(1 - y + 1e-9)))
    g = {k: np.zeros_like(v) for k, v in p.items()}
    dl = ((y - label) / len(label)).astype(np.float32)
    g["c"][0], g["o"] = dl.sum(), pooled.T @ dl
    dpool = dl[:, None] * p["o"]
    dw = (states * dpool).sum(axis=2)
    dstates = w[:, :, None] * dpool
    de = w * (dw - (w * dw).sum(axis=0))
    g["u"] = np.einsum("tbh,tb->h", s, de)
    ds = de[:, :, None] * p["u"] * (1 - s * s)
    g["A"], g["a"] = np.einsum("tbi,tbj->ij", states, ds), ds.sum(axis=(0, 1))
    dstates = dstates + ds @ p["A"].T
    dx = np.zeros_like(x)
    for d, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
        carry = np.zeros_like(dstates[0, :, part])
        for t, before, z, r, n, hun, mt in reversed(tapes[d]):
            dh = dstates[t][:, part] + carry
            here, carry = dh * mt, dh * ~mt
            dn = here * (1 - z) * (1 - n * n)
            dz = here * (before - n) * z * (1 - z)
            dr = dn * hun * r * (1 - r)
            da, dhu = np.concatenate([dz, dr, dn], axis=1), np.concatenate([dz, dr, dn * r], axis=1)
            carry = carry + here * z + dhu @ p[f"U{d}"].T
            g[f"U{d}"] += before.T @ dhu
            g[f"W{d}"] += x[t].T @ da
            g[f"b{d}"] += da.sum(axis=0)
            dx[t] += da @ p[f"W{d}"].T
    dvectors = np.zeros_like(vectors)
    _rows_added(dvectors, i.ravel(), dx.reshape(-1, dx.shape[2]))
    _rows_added(g["word"], word, dvectors)
    g["word"][0] = 0
    _rows_added(g["gram"], gram_ids, np.repeat(dvectors / np.maximum(gram_count, 1)[:, None], gram_count, axis=0))
    return loss, g


def windows(n: int) -> np.ndarray:
    """First words of the windows over n words, `STRIDE` words apart; the last one ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    at = np.arange(0, n - WINDOW, STRIDE)
    return np.append(at, n - WINDOW)


def _matrix(ids: np.ndarray, starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (B, T) of the word ids of many texts: starts are places in ids, n the words from there on."""
    at = starts[:, None] + np.arange(WINDOW)
    mask = np.arange(WINDOW) < n[:, None]
    return ids[np.minimum(at, len(ids) - 1)] if len(ids) else np.zeros(at.shape, np.int64), mask


class Words:
    """Distinct tokens as input vectors; filled as tokens turn up."""

    def __init__(self, p: dict, index: dict, limit: int = 300_000):
        self.p, self.index, self.limit = p, index, limit
        self.clear()

    def clear(self) -> None:
        self.known, self.vectors, self.used = {}, np.zeros((4096, DIM), np.float32), 0

    def ids(self, tokens: list[str]) -> np.ndarray:
        try:
            return np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            new = list(set(tokens).difference(self.known))
            words = list(map(plain, new))
            rows = np.fromiter((self.index.get(w, 0) for w in words), np.int64, len(words))
            ids, count = grams(words)
            vectors = inputs(self.p, rows, ids, count)
            while self.used + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
            self.vectors[self.used : self.used + len(new)] = vectors
            self.known.update(zip(new, range(self.used, self.used + len(new))))
            self.used += len(new)
            return np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))


def worst(p: dict, words: Words, texts: list[str | None], some: int = 400_000) -> np.ndarray:
    """The largest window logit of each text, over all its windows; nan without words."""
    out = np.full(len(texts), np.nan)
    held, size = [], 0

    def flush() -> None:
        if not held:
            return
        ids, starts, left, owner, base = [], [], [], [], 0
        for k, own in held:
            at = windows(len(own))
            ids.append(own), starts.append(base + at), left.append(len(own) - at), owner.append(np.full(len(at), k))
            base += len(own)
        m, mask = _matrix(np.concatenate(ids), np.concatenate(starts), np.concatenate(left))
        owner = np.concatenate(owner)
        score = logits(p, words.vectors[: words.used], m, mask)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        out[owner[first]] = np.maximum.reduceat(score, first)
        held.clear()

    def number(block: list[tuple[int, list[str]]]) -> None:
        """New words of many texts are entered at once."""
        if words.used > words.limit:
            words.clear()
        ids, at = words.ids([w for _, t in block for w in t]), 0
        for k, t in block:
            held.append((k, ids[at : at + len(t)]))
            at += len(t)
        flush()
        block.clear()

    block: list[tuple[int, list[str]]] = []
    for k, text in enumerate(texts):
        tokens = text.split() if text else []
        if not tokens:
            continue
        block.append((k, tokens))
        size += len(tokens)
        if size >= some:
            number(block)
            size = 0
    number(block)
    return out


def train(texts: list[str], labels: list[int], seed: int = SEED, epochs: int | None = None) -> dict:
    """Fit the network to labelled texts: {"p", "index", "a", "b"}; the score is sigmoid(a * worst logit + b)."""
    rng = np.random.default_rng(seed)
    # as many updates for a small sample as for a full one, within reason
    epochs = epochs or min(5 * EPOCHS, max(EPOCHS, 2 * SAMPLE * EPOCHS // len(texts)))
    place: dict[str, int] = {}
    docs = [np.fromiter((place.setdefault(w, len(place)) for w in t.split()), np.int64) for t in texts]
    words = list(map(plain, place))
    seen = Counter(w for d in docs for w in {words[k] for k in set(d.tolist())})
    vocabulary = [w for w, n in sorted(seen.items(), key=lambda x: (-x[1], x[0])) if n > 1]  # the sample bounds them
    index = {w: k + 1 for k, w in enumerate(vocabulary)}
    rows = np.array([index.get(w, 0) for w in words])
    gram_ids, gram_count = grams(words)
    gram_at = np.concatenate([[0], np.cumsum(gram_count)])
    label = np.array(labels, np.float32)
    p = start(vocabulary, seed)
    moment, square, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    flat = np.concatenate(docs)
    base = np.concatenate([[0], np.cumsum([len(d) for d in docs])[:-1]])
    at = [windows(len(d)) for d in docs]
    owner = np.repeat(np.arange(len(docs)), [len(x) for x in at])
    starts, left = np.concatenate([base[k] + x for k, x in enumerate(at)]), np.concatenate([len(docs[k]) - x for k, x in enumerate(at)])
    m, mask = _matrix(flat.astype(np.int32), starts, left)
    first = np.concatenate([[0], np.cumsum([len(x) for x in at])[:-1]])
    count = np.array([len(x) for x in at])

    def score() -> np.ndarray:
        return logits(p, inputs(p, rows, gram_ids, gram_count), m, mask)

    def top(s: np.ndarray) -> np.ndarray:
        order = np.lexsort((s, owner))
        return order[np.cumsum(count) - 1]

    for epoch in range(epochs):
        any_ = first + (rng.random(len(docs)) * count).astype(np.int64)
        if epoch == 0:
            chosen = np.concatenate([first + (rng.random(len(docs)) * count).astype(np.int64) for _ in range(3)])
        else:
            chosen = np.concatenate([top(score()), any_[label == 0]])
        rng.shuffle(chosen)
        rate = RATE * (1 - 0.8 * epoch / epochs)
        for k in range(0, len(chosen), BATCH):
            pick = chosen[k : k + BATCH]
            own, ids = np.unique(m[pick], return_inverse=True)
            grams_ = np.concatenate([gram_ids[gram_at[j] : gram_at[j + 1]] for j in own])
            row = np.where(rng.random(len(own)) < DROP, 0, rows[own])  # so that characters must tell, too
            _, g = loss_and_gradient(p, row, grams_, gram_count[own], ids.reshape(len(pick), WINDOW), mask[pick], label[owner[pick]])
            step += 1
            for name, v in g.items():
                if name in ("word", "gram"):  # rows without a gradient rest
                    on = np.unique(row if name == "word" else grams_)
                    v, target, mo, sq = v[on], p[name], moment[name], square[name]
                    mo[on], sq[on] = 0.9 * mo[on] + 0.1 * v, 0.99 * sq[on] + 0.01 * v * v
                    target[on] -= rate * (mo[on] / (1 - 0.9**step)) / (np.sqrt(sq[on] / (1 - 0.99**step)) + 1e-6)
                else:
                    moment[name] = 0.9 * moment[name] + 0.1 * v
                    square[name] = 0.99 * square[name] + 0.01 * v * v
                    p[name] -= (rate * (moment[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    best = np.maximum.reduceat(score(), first)
    a, b = 1.0, 0.0
    weight = np.where(label == 1, 0.5 / max(label.mean(), 1e-9), 0.5 / max(1 - label.mean(), 1e-9))
    for _ in range(400):  # Platt's two numbers, classes weighted alike
        y = _sigmoid(a * best + b)
        d = (y - np.where(label == 1, 0.98, 0.02)) * weight
        a, b = a - 0.05 * float((d * best).mean()), b - 0.05 * float(d.mean())
    return {"p": p, "index": index, "a": max(a, 1e-3), "b": b}


def folded(doc_id) -> F.Column:
    """crc32 of doc_id as text, modulo 5; 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Train on at most ``sample`` documents of each class whose doc_id is not held out, in the order of a hash of
    doc_id until `SAMPLE_BYTES` of text are reached.

    Labels other than 0 and 1, null ids, documents without words and texts over `TEXT_BYTES` are left out. If a class
    has no document, the model is the constant share of class 1."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").where(folded(F.col("doc_id")) != 0)
    share = known.agg(F.avg("toxic")).first()[0]
    few = [known.where(F.col("toxic") == k).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id")).limit(sample) for k in (0, 1)]
    ids = {r[0]: r[1] for part in few for r in part.collect()}
    spark = docs.sparkSession
    picked = spark.createDataFrame(list(ids.items()), "doc_id long, toxic int")  # at most 2 * sample rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") <= TEXT_BYTES).join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum(F.octet_length("text")).over(before)).where(F.col("upto") <= SAMPLE_BYTES).collect()
    rows = sorted((r for r in rows if r["text"] and r["text"].split()), key=lambda r: r["doc_id"])
    prior = float(share) if share is not None else 0.0
    if len({r["toxic"] for r in rows}) < 2:
        return {"prior": prior}
    return train([r["text"] for r in rows], [r["toxic"] for r in rows]) | {"prior": prior}


def score(docs: DataFrame, model: dict, column: str = "score") -> DataFrame:
    """``docs`` with the score of every row's text as a last column.

    A null, empty or blank text gets the share of toxic labels (at most 0.49). Rows are scored one by one, so null
    doc_ids and repeated rows need no rule; an empty table gives no rows. A column that has the score's name is
    replaced."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(column)
    place, names = docs.columns.index("text"), [*docs.columns, column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        words = Words(m["p"], m["index"]) if "p" in m else None
        for batch in batches:
            out = np.full(batch.num_rows, min(m["prior"], 0.49))
            if words:
                best = worst(m["p"], words, batch.column(place).to_pylist())
                out = np.where(np.isnan(best), out, _sigmoid(m["a"] * best + m["b"]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=names)

    plain_names = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))  # names may hold anything
    return plain_names.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))
