"""Language ID with a bidirectional gated recurrent network over bytes, trained
in numpy by backpropagation through time. Every position of a text gets its own
label probabilities; a document's are their mean.

A text is read whole, in windows of WINDOW bytes; within a window one network
runs forward and one backward, and each byte is labelled from both states. The
cost is linear in the bytes and the memory is that of a slice of windows, so
very long texts need no special care.

Training: at most PER_LANGUAGE labelled documents for each language, those with
the smallest hashes of id, and of each at most CROPS windows at hashed places.
This bounded sample is the only data that reaches the driver; the fitted
network (some ten thousand numbers) is broadcast. Prediction covers every row
and uses nothing but the text.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text if there is no labelled row. Rows with a null label or null
text are not learnt from. Ties go to the label that sorts first. Repeated rows
each get their result. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import groups, small
from quire.session import cut_lineage

PER_LANGUAGE = 500
CROPS = 4
WINDOW = 96
HIDDEN = 8
STEPS = 350
BATCH = 192
RATE = 0.02

_LETTER = regex.compile(r"\p{L}")


def _squash(a: np.ndarray, t: np.ndarray) -> None:
    """a / (1 + |a|) in place; t is work space."""
    np.abs(a, out=t)
    t += 1
    a /= t


class Direction:
    """One gated recurrent network: x (256 x 3H) holds what each byte adds to the
    update gate, the reset gate and the candidate; u (H x 3H) what the state adds.
    Gates and candidate are squashed by a / (1 + |a|), which costs a sixth of exp."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.h = hidden
        self.x = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.u = rng.normal(0, 0.4, (hidden, 3 * hidden)).astype(np.float32)

    def steps(self, rows: list[np.ndarray]) -> Iterator[np.ndarray]:
        """States after each row of bytes; a later row may be of more windows (which begin
        there) or of fewer (the last have ended). The state array is reused."""
        n, most = self.h, max(map(len, rows))
        x, u = self.x.astype(np.float32), self.u.astype(np.float32)
        xg, xc, ug, uc = (np.ascontiguousarray(a) for a in (x[:, :2 * n], x[:, 2 * n:], u[:, :2 * n], u[:, 2 * n:]))
        h, (g, t), (c, s) = np.zeros((most, n), np.float32), np.empty((2, most, 2 * n), np.float32), np.empty((2, most, n), np.float32)
        for row in rows:
            k = len(row)
            hk, gk, tk, ck, sk = h[:k], g[:k], t[:k], c[:k], s[:k]
            np.take(xg, row, 0, out=gk, mode="clip")
            gk += np.matmul(hk, ug, out=tk)
            _squash(gk, tk)
            gk += 1
            gk *= 0.5
            np.matmul(hk, uc, out=sk)
            sk *= gk[:, n:]
            np.take(xc, row, 0, out=ck, mode="clip")
            ck += sk
            _squash(ck, sk)
            hk -= ck
            hk *= gk[:, :n]
            hk += ck
            yield hk

    def forward(self, bytes_: np.ndarray) -> tuple[np.ndarray, list]:
        """All states, and what backpropagation needs."""
        n, h = self.h, np.zeros((bytes_.shape[1], self.h), np.float32)
        states, kept = [], []
        for row in bytes_:
            s = h @ self.u
            a = self.x[row]
            g = a[:, :2 * n] + s[:, :2 * n]
            g = (1 + g / (1 + np.abs(g))) / 2
            z, r = g[:, :n], g[:, n:]
            c = a[:, 2 * n:] + r * s[:, 2 * n:]
            c = c / (1 + np.abs(c))
            kept.append((row, h, z, r, s[:, 2 * n:], c))
            h = c + z * (h - c)
            states.append(h)
        return np.array(states), kept

    def backward(self, kept: list, d_states: np.ndarray) -> list[np.ndarray]:
        """Gradients of x and u, through time from the last step to the first."""
        du, rows, added = np.zeros_like(self.u), [], []
        dh = np.zeros_like(d_states[0])
        for (row, before, z, r, s, c), d in zip(reversed(kept), d_states[::-1]):
            dh = dh + d
            dc = dh * (1 - z) * (1 - np.abs(c))**2
            dz = dh * (before - c) * (1 - np.abs(2 * z - 1))**2 / 2
            dr = dc * s * (1 - np.abs(2 * r - 1))**2 / 2
            da = np.concatenate((dz, dr, dc), 1)
            ds = np.concatenate((dz, dr, dc * r), 1)
            rows.append(row)
            added.append(da)
            du += before.T @ ds
            dh = dh * z + ds @ self.u.T
        byte, da = np.concatenate(rows), np.concatenate(added)
        dx = np.stack([np.bincount(byte, column, 256) for column in da.T], 1).astype(self.x.dtype)
        return [dx, du]


class Network:
    """Both directions and the label layer."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.ahead, self.back = Direction(rng, hidden), Direction(rng, hidden)
        self.v = rng.normal(0, 0.3, (2 * hidden, len(labels))).astype(np.float32)
        self.c = np.zeros(len(labels), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.x, self.ahead.u, self.back.x, self.back.u, self.v, self.c]

    def gradients(self, bytes_: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all positions (time x windows), and its gradients."""
        a, kept_a = self.ahead.forward(bytes_)
        b, kept_b = self.back.forward(bytes_[::-1])
        both = np.concatenate((a, b[::-1]), 2)
        scores = both @ self.v + self.c
        scores -= scores.max(-1, keepdims=True)
        p = np.exp(scores)
        p /= p.sum(-1, keepdims=True)
        weight = mask / mask.sum()
        columns = np.arange(len(label))
        loss = -(np.log(p[:, columns, label] + 1e-9) * weight).sum()
        p[:, columns, label] -= 1
        p *= weight[:, :, None]
        d = p @ self.v.T
        n = self.ahead.h
        return float(loss), [*self.ahead.backward(kept_a, d[:, :, :n]), *self.back.backward(kept_b, d[::-1, :, n:]),
                             np.einsum("tbi,tbj->ij", both, p), p.sum((0, 1))]

    def fit(self, windows: list[bytes], label: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 3) -> float:
        """Adam over random batches; batches are drawn evenly over the labels."""
        rng, mean, square, loss = np.random.default_rng(seed), [0.0] * 6, [0.0] * 6, 0.0
        by_label = [np.flatnonzero(label == k) for k in range(len(self.labels))]
        by_label = [x for x in by_label if len(x)]
        grid, mask = padded(windows)
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(x, max(1, batch // len(by_label))) for x in by_label])
            loss, grads = self.gradients(grid[:, pick], mask[:, pick], label[pick])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            for k, (value, g) in enumerate(zip(self.parameters(), grads)):
                g = g / max(1.0, norm)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                pace = rate * min(1.0, 2 - 2 * step / (steps + 1))
                value -= (pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return loss

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean label probabilities over all positions of each text (empty text: zeros)."""
        k, size = len(self.labels), np.array([len(t) for t in texts])
        n = -(-size // WINDOW)
        out = np.zeros((len(texts), k))
        if not n.sum():
            return out
        grid = np.frombuffer(b"".join(t.ljust(m * WINDOW, b"\0") for t, m in zip(texts, n.tolist())), np.uint8).reshape(-1, WINDOW)
        length = np.full(len(grid), WINDOW)
        length[np.cumsum(n)[n > 0] - 1] = (size - (n - 1) * WINDOW)[n > 0]
        order = np.argsort(-length, kind="stable")  # so the windows with a byte t come first
        own, length = np.repeat(np.arange(len(texts)), n)[order], length[order]
        active = np.searchsorted(-length, -np.arange(WINDOW), "left")
        grid = grid[order].T.astype(np.intp)
        rows = [row[:c] for row, c in zip(grid, active.tolist()) if c]
        h, ones = self.ahead.h, np.ones(k, np.float32)
        ahead = [state @ self.v[:h] + self.c for state in self.ahead.steps(rows)]
        total = np.zeros((len(length), k), np.float32)
        for p, state in zip(ahead[::-1], self.back.steps(rows[::-1])):
            p += state @ self.v[h:]
            np.clip(p, -40, 40, out=p)
            np.exp(p, out=p)
            p /= (p @ ones)[:, None]
            total[:len(p)] += p
        np.add.at(out, own, total)
        return out / np.maximum(size, 1)[:, None]


def padded(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(time x windows) bytes and mask; short windows are repeated to full length."""
    grid = np.array([np.frombuffer((w * (WINDOW // len(w) + 1))[:WINDOW], np.uint8) for w in windows]).T
    return grid, np.ones(grid.shape, np.float32)


def _crops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"lang": [], "id": [], "fp": [], "crop": []}
        for lang, where, name, fp, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "h", "id", "fp", "text"))):
            data = text.encode("utf-8", "replace")
            rng = np.random.default_rng(where & 0xFFFFFFFF)
            last = max(0, len(data) - WINDOW)
            for at in sorted({0, *rng.integers(0, last + 1, CROPS - 1).tolist()}):
                if data[at:at + WINDOW].strip():
                    for key, value in zip(out, (lang, name, fp, data[at:at + WINDOW])):
                        out[key].append(value)
        yield pa.RecordBatch.from_pydict(out, pa.schema([("lang", pa.string()), ("id", pa.string()),
                                                         ("fp", pa.int64()), ("crop", pa.binary())]))


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Network | None:
    """A network fitted to the bounded sample of the rows for which ``learn`` holds; None
    without any. The sample has ``per_language`` texts of each language, or all if there
    are fewer: rows that repeat id, language and text are one, rows of one id with
    different texts are several, and a null id is an id like any other. Only their
    windows reach the driver, ``CROPS`` a text at most."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"), learn.alias("learn"))
    known = (rows.filter(F.col("learn") & F.col("lang").isNotNull() & (F.length("text") > 0))
             .withColumn("h", F.xxhash64("id")).withColumn("fp", F.xxhash64("text")))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("h", "id", "fp"))
    texts = known.select("lang", "h", "id", "fp").distinct().withColumn("rank", rank)
    key = ("lang", "h", "id", "fp")
    picked = cut_lineage(texts.filter(F.col("rank") <= per_language).select(*(F.col(c).alias("_" + c) for c in key)))
    keys = [F.col(c).eqNullSafe(F.col("_" + c)) for c in key]
    some = known.join(small(picked), keys, "left_semi").select("lang", "h", "id", "fp", "text")
    # rows that repeat one another give equal windows, and these are one before they leave the tasks
    crops = (some.mapInArrow(_crops, "lang string, id string, fp long, crop binary").distinct()
             .select("lang", "crop").toPandas().sort_values(["lang", "crop"]))
    if crops.empty:
        return None
    labels = sorted(set(crops["lang"]))
    network = Network(labels)
    network.fit([bytes(c) for c in crops["crop"]], np.searchsorted(labels, crops["lang"].to_numpy(str)))
    return network


_FOUND = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict(docs: DataFrame, network: Network | None, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with column ``out``: lang_pred and score of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    @F.arrow_udf(_FOUND)
    def label(texts: pa.Array) -> pa.Array:
        net, names, scores = sent.value, [], []
        for _, some in groups(texts, 1 << 18):
            pooled = net.pooled(some) if net else np.zeros((len(some), 1))
            for text, p in zip(some, pooled):
                known = net is not None and _LETTER.search(text.decode("utf-8", "replace")) is not None
                names.append(net.labels[int(p.argmax())] if known else "und")
                scores.append(min(1.0, float(p.max())) if known else 0.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return docs.withColumn(out, label(F.col(text_col).cast("string")))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: CRC-32 of the id as text leaves 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
