"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads windows of WINDOW bytes in both directions; at each position its two states give the probability of
each language (every position is labelled), and a document's probabilities are the mean over all positions of its whole
text. It is trained in numpy by backpropagation through time with Adam, and broadcast (some kB). The sample is one of
labelled windows: each window of each text that is not held out has the same chance to be in it, for each language the one
that gives about SAMPLE windows, or fewer where there are very many languages. All languages are learnt.

Defined results: null texts and texts without a letter are `und` with score 0; without training rows everything is `und`;
repeated rows each get their prediction; other columns are ignored; of equal probabilities the language that comes first
in the alphabet is taken; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_arrow

HIDDEN = 8
WINDOW = 96
#: About the most windows of each language, and of all together, that a model is fitted on.
SAMPLE = 1200
SAMPLE_ALL = 40_000
EPOCHS = 6
BATCH = 128
RATE = 0.02
#: Windows worked on at once.
WIDTH = 2048
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}").search

Weights = dict[str, np.ndarray]


def new_weights(n_langs: int, seed: int = 3) -> Weights:
    rng = np.random.default_rng(seed)
    w: Weights = {}
    for d in "fb":  # forwards, backwards. Rows: update gate, reset gate, candidate
        w[f"x{d}"] = rng.normal(0, 0.3, (3 * HIDDEN, 256)).astype(np.float32)
        w[f"u{d}"] = rng.normal(0, HIDDEN**-0.5, (3 * HIDDEN, HIDDEN)).astype(np.float32)
    w["o"] = rng.normal(0, HIDDEN**-0.5, (n_langs, 2 * HIDDEN)).astype(np.float32)
    w["c"] = np.zeros((n_langs, 1), np.float32)
    return w


def gate(x: np.ndarray) -> np.ndarray:
    """The piecewise linear sigmoid: 0 to 1, of slope 1/4 around 0."""
    return np.clip(0.25 * x + 0.5, 0, 1)


def read(x: np.ndarray, table: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
    """States (time, HIDDEN, windows) of one direction over bytes x (time, windows), and what training needs."""
    h = np.zeros((HIDDEN, x.shape[1]), np.float32)
    states, notes = np.empty((len(x), HIDDEN, x.shape[1]), np.float32), []
    for t in range(len(x)):
        g = np.take(table, x[t], axis=1)
        gates = gate(g[: 2 * HIDDEN] + u[: 2 * HIDDEN] @ h)
        z, r = gates[:HIDDEN], gates[HIDDEN:]
        c = np.tanh(g[2 * HIDDEN :] + u[2 * HIDDEN :] @ (r * h))
        notes.append((h, z, r, c))
        h = h + z * (c - h)
        states[t] = h
    return states, notes


def read_fast(x: np.ndarray, table: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The states alone, without new arrays in the loop. The gates' slope and offset are folded into the weights."""
    two, n = 2 * HIDDEN, x.shape[1]
    table, u = table.copy(), u.copy()
    table[:two] = 0.25 * table[:two] + 0.5
    u[:two] *= 0.25
    h, states = np.zeros((HIDDEN, n), np.float32), np.empty((len(x), HIDDEN, n), np.float32)
    g, gates, c = np.empty((3 * HIDDEN, n), np.float32), np.empty((two, n), np.float32), np.empty((HIDDEN, n), np.float32)
    for t in range(len(x)):
        np.take(table, x[t], axis=1, out=g, mode="clip")
        np.matmul(u[:two], h, out=gates)
        gates += g[:two]
        np.clip(gates, 0, 1, out=gates)
        r = gates[HIDDEN:]
        r *= h
        np.matmul(u[two:], r, out=c)
        c += g[two:]
        np.tanh(c, out=c)
        c -= h
        c *= gates[:HIDDEN]
        h = np.add(h, c, out=states[t])
    return states


def probabilities(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-2, keepdims=True))
    return e / e.sum(axis=-2, keepdims=True)


def gradients(w: Weights, x: np.ndarray, mask: np.ndarray, lang: np.ndarray) -> tuple[float, Weights]:
    """Mean loss over all positions, and its gradients by backpropagation through time. mask: (time, windows)."""
    steps, n = x.shape
    f, notes_f = read(x, w["xf"], w["uf"])
    b, notes_b = read(x[::-1], w["xb"], w["ub"])
    both = np.concatenate([f, b[::-1]], axis=1)
    p = probabilities(w["o"] @ both + w["c"])
    at = (np.arange(steps)[:, None], lang[None, :], np.arange(n)[None, :])
    weight = mask / max(mask.sum(), 1)
    loss = float(-(np.log(p[at] + 1e-9) * weight).sum())
    d = p.copy()
    d[at] -= 1
    d *= weight[:, None, :]
    g: Weights = {"o": np.einsum("tkn,thn->kh", d, both), "c": d.sum((0, 2))[:, None]}
    back = np.einsum("kh,tkn->thn", w["o"], d)
    for name, notes, xs, ds in (("f", notes_f, x, back[:, :HIDDEN]), ("b", notes_b, x[::-1], back[::-1, HIDDEN:])):
        u, gu, gx = w[f"u{name}"], np.zeros_like(w[f"u{name}"]), np.zeros((256, 3 * HIDDEN), np.float32)
        dh = np.zeros((HIDDEN, n), np.float32)
        for t in reversed(range(steps)):
            h, z, r, c = notes[t]
            dh = dh + ds[t]
            dc = dh * z * (1 - c * c)
            drh = u[2 * HIDDEN :].T @ dc
            dz, dr = 0.25 * dh * (c - h) * ((z > 0) & (z < 1)), 0.25 * drh * h * ((r > 0) & (r < 1))
            gates = np.concatenate([dz, dr])
            gu[: 2 * HIDDEN] += gates @ h.T
            gu[2 * HIDDEN :] += dc @ (r * h).T
            np.add.at(gx, xs[t], np.concatenate([gates, dc]).T)
            dh = dh * (1 - z) + drh * r + u[: 2 * HIDDEN].T @ gates
        g[f"u{name}"], g[f"x{name}"] = gu, gx.T
    return loss, g


def fit(x: np.ndarray, mask: np.ndarray, lang: np.ndarray, n_langs: int, seed: int = 3) -> Weights:
    """Adam over windows x (windows, WINDOW)."""
    w, rng = new_weights(n_langs, seed), np.random.default_rng(seed)
    m, v = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}
    step, total = 0, EPOCHS * max(1, len(x) // BATCH)
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
            step += 1
            _, g = gradients(w, x[at].T, mask[at].T, lang[at])
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                w[k] -= (RATE * (1 - 0.9 * step / total) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return w


def windows(raw: bytes) -> np.ndarray:
    """Bytes as rows of WINDOW, the last one filled up with zeros."""
    n = -(-len(raw) // WINDOW)
    return np.frombuffer(raw + bytes(n * WINDOW - len(raw)), np.uint8).reshape(n, WINDOW)


def document_probabilities(w: Weights, raws: list[bytes]) -> np.ndarray:
    """(documents, languages): the mean over all positions. No text is empty."""
    sizes = np.array([len(r) for r in raws])
    n_win = -(-sizes // WINDOW)
    x = np.concatenate([windows(r) for r in raws])
    left = np.concatenate([np.minimum(WINDOW, s - WINDOW * np.arange(n)) for s, n in zip(sizes, n_win, strict=True)])
    sums = np.empty((len(x), len(w["o"])))
    for k in range(0, len(x), WIDTH):
        bytes_ = np.ascontiguousarray(x[k : k + WIDTH].T).astype(np.intp)
        f = read_fast(bytes_, w["xf"], w["uf"])
        b = read_fast(bytes_[::-1], w["xb"], w["ub"])
        total = np.zeros((len(w["o"]), bytes_.shape[1]), np.float32)
        size = left[k : k + WIDTH]
        for t in range(WINDOW):
            e = np.exp(w["o"][:, :HIDDEN] @ f[t] + w["o"][:, HIDDEN:] @ b[WINDOW - 1 - t] + w["c"])
            e /= e.sum(axis=0)
            total += e if (size > t).all() else e * (size > t)
        sums[k : k + WIDTH] = total.T
    return np.add.reduceat(sums, np.cumsum(n_win) - n_win, axis=0) / sizes[:, None]


def sample(docs: DataFrame, size: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Languages, windows, masks and labels of about `size` windows a language at most, of texts that aren't held out.

    A window's chance is drawn by its document's id, so it is the same each time. A doc_id that repeats with one text is one
    document. The driver gets a count for each language, and the sample.
    """
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).where(F.octet_length("text") > 0)
    n = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.sum(F.ceil(F.octet_length("text") / WINDOW)).alias("n")).collect()}
    langs = sorted(n)
    if not langs:
        return [], np.empty((0, WINDOW), np.uint8), np.empty((0, WINDOW), np.float32), np.empty(0, np.int64)
    size = max(1, min(size, SAMPLE_ALL // len(langs)))
    sent = docs.sparkSession.sparkContext.broadcast({k: min(1.0, size / n[k]) for k in langs})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = sent.value
        for batch in batches:
            rows = []
            for seed, lang, text in zip(*(batch.column(c).to_pylist() for c in ("seed", "lang", "text")), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                drawn = np.random.default_rng(seed).random(-(-len(raw) // WINDOW)) < share[lang]
                rows += [(lang, seed, at, raw[at : at + WINDOW]) for at in (np.flatnonzero(drawn) * WINDOW).tolist()]
            cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["lang", "seed", "at", "raw"])

    seeded = known.select(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 62)).alias("seed"), "lang", "text")
    got = sorted((k, bytes(r)) for k, _, _, r in map_arrow(seeded, run, "lang string, seed long, at long, raw binary").distinct().collect())
    langs = sorted({k for k, _ in got})
    x = np.concatenate([windows(r) for _, r in got])
    mask = np.array([np.arange(WINDOW) < len(r) for _, r in got], np.float32)
    place = {k: i for i, k in enumerate(langs)}
    return langs, x, mask, np.array([place[k] for k, _ in got])


def identify(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    langs, x, mask, y = sample(docs, size)
    sent = docs.sparkSession.sparkContext.broadcast((langs, fit(x, mask, y, len(langs)) if langs else {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, w = sent.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            raws, at, size = [], [], 0
            for i, t in enumerate([*texts, None]):
                if i == len(texts) or size > WIDTH * WINDOW * 4:
                    if raws:
                        p = document_probabilities(w, raws)
                        for k, row in zip(at, p, strict=True):
                            pred[k], score[k] = names[int(row.argmax())], float(row.max())
                    raws, at, size = [], [], 0
                if t and names and LETTER(t):
                    raws.append(t.encode("utf-8", "surrogatepass"))
                    at.append(i)
                    size += len(raws[-1])
            yield pa.record_batch([batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(np.minimum(score, 1.0))], names=["doc_id", "lang_pred", "score"])

    out = map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
