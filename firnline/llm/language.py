"""Language identification by a bidirectional gated recurrent network over bytes.

One layer of gated recurrent units reads the UTF-8 bytes forwards, one backwards; at every position a softmax over
both states labels that byte, and a document's probabilities are the mean over all its positions. The network is trained in
numpy by backpropagation through time with Adam, in one task, on a bounded sample: at most about ``fit_docs`` labelled
documents, shared out evenly over the languages and chosen by a hash of the id, ``FIT_WINDOWS`` windows of each from anywhere in
the text. Scoring runs on the documents' own partitions over whole texts, cut into windows of nearly equal
length (``WINDOW`` bytes at most) that are one batch of the network; both states start anew in a window.

Cases: null texts and texts without a letter are ``und`` with score 0; documents without a language or with an empty text are
not learned from; repeated rows and extra columns are treated like any others; of equal probabilities the
first language by name wins; with one language known that one has score 1; with none everything is ``und``; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import per_batch, text_of

UNITS = 12
WINDOW = 128
BATCH = 2_048
FIT_DOCS = 2_000
FIT_WINDOWS = 4
FIT_LENGTH = 64
STEPS = 300
UNKNOWN = "und"


@dataclass
class Network:
    """Parameters by name: ``e`` (byte to gates), ``u`` (state to gates), ``c`` (bias of the state's part in the
    candidate), ``w`` (state to labels), each for directions 0 and 1, and ``bias``."""

    languages: list[str]
    p: dict[str, np.ndarray]


def initial(languages: list[str], units: int, seed: int, kind=np.float32) -> Network:
    rng, p = np.random.default_rng(seed), {"bias": np.zeros(len(languages), dtype=kind)}
    for d in "01":
        p["e" + d] = (rng.standard_normal((256, 3 * units)) * 0.3).astype(kind)
        p["e" + d][:, :units] += 1  # at first the state is mostly kept
        p["u" + d] = (rng.standard_normal((units, 3 * units)) * units ** -0.5).astype(kind)
        p["c" + d] = np.zeros(units, dtype=kind)
        p["w" + d] = (rng.standard_normal((units, len(languages))) * 0.3).astype(kind)
    return Network(languages, p)


def run_direction(p: dict, d: str, x: np.ndarray, live: np.ndarray | None, keep: bool = False):
    """States after every step, (steps, rows, units); with ``keep`` also what the gradient needs.

    A sigmoid is ``(1 + tanh(a / 2)) / 2``: the halves go into the parameters, so that a step is three look-ups, three
    products and a few passes over contiguous arrays.
    """
    units, half = len(p["u" + d]), p["u" + d].dtype.type(0.5)
    steps, rows = x.shape
    ez, er, en = (np.ascontiguousarray(g) for g in np.split(p["e" + d], 3, axis=1))
    uz, ur, un = (np.ascontiguousarray(g) * half for g in np.split(p["u" + d], 3, axis=1))
    ez, er, bias = ez * half, er * half, p["c" + d] * half
    out = np.empty((steps, rows, units), dtype=half.dtype)
    z, r, new, part, product = (np.empty((rows, units), dtype=half.dtype) for _ in range(5))
    h, kept = np.zeros((rows, units), dtype=half.dtype), []
    for t in range(steps) if d == "0" else range(steps - 1, -1, -1):
        at = x[t].astype(np.intp)
        for table, weights, gate in ((ez, uz, z), (er, ur, r)):
            np.take(table, at, axis=0, out=gate, mode="clip")
            np.matmul(h, weights, out=product)
            gate += product
            np.tanh(gate, out=gate)
        np.matmul(h, un, out=part)
        part += bias
        np.take(en, at, axis=0, out=new, mode="clip")
        new += part
        np.multiply(r, part, out=product)
        new += product
        np.tanh(new, out=new)
        if keep:
            kept.append((t, h, (1 + z) * half, (1 + r) * half, part * 2, new.copy()))
        after = out[t]
        np.subtract(h, new, out=product)
        product *= z
        np.add(h, new, out=after)
        after += product
        after *= half
        if live is not None:
            after *= live[t][:, None]
        h = after
    return (out, kept) if keep else out


def position_scores(net: Network, x: np.ndarray, live: np.ndarray | None) -> np.ndarray:
    """Softmax at every position, (languages, steps, rows)."""
    p = net.p
    scores = sum(p["w" + d].T @ run_direction(p, d, x, live).reshape(x.size, -1).T for d in "01")
    scores += p["bias"][:, None]
    scores -= scores.max(axis=0)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=0)
    return scores.reshape(-1, *x.shape)


def loss_and_gradient(net: Network, x: np.ndarray, live: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy over the live positions, and its gradient by every parameter (through time)."""
    p, grads = net.p, {}
    units = len(p["u0"])
    runs = {d: run_direction(p, d, x, live, keep=True) for d in "01"}
    scores = sum(runs[d][0] @ p["w" + d] for d in "01") + p["bias"]
    scores = scores - scores.max(axis=2, keepdims=True)
    scores -= np.log(np.exp(scores).sum(axis=2, keepdims=True))
    weight = live / live.sum()
    rows = np.arange(x.shape[1])
    loss = -float((scores[:, rows, label] * weight).sum())
    given = np.exp(scores)
    given[:, rows, label] -= 1
    given *= weight[:, :, None]
    grads["bias"] = given.sum(axis=(0, 1))
    order = np.argsort(x.ravel(), kind="stable")
    seen, starts = np.unique(x.ravel()[order], return_index=True)
    for d in "01":
        out, kept = runs[d]
        u = p["u" + d]
        grads["w" + d] = np.tensordot(out, given, axes=([0, 1], [0, 1]))
        from_labels = given @ p["w" + d].T
        by_byte = np.empty((*x.shape, 3 * units), dtype=u.dtype)
        du, dc, dh = np.zeros_like(u), np.zeros(units, dtype=u.dtype), np.zeros((x.shape[1], units), dtype=u.dtype)
        for t, h, z, r, part, new in reversed(kept):
            dh = (dh + from_labels[t]) * live[t][:, None]
            d_new = dh * (1 - z) * (1 - new * new)
            d_z = dh * (h - new) * z * (1 - z)
            d_r = d_new * part * r * (1 - r)
            by_byte[t] = np.concatenate([d_z, d_r, d_new], axis=1)
            d_state = np.concatenate([d_z, d_r, d_new * r], axis=1)
            du += h.T @ d_state
            dc += d_state[:, 2 * units:].sum(axis=0)
            dh = dh * z + d_state @ u.T
        de = np.zeros_like(p["e" + d])
        de[seen] = np.add.reduceat(by_byte.reshape(-1, 3 * units)[order], starts, axis=0)
        grads |= {"e" + d: de, "u" + d: du, "c" + d: dc}
    return loss, grads


def train(languages: list[str], windows: list[bytes], label: np.ndarray, units: int = UNITS, steps: int = STEPS,
          rows: int = 128, rate: float = 0.02, seed: int = 12) -> Network:
    """The network after ``steps`` batches of ``rows`` windows, the languages in equal parts."""
    net, rng = initial(languages, units, seed), np.random.default_rng(seed)
    by_label = [np.flatnonzero(label == k) for k in range(len(languages))]
    mean = {k: np.zeros_like(v) for k, v in net.p.items()}
    square = {k: np.zeros_like(v) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        drawn = np.concatenate([rng.choice(of, -(-rows // len(by_label))) for of in by_label])
        batch = [windows[i] for i in drawn]
        length = max(map(len, batch))
        x = np.frombuffer(b"".join(w.ljust(length, b"\0") for w in batch), dtype=np.uint8).reshape(-1, length).T
        live = (np.arange(length)[:, None] < np.array([len(w) for w in batch])).astype(np.float32)
        _, grads = loss_and_gradient(net, np.ascontiguousarray(x), live, label[drawn])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        pace = rate * (1 - (step - 1) / steps) * min(1.0, 1.0 / max(size, 1e-9))
        for k, g in grads.items():
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            net.p[k] -= (pace * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-7)
                         ).astype(net.p[k].dtype)
    return net


def document_scores(net: Network, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int = WINDOW,
                    batch: int = BATCH) -> np.ndarray:
    """Mean label probabilities over all bytes of every text, given as places in ``data``; zeros for empty texts."""
    pieces = -(-lengths // window)
    size = -(-lengths // np.maximum(pieces, 1))
    owner = np.repeat(np.arange(len(lengths)), pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = number * size[owner]
    span = np.minimum(size[owner], lengths[owner] - begin)
    begin = begin + starts[owner]
    sums = np.zeros((len(lengths), len(net.languages)))
    # Windows of like length run together, so that little of a batch is padding.
    by_span = np.argsort(span, kind="stable")
    for i in range(0, len(by_span), batch):
        at = by_span[i:i + batch]
        steps = np.arange(int(span[at].max()))[:, None]
        live = steps < span[at]
        x = data[np.minimum(begin[at] + steps, len(data) - 1)]
        if live.all():
            added = position_scores(net, x, None).sum(axis=1)
        else:
            mask = live.astype(net.p["bias"].dtype)
            added = (position_scores(net, x, mask) * mask).sum(axis=1)
        for k, values in enumerate(added):
            sums[:, k] += np.bincount(owner[at], values, len(sums))
    return sums / np.maximum(lengths, 1)[:, None]


def held_out() -> Column:
    """True for the fifth of the ids that is never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, **options) -> Network | None:
    """The network learned from ``text`` and ``lang`` of the rows given, or None where no language is known."""
    known = docs.filter(F.col("lang").isNotNull() & (F.length(text_of("text")) > 0)).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    each = max(1, fit_docs // len(counts))
    shares = docs.sparkSession.createDataFrame(
        [(k, min(1.0, each / n) * (1 << 32)) for k, n in counts.items()], "lang string, share double")
    # One row a language.
    drawn = (known.join(F.broadcast(shares), "lang")
             .filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32)) < F.col("share"))
             .select("lang", "text", F.xxhash64("doc_id", "text").alias("h")))

    def cut(batches):
        for batch in batches:
            out = []
            for lang, text, h in zip(*(batch[c].to_pylist() for c in ("lang", "text", "h"))):
                raw = text.encode("utf-8", "surrogatepass")
                rng = np.random.default_rng(zlib.crc32(str(h).encode()))
                out += [(lang, raw[a:a + FIT_LENGTH]) for a in
                        rng.integers(0, max(1, len(raw) - FIT_LENGTH + 1), FIT_WINDOWS).tolist()]
            yield pa.RecordBatch.from_pydict({"lang": pa.array([x for x, _ in out], pa.string()),
                                              "window": pa.array([w for _, w in out], pa.binary())})

    windows = drawn.mapInArrow(cut, "lang string, window binary")
    # At most about ``fit_docs * FIT_WINDOWS`` windows of 64 bytes, whatever the corpus: one task trains.

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by([("lang", "ascending"), ("window", "ascending")])
        names, texts = group["lang"].to_pylist(), group["window"].to_pylist()
        languages = sorted(set(names))
        net = train(languages, texts, np.array([languages.index(n) for n in names]), **options)
        return pa.table({
            "languages": pa.array([languages], pa.list_(pa.string())), "names": pa.array([list(net.p)], pa.list_(pa.string())),
            "shapes": pa.array([[list(v.shape) for v in net.p.values()]], pa.list_(pa.list_(pa.int32()))),
            "values": pa.array([[v.astype("<f4").tobytes() for v in net.p.values()]], pa.list_(pa.binary()))})

    made = windows.groupBy(F.lit(0).alias("all")).applyInArrow(
        learn, "languages array<string>, names array<string>, shapes array<array<int>>, values array<binary>").first()
    if made is None:
        return None
    return Network(list(made["languages"]), {
        n: np.frombuffer(bytes(v), dtype="<f4").reshape(s).copy()
        for n, s, v in zip(made["names"], made["shapes"], made["values"])})


def predicted(docs: DataFrame, net: Network | None, text: str = "text") -> Column:
    """Column: struct of ``lang`` and ``score``."""
    kind = "struct<lang:string,score:double>"
    unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    if net is None:
        return unknown
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        model = sent.value

        def act(texts: pa.Array) -> pa.Array:
            raw = texts.cast(pa.large_binary())
            ends = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + len(raw) + 1]
            data = np.frombuffer(raw.buffers()[2] or b"\0", dtype=np.uint8)
            scores = document_scores(model, data, ends[:-1], ends[1:] - ends[:-1])
            best = scores.argmax(axis=1)
            return pa.StructArray.from_arrays(
                [pa.array([model.languages[k] for k in best], pa.string()),
                 pa.array(np.clip(scores[np.arange(len(best)), best], 0, 1), pa.float64())], ["lang", "score"])

        return act

    return F.when(text_of(text).rlike(r"\p{L}"), per_batch(make, kind)(text_of(text))).otherwise(unknown)
