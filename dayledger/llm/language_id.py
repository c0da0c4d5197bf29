"""Language identification by a byte convolutional network.

Texts are cut into windows of ``WINDOW`` bytes. Embedded bytes pass filters of
several widths, the largest output of each filter over a window goes through a
softmax layer. The network is trained in numpy on the driver from windows of a
bounded sample of labelled texts, and scores every window of every text; a text's
probabilities are the mean over its windows, weighted by their length.

For scoring, the embedding is folded into the filters: the output of a filter of
width w is a sum of w table rows, looked up by byte, for pairs of bytes at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.common import joined, steps, text_of, tidy

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: Most labelled texts the network is trained on, unless more languages than that are
#: labelled, and windows of each.
SAMPLE_ROWS = 3000
SAMPLE_WINDOWS = 3
UNDETERMINED = "und"


@dataclass
class Network:
    labels: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray

    def fold(self) -> None:
        """Tables of filter outputs: for byte pairs, and for the odd third byte."""
        e = self.embedding
        parts = [[e @ f[k] for k in range(len(f))] for f in self.filters]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        self.tables = []
        for own, bias in zip(parts, self.biases, strict=True):
            tables = [pair(own[k], own[k + 1]) for k in range(0, len(own) - 1, 2)]
            if len(own) % 2:
                tables.append(own[-1])
            tables[0] = tables[0] + bias
            self.tables.append([t.astype(np.float32) for t in tables])

    def features(self, data: np.ndarray) -> np.ndarray:
        """Filter outputs, pooled over each row of a matrix of bytes."""
        pairs = data[:, :-1].astype(np.int32) * 256 + data[:, 1:]
        out = []
        for tables, filters in zip(self.tables, self.filters, strict=True):
            width = len(filters)
            n = data.shape[1] - width + 1
            total = np.take(tables[0], pairs[:, :n], axis=0)
            for k, table in enumerate(tables[1:], 1):
                total += np.take(table, (pairs if len(table) > 256 else data)[:, 2 * k : 2 * k + n], axis=0)
            out.append(total.max(axis=1))
        return np.maximum(np.concatenate(out, axis=1), 0)

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        return softmax(self.features(data) @ self.dense + self.offset)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, targets: np.ndarray, labels: list[str], epochs: int = 6, seed: int = 3) -> Network:
    """Fit the network to byte windows by Adam on the cross-entropy."""
    draw = np.random.default_rng(seed)
    normal = lambda *s, scale: (draw.standard_normal(s) * scale).astype(np.float32)
    net = Network(
        labels,
        normal(256, EMBEDDING, scale=0.5),
        [normal(w, EMBEDDING, FILTERS, scale=1 / np.sqrt(w * EMBEDDING)) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        normal(FILTERS * len(WIDTHS), len(labels), scale=0.1),
        np.zeros(len(labels), np.float32),
    )
    net.embedding[0] = 0
    weights = [net.embedding, *net.filters, *net.biases, net.dense, net.offset]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step = 0
    share = np.bincount(targets, minlength=len(labels)) / max(1, len(targets))
    weight = (1 / np.maximum(share, 1e-3)) / len(labels)
    for _ in range(epochs):
        order = draw.permutation(len(windows))
        for low in range(0, len(order), 64):
            rows = order[low : low + 64]
            gradients = _gradients(net, windows[rows], targets[rows], weight)
            step += 1
            for w, g, m, v in zip(weights, gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    net.fold()
    return net


def _gradients(net: Network, data: np.ndarray, targets: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    rows, n = data.shape
    x = net.embedding[data]
    best, pooled = [], []
    for f, b in zip(net.filters, net.biases, strict=True):
        width = len(f)
        out = sum(x[:, k : n - width + 1 + k] @ f[k] for k in range(width)) + b
        at = out.argmax(axis=1)
        best.append(at)
        pooled.append(np.take_along_axis(out, at[:, None, :], 1)[:, 0])
    hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
    p = softmax(hidden @ net.dense + net.offset)
    p[np.arange(rows), targets] -= 1
    p *= (weight[targets] / rows)[:, None].astype(np.float32)
    back = (p @ net.dense.T) * (hidden > 0)
    g_embedding = np.zeros_like(net.embedding)
    g_filters, g_biases = [], []
    for j, (f, at) in enumerate(zip(net.filters, best, strict=True)):
        g = back[:, j * FILTERS : (j + 1) * FILTERS]
        g_f = np.zeros_like(f)
        for k in range(len(f)):
            own = data[np.arange(rows)[:, None], at + k]
            g_f[k] = np.einsum("rfe,rf->ef", net.embedding[own], g)
            np.add.at(g_embedding, own, g[:, :, None] * f[k].T[None])
        g_filters.append(g_f)
        g_biases.append(g.sum(axis=0))
    return [g_embedding, *g_filters, *g_biases, hidden.T @ p, p.sum(axis=0)]


def fit(
    labelled: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
) -> Network | None:
    """Train on windows of about ``sample_rows`` rows, those with the smallest hash of
    the id for each label. Labels share the rows evenly: rare ones are learned whole,
    and every label has a row at least. Rows without label or letter are no examples;
    without any example there is no network (None)."""
    whole = text_of(text)
    labelled = labelled.where(F.col(label).isNotNull())
    size = F.greatest(F.char_length(whole) - WINDOW, F.lit(0)) + 1
    windows = F.array(
        *(
            whole.substr(F.lit(1) + F.pmod(F.xxhash64(F.col(id_column), F.lit(k)), size).cast("int"), F.lit(WINDOW))
            for k in range(SAMPLE_WINDOWS)
        )
    )
    labelled = labelled.where(has_letter(whole))
    sizes = {r[0]: r[1] for r in labelled.groupBy(F.col(label)).count().collect()}
    shares = {x: (n, own) for (x, n), own in zip(sizes.items(), even_shares(list(sizes.values()), sample_rows), strict=True)}
    examples = labelled.select(
        F.xxhash64(F.col(id_column)).alias("h"), F.col(label).alias("label"), windows.alias("windows")
    )
    rows = sample_by_label(examples, shares).collect() if shares else []
    rows.sort(key=lambda r: (r["h"], r["label"], r["windows"]))
    if not rows:
        return None
    labels = sorted({r["label"] for r in rows})
    number = {x: i for i, x in enumerate(labels)}
    pairs = [(w.encode()[:WINDOW], number[r["label"]]) for r in rows for w in dict.fromkeys(r["windows"])]
    data = np.zeros((len(pairs), WINDOW), np.uint8)
    for i, (w, _) in enumerate(pairs):
        data[i, : len(w)] = np.frombuffer(w, np.uint8)
    return train(data, np.array([t for _, t in pairs]), labels)


def even_shares(sizes: list[int], total: int) -> list[int]:
    """How many of each size to take: all of the small ones, as many of each other as
    ``total`` leaves, one at least."""
    taken, left = [0] * len(sizes), total
    order = sorted(range(len(sizes)), key=lambda i: sizes[i])
    for k, i in enumerate(order):
        taken[i] = min(sizes[i], max(1, left // (len(order) - k)))
        left -= taken[i]
    return taken


def sample_by_label(examples: DataFrame, shares: dict) -> DataFrame:
    """Of each label the rows with the smallest ``h``: ``shares`` has its rows and how
    many to take. A bound on the hash leaves about twice as many before they are
    ranked by label, map side first."""
    bounds = [(x, own, (1 << 63) - 1 if n <= 4 * own else -(1 << 63) + int(2 * own / n * (1 << 64))) for x, (n, own) in shares.items()]
    kind = examples.schema["label"].dataType.simpleString()
    wanted = examples.sparkSession.createDataFrame(bounds, f"label {kind}, own long, bound long")
    near = examples.join(F.broadcast(wanted), "label").where("h <= bound")
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h"))
    return near.withColumn("rank", rank).where("rank <= own").select("h", "label", "windows")


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def text_probabilities(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probabilities over the windows of each text, weighted by their bytes."""
    sizes = np.diff(offsets)
    n_windows = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(sizes)), n_windows)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    begin = offsets[:-1][doc] + k * WINDOW
    width = np.minimum(WINDOW, offsets[1:][doc] - begin)
    total = np.zeros((len(sizes), len(net.labels)))
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    views = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)
    columns = np.arange(WINDOW)
    for low in range(0, len(doc), 64):
        part = slice(low, low + 64)
        rows = views[begin[part]] * (columns < width[part, None])
        np.add.at(total, doc[part], net.probabilities(rows) * width[part, None])
    return total / np.maximum(sizes, 1)[:, None]


def predict(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the probability of that language.

    Every byte of a text is in one window. Null texts, texts without a letter, and
    all texts where there was nothing to learn from get ``und`` and score 0. Other
    columns stay; any of those two names are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    marked = docs.withColumn("lang_pred", has_letter(F.col(text)).cast("string")).withColumn("score", F.lit(0.0))
    if net is None:
        return marked.withColumn("lang_pred", F.lit(UNDETERMINED))
    shared = spark.sparkContext.broadcast(net)

    def score(batches):
        net = shared.value
        for batch in batches:
            names = batch.schema.names
            lettered = np.array([x == "true" for x in batch.column(names.index("lang_pred")).to_pylist()], bool)
            data, offsets = joined(batch.column(names.index(text)).cast(pa.binary()))
            best, scores = np.zeros(len(lettered), int), np.zeros(len(lettered))
            for part in steps(np.diff(offsets)):
                low = offsets[part.start]
                p = text_probabilities(net, data[low : offsets[part.stop]], offsets[part.start : part.stop + 1] - low)
                best[part], scores[part] = p.argmax(axis=1), p.max(axis=1)
            new = {
                "lang_pred": [net.labels[b] if own else UNDETERMINED for b, own in zip(best, lettered, strict=True)],
                "score": np.where(lettered, np.clip(scores, 0, 1), 0.0),
            }
            yield pa.RecordBatch.from_arrays(
                [pa.array(new[n], batch.schema.field(i).type) if n in new else batch.column(i) for i, n in enumerate(names)],
                schema=batch.schema,
            )

    return marked.mapInArrow(tidy(score), marked.schema)
