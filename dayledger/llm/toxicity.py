"""Toxicity scores from a bidirectional gated recurrent network.

Windows of ``WINDOW`` words that overlap by half run through a GRU in either
direction; words are runs of letters, digits and non-ASCII characters. The input of a word is the embedding of the word beside the mean of the
embeddings of its character pairs; attention weights pool the states of a window
before a logistic output. A text scores as its worst window. The network is trained
in numpy on the driver from a bounded sample of labelled texts, a text's loss being
that of its worst window at the time, and scores every window of every text.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import (
    ALNUM_BYTES,
    FOLD_CASE,
    STEP_BYTES,
    WordHasher,
    hashed_sample,
    joined,
    steps,
    text_of,
    word_spans,
)

WINDOW = 24
STRIDE = WINDOW // 2
HIDDEN = 12
WORD_SIZE = 12
CHAR_SIZE = 6
WORD_BUCKETS = 1 << 15
PAIR_BUCKETS = 1 << 10
THRESHOLD = 0.7
#: Most clean and most toxic texts that the network is trained on, and the most
#: windows of one of them; longer texts are drawn from by chance.
SAMPLE_ROWS = (2400, 800)
SAMPLE_WINDOWS = 32
#: Characters of a text that is learned from whole, and of a stretch of a longer one.
WHOLE_CHARS = 20_000
STRETCH_CHARS = 500
#: Windows that one step of the recurrence handles together.
LANES = 4096

_hasher = WordHasher(9, fold_case=True)


@dataclass
class Network:
    words: np.ndarray
    chars: np.ndarray
    inputs: np.ndarray  # 2 x (word + char) x 3 hidden
    states: np.ndarray  # 2 x hidden x 3 hidden
    biases: np.ndarray  # 2 x 3 hidden
    attention: np.ndarray  # 2 hidden x 2 hidden
    context: np.ndarray  # 2 hidden
    output: np.ndarray  # 2 hidden
    offset: np.ndarray  # 1

    def weights(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    @staticmethod
    def fresh(seed: int) -> Network:
        draw = np.random.default_rng(seed)
        normal = lambda *s, scale: (draw.standard_normal(s) * scale).astype(np.float32)
        size, both = WORD_SIZE + CHAR_SIZE, 2 * HIDDEN
        return Network(
            normal(WORD_BUCKETS, WORD_SIZE, scale=0.1),
            normal(PAIR_BUCKETS, CHAR_SIZE, scale=0.3),
            normal(2, size, 3 * HIDDEN, scale=1 / np.sqrt(size)),
            normal(2, HIDDEN, 3 * HIDDEN, scale=1 / np.sqrt(HIDDEN)),
            np.zeros((2, 3 * HIDDEN), np.float32),
            normal(both, both, scale=1 / np.sqrt(both)),
            normal(both, scale=1 / np.sqrt(both)),
            normal(both, scale=0.3),
            np.full(1, -1, np.float32),
        )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Vocabulary:
    """The distinct words of some texts: word buckets and character pairs."""

    buckets: np.ndarray
    pairs: np.ndarray
    owner: np.ndarray
    counts: np.ndarray




def read_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Vocabulary]:
    """The word number and document of each word; hashes and parts of the distinct words."""
    starts, ends, doc = word_spans(data, offsets, ALNUM_BYTES)
    hashes = _hasher(data, starts, ends)
    distinct, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    low, high = starts[first], ends[first]
    # character pairs, with the edges of the word as characters of their own
    size = high - low + 1
    owner = np.repeat(np.arange(len(distinct)), size)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
    folded = FOLD_CASE[data].astype(np.int64)
    folded = np.concatenate([folded, [0]])
    left = np.where(at == low[owner], 0, folded[at - 1])
    right = np.where(at == high[owner], 0, folded[np.minimum(at, len(folded) - 1)])
    pairs = (left * 31 + right * 257) % PAIR_BUCKETS
    buckets = (distinct % np.uint64(WORD_BUCKETS)).astype(np.int64)
    return number, doc, distinct, Vocabulary(buckets, pairs, owner, size)


def read_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, Vocabulary]:
    """The same for many texts, read some at a time."""
    numbers, docs, hashes, parts, seen = [], [], [], [], 0
    for part in steps(np.array([len(t) for t in texts], np.int64), STEP_BYTES // 2):
        own = texts[part]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in own])]).astype(np.int64)
        number, doc, distinct, vocabulary = read_words(np.frombuffer(b"".join(own), np.uint8), offsets)
        numbers.append(number + seen)
        docs.append(doc + part.start)
        hashes.append(distinct)
        parts.append(vocabulary)
        seen += len(distinct)
    _, first, number = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    whole = Vocabulary(*(np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(Vocabulary)))
    return number[np.concatenate(numbers)], np.concatenate(docs), _select(whole, first)


def word_inputs(net: Network, v: Vocabulary) -> np.ndarray:
    """The input of each distinct word: its embedding and that of its characters."""
    n = len(v.buckets)
    if not n:
        return np.zeros((0, WORD_SIZE + CHAR_SIZE), np.float32)
    begin = np.cumsum(v.counts) - v.counts
    chars = np.add.reduceat(net.chars[v.pairs], begin, axis=0) / v.counts[:, None]
    return np.concatenate([net.words[v.buckets], chars.astype(np.float32)], axis=1)


def windows(number: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of every window (-1 beyond its end), and its document. Windows
    begin every ``STRIDE`` words; a text's last one ends with the text."""
    counts = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(counts) - counts
    n_windows = np.where(counts > 0, np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1), 0)
    own = np.repeat(np.arange(n_docs), n_windows)
    k = np.arange(len(own)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    begin = np.minimum(k * STRIDE, np.maximum(counts[own] - WINDOW, 0))
    at = begin[:, None] + np.arange(WINDOW)
    inside = at < counts[own][:, None]
    padded = np.concatenate([number, [0]])
    return np.where(inside, padded[np.minimum(first[own][:, None] + at, len(number))], -1), own


def run(net: Network, projected: np.ndarray, rows: np.ndarray, keep: bool = False):
    """Logits of windows. ``projected``: gate inputs of the distinct words, for each
    direction, with a row of zeros at the end for places beyond a window."""
    lanes, length = rows.shape
    inside = (rows >= 0).astype(np.float32)
    states = np.empty((length, lanes, 2 * HIDDEN), np.float32)
    trace = []
    for side in (0, 1):
        h = np.zeros((lanes, HIDDEN), np.float32)
        steps_ = range(length) if side == 0 else range(length - 1, -1, -1)
        u, mine = net.states[side], slice(side * HIDDEN, (side + 1) * HIDDEN)
        for t in steps_:
            x = projected[side][rows[:, t]]
            g = h @ u
            zr = sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
            m = inside[:, t : t + 1]
            new = h + m * (1 - z) * (n - h)
            if keep:
                trace.append((side, t, h, z, r, n, g[:, 2 * HIDDEN :], m))
            h = new
            states[t, :, mine] = h
    hidden = np.tanh(states @ net.attention)
    scores = hidden @ net.context
    scores = np.where(inside.T > 0, scores, -30)
    weights = np.exp(scores - scores.max(axis=0))
    weights *= inside.T
    weights /= np.maximum(weights.sum(axis=0), 1e-9)
    pooled = np.einsum("tl,tlh->lh", weights, states)
    logits = pooled @ net.output + net.offset[0]
    return (logits, (states, hidden, weights, pooled, trace, inside)) if keep else logits


def project(net: Network, inputs: np.ndarray) -> list[np.ndarray]:
    empty = np.zeros((1, 3 * HIDDEN), np.float32)
    return [np.concatenate([inputs @ net.inputs[s] + net.biases[s], empty]) for s in (0, 1)]


def gradients(net: Network, v: Vocabulary, rows: np.ndarray, targets: np.ndarray) -> list[np.ndarray]:
    """Of the mean logistic loss of some windows, for each weight."""
    lanes = len(rows)
    inputs = word_inputs(net, v)
    projected = project(net, inputs)
    logits, (states, hidden, weights, pooled, trace, _) = run(net, projected, rows, keep=True)
    d = ((sigmoid(logits) - targets) / lanes).astype(np.float32)
    g_output, g_offset = pooled.T @ d, np.array([d.sum()], np.float32)
    d_pooled = d[:, None] * net.output
    d_weights = np.einsum("lh,tlh->tl", d_pooled, states)
    d_scores = weights * (d_weights - (weights * d_weights).sum(axis=0))
    g_context = np.einsum("tl,tlh->h", d_scores, hidden)
    d_hidden = d_scores[:, :, None] * net.context * (1 - hidden**2)
    g_attention = np.einsum("tlh,tlk->hk", states, d_hidden)
    d_states = weights[:, :, None] * d_pooled + d_hidden @ net.attention.T
    d_projected = [np.zeros_like(p) for p in projected]
    g_states = np.zeros_like(net.states)
    carried = {0: np.zeros((lanes, HIDDEN), np.float32), 1: np.zeros((lanes, HIDDEN), np.float32)}
    for side, t, h, z, r, n, gn, m in reversed(trace):
        mine = slice(side * HIDDEN, (side + 1) * HIDDEN)
        dh = carried[side] + d_states[t][:, mine]
        dn = m * (1 - z) * dh * (1 - n**2)
        dz = m * dh * (h - n) * z * (1 - z)
        dr = dn * gn * r * (1 - r)
        dg = np.concatenate([dz, dr, dn * r], axis=1)
        np.add.at(d_projected[side], rows[:, t], np.concatenate([dz, dr, dn], axis=1))
        g_states[side] += h.T @ dg
        carried[side] = dh * (1 - m * (1 - z)) + dg @ net.states[side].T
    own = [p[:-1] for p in d_projected]
    g_inputs = np.stack([inputs.T @ p for p in own])
    g_biases = np.stack([p.sum(axis=0) for p in own])
    d_inputs = own[0] @ net.inputs[0].T + own[1] @ net.inputs[1].T
    g_words = np.zeros_like(net.words)
    np.add.at(g_words, v.buckets, d_inputs[:, :WORD_SIZE])
    g_chars = np.zeros_like(net.chars)
    np.add.at(g_chars, v.pairs, (d_inputs[:, WORD_SIZE:] / v.counts[:, None])[v.owner])
    return [g_words, g_chars, g_inputs, g_states, g_biases, g_attention, g_context, g_output, g_offset]


def train(texts: list[bytes], targets: np.ndarray, seed: int = 9) -> Network:
    """Fit the network to four of five texts, and its offset to the fifth, so that
    ``THRESHOLD`` parts the labels there as well as any value does."""
    fifth = np.arange(len(texts)) % 5 == 4
    if min(np.bincount(targets[fifth], minlength=2)) == 0:
        return learn(texts, targets, seed)
    pick = lambda mask: [t for t, own in zip(texts, mask.tolist(), strict=True) if own]
    net = learn(pick(~fifth), targets[~fifth], seed)
    held = pick(fifth)
    data, offsets = np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)])
    worst = np.concatenate(
        [
            text_logits(net, data[offsets[p.start] : offsets[p.stop]], offsets[p.start : p.stop + 1] - offsets[p.start])
            for p in steps(np.diff(offsets), STEP_BYTES // 2)
        ]
    )
    order = np.argsort(worst)
    ranked, toxic = worst[order], targets[fifth][order]
    # the cut before each value: toxic texts from there on, less clean ones
    gain = np.append(np.cumsum((toxic / toxic.sum() - (1 - toxic) / (1 - toxic).sum())[::-1])[::-1], 0)
    best = int(np.argmax(gain))
    around = np.clip(ranked[[max(best - 1, 0), min(best, len(ranked) - 1)]], -20, 20)
    net.offset -= np.float32(around.mean() - np.log(THRESHOLD / (1 - THRESHOLD)))
    return net


def learn(texts: list[bytes], targets: np.ndarray, seed: int, rounds: int = 8) -> Network:
    """Each round finds the worst window of each text, then learns from these
    windows and as many random ones of clean texts."""
    net = Network.fresh(seed)
    draw = np.random.default_rng(seed)
    number, doc, vocabulary = read_texts(texts)
    rows, own = windows(number, doc, len(texts))
    kept = np.ones(len(rows), bool)
    counts = np.bincount(own, minlength=len(texts))
    for d in np.flatnonzero(counts > SAMPLE_WINDOWS):
        mine = np.flatnonzero(own == d)
        kept[mine] = False
        kept[draw.choice(mine, SAMPLE_WINDOWS, replace=False)] = True
    rows, own = rows[kept], own[kept]
    used, place = np.unique(rows, return_inverse=True)
    vocabulary = _select(vocabulary, used[used >= 0])
    rows = place.reshape(rows.shape) - int(used[0] < 0)
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    step = 0
    for k in range(rounds):
        logits = _logits(net, vocabulary, rows)
        ranked = np.lexsort((logits if k else draw.random(len(rows)), own))
        last = np.flatnonzero(np.diff(np.append(own[ranked], -1)))
        worst = ranked[last]
        # besides, a random window of each clean text: all of its windows are clean
        clean = np.flatnonzero(targets[own] == 0)
        extra = draw.choice(clean, min(len(clean), len(worst)), replace=False) if len(clean) else clean
        chosen = draw.permutation(np.concatenate([worst, extra]))
        if k == 0:  # nothing is known yet of which window it is: all windows count
            toxic = np.flatnonzero(targets[own] == 1)
            some = draw.choice(clean, min(len(clean), 2 * len(toxic)), replace=False) if len(clean) else clean
            chosen = draw.permutation(np.concatenate([toxic, some]))
        for low in range(0, len(chosen), 128):
            at = chosen[low : low + 128]
            used, local = np.unique(rows[at], return_inverse=True)
            local = local.reshape(rows[at].shape)
            if used[0] == -1:
                used, local = used[1:], local - 1
            part = _select(vocabulary, used)
            found = gradients(net, part, local, targets[own[at]].astype(np.float32))
            step += 1
            size = np.sqrt(sum(float((g * g).sum()) for g in found))
            shrink = min(1.0, 1.0 / max(size, 1e-9))
            for w, g, m, v in zip(net.weights(), found, first, second, strict=True):
                m += 0.1 * (shrink * g - m)
                v += 0.01 * ((shrink * g) ** 2 - v)
                w -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


def _select(v: Vocabulary, used: np.ndarray) -> Vocabulary:
    begin = np.cumsum(v.counts) - v.counts
    size = v.counts[used]
    owner = np.repeat(np.arange(len(used)), size)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[used], size)
    return Vocabulary(v.buckets[used], v.pairs[at], owner, size)


def _logits(net: Network, v: Vocabulary, rows: np.ndarray) -> np.ndarray:
    projected = project(net, word_inputs(net, v))
    parts = [run(net, projected, rows[low : low + LANES]) for low in range(0, len(rows), LANES)]
    return np.concatenate(parts) if parts else np.zeros(0, np.float32)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_rows: tuple[int, int] = SAMPLE_ROWS,
) -> Network | None:
    """Train on at most ``sample_rows`` texts of the labels 0 and 1, those with the
    smallest hash of the id; of a text beyond ``WHOLE_CHARS`` characters, stretches of
    it at hashed places. Null labels and empty texts are no examples. An id that
    repeats is one example, of its greatest label and its least text. Without
    examples of both there is no network (None).

    Only ids and labels are shuffled; the chosen ids, a bounded number, are sent to
    where the texts are.
    """
    whole = text_of(text)
    given = labels.select(F.col(id_column).alias("id"), F.col(label).alias("label")).where("label in (0, 1)")
    given = given.groupBy("id").agg(F.max("label").alias("label"))
    there = docs.where(F.length(F.trim(whole)) > 0).select(F.col(id_column).alias("id")).distinct()
    known = there.join(given, "id").select("id", "label", F.xxhash64("id").alias("h"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    picked = [hashed_sample(known.where(F.col("label") == k), sample_rows[k], sizes[k]) for k in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    place = F.col("id_hash"), F.char_length("whole") - STRETCH_CHARS
    stretches = F.transform(
        F.sequence(F.lit(0), F.lit(WHOLE_CHARS // STRETCH_CHARS - 1)),
        lambda i: F.col("whole").substr((F.pmod(F.xxhash64(place[0], i), place[1]) + 1).cast("int"), F.lit(STRETCH_CHARS)),
    )
    own = docs.select(F.col(id_column).alias("id"), F.xxhash64(F.col(id_column)).alias("id_hash"), whole.alias("whole"))
    part = F.when(F.char_length("whole") <= WHOLE_CHARS, F.col("whole")).otherwise(F.concat_ws(" ", stretches))
    texts = own.where(F.length(F.trim("whole")) > 0).join(F.broadcast(chosen), "id")
    rows = texts.groupBy("h", "label").agg(F.min(part).alias("part")).collect()
    rows.sort(key=lambda r: (r["label"], r["h"], r["part"]))
    return train([r["part"].encode() for r in rows], np.array([r["label"] for r in rows]))


def text_scores(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The probability of the worst window of each text; 0 for texts without words."""
    worst = text_logits(net, data, offsets)
    return np.where(np.isinf(worst), 0.0, sigmoid(worst))


def text_logits(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The largest logit of the windows of each text, -inf where there is none."""
    number, doc, _, vocabulary = read_words(data, offsets)
    rows, own = windows(number, doc, len(offsets) - 1)
    worst = np.full(len(offsets) - 1, -np.inf)
    np.maximum.at(worst, own, _logits(net, vocabulary, rows))
    return worst


def score(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on).

    All overlapping windows of every text are scored. Null texts and texts without a
    letter or digit score 0, as do all texts where there was nothing to learn from.
    Other columns stay; any of those two names are replaced. An empty table gives no
    rows.
    """
    marked = docs.withColumn("score", F.lit(0.0))
    if net is not None:
        shared = docs.sparkSession.sparkContext.broadcast(net)

        def compute(batches):
            for batch in batches:
                names = batch.schema.names
                data, offsets = joined(batch.column(names.index(text)).cast(pa.binary()))
                scores = np.zeros(batch.num_rows)
                for part in steps(np.diff(offsets)):
                    low = offsets[part.start]
                    own = offsets[part.start : part.stop + 1] - low
                    scores[part] = text_scores(shared.value, data[low : offsets[part.stop]], own)
                at = names.index("score")
                yield batch.set_column(at, batch.schema.field(at), pa.array(scores))

        marked = marked.mapInArrow(compute, marked.schema)
    return marked.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
