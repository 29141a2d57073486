"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage is encoded
by the make-up of its words; a gated attention layer learns from the document labels
which passages speak for the document, and the attention-weighted sum of the passages'
representations is scored. Fitting takes a bounded sample; scoring is one pass over the
documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.langid import mixed
from pulsemart.llm.text import coded_words, pieces, value_bytes
from pulsemart.session import cut_lineage

# Words of a passage; the last one of a document may be shorter.
PASSAGE = 64
# Bound of the labelled sample, on average; a smaller table is used whole.
FIT_DOCUMENTS = 2000
HIDDEN, GATE = 24, 12
STEPS, RATE, DECAY = 200, 0.02, 1e-3
SIGNS = 16
THRESHOLD = 0.7
SEED = 7

# Byte classes: lower, upper, digit, sentence mark, quote or bracket, other mark, beyond ASCII.
CLASSES = 7


def _byte_classes() -> np.ndarray:
    table = np.full(256, 5, dtype=np.int64)
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[[ord(c) for c in ".,;:!?"]] = 3
    table[[ord(c) for c in "\"'()[]{}-"]] = 4
    table[128:] = 6
    return table


CLASS_OF = _byte_classes()
FEATURES = 2 * CLASSES + 3 + SIGNS


def word_features(vocabulary: pa.Array) -> np.ndarray:
    """One row per word: shares of byte classes, class of the last byte, length, case, hashed signs."""
    n = len(vocabulary)
    out = np.zeros((FEATURES, n), dtype=np.float32)
    if not n:
        return out
    lengths = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(value_bytes(vocabulary), dtype=np.uint8)
    starts = np.cumsum(lengths) - lengths
    kind = CLASS_OF[data]
    counts = np.bincount(np.repeat(np.arange(n), lengths) * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
    out[:CLASSES] = (counts / lengths[:, None]).T
    out[CLASSES + kind[starts + lengths - 1], np.arange(n)] = 1
    out[2 * CLASSES] = np.minimum(lengths, 40) / 10
    out[2 * CLASSES + 1] = (counts[:, 1] > 1) & (counts[:, 0] == 0)
    out[2 * CLASSES + 2] = (counts[:, 0] + counts[:, 1] + counts[:, 2] + counts[:, 6]) == 0
    place = (np.arange(len(data)) - np.repeat(starts, lengths)).astype(np.uint64)
    digest = mixed(np.add.reduceat(mixed(data.astype(np.uint64) + (place << np.uint64(8))), starts))
    for bit in range(SIGNS):
        out[2 * CLASSES + 3 + bit] = np.where(digest >> np.uint64(bit) & np.uint64(1), 1, -1)
    return out


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors and, for each text, how many it has; a text without words has one of zeros.

    A vector is the mean of the passage's word features, the share of its word pairs that
    are new in the document, and its length.
    """
    words = coded_words(texts)
    features = word_features(words.vocabulary)
    size = np.diff(words.starts)
    passages = np.maximum(-(-size // PASSAGE), 1)
    text = np.repeat(np.arange(len(size)), passages)
    first = words.starts[:-1][text] + PASSAGE * (np.arange(len(text)) - np.repeat(np.cumsum(passages) - passages, passages))
    length = np.clip(words.starts[1:][text] - first, 0, PASSAGE)
    out = np.zeros((len(text), FEATURES + 2), dtype=np.float32)
    there = length > 0
    if there.any():
        at = first[there]
        for j in range(FEATURES):
            out[there, j] = np.add.reduceat(features[j][words.codes], at) / length[there]
        out[there, FEATURES] = np.add.reduceat(new_pairs(words.codes, words.texts), at) / length[there]
    out[:, FEATURES + 1] = length / PASSAGE
    return out, passages


def new_pairs(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """1 where a word and the one before it stand together for the first time in their text."""
    size = np.uint64(codes.max() + 2)
    before = np.concatenate([[-1], codes[:-1]])
    before[np.flatnonzero(np.diff(owner, prepend=-1))] = -1
    pair = mixed(mixed(owner.astype(np.uint64)) + (before + 1).astype(np.uint64) * size + codes.astype(np.uint64))
    new = np.zeros(len(codes), dtype=np.float32)
    new[np.unique(pair, return_index=True)[1]] = 1
    return new


@dataclass
class QualityModel:
    """Weights of the encoder (w), the gated attention (v, u, a) and the scorer (c)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def scores(self, texts: pa.Array) -> np.ndarray:
        x, passages = encode(texts)
        return forward(self.weights, (x - self.mean) / self.scale, passages)["p"]


def forward(w: dict[str, np.ndarray], x: np.ndarray, passages: np.ndarray) -> dict[str, np.ndarray]:
    start = np.cumsum(passages) - passages
    h = np.tanh(x @ w["w"] + w["wb"])
    t = np.tanh(h @ w["v"])
    s = 1 / (1 + np.exp(-(h @ w["u"])))
    e = (t * s) @ w["a"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, start), passages))
    attention = e / np.repeat(np.add.reduceat(e, start), passages)
    z = np.add.reduceat(attention[:, None] * h, start, axis=0)
    p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["cb"][0], -30, 30)))
    return {"h": h, "t": t, "s": s, "attention": attention, "z": z, "p": p}


def gradients(w: dict[str, np.ndarray], x: np.ndarray, passages: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss plus weight decay."""
    f = forward(w, x, passages)
    delta = (f["p"] - y) / len(y)
    dz = np.repeat(delta, passages)[:, None] * w["c"][None, :]
    through = (dz * f["h"]).sum(axis=1)
    start = np.cumsum(passages) - passages
    average = np.repeat(np.add.reduceat(f["attention"] * through, start), passages)
    de = f["attention"] * (through - average)
    dt = de[:, None] * w["a"] * f["s"] * (1 - f["t"] ** 2)
    ds = de[:, None] * w["a"] * f["t"] * f["s"] * (1 - f["s"])
    dh = f["attention"][:, None] * dz + dt @ w["v"].T + ds @ w["u"].T
    dx = dh * (1 - f["h"] ** 2)
    out = {
        "w": x.T @ dx, "wb": dx.sum(axis=0), "v": f["h"].T @ dt, "u": f["h"].T @ ds,
        "a": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ delta, "cb": np.array([delta.sum()]),
    }
    return {k: g + DECAY * w[k] * (k in ("w", "c")) for k, g in out.items()}


def train(x: np.ndarray, passages: np.ndarray, y: np.ndarray) -> QualityModel:
    """Adam on all documents at once, from fixed random weights."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = ((x - mean) / scale).astype(np.float32)
    random = np.random.default_rng(SEED)
    shapes = {"w": (x.shape[1], HIDDEN), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE)}
    w = {k: random.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()}
    w |= {"wb": np.zeros(HIDDEN), "a": random.normal(0, 0.3, GATE), "c": random.normal(0, 0.3, HIDDEN), "cb": np.zeros(1)}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, STEPS + 1):
        for k, g in gradients(w, x, passages, y).items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            w[k] = (w[k] - RATE * move).astype(np.float32)
    return QualityModel(mean, scale, w)


def trusted_rows() -> Column:
    """Rows the model may learn from: crc32 of the id as text, modulo 4, is not 2."""
    return F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)


def fit_quality(docs: DataFrame, labels: DataFrame, trusted: Column | None = None) -> QualityModel | None:
    """Train on labelled documents, about ``FIT_DOCUMENTS`` at most, picked by a hash of the id; whole texts.

    None if there is no labelled document. Several labels of a document count as the lowest.
    """
    trusted = F.col("doc_id").isNotNull() if trusted is None else trusted
    known = labels.where(F.col("quality").isNotNull() & trusted)
    share = min(1.0, FIT_DOCUMENTS / max(known.count(), 1))
    uniform = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    known = known.where(uniform < share).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    picked = docs.select("doc_id", "text").where(trusted & (uniform < share))
    # As many rows as the sample's bound.
    sample = picked.join(F.broadcast(known), "doc_id").select("doc_id", "quality", "text")

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            x, passages = encode(piece.column("text"))
            ends = np.cumsum(passages)
            bags = [x[a:b].tobytes() for a, b in zip(ends - passages, ends)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").cast(pa.string()), piece.column("quality"), pa.array(bags, pa.binary())],
                ["id", "quality", "bag"],
            )

    rows = cut_lineage(sample.mapInArrow(compute, "id string, quality int, bag binary"), "quality-sample")
    table = rows.orderBy("id", "bag").toArrow()
    if not table.num_rows:
        return None
    bags = [np.frombuffer(b, dtype=np.float32).reshape(-1, FEATURES + 2) for b in table.column("bag").to_pylist()]
    labels_ = (table.column("quality").to_numpy() > 0).astype(np.float32)
    return train(np.concatenate(bags), np.array([len(b) for b in bags]), labels_)


def score_quality(docs: DataFrame, model: QualityModel | None, id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted.

    Null and empty texts are one empty passage and scored as such; without a model every
    score is 0.5. Repeated rows come back as often as they are there, an empty table gives
    no rows, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            model = shared.value
            found = np.full(piece.num_rows, 0.5) if model is None else model.scores(piece.column("text")).astype(float)
            columns = [piece.column("doc_id"), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("doc_id"), "text").mapInArrow(
        score, f"doc_id {kind}, score double, predicted int"
    )
