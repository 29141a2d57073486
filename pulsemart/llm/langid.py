"""Language identification by interpolated Kneser-Ney character models, one per language.

A word is padded with one blank on either side and each of its characters (the closing
blank included) is predicted from up to ``ORDER - 1`` characters of the same word. Per
order the model is a sorted array of n-gram hashes with one log probability per
language, and a sorted array of context hashes with one log back-off weight per
language; a prediction is a binary search from the highest order down. The language with
the lowest cross-entropy per character wins, unless it lies further above that
language's usual cross-entropy than any document it was calibrated on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.text import Words, coded_words, pieces
from pulsemart.session import cut_lineage

ORDER = 5
# Bound of the sample the models are fitted on: documents per language, the whole of each.
FIT_DOCUMENTS = 400
# Further documents per language on which the rejection is calibrated.
CALIBRATE_DOCUMENTS = 200
# Room above the worst calibration document, and the least excess that counts, in nats per
# character of a long text: few calibration documents say little about the worst one.
MARGIN, ROOM = 1.5, 1.2
# Cross-entropy of a text varies less the longer it is, up to this many characters.
STEADY = 400
# Different words whose characters are held at once.
WORDS_AT_ONCE = 1 << 15
UNKNOWN = "und"
BLANK = 0x20
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of products spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Characters:
    """Characters of padded words, one after the other; ``place`` counts from 0 inside a word."""

    points: np.ndarray
    word: np.ndarray
    place: np.ndarray

    def grams(self, order: int) -> list[np.ndarray]:
        """For each order from 0, the hash of the n-gram that ends at each character (0 where the word begins later)."""
        out = [np.zeros(len(self.points), dtype=np.uint64)]
        total = np.zeros(len(self.points), dtype=np.uint64)
        factors = BASE ** np.arange(order, dtype=np.uint64)
        for k in range(1, order + 1):
            back = np.zeros(len(self.points), dtype=np.uint64)
            back[k - 1 :] = self.points[: max(len(self.points) - k + 1, 0)]
            total = total + back * factors[k - 1]
            out.append(np.where(self.place >= k - 1, mixed(total + np.uint64(k)), np.uint64(0)))
        return out


def characters(vocabulary: pa.Array) -> Characters:
    """Letters of each word in lower case, other characters as single blanks, padded with blanks."""
    letters = pc.replace_substring_regex(pc.utf8_lower(vocabulary), r"[^\p{L}]+", " ")
    letters = pc.utf8_trim(letters, " ")
    padded = pc.binary_join_element_wise(
        pa.scalar(" ", pa.large_string()), letters, pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    )
    lengths = pc.utf8_length(letters).to_numpy(zero_copy_only=False).astype(np.int64)
    there = lengths > 0
    padded = padded.filter(pa.array(there))
    size = lengths[there] + 2
    points = np.frombuffer("".join(padded.to_pylist()).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    word = np.repeat(np.flatnonzero(there), size)
    place = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
    return Characters(points, word, place)


def position(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in a sorted array, -1 if it is not there."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


@dataclass
class LanguageModel:
    """Per order (from 1): sorted n-gram hashes with log probabilities, sorted context hashes with log weights."""

    languages: list[str]
    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    unseen: float
    usual: np.ndarray | None = None
    limit: np.ndarray | None = None

    def word_scores(self, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each word, its log probability in each language and its number of predicted characters."""
        parts = [self._word_scores(vocabulary.slice(i, WORDS_AT_ONCE)) for i in range(0, len(vocabulary), WORDS_AT_ONCE)]
        if not parts:
            return np.zeros((0, len(self.languages))), np.zeros(0, dtype=np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _word_scores(self, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        chars = characters(vocabulary)
        order = len(self.grams)
        hashes = chars.grams(order)
        score = np.zeros((len(chars.points), len(self.languages)), dtype=np.float64)
        # The opening blank is given, not predicted.
        open_ = np.flatnonzero(chars.place > 0)
        for k in range(order, 0, -1):
            fits = chars.place[open_] >= k - 1
            at = np.full(len(open_), -1)
            at[fits] = position(self.grams[k - 1], hashes[k][open_[fits]])
            found = at >= 0
            score[open_[found]] += self.logs[k - 1][at[found]]
            missing = open_[~found & fits]
            context = position(self.contexts[k - 1], hashes[k - 1][missing - 1])
            known = context >= 0
            score[missing[known]] += self.weights[k - 1][context[known]]
            open_ = open_[~found]
        score[open_] += self.unseen
        size = len(vocabulary)
        counts = np.bincount(chars.word[chars.place > 0], minlength=size)
        sums = [np.bincount(chars.word, weights=score[:, i], minlength=size) for i in range(len(self.languages))]
        return np.stack(sums, axis=1) if sums else np.zeros((size, 0)), counts

    def entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text in each language, and the number of characters."""
        words: Words = coded_words(texts)
        logs, counts = self.word_scores(words.vocabulary)
        owner, n = words.texts, len(texts)
        size = np.bincount(owner, weights=counts[words.codes], minlength=n).astype(float)
        sums = [np.bincount(owner, weights=logs[words.codes, i], minlength=n) for i in range(len(self.languages))]
        total = np.stack(sums, axis=1) if sums else np.zeros((n, 0))
        return -total / np.maximum(size, 1)[:, None], size

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language (-1: none), score and whether the calibrated rejection applies."""
        entropy, size = self.entropies(texts)
        if not self.languages:
            return np.full(len(texts), -1), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(len(best)), best]
        # Confidence grows with the length of short texts.
        sharp = np.minimum(size, 20)[:, None]
        score = 1 / np.exp(-sharp * (entropy - lowest[:, None])).sum(axis=1)
        none = size == 0
        rejected = none.copy()
        if self.limit is not None:
            excess = (lowest - self.usual[best]) * np.sqrt(np.clip(size, 1, STEADY))
            rejected |= excess > self.limit[best]
        return np.where(none, -1, best), np.where(none, 0.0, score), rejected


def ngram_counts(sample: DataFrame) -> DataFrame:
    """(lang, k, gram, context, lower, initial, count) over the texts of (lang, text)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            for lang in pc.unique(piece.column("lang")).to_pylist():
                texts = piece.filter(pc.equal(piece.column("lang"), lang)).column("text")
                words = coded_words(texts)
                chars = characters(words.vocabulary)
                times = np.bincount(words.codes, minlength=len(words.vocabulary))
                hashes = chars.grams(ORDER)
                for k in range(1, ORDER + 1):
                    at = np.flatnonzero((chars.place >= k - 1) & (chars.place > 0))
                    if not len(at):
                        continue
                    gram, first, inverse = np.unique(hashes[k][at], return_index=True, return_inverse=True)
                    total = np.bincount(inverse, weights=times[chars.word[at]]).astype(np.int64)
                    end = at[first]
                    initial = chars.points[end - k + 1] == BLANK if k > 1 else np.zeros(len(end), dtype=bool)
                    columns = [
                        pa.array([lang] * len(gram), pa.string()),
                        pa.array(np.full(len(gram), k, dtype=np.int32)),
                        pa.array(gram.view(np.int64)),
                        pa.array(hashes[k - 1][end - 1].view(np.int64)),
                        pa.array(hashes[k - 1][end].view(np.int64)),
                        pa.array(initial),
                        pa.array(total),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "k", "gram", "context", "lower", "initial", "n"])

    schema = "lang string, k int, gram long, context long, lower long, initial boolean, n long"
    keys = ["lang", "k", "gram", "context", "lower", "initial"]
    return sample.select("lang", "text").mapInArrow(count, schema).groupBy(*keys).agg(F.sum("n").alias("n"))


def kneser_ney(counts: pa.Table) -> LanguageModel:
    """Interpolated models from the n-gram counts of a bounded sample.

    The highest order uses counts, lower ones the number of different characters seen
    before the n-gram; n-grams that begin a word have none before and keep their counts.
    """
    languages = sorted(pc.unique(counts.column("lang")).to_pylist())
    code = pc.index_in(counts.column("lang"), pa.array(languages)).to_numpy()
    column = {c: counts.column(c).to_numpy() for c in ("k", "gram", "context", "lower", "initial", "n")}
    grams, logs, contexts, weights = [], [], [], []
    below = None
    unseen = 0.0
    for k in range(1, ORDER + 1):
        own = column["k"] == k
        gram, first, inverse = np.unique(column["gram"][own].view(np.uint64), return_index=True, return_inverse=True)
        shape = (len(gram), len(languages))
        seen = np.zeros(shape)
        seen[inverse, code[own]] = column["n"][own]
        if k < ORDER:
            longer = column["k"] == k + 1
            at = np.searchsorted(gram, column["lower"][longer].view(np.uint64))
            before = np.zeros(shape)
            np.add.at(before, (at, code[longer]), 1)
            seen = np.where(column["initial"][own][first][:, None] | (before == 0) & (seen > 0), seen, before)
        context, inside = np.unique(column["context"][own][first].view(np.uint64), return_inverse=True)
        total, kinds = (np.zeros((len(context), len(languages))) for _ in range(2))
        np.add.at(total, inside, seen)
        np.add.at(kinds, inside, seen > 0)
        once, twice = (seen == 1).sum(axis=0), (seen == 2).sum(axis=0)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.9)
        if k == 1:
            base = np.full(shape, 1 / (len(gram) + 1))
            unseen = -np.log(len(gram) + 1)
        else:
            base = below[np.searchsorted(grams[-1], column["lower"][own][first].view(np.uint64))]
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.where(total > 0, discount * kinds / total, 1.0)
            kept = np.where(total[inside] > 0, np.maximum(seen - discount, 0) / total[inside], 0.0)
        probability = kept + weight[inside] * base
        grams.append(gram)
        logs.append(np.log(probability).astype(np.float32))
        contexts.append(context)
        weights.append(np.log(weight).astype(np.float32))
        below = probability
    return LanguageModel(languages, grams, logs, contexts, weights, float(unseen))


def learnable(docs: DataFrame, trusted: Column) -> DataFrame:
    """(lang, text, fits): trusted documents, picked by a hash so that each language has its bound at most on average."""
    bound = FIT_DOCUMENTS + CALIBRATE_DOCUMENTS
    rows = docs.where(trusted & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id").alias("place")
    )
    # One row per language; the models themselves take far more room.
    rates = rows.groupBy("lang").agg((F.lit(float(bound)) / F.count("*")).alias("rate"))
    uniform = F.shiftrightunsigned("place", 11) / F.lit(float(1 << 53))
    fits = F.pmod(F.xxhash64("place"), F.lit(bound)) < FIT_DOCUMENTS
    picked = rows.join(F.broadcast(rates), "lang").where(F.col("text").isNotNull() & (uniform < F.col("rate")))
    return picked.select("lang", "text", fits.alias("fits"))


def trusted_rows(id_column: str = "doc_id") -> Column:
    """Rows a model may learn from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 != 2, F.lit(True))


def fit_language_model(docs: DataFrame, trusted: Column | None = None) -> LanguageModel:
    """Models of all languages named in ``docs.lang``, from a bounded sample of documents.

    Per language about ``FIT_DOCUMENTS`` documents train the model and about
    ``CALIBRATE_DOCUMENTS`` others (the training ones where those are under 20) set its
    usual cross-entropy and the limit beyond which a text is rejected. All texts are taken
    whole; what reaches the driver are the n-gram counts of the sample and two numbers per
    calibration document.
    """
    sample = learnable(docs, F.lit(True) if trusted is None else trusted)
    sample = cut_lineage(sample, "language-sample")
    counts = ngram_counts(sample.where("fits")).toArrow()
    if not counts.num_rows:
        counts = ngram_counts(sample).toArrow()
    if not counts.num_rows:
        return LanguageModel([], [], [], [], [], 0.0)
    model = kneser_ney(counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            entropy, size = shared.value.entropies(piece.column("text"))
            own = pc.index_in(piece.column("lang"), pa.array(shared.value.languages)).fill_null(0).to_numpy()
            columns = [
                piece.column("lang"), piece.column("fits"), pa.array(entropy[np.arange(len(own)), own]), pa.array(size)
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "fits", "entropy", "size"])

    schema = "lang string, fits boolean, entropy double, size double"
    calibrate(model, sample.mapInArrow(measure, schema).where("size > 0").toArrow())
    shared.unpersist()
    return model


def calibrate(model: LanguageModel, rows: pa.Table) -> None:
    """Set ``usual`` and ``limit`` from cross-entropies of sample documents in their own language."""
    usual, limit = np.zeros(len(model.languages)), np.full(len(model.languages), np.inf)
    for i, lang in enumerate(model.languages):
        own = rows.filter(pc.equal(rows.column("lang"), lang))
        held = own.filter(pc.invert(own.column("fits")))
        held = held if held.num_rows >= 20 else own
        if held.num_rows:
            entropy, size = held.column("entropy").to_numpy(), held.column("size").to_numpy()
            usual[i] = np.median(entropy)
            excess = (entropy - usual[i]) * np.sqrt(np.clip(size, 1, STEADY))
            limit[i] = max(MARGIN * excess.max(), ROOM * np.sqrt(STEADY))
    model.usual, model.limit = usual, limit


def identify_language(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, rejected.

    Null texts and texts without a letter get "und", score 0 and are rejected; so does every
    text when the model has no language. ``score`` is the winner's share of the likelihoods
    of up to 20 characters of average surprise; equal cross-entropies go to the language
    that sorts first. Repeated rows come back as often as they are there, an empty table
    gives no rows, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for piece in pieces(batches):
            best, score, rejected = model.predict(piece.column("text"))
            columns = [piece.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "rejected"])

    kind = docs.schema[id_column].dataType.simpleString()
    narrow = docs.select(F.col(id_column).alias("doc_id"), "text")
    return narrow.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def keep_known_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` without the rows `identify_language` rejects; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            _, _, rejected = shared.value.predict(piece.column("text"))
            yield piece.filter(pa.array(~rejected))

    return docs.mapInArrow(keep, docs.schema)
