"""Toxicity by a learned lexicon, matched through Levenshtein automata, weighed by context windows.

The lexicon holds words and word beginnings that labelled documents show to be abusive.
All its entries form one trie; walking the trie and every entry's Levenshtein automaton
together, state set by state set, gives one deterministic automaton that reads a word
once and says which entry it is or misspells. Each hit is then weighed by a window of
words around it: quotation marks and words of reporting lower it, address raises it.
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

# Bound of the labelled sample, on average; a smaller table is used whole.
FIT_DOCUMENTS = 16_000
# Bounds of the lexicon and of its entries' length.
ENTRIES = 200
SHORTEST, LONGEST = 4, 24
BEGINNINGS = (4, 5, 6, 7)
# An entry is this much likelier in toxic documents, with at least this log-likelihood ratio,
# and occurs in so many toxic documents and in this share of them.
ODDS, EVIDENCE, SUPPORT, SHARE = 60.0, 30.0, 3, 0.02
# Rounds of learning; each looks at the toxic documents that no entry explains yet.
ROUNDS = 4
# Misspellings are accepted from this length on, if so many of the documents with one are toxic (or there is none).
FUZZY_FROM, FUZZY_PRECISION = 5, 0.8
# Words on either side that a hit's window takes in, and what a window makes of the hit.
WINDOW = 4
QUOTED, REPORTED, ADDRESSED = 0.25, 0.5, 1.2
THRESHOLD = 0.5

# Quotation marks, words of reporting, words of address.
OPENING = "\"'“‘«„‹`"
CLOSING = "\"'”’»“›`"
REPORTING = (
    "said says wrote called calls quote quoted quotes quoting term word insult slur "
    "sagte schrieb nannte wort zitat dit écrit mot citation dijo escribió palabra cita"
).split()
ADDRESS = "you your you're ya u du dich dein ihr tu toi vous ton tú usted eres".split()


@dataclass
class Lexicon:
    """Entries with the share of toxic documents among those they occur in; ``begins`` matches word beginnings."""

    entries: list[str]
    begins: np.ndarray
    exact: np.ndarray
    fuzzy: np.ndarray


@dataclass
class Automaton:
    """``table[state, symbol]`` over the lexicon's characters (0: any other); ``accepts[state]`` is 2 * entry + errors, or -1."""

    symbols: np.ndarray
    table: np.ndarray
    accepts: np.ndarray

    def read(self, words: pa.Array) -> np.ndarray:
        """For each word 2 * entry + errors of its best match, -1 for none."""
        lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
        symbol = np.where(points < len(self.symbols), self.symbols[np.minimum(points, len(self.symbols) - 1)], 0)
        starts = np.cumsum(lengths) - lengths
        state = np.zeros(len(words), dtype=np.int64)
        going = np.flatnonzero(lengths > 0)
        step = 0
        while len(going):
            state[going] = self.table[state[going], symbol[starts[going] + step]]
            step += 1
            going = going[(lengths[going] > step) & (state[going] != 1)]
        return self.accepts[state]


def build_automaton(lexicon: Lexicon) -> Automaton:
    """Intersect the trie of the entries with Levenshtein automata of one error.

    An item (node, errors) says that the word so far is the trie path to ``node`` with so
    many errors. Reading a character follows a child, replaces a child's character, or
    counts the character as extra; missing characters are followed right away. Items that
    end a word beginning stay for good. State 0 is the start, state 1 is dead.
    """
    children: list[dict[str, int]] = [{}]
    ends: list[int] = [-1]
    lenient: list[bool] = [False]  # some entry below accepts misspellings
    for number, entry in enumerate(lexicon.entries):
        node = 0
        path = [0]
        for char in entry:
            if char not in children[node]:
                children[node][char] = len(children)
                children.append({})
                ends.append(-1)
                lenient.append(False)
            node = children[node][char]
            path.append(node)
        ends[node] = number
        if lexicon.fuzzy[number] > 0:
            for p in path:
                lenient[p] = True
    letters = sorted({c for entry in lexicon.entries for c in entry})

    def closed(items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        out, todo = set(items), list(items)
        while todo:
            node, errors = todo.pop()
            if node >= 0 and errors == 0:
                for child in children[node].values():
                    if lenient[child] and (child, 1) not in out:
                        out.add((child, 1))
                        todo.append((child, 1))
        # An item without errors stands for the same item with one.
        done = {(n, 0) for n, e in out if e == 0}
        kept = {(n, e) for n, e in out if e == 0 or (n, 0) not in done}
        for node, errors in list(kept):
            if node >= 0 and ends[node] >= 0 and lexicon.begins[ends[node]] and (errors == 0 or lexicon.fuzzy[ends[node]] > 0):
                kept.add((-1 - (2 * ends[node] + errors), errors))  # stays accepted
        return frozenset(kept)

    def after(state: frozenset[tuple[int, int]], char: str) -> frozenset[tuple[int, int]]:
        items: set[tuple[int, int]] = set()
        for node, errors in state:
            if node < 0:
                items.add((node, errors))
                continue
            if char in children[node]:
                items.add((children[node][char], errors))
            if errors == 0:
                if lenient[node]:
                    items.add((node, 1))
                for child in children[node].values():
                    if lenient[child]:
                        items.add((child, 1))
        return closed(items)

    def accepted(state: frozenset[tuple[int, int]]) -> int:
        best = (2, -1)
        for node, errors in state:
            if node < 0:
                number = (-1 - node) >> 1
            else:
                number = ends[node]
                if number < 0 or (errors and not lexicon.fuzzy[number] > 0):
                    continue
            best = min(best, (errors, number))
        return 2 * best[1] + best[0] if best[1] >= 0 else -1

    dead: frozenset[tuple[int, int]] = frozenset()
    start = frozenset({(0, 0)} | {(c, 1) for c in children[0].values() if lenient[c]})
    numbers = {start: 0, dead: 1}
    states = [start, dead]
    rows: list[list[int]] = []
    for state in states:
        row = []
        for char in ["", *letters]:
            to = after(state, char)
            if to not in numbers:
                numbers[to] = len(states)
                states.append(to)
            row.append(numbers[to])
        rows.append(row)
    symbols = np.zeros(max([ord(c) for c in letters], default=0) + 2, dtype=np.int64)
    for i, char in enumerate(letters, 1):
        symbols[ord(char)] = i
    return Automaton(symbols, np.array(rows, dtype=np.int64), np.array([accepted(s) for s in states]))


def terms(vocabulary: pa.Array) -> pa.Array:
    """Lower-case words without the marks around them."""
    return pc.replace_substring_regex(pc.utf8_lower(vocabulary), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def labelled_sample(docs: DataFrame, labels: DataFrame, trusted: Column) -> DataFrame:
    """(text, toxic): at most ``FIT_DOCUMENTS`` labelled documents on average, picked by a hash of the id."""
    known = labels.where(F.col("toxic").isNotNull() & trusted).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    count = known.count()
    share = min(1.0, FIT_DOCUMENTS / max(count, 1))
    uniform = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    # As many rows as the sample's bound; several labels of a document count as its highest.
    known = known.where(uniform < share).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = docs.select("doc_id", "text").where(F.col("text").isNotNull() & trusted & (uniform < share))
    found = picked.join(F.broadcast(known), "doc_id").select("text", "toxic")
    # Copies of a document are no further evidence.
    return cut_lineage(found.dropDuplicates(["text"]), "toxicity-sample")


def trusted_rows() -> Column:
    """Rows the lexicon may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)


def distinct_pairs(words: Words, keys: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, key) pairs of the words; words of key -1 are left out."""
    of_word = keys[words.codes]
    owner = words.texts
    there = of_word >= 0
    pairs = np.unique(owner[there] * (keys.max(initial=0) + 1) + of_word[there])
    return pairs // (keys.max(initial=0) + 1), pairs % (keys.max(initial=0) + 1)


def term_counts(sample: DataFrame) -> DataFrame:
    """(term, begins, toxic, clean): documents with the word, and with a word that begins so."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words = coded_words(piece.column("text"))
            toxic = piece.column("toxic").to_numpy() > 0
            cleaned = terms(words.vocabulary)
            size = pc.utf8_length(cleaned).to_numpy(zero_copy_only=False)
            for length in (0, *BEGINNINGS):
                if length:
                    shown, fits = pc.utf8_slice_codeunits(cleaned, 0, length), size >= length
                else:
                    shown, fits = cleaned, (size >= SHORTEST) & (size <= LONGEST)
                coded = shown.dictionary_encode()
                keys = np.where(fits, coded.indices.to_numpy(zero_copy_only=False), -1).astype(np.int64)
                text, key = distinct_pairs(words, keys, piece.num_rows)
                n = len(coded.dictionary)
                bad = np.bincount(key[toxic[text]], minlength=n)
                good = np.bincount(key[~toxic[text]], minlength=n)
                there = bad + good > 0
                columns = [
                    coded.dictionary.filter(pa.array(there)).cast(pa.string()),
                    pa.array(np.full(there.sum(), length > 0)),
                    pa.array(bad[there].astype(np.int64)),
                    pa.array(good[there].astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["term", "begins", "toxic", "clean"])

    counted = sample.mapInArrow(count, "term string, begins boolean, toxic long, clean long")
    return counted.groupBy("term", "begins").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_entries(counts: DataFrame, toxic: int, clean: int) -> Lexicon:
    """The entries with the strongest evidence; a word whose beginning is one already adds nothing."""
    rate = F.lit(float(toxic) / (toxic + clean))
    n = F.col("toxic") + F.col("clean")
    log_ratio = 2 * (
        F.when(F.col("toxic") > 0, F.col("toxic") * F.log(F.col("toxic") / (n * rate))).otherwise(0.0)
        + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * (1 - rate)))).otherwise(0.0)
    )
    odds = ((F.col("toxic") + 0.5) / (toxic + 1.0)) / ((F.col("clean") + 0.5) / (clean + 1.0))
    strong = (F.col("toxic") >= max(SUPPORT, SHARE * toxic)) & (odds >= ODDS) & (log_ratio >= EVIDENCE)
    # Of equal evidence the longer one is the more specific; whole words before beginnings.
    ranked = (
        counts.withColumn("evidence", log_ratio)
        .where(strong)
        .orderBy(F.col("evidence").desc(), F.length("term").desc(), "begins", "term")
        .limit(20 * ENTRIES)
        .collect()
    )
    chosen: list = []
    for row in ranked:
        inside = any(c.begins and row.term.startswith(c.term) or c.term == row.term for c in chosen)
        # A beginning that is little more than one chosen word adds that word's neighbours only.
        around = row.begins and any(c.term.startswith(row.term) for c in chosen)
        if not inside and not (around and not row.toxic > 1.2 * max(c.toxic for c in chosen if c.term.startswith(row.term))):
            chosen.append(row)
        if len(chosen) == ENTRIES:
            break
    precision = np.array([(c.toxic + 0.5 * toxic / (toxic + clean)) / (c.toxic + c.clean + 0.5) for c in chosen])
    fuzzy = np.array([0.8 * p if len(c.term) >= FUZZY_FROM else 0.0 for c, p in zip(chosen, precision)])
    return Lexicon([c.term for c in chosen], np.array([c.begins for c in chosen], dtype=bool), precision, fuzzy)


def drop_chance_misspellings(lexicon: Lexicon, sample: DataFrame) -> Lexicon:
    """Entries whose misspellings are met in clean documents too keep their exact form only."""
    shared = sample.sparkSession.sparkContext.broadcast(build_automaton(lexicon))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words = coded_words(piece.column("text"))
            text, match = distinct_pairs(words, shared.value.read(terms(words.vocabulary)), piece.num_rows)
            toxic = piece.column("toxic").take(pa.array(text))
            yield pa.RecordBatch.from_arrays([pa.array(match), toxic], ["match", "toxic"])

    met = sample.mapInArrow(count, "match long, toxic int").groupBy("match")
    toxic_share = F.avg((F.col("toxic") > 0).cast("double"))
    shares = {r.match: r.share for r in met.agg(toxic_share.alias("share")).collect()}
    reliable = [shares.get(2 * i + 1, 1.0) >= FUZZY_PRECISION for i in range(len(lexicon.entries))]
    return Lexicon(lexicon.entries, lexicon.begins, lexicon.exact, np.where(reliable, lexicon.fuzzy, 0.0))


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    automaton: Automaton
    base: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """1 - product over the hits of (1 - weight of the entry * weight of its window), at least the base rate's share."""
        words = coded_words(texts)
        match = self.automaton.read(terms(words.vocabulary))
        hits = np.flatnonzero(match[words.codes] >= 0)
        log_none = np.zeros(len(texts))
        if len(hits):
            owner = words.texts
            found = match[words.codes[hits]]
            entry, errors = found >> 1, found & 1
            weight = np.where(errors == 0, self.lexicon.exact[entry], self.lexicon.fuzzy[entry])
            weight = np.clip(weight * window_weights(words, hits, owner), 0, 0.999)
            log_none = np.bincount(owner[hits], weights=np.log1p(-weight), minlength=len(texts))
        return 1 - np.exp(log_none) * (1 - self.base)


def window_weights(words: Words, hits: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """What the words around each hit make of it."""
    near = hits[:, None] + np.arange(-WINDOW, WINDOW + 1)[None, :]
    inside = (near >= words.starts[owner[hits]][:, None]) & (near < words.starts[owner[hits] + 1][:, None])
    codes = words.codes[np.clip(near, 0, len(words.codes) - 1)]
    shown, place = np.unique(codes, return_inverse=True)
    text = words.vocabulary.take(pa.array(shown)).to_pylist()
    core = terms(words.vocabulary.take(pa.array(shown))).to_pylist()
    opens = np.array([t[:1] in OPENING and t[:1] != "" for t in text])
    closes = np.array([t.rstrip(".,;:!?)")[-1:] in CLOSING and t.rstrip(".,;:!?)") != "" for t in text])
    reports = np.array([c in REPORTING for c in core])
    addresses = np.array([c in ADDRESS for c in core])
    place = place.reshape(codes.shape)
    quoted = (opens[place] & inside)[:, : WINDOW + 1].any(axis=1) & (closes[place] & inside)[:, WINDOW:].any(axis=1)
    reported = (reports[place] & inside)[:, :WINDOW].any(axis=1)
    addressed = (addresses[place] & inside).any(axis=1)
    weight = np.where(quoted, QUOTED, 1.0) * np.where(quoted & reported, REPORTED, 1.0)
    return weight * np.where(addressed & ~quoted, ADDRESSED, 1.0)


def joined(one: Lexicon, two: Lexicon) -> Lexicon:
    """Both lexicons, without entries of the second that are in the first."""
    new = [i for i, e in enumerate(two.entries) if e not in one.entries][: ENTRIES - len(one.entries)]
    return Lexicon(
        one.entries + [two.entries[i] for i in new],
        np.concatenate([one.begins, two.begins[new]]),
        np.concatenate([one.exact, two.exact[new]]),
        np.concatenate([one.fuzzy, two.fuzzy[new]]),
    )


def unexplained(sample: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All clean documents, and the toxic ones without an exact hit."""
    shared = sample.sparkSession.sparkContext.broadcast(build_automaton(lexicon))

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words = coded_words(piece.column("text"))
            match = shared.value.read(terms(words.vocabulary))
            exact = np.where((match >= 0) & (match % 2 == 0), 0, -1)
            hit = np.zeros(piece.num_rows, dtype=bool)
            hit[distinct_pairs(words, exact, piece.num_rows)[0]] = True
            toxic = piece.column("toxic").to_numpy() > 0
            yield piece.filter(pa.array(~(hit & toxic)))

    return sample.mapInArrow(keep, sample.schema)


def fit_toxicity(docs: DataFrame, labels: DataFrame, trusted: Column | None = None) -> ToxicityModel:
    """Learn the lexicon from labelled documents, about ``FIT_DOCUMENTS`` of them at most.

    The counts of the sample's words are summed by Spark; the driver gets a bounded number
    of entries. A word that merely stands beside abuse, as in copies of one document, is
    no entry: later rounds count only what the entries so far leave unexplained. Without
    labels of both kinds the lexicon is empty.
    """
    trusted = F.col("doc_id").isNotNull() if trusted is None else trusted
    sample = labelled_sample(docs, labels, trusted)
    lexicon = Lexicon([], np.zeros(0, dtype=bool), np.zeros(0), np.zeros(0))
    left = sample
    for _ in range(ROUNDS):
        counts = {r.bad: r.n for r in left.groupBy((F.col("toxic") > 0).alias("bad")).agg(F.count("*").alias("n")).collect()}
        toxic, clean = counts.get(True, 0), counts.get(False, 0)
        if toxic < SUPPORT or not clean:
            break
        found = choose_entries(term_counts(left), toxic, clean)
        grown = joined(lexicon, found)
        if len(grown.entries) == len(lexicon.entries):
            break
        lexicon = grown
        left = cut_lineage(unexplained(sample, lexicon), "unexplained")
    if lexicon.entries:
        lexicon = drop_chance_misspellings(lexicon, sample)
    return ToxicityModel(lexicon, build_automaton(lexicon), 0.01)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted.

    Null and empty texts have the lowest score. Repeated rows come back as often as they
    are there, an empty table gives no rows, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = shared.value.scores(piece.column("text"))
            columns = [piece.column("doc_id"), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("doc_id"), "text").mapInArrow(
        score, f"doc_id {kind}, score double, predicted int"
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` without the rows predicted toxic; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            yield piece.filter(pa.array(shared.value.scores(piece.column("text")) < THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)
