"""Toxicity by the nearest labelled examples.

Texts are vectors of all their words: ``1 + ln(tf)`` times the inverse document frequency, times
how far the word's odds differ between the labels, so that words which tell nothing weigh
little; none is left out. The nearest examples by exact cosine vote, each by the square of its
cosine; votes are calibrated by the examples' own, each without itself.

Words that many examples hold have a row of weights, an entry for each example: what they add to
the cosines of many texts is one product of matrices. For the others, examples are ordered so that
similar ones share a block, and an inverted list keeps, for each word, the blocks that hold it with
its greatest weight there. The sums of those bound every block's cosines; blocks whose bound is
below the cosine of the last neighbour are never opened.

Document frequencies and odds are counted over all training rows. The examples are a sample of
at most ``MAX_EXAMPLES`` rows of each label, the first by a hash of the id.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property, lru_cache
from itertools import islice, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from broadsheet.llm.common import release, shared_table, text_of
from broadsheet.llm.language_id import FOLDS, held_out

MAX_EXAMPLES = 3000
NEIGHBOURS = 15
BLOCK = 64
# Postings read in the first round; examples left for each neighbour that are few enough to verify.
FIRST_POSTINGS, FEW_LEFT = 8192, 4
# Blocks from which on a word's block bounds are kept as a whole row.
DENSE_BLOCKS = 16
# A word that one example in so many holds has a row of all its weights: these rows have at most so
# many times the numbers of the postings. Texts scored at a time.
COMMON, TEXTS = 16, 256
# Against rounding: postings and rows keep weights in single precision, and rows are added up in it;
# examples' own lists are in double.
SLACK = 1e-4
# Weight of the base rate among the votes.
PRIOR = 0.5
BINS = 20

_WORD = re.compile(r"\w+")
# ASCII characters that are part of no word become spaces.
_GAPS = bytes(c if c > 127 or _WORD.fullmatch(chr(c)) else 32 for c in range(256))


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_counts(text: str) -> Counter:
    """How often each of ``words_of`` occurs. Texts are cut at ASCII characters and white space first;
    the pattern sees only distinct pieces with others that are no letter or digit."""
    cut = text.lower().encode("utf-8", "surrogatepass").translate(_GAPS).decode("utf-8", "surrogatepass")
    counted = Counter(cut.split())
    for piece in [p for p in counted if not p.isalnum()]:
        n = counted.pop(piece)
        for word in _WORD.findall(piece):
            counted[word] += n
    return counted


@dataclass(frozen=True)
class ExampleIndex:
    """Words ``t`` have the entries ``first[t]`` to ``first[t + 1]``, one for each block that holds
    them: its number, its greatest weight, and the postings ``opens[e]`` to ``opens[e + 1]``.
    Example ``i`` has the words and weights ``starts[i]`` to ``starts[i + 1]`` of ``held`` and
    ``held_weight``. ``top`` is a word's greatest weight anywhere. Words in many blocks also have
    their greatest weights as a row of ``dense``, a column for each block."""

    terms: dict[str, int]
    scale: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    first: np.ndarray
    block: np.ndarray
    greatest: np.ndarray
    opens: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    held: np.ndarray
    held_weight: np.ndarray
    starts: np.ndarray
    block_of: np.ndarray
    top: np.ndarray
    dense_row: np.ndarray
    dense: np.ndarray
    base_rate: float
    calibrated: np.ndarray | None = None

    @cached_property
    def common(self) -> tuple[np.ndarray, np.ndarray]:
        """For each word its row or -1, and the rows: weights in all examples of the words in many.
        Made from the postings where it is needed; it is not sent."""
        opens = self.opens[self.first].astype(np.int64)
        many = np.flatnonzero(np.diff(opens) * COMMON >= max(len(self.ids), 1))
        row = np.full(len(opens) - 1, -1, np.int32)
        row[many] = np.arange(len(many))
        postings, sizes = _spread(opens[many], opens[many + 1])
        weights = np.zeros((len(many), len(self.ids)), np.float32)
        weights[np.repeat(np.arange(len(many)), sizes), self.example[postings]] = self.weight[postings]
        return row, weights


def term_scale(rows: int, positive: int, n: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Weight of words that ``n`` rows hold, ``a`` of them positive: inverse document frequency
    times the distance of their log odds from those of a word that tells nothing."""
    rate = (positive + 1) / (rows + 2)
    odds = np.log((a + rate) / (positive + 1)) - np.log((n - a + 1 - rate) / (rows - positive + 1))
    return (1 + np.log(max(rows, 1) / np.maximum(n, 1))) * np.abs(odds)


def vector(terms: dict[str, int], scale: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Known words and weights of length 1; both empty if the text has none that weighs."""
    counted = word_counts(text)
    found = np.fromiter(map(terms.get, counted, repeat(-1)), np.int64, len(counted))
    counts = np.fromiter(counted.values(), np.int64, len(counted))
    known = found >= 0
    return weighted(scale, found[known], counts[known])


def weighted(scale: np.ndarray, found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words ``found`` that occur ``counts`` times, as a vector of length 1."""
    weight = (1 + np.log(counts)) * scale[found]
    length = math.sqrt(weight @ weight)
    return (found, weight / length) if length > 0 else (np.empty(0, np.int64), np.empty(0))


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some ranges, and the size of each range."""
    sizes = ends - starts
    upto = np.cumsum(sizes)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(starts - (upto - sizes), sizes), sizes


def _cosines(index: ExampleIndex, examples: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Whole cosines of some examples, from their own lists of words."""
    scratch = _scratch(len(index.scale))
    scratch[terms] = weights
    found = np.empty(len(examples))
    for at in range(0, len(examples), BLOCK):
        some = examples[at : at + BLOCK]
        entries, sizes = _spread(index.starts[some], index.starts[some + 1])
        parts = scratch.take(index.held[entries]) * index.held_weight[entries]
        found[at : at + BLOCK] = np.bincount(np.repeat(np.arange(len(some)), sizes), parts, len(some))
    scratch[terms] = 0
    return found


@lru_cache(1)
def _scratch(size: int) -> np.ndarray:
    """A row of zeros, kept by the worker; whoever writes to it clears it."""
    return np.zeros(size)


def common_parts(index: ExampleIndex, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """What the words in many examples add to the cosines of some texts, a row for each text."""
    row, rows = index.common
    asked = np.zeros((len(vectors), len(rows)), np.float32)
    for i, (terms, weights) in enumerate(vectors):
        at = row[terms]
        asked[i, at[at >= 0]] = weights[at >= 0]
    return asked @ rows


def nearest(index: ExampleIndex, terms: np.ndarray, weights: np.ndarray, k: int, but: int = -1, part: np.ndarray | None = None):
    """``(examples, cosines)`` of the ``k`` nearest examples, nearest first; ties by number. ``part``
    is the text's row of ``common_parts``, if it is known.

    The other words are taken in rounds, those that can add most first. The greatest weights of the
    words not yet taken bound what each block can still add; an example whose part and bound together
    stay below the ``k``-th part is out, and a block without examples left is not read again. Few
    examples left are verified by their own lists of words.
    """
    if not len(terms) or not len(index.ids):
        return np.empty(0, np.int64), np.empty(0)
    whole = terms, weights
    at, rows = index.common[0][terms], index.common[1]
    other = at < 0
    part = weights[~other] @ rows[at[~other]] if part is None else part.astype(np.float64)
    terms, weights = terms[other], weights[other]
    order = np.argsort(-weights * index.top[terms], kind="stable")
    terms, weights = terms[order], weights[order]
    count = -(-len(index.ids) // BLOCK)
    row = index.dense_row[terms]
    rest = weights[row >= 0] @ index.dense[row[row >= 0]]
    few = terms[row < 0]
    entries, sizes = _spread(index.first[few], index.first[few + 1])
    rest += np.bincount(index.block[entries], np.repeat(weights[row < 0], sizes) * index.greatest[entries], count)
    # rounds of about twice as many postings each, cut between words
    upto = np.cumsum(index.opens[index.first[terms + 1]] - index.opens[index.first[terms]], dtype=np.int64)
    alive = np.ones(count, bool)
    at, size, least = 0, FIRST_POSTINGS, 0.0
    while True:
        past = upto[at - 1] if at else 0
        end = min(int(np.searchsorted(upto, past + size)) + 1, len(terms))
        entries, sizes = _spread(index.first[terms[at:end]], index.first[terms[at:end] + 1])
        blocks, each = index.block[entries], np.repeat(weights[at:end], sizes)
        rest -= np.bincount(blocks, each * index.greatest[entries], count)
        if not alive.all():
            use = alive[blocks]
            entries, each = entries[use], each[use]
        postings, many = _spread(index.opens[entries], index.opens[entries + 1])
        part += np.bincount(index.example[postings], np.repeat(each, many) * index.weight[postings], len(part))
        at, size = end, size * 2
        if but >= 0:
            part[but] = 0
        if len(part) > k:
            least = max(least, np.partition(part, len(part) - k)[len(part) - k])
        left = np.flatnonzero(part + rest[index.block_of] >= max(least - SLACK, 0))
        if least > 0:
            alive = np.bincount(left // BLOCK, minlength=count) > 0
        if at == len(terms) or least > 0 and len(left) <= FEW_LEFT * k:
            break
    left = left[left != but]
    if at == len(terms) and len(left) > k:  # parts are rounded cosines here
        left = left[part[left] >= least - SLACK]
    score = _cosines(index, left, *whole)
    left, score = left[score > 0], score[score > 0]
    best = np.lexsort((left, -score))[:k]
    return left[best], score[best]


def vote(index: ExampleIndex, examples: np.ndarray, cosines: np.ndarray) -> float:
    """Share of the positive label among the neighbours, by squared cosine, and the base rate."""
    trust = cosines**2
    return float((trust @ index.label[examples] + PRIOR * index.base_rate) / (trust.sum() + PRIOR))


def score_text(index: ExampleIndex, text: str) -> tuple[float, list[int]]:
    """Calibrated score, and the ids of the three nearest examples."""
    return score_vector(index, *vector(index.terms, index.scale, text))


def score_vector(
    index: ExampleIndex, terms: np.ndarray, weights: np.ndarray, part: np.ndarray | None = None
) -> tuple[float, list[int]]:
    examples, cosines = nearest(index, terms, weights, NEIGHBOURS, part=part)
    raw = vote(index, examples, cosines)
    centres = (np.arange(BINS) + 0.5) / BINS
    score = raw if index.calibrated is None else float(np.interp(raw, centres, index.calibrated))
    return score, index.ids[examples[:3]].tolist()


def score_vectors(index: ExampleIndex, vectors: Iterator[tuple]) -> Iterator[tuple[float, list[int]]]:
    """``score_vector`` of many texts, some at a time."""
    while some := list(islice(vectors, TEXTS)):
        for one, part in zip(some, common_parts(index, some), strict=True):
            yield score_vector(index, *one, part)


def _rising(rates: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest sequence that never falls (pooling neighbours that do)."""
    pools: list[list[float]] = []
    for rate, weight in zip(rates.tolist(), weights.tolist(), strict=True):
        pools.append([rate, weight, 1])
        while len(pools) > 1 and pools[-2][0] > pools[-1][0]:
            r, w, n = pools.pop()
            q = pools[-1]
            pools[-1] = [(q[0] * q[1] + r * w) / (q[1] + w), q[1] + w, q[2] + n]
    return np.concatenate([np.full(n, rate) for rate, _, n in pools])


def _known_terms(texts: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """``texts`` with each text's known words in place of the text: ``held``, the steps between their
    numbers in rising order, and ``tf``, how often each occurs, as 32-bit integers."""
    kept = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = vocabulary.value
        for batch in batches:
            held, tf = [], []
            for text in batch.column("text"):
                counted = word_counts(text.as_py())
                found = np.fromiter(map(terms.get, counted, repeat(-1)), np.int32, len(counted))
                order = np.argsort(found)[np.count_nonzero(found < 0) :]
                held.append(np.diff(found[order], prepend=np.int32(0)).tobytes())
                tf.append(np.fromiter(counted.values(), np.int32, len(counted))[order].tobytes())
            columns = [*(batch.column(c) for c in kept), pa.array(held, pa.binary()), pa.array(tf, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "held", "tf"])

    return texts.mapInArrow(run, texts.select(kept).schema.add("held", "binary").add("tf", "binary"))


def _numbers(held: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(held, np.int32), dtype=np.int64)


def _term_counts(rows: DataFrame, size: int) -> DataFrame:
    """``(term, n, a)``: of ``rows(label, held)``, how many hold a word, and how many of those are positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, positive = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for held, label in zip(batch.column("held"), batch.column("label"), strict=True):
                terms = _numbers(held.as_py())
                total[terms] += 1
                if label.as_py():
                    positive[terms] += 1
        found = np.flatnonzero(total)
        columns = (found.astype(np.int32), total[found], positive[found])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["term", "n", "a"])

    counts = rows.select("label", "held").mapInArrow(run, "term int, n long, a long")
    return counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("a").alias("a"))


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = [word_counts(t) for t in batch["text"]]
        sizes = [len(c) for c in counts]
        yield pd.DataFrame(
            {
                "example": np.repeat(batch["example"].to_numpy(), sizes),
                "term": [t for c in counts for t in c],
                "tf": np.array([n for c in counts for n in c.values()], np.int64),
            }
        )


def build_index(
    terms: dict[str, int], scale: np.ndarray, ids: np.ndarray, label: np.ndarray,
    example: np.ndarray, term: np.ndarray, tf: np.ndarray, base_rate: float,
) -> ExampleIndex:
    """Index of examples given as ``(example, term, tf)``, examples and terms by number."""
    weight = (1 + np.log(tf)) * scale[term]
    length = np.sqrt(np.bincount(example, weight**2, len(ids)))
    weight = weight / np.where(length > 0, length, 1)[example]
    # examples by their weightiest words, so that blocks hold similar ones
    order = np.lexsort((term, -weight, example))
    rank = np.arange(len(order)) - np.searchsorted(example[order], example[order])
    lead = np.full((3, len(ids)), -1)
    for r in range(3):
        at = order[rank == r]
        lead[r, example[at]] = term[at]
    by = np.lexsort((ids, lead[2], lead[1], lead[0]))
    place = np.empty(len(ids), np.int64)
    place[by] = np.arange(len(ids))
    example = place[example]
    order = np.lexsort((example, term))
    example, term, weight = example[order], term[order], weight[order]
    cell = term * (len(ids) // BLOCK + 1) + example // BLOCK
    starts = np.flatnonzero(np.diff(cell, prepend=-1))
    by_example = np.argsort(example, kind="stable")
    top = np.zeros(len(terms))
    np.maximum.at(top, term, weight)
    first = np.searchsorted(term[starts], np.arange(len(terms) + 1))
    block, greatest = example[starts] // BLOCK, np.maximum.reduceat(weight, starts) if len(starts) else np.empty(0)
    many = np.flatnonzero(np.diff(first) >= DENSE_BLOCKS)
    dense_row = np.full(len(terms), -1, np.int32)
    dense_row[many] = np.arange(len(many))
    row = dense_row[term[starts]]
    dense = np.zeros((len(many), -(-len(ids) // BLOCK)), np.float32)
    dense[row[row >= 0], block[row >= 0]] = greatest[row >= 0]
    return ExampleIndex(
        terms, scale, ids[by], label[by].astype(float), first, block.astype(np.int32), greatest.astype(np.float32),
        np.append(starts, len(term)).astype(np.int32), example.astype(np.int32), weight.astype(np.float32), term[by_example].astype(np.int32), weight[by_example],
        np.searchsorted(example[by_example], np.arange(len(ids) + 1)), np.arange(len(ids)) // BLOCK, top, dense_row, dense, base_rate,
    )


def _examples(texts: DataFrame, first: DataFrame) -> DataFrame:
    """The rows ``first(doc_id, hash, label)``, few enough to broadcast, with their texts and a number
    each, repeated rows too."""
    listed = first.repartition(1).sortWithinPartitions("hash", "doc_id", "label")
    listed = shared_table(listed.select(F.monotonically_increasing_id().alias("example"), "*"), "chosen")
    wanted = F.broadcast(listed.select("doc_id", "hash").distinct())
    texts = texts.join(wanted, ["doc_id", "hash"], "left_semi").dropDuplicates(["doc_id", "hash"])
    return shared_table(listed.join(texts, ["doc_id", "hash"]), "examples")


def fit(labelled: DataFrame, max_examples: int = MAX_EXAMPLES) -> ExampleIndex:
    """Index of ``labelled(doc_id, text, label)``; rows with a null label or id teach nothing."""
    index, numbered = fit_numbered(labelled, max_examples=max_examples)
    release(numbered)
    return index


def fit_numbered(
    labelled: DataFrame, labels: DataFrame | None = None, max_examples: int = MAX_EXAMPLES
) -> tuple[ExampleIndex, DataFrame]:
    """Index of ``labelled(doc_id, text, label)``, or of ``labelled(doc_id, text)`` and ``labels(doc_id,
    label)``, and a written table of the known words of all its rows, for ``score_numbered``.

    What comes to the driver are the words of at most ``2 * max_examples`` rows. Repeated rows
    are examples of their own; without rows the index is empty and every score the base rate.
    """
    spark = labelled.sparkSession
    # texts are hashed before they meet labels, so that choosing examples moves no text
    texts = labelled.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", text_of())
    texts = texts.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("hash"), *(["label"] if labels is None else []))

    def with_labels(some: DataFrame) -> DataFrame:
        # labels grow with the documents, so they are never broadcast
        met = some if labels is None else some.join(labels.select("doc_id", "label").hint("merge"), "doc_id")
        return met.filter("label is not null and doc_id is not null").withColumn("label", (F.col("label") == 1).cast("int"))

    order = shared_table(with_labels(texts.drop("text")).select("doc_id", "label", "hash"), "labelled_rows")
    total, positive = order.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    base_rate = (positive + 1) / (total + 2)
    # the first of each label by hash
    sides = [order.filter(F.col("label") == y).orderBy("hash", "doc_id").limit(max_examples) for y in (0, 1)]
    chosen = _examples(texts.select("doc_id", "hash", "text"), sides[0].unionByName(sides[1]))
    words = shared_table(chosen.select("example", "text").mapInPandas(_words, "example long, term string, tf long"), "example_words")
    vocabulary = words.select("term").distinct().repartition(1).sortWithinPartitions("term")
    vocabulary = shared_table(vocabulary.select("term", F.monotonically_increasing_id().cast("int").alias("number")), "vocabulary")
    numbered = vocabulary.orderBy("number").toArrow()
    terms = dict(zip(numbered.column("term").to_pylist(), range(numbered.num_rows), strict=True))
    sent = spark.sparkContext.broadcast(terms)
    known = shared_table(_known_terms(texts.drop("hash"), sent), "known_words")
    sent.destroy()
    counts = _term_counts(with_labels(known.drop("tf")), len(terms)).orderBy("term").toArrow()
    n, a = (counts.column(c).to_numpy().astype(float) for c in ("n", "a"))
    examples = chosen.select("example", "doc_id", "label").orderBy("example").toArrow().to_pandas()
    listed = words.join(F.broadcast(vocabulary), "term").select("example", "number", F.col("tf").cast("int").alias("tf")).toArrow()
    index = build_index(
        terms, term_scale(total, positive, n, a), examples["doc_id"].to_numpy(), examples["label"].to_numpy(),
        np.searchsorted(examples["example"].to_numpy(), listed.column("example").to_numpy()),
        listed.column("number").to_numpy(), listed.column("tf").to_numpy().astype(float), base_rate,
    )
    del listed, numbered, counts
    if not len(index.ids):
        return index, known
    # calibration: every example's vote without itself, labels weighted as among all rows
    share = {0: total - positive, 1: positive}
    worth = [share[y] / max(int((index.label == y).sum()), 1) for y in (0, 1)]
    sent = spark.sparkContext.broadcast(index)

    def own_votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = sent.value
        for batch in batches:
            votes, numbers = [], batch["id"].to_numpy()
            for some in np.split(numbers, range(TEXTS, len(numbers), TEXTS)):
                own = [slice(index.starts[i], index.starts[i + 1]) for i in some]
                vectors = [(index.held[o], index.held_weight[o]) for o in own]
                for i, one, part in zip(some.tolist(), vectors, common_parts(index, vectors), strict=True):
                    votes.append(vote(index, *nearest(index, *one, NEIGHBOURS, but=i, part=part)))
            label = index.label[batch["id"].to_numpy()].astype(int)
            yield pd.DataFrame({"bin": np.minimum((np.array(votes) * BINS).astype(int), BINS - 1), "label": label})

    votes = spark.range(len(index.ids)).mapInPandas(own_votes, "bin int, label int").groupBy("bin", "label").count().toArrow().to_pandas()
    sent.destroy()
    mass = np.zeros((BINS, 2))
    for b, y, n in votes.itertuples(index=False):
        mass[b, y] += n * worth[y]
    # a bin without examples goes by its own votes
    centres = (np.arange(BINS) + 0.5) / BINS
    rates = (mass[:, 1] + centres) / (mass.sum(1) + 1)
    return replace(index, calibrated=_rising(rates, mass.sum(1) + 1)), known


def _scored(rows: DataFrame, index: ExampleIndex, vectors: Callable) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(score_vectors(sent.value, vectors(sent.value, batch)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.list_(pa.int64()))],
                names=["doc_id", "score", "evidence"],
            )

    schema = rows.select("doc_id").schema.add("score", "double").add("evidence", T.ArrayType(T.LongType()))
    return rows.mapInArrow(run, schema)


def score_documents(docs: DataFrame, index: ExampleIndex) -> DataFrame:
    """``(doc_id, score, evidence)``: evidence holds the ids of the nearest examples. A null
    text counts as empty; texts without a known word score as the base rate does."""

    def vectors(index: ExampleIndex, batch: pa.RecordBatch) -> Iterator[tuple]:
        return (vector(index.terms, index.scale, t.as_py()) for t in batch.column("text"))

    return _scored(docs.select("doc_id", text_of().alias("text")), index, vectors)


def score_numbered(numbered: DataFrame, index: ExampleIndex) -> DataFrame:
    """``score_documents`` of the rows that ``fit_numbered`` has cut into words; its index holds
    them by number, so that its own words need not be sent."""

    def vectors(index: ExampleIndex, batch: pa.RecordBatch) -> Iterator[tuple]:
        for held, tf in zip(batch.column("held"), batch.column("tf"), strict=True):
            yield weighted(index.scale, _numbers(held.as_py()), np.frombuffer(tf.as_py(), np.int32))

    return _scored(numbered.select("doc_id", "held", "tf"), replace(index, terms={}), vectors)


def score_held_out(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """``(doc_id, held_out, score, predicted, evidence)`` of all documents; the label of an id
    is its largest, and only ids outside the held-out fold teach."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = known.filter(~held_out(folds=folds))
    index, numbered = fit_numbered(docs, known)
    scored = score_numbered(numbered, index)
    return scored.select(
        "doc_id", held_out(folds=folds).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence"
    )
