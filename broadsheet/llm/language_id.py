"""Language identification by prediction by partial matching over bytes.

For every language a context tree of bytes up to order 3 is counted over all its training
texts. A byte's probability follows escape method C with exclusion: a context that has seen
the byte n times among N bytes and D distinct ones gives n / (N + D), otherwise the
escape mass D / (N + D) goes to the next shorter context, shared among the bytes that this one
has not seen; below order 0 all 256 bytes are alike. The trees are whole: every byte value and every context
that training has. With frozen statistics every code length is a constant: a text's length in
bits under each language is a sum over all its bytes, looked up once for equal grams of a piece of text.

Bytes are numbers to 255, and the beginning of a text is 256. A gram is a context, the last byte first, and
the byte after it: ``((c * 257 + b) * 257 + a) * 256 + x``. The counts pass the driver in parts of about ``CELLS``
grams, each all that some endings (c, b) have, so what a process holds of them is bounded whatever the training texts are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from broadsheet.llm.common import release, shared_table, text_of

UNKNOWN = "und"
FOLDS = 5
# What a context is made of: bytes and the beginning of a text.
BEGIN = 256
WIDTH = 257
# Counts that pass the driver, and are held by a worker, at a time where there are more.
CELLS = 1_000_000
# Bytes worked on at a time; bounds a worker's memory whatever the length of a text.
CHUNK = 1 << 19
# Texts of a batch that are taken out of it at a time.
TEXTS = 256
# Where the counts are in parts, each is fetched for up to so many pieces of bytes, and so many times more texts.
WIDER = 8

# Grams of one order in one language, sorted, and how often each occurs.
Counts = tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Level:
    """The contexts of one length in one language. ``bits`` by gram seen; ``escape`` by context: what the
    next shorter one's bits grow by for a byte not seen here; ``whole``: N + D, or N where all bytes are seen."""

    grams: np.ndarray
    n: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    whole: np.ndarray
    escape: np.ndarray


@dataclass(frozen=True)
class LanguageModel:
    """``pairs``: counts of order 1 by language. ``parts``: counts of order 3 by language, of the grams from
    one of ``endings`` to the next; a single part is here, several are broadcast and fetched in turn.

    The trees made of them are built where they are asked for, those of a single part once a process."""

    languages: tuple[str, ...]
    pairs: tuple[Counts, ...]
    endings: np.ndarray
    parts: tuple[tuple[Counts, ...] | Broadcast, ...]

    @cached_property
    def _short(self) -> list[tuple[Level, Level]]:
        """Orders 1 and 0 by language."""
        zero = [_level(*_summed(_shorter(grams), n)) for grams, n in self.pairs]
        return [(_level(*counts, none), none) for counts, none in zip(self.pairs, zero, strict=True)]

    @cached_property
    def _single(self) -> list[tuple[Level, ...]]:
        return list(self._trees(self.parts[0]))

    def _trees(self, part: tuple[Counts, ...] | Broadcast) -> Iterator[tuple[Level, ...]]:
        """Orders 3 to 0 by language."""
        for (grams, n), short in zip(_value(part), self._short, strict=True):
            two = _level(*_summed(_shorter(grams), n), short[0])
            yield _level(grams, n, two), two, *short

    def bits(self, grams: np.ndarray, order: int = 3) -> np.ndarray:
        """Code lengths by gram and language of sorted grams of order 3 or 2."""
        found = np.empty((len(grams), len(self.languages)), np.float32)
        cuts = np.searchsorted(grams, self.endings[1:] * 256 * WIDTH ** (order - 2)).tolist()
        for part, at, end in zip(self.parts, [0, *cuts], [*cuts, len(grams)], strict=True):
            if at < end:
                for k, levels in enumerate(self._single if len(self.parts) == 1 else self._trees(part)):
                    found[at:end, k] = _looked_up(levels[3 - order :], grams[at:end])
        return found

    @cached_property
    def _symbols(self) -> tuple[np.ndarray, int]:
        """The beginning, the bytes that training has, and one that stands for all others; how many it stands for."""
        used = np.unique(np.concatenate([grams & 255 for grams, _ in self.pairs]))
        other = np.setdiff1d(np.arange(256), used)
        return np.concatenate([[BEGIN], used, other[:1]]), len(other)

    @cached_property
    def _contexts(self) -> np.ndarray:
        return np.unique(np.concatenate([grams >> 8 for part in self.parts for grams, _ in _value(part)]))

    @cached_property
    def node(self) -> np.ndarray:
        """Three symbols to the row of ``cost`` that has their longest known context."""
        symbols, _ = self._symbols
        short = len(symbols) ** 2
        row = np.zeros(WIDTH, int)
        row[symbols] = np.arange(len(symbols))
        known = self._contexts
        a, b, c = row[known % WIDTH], row[known // WIDTH % WIDTH], row[known // WIDTH**2]
        node = np.tile(np.arange(short, dtype=np.int32), len(symbols))
        node[(a * len(symbols) + b) * len(symbols) + c] = np.arange(short, short + len(known), dtype=np.int32)
        return node

    @cached_property
    def cost(self) -> np.ndarray:
        """The trees laid out: bits by row, symbol and language. To look at small models; scoring has no need of it."""
        symbols, others = self._symbols
        pairs = (symbols[None, :] * WIDTH + symbols[:, None]).ravel()

        def rows(contexts, order):
            grams, back = np.unique(contexts[:, None] * 256 + symbols[1:], return_inverse=True)
            found = self.bits(grams, order)[back.reshape(len(contexts), -1)]
            begin = np.full((len(contexts), 1, len(self.languages)), np.inf, np.float32)
            return np.concatenate([begin, found], 1)

        cost = np.concatenate([rows(pairs, 2), rows(self._contexts, 3)])
        if others:
            cost[:, -1] -= np.float32(np.log2(others))
        return cost


def held_out(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    """True for the documents kept out of training; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == 0


def _pieces(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Grams of whole texts in bounded pieces: ``(grams, owners' numbers, where each owner's begin)``."""
    parts, owners, total = [], [], 0
    for number, text in enumerate(texts):
        for at in range(0, len(text), CHUNK):
            # three bytes come before each part: those before it, or else they stand for the beginning
            part = (text[at - 3 : at] if at else b"\0\0\0") + text[at : at + CHUNK]
            if parts and total + len(part) > CHUNK:
                yield _joined(parts, owners)
                parts, owners, total = [], [], 0
            parts.append((part, not at))
            owners.append(number)
            total += len(part)
    if parts:
        yield _joined(parts, owners)


def _joined(parts, owners):
    starts = np.cumsum([0, *(len(part) for part, _ in parts[:-1])])
    s = np.frombuffer(b"".join(part for part, _ in parts), np.uint8).astype(np.int64)
    first = starts[[begins for _, begins in parts]]
    for k in range(3):
        s[first + k] = BEGIN
    grams = ((s[2:-1] * WIDTH + s[1:-2]) * WIDTH + s[:-3]) * 256 + s[3:]
    inner = np.ones(len(grams), bool)
    for k in range(1, 4):
        inner[starts[1:] - k] = False
    return grams[inner], np.array(owners), starts - 3 * np.arange(len(starts))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, texts = batch.column("lang"), batch.column("text")
        for lang in langs.unique():
            own = np.flatnonzero(pc.equal(langs, lang).to_numpy(zero_copy_only=False))
            for grams, _, _ in _pieces(texts[i].as_py() for i in own.tolist()):
                found, n = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(found)), pa.array(found), pa.array(n)], names=["lang", "gram", "n"])


def _shorter(grams):
    """The grams without the first byte of their context."""
    return grams // (WIDTH * 256) * 256 + grams % 256


def _summed(grams: np.ndarray, n: np.ndarray) -> Counts:
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    starts = np.flatnonzero(np.diff(grams, prepend=-1))
    return grams[starts], np.add.reduceat(n[order], starts)


def _level(grams: np.ndarray, n: np.ndarray, shorter: Level | None = None) -> Level:
    starts = np.flatnonzero(np.diff(grams >> 8, prepend=-1))
    contexts = grams[starts] >> 8
    distinct = np.diff(starts, append=len(grams))
    escapes = distinct < 256
    whole = np.add.reduceat(n, starts) + np.where(escapes, distinct, 0)
    # the share that the bytes not seen here have in the shorter context
    if shorter is None:
        rest = (256 - distinct) / 256
    else:
        seen = np.add.reduceat(shorter.n[np.searchsorted(shorter.grams, _shorter(grams))], starts)
        below = shorter.whole[np.searchsorted(shorter.contexts, contexts // WIDTH)]
        rest = (below - seen) / below
    escape = -np.log2(np.divide(distinct / whole, rest, out=np.ones(len(starts)), where=escapes))
    return Level(grams, n, -np.log2(n / np.repeat(whole, distinct)), contexts, whole, escape)


def _looked_up(levels: Sequence[Level], grams: np.ndarray) -> np.ndarray:
    """Bits of every gram's last byte after the others."""
    if not levels:
        return np.full(len(grams), 8.0)
    level, *shorter = levels
    if not len(level.grams):
        return _looked_up(shorter, _shorter(grams))
    at = np.searchsorted(level.grams, grams)
    seen = level.grams.take(at, mode="clip") == grams
    bits = level.bits.take(at, mode="clip")
    new = grams[~seen]
    context = new >> 8
    at = np.searchsorted(level.contexts, context)
    known = level.contexts.take(at, mode="clip") == context
    bits[~seen] = _looked_up(shorter, _shorter(new)) + np.where(known, level.escape.take(at, mode="clip"), 0)
    return bits


def _value(part: tuple[Counts, ...] | Broadcast) -> tuple[Counts, ...]:
    """A part's counts; what is broadcast does not stay in the process."""
    if not isinstance(part, Broadcast):
        return part
    value = part.value
    if vars(part).get("_path"):
        vars(part).pop("_value", None)
    return value


def _by_language(found: pa.Table, languages: tuple[str, ...]) -> tuple[Counts, ...]:
    of = found["lang"].combine_chunks().dictionary_encode()
    names, numbers = of.dictionary.to_pylist(), of.indices.to_numpy()
    grams, n = found["gram"].to_numpy(), found["n"].to_numpy()
    order = np.argsort(grams)
    grams, n, numbers = grams[order], n[order], numbers[order]
    own = [numbers == (names.index(lang) if lang in names else -1) for lang in languages]
    return tuple((grams[o], n[o]) for o in own)


def fit(docs: DataFrame, folds: int = FOLDS, cells: int = CELLS) -> LanguageModel | None:
    """Model of the languages of ``docs(doc_id, text, lang)``, or None without training rows.

    Rows with a null language, a null text or a held-out id teach nothing.
    """
    train = docs.filter(~held_out(folds=folds)).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").cast("binary").alias("text")
    ).dropna()
    grams = shared_table(
        train.mapInArrow(_count_grams, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")),
        "language_grams",
    )
    # at most 257 * 256 for each language
    pair = F.expr(f"gram div {WIDTH * WIDTH * 256} * 256 + gram % 256").alias("gram")
    pairs = grams.groupBy("lang", pair).agg(F.sum("n").alias("n")).toArrow()
    languages = tuple(sorted(pairs["lang"].unique().to_pylist()))
    if not languages:
        release(grams)
        return None
    # at most 257 * 257
    ending = F.expr(f"gram div {WIDTH * 256}").alias("ending")
    sizes = grams.groupBy(ending).agg(F.count("*").alias("n")).orderBy("ending").toArrow()
    n = sizes["n"].to_numpy()
    first = np.flatnonzero(np.diff((np.cumsum(n) - n) // cells, prepend=-1))
    endings = sizes["ending"].to_numpy()[first]
    if len(endings) == 1:
        parts = [_by_language(grams.toArrow(), languages)]
    else:
        parts = []
        for at, end in zip(endings.tolist(), [*endings[1:].tolist(), WIDTH**2], strict=True):
            part = grams.filter(F.col("gram").between(at * WIDTH * 256, end * WIDTH * 256 - 1)).toArrow()
            parts.append(docs.sparkSession.sparkContext.broadcast(_by_language(part, languages)))
    release(grams)
    return LanguageModel(languages, _by_language(pairs, languages), endings, tuple(parts))


def share(spark: SparkSession, model: LanguageModel | None) -> tuple[Broadcast, ...]:
    """The model as ``identify`` sends it to the workers. Its caller can destroy all that is
    returned once the result is written."""
    parts = model.parts if model is not None and len(model.parts) > 1 else ()
    return spark.sparkContext.broadcast(replace(model, parts=()) if parts else model), *parts


def code_lengths(model: LanguageModel, texts: list[bytes]) -> np.ndarray:
    """Bits of every text under every language."""
    bits = np.zeros((len(texts), len(model.languages)))
    pieces = ((*np.unique(grams, return_inverse=True), owners, starts) for grams, owners, starts in _pieces(texts))
    while held := list(islice(pieces, min(len(model.parts), WIDER))):
        known = np.unique(np.concatenate([grams for grams, *_ in held])) if len(held) > 1 else held[0][0]
        cost = model.bits(known)
        for grams, back, owners, starts in held:
            own = cost[np.searchsorted(known, grams)] if len(held) > 1 else cost
            np.add.at(bits, owners, np.add.reduceat(own[back], starts, axis=0, dtype=np.float64))
    return bits


def identify(
    docs: DataFrame, model: LanguageModel | tuple[Broadcast, ...] | None, keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``lang_pred``, ``score`` and ``bits_per_byte``.

    ``score`` is the share of the best language in the likelihoods of all. A text without
    letters, a null text, and any text under no model, is ``und`` with score 0. A model may be
    given as ``share`` returns it.
    """
    keep = ["doc_id"] if keep is None else keep
    fields = docs.select(*keep).schema
    clash = {"lang_pred", "score", "bits_per_byte"} & {f.name.lower() for f in fields}
    if clash:
        raise ValueError(f"columns {sorted(clash)} would appear twice")
    lettered = F.when(text_of().rlike(r"\p{L}"), text_of().cast("binary"))
    shared, *parts = model if isinstance(model, tuple) else share(docs.sparkSession, model)

    # only texts go to Python, and only verdicts come back; the other columns stay where they are
    @F.arrow_udf("lang_pred string, score double, bits_per_byte double")
    def verdict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = replace(shared.value, parts=tuple(parts)) if parts else shared.value
        some = TEXTS * min(max(len(parts), 1), WIDER)
        for batch in batches:
            label, score, per_byte = [UNKNOWN] * len(batch), np.zeros(len(batch)), np.zeros(len(batch))
            for at in range(0, len(batch) if model is not None else 0, some):
                data = [t or b"" for t in batch.slice(at, some).to_pylist()]
                bits = code_lengths(model, data)
                best = bits.argmin(1)
                share = 1 / np.exp2(bits.min(1, keepdims=True) - bits).sum(1)
                for i, d in enumerate(data):
                    if d:
                        label[at + i], score[at + i] = model.languages[best[i]], share[i]
                        per_byte[at + i] = bits[i, best[i]] / len(d)
            yield pa.StructArray.from_arrays(
                [pa.array(label, pa.string()), pa.array(score), pa.array(per_byte)], names=["lang_pred", "score", "bits_per_byte"]
            )

    # else a filter on the verdict would ask for it again
    once = verdict.asNondeterministic()
    work = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], once(lettered).alias("verdict"))
    return work.select(*[F.col(f"k{i}").alias(f.name) for i, f in enumerate(fields)], "verdict.*")


def identify_held_out(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, bits_per_byte)``: fit on the rows outside the
    held-out fold, predict all."""
    narrow = docs.select("doc_id", "text", "lang")
    found = identify(narrow, fit(narrow, folds=folds))
    return found.select("doc_id", held_out(folds=folds).alias("held_out"), "lang_pred", "score", "bits_per_byte")
