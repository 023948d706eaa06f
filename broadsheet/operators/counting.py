"""Totals of n-grams over many documents, counted in Arrow batches.

A task numbers the words of about ``CHUNK_WORDS`` at a time and sorts n-grams as numbers, so
strings are made only for distinct n-grams. Spark adds up what the tasks return.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

CHUNK_WORDS = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _chunks(batch: pa.RecordBatch, text: str, sets: list[str], size: int) -> Iterator[tuple]:
    """``(words, ids, doc, flags)``: distinct words, the words of some documents by their numbers, each
    one's document, and which sets a document is in."""
    lists = batch.column(text)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat, upto = pc.list_flatten(lists), np.cumsum(lengths)
    flags = [batch.column(s).to_numpy(zero_copy_only=False).astype(bool) for s in sets]
    begin = 0
    while begin < len(lengths):
        before = int(upto[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, before + size, side="right")))
        if upto[end - 1] > before:
            coded = flat.slice(before, int(upto[end - 1]) - before).dictionary_encode()
            ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            yield coded.dictionary, ids, np.repeat(np.arange(end - begin), lengths[begin:end]), [f[begin:end] for f in flags]
        begin = end


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False)


def _cells(hashed: np.ndarray, ids: np.ndarray, place: np.ndarray, n: int, cells: int) -> np.ndarray:
    """Cells of the ``n`` words from each place on."""
    of_word = hashed[ids]
    mixed = of_word[place]
    for k in range(1, n):
        mixed = mixed * _MIX + of_word[place + k]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX
    return ((mixed >> np.uint64(32)) % np.uint64(cells)).astype(np.int64)


def _places(doc: np.ndarray, n: int) -> np.ndarray:
    """Where ``n`` words of one document begin."""
    return np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :]) if len(doc) >= n else np.empty(0, np.int64)


def cell_totals(rows: DataFrame, text: str, longest: int, sets: list[str], cells: int) -> DataFrame:
    """``(cell, tf_<set>, ...)``: occurrences of all n-grams of the word lists, added up by cells of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sets), cells), np.int64)
        for batch in batches:
            for words, ids, doc, flags in _chunks(batch, text, sets, CHUNK_WORDS):
                hashed = _hashes(words)
                for n in range(1, longest + 1):
                    place = _places(doc, n)
                    at = _cells(hashed, ids, place, n, cells)
                    for i, flag in enumerate(flags):
                        total[i] += np.bincount(at if flag.all() else at[flag[doc[place]]], minlength=cells)
        found = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (found, *total[:, found])], names=names)

    names = ["cell", *[f"tf_{s}" for s in sets]]
    counted = rows.select(text, *sets).mapInArrow(run, ", ".join(f"`{n}` long" for n in names))
    return counted.groupBy("cell").agg(*[F.sum(n).alias(n) for n in names[1:]])


def ngram_totals(rows: DataFrame, text: str, longest: int, sets: list[str], heavy: Broadcast | None = None) -> DataFrame:
    """``(term, tf_<set>, df_<set>, ...)``: occurrences of n-grams of the word lists, and documents that
    hold them, over the documents of each set. With ``heavy``, a truth value for each cell, only
    n-grams of true cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if heavy is None else heavy.value
        for batch in batches:
            for words, ids, doc, flags in _chunks(batch, text, sets, CHUNK_WORDS):
                hashed = None if wanted is None else _hashes(words)
                number = ids
                for n in range(1, longest + 1):
                    place = _places(doc, n)
                    if n > 1:
                        # a number for the words before, and the last word's
                        code = np.zeros(len(ids), np.int64)
                        code[place] = number[place] * len(words) + ids[place + n - 1]
                        number = code if n == longest else np.unique(code, return_inverse=True)[1]
                    if wanted is not None:
                        place = place[wanted[_cells(hashed, ids, place, n, len(wanted))]]
                    if len(place):
                        yield _counted(words, ids, doc, flags, number, place, n)

    def _counted(words, ids, doc, flags, number, place, n) -> pa.RecordBatch:
        place = place[np.argsort(number[place], kind="stable")]  # documents stay in order
        code, of = number[place], doc[place]
        changed = np.append(True, code[1:] != code[:-1])
        first = changed | np.append(True, of[1:] != of[:-1])
        starts = np.flatnonzero(changed)
        begin = place[starts]
        term = words.take(pa.array(ids[begin]))
        for k in range(1, n):
            term = pc.binary_join_element_wise(term, words.take(pa.array(ids[begin + k])), " ")
        sums = []
        for flag in flags:
            member = flag[of]
            sums += [np.add.reduceat(member.astype(np.int64), starts), np.add.reduceat((member & first).astype(np.int64), starts)]
        return pa.RecordBatch.from_arrays([term, *map(pa.array, sums)], names=["term", *names])

    names = [f"{figure}_{s}" for s in sets for figure in ("tf", "df")]
    counted = rows.select(text, *sets).mapInArrow(run, ", ".join(["term string", *[f"`{n}` long" for n in names]]))
    # no occurrence in a set: null, as a sum over no rows
    totals = [(F.nullif(F.sum(n), F.lit(0)) if n.startswith("tf_") else F.sum(n)).alias(n) for n in names]
    return counted.groupBy("term").agg(*totals)
