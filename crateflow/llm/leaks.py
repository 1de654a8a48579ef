"""Evaluation items that stand in training documents, found with a positional inverted index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from crateflow.llm.alignment import quoted_words
from crateflow.llm.words import words
from crateflow.session import cut_lineage, spread

#: Of every run of so many words of an item the rarest in the corpus is looked up. A leak of 15 words with up to three breaks holds an
#: unbroken run of four, and so do two halves with a break each: none is without a hit.
RUN = 4
#: Around such a run, ``NEAR`` of ``SPAN`` words in a row stand in the document within ``DRIFT`` words of where the run puts them: the larger
#: half of a leak has eight.
NEAR, SPAN, DRIFT = 7, 12, 3
#: Words of a leak; and of the smaller half, where it stands in two.
LEAST_WORDS, LEAST_HALF = 15, 6
#: Words of items that are held against the index at once (12 bytes each in every task); more items are taken in blocks, each against all documents.
ITEM_WORDS = 2_000_000
#: Words of documents that a task inverts at once, and hits that it intersects at once (about 100 bytes each).
PART_WORDS, PART_HITS = 2_000_000, 1_000_000


@dataclass(frozen=True)
class Items:
    """Test items as one array of term numbers (from 1; -1 separates items), with their seeds: the words to look up, sorted by term."""

    ids: list
    terms: np.ndarray
    start: np.ndarray
    length: np.ndarray
    seed_item: np.ndarray
    seed_at: np.ndarray
    seed_term: np.ndarray


def _word_rows(key: str, text: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key].to_numpy(), "_words": [words(t) for t in b[text]]})

    return run


def inverted_index(docs: DataFrame, key: str, text: str, vocabulary: dict[str, int], least: int = LEAST_WORDS) -> DataFrame:
    """(_doc, _terms): per document the number of the term at each position, 0 for words out of the vocabulary. Stored, so that texts are
    read and folded once. Documents with fewer than ``least`` words of the vocabulary are left out. Within a stored partition
    ``intersect`` inverts it to postings lists by term."""
    kind = dict(docs.dtypes)[key]
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number = known.value.get
            rows = [np.array([number(w, 0) for w in words(t)], dtype=np.int32) for t in b.column(1).to_pylist()]
            kept = np.array([np.count_nonzero(r) >= least for r in rows], dtype=bool)
            rows = [r for r, k in zip(rows, kept) if k]
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(kept)), lists], names=["_doc", "_terms"])

    rows = docs.select(F.col(key).alias("_doc"), F.col(text).alias("_text")).where(F.col("_doc").isNotNull() & F.col("_text").isNotNull())
    return cut_lineage(rows.mapInArrow(run, f"_doc {kind}, _terms array<int>"))


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(documents, terms, starts and end) of slices of a batch of the index, each of about ``PART_WORDS`` words or of one document."""
    lists = batch.column(1)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy()
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PART_WORDS, "right")) - 1)
        yield batch.column(0).slice(first, last - first).to_pylist(), values[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def term_counts(index: DataFrame, terms: int) -> np.ndarray:
    """How often each term occurs in all documents, counted in each task before the counts are summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms + 1, dtype=np.int64)
        for b in batches:
            for _, part, _ in _parts(b):
                total += np.bincount(part, minlength=terms + 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    rows = index.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()  # at most a row a term of the items
    out = np.zeros(terms + 1, dtype=np.int64)
    for r in rows:
        out[r["term"]] = r["n"]
    return out


def arrange(ids: list, sequences: list[np.ndarray], counts: np.ndarray, run: int = RUN) -> Items:
    """The items with their seeds: the rarest word of each ``run`` words in a row, the first of equals."""
    apart = np.full(run, -1, dtype=np.int32)
    start, at, terms, owner, seeds = [], run, [apart], [], []
    for i, s in enumerate(sequences):
        start.append(at)
        terms += [s, apart]
        windows = np.lib.stride_tricks.sliding_window_view(counts[s], min(run, len(s)))
        chosen = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
        owner.append(np.full(len(chosen), i))
        seeds.append(at + chosen)
        at += len(s) + run
    flat = np.concatenate(terms)
    seed_at, seed_item = np.concatenate(seeds), np.concatenate(owner)
    order = np.argsort(flat[seed_at], kind="stable")
    return Items(ids, flat, np.array(start), np.array([len(s) for s in sequences]), seed_item[order], seed_at[order], flat[seed_at][order])


def intersect(terms: np.ndarray, starts: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, item number, offset): where ``RUN`` words in a row of an item stand in a document.

    The documents' terms (``starts`` with the end) are inverted to postings lists; those of the seeds, rarest terms of the items, are
    intersected with their neighbours' lists, shifted by the words between. offset: position in the document minus position in the item.
    """
    n_docs, gap = len(starts) - 1, RUN
    size = np.diff(starts)
    owner = np.repeat(np.arange(n_docs), size)
    padded = np.zeros(len(terms) + gap * (n_docs + 1), dtype=np.int32)
    place = np.arange(len(terms)) + gap * (owner + 1)
    padded[place] = terms
    order = np.argsort(terms, kind="stable")
    order = order[np.searchsorted(terms[order], 1) :]
    lists = terms[order]
    lo, hi = np.searchsorted(lists, items.seed_term, "left"), np.searchsorted(lists, items.seed_term, "right")
    ends = np.cumsum(hi - lo)
    found: list[np.ndarray] = []
    first = 0
    while first < len(lo):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PART_HITS, "right")))
        n = (hi - lo)[first:last]
        seed = np.repeat(np.arange(first, last), n)
        at = order[np.arange(len(seed)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[first:last], n)]
        here, there = place[at], items.seed_at[seed]
        equal = {d: padded[here + d] == items.terms[there + d] for d in range(1 - gap, gap) if d}
        row = np.zeros(len(seed), dtype=bool)
        for left in range(gap):
            row |= np.logical_and.reduce([equal[d] for d in range(-left, gap - left) if d])
        seed, at = seed[row], at[row]
        doc, item = owner[at], items.seed_item[seed]
        found.append(np.stack([doc, item, (at - starts[doc]) - (items.seed_at[seed] - items.start[item])]))
        first = last
    every = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((3, 0), dtype=np.int64)
    return every[0], every[1], every[2]


def proximity(terms: np.ndarray, starts: np.ndarray, items: Items, doc: np.ndarray, item: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """The most words of ``SPAN`` in a row of the item that stand within ``DRIFT`` words of their place in the document, at each offset."""
    out = np.zeros(len(doc), dtype=np.int64)
    if not len(doc):
        return out
    width = int(items.length.max())
    step = max(1, PART_HITS // width)
    column = np.arange(width)
    for first in range(0, len(doc), step):
        d, i, o = (x[first : first + step] for x in (doc, item, offset))
        own = items.terms[np.minimum(items.start[i][:, None] + column, len(items.terms) - 1)]
        inside = column < items.length[i][:, None]
        met = np.zeros(own.shape, dtype=bool)
        for shift in range(-DRIFT, DRIFT + 1):
            place = o[:, None] + column + shift
            held = inside & (place >= 0) & (place < np.diff(starts)[d][:, None])
            met |= held & (terms[np.clip(starts[d][:, None] + place, 0, len(terms) - 1)] == own)
        total = np.concatenate([np.zeros((len(met), 1), dtype=np.int64), np.cumsum(met, axis=1)], axis=1)
        span = min(SPAN, width)
        out[first : first + step] = (total[:, span:] - total[:, :-span]).max(axis=1)
    return out


def _quoted(document: np.ndarray, item: np.ndarray, offsets: np.ndarray) -> tuple[int, int]:
    """``quoted_words`` of a document and an item near the offsets at which phrases were found; in the whole document if one passage there
    lacks a second."""
    slack = len(item) // 2 + 8
    near = np.zeros(len(document) + 1, dtype=np.int32)
    np.add.at(near, np.clip(offsets - slack, 0, len(document)), 1)
    np.add.at(near, np.clip(offsets + len(item) + slack, 0, len(document)), -1)
    at = np.flatnonzero((np.cumsum(near[:-1]) > 0) & (document > 0))
    matched, second = quoted_words(document[at], item, LEAST_HALF, LEAST_WORDS, at)
    if 2 * matched >= LEAST_WORDS and not leaked(matched, second):
        at = np.flatnonzero(document > 0)
        return quoted_words(document[at], item, LEAST_HALF, LEAST_WORDS, at)
    return matched, second


def find_leaks(docs: DataFrame, key: str, text: str, tests: DataFrame, item: str, item_text: str) -> DataFrame:
    """(item, key, matched, second): documents that hold at least 15 words of a test item in its order.

    The words stand in one passage, or two of at least ``LEAST_HALF``; few single words may be changed, added or dropped (see
    ``alignment``). Both sides' texts may be null or empty (no match); repeated rows give one result; items of fewer than 15
    words can't leak. The documents' words form a stored positional index, partitioned by document. In each partition the
    postings lists of the items' rarest terms are intersected by offset, which gives all places where four words in a row
    agree, then proximity around them; what is left is measured on the index. Neither postings nor texts are shuffled. Items beyond
    ``ITEM_WORDS`` are taken in blocks.
    """
    kind, item_kind = dict(docs.dtypes)[key], dict(tests.dtypes)[item]
    named = tests.select(F.col(item).alias("item"), F.col(item_text).alias("_text")).dropna().dropDuplicates(["item"])
    probes = cut_lineage(spread(named).mapInPandas(_word_rows("item", "_text"), f"item {item_kind}, _words array<string>").where(F.size("_words") >= LEAST_WORDS))
    total = probes.agg(F.sum(F.size("_words"))).first()[0] or 0
    blocks = max(1, -(-total // ITEM_WORDS))
    out = None
    for i in range(blocks):
        rows = probes.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i).orderBy("item").collect()  # a block of about ITEM_WORDS words
        found = _find(docs, key, text, kind, item_kind, [r["item"] for r in rows], [r["_words"] for r in rows])
        out = found if out is None else out.unionByName(found)
    best = out.groupBy("item", "_doc").agg(F.max(F.struct("matched", "second")).alias("_b"))
    return best.select(F.col("item").alias(item), F.col("_doc").alias(key), "_b.matched", "_b.second")


def _find(docs: DataFrame, key: str, text: str, kind: str, item_kind: str, ids: list, texts: list[list[str]]) -> DataFrame:
    spark = docs.sparkSession
    schema = f"item {item_kind}, _doc {kind}, matched int, second int"
    if not ids:
        return spark.createDataFrame([], schema)
    vocabulary: dict[str, int] = {}
    sequences = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in t], dtype=np.int32) for t in texts]
    index = inverted_index(docs, key, text, vocabulary)
    items = spark.sparkContext.broadcast(arrange(ids, sequences, term_counts(index, len(vocabulary))))

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = items.value
        for b in batches:
            rows = []
            for names, terms, starts in _parts(b):
                doc, item, offset = intersect(terms, starts, own)
                close = proximity(terms, starts, own, doc, item, offset) >= NEAR
                heads = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]) if len(doc) else np.zeros(0, dtype=np.int64)
                for h, e in zip(heads, [*heads[1:], len(doc)]):
                    d, i = doc[h], item[h]
                    if not close[h:e].any():
                        continue
                    matched, second = _quoted(terms[starts[d] : starts[d + 1]], own.terms[own.start[i] : own.start[i] + own.length[i]], offset[h:e])
                    if leaked(matched, second):
                        rows.append((own.ids[i], names[d], matched, second))
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["item", "_doc", "matched", "second"]).astype({"matched": "int32", "second": "int32"}), schema=arrow)

    return index.mapInArrow(run, schema)


def leaked(matched: int, second: int) -> bool:
    """Whether so many matched words make a leak."""
    return matched >= LEAST_WORDS or (matched + second >= LEAST_WORDS and second >= LEAST_HALF)
