"""Toxicity by nearest labelled examples: exact TF-IDF cosine through a block-max inverted index.

A bounded sample of labelled documents is the index; its vocabulary is every word of the sample. Texts and
examples are unit vectors of ``(1 + log tf) * idf``. The idf is the squared delta idf: the smoothed log ratio
of a word's document frequencies among toxic and other examples, so that words that say nothing about
the label weigh next to nothing without any of them being left out.

Examples are sorted by their strongest words and cut into blocks. For each word the inverted index lists the
blocks that hold it, with the word's maximal weight there and its postings. The words of a text that can add least to
any cosine, by the maxima of their lists, are set aside, with the sum of what they can add as a bound. By the others a
text's bound for a block is the sum of its weights times the block's maxima; the blocks of the highest bounds are scored
first, and then all whose bound reaches the k-th best score found. Examples whose score and the bound of
the words set aside reach it are compared in full, which makes the nearest examples exact.

The neighbours vote with their cosines, smoothed by the share of toxic examples; they are the evidence. Votes are
calibrated by a logistic curve fitted to cross-validated votes of the sample's own examples.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.frames import binary_column
from starload.llm.textbytes import LOWER, NOT_ALNUM, hash_spans, slices, spans

#: Labelled documents fitted on (those with the smallest id hashes).
SAMPLE = 4096
#: Documents by which the frequencies of a word are smoothed towards the sample's share of toxic examples.
SMOOTHING = 4.0
#: Neighbours that vote, examples of a block, blocks scored before bounds are used, and the weight of the prior in the vote.
NEIGHBOURS = 15
BLOCK = 64
FIRST = 4
PRIOR_WEIGHT = 1.0
#: Share of what a text's words can add to a cosine that the words set aside hold at most.
REST = 0.02
#: Folds of the calibration.
FOLDS = 5


def words_of(texts: list[str]) -> list[np.ndarray]:
    """Word hashes of each text: runs of ASCII letters, digits and longer characters, A-Z lower-cased."""
    out = []
    for _, _, data, offs in slices(pa.array([t.encode() for t in texts], pa.large_binary())):
        out.extend(_words(data, offs))
    return out


def _words(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    data = LOWER[data]
    starts, ends, first = spans(data, offs, NOT_ALNUM)
    hashes = hash_spans(data, starts, ends)
    return [hashes[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def term_counts(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word and count of each distinct word of each text, in that order."""
    row = np.repeat(np.arange(len(rows)), [r.size for r in rows])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    order = np.lexsort((flat, row))
    row, flat = row[order], flat[order]
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (flat[1:] != flat[:-1]))) if flat.size else np.zeros(0, np.int64)
    return row[first], flat[first], np.diff(np.append(first, flat.size))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all ranges ``starts .. starts + sizes``, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if ends.size else 0)


class Index:
    """Labelled examples as a block-max inverted index.

    ``row, term, count`` are the distinct words of the examples ``ids, labels``.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, row: np.ndarray, term: np.ndarray, count: np.ndarray):
        self.terms, word = np.unique(term, return_inverse=True)
        n, positive = ids.size, float(labels.sum())
        self.prior = positive / n if n else 0.0
        toxic, other = (np.bincount(word[labels[row] == k], minlength=self.terms.size).astype(float) for k in (1, 0))
        if 0 < positive < n:
            share = lambda docs, size: (docs + SMOOTHING * size / n) / (size + SMOOTHING)
            self.idf = np.log(share(toxic, positive) / share(other, n - positive)) ** 2
        else:
            self.idf = np.log((1 + n) / (1 + toxic + other)) + 1
        weight = self._unit(row, word, count, n)
        # examples with the same strongest words are neighbours, so that blocks hold few strong words
        strong = np.lexsort((word, -weight, row))
        first = np.searchsorted(row[strong], np.arange(n))
        has = (first < strong.size) & (row[strong][np.minimum(first, max(strong.size - 1, 0))] == np.arange(n)) if strong.size else np.zeros(n, bool)
        lead = np.where(has, word[strong][np.minimum(first, max(strong.size - 1, 0))], -1) if strong.size else np.full(n, -1)
        order = np.lexsort((ids, lead))
        self.ids, self.labels = ids[order], labels[order]
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        self.blocks = -(-n // BLOCK)
        # postings by word, block and example; an entry is the run of one word in one block
        doc = place[row]
        by = np.lexsort((doc, word))
        self.doc, self.weight = doc[by].astype(np.int32), weight[by]
        again = np.lexsort((word, doc))  # and forward: the words of each example
        self.word, self.own = word[again].astype(np.int32), weight[again]
        self.words = np.searchsorted(doc[again], np.arange(n + 1))
        word, block = word[by], doc[by] // BLOCK
        self.start = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (block[1:] != block[:-1]))) if word.size else np.zeros(0, np.int64)
        self.size = np.diff(np.append(self.start, word.size))
        self.block = block[self.start]
        self.highest = np.maximum.reduceat(self.weight, self.start) if word.size else np.zeros(0)
        self.entries = np.searchsorted(word[self.start], np.arange(self.terms.size + 1))
        self.top = np.maximum.reduceat(self.highest, self.entries[:-1]) if word.size else np.zeros(0)
        self.curve = (1.0, 0.0)

    def _unit(self, row: np.ndarray, word: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        weight = (1 + np.log(count)) * self.idf[word]
        norm = np.sqrt(np.bincount(row, weight ** 2, minlength=n))
        return weight / np.where(norm > 0, norm, 1.0)[row]

    def vectorise(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, word number and weight of the texts' unit vectors; words that no example holds are not in them."""
        row, term, count = term_counts(rows)
        at = np.minimum(np.searchsorted(self.terms, term), max(self.terms.size - 1, 0))
        known = self.terms[at] == term if self.terms.size else np.zeros(term.size, dtype=bool)
        row, word = row[known], at[known]
        return row, word, self._unit(row, word, count[known], len(rows))

    def nearest(self, texts: int, row: np.ndarray, word: np.ndarray, weight: np.ndarray,
                k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of the largest positive cosine of each text, ties to the smaller id: places (-1 for none) and cosines."""
        place, cosine = np.full((texts, k), -1), np.zeros((texts, k))
        edges = np.searchsorted(row, np.arange(texts + 1))
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            doc, score = self._nearest(word[a:b], weight[a:b], k)
            place[i, : doc.size], cosine[i, : doc.size] = doc, score
        return place, cosine

    def _nearest(self, word: np.ndarray, weight: np.ndarray, k: int, rest: float = REST) -> tuple[np.ndarray, np.ndarray]:
        """The nearest examples of one text (its words ascending) and their cosines."""
        if not word.size:
            return np.zeros(0, np.int64), np.zeros(0)
        most = weight * self.top[word]
        order = np.argsort(-most, kind="stable")
        aside = np.append(np.cumsum(most[order][::-1])[::-1][1:], 0.0)  # what the words after each can add
        used = int(np.argmax(aside <= rest * most.sum())) + 1
        bound = aside[used - 1] * (1 + 1e-9) if used < word.size else 0.0
        strong = order[:used]
        size = self.entries[word[strong] + 1] - self.entries[word[strong]]
        entry = _spread(self.entries[word[strong]], size)
        block, load = self.block[entry], np.repeat(weight[strong], size)
        bounds = np.bincount(block, load * self.highest[entry], minlength=self.blocks)
        score = np.zeros(self.ids.size)

        def visit(wanted: np.ndarray) -> float:
            """Add the scores of some blocks' examples; the k-th best score so far."""
            use = wanted[block]
            posting = _spread(self.start[entry[use]], self.size[entry[use]])
            score[:] += np.bincount(self.doc[posting], np.repeat(load[use], self.size[entry[use]]) * self.weight[posting],
                                    minlength=score.size)
            return np.partition(score, -k)[-k] * (1 - 1e-9) if score.size >= k else 0.0

        first = np.zeros(self.blocks, dtype=bool)
        first[np.argsort(-bounds, kind="stable")[:FIRST]] = True
        kth = visit(first)
        kth = visit(~first & (bounds > 0) & (bounds + bound >= kth))
        if kth <= 0 and bound > 0:
            return self._nearest(word, weight, k, 0.0)  # fewer than k share a strong word: all words count
        near = np.flatnonzero((score > 0) & (score + bound >= kth))
        size = self.words[near + 1] - self.words[near]
        posting = _spread(self.words[near], size)
        at = np.minimum(np.searchsorted(word, self.word[posting]), word.size - 1)
        part = np.where(word[at] == self.word[posting], weight[at] * self.own[posting], 0.0)
        cosine = np.bincount(np.repeat(np.arange(near.size), size), part, minlength=near.size)
        best = np.lexsort((self.ids[near], -cosine))[:k]
        best = best[cosine[best] > 0]
        return near[best], cosine[best]

    def votes(self, cosine: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Votes weighted by nearness, with the prior."""
        toxic = (cosine * self.labels[np.maximum(place, 0)]).sum(axis=1) if self.ids.size else np.zeros(len(place))
        return (toxic + PRIOR_WEIGHT * self.prior) / (cosine.sum(axis=1) + PRIOR_WEIGHT)

    def score(self, cosine: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Calibrated votes; the prior for texts without neighbours."""
        return np.where((place >= 0).any(axis=1), _curve(self.votes(cosine, place), *self.curve), self.prior)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _curve(votes: np.ndarray, slope: float, shift: float) -> np.ndarray:
    return 1 / (1 + np.exp(-(slope * _logit(votes) + shift)))


def calibrate(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits the votes to the labels (Newton steps, slightly ridged)."""
    x = np.stack([_logit(votes), np.ones(votes.size)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ beta)))
        ridge = np.diag([1e-3, 1e-3])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (labels - p) - ridge @ (beta - [1.0, 0.0]))
        beta = beta + np.clip(step, -2, 2)
    return (float(beta[0]), float(beta[1])) if np.isfinite(beta).all() and beta[0] > 0 else (1.0, 0.0)


def build(ids: np.ndarray, labels: np.ndarray, row: np.ndarray, term: np.ndarray, count: np.ndarray) -> Index:
    """The index of the examples, calibrated on votes that each fold gets from an index of the other folds."""
    index = Index(ids, labels, row, term, count)
    if 0 < labels.sum() < ids.size and ids.size >= 2 * FOLDS:
        votes, fold = np.zeros(ids.size), np.arange(ids.size) % FOLDS
        for f in range(FOLDS):
            rest, own = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            number = np.cumsum(fold != f) - 1
            learn = fold[row] != f
            other = Index(ids[rest], labels[rest], number[row[learn]], term[learn], count[learn])
            texts = [np.repeat(term[a:b], count[a:b]) for a, b in zip(*np.searchsorted(row, [own, own + 1]))]
            place, cosine = other.nearest(own.size, *other.vectorise(texts))
            votes[own] = other.votes(cosine, place)
        index.curve = calibrate(votes, labels)
    return index


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text",
        toxic: str = "toxic") -> Index:
    """The index over a sample of at most ``sample`` labelled documents (the smallest hashes of their ids).

    Labels other than 0 and 1, null ids and null texts are left out; of several labels of one id the
    largest counts, of several texts the first in binary order. No labelled rows give an index that always
    answers with the prior 0. The driver gets the sample's distinct words, whatever the size of the corpus.
    """
    chosen = (labels.where(labels[doc_id].isNotNull() & labels[toxic].isin(0, 1))
              .groupBy(labels[doc_id].alias("doc_id")).agg(F.max(labels[toxic]).cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.where(docs[text].isNotNull()).select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
            .join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in slices(binary_column(batch, "text")):
                row, term, count = term_counts(_words(data, offs))
                at = np.searchsorted(row, np.arange(j - i + 1))
                cells = [[x[a:b].tobytes() for a, b in zip(at, at[1:])] for x in (term, count.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], *(pa.array(x, pa.binary()) for x in cells)],
                                                 ["doc_id", "toxic", "terms", "counts"])

    found = (rows.select("doc_id", "toxic", "text").mapInArrow(counted, "doc_id long, toxic int, terms binary, counts binary")
             .toPandas().sort_values("doc_id"))
    terms = [np.frombuffer(x, np.uint64) for x in found["terms"]]
    counts = [np.frombuffer(x, np.int32) for x in found["counts"]]
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return build(found["doc_id"].to_numpy(dtype=np.int64), found["toxic"].to_numpy(dtype=np.int64),
                 np.repeat(np.arange(len(found)), [t.size for t in terms]), join(terms, np.uint64), join(counts, np.int32))


def score(docs: DataFrame, index: Index, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted, evidence`` for every whole text.

    ``evidence`` lists the voting examples (``doc_id, cosine, toxic``), nearest first. A text without a word of
    the vocabulary, an empty or null one included, gets the prior and no evidence. Repeated rows
    and null ids give one row each; further columns are not read. Map-only: the index is bounded by
    the sample and travels with the tasks.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in slices(binary_column(batch, "text")):
                place, cosine = index.nearest(j - i, *index.vectorise(_words(data, offs)))
                result = index.score(cosine, place)
                evidence = [[{"doc_id": int(index.ids[p]), "cosine": c, "toxic": int(index.labels[p])}
                             for p, c in zip(ps, cs) if p >= 0] for ps, cs in zip(place.tolist(), cosine.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.array(result), pa.array((result >= 0.5).astype(np.int32)),
                     pa.array(evidence, pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())])))],
                    ["doc_id", "score", "predicted", "evidence"])

    return (docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, score double, predicted int, evidence array<struct<doc_id: bigint, cosine: double, toxic: int>>"))
