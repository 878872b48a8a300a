"""Line dedup by a log-template tree: recurring templates across documents are dropped.

Lines are parsed by a tree of fixed depth: the first level is the number of tokens, the next
``DEPTH`` levels are the leading tokens, where a token with a digit is a variable field ``<*>``. Lines
of a leaf are generalised to templates: in the order of their masked texts, a line joins the
first template with which at least ``similar`` of its tokens agree, and positions that differ
become ``<*>``. A template found in at least ``min_docs`` documents recurs, and its lines are dropped in all
of them but the first, so that no text is lost from the corpus. Two kinds of masked lines recur by themselves, without
a template: lines too short for one in at least ``short_docs`` documents, and lines of at least
``EXACT_WORDS`` words, which are not the same by chance, in ``EXACT_DOCS``.

Leaves with fewer lines than that cannot hold a recurring line and are left out
first. Equal masked lines are counted before the shuffle, so a line that every document
has costs one row per task. A leaf is never split, so the result is the same at every size: the distinct lines of a leaf
meet in one task, which holds its templates and finds a line's by its pieces instead of trying all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.frames import cut

DEPTH = 3
#: Templates of a leaf from which on lines look theirs up by pieces.
INDEXED = 64
#: Production parameters: documents a template recurs in, tokens of a line at least, share of agreeing tokens.
MIN_DOCS = 4
MIN_TOKENS = 4
SIMILAR = 0.8
#: Documents a line of fewer tokens recurs in; words without a digit of a line that recurs from ``EXACT_DOCS`` documents on.
SHORT_DOCS = 12
EXACT_WORDS = 20
EXACT_DOCS = 2

TOKEN_GAP = r"[ \t\x0B\f\r]+"
VARIABLE = r"[^ ]*[0-9][^ ]*"


def masked(lines):
    """Each line of an array: its tokens joined by single spaces, with a placeholder for each token that holds a digit.

    Most lines need neither replacement; a plain search tells. Each step is a pass of its own, so that no line
    is replaced twice.
    """
    spaced = F.transform(lines, lambda line: F.trim(F.when(line.rlike(r"[\t\x0B\f\r]|  "), F.regexp_replace(line, TOKEN_GAP, " ")).otherwise(line)))
    return F.transform(spaced, lambda line: F.when(line.rlike("[0-9]"), F.regexp_replace(line, VARIABLE, "<*>")).otherwise(line))


def parse_lines(docs: DataFrame, min_tokens: int, short_docs: int = SHORT_DOCS, depth: int = DEPTH) -> DataFrame:
    """``row_id, line_no, leaf, line`` (masked), ``line_hash, exact, long`` of every line with a token that holds no digit.

    ``exact`` is the number of documents from which on the line recurs by itself (null: it does not); ``long``
    says that it has ``min_tokens`` tokens and may recur by its template, digits in all tokens or not.
    """
    # the tokens are counted before the lines are dealt out: the planner would repeat it for each use
    parsed = F.transform(masked(F.split("text", "\n")), lambda line: F.struct(
        line.alias("line"), F.size(F.split(line, " ")).alias("size"), F.substring_index(line, " ", depth).alias("lead"),
        F.when(line.contains("<*>"), F.size(F.array_remove(F.split(line, " "), "<*>"))).alias("words")))
    lines = docs.select("row_id", F.posexplode(parsed).alias("line_no", "l")).select("row_id", "line_no", "l.*")
    size, words = F.col("size"), F.coalesce("words", "size")
    exact = F.when(size < min_tokens, F.lit(short_docs)).when(words >= EXACT_WORDS, F.lit(EXACT_DOCS))
    return (lines.where("line <> ''").where((size >= min_tokens) | (words > 0))
            .select("row_id", "line_no", F.xxhash64("size", "lead").alias("leaf"), "line", F.xxhash64("line").alias("line_hash"),
                    exact.cast("int").alias("exact"), (size >= min_tokens).alias("long")))


class Templates:
    """The templates of one leaf, built in the order in which lines come.

    A line that differs from a template in at most ``d`` places equals it in one of ``d + 1`` pieces, so
    templates that share no piece with the line need not be compared. The leading tokens, equal in all of
    a leaf, are left out of the pieces where enough others are there.
    """

    def __init__(self, similar: float):
        self.similar = similar
        self.words: dict[str, int] = {"<*>": 0}
        self._reset(0)

    def _reset(self, size: int) -> None:
        self.rows, self.used = np.zeros((4, size), dtype=np.int64), 0
        self.least = next(k for k in range(size + 2) if k >= self.similar * size)
        pieces = min(size - self.least + 1, size)
        first = min(DEPTH, size - pieces) if self.least else 0
        self.edges = [first + (size - first) * k // pieces for k in range(pieces + 1)] if pieces > 0 else []
        self.held: dict[tuple[int, bytes], list[int]] | None = None

    def _hold(self, k: int) -> None:
        row = self.rows[k]
        for at in zip(self.edges, self.edges[1:]):
            numbers = self.held.setdefault((at[0], row[at[0]:at[1]].tobytes()), [])
            if not numbers or numbers[-1] != k:
                numbers.append(k)

    def _first(self, codes: np.ndarray) -> int | None:
        """The first template of which enough tokens agree."""
        if self.held is None:
            best = np.flatnonzero((self.rows[: self.used] == codes).sum(axis=1) >= self.least)
            return int(best[0]) if best.size else None
        near = set()
        for i, j in zip(self.edges, self.edges[1:]):
            near.update(self.held.get((i, codes[i:j].tobytes()), ()))
        if not near:
            return None
        near = np.sort(np.fromiter(near, np.int64, len(near)))
        best = np.flatnonzero((self.rows[near] == codes).sum(axis=1) >= self.least)
        return int(near[best[0]]) if best.size else None

    def add(self, line: str) -> int:
        """The number of the line's template."""
        codes = np.array([self.words.setdefault(t, len(self.words)) for t in line.split(" ")], dtype=np.int64)
        if self.rows.shape[1] != codes.size:
            self._reset(codes.size)
        k = self._first(codes)
        if k is not None:
            differs = self.rows[k] != codes
            if self.rows[k][differs].any():
                self.rows[k][differs] = 0
                if self.held is not None:
                    self._hold(k)
            return k
        if self.used == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.used] = codes
        self.used += 1
        if self.held is not None:
            self._hold(self.used - 1)
        elif self.used >= INDEXED and self.least > 0:
            self.held = {}
            for known in range(self.used):
                self._hold(known)
        return self.used - 1


def _cluster(similar: float):
    """Lines sorted by leaf and text: each line with its template's number in the leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, templates = None, None
        for batch in batches:
            number = []
            for leaf, line in zip(*(batch.column(c).to_pylist() for c in ("leaf", "line"))):
                if leaf != at:
                    at, templates = leaf, Templates(similar)
                number.append(templates.add(line))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("leaf", "line_hash")), pa.array(number, pa.int64())],
                                             ["leaf", "line_hash", "template"])

    return run


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, similar: float = SIMILAR,
                    short_docs: int = SHORT_DOCS) -> DataFrame:
    """``row_id, line_no`` of the lines to drop, some twice; ``docs`` holds ``row_id`` (one document) and ``text``."""
    lines = parse_lines(docs, min_tokens, short_docs)
    many = F.col("n") >= min_docs
    busy = (lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.min("exact").alias("least"))
            .where(many | (F.col("n") >= F.col("least"))).select("leaf", many.alias("many")))
    may = F.col("long") & F.col("many")
    near = cut(lines.join(busy, "leaf").where(may | F.col("exact").isNotNull())
               .select("row_id", "line_no", "leaf", F.when(may, F.col("line")).alias("line"), "line_hash", "exact", may.alias("may")))
    distinct = near.where("may").select("leaf", "line_hash", "line").distinct()
    numbered = (distinct.repartition("leaf").sortWithinPartitions("leaf", "line")
                .mapInArrow(_cluster(similar), "leaf long, line_hash long, template long"))
    placed = cut(numbered)
    # a document with several lines of one template counts once
    member = near.where("may").select("leaf", "line_hash", "row_id", "line_no").join(placed, ["leaf", "line_hash"])
    again = (member.select("leaf", "template", "row_id").distinct().groupBy("leaf", "template")
             .agg(F.count(F.lit(1)).alias("docs"), F.min("row_id").alias("first")).where(F.col("docs") >= min_docs))
    alone = near.where("exact is not null").select("line_hash", "row_id", "line_no", "exact")
    same = (alone.select("line_hash", "row_id", "exact").distinct().groupBy("line_hash", "exact")
            .agg(F.count(F.lit(1)).alias("docs"), F.min("row_id").alias("first")).where(F.col("docs") >= F.col("exact"))
            .select("line_hash", "first"))
    return (member.join(again, ["leaf", "template"]).where("row_id <> first").select("row_id", "line_no")
            .unionByName(alone.join(same, "line_hash").where("row_id <> first").select("row_id", "line_no")))


def drop_recurring(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, similar: float = SIMILAR,
                   doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None, short_docs: int = SHORT_DOCS) -> DataFrame:
    """``doc_id, text`` (and the columns of ``carry``), ``n_lines, n_dropped`` for every document, without the lines of recurring templates.

    A recurring template's lines stay in the document with the smallest id, as does a masked line of fewer than
    ``min_tokens`` tokens that is in ``short_docs`` documents or more, or one of ``EXACT_WORDS`` words that is in
    ``EXACT_DOCS``. Other lines are kept if their template is in fewer than ``min_docs`` documents; blank lines, and short
    lines with a digit in each token, always. A null
    text stays null, with no lines. A document is an id with a text (texts compared by a 32-bit hash): rows of one id
    and different texts are documents of their own, in the order of that hash; rows alike in both are one document.
    Documents with a null id come after the others. Empty tables give no rows; further columns are not read.
    """
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), *[docs[c] for c in carry or []])
    # ordered as the documents are: null ids last
    rows = rows.withColumn("row_id", F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                                              F.hash("text").alias("text")))
    drop = (recurring_lines(rows.where("text is not null").select("row_id", "text"), min_docs, min_tokens, similar, short_docs)
            .groupBy("row_id").agg(F.collect_set("line_no").alias("gone")))
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line, k: ~F.array_contains(F.col("gone"), k))
    return (rows.join(drop, "row_id", "left")
            .select("doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
                    *[F.col(c) for c in carry or []],
                    F.coalesce(F.when(F.col("text").isNotNull(), F.size(lines)), F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
            .withColumn("n_dropped", F.greatest("n_dropped", F.lit(0).cast("long"))))
