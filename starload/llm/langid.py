"""Language identification by hyperdimensional profiles of letter trigrams.

Each letter class has a random vector of +1 and -1. A trigram ``abc`` is bound as
``shift(shift(a)) * shift(b) * c`` (element-wise products of permuted letter vectors), a text is
the bundle (sum) of its trigrams' vectors, and a language's prototype is the bundle of its
training texts. A text gets the language whose prototype has the largest cosine.

Letters are lower-cased; a-z have classes of their own, all other letters share 37 classes by
code point, and a run of anything else is one gap. Bundling is linear, so trigrams are counted
first and each distinct one is bound once per block of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.frames import binary_column
from starload.llm.textbytes import slices

DIMENSIONS = 512
#: Of a language's labelled texts of one length, the share that its limit may turn away; classes of length; labelled texts a limit needs.
BELOW = 0.005
SIZES = 16
ENOUGH = 50
#: How the limit falls from one class of length to the next shorter one where there are no texts to tell.
SHORTER = 0.7
CLASSES = 64
SEED = 17

_made: dict[str, np.ndarray] = {}


def letter_classes() -> np.ndarray:
    """Class of each code point: 0 no letter, 1-26 a-z, 27-63 other letters."""
    if "classes" not in _made:
        points = np.arange(0x110000)
        letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
        table = np.where(letter, 27 + points % 37, 0).astype(np.uint8)
        table[97:123] = np.arange(1, 27)
        table[65:91] = np.arange(1, 27)
        _made["classes"] = table
    return _made["classes"]


def letter_vectors(dimensions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random letter vectors, shifted by two, one and no places."""
    key = f"v{dimensions}"
    if key not in _made:
        base = np.random.default_rng(SEED).integers(0, 2, (CLASSES, dimensions), dtype=np.int8) * 2 - 1
        _made[key] = np.stack([np.roll(base, 2, axis=1), np.roll(base, 1, axis=1), base]).astype(np.int8)
    return tuple(_made[key])


def bind(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """The bound vectors of trigram codes (base-64 digits), one row each."""
    first, second, third = letter_vectors(dimensions)
    return (first[codes >> 12] * second[codes >> 6 & 63] * third[codes & 63]).astype(np.float32)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All trigram codes with the row of each, and which rows hold a letter."""
    joined = "\0" + "\0".join(t.replace("\0", " ") for t in texts).lower()
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    code = letter_classes()[points]
    row = np.cumsum(points == 0) - 1
    has = np.zeros(len(texts), dtype=bool)
    has[row[code > 0]] = True
    keep = code > 0
    keep[1:] |= code[:-1] > 0
    keep |= points == 0
    code, row = code[keep].astype(np.int32), row[keep]
    same = row[2:] == row[:-2]
    return (code[:-2] << 12 | code[1:-1] << 6 | code[2:])[same], row[2:][same], has


def _texts(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[int, int, list[str]]]:
    for i, j, data, offs in slices(binary_column(batch, text), 1 << 19):
        raw = data.tobytes()
        yield i, j, [raw[a:b].decode() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]


def count_trigrams(training: DataFrame) -> DataFrame:
    """``lang, code, n``: trigram counts of each language, summed per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for i, j, texts in _texts(batch):
                code, row, _ = trigrams(texts)
                own = langs[i:j]
                for lang in set(own.tolist()):
                    mine = code[(own == lang)[row]]
                    counts[lang] = counts.get(lang, 0) + np.bincount(mine, minlength=CLASSES ** 3)
        for lang, n in counts.items():
            code = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * code.size, pa.string()), pa.array(code.astype(np.int32)),
                                              pa.array(n[code].astype(np.int64))], ["lang", "code", "n"])

    rows = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    return rows.mapInArrow(run, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def fit(training: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes as unit vectors, learned from all rows with text and lang.

    The driver gets one counter per language and trigram class: at most 64**3 per language,
    however many documents there are.
    """
    counts = count_trigrams(training).toPandas()
    langs = sorted(counts["lang"].unique())
    prototypes = np.zeros((len(langs), dimensions))
    for k, lang in enumerate(langs):
        mine = counts[counts["lang"] == lang]
        code, n = mine["code"].to_numpy(), mine["n"].to_numpy(dtype=float)
        for i in range(0, code.size, 16384):
            prototypes[k] += n[i:i + 16384] @ bind(code[i:i + 16384], dimensions)
        prototypes[k] /= np.linalg.norm(prototypes[k]) or 1.0
    return langs, prototypes


def cosines(texts: list[str], prototypes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosine of each text with each prototype, and which texts hold a letter."""
    code, row, has = trigrams(texts)
    used = np.flatnonzero(np.bincount(code, minlength=CLASSES ** 3))
    place = np.zeros(CLASSES ** 3, dtype=np.int64)
    place[used] = np.arange(used.size)
    vectors = bind(used, prototypes.shape[1])
    bundles = np.zeros((len(texts), prototypes.shape[1]), dtype=np.float32)
    step = max(1, (1 << 21) // max(1, used.size))
    for i in range(0, len(texts), step):
        j = min(i + step, len(texts))
        a, b = np.searchsorted(row, [i, j])
        counts = np.bincount((row[a:b] - i) * used.size + place[code[a:b]], minlength=(j - i) * used.size)
        bundles[i:j] = counts.reshape(j - i, used.size).astype(np.float32) @ vectors
    norms = np.linalg.norm(bundles.astype(np.float64), axis=1)
    return bundles @ prototypes.T / np.where(norms > 0, norms, 1.0)[:, None], has


def size_class(texts: list[str]) -> np.ndarray:
    """The class of a text's length: 0 to 7 characters, 8 to 15, 16 to 31, and so on, up to ``SIZES``."""
    return np.array([min(SIZES - 1, max(0, len(t).bit_length() - 3)) for t in texts], dtype=np.int64)


def gate(training: DataFrame, langs: list[str], prototypes: np.ndarray, below: float = BELOW) -> np.ndarray:
    """The least cosine ``[language, size class]`` of a text that belongs to a language.

    It is the ``below`` quantile of the cosines of the labelled texts with their own language's prototype, by length:
    short texts hold few trigrams and lie farther from it. A class with fewer than ``ENOUGH`` labelled texts takes the
    limit of the next shorter class that has them, else ``SHORTER`` times that of the next longer one; a language without
    any has no limit (-1). Quantiles come from an aggregate: one number for each language and class reaches the driver.
    """
    limits = np.full((len(langs), SIZES), -1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {lang: k for k, lang in enumerate(langs)}
        for batch in batches:
            own = np.array([number.get(x, -1) for x in batch.column("lang").to_pylist()], dtype=np.int64)
            for i, j, texts in _texts(batch):
                cos, has = cosines(texts, prototypes)
                use = np.flatnonzero(has & (own[i:j] >= 0))
                lang = own[i:j][use]
                yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(size_class(texts)[use]), pa.array(cos[use, lang].astype(float))],
                                                 ["lang", "size", "cosine"])

    if langs:
        rows = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
        found = (rows.mapInArrow(run, "lang long, size long, cosine double").groupBy("lang", "size")
                 .agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("cosine", below, 10_000).alias("least")))
        for r in found.where(F.col("n") >= ENOUGH).collect():
            limits[r["lang"], r["size"]] = r["least"]
        for k in range(1, SIZES):
            limits[:, k] = np.where(limits[:, k] == -1, limits[:, k - 1], limits[:, k])
        for k in range(SIZES - 2, -1, -1):
            limits[:, k] = np.where((limits[:, k] == -1) & (limits[:, k + 1] > 0), SHORTER * limits[:, k + 1], limits[:, k])
    return limits


def filter_known(docs: DataFrame, langs: list[str], prototypes: np.ndarray, limits: np.ndarray, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text has a letter and reaches its nearest language's limit (see ``gate``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in _texts(batch, text):
                keep = np.zeros(j - i, dtype=bool)
                if langs:
                    cos, has = cosines(texts, prototypes)
                    best = cos.argmax(axis=1)
                    keep = has & (cos[np.arange(j - i), best] >= limits[best, size_class(texts)])
                yield batch.slice(i, j - i).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every whole text; score is the best cosine, not below 0.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if no
    language was learned. Ties go to the first language by code point. Repeated rows and null
    ids give one row each; further columns are not read. Map-only.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in _texts(batch):
                pred, score = ["und"] * (j - i), np.zeros(j - i)
                if langs:
                    cos, has = cosines(texts, prototypes)
                    best = cos.argmax(axis=1)
                    pred = [langs[b] if h else "und" for b, h in zip(best.tolist(), has.tolist())]
                    score = np.where(has, np.clip(cos.max(axis=1), 0.0, 1.0), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(pred, pa.string()), pa.array(score)],
                                                 ["doc_id", "lang_pred", "score"])

    return (docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double"))
