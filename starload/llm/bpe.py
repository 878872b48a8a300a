"""Byte-level BPE through a sentencepiece model serialised from a rank vocabulary.

A rank file (one base64 token and its rank a line) becomes a sentencepiece BPE model
without training: bytes are written as visible characters, every token is one piece
with the negative rank as its score, and normalisation is the identity. Merging the
best-scored neighbours first, leftmost on ties, is then the merge order of the ranks.
Pre-tokens are encoded one by one; a token that is in the vocabulary but is not
reached by merges keeps its own id, as whole pre-tokens are looked up first.

Texts are cut where a pre-token surely ends, so that a repeated word is encoded once per
Python worker and its ids are gathered for all rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from starload.llm.frames import binary_column
from starload.llm.textbytes import hash_spans, slices

#: Distinct stretches kept per Python worker before the table is started anew (about 40 MB).
CACHE_WORDS = 1_000_000
#: White space other than the six ASCII blanks; rows holding it are encoded whole.
RARE_BLANK = regex.compile(r"[^\S\x20\x09-\x0D]")
#: Kind of a byte: 1 blank, 2 ASCII letter, 3 ASCII punctuation, 4 may belong to rare white space, 0 any other.
BYTE_KIND = np.array([1 if b == 32 or 9 <= b <= 13 else 2 if b < 128 and chr(b).isalpha() else 3 if 33 <= b <= 126 and not chr(b).isalnum()
                      else 4 if b in (0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3) else 0 for b in range(256)])


def byte_characters() -> list[str]:
    """A visible character for each byte: printable Latin-1 as itself, the rest from U+0100 on in byte order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in the order of their ranks, which must run from 0 without a gap."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without a gap")
    return [tokens[i] for i in range(len(tokens))]


def model_bytes(tokens: list[bytes]) -> bytes:
    """The serialised sentencepiece model: ids are ranks, and one unused unknown piece follows."""
    shown = dict(enumerate(byte_characters()))
    pieces = [_field(1, _field(1, t.decode("latin-1").translate(shown).encode()) + _field(2, float(-rank)) + _field(3, 1))
              for rank, t in enumerate(tokens)]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    no_id = 2 ** 64 - 1  # -1 as a varint
    trainer = (_field(3, 2) + _field(4, len(pieces)) + _field(24, 0) + _field(35, 0) + _field(40, len(tokens))
               + _field(41, no_id) + _field(42, no_id) + _field(43, no_id))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        self.shown = dict(enumerate(byte_characters()))
        self.pattern = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.tokens))
        texts = [t.decode("latin-1").translate(self.shown) for t in self.tokens]
        merged = self.model.encode(texts, num_threads=1)
        self.unmerged = {t: rank for rank, (t, ids) in enumerate(zip(texts, merged)) if ids != [rank]}
        self.forget()

    def pieces(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, pre-token by pre-token; one call of the model for all."""
        words = [[m.encode().decode("latin-1").translate(self.shown) for m in self.pattern.findall(t)] for t in texts]
        flat = [w for row in words for w in row]
        got = iter(self.model.encode(flat, num_threads=1) if flat else [])
        out = []
        for row in words:
            ids: list[int] = []
            for word in row:
                own = next(got)
                ids.extend(own if word not in self.unmerged else [self.unmerged[word]])
            out.append(ids)
        return out

    def units(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Starts of stretches that can be encoded apart: no pre-token spans one.

        An edge lies before a space that precedes a non-space, and between a letter (ASCII or
        U+00C0-U+00FF) and ASCII punctuation. Rows holding other white space stay whole.
        """
        n = data.size
        edge = np.zeros(n + 1, dtype=bool)
        edge[offs] = True
        kind = BYTE_KIND[data]
        blank = kind == 1
        cut = edge[:-1].copy()
        cut[:-1] |= (data[:-1] == 32) & ~blank[1:]
        letter = kind == 2
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7) & (data[1:] >= 128)
        cut[1:] |= letter[:-1] & (kind[1:] == 3)
        odd = np.flatnonzero(kind == 4)
        for i in np.unique(np.searchsorted(offs, odd, side="right") - 1):
            if RARE_BLANK.search(data[offs[i]: offs[i + 1]].tobytes().decode()):
                cut[offs[i] + 1: offs[i + 1]] = False
        return np.flatnonzero(cut)

    def encode_rows(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and each row's place in them."""
        n = data.size
        if not n:
            return np.zeros(0, np.int32), np.zeros(offs.size, np.int64)
        starts = self.units(data, offs)
        ends = np.append(starts[1:], n)
        unit, first, index = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if self.known.size > CACHE_WORDS:
            self.forget()
        at = np.searchsorted(self.known, unit)
        new = np.flatnonzero(self.known[np.minimum(at, self.known.size - 1)] != unit)
        if new.size:
            texts = [data[i:j].tobytes().decode() for i, j in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            self.learn(unit[new], self.pieces(texts))
            at = np.searchsorted(self.known, unit)
        size = self.size[at][index]
        place = np.cumsum(size)
        steps = np.arange(place[-1]) - np.repeat(place - size - self.begin[at][index], size)
        return self.ids[steps], np.append(0, place)[np.searchsorted(starts, offs)]

    def forget(self) -> None:
        """An empty table of encoded stretches (its one entry keeps look-ups in range)."""
        self.known, self.begin, self.size = np.zeros(1, np.uint64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)

    def learn(self, hashes: np.ndarray, rows: list[list[int]]) -> None:
        """Add encoded stretches to the table, which stays sorted by hash."""
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        begin = self.ids.size + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, np.fromiter((i for r in rows for i in r), np.int32, int(size.sum()))])
        place = np.searchsorted(self.known, hashes)
        self.known, self.begin, self.size = (np.insert(x, place, y) for x, y in
                                             ((self.known, hashes), (self.begin, begin), (self.size, size)))

    def decode(self, ids: list[int]) -> bytes:
        """The bytes the ids stand for."""
        return b"".join([self.tokens[i] for i in ids])


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, built once per Python worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id",
                     text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode the ids again: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    With ``keep_ids`` the column ``token_ids`` (array of int) follows. A null text is the
    empty text (no ids). Repeated rows and null ids give one row each; further columns
    are not read. Map-only: no shuffle, and memory is bounded by one batch of rows.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            texts = binary_column(batch, "text")
            for i, j, data, offs in slices(texts):
                ids, at = own.encode_rows(data, offs)
                rows = [ids[at[k]: at[k + 1]].tolist() for k in range(j - i)]
                out = [batch.column(0)[i:j], pa.array([len(r) for r in rows], pa.int64()),
                       pa.array([hashlib.sha256(" ".join(map(str, r)).encode()).hexdigest() for r in rows], pa.string()),
                       pa.array([hashlib.sha256(own.decode(r)).hexdigest() for r in rows], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    out.append(pa.array(rows, pa.list_(pa.int32())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(out, names)

    schema = (f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
              + (", token_ids array<int>" if keep_ids else ""))
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, schema)
