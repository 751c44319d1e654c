"""SentencePiece encoding and decoding with an Aho-Corasick Viterbi.

An automaton over all pieces reads a text once; at each place its output links
name every piece that ends there, and each relaxes the best score up to that
place.  The best segmentation is the one with the greatest sum of piece
scores.  Characters without a piece become byte pieces.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import workers_import_package

SPACE = "▁"
UNKNOWN_PENALTY = 10.0          # below the lowest piece score, for a character without a piece
_REMEMBERED = 250_000           # words a worker remembers before it starts afresh
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces(dict):
    """The pieces of a model file and their automaton.  As a mapping it leads from a
    normalised word to the raw 32-bit ids of its best segmentation."""

    def __init__(self, path: str):
        super().__init__()
        import ahocorasick
        import sentencepiece
        model = self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.unknown, self.byte_ids = model.unk_id(), {}
        self.text = np.empty(n, object)
        self.scores = np.zeros(n)
        self.is_byte = np.zeros(n, bool)
        self.byte_values = np.zeros(n, np.uint8)
        self.automaton = ahocorasick.Automaton()
        self.single, self.pairs = set(), set()
        for i in range(n):
            piece, score = model.id_to_piece(i), model.get_score(i)
            self.text[i] = piece.replace(SPACE, " ")
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.is_byte[i], self.byte_values[i] = i, True, value
            elif model.is_unknown(i):
                self.text[i] = " \u2047 "
            elif model.is_control(i) or model.is_unused(i):
                self.text[i] = ""
            else:
                self.scores[i] = score
                self.automaton.add_word(piece, (len(piece), i, score))
                if len(piece) == 1:
                    self.single.add(piece)
                self.pairs.update(map("".join, zip(piece, piece[1:])))
        self.automaton.make_automaton()
        self.penalty = float(self.scores.min()) - UNKNOWN_PENALTY
        # a character without a piece is scored once, at its first byte
        lead = self.is_byte & ((self.byte_values & 0xC0) != 0x80)
        self.scores[lead] = self.penalty
        self.scores[self.unknown] = self.penalty
        # no piece reaches into the next word: words can be segmented one by one
        self.words_apart = not any(p[1] == SPACE and p[0] != SPACE for p in self.pairs)
        first = model.encode("a")
        self.prefix = bool(first) and model.id_to_piece(first[0]).startswith(SPACE)

    def segment(self, chunk: str) -> bytes:
        """Raw ids of the best segmentation of a normalised chunk."""
        n = len(chunk)
        best, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
        bare = []           # ends of characters without a piece, last first
        if not self.single.issuperset(chunk):
            bare = [i + 1 for i, c in enumerate(chunk) if c not in self.single][::-1]
        for last, hit in self.automaton.iter(chunk):
            end = last + 1
            while bare and bare[-1] <= end:
                self._bare(bare.pop(), best, back)
            total = best[end - hit[0]] + hit[2]
            if total > best[end]:
                best[end], back[end] = total, hit
        while bare:
            self._bare(bare.pop(), best, back)
        ids, at = [], n
        while at:
            hit = back[at]
            if hit[1] < 0:
                raw = chunk[at - 1].encode("utf-8", "surrogatepass")
                ids += [self.byte_ids.get(b, self.unknown) for b in reversed(raw)] if self.byte_ids else [self.unknown]
            else:
                ids.append(hit[1])
            at -= hit[0]
        ids.reverse()
        return array("i", ids).tobytes()

    def _bare(self, end: int, best: list, back: list) -> None:
        total = best[end - 1] + self.penalty
        if total > best[end]:
            best[end], back[end] = total, (1, -1)

    def __missing__(self, word: str) -> bytes:
        """No piece holds the two characters at a cut, so its parts can be segmented apart."""
        cuts = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.pairs]
        if cuts:
            raw = b"".join([self[word[i:j]] for i, j in zip([0, *cuts], [*cuts, len(word)])])
        else:
            raw = self.segment(word)
        if len(word) <= 64:
            self[word] = raw
        return raw

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        norm = text.replace(" ", SPACE)
        norm = SPACE + norm if self.prefix else norm
        if not self.words_apart:
            return np.frombuffer(self.segment(norm), np.int32)
        if len(self) > _REMEMBERED:
            self.clear()
        return np.frombuffer(b"".join(map(self.__getitem__, _WORD.findall(norm))), np.int32)

    def score(self, ids: np.ndarray) -> float:
        return float(self.scores[ids].sum())

    def decode(self, ids: np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return ""
        as_byte = self.is_byte[ids]
        edges = [0, *(np.flatnonzero(np.diff(as_byte)) + 1), len(ids)]
        text = "".join([
            self.byte_values[ids[a:b]].tobytes().decode("utf-8", "replace") if as_byte[a] else "".join(self.text[ids[a:b]])
            for a, b in zip(edges, edges[1:])])
        return text[1:] if self.prefix and text.startswith(" ") else text


_MODELS: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One automaton a worker process and model file."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def _parts(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Smaller batches: a task holds the ids of few texts at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, text, ids, n_bytes (byte pieces among them), score.

    A null or empty text has no ids.  Null and repeated ids keep their rows.
    Other columns are not read.  An empty table gives an empty table."""
    workers_import_package(docs.sparkSession)
    path = path or default_path()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in _parts(batches):
            ids = [model.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text"), pa.array(ids, pa.list_(pa.int32())),
                pa.array([int(model.is_byte[i].sum()) for i in ids], pa.int64()),
                pa.array([model.score(i) for i in ids], pa.float64())], ["doc_id", "text", "ids", "n_bytes", "score"])
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "doc_id long, text string, ids array<int>, n_bytes long, score double")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """`encoded(doc_id, ids, ...)` with the decoded text added (null ids: null)."""
    workers_import_package(encoded.sparkSession)
    path = path or default_path()
    names = encoded.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in _parts(batches):
            ids = batch.column("ids")
            texts = [model.decode(i.values.to_numpy(zero_copy_only=False)) if i.is_valid else None for i in ids]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())],
                                             [*names, "decoded"])
    return encoded.mapInArrow(run, encoded.withColumn("decoded", F.lit("")).schema)
