"""SentencePiece encoding and decoding with an Aho-Corasick automaton.

The automaton holds every piece; one pass over a text reports, at each position,
all pieces that end there (the automaton follows its output links), and each
relaxes the best score at its end: a single-pass Viterbi for the segmentation
with the greatest sum of piece scores. Characters that no piece covers become
byte pieces. Ties keep the longer last piece.

No piece has a blank after another character, so the best segmentation of a text
is that of its blank-led words in turn; a bounded cache keeps words already
segmented. The vocabulary file is read once a worker, from a path given by the
caller; it is never trained or copied.

Decoding is exact: blanks travel as U+2581, a U+2581 of the text itself as
bytes, and the blank put before the text is taken off again.

Edge cases: null texts have null pieces, empty texts none; ids may be null or
repeat, each row keeps its own result; extra columns are not read; very long
texts are encoded whole, a word at a time; ids that stand for no text, null ones
among them, decode as U+FFFD.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalendria.llm.support import lean

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
NO_TEXT = "\ufffd".encode()
#: How far the score of a byte is below the least score of a piece, and words of a generation of a worker's cache.
BYTE_PENALTY = 10.0
CACHE = 120_000
#: Blanks and the word behind them.
CHUNK = re.compile(r"▁+[^▁]*|[^▁]+")


class PieceCodec:
    """Encoder and decoder over (piece, score) pairs; ``byte_ids`` has the id of each byte's piece."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece has a blank after another character: words can't be encoded apart")
        self.byte_ids = byte_ids
        self.raw = {i: p.replace(BLANK, " ").encode() for p, (i, _) in pieces.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.joins = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.byte_score = min((score for _, score in pieces.values()), default=0.0) - BYTE_PENALTY
        self.automaton = ahocorasick.Automaton()
        for p, (i, score) in pieces.items():
            self.automaton.add_word(p, (len(p), i, score))
        self.automaton.make_automaton()
        #: ids of words as bytes, in two generations: what is asked for again outlives a full one
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.blank = np.array([byte_ids[c] for c in BLANK.encode()], np.int32).tobytes()

    @classmethod
    def load(cls, path: str) -> PieceCodec:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        normal = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        byte_ids = [0] * 256
        for i in ids:
            if sp.is_byte(i):
                byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
        return cls(normal, byte_ids)

    def viterbi(self, chunk: str) -> tuple[int, ...]:
        """Ids of the best segmentation of one blank-led word."""
        n, unreached = len(chunk), -float("inf")
        best, size_of, piece_of = [0.0] + [unreached] * n, [1] * (n + 1), [-1] * (n + 1)
        byte_score, done = self.byte_score, 0
        # matches come by end, longest first: all starts are settled by then
        for end, (size, piece, score) in self.automaton.iter(chunk):
            while done < end:  # a character may go as bytes wherever that scores better
                raw = byte_score if chunk[done] < "\x80" else byte_score * len(chunk[done].encode())
                done += 1
                if best[done - 1] + raw > best[done]:
                    best[done], size_of[done], piece_of[done] = best[done - 1] + raw, 1, -1
            s = best[end + 1 - size] + score
            if s > best[end + 1]:
                best[end + 1], size_of[end + 1], piece_of[end + 1] = s, size, piece
        for done in range(done + 1, n + 1):
            raw = byte_score * len(chunk[done - 1].encode())
            if best[done - 1] + raw > best[done]:
                best[done], size_of[done], piece_of[done] = best[done - 1] + raw, 1, -1
        out: list[int] = []
        while n:
            if piece_of[n] >= 0:
                out.append(piece_of[n])
            else:
                out.extend(self.byte_ids[c] for c in reversed(chunk[n - 1].encode()))
            n -= size_of[n]
        out.reverse()
        return tuple(out)

    def segment(self, chunk: str) -> bytes:
        """As :meth:`viterbi`, in parts: no piece spans two characters that stand side by side in no piece."""
        joins = self.joins
        cuts = [i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in joins]
        out: list[bytes] = []
        for a, b in zip([0, *cuts], [*cuts, len(chunk)], strict=True):
            part = chunk[a:b]
            ids = self.known(part) if cuts else None
            out.append(self.keep(part, np.array(self.viterbi(part), np.int32).tobytes()) if ids is None else ids)
        return self.keep(chunk, b"".join(out)) if cuts else out[0]

    def known(self, chunk: str) -> bytes | None:
        ids = self.cache.get(chunk)
        if ids is None and (ids := self.older.get(chunk)) is not None:
            self.keep(chunk, ids)
        return ids

    def keep(self, chunk: str, ids: bytes) -> bytes:
        if len(chunk) <= 64:
            if len(self.cache) >= CACHE:
                self.older, self.cache = self.cache, {}
            self.cache[chunk] = ids
        return ids

    def encode_bytes(self, text: str) -> bytes:
        """The ids of a text, four bytes each."""
        if not text:
            return b""
        out: list[bytes] = []
        literal = BLANK in text
        # a blank of the text's own is kept apart from those that stand for spaces
        for k, part in enumerate(text.split(BLANK) if literal else [text]):
            if k:
                out.append(self.blank)
            out += [self.known(chunk) or self.segment(chunk) for chunk in CHUNK.findall(("" if k else BLANK) + part.replace(" ", BLANK))]
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids. What is no text, ids outside the vocabulary and bytes that are no UTF-8, shows as U+FFFD."""
        try:
            raw = b"".join(map(self.raw.__getitem__, ids))
        except KeyError:
            raw = b"".join(self.raw.get(i, NO_TEXT) for i in ids)
        text = raw.decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


@functools.cache
def codec(path: str) -> PieceCodec:
    """The codec of a vocabulary file, one a worker."""
    return PieceCodec.load(path)


def encode_pieces(docs: DataFrame, model_path: str = DEFAULT_MODEL, text_col: str = "text", id_col: str = "doc_id", check: bool = True) -> DataFrame:
    """(doc_id, pieces array<int>, round_trip) for each row; ``round_trip`` says that decoding gives the text again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = part.column(1).to_pylist()
                ids = [None if t is None else c.encode_bytes(t) for t in texts]
                same = [None if t is None or not check else c.decode(np.frombuffer(i, np.int32).tolist()) == t for t, i in zip(texts, ids, strict=True)]
                packed = pa.array([None if i is None else np.frombuffer(i, np.int32) for i in ids], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), packed, pa.array(same, pa.bool_())], ["doc_id", "pieces", "round_trip"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, pieces array<int>, round_trip boolean")


def decode_pieces(encoded: DataFrame, model_path: str = DEFAULT_MODEL, pieces_col: str = "pieces", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text) from arrays of piece ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for b in batches:
            texts = [None if x is None else c.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(pieces_col).alias("pieces"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
