"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives a one-pass Viterbi.

The pieces of a model file and their scores are given; nothing is trained. A text is encoded as the
sequence of pieces of greatest total score. The automaton reads the text once; at each position its
output links list all pieces that end there, longest first, and each relaxes the best score of that
position. Characters without a piece become their UTF-8 bytes' pieces. A tie goes to the longest
last piece.

Spaces become the mark U+2581 and one mark stands before the text. Where no piece has a mark after
another character, nor a line break, none reaches over the start of a run of marks or a line break, so
the best pieces of a text are those of its stretches between them; repeated stretches are then looked
up. Models without that property are encoded whole. A mark in the text itself is written as bytes, so decoding
returns every text exactly. Null is the empty text; empty text has no ids. Repeated rows are encoded
alike; an empty table stays empty; other columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitspark.llm.common import binary_texts, free_names, text_or_empty

MARK = "▁"
#: Stands for a mark that the text itself holds; U+FFFF is no character, so no piece has it.
OWN_MARK = "￿"
#: Score of a character without a piece: below the worst piece by this much.
UNKNOWN_PENALTY = 10.0
#: Stretches in a generation of what a worker remembers; it keeps two.
CACHE = 300_000


@dataclass(frozen=True)
class Pieces:
    """Texts and scores of ordinary pieces by id, and the ids of the byte pieces."""

    texts: dict[int, str]
    scores: dict[int, float]
    byte_ids: list[int]

    @property
    def splits(self) -> bool:
        """Whether no piece reaches over the start of a run of marks, or holds a line break."""
        return not any(re.search(f"[^{MARK}]{MARK}|\n", t) for t in self.texts.values())


def load_pieces(model_file: str) -> Pieces:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    texts, scores, byte_ids = {}, {}, [-1] * 256
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            texts[i], scores[i] = model.id_to_piece(i), model.get_score(i)
    if -1 in byte_ids:
        raise ValueError("the model needs a piece for every byte")
    return Pieces(texts, scores, byte_ids)


class Encoder:
    def __init__(self, pieces: Pieces) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for i, text in pieces.texts.items():
            self.automaton.add_word(text, (len(text), pieces.scores[i], i))
        self.automaton.make_automaton()
        self.unknown = min(pieces.scores.values()) - UNKNOWN_PENALTY
        self.byte_ids = pieces.byte_ids
        self.stretch = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n") if pieces.splits else None
        #: Ids (as bytes) and scores of stretches; ``old`` are those of the generation before.
        self.known: tuple[dict[str, bytes], dict[str, float]] = ({}, {})
        self.old: tuple[dict[str, bytes], dict[str, float]] = ({}, {})

    def viterbi(self, text: str) -> tuple[tuple[int, ...], float]:
        """Ids of greatest total score, and that score."""
        n = len(text)
        best = [0.0] * (n + 1)
        last: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        done = 0

        def close(upto: int) -> None:
            """Give positions that no piece reaches a byte-coded character."""
            nonlocal done
            while done < upto:
                done += 1
                if not last[done][0]:
                    best[done], last[done] = best[done - 1] + self.unknown, (1, -1)

        for end, (length, score, piece) in self.automaton.iter(text):
            end += 1
            close(end - 1)
            total = best[end - length] + score
            if not last[end][0]:
                best[end], last[end] = total, (length, piece)
                if length > 1 and best[end - 1] + self.unknown > total:
                    best[end], last[end] = best[end - 1] + self.unknown, (1, -1)
            elif total > best[end]:
                best[end], last[end] = total, (length, piece)
        close(n)
        ids: list[int] = []
        at = n
        while at:
            length, piece = last[at]
            if piece >= 0:
                ids.append(piece)
            else:
                char = MARK if text[at - 1] == OWN_MARK else text[at - 1]
                ids.extend(self.byte_ids[b] for b in reversed(char.encode()))
            at -= length
        return tuple(reversed(ids)), best[n]

    def __call__(self, text: str) -> tuple[np.ndarray, float]:
        if not text:
            return np.zeros(0, np.int32), 0.0
        if OWN_MARK in text:
            # The stand-in is itself in the text: code it away piece by piece around it.
            return self._around(text)
        marked = MARK + text.replace(MARK, OWN_MARK).replace(" ", MARK)
        if self.stretch is None:
            ids, score = self.viterbi(marked)
            return np.array(ids, np.int32), score
        stretches = self.stretch.findall(marked)
        try:
            parts = list(map(self.known[0].__getitem__, stretches))
        except KeyError:
            self._learn(dict.fromkeys(stretches))
            parts = map(self.known[0].__getitem__, stretches)
        ids = np.frombuffer(b"".join(parts), dtype=np.int32)
        return ids, sum(map(self.known[1].__getitem__, stretches))

    def _learn(self, stretches: dict[str, None]) -> None:
        if len(self.known[0]) > CACHE:
            self.known, self.old = ({}, {}), self.known
        for s in stretches:
            if s not in self.known[0]:
                if s in self.old[0]:
                    self.known[0][s], self.known[1][s] = self.old[0][s], self.old[1][s]
                else:
                    ids, score = self.viterbi(s)
                    self.known[0][s], self.known[1][s] = np.array(ids, np.int32).tobytes(), score

    def _around(self, text: str) -> tuple[np.ndarray, float]:
        """A text with U+FFFF: Viterbi between its occurrences, their bytes at them."""
        own = [self.byte_ids[b] for b in OWN_MARK.encode()]
        ids: list[int] = []
        score = 0.0
        for i, part in enumerate(text.split(OWN_MARK)):
            if i:
                ids.extend(own)
                score += self.unknown
            marked = (MARK if not i else "") + part.replace(MARK, OWN_MARK).replace(" ", MARK)
            if marked:
                more, s = self.viterbi(marked)
                ids.extend(more)
                score += s
        return np.array(ids, np.int32), score


class Decoder:
    def __init__(self, pieces: Pieces) -> None:
        self.bytes = {i: t.replace(MARK, " ").encode() for i, t in pieces.texts.items()}
        self.bytes.update((i, bytes([b])) for b, i in enumerate(pieces.byte_ids))

    def __call__(self, ids) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_ENCODERS: dict[tuple[int, int], Encoder] = {}


def worker_encoder(pieces) -> Encoder:
    """One encoder, with what it remembers, for all tasks of a worker that share ``pieces``."""
    key = (len(pieces.value.texts), hash(frozenset(pieces.value.texts.items())))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(pieces.value)
    return _ENCODERS[key]


def _with(schema: T.StructType, *added: T.StructField) -> T.StructType:
    names = {f.name for f in added}
    return T.StructType([f for f in schema.fields if f.name not in names] + list(added))


def encode(docs: DataFrame, model_file: str | None = None, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` (all columns if None) with ids, n_tokens and score; columns of those names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model_file or default_model()))
    kept = [c for c in (docs.columns if carry is None else carry) if c not in ("ids", "n_tokens", "score")]
    rows = docs.select(*kept, text_or_empty(text).alias(free_names(kept, "_text")[0]))
    schema = _with(
        docs.select(*kept).schema,
        T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("n_tokens", T.LongType(), False),
        T.StructField("score", T.DoubleType(), False),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared)
        for batch in batches:
            texts = binary_texts(batch.column(batch.num_columns - 1))
            found = [encoder(t.decode()) for t in texts]
            sizes = [len(ids) for ids, _ in found]
            values = np.concatenate([ids for ids, _ in found]) if found else np.zeros(0, np.int32)
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
            columns = [
                *batch.columns[:-1],
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                pa.array(sizes, pa.int64()),
                pa.array([s for _, s in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "ids", "n_tokens", "score"])

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, model_file: str | None = None, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in column ``into``; null ids give null."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(model_file or default_model()))
    kept = [c for c in encoded.columns if c != into]
    schema = _with(encoded.select(*kept).schema, T.StructField(into, T.StringType(), True))
    place = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            column = batch.column(place)
            values = column.values.to_numpy(zero_copy_only=False)
            offsets = column.offsets.to_pylist()
            valid = column.is_valid().to_pylist()
            texts = [decoder(values[a:b].tolist()) if ok else None for a, b, ok in zip(offsets, offsets[1:], valid)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, into])

    return encoded.select(*kept).mapInArrow(run, schema)


def op1(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """doc_id, ids, n_tokens, score, and whether decoding gives the text back."""
    rows = docs.select("doc_id", text_or_empty().alias("source_text"))
    coded = decode(encode(rows, model_file, "source_text"), model_file)
    return coded.select("doc_id", "ids", "n_tokens", "score", (F.col("decoded") == F.col("source_text")).alias("round_trip"))
