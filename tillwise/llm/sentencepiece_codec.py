"""SentencePiece encoding and decoding that keeps original byte offsets.

The library segments. The alignment is made here: the text is normalised by longest prefix
through the model's compiled character map while every output byte remembers the source byte
range it came from, and each piece is then projected on to the original bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillwise.llm.common import passed_through

_SPACE_PIECE = "▁".encode()
_OUT_ROWS = 256


class CharMap:
    """The compiled character map: a double-array trie over UTF-8 prefixes, then texts."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, int]:
        """(length, place of the replacement) of the longest known prefix; length 0: none."""
        units, found, place = self.units, 0, 0
        if not units:
            return 0, 0
        node = 0
        unit = units[0]
        node ^= (unit >> 10) << ((unit & (1 << 9)) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & ((1 << 31) | 0xFF) != data[i]:
                break
            node ^= (unit >> 10) << ((unit & (1 << 9)) >> 6)
            if (unit >> 8) & 1:
                found, place = i - at + 1, units[node] & ((1 << 31) - 1)
        return found, place

    def replacement(self, place: int) -> bytes:
        return self.texts[place : self.texts.index(b"\0", place)]


def _char_length(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Normalizer:
    """Normalised bytes with, for each, the start of its source and one closing entry."""

    def __init__(self, blob: bytes, dummy_prefix: bool, squeeze: bool, escape: bool):
        self.map, self.identity = CharMap(blob), not blob
        self.dummy_prefix, self.squeeze, self.escape = dummy_prefix, squeeze, escape

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        data = text.encode()
        if self.identity and not self.squeeze:
            return self._unmapped(data)
        return self._mapped(data)

    def _unmapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """No map and no squeezing: only the prefix is added and spaces become pieces."""
        if not data:
            return b"", np.zeros(1, np.int64)
        width = len(_SPACE_PIECE) if self.escape else 1
        raw = np.frombuffer(data, np.uint8)
        source = np.repeat(np.arange(len(raw)), np.where(raw == 32, width, 1))
        out = data.replace(b" ", _SPACE_PIECE) if self.escape else data
        if self.dummy_prefix:
            out = (_SPACE_PIECE if self.escape else b" ") + out
            source = np.concatenate((np.zeros(width, np.int64), source))
        return out, np.append(source, len(data))

    def _steps(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        at = 0
        while at < len(data):
            length, place = self.map.longest(data, at)
            if length:
                yield at, at + length, self.map.replacement(place)
            else:
                length = _char_length(data[at])
                yield at, at + length, data[at : at + length]
            at += length

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        space = _SPACE_PIECE if self.escape else b" "
        steps = list(self._steps(data))
        low, high = 0, len(steps)
        if self.squeeze:
            while low < high and steps[low][2].strip(b" ") == b"":
                low += 1
        out, source = bytearray(), []
        if low == high:
            return b"", np.zeros(1, np.int64)
        last_was_space = self.squeeze
        begin = steps[low][0]
        if self.dummy_prefix:
            out += space
            source += [begin] * len(space)
        for start, _, piece in steps[low:high]:
            if self.squeeze and last_was_space:
                piece = piece.lstrip(b" ")
            if not piece:
                continue
            last_was_space = piece.endswith(b" ")
            piece = piece.replace(b" ", space)
            out += piece
            source += [start] * len(piece)
        closing = len(data)
        if self.squeeze:
            while out.endswith(space):
                closing = source[len(out) - len(space)]
                del out[len(out) - len(space) :], source[len(source) - len(space) :]
        return bytes(out), np.array([*source, closing], np.int64)


@lru_cache(2)
def load(path: str, add_eos: bool = False):
    """(processor, normaliser, bytes that each id spells) of a model file; -1: the id is unknown
    and spells as many bytes as the text has there."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    processor = sentencepiece.SentencePieceProcessor(model_file=path, add_eos=add_eos)
    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    kinds = proto.ModelProto.SentencePiece
    spelt = {kinds.BYTE: lambda p: 1, kinds.CONTROL: lambda p: 0, kinds.UNKNOWN: lambda p: -1}
    lengths = np.array(
        [spelt.get(p.type, lambda p: len(p.piece.encode()))(p) for p in model.pieces], np.int64
    )
    normalise = Normalizer(
        spec.precompiled_charsmap,
        spec.add_dummy_prefix,
        spec.remove_extra_whitespaces,
        spec.escape_whitespaces,
    )
    return processor, normalise, lengths


def project(
    ids: np.ndarray, lengths: np.ndarray, norm: bytes, source: np.ndarray, pieces: Callable
) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every id in the original text."""
    spelt = lengths[ids]
    if (spelt < 0).any():  # unknown ids: ask for their surface forms
        forms = pieces()
        spelt = np.array([len(f.encode()) if n < 0 else n for f, n in zip(forms, spelt)], np.int64)
    cuts = np.concatenate(([0], np.cumsum(spelt)))
    if cuts[-1] != len(norm):
        raise ValueError(f"pieces spell {cuts[-1]} bytes, the normalised text has {len(norm)}")
    return source[cuts[:-1]], source[cuts[1:]]


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    cuts = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=cuts[1:])
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(rows).astype(np.int32)))


def encode(docs: DataFrame, model_path: str, add_eos: bool = True) -> DataFrame:
    """(row, ids, starts, ends, decoded) for every row of ``docs``.

    ``row`` holds the input columns. ``ids`` are those of the library, without sampling;
    ``starts``/``ends`` are byte offsets of each id in the original UTF-8 text (an end id spans
    nothing); ``decoded`` is the library's text for the ids. A NULL text is encoded as empty.
    The model's path must be readable where tasks run; the file is not copied.
    """
    packed = passed_through(docs)
    fields = [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ]
    schema = T.StructType([packed.schema["row"], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor, normalise, lengths = load(model_path, add_eos)
        for batch in batches:
            for low in range(0, batch.num_rows, _OUT_ROWS):
                part = batch.slice(low, _OUT_ROWS)
                # taken out of the row, so a text crosses into Python once
                texts = [t or "" for t in pc.struct_field(part.column("row"), "text").to_pylist()]
                coded = processor.encode(texts, num_threads=1)
                ids, starts, ends = [], [], []
                for text, row in zip(texts, coded):
                    norm, source = normalise(text)
                    ids.append(np.array(row, np.int32))
                    first, last = project(
                        ids[-1], lengths, norm, source,
                        lambda t=text: [p.surface for p in processor.encode(t, out_type="immutable_proto").pieces],
                    )
                    starts.append(first)
                    ends.append(last)
                yield pa.record_batch(
                    [
                        part.column("row"), _lists(ids), _lists(starts), _lists(ends),
                        pa.array(processor.decode(coded), pa.string()),
                    ],
                    names=["row", "ids", "starts", "ends", "decoded"],
                )

    return packed.mapInArrow(run, schema)
