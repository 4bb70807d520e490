"""SentencePiece encoding that knows where every piece comes from, and decoding.

The model's compiled character map is a double-array trie. A text is normalised by the longest prefix that the trie
holds, again and again, and every normalised byte notes where in the text it was read. The normalised text is cut into
pieces by the library, with a copy of the model that normalises nothing any more, and that record projects each piece to
a span of the original bytes.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import apart, importable

#: The module that knows where the vocabulary files of public tokenizers lie.
TOKENIZERS = "public_tokenizers"
MODEL = "piece_bpe_32k.model"

#: What stands for a space in pieces, and for bytes that are no character.
SPACE_MARK, REPLACEMENT = "▁", "�"
_MARK = SPACE_MARK.encode()
#: Bytes of text whose arrays go back to Spark together (a longer text goes alone).
PART = 1 << 20
#: Kinds of pieces in a model file (fixed values).
USER_DEFINED, BYTE = 4, 6


def tokenizer_path(name: str, module: str = TOKENIZERS) -> str:
    """Where a vocabulary file lies on this machine: in the folder of the module, or the name itself if it is a path."""
    if "/" in name:
        return name
    found = importlib.util.find_spec(module)
    if found is None:
        raise FileNotFoundError(f"{name}: there is no module {module} beside which it could lie")
    return str(Path(found.origin).parent / name)


class CharacterMap:
    """A compiled character map: a double-array trie of byte strings, and what each of them becomes."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist() if size else []
        self.strings = compiled[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """The length of the longest entry that the data at this place begins with, and its replacement."""
        units, n = self.units, len(data)
        if not units:
            return None
        node, found = _offset(units[0]), None
        for i in range(at, n):
            node ^= data[i]
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1] : self.strings.index(b"\0", found[1])]


def _offset(unit: int) -> int:
    """How far a unit's children lie from it."""
    return unit >> 10 << ((unit & 0x200) >> 6)


def _width(data: bytes, at: int) -> int:
    """Bytes of the character here; 0 where there is none."""
    lead = data[at]
    width = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
    try:
        data[at : at + width].decode()
    except UnicodeDecodeError:
        return 0
    return width if at + width <= len(data) else 0


class Pieces:
    """A model whose every piece stands for known bytes: characters without a piece go as bytes."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        if not spec.trainer_spec.byte_fallback or any(p.type == USER_DEFINED for p in spec.pieces):
            raise ValueError("only models with byte fallback and without user-defined pieces are known")
        rule = spec.normalizer_spec
        if spec.trainer_spec.treat_whitespace_as_suffix or not rule.escape_whitespaces:
            raise ValueError("only models that mark a space before a word are known")
        self.map = CharacterMap(rule.precompiled_charsmap)
        self.dummy, self.squeeze = rule.add_dummy_prefix, rule.remove_extra_whitespaces
        #: What each id stands for, a space as such; and how many bytes that is in a normalised text.
        self.bytes = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else p.piece.replace(SPACE_MARK, " ").encode()
            for p in spec.pieces
        ]
        self.width = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in spec.pieces], np.int32)
        rule.precompiled_charsmap, rule.add_dummy_prefix, rule.remove_extra_whitespaces = b"", False, False
        self.library = SentencePieceProcessor(model_proto=spec.SerializeToString())

    def normalise(self, data: bytes) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes where in the data it comes from; one more entry for its end."""
        if not data:
            return "", np.zeros(0, np.int32)
        if not self.map.units and not self.squeeze:
            try:
                return self._plain(data.decode(), data)
            except UnicodeDecodeError:
                pass
        return self._mapped(data)

    def _plain(self, text: str, data: bytes) -> tuple[str, np.ndarray]:
        """Without a character map every character is itself, and only spaces change."""
        view = np.frombuffer(data, np.uint8)
        place = np.arange(len(data), dtype=np.int32)
        if not data.isascii():  # the bytes of a character come from where it begins
            place = np.maximum.accumulate(np.where(view & 0xC0 == 0x80, 0, place))
        source = np.repeat(place, np.where(view == 0x20, len(_MARK), 1))
        lead = np.zeros(len(_MARK) * self.dummy, np.int32)
        return SPACE_MARK * self.dummy + text.replace(" ", SPACE_MARK), np.concatenate([lead, source, [np.int32(len(data))]])

    def _prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        found = self.map.longest(data, at)
        if found is not None:
            return found
        width = _width(data, at)
        return (width, data[at : at + width]) if width else (1, REPLACEMENT.encode())

    def _mapped(self, data: bytes) -> tuple[str, np.ndarray]:
        """Longest prefix by longest prefix. Leading, repeated and trailing spaces go where the model says so."""
        at, out, source = 0, bytearray(), []
        while self.squeeze and at < len(data):
            width, becomes = self._prefix(data, at)
            if becomes != b" ":
                break
            at += width
        if at == len(data):
            return "", np.zeros(0, np.int32)
        if self.dummy:
            out += _MARK
            source += [at] * len(_MARK)
        spaced = self.squeeze
        while at < len(data):
            width, becomes = self._prefix(data, at)
            if spaced:
                becomes = becomes.lstrip(b" ")
            if becomes:
                spaced = self.squeeze and becomes.endswith(b" ")
                becomes = becomes.replace(b" ", _MARK)
                out += becomes
                source += [at] * len(becomes)
            elif not self.squeeze:
                spaced = False
            at += width
        end = len(data)
        while self.squeeze and out.endswith(_MARK):
            del out[-len(_MARK) :]
            end = source[len(out)]
            del source[len(out) :]
        return out.decode(), np.array([*source, end], np.int32)

    def ids(self, data: bytes) -> np.ndarray:
        """The ids alone."""
        return np.array(self.library.encode(self.normalise(data)[0]), np.int32)

    def encode(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in the data each begins and ends.

        Of the bytes of a character that is no piece, the last one has the character's span and the others are empty
        spans at its begin.
        """
        text, source = self.normalise(data)
        ids = np.array(self.library.encode(text), np.int32)
        if not len(ids):
            return ids, ids, ids
        ends = source[np.cumsum(self.width[ids], dtype=np.int64)]
        return ids, np.concatenate([source[:1], ends[:-1]]), ends


@lru_cache(2)
def pieces(model: str = MODEL) -> Pieces:
    return Pieces(Path(tokenizer_path(model)).read_bytes())


@lru_cache(2)
def _library(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(model))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *arrays])))


def _parts(batch: pa.RecordBatch, texts: pa.Array) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Rows of a batch together until their texts reach PART bytes: a text has more tokens than a batch should hold."""
    begin = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        size += n
        if size >= PART or i == len(texts) - 1:
            yield batch.slice(begin, i + 1 - begin), texts.slice(begin, i + 1 - begin)
            begin, size = i + 1, 0


def with_arrays(
    docs: DataFrame, text_col: str, fields: tuple[str, ...], load: Callable[[], Callable[[bytes], tuple[np.ndarray, ...]]]
) -> DataFrame:
    """The documents and arrays of numbers after their own columns, which ``load()``, called on the executors, makes of
    the whole text (null: empty). Names that a document already has get underscores before them."""
    at, names = docs.columns.index(text_col), apart(docs.columns, *fields)
    kinds = [T.StructField(name, T.ArrayType(T.IntegerType())) for name in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = load()
        for batch in batches:
            for part, texts in _parts(batch, batch.column(at).cast(pa.binary())):
                rows = [make(x.as_py() or b"") for x in texts]
                made = [_lists([row[i] for row in rows]) for i in range(len(fields))]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *names])

    return importable(docs).mapInArrow(run, T.StructType([*docs.schema.fields, *kinds]))


def with_pieces(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """The documents and three arrays after their own columns: ids, begins, ends.

    Piece i stands for the bytes from begins[i] to ends[i] of the whole text in UTF-8. Null and empty texts have no
    pieces. Names that a document already has get underscores before them; its own columns come back as they are. Repeated
    rows are encoded alike, no row moves, and an empty table gives an empty result. ``model`` is the name of a file of the
    public tokenizers, or a path; either is looked for on the executors.
    """
    return with_arrays(docs, text_col, ("ids", "begins", "ends"), lambda: pieces(model).encode)


def decoded(ids: Column | str, model: str = MODEL) -> Column:
    """The text that the library makes of ids; null or no ids give an empty text."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        library, out = _library(model), []
        for x in lists:
            numbers = [] if x.values is None else x.values.to_numpy().tolist()
            out.append(library.decode(numbers) if numbers else "")
        return pa.array(out, pa.string())

    return decode(ids if isinstance(ids, Column) else F.col(ids))


def ids_text(ids: Column | str) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join((F.col(ids) if isinstance(ids, str) else ids).cast("array<string>"), ",")


def pieces_report(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id column, n_tokens, ids_sha256, decoded_sha256, and the bytes that its spans cover
    (all of them, where the model drops no white space)."""
    made = with_pieces(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model)
    covered = F.when(F.size("ids") > 0, F.element_at("ends", -1) - F.element_at("begins", 1)).otherwise(0)
    return made.select(
        F.col("id").alias(id_col),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids_text("ids"), 256).alias("ids_sha256"),
        F.sha2(decoded("ids", model), 256).alias("decoded_sha256"),
        covered.cast("long").alias("covered_bytes"),
    )
