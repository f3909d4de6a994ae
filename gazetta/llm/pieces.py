"""Offset-preserving SentencePiece encoding and decoding (operator 7).

The normaliser walks the text by longest prefixes through the model's compiled character map (a double-array trie with a pool of
replacements) and records for every normalised byte which original bytes it came from. The pieces cover the normalised text without gaps,
so the running sum of their lengths, looked up in that alignment, projects every piece to original byte spans. The ids and the decoded
text are the library's, out of its own normalisation of the raw text; this normaliser serves the spans alone.

Nulls: a NULL text is empty (begin and end id alone). Repeated rows, ties and extra columns need nothing; an empty table gives an empty result;
very long texts are one row each.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gazetta.llm.common import resident, slices, texts

SPACE = "▁"


# --- the model file (protocol buffer fields as published with the format) ---------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field number and value of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        elif tag & 7 == 2:
            size = number()
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            width = {1: 8, 5: 4}[tag & 7]
            yield tag >> 3, data[at : at + width]
            at += width


def _message(fields: list[tuple[int, bytes | int]]) -> bytes:
    """A protocol buffer message of bytes and whole numbers."""

    def number(value: int) -> bytes:
        out = bytearray()
        while value > 127:
            out.append(value & 127 | 128)
            value >>= 7
        return bytes(out) + bytes([value])

    parts = []
    for field, value in fields:
        parts += [number(field << 3), number(value)] if isinstance(value, int) else [number(field << 3 | 2), number(len(value)), value]
    return b"".join(parts)


def without_normalizer(model: bytes) -> bytes:
    """The model for texts that are normalised already: the same pieces, no character map, no white-space rules, no samples of its own."""
    plain = _message([(1, b"identity"), (2, b""), (3, 0), (4, 0), (5, 0)])
    return _message([(field, value) for field, value in _fields(model) if field not in (3, 4)] + [(3, plain)])


def normalizer_spec(model: bytes) -> dict[str, object]:
    """Character map and white-space settings of a model file."""
    spec: dict[str, object] = {"charsmap": b"", "dummy_prefix": True, "remove_extra": True, "escape": True, "suffix": False}
    for field, value in _fields(model):
        if field == 3:
            for number, inner in _fields(value):
                name = {2: "charsmap", 3: "dummy_prefix", 4: "remove_extra", 5: "escape"}.get(number)
                if name:
                    spec[name] = inner if name == "charsmap" else bool(inner)
        if field == 2:
            spec["suffix"] = any(number == 24 and inner for number, inner in _fields(value))
    return spec


# --- normalisation -----------------------------------------------------------------------------------------------------


class CharacterMap:
    """Longest-prefix replacements out of a compiled character map."""

    def __init__(self, compiled: bytes):
        self.units = np.zeros(0, np.uint32)
        self.pool = b""
        if compiled:
            (size,) = struct.unpack_from("<I", compiled)
            self.units = np.frombuffer(compiled, "<u4", size // 4, 4)
            self.pool = compiled[4 + size :]
        self._trie = self.units.tolist()
        self.firsts = {b for b in range(256) if self._step(0, b) is not None} if self._trie else set()
        self._start = re.compile(b"[" + b"".join(re.escape(bytes([b])) for b in sorted(self.firsts)) + b"]") if self.firsts else None

    def _step(self, node: int, byte: int) -> int | None:
        """Child of a node of the double array: its label is the byte."""
        unit = self._trie[node]
        child = node ^ ((unit >> 10) << ((unit & 0x200) >> 6)) ^ byte
        return child if child < len(self._trie) and self._trie[child] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix at a place, and what stands for it."""
        node, found = 0, None
        for k in range(at, len(data)):
            child = self._step(node, data[k])
            if child is None:
                break
            node = child
            unit = self._trie[node]
            if unit >> 8 & 1:
                leaf = self._trie[node ^ ((unit >> 10) << ((unit & 0x200) >> 6))] & 0x7FFFFFFF
                found = (k + 1 - at, leaf)
        if found is None:
            return None
        return found[0], self.pool[found[1] : self.pool.index(b"\0", found[1])]

    def apply(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Replaced bytes, and for each the original place (one more entry for the end)."""
        if self._start is None:
            return data, np.arange(len(data) + 1)
        out, places, at = [], [], 0
        search = self._start.search
        while (hit := search(data, at)) is not None:
            start = hit.start()
            # prefixes start where a character does
            if data[start] & 0xC0 == 0x80:
                known = None
            else:
                known = self.longest(data, start)
            end = start + (known[0] if known else 1)
            if known is None:
                while end < len(data) and data[end] & 0xC0 == 0x80:
                    end += 1
            out += [data[at:start], known[1] if known else data[start:end]]
            places += [np.arange(at, start), np.full(len(known[1]), start) if known else np.arange(start, end)]
            at = end
        out.append(data[at:])
        places.append(np.arange(at, len(data) + 1))
        return b"".join(out), np.concatenate(places)


class Normalizer:
    """Normalised bytes of a text with their alignment to its own bytes."""

    def __init__(self, model: bytes):
        spec = normalizer_spec(model)
        self.map = CharacterMap(spec["charsmap"])
        self.dummy_prefix, self.remove_extra, self.escape, self.suffix = (bool(spec[k]) for k in ("dummy_prefix", "remove_extra", "escape", "suffix"))

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised text, and the original byte place of each of its bytes and of its end."""
        data, places = self.map.apply(text.encode())
        if self.remove_extra:
            data, places = _squeezed(data, places, self.escape)
        if not data:
            return b"", places
        if self.dummy_prefix:
            at = len(data) if self.suffix else 0
            data = data[:at] + b" " + data[at:]
            places = np.concatenate([places[:at], places[at : at + 1], places[at:]])
        if self.escape:
            width = np.where(np.frombuffer(data, np.uint8) == 0x20, 3, 1)
            places = np.append(np.repeat(places[:-1], width), places[-1])
            data = data.replace(b" ", SPACE.encode())
        return data, places


#: The blanks at a text's end, without and with the written sign; they are read from the end, in one step.
_TRAILING = (re.compile(rb"\x20*+"), re.compile(rb"(?:\x20|" + SPACE.encode()[::-1] + rb")*+"))


def _squeezed(data: bytes, places: np.ndarray, escape: bool) -> tuple[bytes, np.ndarray]:
    """Without blanks at both ends and after another blank; at the end a written sign for a blank goes, too."""
    end = len(data) - _TRAILING[escape].match(data[::-1]).end()
    data, places = data[:end], places[: end + 1]
    blank = np.frombuffer(data, np.uint8) == 0x20
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[:1] = ~blank[:1]
    last = np.flatnonzero(~blank)
    end = int(last[-1]) + 1 if len(last) else 0
    keep[end:] = False
    return np.frombuffer(data, np.uint8)[keep].tobytes(), np.append(places[:-1][keep], places[end])


# --- encoding ---------------------------------------------------------------------------------------------------------


class PieceEncoder:
    """Ids, original byte spans and decoded texts."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            model = file.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=without_normalizer(model))
        self.normalizer = Normalizer(model)
        n = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(n)]
        self.lengths = np.array([1 if self.library.is_byte(i) else len(p.encode()) for i, p in enumerate(names)], np.int64)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[tuple[np.ndarray, np.ndarray]]]:
        """Ids of each text with begin and end id, and the first and end byte in the text of each piece."""
        normalized = [self.normalizer(t) for t in texts]
        ids = self.merger.encode([data for data, _ in normalized], num_threads=1, add_bos=True, add_eos=True)
        return ids, [self._spans(t, *n, own) for t, n, own in zip(texts, normalized, ids, strict=True)]

    def _spans(self, text: str, data: bytes, places: np.ndarray, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First and end byte in the text of each piece; begin and end id are empty spans at the text's ends.

        A byte of a replacement of several bytes stands for the whole original; where pieces meet inside one, the later piece's span is empty.
        """
        edges = np.concatenate([[0], np.cumsum(self.lengths[np.array(ids[1:-1], np.int64)])])
        if edges[-1] != len(data):
            edges = self._edges_with_unknown(data)
        at = places[edges] if len(data) else np.zeros(len(edges), np.int64)
        last = len(text.encode())
        return np.concatenate([[0], at[:-1], [last]]), np.concatenate([[0], at[1:], [last]])

    def _edges_with_unknown(self, data: bytes) -> np.ndarray:
        """Edges where the model knows no bytes: an unknown piece covers its own text."""
        sizes = [len(p.encode()) for p in self.merger.encode(data.decode(), out_type=str)]
        edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        if edges[-1] != len(data):
            raise ValueError("the pieces do not cover the normalised text")
        return edges


def piece_encoder(path: str) -> PieceEncoder:
    """One per worker and file."""
    return resident(("pieces", path), lambda: PieceEncoder(path))


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, begins, ends): every piece with its original byte span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_encoder(model)
        for batch in slices(batches, 128, 2 << 20):
            own = texts(batch.column("text"))
            ids, spans = pieces.encode(own)
            edges = pa.array(np.concatenate([[0], np.cumsum([len(i) for i in ids])]), pa.int32())
            flat = [np.concatenate(x) if x else np.zeros(0) for x in (ids, [s[0] for s in spans], [s[1] for s in spans])]
            lists = [pa.ListArray.from_arrays(edges, pa.array(x.astype(np.int32))) for x in flat]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], names=["doc_id", "ids", "begins", "ends"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, begins array<int>, ends array<int>")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text): texts from ids by the library."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = piece_encoder(model).library
        for batch in slices(batches, 128):
            found = [library.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long"


def piece_digests(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32): ids, spans and decoded text in one pass, as digests.

    ``spans_crc32`` is the checksum of all begins and ends as little-endian 32-bit integers.
    """
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_encoder(model)
        for batch in slices(batches, 128, 2 << 20):
            own = texts(batch.column("text"))
            ids, places = pieces.encode(own)
            decoded = [pieces.library.decode(x) for x in ids]
            spans = [zlib.crc32(np.concatenate(x).astype("<u4").tobytes()) for x in places]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
                    pa.array(spans, pa.int64()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, _DIGESTS)
