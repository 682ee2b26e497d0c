"""SentencePiece encoding that keeps the way back to the original bytes.

The text is normalised here, by the longest-prefix rule of the model's compiled
character map, and each normalised byte remembers the original byte it came from.
A processor whose own normaliser is switched off segments the result, so a piece
covers a known run of normalised bytes and with it a known span of the original.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"  # stands for a space inside pieces

# Fields of the model file (protocol buffer numbers and piece types).
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_UNKNOWN, _USER_DEFINED, _BYTE = 2, 4, 6


def _varint(blob: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = blob[at]
        at += 1
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            return value, at


def _fields(blob: bytes) -> Iterator[tuple[int, object, int, int]]:
    """(field number, value, first byte, end) of one protocol buffer message."""
    at = 0
    while at < len(blob):
        begin = at
        tag, at = _varint(blob, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(blob, at)
        elif kind == 2:
            size, at = _varint(blob, at)
            value, at = blob[at : at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = blob[at : at + size], at + size
        yield tag >> 3, value, begin, at


def _trie_entries(charsmap: bytes) -> dict[bytes, bytes]:
    """All (source, replacement) pairs of a compiled character map.

    The map is a double-array trie over UTF-8 bytes followed by zero-terminated
    replacements; a leaf holds the place of its replacement.
    """
    if len(charsmap) < 4:
        return {}
    (size,) = struct.unpack_from("<I", charsmap)
    units = np.frombuffer(charsmap, "<u4", size // 4, 4)
    targets = charsmap[4 + size :]

    def child_base(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    entries: dict[bytes, bytes] = {}
    labels = np.arange(1, 256, dtype=np.uint32)
    stack = [(child_base(int(units[0])), b"")]
    while stack:
        base, prefix = stack.pop()
        places = np.uint32(base) ^ labels
        inside = places < len(units)
        children = inside.copy()
        children[inside] = units[places[inside]] & np.uint32(0x800000FF) == labels[inside]
        for place, label in zip(places[children].tolist(), labels[children].tolist()):
            unit = int(units[place])
            key, below = prefix + bytes([label]), place ^ child_base(unit)
            if unit >> 8 & 1:
                start = int(units[below]) & 0x7FFFFFFF
                entries[key] = targets[start : targets.index(b"\0", start)]
            stack.append((below, key))
    return entries


class Normalizer:
    """Longest-prefix normalisation with the source offset of every byte."""

    def __init__(self, spec: bytes, symbols: tuple[bytes, ...] = ()) -> None:
        found = {number: value for number, value, _, _ in _fields(spec)}
        self.dummy_prefix = bool(found.get(3, 1))
        self.squeeze = bool(found.get(4, 1))
        self.space = (SPACE if found.get(5, 1) else " ").encode()
        # A symbol of the user's is kept as it is and beats the map.
        entries = _trie_entries(found.get(2, b""))
        self.symbols = {s: s for s in symbols if s}
        self.tables = [t for t in (self.symbols, entries) if t]
        self.longest = [max(map(len, t)) for t in self.tables]
        heads = {key[:1] for table in self.tables for key in table}
        self.heads = re.compile(b"[" + b"".join(map(re.escape, sorted(heads))) + b"]") if heads else None

    def _replacement(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        for table, longest in zip(self.tables, self.longest):
            for size in range(min(longest, len(text) - at), 0, -1):
                target = table.get(text[at : at + size])
                if target is not None:
                    return size, target
        return None

    def _mapped(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The text after the map, and for each byte where its source begins."""
        if self.heads is None:
            return text, np.arange(len(text) + 1)
        out: list[bytes] = []
        source: list[np.ndarray] = []
        at = 0
        while at < len(text):
            hit = self.heads.search(text, at)
            upto = hit.start() if hit else len(text)
            out.append(text[at:upto])
            source.append(np.arange(at, upto))
            if upto == len(text):
                break
            at = upto
            size, target = self._replacement(text, at) or (_char_size(text[at]), None)
            out.append(text[at : at + size] if target is None else target)
            source.append(np.arange(at, at + size) if target is None else np.full(len(target), at))
            at += size
        return b"".join(out), np.concatenate([*source, [len(text)]])

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes; source offset of each, and the text's end at last."""
        mapped, source = self._mapped(text.encode())
        if self.squeeze:
            data = np.frombuffer(mapped, np.uint8)
            blank = data == 32
            keep = ~blank
            keep[1:] |= ~blank[:-1]  # the first blank of a run
            keep[:1] &= ~blank[:1]
            mapped, source = data[keep].tobytes(), np.append(source[:-1][keep], source[-1])
        if not mapped and (self.squeeze or not text):
            return b"", source[-1:]
        widths = np.where(np.frombuffer(mapped, np.uint8) == 32, len(self.space), 1)
        source = np.append(np.repeat(source[:-1], widths), source[-1])
        out = mapped.replace(b" ", self.space)
        if self.dummy_prefix:
            source = np.concatenate([np.full(len(self.space), source[0]), source])
            out = self.space + out
        if self.squeeze:  # no space, written either way, at the end
            solid = len(out)
            while out.endswith(self.space, 0, solid):
                solid -= len(self.space)
            out, source = out[:solid], np.append(source[:solid], source[-1])
        return out, source


def _char_size(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class PieceCodec:
    """Encoder with spans and decoder for one model (the file's bytes)."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        sizes, kinds, symbols, spec, plain = [], [], [], b"", []
        for number, value, begin, end in _fields(model):
            if number == _PIECE:
                piece = {n: v for n, v, _, _ in _fields(value)}
                kind = piece.get(3, 1)
                sizes.append(1 if kind == _BYTE else len(piece.get(1, b"")))
                kinds.append(kind)
                if kind == _USER_DEFINED:
                    symbols.append(piece[1])
            if number == _NORMALIZER:
                spec = value
            else:
                plain.append(model[begin:end])
        # The same model with a normaliser that does nothing: identity, no dummy
        # prefix, white space neither removed nor escaped.
        idle = b"\x0a\x08identity" + bytes([3 << 3, 0, 4 << 3, 0, 5 << 3, 0])
        plain.append(bytes([_NORMALIZER << 3 | 2, len(idle)]) + idle)
        self.normalize = Normalizer(spec, tuple(symbols))
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=b"".join(plain))
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.sizes = np.array(sizes)
        self.unknown = np.array(kinds) == _UNKNOWN

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and where each piece's span ends in the text's bytes.

        Spans follow each other: a piece begins where the one before it ends.
        """
        normal, source = self.normalize(text)
        plain = normal.decode()
        ids = np.array(self.segmenter.encode(plain), np.int32)
        sizes = self.sizes[ids]
        if ids.size and self.unknown[ids].any():  # their length is that of their surface
            sizes = np.array([len(p.encode()) for p in self.segmenter.encode(plain, out_type=str)])
        return ids, source[np.cumsum(sizes)].astype(np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return self.decoder.decode(ids.tolist())


ENCODED = "ids array<int>, ends array<int>, decoded string"


def encode_documents(docs: DataFrame, model_path: str, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, ids, span ends (bytes of the text) and the decoded text.

    A null text counts as empty: no ids, no spans, decoded to ''. Rows are
    independent, so repeated rows give repeated results and an empty table an
    empty one; columns not named in ``keep`` play no part. The model file is read
    once on the driver and travels with the job; it is not a table, its size is
    fixed (half a megabyte here).
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf(ENCODED)
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = PieceCodec(model.value)
        for texts in batches:
            rows = [codec.encode(t or "") for t in texts]
            yield pd.DataFrame(
                {
                    "ids": [ids for ids, _ in rows],
                    "ends": [ends for _, ends in rows],
                    "decoded": [codec.decode(ids) for ids, _ in rows],
                }
            )

    return docs.select(*keep, encoded(F.col(text)).alias("_encoded")).select(*keep, "_encoded.*")
