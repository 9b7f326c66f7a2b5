"""SentencePiece encoding and decoding with source offsets.

The text is normalised by longest-prefix matches in the model's compiled character
map; every normalised character remembers the byte of the text it came from, so each
piece is projected to a byte span of the original.  Segmentation is byte-pair merging
by piece score.  It runs on chunks no piece of the vocabulary can cross, which lets a
task reuse the pieces of a chunk it has met before.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from scanlens.llm.common import map_batches, texts

SPACE = "▁"
#: Chunks of one generation of a task's memory.
CHUNK_CACHE = 250_000
_PACK = struct.Struct("=II").pack


class CharacterMap:
    """Longest-prefix lookups in a compiled character map (a double-array trie and its replacements)."""

    def __init__(self, blob: bytes):
        self.units: tuple[int, ...] = ()
        self.strings = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.strings = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, raw: bytes, start: int) -> tuple[bytes, int] | None:
        """Replacement and length in bytes of the longest entry at ``start``."""
        units, found = self.units, None
        at = self._offset(units[0])
        for k in range(start, len(raw)):
            at ^= raw[k]
            if at >= len(units) or units[at] & 0x800000FF != raw[k]:
                break
            leaf = units[at] & 256
            at ^= self._offset(units[at])
            if leaf:
                found = units[at] & 0x7FFFFFFF, k + 1 - start
        if found is None:
            return None
        return self.strings[found[0] : self.strings.index(b"\0", found[0])], found[1]


class _Chunks(dict):
    """Remembered chunks in two generations; those in use outlive a change of generation."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, chunk: str):
        known = self.old.get(chunk) or self.make(chunk)
        if len(chunk) <= 64:
            if len(self) >= CHUNK_CACHE:
                self.old = dict(self)
                self.clear()
            self[chunk] = known
        return known


class Encoder:
    """One model: normaliser, merges and decoder.  ``blob`` is the serialised model."""

    def __init__(self, blob: bytes):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(blob)
        spec, kinds = model.normalizer_spec, model.SentencePiece
        if model.trainer_spec.model_type != 2 or model.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces:
            raise ValueError("byte-pair models with escaped, leading white space only")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.charmap = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.trim = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.vocab = {p.piece: (p.score, i) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.surface = {i: p.piece.replace(SPACE, " ").encode() for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.surface |= {i: bytes([b]) for b, i in self.bytes.items()}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.surface[self.unknown] = model.trainer_spec.unk_surface.encode()
        self.end = next(i for i, p in enumerate(model.pieces) if p.piece == model.trainer_spec.eos_piece)
        self.surface |= {i: b"" for i, p in enumerate(model.pieces) if i not in self.surface}
        self.score, self.none = {p: s for p, (s, _) in self.vocab.items()}.get, float("-inf")
        self.digits = [str(i) for i in range(len(model.pieces))]
        self.packed = {p: _PACK(i, len(p)) for p, (_, i) in self.vocab.items()}
        self.chunks = self._chunker()
        self.known = _Chunks(self._segment)

    def _chunker(self) -> re.Pattern[str]:
        """Cuts where no piece can reach across: around characters that no longer piece holds, and before blanks."""
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.vocab):
            return re.compile("(?s).+")
        joined = {c for p in self.vocab if len(p) > 1 for c in p}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined)
        solo = f"[{alone}]|" if alone else ""
        return re.compile(f"(?s){solo}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+")

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and the source byte of each of its characters and of its end."""
        if self.charmap.units or self.trim:
            return self._mapped(text)
        # a map without entries has no match anywhere: every character stands for itself
        raw = np.frombuffer(text.encode(), np.uint8)
        at = np.flatnonzero((raw & 0xC0) != 0x80)
        added = self.prefix and bool(text)
        return SPACE * added + text.replace(" ", SPACE), np.concatenate([[0] * added, at, [len(raw)]]).astype(np.int64)

    def _mapped(self, text: str) -> tuple[str, np.ndarray]:
        """Longest-prefix matches one after another."""
        out: list[str] = []
        at: list[int] = []
        raw, start = text.encode(), 0
        plain = not self.charmap.units
        spaced, begun = self.trim, False
        while start < len(raw):
            hit = None if plain else self.charmap.longest(raw, start)
            if hit is None:
                lead = raw[start]
                n = 1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4
                piece = raw[start : start + n].decode()
            else:
                piece, n = hit[0].decode(), hit[1]
            if not begun and not (self.trim and piece == " "):
                begun = True
                if self.prefix:
                    out.append(SPACE)
                    at.append(start)
            if spaced:
                piece = piece.lstrip(" ")
            for c in piece:
                out.append(SPACE if c == " " else c)
                at.append(start)
            if piece or not spaced:
                spaced = self.trim and piece.endswith(" ")
            start += n
        end = len(raw)
        while self.trim and out and out[-1] == SPACE:
            out.pop()
            end = at.pop()
        return "".join(out), np.array([*at, end], np.int64)

    def _merge(self, chunk: str) -> list[str]:
        """Byte-pair merges: always the pair with the best score, the leftmost of equals."""
        if len(chunk) > 64:
            return self._merge_long(chunk)
        score, none = self.score, self.none
        parts = list(chunk)
        scores = [score(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) > none:
            i = scores.index(best)
            parts[i] = pair = parts[i] + parts.pop(i + 1)
            del scores[i]
            if i:
                scores[i - 1] = score(parts[i - 1] + pair, none)
            if i < len(scores):
                scores[i] = score(pair + parts[i + 1], none)
        return parts

    def _merge_long(self, chunk: str) -> list[str]:
        """The same merges with a queue, for chunks without any blank over a long stretch."""
        parts: list[str | None] = list(chunk)
        n, score = len(parts), self.score
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and (s := score(pair := parts[i] + parts[j])) is not None:
                heapq.heappush(queue, (-s, i, j, pair))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, pair = heapq.heappop(queue)
            if parts[i] is None or right[i] != j or len(parts[i]) + len(parts[j]) != len(pair):
                continue
            parts[i], parts[j] = pair, None
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p is not None]

    def _segment(self, chunk: str) -> bytes:
        """Ids, each followed by the characters it ends (0 for all but the last byte of one), as 32-bit numbers."""
        return b"".join([self.packed.get(piece) or self._unlisted(piece) for piece in self._merge(chunk)])

    def _unlisted(self, piece: str) -> bytes:
        """The same for a character that is no piece."""
        if not self.bytes:
            return _PACK(self.unknown, len(piece))
        raw = piece.encode()
        return b"".join(_PACK(self.bytes[b], k == len(raw)) for k, b in enumerate(raw, 1))

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Ids with the end id, and the byte span of the original text behind each."""
        plain, at = self.normalise(text)
        found = np.frombuffer(b"".join(map(self.known.__getitem__, self.chunks.findall(plain))), np.uint32)
        ids = found[::2].tolist()
        ids.append(self.end)
        edge = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(found[1::2], out=edge[1:-1])
        edge = at[edge]
        edge[-2:] = at[-1]
        return ids, edge[:-1], edge[1:]

    def digest(self, text: str) -> tuple[int, int, str, str]:
        """Number of ids with the end id, bytes under their spans, SHA-256 of the id text and of the decoded text."""
        ids, begin, end = self.encode(text)
        coded = " ".join(map(self.digits.__getitem__, ids)).encode()
        return len(ids), int((end - begin).sum()), hashlib.sha256(coded).hexdigest(), hashlib.sha256(self.decode(ids).encode()).hexdigest()

    def decode(self, ids: list[int]) -> str:
        """Text of a row of ids; control ids are silent, added leading blanks go."""
        if not self.trim:  # one blank only, that of the first piece with text
            try:
                text = b"".join(map(self.surface.__getitem__, ids))
            except KeyError:  # an id beyond the vocabulary is silent
                text = b"".join(self.surface.get(i, b"") for i in ids)
            return text[self.prefix and text[:1] == b" " :].decode("utf-8", "replace")
        parts = [self.surface.get(i, b"") for i in ids]
        for k, part in enumerate(parts):
            if part[:1] == b" ":
                parts[k] = part[1:]
            if parts[k]:
                break
        return b"".join(parts).decode("utf-8", "replace")


def _encoder(spark: SparkSession, model: str):
    blob = spark.sparkContext.broadcast(open(model, "rb").read())  # half a MB, read where the model is installed
    return lambda: Encoder(blob.value)


def encode_documents(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Add ``ids``, ``begin``, ``end`` (byte span of each piece in the original) to every row.

    Columns of these names are replaced, others kept.  A null or empty text has the
    end id alone with an empty span.  Byte pieces of one character span nothing but
    for the last.  Rows are independent, so repeated rows and ties need no rule.
    """
    names = [c for c in docs.columns if c not in ("ids", "begin", "end")]
    docs = docs.select(*names)
    make = _encoder(docs.sparkSession, model)

    def start():
        encoder = make()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [encoder.encode(t) for t in texts(batch, text)]
            kind = pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([r[k] for r in rows], kind) for k in range(3))], names=[*names, "ids", "begin", "end"])

        return step

    fields = ", ".join(f"`{c}` {k}" for c, k in docs.dtypes)
    return map_batches(docs, f"{fields}, ids array<int>, begin array<int>, end array<int>", start)


def decode_documents(encoded: DataFrame, model: str, out: str = "decoded") -> DataFrame:
    """Add the text of ``ids`` as column ``out`` (replaced if present); null ids give the empty text."""
    names = [c for c in encoded.columns if c != out]
    encoded = encoded.select(*names)
    make = _encoder(encoded.sparkSession, model)

    def start():
        encoder = make()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [encoder.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.string())], names=[*names, out])

        return step

    fields = ", ".join(f"`{c}` {k}" for c, k in encoded.dtypes)
    return map_batches(encoded, f"{fields}, `{out}` string", start)


def encoding_digests(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text inside its task; only sizes and digests leave it.

    Every text is normalised with its alignment, its pieces are projected to byte spans,
    and its ids are decoded.  One row per input row: key, n_tokens, ids_sha256,
    decoded_sha256, and span_bytes, the bytes of the text under the spans.  A null text is
    the empty text: the end id alone, decoded to nothing.
    """
    docs = docs.select(key, text)
    make = _encoder(docs.sparkSession, model)

    def start():
        encoder = make()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [encoder.digest(t) for t in texts(batch, text)]
            n, size, ids, back = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([batch.column(key), pa.array(n, pa.int64()), pa.array(ids), pa.array(back), pa.array(size, pa.int64())], names=[key, "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes"])

        return step

    return map_batches(docs, f"`{key}` {docs.dtypes[0][1]}, n_tokens long, ids_sha256 string, decoded_sha256 string, span_bytes long", start)

