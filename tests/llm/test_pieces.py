"""Encoding against the sentencepiece library itself."""

from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from scanlens.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def _texts() -> list[str]:
    draw = random.Random(3)
    alphabet = "abcth  \n\t.,\u2581é漢字ñ🙂\x00<s>0x1A\u200b\ufeff"
    own = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40))) for _ in range(1500)]
    return [*own, "", " ", "  a  ", "\u2581", "a" * 500, " " * 100, "the" * 400, "<s></s><0x0A><unk>"]


def test_ids_spans_and_text_equal_the_library(library):
    encoder = pieces.Encoder(open(MODEL, "rb").read())
    for t in _texts():
        ids, begin, end = encoder.encode(t)
        assert ids == library.encode(t, add_eos=True)
        assert encoder.decode(ids) == library.decode(ids)
        for k, p in enumerate(library.encode(t, return_type="proto").pieces):
            assert (p.begin, p.end) == (begin[k], end[k])
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
        assert encoder.digest(t) == (len(ids), int(sum(end) - sum(begin)), *sha) and int(sum(end) - sum(begin)) == len(t.encode())


def test_long_chunks_merge_like_short_ones():
    encoder = pieces.Encoder(open(MODEL, "rb").read())
    for t in _texts():
        assert encoder._merge_long(t[:60]) == encoder._merge(t[:60])


def _double_array(entries: dict[bytes, int]) -> bytes:
    """A small double array for tests: one unit block per trie node, placed in free slots."""
    trie: dict = {}
    for key, value in entries.items():
        at = trie
        for b in key:
            at = at.setdefault(b, {})
        at["end"] = value
    units, used = [0] * 8192, {0}

    def place(at: dict, pos: int) -> None:
        labels = [b for b in at if b != "end"] + ([0] if "end" in at else [])
        base = next(o for o in range(256, 8000, 256) if all((pos ^ o) ^ b not in used and (pos ^ o) ^ b < 8192 for b in labels))
        start = pos ^ base
        used.update(start ^ b for b in labels)
        units[pos] = (units[pos] & 0x800003FF) | base << 10 | (256 if "end" in at else 0)
        if "end" in at:
            units[start] = 0x80000000 | at["end"]
        for b in [x for x in at if x != "end"]:
            units[start ^ b] |= b
            place(at[b], start ^ b)

    place(trie, 0)
    return struct.pack("<8192I", *units)


def test_longest_prefix_normalisation_equals_the_library():
    strings, entries = b"", {}
    for key, value in {"A": "a", "AB": "xy", "ABC": "q", "é": "e", "ﬁ": "fi", "\t": " ", "\u3000": " ", "Z": ""}.items():
        entries[key.encode()] = len(strings)
        strings += value.encode() + b"\0"
    array = _double_array(entries)
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(MODEL, "rb").read())
    model.normalizer_spec.name = "own"
    model.normalizer_spec.precompiled_charsmap = struct.pack("<I", len(array)) + array + strings
    draw = random.Random(5)
    for trim in (False, True):
        model.normalizer_spec.remove_extra_whitespaces = trim
        blob = model.SerializeToString()
        library, encoder = sentencepiece.SentencePieceProcessor(model_proto=blob), pieces.Encoder(blob)
        for _ in range(400):
            t = "".join(draw.choice("ABCéﬁ\t\u3000 abZ\u2581") for _ in range(draw.randint(0, 14)))
            ids, begin, end = encoder.encode(t)
            assert ids == library.encode(t, add_eos=True), (t, trim)
            assert encoder.decode(ids) == library.decode(ids)
            assert encoder.digest(t)[0] == len(ids)
            raw = t.encode()
            assert all(0 <= b <= e <= len(raw) for b, e in zip(begin, end, strict=True)) and list(begin) == sorted(begin)


def test_operator_on_odd_rows(spark, odd, none, clashing, library):
    rows = pieces.encoding_digests(clashing, MODEL).collect()
    assert len(rows) == odd.count()
    for r, t in zip(rows, [x.text or "" for x in odd.collect()], strict=True):
        assert r.n_tokens == len(library.encode(t, add_eos=True))
    full = pieces.decode_documents(pieces.encode_documents(clashing, MODEL), MODEL).collect()
    assert [r.decoded for r in full] == [library.decode(r.ids) for r in full]
    assert {len(r.ids) == len(r.begin) == len(r.end) for r in full} == {True}
    assert pieces.encoding_digests(none, MODEL).count() == 0


def test_remembered_chunks_are_flat():
    """A chunk is remembered as one row of bytes, which the collector does not visit, with a number and a width for each id."""
    encoder = pieces.Encoder(open(MODEL, "rb").read())
    for text in ("", "plain words", "𝔘 \x07 naïve"):
        ids, begin, end = encoder.encode(text)
        assert len(ids) == len(begin) == len(end) and int((end - begin).sum()) == len(text.encode())
    assert encoder.known and all(isinstance(v, bytes) and not len(v) % 8 for v in encoder.known.values())
