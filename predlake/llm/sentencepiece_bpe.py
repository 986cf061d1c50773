"""Exact SentencePiece encoding of merge-type (BPE) models by backtracking, and decoding.

The merges of a BPE model take, again and again, the adjacent pair whose
concatenation has the best score, leftmost first. No merge crosses the border of
two final pieces, so a split of a text into pieces is the encoding exactly if
merging any two neighbours anew gives these two. The encoder walks a text with
the longest match at each position (Aho-Corasick), takes the next shorter one
where a neighbour is incompatible, and steps back where none is left. What leads
to a position is unique, so a position that failed once is marked in a bitfield
and never entered again.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_process

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format
KEPT_CHUNKS = 400_000  # encodings of short chunks that a task keeps at most
KEPT_PAIRS = 400_000
SHORT = 48
LATIN, SIGN = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]", r"[!-@\[-`{-~]"


def read_model(path: str) -> dict:
    """The parts of a model file that encoding needs, as plain data for a broadcast."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, trained = model.normalizer_spec, model.trainer_spec
    if trained.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not (
            norm.add_dummy_prefix and norm.escape_whitespaces and trained.byte_fallback):
        raise ValueError("only byte-fallback BPE models with identity normalisation and a dummy prefix are supported")
    if any(p.type in (USER, UNUSED) for p in model.pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    return {"pieces": [p.piece for p in model.pieces], "scores": [p.score for p in model.pieces], "types": [p.type for p in model.pieces],
            "bos": trained.bos_id, "eos": trained.eos_id}


def hash_of(model: dict) -> str:
    return hashlib.sha256(repr(model).encode("utf-8")).hexdigest()


class Encoder:
    def __init__(self, model: dict) -> None:
        self.pieces, self.types = model["pieces"], model["types"]
        self.bos, self.eos = model["bos"], model["eos"]
        self.ids = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == NORMAL}
        self.score = {p: model["scores"][i] for p, i in self.ids.items()}
        self.bytes = {int(p[1:-1], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}
        self.matches = ahocorasick.Automaton()
        for p in self.ids:
            self.matches.add_word(p, len(p))
        self.matches.make_automaton()
        self.id_bytes = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.text_bytes = {p: p.replace(SPACE, " ").encode("utf-8") for p in self.ids}
        joined = [p for p in self.ids if len(p) > 1]
        self.chunks = self._cutter([p for p in self.ids if len(p) > 1])
        self._pairs: dict[tuple[str, str], bool] = {}
        self._short: dict[str, tuple[bytes, bytes]] = {}

    def _cutter(self, joined: list[str]) -> re.Pattern:
        """Where no piece reaches across, a text may be cut: before spaces, around line ends, between Latin letters and ASCII signs."""
        if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in joined):
            return re.compile("(?s:.+)")
        chunks = f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"
        if not any(re.search(f"{LATIN}{SIGN}|{SIGN}{LATIN}", p) for p in joined):
            ahead = rf"{SPACE}\n]|\Z)"
            chunks = f"{SPACE}*{LATIN}+(?={SIGN[:-1]}{ahead}|{SPACE}*{SIGN}+(?={LATIN[:-1]}{ahead}|{chunks}"
        return re.compile(chunks)

    def merge(self, text: str) -> list[str]:
        """Plain merging, for two pieces at most."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Does merging a + b anew give just a and b? ("", b): does b merge to itself?"""
        known = self._pairs.get((a, b))
        if known is None:
            known = self.merge(a + b) == ([a, b] if a else [b])
            if len(self._pairs) >= KEPT_PAIRS:
                self._pairs.clear()
            self._pairs[a, b] = known
        return known

    def split(self, text: str) -> list[str]:
        """The pieces of a chunk; a character that no piece covers stands alone."""
        n = len(text)
        lengths: list[list[int]] = [[1] for _ in range(n)]
        for last, length in self.matches.iter(text):
            if length > 1:
                lengths[last - length + 1].append(length)  # ascending, as ends ascend
        pairs, compatible = self._pairs, self.compatible
        failed = bytearray(n // 8 + 1)
        path: list[str] = []
        left: list[list[int]] = []  # what is still to try where each piece of the path begins
        pos, before, options = 0, "", lengths[0]
        while pos < n:
            while options:
                end = pos + options.pop()
                if failed[end >> 3] >> (end & 7) & 1:
                    continue
                piece = text[pos:end]
                fits = pairs.get((before, piece))
                if fits if fits is not None else compatible(before, piece):
                    break
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                pos -= len(path.pop())
                options, before = left.pop(), path[-1] if path else ""
                continue
            path.append(piece)
            left.append(options)
            before, pos = piece, end
            if end < n:
                options = lengths[end]
        return path

    def _chunk(self, text: str) -> tuple[bytes, bytes]:
        """Ids as little-endian 32-bit integers, and what they decode to."""
        ids, decoded = [], []
        for p in self.split(text):
            known = self.id_bytes.get(p)
            if known is not None:
                ids.append(known)
                decoded.append(self.text_bytes[p])
            else:
                spelled = [self.bytes[b] for b in p.encode("utf-8")]
                ids.append(np.array(spelled, "<u4").tobytes())
                decoded.append(self.decode_pieces(spelled).encode("utf-8"))  # whole characters: a run never has half of one
        return b"".join(ids), b"".join(decoded)

    def decode_pieces(self, ids: list[int]) -> str:
        """Text of ids without control pieces and before the dummy prefix goes; runs of byte pieces are UTF-8."""
        out, run = [], bytearray()
        for i in ids:
            if self.types[i] == BYTE:
                run.append(int(self.pieces[i][1:-1], 16))
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if self.types[i] != CONTROL:
                out.append(self.pieces[i].replace(SPACE, " "))
        out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """(ids with begin and end as little-endian 32-bit integers, decoded text in UTF-8) of a whole text."""
        ids, decoded = [np.uint32(self.bos).tobytes()], []
        if text:
            kept = self._short
            for chunk in self.chunks.findall(SPACE + text.replace(" ", SPACE)):
                both = kept.get(chunk)
                if both is None:
                    both = self._chunk(chunk)
                    if len(chunk) <= SHORT:
                        if len(kept) >= KEPT_CHUNKS:
                            kept.clear()
                        kept[chunk] = both
                ids.append(both[0])
                decoded.append(both[1])
        ids.append(np.uint32(self.eos).tobytes())
        return b"".join(ids), b"".join(decoded)[1:]  # without the dummy prefix


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ``ids`` (array of ints with begin and end ids) and ``decoded``.

    Null and empty texts give just the two ids and an empty text. Repeated rows and
    null ids stay; other columns are not read. A task keeps the encodings of up to
    KEPT_CHUNKS short chunks; long ones are encoded each time. An empty table gives no rows.
    """
    return _map(docs, model_path, id_col, text_col, "ids array<int>, decoded string",
                lambda ids, text: (np.frombuffer(ids, "<u4").astype(np.int32), text.decode("utf-8")))


def digest_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_texts``, with n_tokens, ids_sha256 and decoded_sha256 in place of the ids and the text."""
    return _map(docs, model_path, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                lambda ids, text: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()))


def _map(docs: DataFrame, model_path: str, id_col: str, text_col: str, columns: str, form) -> DataFrame:
    parts = read_model(model_path)
    model, key = docs.sparkSession.sparkContext.broadcast(parts), hash_of(parts)
    names = ["doc_id", *(c.split()[0] for c in columns.split(", "))]

    def run(batches):
        encoder = per_process(f"sentencepiece:{key}", lambda: Encoder(model.value))
        for pdf in batches:
            yield pd.DataFrame([(i, *form(*encoder.encode(t or ""))) for i, t in zip(pdf.doc_id, pdf.text)], columns=names)

    ids = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, f"doc_id {ids}, {columns}")
