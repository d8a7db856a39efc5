"""Byte-pair encoding with the vocabulary files of public tokenizers.

``Codec`` gives the ids that the tokenizers library gives for its file. A text is cut at places where no token can
cross; each distinct cut is encoded once and remembered (a bounded memory), so frequent words cost a lookup.

Long unsplit text (one piece without such a place, as in encoded data or unspaced scripts) goes through a tree
concatenation. The piece is halved until its leaves are short; leaves are encoded in parallel; then at each join a
window of tokens on both sides is encoded again, and grows until both sides agree: the window begins and ends
with the same tokens as the halves, and every neighbouring pair of tokens is stable, which means that encoding the bytes of
the pair alone returns that pair. A sequence of tokens of a text whose neighbouring pairs are all stable is the encoding of
the text, so the result is exact, whatever the place of the cuts.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from .common import arrow_map, kept, table, tokenizer_path

LEAF_BYTES = 512
WINDOW_TOKENS = 4
#: Bytes that the remembered cuts of a worker take, and the longest of them in characters.
REMEMBER_BYTES = 128 << 20
REMEMBER_CHARS = 64
#: What Python needs for an entry besides its characters and ids, as measured with 220,000 of them.
ENTRY_BYTES = 420
#: Characters of a text that are cut up at a time; only memory depends on it.
SLICE_CHARS = 1 << 18


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def concatenate(left: list[int], right: list[int], encode: Callable[[bytes], list[int]], bytes_of: dict[int, bytes]) -> list[int]:
    """Ids of the joined bytes of two encoded halves."""
    if not left or not right:
        return left + right

    def stable(a: int, b: int) -> bool:
        return encode(bytes_of[a] + bytes_of[b]) == [a, b]

    if stable(left[-1], right[0]):
        return left + right
    reach = WINDOW_TOKENS
    while True:
        a, b = max(0, len(left) - reach), min(len(right), reach)
        middle = encode(b"".join(bytes_of[i] for i in left[a:] + right[:b]))
        if (not a or stable(left[a - 1], middle[0])) and (b == len(right) or stable(middle[-1], right[b])):
            return left[:a] + middle + right[b:]
        reach *= 2


def encode_tree(piece: bytes, encode: Callable[[bytes], list[int]], bytes_of: dict[int, bytes], pool: ThreadPoolExecutor | None = None, leaf: int = LEAF_BYTES) -> list[int]:
    """Ids of one long unsplit piece by halves. Leaves are encoded in parallel, and so are the joins of each level."""
    leaves = 1
    while len(piece) > leaf * leaves:
        leaves *= 2
    cuts = [len(piece) * k // leaves for k in range(leaves + 1)]
    run = pool.map if pool else map
    parts = list(run(lambda k: encode(piece[cuts[k] : cuts[k + 1]]) if cuts[k] < cuts[k + 1] else [], range(leaves)))
    while len(parts) > 1:
        parts = list(run(lambda k: concatenate(parts[k], parts[k + 1], encode, bytes_of), range(0, len(parts), 2)))
    return parts[0]


class Codec:
    """One tokenizer file. ``ids(text)`` is little-endian unsigned 32-bit ids; ``text(ids)`` decodes."""

    #: White space of Python that the file's patterns don't count as such.
    ODD = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, alphabet = file["model"], byte_alphabet()
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {a["content"]: a["id"] for a in file["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.bytes_of: list[bytes] = [b""] * (1 + max(*model["vocab"].values(), *self.special.values()))
        ranks: dict[bytes, int] = {}
        for token, i in model["vocab"].items():
            if token in self.special:
                continue
            end = self.suffix and token.endswith(self.suffix)
            raw = bytes(alphabet[c] for c in (token[: -len(self.suffix)] if end else token))
            self.bytes_of[i] = raw + b" " if end else raw
            ranks[raw + b"\xff" if end else raw] = i
        if self.suffix:  # a word's end is one more byte, which no UTF-8 text has; its last byte takes it first of all
            ranks.setdefault(b"\xff" * 2, len(self.bytes_of))
            self.end = b"\xff"
            self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        else:
            self.end = b""
            self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.names = list(self.bytes_of)
        for content, i in self.special.items():
            self.names[i] = content.encode()
        self.piece_bytes = {i: raw for raw, i in ranks.items()}
        self.core = tiktoken.Encoding("file", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.memory: dict[str, bytes] = {}
        self.remembered = 0
        self.pool: ThreadPoolExecutor | None = None

    def piece(self, raw: bytes) -> list[int]:
        """Ids of the bytes of one piece, long ones by tree concatenation."""
        whole = raw + self.end
        if len(whole) <= LEAF_BYTES:
            return self.core.encode_single_piece(whole)
        self.pool = self.pool or ThreadPoolExecutor(2)
        return encode_tree(whole, self.core.encode_single_piece, self.piece_bytes, self.pool)

    def _learn(self, cut: str) -> bytes:
        """Ids of a text without special tokens, through all steps of the file; remembers short ones."""
        text = cut
        if self.suffix:
            # one code point at a time, as the file's lower-casing has no context
            text = cut.lower() if cut.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", text)))
        got: list[int] = []
        # letters of ASCII are one piece
        for piece in [text] if text.isascii() and text.isalpha() else self.pattern.findall(text):
            got += self.piece(piece.encode())
        ids = struct.pack(f"<{len(got)}I", *got)
        if len(cut) <= REMEMBER_CHARS:
            if self.remembered >= REMEMBER_BYTES:
                self.memory.clear()
                self.remembered = 0
            self.memory[cut] = ids
            self.remembered += ENTRY_BYTES + 2 * len(cut) + len(ids)
        return ids

    #: A blank with other white space beside it.
    BESIDE = re.compile(r" \s|\s ")

    def _plain(self, text: str) -> bytes:
        if not self.suffix:
            if self.ODD.search(text) or self.BESIDE.search(text):
                cuts = self.pattern.findall(text)
            else:  # each blank stands between two other characters, and a token can only begin with it
                first, *rest = text.split(" ")
                cuts = [first, *[" " + x for x in rest]]
        elif self.ODD.search(text):
            return self._learn(text)
        else:  # the file drops white space, and no token crosses it
            cuts = text.split()
        got = list(map(self.memory.get, cuts))
        if None in got:
            got = [x if x is not None else (self.memory.get(c) or self._learn(c)) for x, c in zip(got, cuts, strict=True)]
        return b"".join(got)

    #: A blank between two characters that are no white space: tokens of either kind of file can begin with it, but none goes across.
    BETWEEN = re.compile(r"(?<=\S) (?=\S)")

    def _slices(self, text: str) -> Iterator[str]:
        """A long text in parts that are encoded by themselves, each up to the first blank after SLICE_CHARS characters."""
        begin = 0
        while len(text) - begin > SLICE_CHARS and (found := self.BETWEEN.search(text, begin + SLICE_CHARS)):
            yield text[begin : found.start()]
            begin = found.start()
        yield text[begin:]

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        parts = self.special_at.split(text) if "<|" in text else [text]
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else b"".join(map(self._plain, self._slices(p))) for p in parts if p)

    def text(self, ids: bytes) -> str:
        """What the library's decode gives with skip_special_tokens=False, for a file without a word-end suffix."""
        return b"".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    """One for each Python worker, kept between tasks."""
    return kept(path, lambda: Codec(path))


def encode_decode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: key, n_tokens, ids_sha256, decoded_sha256. Null and empty texts have no tokens.

    Tokens stay in the worker: the digest is made where the text is, so only a few bytes of each row go on. Texts of any length are
    encoded whole. Repeated rows and null keys are rows like any other; further columns are left out. No rows: no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            n, ids, back = [], [], []
            for t in batch[1]:
                got = own.ids(t.as_py())
                n.append(len(got) // 4)
                ids.append(hashlib.sha256(got).hexdigest())
                back.append(hashlib.sha256(own.text(got).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    thin = df.select(key, text)
    return arrow_map(thin, run, f"`{key}` {thin.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string", keeps=path)


def op4_bpe(spark, sf_dir: str) -> DataFrame:
    """Number and digest of every document's tokens, and digest of what they decode to."""
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
