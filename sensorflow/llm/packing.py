"""Packing: vector bin packing of token sequences, by the dot-product heuristic.

A bin has three limits: tokens, segments and loss-bearing tokens. Pieces wait
in a window; the next piece of the open bin is the one that fits and has the
largest dot product of its size with what the bin has left, each part weighted
by how scarce it is. When nothing in the window fits whole, the longest piece
is cut to what is left, so a bin ends full unless its segments ran out.

Every partition packs its own rows in one streaming pass; nothing is shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import tidy

#: Limits of a bin: tokens, segments, loss-bearing tokens; and the pieces that wait at most.
TOKENS, SEGMENTS, LOSS, WINDOW = 1024, 64, 1024, 256
#: Fixed value: how this vocabulary's tokenizer splits a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tokenizer:
    """Byte-level BPE ids of whole texts, ended by id 0.

    ``path`` is the vocabulary in ranks, ``added`` the tokens that it lacks and
    the JSON form has (text -> id): each stands for its id wherever a text holds
    it. With them the ids equal those of the JSON form; without, an added token
    is text like any other. The ranks library gives up on runs of about a
    million white-space characters; such a text is encoded by the JSON form
    at ``whole``, which is slower and has no such limit.
    """

    def __init__(self, path: str, added: dict[str, int] | None = None, whole: str | None = None):
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added or {})
        self.added, self.path, self.whole = added, whole, None

    def ids(self, text: str) -> np.ndarray:
        try:
            ids = self.encoding.encode(text, allowed_special="all")
        except ValueError:
            if self.path is None:
                raise
            ids = self._by_whole(text)
        ids.append(0)
        return np.array(ids, "<u4")

    def _by_whole(self, text: str) -> list[int]:
        if self.whole is None:
            import tokenizers

            self.whole = tokenizers.Tokenizer.from_file(self.path)
            self.whole.encode_special_tokens = not self.added
        return self.whole.encode(text, add_special_tokens=False).ids

    def bears_loss(self, ids: np.ndarray, prompt: str) -> np.ndarray:
        """Running count (one longer than ``ids``) of the tokens that do not lie whole in ``prompt``, the beginning of their text."""
        ends = np.cumsum([len(self.encoding.decode_single_token_bytes(i)) for i in ids[:-1].tolist()])
        free = np.append(ends <= len(prompt.encode()), False)
        return np.concatenate(([0], np.cumsum(~free)))


class Packer:
    """Places pieces into bins; closed bins come out as lists of (key, start, length).

    ``running`` of a document is the running count of its loss-bearing tokens
    (one longer than its tokens), or None if all of them are.
    """

    def __init__(self, tokens: int = TOKENS, segments: int = SEGMENTS, loss: int = LOSS, window: int = WINDOW):
        self.limit = np.array([tokens, segments, loss], float)
        self.window = window
        self.wait: list[tuple] = []
        self.sizes = np.empty((window + 1, 3))
        self._reset()

    def _reset(self) -> None:
        self.bin: list[tuple] = []
        self.left = self.limit.copy()

    @staticmethod
    def _loss(p: tuple, n: int) -> int:
        return n if p[3] is None else int(p[3][p[1] + n] - p[3][p[1]])

    def _keep(self, k: int, p: tuple) -> None:
        self.wait[k:k + 1] = [p]
        self.sizes[k] = (p[2], 1, self._loss(p, p[2]))

    def add(self, key, start: int, n: int, running: np.ndarray | None = None) -> Iterator[list[tuple]]:
        """Add ``n`` tokens of ``key`` from ``start`` on; yields the bins that close."""
        size = int(self.limit[0])
        if running is None and self.limit[2] >= size:
            while n >= size:  # a full bin of its own
                yield [(key, start, size)]
                start, n = start + size, n - size
        while n > 0:
            m = min(n, size)
            self._keep(len(self.wait), (key, start, m, running))
            start, n = start + m, n - m
            while len(self.wait) >= self.window:
                yield from self._place()

    def finish(self) -> Iterator[list[tuple]]:
        while self.wait:
            yield from self._place()
        yield from self._close()

    def _close(self) -> Iterator[list[tuple]]:
        """The open bin; one that is not full as bins of power-of-two lengths, which need no padding."""
        pieces, used = self.bin, int(self.limit[0] - self.left[0])
        self._reset()
        if used == self.limit[0]:
            yield pieces
            return
        while used:
            room = want = 1 << (used.bit_length() - 1)
            out = []
            while room:
                key, start, n = pieces.pop()
                m = min(n, room)
                out.append((key, start + n - m, m))
                if m < n:
                    pieces.append((key, start, n - m))
                room -= m
            yield out
            used -= want

    def _take(self, k: int, n: int) -> None:
        p = self.wait[k]
        self.bin.append((p[0], p[1], n))
        self.left -= (n, 1, self._loss(p, n))
        if n < p[2]:
            self._keep(k, (p[0], p[1] + n, p[2] - n, p[3]))
            return
        last = len(self.wait) - 1
        self.wait[k], self.sizes[k] = self.wait[last], self.sizes[last]
        self.wait.pop()

    def _place(self) -> Iterator[list[tuple]]:
        """One step: the best fitting piece, else a cut of the longest, else the bin closes."""
        sizes = self.sizes[:len(self.wait)]
        fits = (sizes <= self.left).all(axis=1)
        if fits.any():
            gain = np.where(fits, (sizes / self.limit) @ (self.left / self.limit), -1)
            k = int(gain.argmax())
            self._take(k, self.wait[k][2])
        else:
            k = int(sizes[:, 0].argmax())
            p = self.wait[k]
            n = min(int(self.left[0]), p[2]) if self.left[1] >= 1 else 0
            if p[3] is None:
                n = min(n, int(self.left[2]))
            elif n:  # as many tokens as the loss that is left allows
                n = int(np.searchsorted(p[3][p[1] + 1:p[1] + n + 1] - p[3][p[1]], self.left[2], "right"))
            if n < 1:
                yield from self._close()
                return
            self._take(k, n)
        if self.left[0] < 1:
            yield from self._close()


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _pack(path: str, added: dict[str, int] | None, whole: str | None, limits: tuple[int, int, int], window: int):
    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        sequence = TaskContext.get().partitionId() << 40
        tokenizer, packer = Tokenizer(path, added, whole), Packer(*limits, window)
        rows: list[tuple] = []
        size = 0

        def out() -> pd.DataFrame:
            pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
            pdf["doc_id"] = pdf["doc_id"].astype("Int64")
            return pdf

        def closed(bins: Iterator[list[tuple]]) -> None:
            nonlocal sequence, size
            for pieces in bins:
                at = 0
                for (doc, ids), start, n in pieces:
                    rows.append((doc, start, n, ids[start:start + n].tobytes(), len(ids), sequence, at))
                    at += n
                size += at
                sequence += 1

        for pdf in batches:
            for doc, text, prompt in zip(pdf["doc_id"], pdf["text"], pdf["prompt"]):
                ids = tokenizer.ids(text or "")
                running = None if pd.isna(prompt) else tokenizer.bears_loss(ids, (text or "")[:max(0, int(prompt))])
                closed(packer.add((None if pd.isna(doc) else int(doc), ids), 0, len(ids), running))
                if size > 1 << 20:
                    yield out()
                    rows, size = [], 0
        closed(packer.finish())
        if rows:
            yield out()
    return run


def pack(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", tokens: int = TOKENS,
         segments: int = SEGMENTS, loss: int = LOSS, window: int = WINDOW,
         added: dict[str, int] | None = None, whole: str | None = None, prompt: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    A document is its ids and a last id 0, so a NULL or empty text is that one
    id. Every id is in exactly one piece; the pieces of a sequence lie without
    gaps from offset 0. Rows are packed one by one, whether they repeat or have
    no id; an empty table gives no rows; texts of any length are packed whole;
    other columns are left out. ``tokenizer`` is a path of the ranks file that
    every executor can read, ``added`` the tokens of the JSON form that the ranks
    lack (``added_tokens``), ``whole`` the path of the JSON form, for texts that
    the ranks library cannot encode. ``prompt`` names a column with the number of
    leading code points of a row that bear no loss (a prompt); NULL, or no such
    column: all tokens bear loss. The last id of a document bears loss.
    """
    if tokens & (tokens - 1):
        raise ValueError("tokens must be a power of two")
    read = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                       (F.col(f"`{prompt}`") if prompt else F.lit(None)).cast("long").alias("prompt"))
    out = read.mapInPandas(_pack(tokenizer, added, whole, (tokens, segments, loss), window), PIECES)
    return out.withColumnRenamed("doc_id", id)


def digest_pieces(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def tokenizer_path() -> str:
    """The public byte-level vocabulary as ranks, the same ids as its JSON form but for ``added_tokens``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def whole_path() -> str:
    """The JSON form of the vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def added_tokens() -> dict[str, int]:
    """Text -> id of the tokens that the vocabulary's JSON form adds to the ranks."""
    with open(whole_path(), encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def op5_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digest_pieces(pack(docs, tokenizer_path(), added=added_tokens(), whole=whole_path()))
