"""Byte-pair encoding by contiguous rank arrays, and decoding.

A text is cut into words by the library's pre-tokenizer (its Unicode tables decide what a letter is). A word holds its part boundaries side by side and, between
each two neighbouring parts, the rank of their merge. The smallest rank is found by a scan of the array; its merge
deletes one boundary, and only the ranks to the left and right of it are looked up anew; this is repeated until no
rank is left. The arrays of many words of one length are the rows of a matrix, so that a step scans, deletes and
refreshes for all of them at once. Words over SHORT bytes, for which scans would cost the square of their length,
keep their ranks in a heap over linked parts. Each distinct word of a batch is encoded once, and a bounded memo of
words stays with the Python worker (see _memo).

Decoding takes each id's bytes from one table. Broken UTF-8 becomes replacement characters.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import pre_tokenizers

from . import _text
from ._memo import DIGIT, LETTER, PUNCT, Memo, byte_characters, memo, only

SHORT, NONE = 32, np.int32(1 << 30)
ENCODED, DECODED = "doc_id bigint, ids array<bigint>", "doc_id bigint, text string"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Merge ranks, special strings and the bytes of every id, from a published byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        ids, marks = given["model"]["vocab"], byte_characters()
        self.special = {t["content"]: t["id"] for t in given.get("added_tokens", [])}
        self.byte_id = np.array([ids[marks[b]] for b in range(256)], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in given["model"]["merges"]]
        left, right, whole = (np.array(x, np.int64) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in merges)))
        self.size = 1 + max(*ids.values(), *self.special.values(), 0)
        self.made = whole.astype(np.int32)
        order = np.argsort(left * self.size + right, kind="stable")
        self.pairs, self.order = (left * self.size + right)[order], order.astype(np.int32)
        byte_of = {c: b for b, c in marks.items()}
        table = [b""] * self.size
        for v, i in [*ids.items(), *self.special.items()]:
            table[i] = bytes(byte_of[c] for c in v) if all(c in byte_of for c in v) else v.encode()
        self.bytes = pa.array(table, pa.binary())
        self.splitter = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.cutter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def words(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(text)] if text else []

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, NONE without one. Negative ids stand for no part."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (a >= 0) & (b >= 0), self.order[at], NONE)

    def merge_rows(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids) of words of one length: a matrix with a word's bytes in each row. Ids stand at the left."""
        n, width = raw.shape
        out, count = np.zeros((n, width), np.int32), np.full(n, width)
        ids, rows = self.byte_id[raw], np.arange(n)
        ranks = self.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        while True:
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(ids), np.int64)
            line = np.arange(len(ids))
            best = ranks[line, at] if ranks.shape[1] else np.full(len(ids), NONE)
            over = best == NONE
            if over.any():
                out[rows[over], :ids.shape[1]] = ids[over]
                count[rows[over]] = ids.shape[1]
                go = ~over
                ids, ranks, rows, at, best = ids[go], ranks[go], rows[go], at[go], best[go]
                line = np.arange(len(ids))
            if not len(ids):
                return out, count
            ids[line, at] = self.made[best]
            column = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), 1)
            column = column[:-1]
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), 1)
            for a in (at - 1, at):  # the boundaries on both sides of the new part
                inside = np.flatnonzero((a >= 0) & (a < ranks.shape[1]))
                ranks[inside, a[inside]] = self.ranks(ids[inside, a[inside]], ids[inside, a[inside] + 1])

    def merge_long(self, raw: bytes) -> list[int]:
        """A long word's ids, with its ranks in a heap over linked parts."""
        ids = self.byte_id[np.frombuffer(raw, np.uint8)].tolist()
        n = len(ids)
        behind, before = list(range(1, n + 1)), list(range(-1, n - 1))
        known = dict(zip(self.pairs.tolist(), self.order.tolist())) if not hasattr(self, "_known") else self._known
        self._known = known
        heap = [(r, k) for k, r in enumerate(self.ranks(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64)).tolist()) if r < NONE]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            j = behind[k] if ids[k] >= 0 else n
            if j >= n or known.get(ids[k] * self.size + ids[j]) != r:
                continue  # one of its parts is gone or has grown
            ids[k], ids[j] = int(self.made[r]), -1
            behind[k] = behind[j]
            if behind[k] < n:
                before[behind[k]] = k
            for a, b in ((before[k], k), (k, behind[k])):
                if a >= 0 and b < n and (rank := known.get(ids[a] * self.size + ids[b])) is not None:
                    heapq.heappush(heap, (rank, a))
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each word; no word is empty."""
        out, by_length = [b""] * len(words), {}
        for k, w in enumerate(words):
            by_length.setdefault(len(w), []).append(k)
        for length, at in by_length.items():
            if length > SHORT:
                for k in at:
                    out[k] = np.array(self.merge_long(words[k]), "<u4").tobytes()
                continue
            ids, count = self.merge_rows(np.frombuffer(b"".join(words[k] for k in at), np.uint8).reshape(-1, length))
            ids = ids.astype("<u4")
            for k, row, n in zip(at, ids, count.tolist()):
                out[k] = row[:n].tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of whole texts; special strings inside them are their ids."""
        plan, distinct = [], {}
        for text in texts:
            parts, at = [], 0
            for m in self.splitter.finditer(text) if self.splitter else ():
                parts += self.words(text[at:m.start()])
                parts.append(self.special[m[0]])
                at = m.end()
            parts += self.words(text[at:] if at else text)
            for p in parts:
                if isinstance(p, str):
                    distinct.setdefault(p, len(distinct))
            plan.append(parts)
        made = self.encode_words([w.encode("utf-8", "surrogatepass") for w in distinct])
        return [b"".join(made[distinct[p]] if isinstance(p, str) else p.to_bytes(4, "little") for p in parts) for parts in plan]

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> Iterator[bytes]:
        """UTF-8 bytes of the text of each ids[edges[k]:edges[k + 1]]."""
        taken = self.bytes.take(pa.array(ids.astype(np.int64)))
        _, offsets, data = taken.buffers()
        offsets = np.frombuffer(offsets, np.int32)[taken.offset:taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int32)
        data = memoryview(data) if data is not None else memoryview(b"")
        for a, b in zip(offsets[edges[:-1]].tolist(), offsets[edges[1:]].tolist()):
            raw = data[a:b].tobytes()
            try:
                raw.decode()
                yield raw
            except UnicodeDecodeError:
                yield raw.decode("utf-8", "replace").encode()


class RankMemo(Memo):
    """The memo over this module's own encoder."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        super().__init__()

    def call(self, texts):
        return self.vocabulary.encode(texts)

    def fresh(self, raw, begin, end, c):
        """Units of one blank and one kind of characters are words as they stand."""
        blank = np.frombuffer(raw, np.uint8)[begin] == 32
        good = end - begin > blank
        good &= only(c, begin + blank, end, (LETTER,)) | only(c, begin + blank, end, (PUNCT,)) | only(c, begin + blank, end, (DIGIT,))
        size, n, start = end - begin, np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        data, parts, held = np.frombuffer(raw, np.uint8), [], 0
        for length in np.unique(size[good & (size <= SHORT)]).tolist():
            rows = np.flatnonzero(good & (size == length))
            ids, count = self.vocabulary.merge_rows(data[begin[rows][:, None] + np.arange(length)])
            n[rows], start[rows] = count, held + np.cumsum(count) - count
            parts.append(ids[np.arange(length) < count[:, None]].astype(np.uint32))
            held += len(parts[-1])
        rows = np.flatnonzero(~good | (size > SHORT))
        ids, count = Memo.fresh(self, raw, begin[rows], end[rows], None)
        n[rows], start[rows] = count, held + np.cumsum(count) - count
        both, ends = np.concatenate([*parts, ids]), np.cumsum(n)
        return both[np.repeat(start - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)], n


def _encode(vocab: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _text.runs(batch):
                flat, edges = memo("ranks", vocab, RankMemo).ids(texts)
                ids = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat, pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], ["doc_id", "ids"])
    return run


def _decode(vocab: str):
    def run(batches):
        words = Vocabulary(vocab)
        for batch in batches:
            lists = batch.column(1).fill_null([])
            for k in range(0, len(lists), 500):
                part = lists.slice(k, 500)
                edges = part.offsets.to_numpy().astype(np.int64)
                texts = [x.decode() for x in words.decode(part.flatten().to_numpy(zero_copy_only=False), edges - edges[0])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, len(part)), pa.array(texts, pa.string())], ["doc_id", "text"])
    return run


def _round_trip(vocab: str):
    def run(batches):
        for batch in batches:
            for at, texts in _text.runs(batch):
                m = memo("ranks", vocab, RankMemo)
                flat, edges = m.ids(texts)
                raw, bounds = memoryview(flat.astype("<u4").tobytes()), (4 * edges).tolist()
                ids = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:])]
                back = [hashlib.sha256(x).hexdigest() for x in m.vocabulary.decode(flat, edges)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(np.diff(edges), pa.int64()), pa.array(ids, pa.string()),
                                                  pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def encode(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids of every whole text, one row per input row.

    NULL and empty texts have no ids; a NULL id is kept; repeated rows give repeated results; other columns are
    ignored; an empty table gives an empty result. `vocab` is the path of a byte-level BPE file.
    """
    return _text.rows(docs, id_col=id_col, text_col=text_col).mapInArrow(_encode(vocab), ENCODED)


def decode(encoded: DataFrame, vocab: str) -> DataFrame:
    """doc_id, text of every id list, special ids as their strings; a NULL list is an empty text."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(vocab), DECODED)


def round_trip(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the digests of each text's ids (little-endian unsigned 32-bit) and of the text decoded from them;
    edge rows as in `encode`."""
    return _text.rows(docs, id_col=id_col, text_col=text_col).mapInArrow(_round_trip(vocab), DIGESTS)
