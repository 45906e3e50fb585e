"""Ids of whole texts from a tokenizer, with a bounded memo of its calls.

A text is cut into units at borders that no token can cross whatever surrounds them: around white space, and
where letters, digits and punctuation of ASCII (and the letters of Latin-1) meet. All that is not known to be
one of these stays joined to its neighbours, and texts that may hold special strings go to the tokenizer whole.
So a text's ids are the ids of its units. Units are found on the bytes of an Arrow batch by table lookups, and
looked up in one open-addressing table of whole-array steps; only units that are not in it reach the tokenizer,
each once a batch.

The table belongs to the Python worker, not to the task: functions are shipped by value, which gives every task
fresh module globals, so it hangs on an entry of sys.modules. It keeps the first LIMIT units that are met twice
(a bitmap of SEEN hashes remembers the first meeting); all others are encoded each time, so its size never
changes a result. A worker keeps one tokenizer's memo; `release` drops it.
"""

from __future__ import annotations

import os
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LIMIT, SLOT_BITS, SEEN_BITS, KEY_WORDS, BLOCK, STRETCH = 600_000, 20, 23, 3, 1 << 14, 2_000_000
OTHER, LETTER, BLANK, SPACE, PUNCT, DIGIT, QUOTE, EDGE = range(8)
KNOWN = np.isin(np.arange(8), (LETTER, PUNCT, DIGIT, QUOTE))


def _classes() -> np.ndarray:
    """The class of each byte. Bytes over 127 and control characters are OTHER."""
    out = np.zeros(256, np.uint8)
    for k in range(33, 127):
        c = chr(k)
        out[k] = LETTER if c.isalpha() else DIGIT if c.isdigit() else QUOTE if c == "'" else PUNCT
    out[9:14], out[32] = SPACE, BLANK
    return out


CLASS = _classes()
#: [class before, class]: a unit begins here whatever comes next.
BORDER = np.zeros((8, 8), bool)
BORDER[np.ix_(KNOWN, [BLANK, SPACE])] = True
BORDER[SPACE, KNOWN] = True
for _a, _b in ((LETTER, PUNCT), (LETTER, QUOTE), (LETTER, DIGIT), (DIGIT, LETTER), (DIGIT, PUNCT), (DIGIT, QUOTE), (PUNCT, LETTER), (PUNCT, DIGIT)):
    BORDER[_a, _b] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPREAD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
MASKS = np.array([(1 << 8 * k) - 1 if k < 8 else (1 << 64) - 1 for k in range(9)], np.uint64)


def kept(name: str) -> dict:
    """A dict that lives as long as the Python process, however often this module is shipped."""
    home = sys.modules.setdefault("sidweave_kept", types.ModuleType("sidweave_kept"))
    return home.__dict__.setdefault(name, {})


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts with room behind them, offsets of the texts); NULL counts as empty."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(32, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    out = np.zeros(size + 32, np.uint8)
    if size:
        out[:size] = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return out, offsets - offsets[0]


class Table:
    """Byte strings of up to 24 bytes and their row numbers, found and added by whole arrays."""

    def __init__(self) -> None:
        self.slots = np.zeros((1 << SLOT_BITS, KEY_WORDS + 1), np.uint64)  # the key and 1 + row; 0: empty

    def find(self, keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if it has none."""
        out, todo = np.full(len(keys), -1, np.int64), None
        at = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        while todo is None or len(todo):
            got, own = self.slots.take(at, 0), keys if todo is None else keys[todo]
            held = got[:, KEY_WORDS]
            full = held > 0
            same = full & (got[:, :KEY_WORDS] == own).all(1)
            hit = np.flatnonzero(same)
            out[hit if todo is None else todo[hit]] = held[hit].astype(np.int64) - 1
            on = np.flatnonzero(full & ~same)
            todo, at = on if todo is None else todo[on], (at[on] + 1) & ((1 << SLOT_BITS) - 1)
        return out

    def add(self, keys: np.ndarray, hashes: np.ndarray, rows: np.ndarray) -> None:
        """Distinct keys that are not in the table yet."""
        todo, at = np.arange(len(keys)), (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        while len(todo):
            free = np.flatnonzero(self.slots[at, KEY_WORDS] == 0)
            _, first = np.unique(at[free], return_index=True)  # of several for one slot the first takes it
            won = free[first]
            self.slots[at[won], :KEY_WORDS] = keys[todo[won]]
            self.slots[at[won], KEY_WORDS] = (rows[todo[won]] + 1).astype(np.uint64)
            on = np.ones(len(todo), bool)
            on[won] = False
            todo, at = todo[on], (at[on] + 1) & ((1 << SLOT_BITS) - 1)


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Memo:
    """ids(texts) -> all ids one after the other (unsigned 32 bit) and each text's bounds in them."""

    drop_blank = False  # a unit's leading blank makes no difference

    def __init__(self) -> None:
        self.table, self.seen = Table(), np.zeros(1 << SEEN_BITS, bool)
        self.pool, self.sizes, self.starts = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def call(self, texts: list[str]) -> list[bytes]:
        """The tokenizer's ids of each text, as little-endian unsigned 32-bit bytes."""
        raise NotImplementedError

    def odd(self, texts: pa.Array) -> pa.Array:
        """Texts that must go to the tokenizer whole."""
        return pc.match_substring(texts, "<|")

    def folded(self, data: np.ndarray) -> np.ndarray:
        """Bytes with the same ids and fewer distinct units."""
        return data

    def borders(self, c: np.ndarray, before: np.ndarray, behind: np.ndarray) -> np.ndarray:
        """Where units begin, from the classes of each byte and its neighbours."""
        out = BORDER.ravel()[before << 3 | c]
        out |= ((c == BLANK) | (c == SPACE)) & KNOWN[behind]
        return out

    def fresh(self, raw: bytes, begin: np.ndarray, end: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, number of ids) of the units raw[begin:end]."""
        made = self.call([raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(begin.tolist(), end.tolist())])
        return np.frombuffer(b"".join(made), np.uint32), np.fromiter(map(len, made), np.int64, len(made)) // 4

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """In stretches of about STRETCH bytes, which bound the arrays at work."""
        size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at, parts, edges = np.cumsum(size), 0, [], [np.zeros(1, np.int64)]
        while at < len(texts) or not parts:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STRETCH, "right")))
            flat, own = self._ids(texts.slice(at, to - at))
            parts.append(flat)
            edges.append(own[1:] + edges[-1][-1])
            at = to
        return np.concatenate(parts), np.concatenate(edges)

    def _ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        whole = self.odd(texts).to_numpy(zero_copy_only=False)
        data, bounds = text_bytes(texts)
        data = self.folded(data)
        size = int(bounds[-1])
        c = CLASS[data]
        latin = np.flatnonzero(data[:size] == 0xC3)  # U+00C0 to U+00FF: letters but for two signs
        latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
        c[latin] = c[latin + 1] = LETTER
        c, inner = c[:size], bounds[:-1][bounds[:-1] < size]
        before = np.concatenate([[np.uint8(EDGE)], c[:-1]])[:size]
        before[inner] = EDGE
        behind = np.concatenate([c[1:], [np.uint8(EDGE)]])[:size]
        behind[bounds[1:][bounds[1:] > 0] - 1] = EDGE
        border = self.borders(c, before, behind)
        border[inner] = True
        begin = np.flatnonzero(border)
        end = np.append(begin[1:], size)[:len(begin)]
        unit_of = np.searchsorted(begin, bounds)
        flat, each = self._units(data, begin, end, c)
        edges = np.concatenate([[0], np.cumsum(each)])[unit_of]
        return self._with_whole(texts, whole, flat, edges) if whole.any() else (flat, edges)

    def _units(self, data, begin, end, c):
        """ids of all units one after the other, and how many each has."""
        if self.drop_blank:
            begin = begin + (data[begin] == 32)
        length, wide = end - begin, np.ndarray((len(data) - 7,), np.uint64, data, strides=(1,))
        keys, hashes, row = np.empty((len(begin), KEY_WORDS), np.uint64), np.empty(len(begin), np.uint64), np.empty(len(begin), np.int64)
        for at in range(0, len(begin), BLOCK):  # blocks that stay in the processor's cache
            b, n = begin[at:at + BLOCK], length[at:at + BLOCK]
            own, h = keys[at:at + BLOCK], n.astype(np.uint64)
            for k in range(KEY_WORDS):
                own[:, k] = wide[np.minimum(b + 8 * k, len(wide) - 1)] & MASKS.take(np.clip(n - 8 * k, 0, 8))
                h = (h ^ own[:, k]) * SPREAD[k]
                h ^= h >> np.uint64(29)
            hashes[at:at + BLOCK] = h = h * SPREAD[0]
            row[at:at + BLOCK] = self.table.find(own, h)
        short = length <= 8 * KEY_WORDS
        zero = np.flatnonzero(data[:-32] == 0)  # a key ends at its zero bytes, so units that hold one have no key
        if len(zero) and len(begin):
            short[np.searchsorted(begin, zero, "right") - 1] = False
        row[~short] = -1
        unseen = np.flatnonzero(row < 0)
        pool, sizes, starts = self.pool, self.sizes, self.starts
        if len(unseen):
            own = np.where(short[unseen], hashes[unseen], unseen.astype(np.uint64))
            _, first, place = np.unique(own, return_index=True, return_inverse=True)
            twin = unseen[first][place]
            order = np.argsort(first)
            first, place = first[order], np.argsort(order)[place]
            apart = (keys[unseen] != keys[twin]).any(1) | (length[unseen] != length[twin]) | ((~short[unseen] | ~short[twin]) & (unseen != twin))
            lone = np.flatnonzero(apart)  # one hash for two units: each is a unit of its own
            asked = np.concatenate([unseen[first], unseen[lone]])
            place[lone] = len(first) + np.arange(len(lone))
            flat, n = self.fresh(data.tobytes(), begin[asked], end[asked], c)
            at = np.cumsum(n) - n
            row[unseen] = len(sizes) + place
            pool, sizes, starts = np.concatenate([pool, flat]), np.concatenate([sizes, n]), np.concatenate([starts, at + len(pool)])
            self._keep(asked[:len(first)], np.bincount(place, minlength=len(asked))[:len(first)], keys, hashes, short, flat, n, at)
        each = sizes[row]
        total = int(each.sum())
        narrow = np.int32 if max(total, len(pool)) < 1 << 31 else np.int64
        ends = np.cumsum(each)
        index = np.repeat((starts[row] - ends + each).astype(narrow), each)
        index += np.arange(total, dtype=narrow)
        return pool[index], each

    def _keep(self, asked, met, keys, hashes, short, flat, n, at) -> None:
        room = LIMIT - len(self.sizes)
        if room <= 0:
            return
        mark = (hashes[asked] >> np.uint64(64 - SEEN_BITS)).astype(np.int64)
        keep = np.flatnonzero(short[asked] & ((met > 1) | self.seen[mark]))[:room]
        self.seen[mark] = True
        if not len(keep):
            return
        ends = np.cumsum(n[keep])
        index = np.repeat(at[keep] - ends + n[keep], n[keep]) + np.arange(ends[-1])
        self.table.add(keys[asked[keep]], hashes[asked[keep]], len(self.sizes) + np.arange(len(keep)))
        self.starts = np.concatenate([self.starts, len(self.pool) + ends - n[keep]])
        self.sizes = np.concatenate([self.sizes, n[keep]])
        self.pool = np.concatenate([self.pool, flat[index]])

    def _with_whole(self, texts, whole, flat, edges):
        parts, at, spread = [], 0, np.flatnonzero(whole)
        for i in spread:  # one at a time: such texts may be long
            own = np.frombuffer(self.call([texts[int(i)].as_py()])[0], np.uint32)
            parts += [flat[edges[at]:edges[i]], own]
            at = i + 1
        parts.append(flat[edges[at]:])
        lengths = np.diff(edges)
        lengths[spread] = [len(p) for p in parts[1::2]]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(lengths)])

    def _joined(self, raw, begin, end, good, glue: bytes, cuts):
        """fresh, with all `good` units in calls of many: joined by `glue` for the inner model, the ids cut apart by
        cuts(ids) -> (starts, ends) in them."""
        pick, rest = np.flatnonzero(good), np.flatnonzero(~good)
        joined = self.inner_form(glue.join([raw[a:b] for a, b in zip(begin[pick].tolist(), end[pick].tolist())]))
        ids = np.frombuffer(_packed(self.inner.encode_batch_fast([joined], add_special_tokens=False)[0].ids), np.uint32)
        lo, hi = cuts(ids)
        if len(lo) != len(pick):
            return Memo.fresh(self, raw, begin, end, None)
        other, n_other = Memo.fresh(self, raw, begin[rest], end[rest], None)
        n, start = np.empty(len(begin), np.int64), np.empty(len(begin), np.int64)
        n[pick], start[pick] = hi - lo, lo
        n[rest], start[rest] = n_other, len(ids) + np.cumsum(n_other) - n_other
        both, ends = np.concatenate([ids, other]), np.cumsum(n)
        return both[np.repeat(start - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)], n


def only(c: np.ndarray, begin: np.ndarray, end: np.ndarray, classes: tuple[int, ...]) -> np.ndarray:
    """Units, in ascending order and apart, of which every byte is of the given classes."""
    if not len(begin):
        return np.zeros(0, bool)
    bad = ~np.isin(np.arange(8), classes)[np.append(c, np.uint8(EDGE))]
    return ~np.logical_or.reduceat(bad, np.stack([begin, end], 1).ravel())[::2]


def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def inner(path: str):
    """The same library and model for units that are cut and normal already: white space alone separates them."""
    import json

    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    return Tokenizer.from_str(json.dumps(given | {"pre_tokenizer": {"type": "WhitespaceSplit"}, "normalizer": None, "added_tokens": []}))


def byte_characters() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes as: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    return out | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in out)}


SHIFTED = [(chr(b), c) for b, c in byte_characters().items() if ord(c) != b and b != 10]


def shifted(raw: bytes) -> str:
    """Bytes as byte-level characters; line ends stay."""
    out = raw.decode("latin-1")
    for b, c in SHIFTED:
        out = out.replace(b, c)
    return out


class ByteMemo(Memo):
    """Byte-level BPE. A blank belongs to what follows it; a line end between two words is an id of its own."""

    def __init__(self, path: str) -> None:
        self.library, self.inner = library(path), inner(path)
        self.line = self.library.token_to_id("Ċ")
        super().__init__()

    def call(self, texts):
        return [_packed(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def inner_form(self, joined: bytes) -> str:
        return shifted(joined).replace("\n", "\nĊ\n")

    def fresh(self, raw, begin, end, c):
        blank = np.frombuffer(raw, np.uint8)[begin] == 32
        good = end - begin > blank
        good &= only(c, begin + blank, end, (LETTER,)) | only(c, begin + blank, end, (PUNCT,)) | only(c, begin + blank, end, (DIGIT,))

        def cuts(ids):
            at = np.flatnonzero(ids == self.line)
            return np.concatenate([[0], at + 1]), np.append(at, len(ids))

        return self._joined(raw, begin, end, good, b"\n", cuts)


class WordMemo(Memo):
    """BPE over lower-cased words that ends each word with a marked id; white space only separates."""

    drop_blank = True

    def __init__(self, path: str) -> None:
        self.library, self.inner = library(path), inner(path)
        vocab = self.library.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for v, i in vocab.items() if v.endswith("</w>")]] = True
        super().__init__()

    call = ByteMemo.call

    def inner_form(self, joined: bytes) -> str:
        return shifted(joined.decode().lower().encode())

    def folded(self, data):
        """ASCII letters in lower case, as the tokenizer's own normaliser makes them."""
        return LOWER[data]

    def fresh(self, raw, begin, end, c):
        good = (only(c, begin, end, (LETTER,)) | only(c, begin, end, (PUNCT,))) & (end > begin)

        def cuts(ids):
            ends = np.flatnonzero(self.last[ids]) + 1
            return np.concatenate([[0], ends[:-1]]), ends

        return self._joined(raw, begin, end, good, b"\n", cuts)


class PieceMemo(Memo):
    """Sentence pieces with byte fallback; the library puts a word mark before each unit itself."""

    drop_blank = True

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(n)]
        plain = [not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i)) for i in range(n)]
        if any("▁" in v.lstrip("▁") for v, p in zip(names, plain) if p):
            raise ValueError("a piece crosses a word border; units would not be exact")
        self.pairs = {v[k:k + 2] for v, p in zip(names, plain) if p for k in range(len(v) - 1)}
        self.sizes_of = np.array([len(v.replace("▁", " ").encode()) if p else 1 for v, p in zip(names, plain)])
        super().__init__()

    def call(self, texts):
        return [_packed(x) for x in self.library.encode(texts, num_threads=1)]

    def borders(self, c, before, behind):
        return c == BLANK

    def odd(self, texts):
        odd = pc.or_(pc.match_substring(texts, "▁"), pc.match_substring(texts, "  "))
        edge = pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " "))
        return pc.or_(pc.or_(odd, edge), pc.equal(pc.binary_length(texts), 0))


KINDS = {"byte": ByteMemo, "word": WordMemo, "piece": PieceMemo}


def memo(kind: str, path: str, make=None) -> Memo:
    """The worker's memo for a tokenizer file; kept between tasks until another one is asked for."""
    held = kept("memo")
    if (kind, path) not in held:
        release()
        held[kind, path] = (make or KINDS[kind])(path)
    return held[kind, path]


def release() -> None:
    """Give the memory of the worker's memo or automaton back before work that needs it."""
    for name in ("memo", "matcher"):
        kept(name).clear()
    pa.default_memory_pool().release_unused()
