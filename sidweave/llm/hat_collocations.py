"""Phrase collocations, counted in HAT-tries.

Each task counts the phrases of its texts in tries over word ids, one for each language. The root's children are the
prefix partitions (a hash of a phrase's first two words); below each hangs a shallow trie whose leaves are hash
containers for ranges of phrases. Only the longest phrase from each place goes in, up to four words or the piece's
end; a shorter one's count is that of all phrases that begin with it, which share its prefix partition. A container that holds over BURST phrases bursts at the next word: words that fill
half a container get a child of their own, the others share children. When a task holds more than HELD phrases, it
spills the largest subtrees, whole, as runs sorted by their words; a run carries its own words, so no id leaves a
task. Runs travel to their prefix partition, where they are merged and phrases under the least count go.

Words under the least count can stand in no candidate, so they end pieces like punctuation does. They are counted
first, and the others are marked in a bitmap of 2**MAP_BITS hashes, whatever their number: a rare word that shares a
mark with a frequent one costs work but changes no result. Scores, cuts and the dropping of contained phrases are
joins of the frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from . import _text
from ._memo import LOWER, text_bytes

LEAST, LONGEST, MAP_BITS, BURST, HELD, WORDS = 30, 4, 24, 1 << 16, 2_000_000, (1 << 16) - 1
SHIFTS = np.array([48, 32, 16, 0], np.uint64)
RUN, PHRASES = "lang string, part int, run binary", "lang string, words array<string>, f bigint"
#: The characters that end pieces, and those that separate words.
ENDS, BETWEEN = ".,;:!?\n\x0b\x0c\r", " \t"
END = np.isin(np.arange(256), [ord(c) for c in ENDS])
IN_WORD = ~END & ~np.isin(np.arange(256), [ord(c) for c in BETWEEN])


def spans(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """(each word of a run of texts, its text's number, a number that changes at the border of a piece)."""
    data, bounds = text_bytes(texts)
    size = int(bounds[-1])
    inside = IN_WORD[data[:size]]
    head = inside.copy()
    head[1:] &= ~inside[:max(0, size - 1)]
    edge = bounds[:-1][bounds[:-1] < size]
    head[edge] = inside[edge]
    begin = np.flatnonzero(head)
    doc = np.searchsorted(bounds, begin, "right") - 1
    letters = LOWER[data[:size][inside]]
    offsets = np.append(np.concatenate([[0], np.cumsum(inside)])[begin], len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words.dictionary_encode(), doc, np.cumsum(END[data[:size]])[begin] + doc if len(begin) else doc


def by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.DictionaryArray, np.ndarray, np.ndarray]]:
    """(lang, words, word number of each place, piece number of each place) of runs of (lang, text) rows."""
    for at, texts in _text.runs(batch):
        words, doc, piece = spans(texts)
        langs = batch.column(0).slice(at, len(texts)).dictionary_encode()
        code, lang = words.indices.to_numpy().astype(np.int64), langs.indices.to_numpy()[doc]
        for k, name in enumerate(langs.dictionary.to_pylist()):
            mine = lang == k
            if mine.any():
                yield name, words.dictionary, code[mine], piece[mine]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, words, code, _ in by_lang(batch):
            n = np.bincount(code, minlength=len(words))
            met = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(met) + 1), pa.string()),
                                              pa.concat_arrays([words.take(pa.array(met)), pa.nulls(1, pa.string())]),
                                              pa.array(np.append(n[met], len(code)), pa.int64())], ["lang", "word", "f"])


def hashes(lang: str, words: list[str]) -> np.ndarray:
    """The same hash as Spark's xxhash64 of lang and word."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def word_map(words: DataFrame) -> np.ndarray:
    """The bitmap of the words of (lang, word): at most 2**(MAP_BITS - 6) rows come to the driver."""
    bucket = F.pmod(F.xxhash64("lang", "word"), F.lit(1 << MAP_BITS))
    marks = words.select(bucket.alias("b")).groupBy(F.shiftright("b", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b & 63 AS int))")).alias("bits")).toPandas()
    out = np.zeros(1 << MAP_BITS - 6, np.int64)
    out[marks["at"].to_numpy(np.int64)] = marks["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


class Container:
    """A leaf: phrases from `low` on that share their first `depth` words, counted by hash; not sorted."""

    def __init__(self, low: int, depth: int) -> None:
        self.low, self.depth, self.keys, self.counts, self.fresh, self.n_fresh = low, depth, np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray) -> None:
        self.fresh.append(keys)
        self.n_fresh += len(keys)

    def size(self) -> int:
        return len(self.keys) + self.n_fresh

    def count(self) -> None:
        if not self.n_fresh:
            return
        keys = np.concatenate([self.keys, *self.fresh])
        counts = np.concatenate([self.counts, np.ones(self.n_fresh, np.int64)])
        made = pa.table({"k": keys, "c": counts}).group_by("k", use_threads=False).aggregate([("c", "sum")])
        self.keys, self.counts = made["k"].to_numpy(), made["c_sum"].to_numpy()
        self.fresh, self.n_fresh = [], 0

    def burst(self, high: int) -> list[Container]:
        """Children by the next word, for phrases under `high`: one that fills half a container is alone, the others share."""
        word = (self.keys >> SHIFTS[self.depth]).astype(np.int64) & WORDS
        most = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=WORDS + 1))])
        step, stem = 1 << int(SHIFTS[self.depth]), self.low >> int(SHIFTS[self.depth]) + 16 << int(SHIFTS[self.depth]) + 16
        out, at = [], self.low >> int(SHIFTS[self.depth]) & WORDS
        last = min(WORDS, high - 1 - stem >> int(SHIFTS[self.depth]))
        while at <= last:
            to = min(last + 1, max(at + 1, int(np.searchsorted(most, most[at] + BURST // 2, "right")) - 1))
            child = Container(max(self.low, stem + at * step), self.depth + (to == at + 1))
            mine = (word >= at) & (word < to)
            child.keys, child.counts = self.keys[mine], self.counts[mine]
            out.append(child)
            at = to
        return out


class Subtree:
    """The phrases of one prefix partition."""

    def __init__(self) -> None:
        self.leaves, self.lows = [Container(0, 0)], np.zeros(1, np.uint64)

    def add(self, keys: np.ndarray) -> None:
        if len(self.leaves) == 1:
            self.leaves[0].add(keys)
        else:
            leaf = np.searchsorted(self.lows, keys, "right") - 1
            for k in np.unique(leaf):
                self.leaves[k].add(keys[leaf == k])
        if any(leaf.size() > BURST for leaf in self.leaves):
            grown = []
            for leaf, high in zip(self.leaves, [*self.lows[1:].tolist(), 1 << 64]):
                if leaf.size() > BURST:
                    leaf.count()
                grown += leaf.burst(high) if len(leaf.keys) > BURST and leaf.depth < LONGEST else [leaf]
            self.leaves = grown
            self.lows = np.array([leaf.low for leaf in grown], np.uint64)

    def size(self) -> int:
        return sum(leaf.size() for leaf in self.leaves)

    def run(self, words: np.ndarray) -> bytes:
        """All phrases sorted by their words, with the words that they need. words: of each id, as objects."""
        for leaf in self.leaves:
            leaf.count()
        keys, counts = np.concatenate([leaf.keys for leaf in self.leaves]), np.concatenate([leaf.counts for leaf in self.leaves])
        ids = (keys[:, None] >> SHIFTS).astype(np.int64) & WORDS
        own = np.unique(ids)
        own = own[own > 0]
        order = np.argsort(words[own])
        place = np.zeros(len(words), np.uint64)
        place[own[order]] = np.arange(1, len(own) + 1)
        keys = (place[ids] << SHIFTS).sum(1, dtype=np.uint64)
        by = np.argsort(keys)
        return packed(b" ".join(words[own[order]].tolist()), keys[by], counts[by])


def packed(words: bytes, keys: np.ndarray, counts: np.ndarray) -> bytes:
    """A run: sizes, words, the four columns of word places and the counts, compressed."""
    columns = ((keys[None, :] >> SHIFTS[:, None]) & np.uint64(WORDS)).astype("<u2")
    head = np.array([len(words), len(keys)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + words + columns.tobytes() + counts.astype("<i8").tobytes())


def unpacked(run: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, four word places of each phrase, counts); place 0 is no word."""
    raw = zstandard.ZstdDecompressor().decompress(run)
    n_words, n = np.frombuffer(raw, "<i8", 2).tolist()
    at = 16 + n_words
    return raw[16:at].split(b" "), np.frombuffer(raw, "<u2", 4 * n, at).reshape(4, n).T.astype(np.int64), np.frombuffer(raw, "<i8", n, at + 8 * n)


class HatTrie:
    """One language's phrases, each from its place on up to LONGEST words; `marks` is the bitmap of frequent words."""

    def __init__(self, lang: str, marks: np.ndarray, parts: int) -> None:
        self.lang, self.marks, self.parts = lang, marks, parts
        self.reset()

    def reset(self) -> None:
        self.ids, self.hash_of, self.trees = {}, np.zeros(WORDS + 1, np.uint64), {}

    def size(self) -> int:
        return sum(t.size() for t in self.trees.values())

    def add(self, words: pa.Array, code: np.ndarray, piece: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """Count the phrases of consecutive places; yields runs that had to be spilled."""
        met, place = np.unique(code, return_inverse=True)
        texts = words.take(pa.array(met)).to_pylist()
        found = hashes(self.lang, texts)
        bucket = found & np.uint64((1 << MAP_BITS) - 1)
        often = (self.marks[(bucket >> np.uint64(6)).astype(np.int64)] >> (bucket & np.uint64(63)) & np.uint64(1)).astype(bool)
        yield from self._stretch([t.encode() for t in texts], found, often, place, piece, 0, len(code))

    def _stretch(self, texts, found, often, place, piece, begin, end):
        """Phrases that begin at places begin to end - 1; a trie's word ids are bounded, so a stretch with more words is halved."""
        reach = min(len(place), end + LONGEST - 1)
        here = np.unique(place[begin:reach])
        here = here[often[here]]
        new = [k for k in here.tolist() if texts[k] not in self.ids]
        if len(self.ids) + len(new) > WORDS:
            yield from self.spill(0)
            if len(here) > WORDS:
                middle = (begin + end) // 2
                for a, b in ((begin, middle), (middle, end)):
                    yield from self._stretch(texts, found, often, place, piece, a, b)
                return
            new = here.tolist()
        for k in new:
            self.ids[texts[k]] = len(self.ids) + 1
            self.hash_of[len(self.ids)] = found[k]
        id_of = np.zeros(len(texts), np.uint64)
        id_of[here] = [self.ids[texts[k]] for k in here.tolist()]
        w, p, n = id_of[place[begin:reach]], piece[begin:reach], end - begin
        key, live, two = w[:n] << SHIFTS[0], w[:n] > 0, None
        for k in range(1, LONGEST):  # the longest phrase from each place; the trie holds its beginnings too
            m = min(n, len(w) - k)
            live = live[:m] & (w[k:k + m] > 0) & (p[k:k + m] == p[:m])
            key[:m][live] |= w[k:k + m][live] << SHIFTS[k]
            two = np.flatnonzero(live) if two is None else two
        keys = key[two]
        part = self.hash_of[(keys >> SHIFTS[0]).astype(np.int64)] * np.uint64(0x9E3779B97F4A7C15) + self.hash_of[(keys >> SHIFTS[1]).astype(np.int64) & WORDS]
        part = ((part ^ part >> np.uint64(32)) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(33)) % np.uint64(self.parts)
        order = np.argsort(part.astype(np.uint16 if self.parts <= 1 << 16 else np.int64), kind="stable")
        keys, part = keys[order], part[order].astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]) if len(part) else [0]
        for a, b in zip(cuts, cuts[1:]):
            self.trees.setdefault(int(part[a]), Subtree()).add(keys[a:b])
        if self.size() > HELD:
            for t in self.trees.values():
                for leaf in t.leaves:
                    leaf.count()
            if self.size() > HELD // 2:
                yield from self.spill(HELD // 4)

    def spill(self, down_to: int) -> Iterator[tuple[int, bytes]]:
        """The largest subtrees, whole, until `down_to` phrases are left; with 0 the word ids begin anew."""
        words, held = np.array([b"", *self.ids], object), self.size()
        for part, tree in sorted(self.trees.items(), key=lambda x: -x[1].size()):
            if held <= down_to:
                break
            held -= tree.size()
            yield part, tree.run(words)
            del self.trees[part]
        if not down_to:
            self.reset()


def _runs(shared, parts: int):
    def emit(lang, runs):
        for part, run in runs:
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([part], pa.int32()), pa.array([run], pa.binary())], ["lang", "part", "run"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = {}
        for batch in batches:
            for lang, words, code, piece in by_lang(batch):
                if lang not in tries:
                    tries[lang] = HatTrie(lang, shared.value, parts)
                yield from emit(lang, tries[lang].add(words, code, piece))
                while sum(t.size() for t in tries.values()) > 2 * HELD or len(tries) > 64:  # many languages together
                    largest = max(tries, key=lambda x: tries[x].size())
                    yield from emit(largest, tries.pop(largest).spill(0))
        for lang, trie in tries.items():
            yield from emit(lang, trie.spill(0))
    return run


class Merge:
    """The runs of one prefix partition. They are sorted by words, so a merge keeps that order."""

    def __init__(self) -> None:
        self.runs, self.n = [], 0

    def add(self, run: bytes) -> None:
        self.runs.append(unpacked(run))
        self.n += len(self.runs[-1][2])
        if len(self.runs) > 1 and self.n > HELD + 2 * len(self.runs[0][2]):
            self.merge()

    def merge(self) -> None:
        words = sorted({w for own, _, _ in self.runs for w in own})
        at = {w: k + 1 for k, w in enumerate(words)}
        ids = np.concatenate([np.array([0, *(at[w] for w in own)], np.int64)[place] for own, place, _ in self.runs])
        counts = np.concatenate([c for _, _, c in self.runs])
        if len(words) <= WORDS:
            key = (ids.astype(np.uint64) << SHIFTS).sum(1, dtype=np.uint64)
            order = np.argsort(key, kind="stable")  # merges what is sorted already
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        else:
            order = np.lexsort(ids.T[::-1])
            first = np.flatnonzero(np.concatenate([[True], (np.diff(ids[order], axis=0) != 0).any(1)]))
        self.runs = [(words, ids[order][first], np.add.reduceat(counts[order], first))]
        self.n = len(first)

    def frequent(self, lang: str, least: int) -> pa.RecordBatch:
        self.merge()
        words, ids, counts = self.runs[0]
        names, found, sums = pa.array([w.decode() for w in words], pa.string()), [np.zeros((0, LONGEST), np.int64)], []
        for n in range(2, LONGEST + 1):  # phrases of n words are the runs of equal beginnings
            first = np.flatnonzero(np.concatenate([[True], (np.diff(ids[:, :n], axis=0) != 0).any(1)]))
            f = np.add.reduceat(counts, first)
            good = (f >= least) & (ids[first, n - 1] > 0)
            found.append(np.where(np.arange(LONGEST) < n, ids[first[good]], 0))
            sums.append(f[good])
        ids, f = np.concatenate(found), np.concatenate(sums)
        edges = np.concatenate([[0], np.cumsum((ids > 0).sum(1))])
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), names.take(pa.array(ids[ids > 0] - 1)))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(f), pa.string()), lists, pa.array(f, pa.int64())], ["lang", "words", "f"])


def _merged(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, Merge()
        for batch in batches:
            for lang, part, blob in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if group is not None and group != (lang, part):
                    yield held.frequent(group[0], least)
                    held = Merge()
                group = (lang, part)
                held.add(blob)
        if group is not None:
            yield held.frequent(group[0], least)
    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, words, f) of all phrases of one to four words that occur `least` times or more, (lang, n) word occurrences)."""
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    words = rows.mapInArrow(_count_words, "lang string, word string, f bigint").groupBy("lang", "word").agg(F.sum("f").alias("f"))
    words = cut(words.where((F.col("f") >= least) | F.col("word").isNull()))
    often = words.where("word IS NOT NULL")
    shared = docs.sparkSession.sparkContext.broadcast(word_map(often))
    tasks = _text.partitions(docs)
    runs = rows.mapInArrow(_runs(shared, 4 * tasks), RUN)
    merged = runs.repartition(tasks, "lang", "part").sortWithinPartitions("lang", "part").mapInArrow(_merged(least), PHRASES)
    phrases = often.select("lang", F.array("word").alias("words"), "f").unionByName(merged)
    return cut(phrases), words.where("word IS NULL").select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of two to four words.

    `a` counts the phrase, `l` and `r` the parts of its weakest cut, `n` the language's words; score is
    floor(2000000 a / (l + r)). A phrase that stands in a longer candidate with four fifths of its count or more is
    left out. NULL languages are `und`; NULL and empty texts hold no words; repeated rows count each; other columns
    are ignored; an empty table gives an empty result.
    """
    phrases, totals = frequent_phrases(docs, least, text_col, lang_col)
    size = F.size("words")
    candidates = phrases.where(size > 1)
    cuts = F.explode(F.sequence(F.lit(1), size - 1))
    halves = candidates.withColumn("k", cuts).select(
        "lang", "words", F.col("f").alias("a"), "k", F.slice("words", F.lit(1), F.col("k")).alias("head"),
        F.slice("words", F.col("k") + 1, F.lit(LONGEST)).alias("tail"))
    heads = phrases.select("lang", F.col("words").alias("head"), F.col("f").alias("l"))
    tails = phrases.select("lang", F.col("words").alias("tail"), F.col("f").alias("r"))
    score = F.expr("(2000000 * CAST(a AS DECIMAL(20, 0))) DIV CAST(l + r AS DECIMAL(20, 0))")
    scored = halves.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn("score", score)
    weakest = scored.groupBy("lang", "words").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.expr("flatten(transform(sequence(2, size(words) - 1), n -> transform(sequence(1, size(words) - n + 1), s -> slice(words, s, n))))")
    longer = candidates.where(size > 2).select("lang", F.explode(inner).alias("words"), "f")
    cover = longer.groupBy("lang", "words").agg(F.max("f").alias("cover"))
    covered = F.expr("coalesce(CAST(cover AS DECIMAL(20, 0)) * 100 >= CAST(a AS DECIMAL(20, 0)) * 80, false)")
    kept = weakest.join(cover, ["lang", "words"], "left").where(~covered)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    flat = kept.select("lang", F.concat_ws(" ", "words").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    ranked = flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
