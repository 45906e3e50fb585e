"""Benchmark decontamination by pigeonhole edit matching.

Texts are lower-cased and white space is folded. Each test item is cut into windows of `window`
code points, half overlapping (a short item is one window), and into windows of two thirds of that, which
begin every third of it: a passage of `window` points holds a whole one wherever it starts, so a passage
of that length is found if it has no more edits than a short window may have (copied word for word: always).
A window of n code points may differ in k = n // RATE edits; cut into k + 1 pieces, at least one piece of a
matching region is unchanged. All pieces of a block of items are found by one automaton; each hit places the window in the document, and
Myers' bit-parallel algorithm gives the smallest edit distance of the window within k of that place.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._memo import kept, release

WINDOW, RATE, LEAST, BLOCK_CHARS = 120, 20, 24, 2_000_000
#: Two characters within a word: neither is of a script that is written without spaces.
INSIDE = re.compile(r"(?:(?![\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff])[^\W_]){2}")
FOUND = "doc_id bigint, item_id bigint, errors int, at bigint"


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def windows(text: str, size: int = WINDOW, least: int = LEAST) -> list[str]:
    """Windows of `size` every half of it and of two thirds of `size` every third of it, so that any `size` points
    of a normal text hold a whole one; the last of either kind is flush with the end. Texts under `least` points have none."""
    if len(text) < max(1, least):
        return []
    short, out = max(1, size * 2 // 3), []
    for n, step in ((size, max(1, size // 2)), (short, max(1, size - short))):
        starts = [*range(0, len(text) - n, step), len(text) - n] if len(text) > n else [0] * (n == size)
        out += [text[s:s + n] for s in starts]
    return out


def pieces(window: str, rate: int = RATE) -> list[tuple[int, str]]:
    """(offset, piece): one more than the window's error budget."""
    k = len(window) // rate + 1
    cuts = [len(window) * i // k for i in range(k + 1)]
    return [(a, window[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(eq: dict[str, int], m: int, text: str, most: int) -> tuple[int, int]:
    """(smallest edit distance of the pattern to any part of text, where that part ends); over `most`: (most + 1, -1)."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, most + 1, -1
    for j, c in enumerate(text):
        e = eq.get(c, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        score += bool(ph & high) - bool(mh & high)
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def bordered(pattern: str, text: str, lo: int, hi: int, most: int) -> tuple[int, int]:
    """(smallest edit distance of the pattern to a part of text[lo:hi] that no word runs out of, where that part starts);
    over `most`: (most + 1, -1)."""
    cuts = [i for i in range(lo, hi + 1) if i in (0, len(text)) or not INSIDE.match(text[i - 1:i + 1])]
    best, start = most + 1, -1
    for a in cuts:
        row, ends = list(range(len(pattern) + 1)), set(cuts)
        for j in range(a, min(hi, a + len(pattern) + most)):
            above, row = row, [j - a + 1]
            for i, c in enumerate(pattern):
                row.append(min(above[i] + (c != text[j]), above[i + 1] + 1, row[i] + 1))
            if j + 1 in ends and row[-1] < best:
                best, start = row[-1], a
    return best, start


class Matcher:
    """An automaton over the pieces of some items' windows."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW, rate: int = RATE, least: int = LEAST) -> None:
        self.rate, self.windows, places = rate, [], {}
        for item, text in items:
            text = normal(text or "")
            for w in windows(text, window, least):
                for offset, piece in pieces(w, rate):
                    places.setdefault(piece, []).append((len(self.windows), offset + len(piece)))
                self.windows.append((item, w, masks(w), len(text) < LEAST))
        self.automaton = ahocorasick.Automaton()
        for piece, at in places.items():
            self.automaton.add_word(piece, at)
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def search(self, text: str) -> dict[int, tuple[int, int]]:
        """item -> (fewest errors, start in the normal text) for every item with a window in the text."""
        text, best, tried = normal(text), {}, set()
        if self.empty:
            return best
        for end, at in self.automaton.iter(text):
            for w, behind in at:
                start = end + 1 - behind
                if (w, start) in tried:
                    continue
                tried.add((w, start))
                item, pattern, eq, short = self.windows[w]
                if item in best and best[item][0] == 0:
                    continue
                k = len(pattern) // self.rate
                lo = max(0, start - k)
                if short:
                    errors, begin = bordered(pattern, text, lo, min(len(text), start + len(pattern) + k), k)
                    if errors <= k:
                        best[item] = min(best.get(item, (k + 1, 0)), (errors, begin))
                    continue
                errors, stop = myers(eq, len(pattern), text[lo:start + len(pattern) + k], k)
                if errors <= k:
                    best[item] = min(best.get(item, (k + 1, 0)), (errors, max(0, lo + stop - len(pattern))))
        return best


def _matcher(shared, window: int, rate: int, least: int) -> Matcher:
    """The worker's automaton for a block of items, kept between tasks until another block comes."""
    name, items = shared.value
    held = kept("matcher")
    if (name, window, rate, least) not in held:
        release()
        held[name, window, rate, least] = Matcher(items, window, rate, least)
    return held[name, window, rate, least]


def _shared(spark, block: DataFrame):
    return spark.sparkContext.broadcast((uuid.uuid4().hex, [(r.item_id, r.text) for r in block.collect()]))


def _search(shared, window: int, rate: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(shared, window, rate, least)
        for batch in batches:
            for at, texts in _text.slices(batch):
                ids, rows = batch.column(0), ([], [], [], [])
                for k, t in enumerate(texts):
                    for item, (errors, start) in sorted(matcher.search(t).items()):
                        for c, v in zip(rows, (at + k, item, errors, start)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int64()),
                                                  pa.array(rows[2], pa.int32()), pa.array(rows[3], pa.int64())], ["doc_id", "item_id", "errors", "at"])
    return run


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> list[DataFrame]:
    """The items in blocks of about `block_chars`, the bound on what is broadcast at once."""
    items = benchmark.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rate: int = RATE, block_chars: int = BLOCK_CHARS,
          least: int = 1) -> DataFrame:
    """doc_id, item_id, errors, at: one row for each document row and test item found in it.

    `at` is the place in the normal text of the window with the fewest errors. Items under LEAST code
    points (whole, in as many edits for their length) have to stand between word borders; items under `least`, empty and
    NULL items and NULL item ids are left out. NULL and empty texts
    match nothing. Repeated rows give repeated results; an empty table or benchmark gives an empty result.
    """
    spark, out = docs.sparkSession, None
    for block in blocks(benchmark, block_chars):
        shared = _shared(spark, block)
        found = _text.rows(docs).mapInArrow(_search(shared, window, rate, least), FOUND)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], FOUND)


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rate: int = RATE, block_chars: int = BLOCK_CHARS,
                   least: int = LEAST) -> DataFrame:
    """The rows of `docs` in which no test item is found, block after block, filtered where they are read. Items under
    `least` code points drop no document: an answer like "yes" stands in most of them; leaks() reports them."""
    spark, names = docs.sparkSession, docs.columns
    for block in blocks(benchmark, block_chars):
        shared = _shared(spark, block)

        def run(batches, shared=shared):
            matcher = _matcher(shared, window, rate, least)
            for batch in batches:
                texts = batch.column(names.index("text"))
                yield batch.filter(pa.array([not matcher.search(t.as_py() or "") for t in texts], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
