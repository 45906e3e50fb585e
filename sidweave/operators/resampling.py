"""Majorities of hashed draws with replacement, by whole-array steps over trials."""

from __future__ import annotations

from itertools import batched, groupby

import numpy as np
import pyarrow as pa

from ..functions.digests import numbered_hashes, numbered_tails

PRIME, FACTOR = 2_147_483_647, 40_503
PRIME32 = np.array(PRIME, np.uint32)  # without an axis: taken faster than a scalar
FEW, BEGUN, STEP_CELLS, TABLE_CELLS = 64, 128, 1 << 16, 16
RUN_VOTES, RUN_HASHES, RUN_TRIALS = 10_000, 2_000, 16_000


def draw_sizes(n: int) -> list[int]:
    """2, 4, 8, ... below n, then n itself."""
    return [2 ** i for i in range(1, 62) if 2 ** i < n] + [n] * (n > 1)


def _less(x: np.ndarray, spare: np.ndarray) -> None:
    """x modulo the prime in place, for x under twice the prime: a difference below zero wraps round and is the larger one."""
    np.subtract(x, PRIME32, spare)
    np.minimum(x, spare, x)


def _doublings(k: int, s: int = 1) -> list[np.ndarray]:
    """40503(2js + s^2) modulo the prime for j = 1..s, for each s = s, 2s, 4s, ... below k."""
    out = []
    while s < k:
        j = np.arange(1, min(s, k - s) + 1, dtype=np.int64)
        out.append(((2 * j * s + s * s) % PRIME * FACTOR % PRIME).astype(np.uint32))
        s *= 2
    return out


class Room:
    """Arrays that are written again and again: fresh ones of this size cost as much as the steps that fill them."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple[int, int], kind) -> np.ndarray:
        cells = shape[0] * shape[1]
        if name not in self.held or len(self.held[name]) < cells:
            self.held[name] = np.empty(cells, kind)
        return self.held[name][:cells].reshape(shape)


def _first_draws(hashes: np.ndarray, k: int, room: Room) -> np.ndarray:
    """h(2j+1) + 40503 j^2 modulo the prime, a row for each j = 1..k and a column for each hash."""
    h, s = hashes.astype(np.int64), 1
    draws, spare = (room(name, (k, len(h)), np.uint32) for name in ("first", "spare"))
    draws[0] = (3 * h + FACTOR) % PRIME
    shift = (2 * h % PRIME).astype(np.uint32)
    for added in _doublings(k):
        m = len(added)
        np.add(shift, added[:, None], out=draws[s:s + m])
        _follow(draws[s:s + m], draws[:m], spare[:m])
        s, shift = 2 * s, _twice(shift)
    return draws


def _more_draws(draws: np.ndarray, s: int, shift: np.ndarray, doublings: list[np.ndarray], spare: np.ndarray) -> None:
    """The same with a row for each hash: fills draws from its first s columns; `shift` is 2hs."""
    for added in doublings:
        m = len(added)
        np.add(shift[:, None], added, out=draws[:, s:s + m])
        _follow(draws[:, s:s + m], draws[:, :m], spare[:, :m])
        s, shift = 2 * s, _twice(shift)


def _follow(new: np.ndarray, before: np.ndarray, spare: np.ndarray) -> None:
    """Draws j+s are draws j plus 2hs + 40503(2js + s^2), which `new` holds."""
    _less(new, spare)
    new += before
    _less(new, spare)


def _twice(shift: np.ndarray) -> np.ndarray:
    shift = shift + shift
    _less(shift, np.empty_like(shift))
    return shift


def _places(draws: np.ndarray, sizes: np.ndarray, room: Room) -> np.ndarray:
    """draws modulo `sizes`, one for each of as many equal runs of columns; a division by one number is much faster than the remainder."""
    turns, at, wide = room("spare", draws.shape, np.uint32), room("at", draws.shape, np.intp), draws.shape[1] // len(sizes)
    edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(sizes)]
    for begin, end in zip(edges, edges[1:]):
        some = slice(begin * wide, end * wide)
        np.floor_divide(draws[:, some], sizes[begin], out=turns[:, some])
    turns *= sizes[0] if len(edges) == 2 else np.repeat(sizes, wide)
    np.subtract(draws, turns, out=turns)
    at[...] = turns
    return at


def majorities_of_few(preds: np.ndarray, begins: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, k: int, room: Room) -> np.ndarray:
    """`majorities` of several groups at once, for k <= FEW: runs of preds, with a row of hashes each; places are those in preds.

    Draws are counted by comparing each with the others.
    """
    at = _places(_first_draws(hashes.ravel(), k, room), sizes.astype(np.uint32), room)
    at += np.repeat(begins, hashes.shape[1])
    shape, kind = at.shape, preds.dtype
    drawn = np.take(preds, at, out=room(f"drawn {kind}", shape, kind), mode="clip")
    count, equal = room("count", shape, np.uint8), room("equal", shape, np.bool_)
    count[...] = 0
    for d in range(1, k):
        same = np.equal(drawn[d:], drawn[:-d], out=equal[d:]).view(np.uint8)
        count[d:] += same
        count[:-d] += same
    rank = np.multiply(count, np.uint16(2 * FEW), out=room("rank", shape, np.uint16), dtype=np.uint16)
    rank += np.arange(2 * FEW - 1, 2 * FEW - 1 - k, -1, dtype=np.uint16)[:, None]
    first = (2 * FEW - 1 - rank.max(axis=0) % (2 * FEW)).astype(np.intp)
    return at[first, np.arange(len(first))].reshape(hashes.shape)


def majorities(preds: np.ndarray, hashes: np.ndarray, k: int, room: Room) -> np.ndarray:
    """The vote (its place) that gives each trial's majority its value: the first one drawn for the most frequent prediction.

    That is the first draw of a prediction drawn as often as any. preds are numbers from 0 on.
    """
    size, out = np.array([len(preds)], np.uint32), np.empty(len(hashes), np.intp)
    kinds = int(preds.max()) + 1
    table = kinds if kinds <= TABLE_CELLS * k else 0  # a table of counts for each trial, unless most of it were empty
    turn, begun = min(len(hashes), max(1, STEP_CELLS // max(k, table))), min(k, BEGUN)
    first, shift, doublings = _first_draws(hashes, begun, room), (hashes.astype(np.int64) * (2 * begun) % PRIME).astype(np.uint32), _doublings(k, begun)
    for begin in range(0, len(hashes), turn):
        rows = min(turn, len(hashes) - begin)
        draws = room("draws", (rows, k), np.uint32)
        draws[:, :begun] = first[:, begin:begin + rows].T
        _more_draws(draws, begun, shift[begin:begin + rows], doublings, room("spare", (rows, k), np.uint32))
        at, drawn = _places(draws, size, room), room("drawn", (rows, k), np.intp)
        if preds.dtype == np.intp:
            np.take(preds, at, out=drawn, mode="clip")
        else:
            drawn[...] = preds.take(at)
        place = _first_of_table(drawn, table, room) if table else _first_of_sorted(drawn)
        out[begin:begin + rows] = at[np.arange(rows), place]
    return out


def _first_of_table(drawn: np.ndarray, kinds: int, room: Room) -> np.ndarray:
    """Place in each row of the first number that no other one exceeds in frequency. Changes `drawn`."""
    rows = len(drawn)
    drawn += (np.arange(rows) * kinds)[:, None]
    count = np.bincount(drawn.ravel(), minlength=rows * kinds).reshape(rows, kinds)
    most = count == count.max(axis=1)[:, None]
    return np.take(most.ravel(), drawn, out=room("equal", drawn.shape, np.bool_), mode="clip").argmax(axis=1)


def _first_of_sorted(drawn: np.ndarray) -> np.ndarray:
    """The same by runs of equal numbers, sorted with their places. Changes `drawn`."""
    rows, k = drawn.shape
    bits = k.bit_length()
    drawn <<= bits
    drawn |= np.arange(k)
    drawn.sort(axis=1)
    new = np.ones(drawn.shape, bool)
    np.not_equal(drawn[:, 1:] >> bits, drawn[:, :-1] >> bits, out=new[:, 1:])
    starts = np.flatnonzero(new)
    rank = (np.diff(starts, append=rows * k) << bits) + (k - (drawn.ravel()[starts] & ((1 << bits) - 1)))
    best = np.maximum.reduceat(rank, np.flatnonzero(starts % k == 0))
    return k - (best & ((1 << bits) - 1))


def _moments(values: np.ndarray, known: np.ndarray) -> list[np.ndarray]:
    """Number, mean and std of the known values of each row; the others are 0."""
    count = known.sum(axis=1)
    mean = values.sum(axis=1) / np.maximum(count, 1)
    off = (values - mean[:, None]) * known
    return [count, mean, np.sqrt((off * off).sum(axis=1) / np.maximum(count, 1))]


def _compact(preds: np.ndarray) -> np.ndarray:
    """Numbers of one group's predictions from 0 on, in the fewest bytes if they are many."""
    kinds, preds = np.unique(preds, return_inverse=True)
    return preds.astype(np.intp if len(preds) <= STEP_CELLS else np.min_scalar_type(len(kinds)), copy=False)


def _runs(rows: list[tuple], alike: slice, limit: int):
    """Runs of at most `limit` rows that begin alike."""
    for _, same in groupby(rows, lambda r: r[alike]):
        yield from batched(same, limit)


def _run_of_groups(keys: list[str], heads: pa.Table, starts: list[int], preds: list[pa.Array], values: list[pa.Array], trials: int, room: Room) -> pa.Table:
    """The moments of whole groups whose votes lie one behind the other."""
    pred = pa.chunked_array(preds).combine_chunks()
    kinds = len(pred.dictionary) + 1  # NULL is one
    codes = pred.indices.fill_null(kinds - 1).to_numpy().astype(np.min_scalar_type(kinds))
    value = pa.concat_arrays(values)
    known, value = value.is_valid().to_numpy(zero_copy_only=False), value.fill_null(0.0).to_numpy()
    begin = np.array(starts)
    size = np.diff(begin, append=len(codes))
    texts, part, parts = (heads[c].to_pylist() for c in ("_key", "_part", "_parts"))
    digits, lengths = numbered_tails(trials)
    draws = sorted((part[g], parts[g], k, n, g) for g, n in enumerate(size.tolist()) if part[g] < trials for k in draw_sizes(n))
    compact, found = {}, []
    for run in _runs(draws, slice(2), RUN_HASHES):
        p, of = run[0][:2]
        hashes = numbered_hashes([f"{texts[g]}|{k}|".encode() for _, _, k, _, g in run], (digits[p::of], lengths[p::of]))
        for some in _runs(run, slice(3), max(1, RUN_TRIALS // hashes.shape[1])):
            own, hashes = np.split(hashes, [len(some)])
            k, groups = some[0][2], [x[4] for x in some]
            if k <= FEW:
                won = majorities_of_few(codes, begin[groups], size[groups], own, k, room)
            else:
                for g in groups:
                    if g not in compact:
                        compact[g] = _compact(codes[begin[g]:begin[g] + size[g]])
                won = np.stack([begin[g] + majorities(compact[g], h, k, room) for g, h in zip(groups, own)])
            found.append(_moments(value[won], known[won]))
    count, mean, std = (np.concatenate(x) if x else np.zeros(0) for x in zip(*found)) if found else [np.zeros(0)] * 3
    nothing = count == 0
    out = heads.select(keys).take(pa.array([x[4] for x in draws], pa.int64()))
    for name, column in (("k", pa.array([x[2] for x in draws], pa.int64())), ("_count", pa.array(count.astype(np.int64))),
                         ("maj_mean", pa.array(mean, pa.float64(), mask=nothing)), ("maj_std", pa.array(std, pa.float64(), mask=nothing))):
        out = out.append_column(name, column)
    return out


def resampled(keys: list[str], trials: int):
    """Batches of votes sorted by group (keys, _at from 1 on, _key, _part, _parts, _p, _v) -> keys, k, _count, maj_mean, maj_std.

    A group's trials are those numbered _part, _part + _parts, ... Groups are resampled together, about RUN_VOTES votes at a
    time; of a group's votes a task holds the number of the prediction and the value.
    """
    def run(batches):
        heads, starts, preds, values, held, room = [], [], [], [], 0, Room()

        def add(batch, new):
            nonlocal held
            heads.append(batch.select([*keys, "_key", "_part", "_parts"]).take(pa.array(new, pa.int64())))
            starts.extend((new + held).tolist())
            preds.append(batch.column("_p").dictionary_encode())
            values.append(batch.column("_v"))
            held += len(batch)

        def done():
            nonlocal heads, starts, preds, values, held
            out = _run_of_groups(keys, pa.Table.from_batches(heads), starts, preds, values, trials, room)
            heads, starts, preds, values, held = [], [], [], [], 0
            return out.to_batches()

        for batch in batches:
            new = np.flatnonzero(batch.column("_at").to_numpy() == 1)
            if held >= RUN_VOTES and len(new):
                if new[0]:
                    add(batch.slice(0, new[0]), new[:0])
                yield from done()
                batch, new = batch.slice(new[0]), new - new[0]
            add(batch, new)
        if held:
            yield from done()
    return run
