"""Match article company names to the company dimension and attach its fields.

Names are resolved once per distinct value, by joins: exact, then ignoring case,
then by the best similarity ratio among the keys that share enough letters to
reach it: parts of names and keys are joined by the runs of letters that two
texts so alike must have in common.  Spark sizes the joins.  The map from names to fields goes
to the articles by broadcast up to ``BROADCAST_BYTES`` (measured); beyond that
the names that are measured to be hot do, and the others are joined by shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.schema import COMPANY_FIELDS
from broadsheet.session import materialise, settled

CUTOFF = 0.75
BROADCAST_BYTES = 64 << 20
# Names of a part, of keys twice as many; texts of which all pairs are compared
# together; so many pairs of a part are compared without picks.
PART, BLOCK, FEW_PAIRS = 1 << 17, 8192, 1 << 24
# Buckets and repeats of the letters that are counted, and bits for the letter
# pairs of a text.
LETTERS, REPEATS, PAIR_BITS = 32, 4, 1024
# Nanoseconds for a pair when all are compared, for a pick and for a hit of one.
PAIR_COST, PICK_COST, HIT_COST = 38.0, 80.0, 40.0
# Most picks of a text, picks held of names and of keys, hits looked at
# together, and low bits of a pick that number its row.
PICKS, NAME_PICKS, KEY_PICKS, HITS, ROW_BITS = 1 << 15, 1 << 20, 10 << 20, 1 << 19, 20
# A name is hot when it has more than this share of all rows: so there are at
# most as many hot names as the share goes into one, whatever the data.
HOT_SHARE = 1 / 1000


def _ratio(key: str, name: str, cutoff: float) -> float | None:
    """Similarity ratio, key first; None when it cannot reach ``cutoff``."""
    matcher = SequenceMatcher(None, key, name)
    for bound in (matcher.real_quick_ratio, matcher.quick_ratio):
        if bound() < cutoff:
            return None
    ratio = matcher.ratio()
    return ratio if ratio >= cutoff else None


def _check_cutoff(cutoff: float) -> None:
    if not 0.0 <= cutoff <= 1.0:
        raise ValueError(f"cutoff must lie in [0, 1]: {cutoff}")


def _needed(length: int, cutoff: float) -> int:
    """Least number of common letter pairs of two texts of that total length.

    A ratio of at least ``cutoff`` means ``m`` matching letters with
    ``2 m / length >= cutoff``, in at most ``length - 2 m + 1`` runs.  A run of
    ``r`` letters has ``r - 1`` pairs.
    """
    m = math.ceil(cutoff * length / 2 - 1e-9)
    return 3 * m - length - 1


def _tokens(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Number each code within its text: the second "a" of a text has 1."""
    order = np.lexsort((codes, owner))
    c, o = codes[order], owner[order]
    first = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (o[1:] != o[:-1])]) if len(c) else np.zeros(0, np.int64)
    number = np.empty(len(c), np.int64)
    number[order] = np.arange(len(c)) - np.repeat(first, np.diff(np.r_[first, len(c)]))
    return number


def _profile(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, letter table, letters it leaves out, letter-pair bits and pairs they hide, of each text."""
    size = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), size)
    # Letters by bucket and occurrence; letters that share a bucket only add candidates.
    bucket = codes % LETTERS
    number = _tokens(bucket, owner)
    kept = number < REPEATS
    table = np.zeros((len(texts), LETTERS * REPEATS), np.float32)
    table[owner[kept], bucket[kept] * REPEATS + number[kept]] = 1
    beyond = np.bincount(owner[~kept], minlength=len(texts))
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    pair, of = codes[inner] * 0x110000 + codes[inner + 1], owner[inner]
    mixed = (pair * 64 + _tokens(pair, of)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    place = (mixed >> np.uint64(40)) % np.uint64(PAIR_BITS)
    bits = np.zeros((len(texts), PAIR_BITS), bool)
    bits[of, place] = True
    hidden = np.bincount(of, minlength=len(texts)) - bits.sum(axis=1)
    return size, table, beyond, np.packbits(bits, axis=1).view(np.uint64), hidden


# Numbers of names and keys that may be alike.
_Pairs = Iterator[tuple[np.ndarray, np.ndarray]]


def _all_pairs(left: list[str], right: list[str], cutoff: float) -> _Pairs:
    """The pairs that may reach ``cutoff``, found by comparing all."""
    for first in range(0, len(left), BLOCK):
        n, a, more, a_bits, a_hidden = _profile(left[first : first + BLOCK])
        a = np.column_stack([a, more - cutoff / 2 * n, np.ones(len(n))]).astype(np.float32)
        for second in range(0, len(right), BLOCK):
            k, b, _, b_bits, _ = _profile(right[second : second + BLOCK])
            # A ratio of m common letters is 2 m over both lengths.
            b = np.column_stack([b, np.ones(len(k)), -cutoff / 2 * k]).astype(np.float32)
            room = np.empty(256 * 2048, np.float32)
            for top in range(0, len(n), 256):
                for begin in range(0, len(k), 2048):
                    some, others = a[top : top + 256], b[begin : begin + 2048].T
                    scores = np.matmul(some, others, out=room[: len(some) * others.shape[1]].reshape(len(some), -1))
                    at = np.flatnonzero(scores >= -1e-2 - 1e-5 * n.max())
                    x, y = top + at // scores.shape[1], begin + at % scores.shape[1]
                    both = n[x] + k[y]
                    fit = 2 * np.minimum(n[x], k[y]) >= cutoff * both - 1e-9
                    x, y, both = x[fit], y[fit], both[fit]
                    needed = 3 * np.ceil(cutoff * both / 2 - 1e-9) - both - 1
                    for part in range(0, len(x), 1 << 16):
                        p, q = x[part : part + (1 << 16)], y[part : part + (1 << 16)]
                        shared = np.bitwise_count(a_bits[p] & b_bits[q]).sum(axis=1, dtype=np.int64) + a_hidden[p]
                        good = shared >= needed[part : part + (1 << 16)]
                        yield first + p[good], second + q[good]


# Columns of a name and of a key from which as many letters are picked.
_Piece = tuple[slice, slice, int]


def _pieces(n: int, k: int, common: int, names: int, keys: int, alike: float) -> list[_Piece] | None:
    """The cheapest pieces by which texts of ``n`` and ``k`` letters with ``common`` ones in order must meet; None for all pairs.

    Either all common letters are picked; or one text is cut in two, and of the
    letters it has beyond the common ones the first part has at most ``a`` or the
    second part at most the others less one.  The first common letters of the
    first part then stand at the start of the other text, the last ones of the
    second part at its end, with no more letters between than it has to spare.
    ``alike`` is the chance that two letters are equal.
    """
    best, least = None, PAIR_COST * names * keys

    def consider(pieces: list[_Piece]) -> None:
        nonlocal best, least
        cost = 0.0
        for x, y, size in pieces:
            a, b = math.comb(x.stop - x.start, size), math.comb(y.stop - y.start, size)
            if size < 1 or a > PICKS or b > PICKS:
                return
            cost += PICK_COST * (names * a + keys * b) + HIT_COST * names * keys * a * b * alike**size
        if cost < least:
            best, least = pieces, cost

    # Little to win, or too long for the masks that count letters in order.
    if least < 1e7 or max(n, k) > 64:
        return None
    consider([(slice(0, n), slice(0, k), common)])
    for cut, whole, key_is_cut in ((k, n, True), (n, k, False)):
        spare, free = cut - common, whole - common
        for a in range(spare):
            for at in range(a + 1, cut - (spare - 1 - a)):
                sizes = at - a, cut - at - (spare - 1 - a)
                ends = [min(whole, size + free) for size in sizes]
                mine = slice(0, at), slice(at, cut)
                other = slice(0, ends[0]), slice(whole - ends[1], whole)
                consider([(o, m, size) if key_is_cut else (m, o, size) for m, o, size in zip(mine, other, sizes)])
    return best


def _sums(weighed: list[list[np.ndarray]], at: int, first: int, so_far: np.ndarray | None) -> Iterator[np.ndarray]:
    """The sum of each choice of one column for every weight, in order, from the weight ``at`` and the column ``first`` on."""
    for c in range(first, len(weighed[at]) - len(weighed) + at + 1):
        part = weighed[at][c] if so_far is None else so_far + weighed[at][c]
        if at + 1 == len(weighed):
            yield part
        else:
            yield from _sums(weighed, at + 1, c + 1, part)


def _picks(letters: np.ndarray, size: int) -> np.ndarray:
    """Every choice of ``size`` letters of each row, in order: a hash above the number of the row."""
    width = letters.shape[1]
    weights = np.random.default_rng(size).integers(1, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((math.comb(width, size), len(letters)), np.uint64)
    low = np.uint64((1 << ROW_BITS) - 1)
    step = 1 << 13
    for top in range(0, len(letters), step):
        columns = np.ascontiguousarray(letters[top : top + step].T).astype(np.uint64) + np.uint64(1)
        weighed = [[column * w for column in columns] for w in weights]
        row = np.arange(top, top + columns.shape[1], dtype=np.uint64)
        for number, hashed in enumerate(_sums(weighed, 0, 0, None)):
            out[number, top : top + len(row)] = (hashed & ~low) | row
    return out.reshape(-1)


def _each_once(picks: np.ndarray) -> np.ndarray:
    """Sorted, without repeats."""
    picks.sort()
    again = np.flatnonzero(picks[1:] == picks[:-1])
    return np.delete(picks, again) if len(again) else picks


class _KeyPicks:
    """The picks of some keys, to be looked up."""

    def __init__(self, letters: np.ndarray, size: int):
        picks = _each_once(_picks(letters, size))
        self.row = (picks & np.uint64((1 << ROW_BITS) - 1)).astype(np.int32)
        # Most picks of names are no picks of keys, which a few bits of them tell.
        self.shift = np.uint64(64 - min(24, max(10, 2 + len(picks).bit_length())))
        picks >>= np.uint64(ROW_BITS)
        start = np.flatnonzero(np.r_[True, picks[1:] != picks[:-1]])
        self.hashed = picks[start]
        self.start = np.r_[start, len(picks)].astype(np.int32)
        self.some = np.zeros(1 << (64 - int(self.shift)), bool)
        self.some[self.hashed >> (self.shift - np.uint64(ROW_BITS))] = True

    def hits(self, letters: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of names, and first place and number of the equal picks of keys."""
        picks = _picks(letters, size)
        picks = _each_once(picks[self.some[picks >> self.shift]])
        hashed = picks >> np.uint64(ROW_BITS)
        at = np.minimum(np.searchsorted(self.hashed, hashed), len(self.hashed) - 1)
        equal = self.hashed[at] == hashed
        start = self.start[at[equal]].astype(np.int64)
        return (picks[equal] & np.uint64((1 << ROW_BITS) - 1)).astype(np.int64), start, self.start[at[equal] + 1] - start


def _letter_bits(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each row by bucket and occurrence as bits, and how many they leave out."""
    bucket = (letters % LETTERS).astype(np.uint8)
    bits, beyond = np.zeros((len(letters), LETTERS * REPEATS // 64), np.uint64), np.zeros(len(letters), np.int64)
    every = np.arange(len(letters))
    for c in range(letters.shape[1]):
        seen = (bucket[:, :c] == bucket[:, c : c + 1]).sum(axis=1)
        place = bucket[:, c].astype(np.int64) * REPEATS + np.minimum(seen, REPEATS - 1)
        bits[every, place // 64] |= np.where(seen < REPEATS, np.uint64(1) << (place % 64).astype(np.uint64), np.uint64(0))
        beyond += seen >= REPEATS
    return bits, beyond


def _in_order(names: np.ndarray, i: np.ndarray, keys: np.ndarray, j: np.ndarray) -> np.ndarray:
    """At least the number of letters that pairs of rows have in common in one order; names of up to 64 letters."""
    places = np.zeros((len(names), 64), np.uint64)
    every = np.arange(len(names))
    for c in range(names.shape[1]):
        places[every, names[:, c] % 64] |= np.uint64(1 << c)
    # A bit of a name falls with each further letter in common.
    left = np.full(len(i), (1 << 64) - 1, np.uint64)
    for c in range(keys.shape[1]):
        same = left & places[i, keys[j, c] % 64]
        left = (left + same) | (left - same)
    return names.shape[1] - np.bitwise_count(left & np.uint64((1 << names.shape[1]) - 1)).astype(np.int64)


def _by_picks(names: np.ndarray, keys: np.ndarray, pieces: list[_Piece], common: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Rows of names and keys (as letters) with at least ``common`` letters in one order.

    Yields both, and whether they are only to be compared: of rows that meet too often, all are.
    """
    most = [max(math.comb(p[side].stop - p[side].start, p[2]) for p in pieces) for side in (0, 1)]
    name_step, key_step = max(1, NAME_PICKS // most[0]), max(1, min(1 << ROW_BITS, KEY_PICKS // most[1]))
    for second in range(0, len(keys), key_step):
        some_keys = keys[second : second + key_step]
        known = [_KeyPicks(some_keys[:, y], size) for _, y, size in pieces]
        key_bits, _ = _letter_bits(some_keys)
        for first in range(0, len(names), name_step):
            some = names[first : first + name_step]
            found = [of.hits(some[:, x], size) for of, (x, _, size) in zip(known, pieces)]
            total = sum(int(count.sum()) for *_, count in found)
            if HIT_COST * total > PAIR_COST * len(some) * len(some_keys):
                yield first + np.arange(len(some)), second + np.arange(len(some_keys)), True
                continue
            bits, beyond = _letter_bits(some)
            pairs, held = [np.zeros(0, np.int64)], 0
            for of, (row, start, count) in zip(known, found):
                # Some picks of names at a time, with about as many hits as are looked at together.
                for part in np.split(np.arange(len(row)), np.flatnonzero(np.diff(np.cumsum(count) // HITS)) + 1):
                    n = count[part]
                    i = np.repeat(row[part], n)
                    j = of.row[np.repeat(start[part] - (np.cumsum(n) - n), n) + np.arange(len(i))].astype(np.int64)
                    good = np.bitwise_count(bits[i] & key_bits[j]).sum(axis=1, dtype=np.int64) + beyond[i] >= common
                    pairs.append(np.unique(i[good] * len(some_keys) + j[good]))
                    held += len(pairs[-1])
                    if held > NAME_PICKS:
                        break
            if held > NAME_PICKS:
                yield first + np.arange(len(some)), second + np.arange(len(some_keys)), True
                continue
            both = np.unique(np.concatenate(pairs))
            i, j = both // len(some_keys), both % len(some_keys)
            good = _in_order(some, i, some_keys, j) >= common
            yield first + i[good], second + j[good], False


def _letters(texts: list[str], number: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and numbered letters of the texts of each length."""
    size = np.array([len(t) for t in texts], np.int64)
    codes = number[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")]
    start = np.cumsum(size) - size
    out = {}
    for n in np.unique(size).tolist():
        rows = np.flatnonzero(size == n)
        out[n] = rows, codes[start[rows][:, None] + np.arange(n)]
    return out


def _by_length(left: list[str], right: list[str], cutoff: float) -> _Pairs:
    """Like :func:`_all_pairs`, but names and keys of two lengths meet by picks where that is cheaper."""
    of_keys = np.unique(np.frombuffer("".join(right).encode("utf-32-le", "surrogatepass"), "<u4"))
    # Letters that no key has get one number.
    number = np.full(0x110000, len(of_keys), np.int32)
    number[of_keys] = np.arange(len(of_keys), dtype=np.int32)
    names, keys = _letters(left, number), _letters(right, number)
    shares = []
    for side in (names, keys):
        counts = sum(np.bincount(letters.ravel(), minlength=len(of_keys) + 1) for _, letters in side.values())
        shares.append(counts[:-1] / max(1, counts.sum()))
    alike = float(shares[0] @ shares[1])

    def in_full(some: np.ndarray, others: np.ndarray) -> _Pairs:
        for x, y in _all_pairs([left[r] for r in some], [right[r] for r in others], cutoff):
            yield some[x], others[y]

    for n, (some, letters) in names.items():
        strange = (letters == len(of_keys)).sum(axis=1)
        rest = []
        for k, (others, key_letters) in keys.items():
            common = math.ceil(cutoff * (n + k) / 2 - 1e-9)
            if 2 * min(n, k) < cutoff * (n + k) - 1e-9:
                continue
            able = np.flatnonzero(strange <= n - common)
            pieces = _pieces(n, k, common, len(able), len(others), alike) if len(able) else []
            if pieces is None:
                rest.append(others)
            elif pieces:
                for x, y, open_ in _by_picks(letters[able], key_letters, pieces, common):
                    x, y = some[able[x]], others[y]
                    yield from in_full(x, y) if open_ else [(x, y)]
        if rest:
            yield from in_full(some, np.concatenate(rest))


def _together(names: pa.Table, keys: pa.Table) -> pa.Table:
    """Some names and some keys as one row."""
    columns = [names.column("name").combine_chunks(), keys.column("company_key").combine_chunks()]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
    return pa.table(dict(zip(("names", "keys"), lists)))


def _alike(cutoff: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function of rows of some names and some keys: the pairs that may reach ``cutoff``, some at a time."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                names, keys = (batch.column(c)[at].values for c in ("names", "keys"))

                def drawn(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
                    i, j = (np.concatenate(x) for x in zip(*held))
                    return pa.RecordBatch.from_arrays([names.take(pa.array(i)), keys.take(pa.array(j))], names=["name", "company_key"])

                if not len(names) or not len(keys):
                    continue
                left, right = names.to_pylist(), keys.to_pylist()
                method = _all_pairs if len(left) * len(right) <= FEW_PAIRS else _by_length
                held = []
                for pair in method(left, right, cutoff):
                    held.append(pair)
                    if sum(len(i) for i, _ in held) >= 1 << 16:
                        yield drawn(held)
                        held = []
                if held:
                    yield drawn(held)

    return alike


def candidates(names: DataFrame, dimension: DataFrame, cutoff: float) -> DataFrame:
    """``(name, company_key)`` pairs whose ratio may reach ``cutoff``; misses none.

    Bounded parts of the names meet bounded parts of the keys.  Few pairs are all
    compared: a matrix product counts the letters two texts have in common, and of
    the pairs with enough, those stay that share enough letter pairs
    (``_needed``).  In larger parts, names and keys of two lengths are joined by
    letters picked from them in order, some of which texts so alike must share
    (``_pieces``); lengths for which that costs more are compared in full.
    """
    who = names.select("name").where("name <> ''").distinct()
    dim = dimension.select("company_key").where("company_key <> ''").distinct()
    cores = names.sparkSession.sparkContext.defaultParallelism
    rows, others = who.count(), dim.count()
    # Some groups for each core, of as many parts of names as of keys where there are enough.
    n = max(1, math.ceil(rows / PART), min(math.ceil(math.sqrt(4 * cores)), rows // 512))
    k = max(1, math.ceil(others / (2 * PART)), min(math.ceil(4 * cores / n), others // 512))
    n = max(n, min(math.ceil(4 * cores / k), rows // 512))

    def part(text: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(text), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    left = who.withColumn("a", part("name", n)).withColumn("b", every(k))
    right = dim.withColumn("b", part("company_key", k)).withColumn("a", every(n))
    tasks = max(1, min(n * k, 16 * cores))
    left, right = (df.repartition(tasks, "a", "b") for df in (left, right))
    met = left.groupBy("a", "b").cogroup(right.groupBy("a", "b"))
    # As rows, so that pairs leave a task as they are found.
    together = met.applyInArrow(_together, "names array<string>, keys array<string>")
    return together.mapInArrow(_alike(cutoff), "name string, company_key string")


def best_similar(names: DataFrame, dimension: DataFrame, cutoff: float) -> DataFrame:
    """The most similar key per name, if it reaches ``cutoff``."""

    @F.pandas_udf("double")
    def ratio(key: pd.Series, name: pd.Series) -> pd.Series:
        return pd.Series([_ratio(k, n, cutoff) for k, n in zip(key, name)], dtype="float64")

    # Settled, so that the filter cannot sink below the distinct pairs and have
    # repeated pairs scored again.
    pairs = candidates(names, dimension, cutoff)
    scored = settled(pairs.withColumn("ratio", ratio("company_key", "name"))).where(F.col("ratio").isNotNull())
    best = scored.groupBy("name").agg(F.max_by("company_key", F.struct("ratio", "company_key")).alias("similar_key"))
    if cutoff > 0:
        return best
    # With no cutoff a name that shares no character still takes the largest key.
    last = dimension.agg(F.max("company_key").alias("last_key"))
    return (
        names.select("name")
        .join(best, "name", "left")
        .join(F.broadcast(last))
        .select("name", F.coalesce("similar_key", "last_key").alias("similar_key"))
    )


def resolve_names(names: DataFrame, dimension: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Key and kind of match for each distinct ``name`` and its ``rows``; nulls when unmatched.

    An empty company key is never matched.  Of keys that differ in case only the
    last one counts.
    """
    _check_cutoff(cutoff)
    dim = dimension.where(F.coalesce(F.col("company_key") != "", F.lit(False)))
    distinct = names.where(F.col("name").isNotNull()).groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
    keys = dim.select(F.col("company_key").alias("exact_key"))
    folded = dim.groupBy(F.lower("company_key").alias("folded")).agg(F.max_by("company_key", "pos").alias("folded_key"))
    known = materialise(
        distinct.join(keys, F.col("name") == F.col("exact_key"), "left")
        .join(folded, F.lower("name") == F.col("folded"), "left")
        .select("name", "rows", "exact_key", "folded_key")
    )
    similar = best_similar(known.where("exact_key IS NULL AND folded_key IS NULL").select("name"), dim, cutoff)
    kind = (
        F.when(F.col("exact_key").isNotNull(), "exact")
        .when(F.col("folded_key").isNotNull(), "ignoring case")
        .when(F.col("similar_key").isNotNull(), "similar")
    )
    return known.join(similar, "name", "left").select(
        "name", "rows", F.coalesce("exact_key", "folded_key", "similar_key").alias("company_key"), kind.alias("match_kind")
    )


def _left_join_hot(left: DataFrame, right: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Left join of ``right`` (unique keys), its rows ``hot`` by broadcast and the others by shuffle.

    Rows that the broadcast served go through the shuffle under a salt of their
    own, which no row of ``right`` has, so they spread evenly.
    """
    fields = [c for c in right.columns if c != key]
    served = left.join(F.broadcast(hot.select(key, *[F.col(c).alias(f"_hot_{c}") for c in fields])), key, "left")
    salt = F.when(F.col("_hot__hit").isNotNull(), F.xxhash64(*left.columns).bitwiseOR(F.lit(1))).otherwise(F.lit(0))
    # Zero for every row, but not a constant: that would drop the salt from the join key.
    none = F.pmod(F.xxhash64(key), F.lit(1))
    joined = served.withColumn("_salt", salt).join(right.withColumn("_salt", none), [key, "_salt"], "left")
    return joined.select(*[F.col(c) for c in left.columns], *[F.coalesce(f"_hot_{c}", c).alias(c) for c in fields])


def attach_companies(
    articles: DataFrame,
    dimension: DataFrame,
    cutoff: float = CUTOFF,
    names: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join of the six company fields and ``metadata_matched``.

    ``names`` may supply the company names (column ``name``) from a cheaper
    source than ``articles``, such as the unprocessed input; extra names do no
    harm.
    """
    if names is None:
        names = articles.select(F.col("company_name").alias("name"))
    fields = dimension.select("company_key", *[F.col(n).alias(f"meta_{n}") for n in COMPANY_FIELDS])
    matched = resolve_names(names, dimension, cutoff).where("company_key IS NOT NULL")
    stored = materialise(matched.join(fields, "company_key").drop("company_key", "match_kind").withColumnRenamed("name", "company_name"))
    texts = [f.name for f in stored.schema.fields if f.dataType.simpleString() == "string"]
    size = F.sum(64 + sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0)))
    total = stored.agg(size.alias("bytes"), F.sum("rows").alias("rows")).first()
    name_map = stored.drop("rows").withColumn("_hit", F.lit(True))
    if (total["bytes"] or 0) <= broadcast_bytes:
        joined = articles.join(F.broadcast(name_map), "company_name", "left")
    else:
        hot = stored.where(F.col("rows") > HOT_SHARE * total["rows"]).drop("rows").withColumn("_hit", F.lit(True))
        joined = _left_join_hot(articles, name_map, "company_name", hot)
    return joined.select(
        *[F.col(c) for c in articles.columns],
        F.coalesce("_hit", F.lit(False)).alias("metadata_matched"),
        *[F.col(f"meta_{n}") for n in COMPANY_FIELDS],
    )


def company_age(pub_year: Column, founded: Column) -> Column:
    """Years since founding; null when either is unknown or the result is negative."""
    years = pub_year.try_cast("int") - founded.try_cast("int")
    return F.when(years >= 0, years)


def size_category(employees: Column) -> Column:
    """Size class of a head count."""
    return (
        F.when(employees.isNull(), "Unknown")
        .when(employees < 10_000, "Small")
        .when(employees <= 30_000, "Medium")
        .otherwise("Large")
    )


def with_derived_fields(df: DataFrame) -> DataFrame:
    """Add ``company_age`` and ``company_size_category``."""
    return df.withColumns(
        {
            "company_age": company_age(F.col("pub_year"), F.col("meta_founded_year")),
            "company_size_category": size_category(F.col("meta_employee_count")),
        }
    )
