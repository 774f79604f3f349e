"""Near-duplicate documents: SimHash linked by the general pigeonhole principle.

A document's fingerprint is the bitwise majority of the hashes of its word
shingles.  Fingerprints link at ``radius`` (2) or fewer differing bits.  The 64
bits are grouped so that correlated ones stand together, and each group i gets
a threshold t_i with sum(t_i + 1) = radius + 1.  Two fingerprints within the
radius then agree in some group up to its threshold, so probing each group's
values within its threshold finds every pair; the pairs are verified.
Thresholds come from dynamic programming on estimated probe and candidate
counts, and the number of groups is the cheapest one.

Fingerprints that meet in a bucket of more than ``BUCKET`` members skip the
pairing.  They are linked exactly as well: two fingerprints within 2 bits have a
common neighbour within 1 bit of both, so each emits itself and its 64
one-bit neighbours, and whoever shares such a key is linked to the least
fingerprint there.  At most 65 fingerprints can share a key.

Null and empty texts have fingerprint zero and are linked like any other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.common import hash_limit, map_text
from broadsheet.llm.components import connected_components
from broadsheet.session import materialise

BITS = 64
SEED = 42
RADIUS = 2
BUCKET = 64
#: Fingerprints from which bit correlations and candidate counts are estimated.
#: The estimate only chooses the cheapest grouping; every grouping is exact.
SAMPLE = 1024
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of ``text``; 0 without words."""
    import xxhash

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(parts) <= shingle:
        hashes = [digest(b" ".join(parts), SEED)]
    else:
        hashes = [digest(b" ".join(s), SEED) for s in zip(*(parts[i:] for i in range(shingle)), strict=False)]
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), CHUNK):
        bits = np.array(hashes[i : i + CHUNK], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a signed long."""

    def start() -> Callable:
        return lambda texts: [[fingerprint(t, shingle) for t in texts]]

    return map_text(docs, text, start, [(out, T.LongType())])


def _bit_groups(bits: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of bits of near equal width, correlated bits together."""
    spread = bits - bits.mean(axis=0)
    norm = np.sqrt((spread**2).sum(axis=0))
    norm[norm == 0] = 1
    tied = np.abs((spread / norm).T @ (spread / norm))
    free, groups = list(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        group = [free.pop(0)]
        while len(group) < width:
            best = max(free, key=lambda b: (tied[b, group].sum(), -b))
            free.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def _within(bits: np.ndarray, group: list[int], t: int) -> float:
    """Estimated share of fingerprint pairs within ``t`` bits in ``group``."""
    chance = np.zeros(t + 1)
    chance[0] = 1
    for p in bits[:, group].mean(axis=0):
        same = p * p + (1 - p) * (1 - p)
        chance = chance * same + np.concatenate([[0], chance[:-1]]) * (1 - same)
    part = bits[:, group].astype(np.float32)
    apart = part.sum(axis=1)[:, None] + part.sum(axis=1)[None, :] - 2 * part @ part.T
    n = len(bits)
    seen = ((apart <= t + 0.5).sum() - n) / max(1, n * (n - 1))
    return max(float(chance.sum()), float(seen))


def _probes(width: int, t: int) -> int:
    return 1 + (width if t >= 1 else 0) + (width * (width - 1) // 2 if t >= 2 else 0)


def plan_groups(sample: list[int], total: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Bit groups with their thresholds, of least estimated cost.

    Cost of a group: probes of all fingerprints plus expected candidates.  The
    dynamic program runs over groups and the thresholds' budget.
    """
    if len(sample) < 2:
        return [(list(range(BITS)), radius)]
    raw = np.array(sample, "<i8").view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float64)
    best: tuple[float, list[tuple[list[int], int]]] = (float("inf"), [])
    for m in range(1, radius + 2):
        table: dict[int, tuple[float, list[tuple[list[int], int]]]] = {0: (0.0, [])}
        for group in _bit_groups(bits, m):
            costs = {0: 0.0} | {
                t + 1: total * _probes(len(group), t) + total * total / 2 * _within(bits, group, t)
                for t in range(radius + 1)
            }
            step: dict[int, tuple[float, list[tuple[list[int], int]]]] = {}
            for used, (cost, chosen) in table.items():
                for more, extra in costs.items():
                    at = used + more
                    if at <= radius + 1 and cost + extra < step.get(at, (float("inf"), []))[0]:
                        step[at] = (cost + extra, chosen + ([(group, more - 1)] if more else []))
            table = step
        best = min(best, table[radius + 1], key=lambda x: x[0])
    return best[1]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _mask(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def _flips(group: list[int], t: int) -> list[int]:
    """Masks of all changes of at most ``t`` bits of ``group``."""
    out = [[]] + [[b] for b in group if t >= 1]
    out += [[a, b] for i, a in enumerate(group) for b in group[i + 1 :] if t >= 2]
    return [_mask(x) for x in out]


def links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET, plan: list | None = None) -> DataFrame:
    """Edges ``(a, b)`` that connect the distinct fingerprints ``nodes(fp)``.

    All verified pairs of small buckets; for crowded buckets enough links to
    connect whatever is within the radius there.
    """
    if not 0 <= radius <= 2:
        raise ValueError("radius must be 0, 1 or 2")
    if plan is None:
        total = nodes.count()
        few = nodes.where(F.xxhash64("fp") <= hash_limit(SAMPLE, total))
        sample = [r[0] for r in few.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
        plan = plan_groups(sample, total, radius)
    data = probe = None
    for i, (group, t) in enumerate(plan):
        value = F.col("fp").bitwiseAND(F.lit(_mask(group)))
        d = nodes.select(F.lit(i).alias("g"), value.alias("v"), F.col("fp").alias("b"))
        masks = F.explode(F.lit(_flips(group, t)))
        p = nodes.select(F.lit(i).alias("g"), value.alias("v0"), F.col("fp").alias("a"), masks.alias("x"))
        p = p.select("g", F.col("v0").bitwiseXOR(F.col("x")).alias("v"), "a")
        data, probe = (d, p) if data is None else (data.union(d), probe.union(p))
    crowded = materialise(data.groupBy("g", "v").count().where(F.col("count") > bucket).select("g", "v", F.lit(True).alias("hot")))
    data, probe = (x.join(crowded, ["g", "v"], "left") for x in (data, probe))
    found = (
        probe.where("hot IS NULL")
        .drop("hot")
        .join(data.where("hot IS NULL").drop("hot"), ["g", "v"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
        .select("a", "b")
    )
    hot = data.where("hot").select(F.col("b").alias("fp")).union(probe.where("hot").select("a")).distinct()
    near = _flips(list(range(BITS)), 1)
    keyed = hot.select("fp", F.explode(F.lit(near)).alias("x")).select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("key"))
    star = keyed.groupBy("key").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1)
    pairs = star.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a < b")
    if radius < 2:  # a shared neighbour only shows a distance of up to 2
        pairs = star.select(F.explode("members").alias("a"), "members").select("a", F.explode("members").alias("b"))
        pairs = pairs.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
    return found.union(pairs).distinct()


def components(prints: DataFrame, key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``(fp, component_id, winner)`` for every fingerprint of ``prints``.

    ``component_id`` is the least key of the component (null if it has none but
    null keys).  ``prints`` is read several times: pass a stored table.
    """
    nodes = materialise(prints.groupBy("fp").agg(F.min(key).alias("least")))
    roots = connected_components(links(nodes.select("fp"), radius))
    member = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return member.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``(key, fingerprint, component_id)`` of every document."""
    prints = materialise(with_fingerprints(docs.select(key, text), text).select(key, "fp"))
    return prints.join(components(prints, key, radius), "fp").select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: that of its least key.

    Rows without key come last; of rows with one key and component the first
    stored one stays.  Columns are those of ``docs``.
    """
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), F.col(text).alias("text"))
    stored = materialise(with_fingerprints(packed, "text").drop("text").withColumn("row", F.monotonically_increasing_id()))
    rank = F.struct(F.col(f"doc.`{key}`").isNull().alias("none"), F.col(f"doc.`{key}`").alias("id"), F.col("row"))
    prints = stored.select("fp", rank.alias("rank"))
    best = components(prints, "rank", radius).select(F.col("component_id.row").alias("row")).distinct()
    return stored.join(best, "row", "left_semi").select("doc.*")
