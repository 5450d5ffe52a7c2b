"""Jaccard self-join of shingle sets by partitioning the universe (pigeonhole principle).

Two sets of sizes a >= b link only if their symmetric difference is at most
(a + b) (1 - t) / (1 + t). Copies of a set are one; search is over different sets.

* Sets meet in *size bands* that grow by half. A set is indexed in its own band
  and probes that band and, where partners may be there, the one below.
* A band hashes the universe of shingles into m *segments*. If each segment i of
  a pair differed by more than d_i (-1, 0 or 1), the pair would differ by the
  sum of d_i + 1 at least. So a probe that spends one unit more than its largest
  difference - 0 units on a segment, 1 for an equal subset, 2 for a subset that
  is equal but for one shingle - meets every partner in some segment.
* The index holds each segment's subset, and the *one-deletion neighbourhoods* of
  some segments (of all, in small bands). Allocation is by *cost*: a count-min sketch of
  all subsets tells how often each occurs, and units go where few partners are;
  empty segments, equal for all sets that lack them, come last.
* Entries of a signature meet in one task, packed as bytes; what the sketch knows as hot is
  dealt out by set as well, and kept unseen. Only signatures that a probe and another set share
  go on.
* Sketches of a bit or two a shingle bound the difference of a pair from below; what they don't
  rule out is verified on whole sets. A few rounds of stars (every set against a
  leader of each of its signatures) connect groups of near copies without their pairs; only pairs of
  sets that are still apart are then enumerated. No link between different components is left.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.llm.common import Words, chunks, components, folded, mixed, run_hashes, written

#: Entries of a task that meets signatures, and that a task holds before it deals them; sketch cells; bytes of the filter of
#: sets to re-read.
ENTRIES, HELD, CELLS, FILTER = 1 << 18, 1 << 17, 1 << 18, 4 << 20
#: Bytes of text hashed at a time (working arrays take some 80 times as much).
CHUNK = 1 << 17
#: Bytes of the sketches that travel with signatures; sets of a signature that one task compares.
BRIEF, BLOCK = 64, 2048
#: Roles of an entry: a subset or a deletion in the index; a probe of subsets, and of deletions too.
SUBSET, DELETION, PROBE, NEAR = 1, 2, 4, 8
SALT, ROLELESS = np.uint64(0x5851F42D4C957F2D), ~np.uint64(15)


# ---- sets ------------------------------------------------------------------

def _sets(column: pa.Array, shingle: int):
    """(row, sorted distinct shingle hashes) of the texts of a batch that have words."""
    for c in chunks(column, CHUNK):
        w = Words(c, lower=True)
        many = run_hashes(w.hash, shingle)
        for i in range(c.rows):
            a, b = int(w.first[i]), int(w.first[i + 1])
            if b - a >= shingle:
                yield c.row + i, np.unique(many[a:b - shingle + 1])
            elif b > a:
                yield c.row + i, run_hashes(w.hash[a:b], b - a)


def set_key(s: np.ndarray) -> int:
    """64-bit name of a set: equal for equal sets."""
    return int(mixed(np.array([mixed(s ^ SALT).sum(dtype=np.uint64) + np.uint64(len(s))]))[0].view(np.int64))


# ---- bands -----------------------------------------------------------------

class Bands:
    """Size bands with their segments, for links at 100 * intersection >= percent * union."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [max(1, -(-percent // (100 - percent)))]  # a smaller set links with equal ones only
        self.made: dict[int, tuple[int, int, np.ndarray]] = {}

    def largest_difference(self, a: int, b: int) -> int:
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def of(self, n: int) -> int:
        """The band of size ``n``; -1 below all."""
        while self.low[-1] <= n:
            self.low.append(-(-3 * self.low[-1] // 2))
        return bisect_right(self.low, n) - 1

    def segments(self, band: int) -> tuple[int, int, np.ndarray]:
        """(segments, how many of them have deletions in the index, a hash of each one's place)."""
        if band not in self.made:
            self.of(self.low[band] * 3)
            top = self.low[band + 1] - 1
            m = near = self.largest_difference(top * 100 // self.percent, top) + 1
            if m > 6:
                m, near = m + m // 20 + 2, 2
            self.made[band] = m, near, mixed(np.arange(m).astype(np.uint64) + np.uint64(band << 32) + SALT)
        return self.made[band]

    def probes(self, n: int) -> list[tuple[int, int]]:
        """(band, units) of the bands in which a set of ``n`` looks for sets of its size and below."""
        own = self.of(n)
        if own < 0:
            return []
        out = [(own, self.largest_difference(n, n) + 1)]
        if own > 0 and -(-n * self.percent // 100) < self.low[own]:
            out.append((own - 1, self.largest_difference(n, self.low[own] - 1) + 1))
        return out


class Tokens:
    """A set's shingles, hashed twice: for their segment and for the sum that names a subset."""

    def __init__(self, s: np.ndarray):
        self.spread, self.term = mixed(s + SALT) >> np.uint64(32), mixed(s)

    def subsets(self, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sum of the terms and size of each of ``m`` segments, the shingles' segments)."""
        segment = ((self.spread * np.uint64(m)) >> np.uint64(32)).astype(np.uint16 if m < 1 << 16 else np.int64)
        total = np.zeros(len(segment) + 1, np.uint64)
        np.cumsum(self.term[np.argsort(segment, kind="stable")], out=total[1:])
        size = np.bincount(segment, minlength=m)
        edge = np.zeros(m + 1, np.int64)
        np.cumsum(size, out=edge[1:])
        return total[edge[1:]] - total[edge[:-1]], size, segment


def allocate(cost: np.ndarray, less: np.ndarray, units: int) -> np.ndarray:
    """Units (0, 1 or 2) for each segment, ``units`` in all, at least cost.

    ``cost`` is the price of a segment's first unit, ``less`` that of the second, in the segments that have one.
    """
    first = cost + 1.0
    price = np.concatenate([first, np.maximum(first[:len(less)], less)])
    chosen = np.argsort(price, kind="stable")[:units]  # a second unit never comes before its first
    out = np.zeros(len(first), np.int64)
    np.add.at(out, np.where(chosen < len(first), chosen, chosen - len(first)), 1)
    return out


def entries(s: np.ndarray, bands: Bands, counts) -> np.ndarray:
    """Signatures of a set, the role in the last four bits; ``counts`` tells how often subsets occur."""
    out = []
    own, tokens = bands.of(len(s)), Tokens(s)
    for band, units in bands.probes(len(s)):
        m, near, place = bands.segments(band)
        sums, size, segment = tokens.subsets(m)
        whole = mixed(sums ^ place) & ROLELESS
        some = np.flatnonzero(segment < near)
        here = segment[some]
        less = mixed((sums[here] - tokens.term[some]) ^ place[here]) & ROLELESS
        # the first unit costs a probe and the subset's partners, the second that for each deletion
        cost = counts(whole).astype(float)
        cost[size == 0] = 1e15  # an empty subset only if all else is spent
        spent = allocate(cost, np.bincount(here, 1.0 + counts(less), minlength=near), units)
        role = np.array([0, PROBE, NEAR], np.uint64)[spent]
        low = np.array([0, 0, PROBE], np.uint64)[spent[here]]
        if band == own:
            role |= np.uint64(SUBSET)
            low |= np.uint64(DELETION)
        out += [(whole | role)[role > 0], (less | low)[low > 0]]
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def count_entries(n: int, bands: Bands) -> int:
    """About how many entries a set of ``n`` has."""
    out = 0
    for band, units in bands.probes(n):
        m, near, _ = bands.segments(band)
        out += (m if band == bands.of(n) else units) + n * near // m
    return out


# ---- passes ----------------------------------------------------------------

def _profile(shingle: int, bands: Bands):
    """(doc_id, xh, n, id, m) of each text, and last the task's counts of subsets as a row of its own."""
    names = ["doc_id", "xh", "n", "id", "m", "cells"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches):
        cells = np.zeros(CELLS, np.uint32)
        for b in batches:
            n, key, m, found = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), []
            for row, s in _sets(b.column(2), shingle):
                n[row], key[row], m[row] = len(s), set_key(s), count_entries(len(s), bands)
                band = bands.of(len(s))
                if band >= 0:
                    m_, _, place = bands.segments(band)
                    found.append(_cell(mixed(Tokens(s).subsets(m_)[0] ^ place)))
            if found:
                cells += np.bincount(np.concatenate(found), minlength=CELLS).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), pa.array(key), pa.array(m), pa.nulls(b.num_rows, pa.binary())], names)
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip([None] * 5 + [cells.tobytes()], kinds, strict=True)], names)
    return run


def _cell(signature: np.ndarray) -> np.ndarray:
    return (signature >> np.uint64(46)).astype(np.int64) & (CELLS - 1)


def _packed(shingle: int, bands: Bands, counts: np.ndarray, hot: float, parts: int):
    """(part, entries): signatures and sets, dealt by signature, hot ones by set too."""
    def run(batches):
        held, sets, size = [], [], 0
        seen: set[int] = set()

        def out():
            sig, of = np.concatenate(held), np.concatenate(sets)
            plain = sig & ROLELESS
            key = np.where(counts[_cell(plain)] > hot, plain ^ mixed(of.view(np.uint64)), plain)
            part = (mixed(key) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            edge = np.flatnonzero(np.diff(part[order], prepend=-1))
            both = np.stack([sig.view(np.int64), of], 1)[order]
            blobs = [both[a:z].tobytes() for a, z in zip(edge, np.append(edge[1:], len(order)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(part[order][edge]), pa.array(blobs, pa.binary())], ["part", "entries"])

        for b in batches:
            for _, s in _sets(b.column(0), shingle):
                if bands.of(len(s)) < 0:
                    continue
                key = set_key(s)
                if key in seen:  # a copy
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(key)
                e = entries(s, bands, lambda w: counts[_cell(w)])
                held.append(e)
                sets.append(np.full(len(e), key))
                size += len(e)
                if size > HELD:
                    yield from out()
                    held, sets, size = [], [], 0
        if size:
            yield from out()
    return run


def _shared(counts: np.ndarray, hot: float):
    """(sig, id, role) of the entries of a part whose signature a probe and another set share, or that are hot."""
    def run(key, t):
        raw = np.concatenate([np.frombuffer(x.as_buffer(), np.int64).reshape(-1, 2) for c in t.column("entries").chunks for x in c])
        sig, of = raw[:, 0].view(np.uint64), raw[:, 1]
        plain, role = sig >> np.uint64(4), (sig & np.uint64(15)).astype(np.int32)
        order = np.lexsort((of, plain))
        plain, of, role = plain[order], of[order], role[order]
        new = np.ones(len(of), bool)
        new[1:] = (plain[1:] != plain[:-1]) | (of[1:] != of[:-1])
        at = np.flatnonzero(new)
        role = np.bitwise_or.reduceat(role, at)
        plain, of = plain[at], of[at]
        first = np.flatnonzero(np.diff(plain, prepend=plain[0] ^ np.uint64(1)))
        size = np.diff(np.append(first, len(plain)))
        any_ = np.repeat(np.bitwise_or.reduceat(role, first), size)
        keep = (np.repeat(size, size) > 1) & (any_ & (PROBE | NEAR) > 0) & (any_ & (SUBSET | DELETION) > 0)
        keep |= counts[_cell(plain << np.uint64(4))] > hot
        return pa.table({"sig": pa.array(plain[keep].view(np.int64)), "id": pa.array(of[keep]), "role": pa.array(role[keep])})
    return run


def _wanted(rows: DataFrame) -> np.ndarray:
    """A Bloom filter of the hashes ``k``, of the same size whatever their number."""
    def bits(batches):
        out = np.zeros(FILTER, np.uint8)
        for b in batches:
            for at in _probes(b.column(0).to_numpy()):
                np.bitwise_or.at(out, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        return out

    found = folded(rows.select("k"), bits, np.bitwise_or)
    return np.zeros(FILTER, np.uint8) if found is None else found


def _probes(k: np.ndarray):
    h = mixed(k.view(np.uint64))
    for shift in (0, 32):
        yield ((h >> np.uint64(shift)) & np.uint64(0xFFFFFFFF)).astype(np.int64) % (8 * FILTER)


def odd_sketch(s: np.ndarray) -> bytes:
    """A bit for each of two cells a shingle: set when an odd number of shingles fall there."""
    cells = max(8 * BRIEF, 1 << int(2 * len(s) - 1).bit_length())
    return np.packbits(np.bincount((mixed(s ^ SALT) & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1, bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their sketches: each shingle turns one bit."""
    x, y = (np.frombuffer(folded_to(v, min(len(x), len(y))), "<u8") for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def folded_to(sketch: bytes, size: int) -> bytes:
    """The sketch in ``size`` bytes at most; cells are taken modulo their number, so halves add up."""
    while len(sketch) > size:
        x = np.frombuffer(sketch, "<u8")
        sketch = (x[:len(x) // 2] ^ x[len(x) // 2:]).tobytes()
    return sketch


def _plausible(bands: Bands):
    """(a, b) of the pairs (a, b, n and sketch of both) that their sketches don't rule out."""
    def run(batches):
        for b in batches:
            n, m, x, y = (b.column(i).to_pylist() for i in (2, 3, 4, 5))
            keep = [least_difference(*p) <= bands.largest_difference(i, j) for i, j, *p in zip(n, m, x, y, strict=True)]
            yield pa.RecordBatch.from_arrays(b.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _briefs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_buffer() for x in column), "<u8").reshape(-1, BRIEF // 8)


def _ordered(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Different pairs (a > b)."""
    pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _pairs(bands: Bands, nearest: bool):
    """Plausible pairs of sets of a signature that are in different components.

    Rows come sorted by ``key``; step k compares row i with row i + k of its key, all keys
    at once. With ``nearest``, each row's partner of least difference only.
    """
    def meets(x, y):
        return ((x & (PROBE | NEAR) > 0) & (y & SUBSET > 0)) | ((x & NEAR > 0) & (y & DELETION > 0))

    def run(batches):
        t = pa.Table.from_batches(list(batches)).combine_chunks()
        if not t.num_rows:
            return
        key, side, of, role, n, label = (t.column(c).to_numpy() for c in ("key", "side", "id", "role", "n", "label"))
        brief = _briefs(t.column("brief"))
        best, to = np.full(len(key), np.iinfo(np.int64).max), np.full(len(key), -1)
        live, k, held = np.arange(len(key)), 1, 0
        a, b = [], []
        while True:
            live = live[live + k < len(key)]
            live = live[key[live] == key[live + k]]
            if not len(live):
                break
            for i in np.array_split(live, -(-len(live) // (1 << 16))):
                j = i + k
                fit = (label[i] != label[j]) & ((side[i] != side[j]) | (side[i] == 0))
                fit &= np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * bands.percent
                fit &= meets(role[i], role[j]) | meets(role[j], role[i])
                i, j = i[fit], j[fit]
                apart = np.bitwise_count(brief[i] ^ brief[j]).sum(axis=1).astype(np.int64)
                may = apart <= bands.largest_difference(n[i], n[j])
                i, j, apart = i[may], j[may], apart[may]
                if nearest:
                    for x, y in ((i, j), (j, i)):
                        less = apart < best[x]
                        best[x[less]], to[x[less]] = apart[less], y[less]
                elif len(i):
                    a.append(of[i])
                    b.append(of[j])
                    held += len(i)
                    if held > 1 << 18:
                        yield _ordered(np.concatenate(a), np.concatenate(b))
                        a, b, held = [], [], 0
            k += 1
        if nearest:
            has = np.flatnonzero(to >= 0)
            a, b = [of[has]], [of[to[has]]]
        if a:
            yield _ordered(np.concatenate(a), np.concatenate(b))
    return run


def _chosen_sets(shingle: int, wanted):
    """(id, n, brief sketch, sketch, items) of the texts whose (doc_id, text) the filter holds, once a task."""
    def run(batches):
        sent: set[int] = set()
        for b in batches:
            hit = np.ones(b.num_rows, bool)
            for at in _probes(b.column(0).to_numpy()):
                hit &= wanted.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
            found = []
            for _, s in _sets(b.column(1).filter(pa.array(hit)), shingle):
                key = set_key(s)
                if key not in sent:
                    sketch = odd_sketch(s)
                    found.append((key, len(s), folded_to(sketch, BRIEF), sketch, s.tobytes()))
                    if len(sent) > 200_000:
                        sent.clear()
                    sent.add(key)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate([pa.int64()] * 2 + [pa.binary()] * 3)],
                                             ["id", "n", "brief", "sketch", "items"])
    return run


def _links(bands: Bands):
    """(a, b) of the pairs whose sets link."""
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(x, y)
                common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                keep.append(100 * common >= bands.percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(b.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


# ---- the operator ----------------------------------------------------------

def jaccard_components(docs: DataFrame, shingle: int = 5, percent: int = 80, stars: int = 1,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    A row's set is its distinct shingles of ``shingle`` words (A-Z lower-cased; the whole
    sequence, if it has fewer words). Rows link at 100 * intersection >= ``percent`` * union;
    ``component_id`` is the smallest doc_id that links reach, the row's own included. A null,
    empty or blank text has the empty set and links with nothing, its own copies included. Repeated rows
    get equal rows, and a null id counts in no minimum. Other columns of ``docs`` are not looked
    at; an empty table gives an empty result. ``stars`` rounds of stars come before pairs are enumerated;
    the result doesn't depend on it. Shingles and sets go by 64-bit hashes.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("xh"), text.alias("text"))
    bands = Bands(percent)
    seen = written(rows.mapInArrow(_profile(shingle, bands), "doc_id long, xh long, n long, id long, m long, cells binary"), "pigeonhole-sets")
    of_row = seen.where("cells is null").select("doc_id", "xh", "n", "id")
    classes = of_row.where(f"n >= {bands.low[0]}").groupBy("id").agg(
        F.min("n").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "xh")).alias("s"))

    def cells(batches):
        out = np.zeros(CELLS, np.int64)
        for b in batches:
            for x in b.column(0):
                out += np.frombuffer(x.as_buffer(), np.uint32)
        return out

    counts = folded(seen.where("cells is not null").select("cells"), cells, np.add)
    total = (seen.agg(F.sum("m")).first()[0] or 0) if counts is not None else 0
    if not total:
        edges = docs.sparkSession.createDataFrame([], "a long, b long")
    else:
        edges = _edges(rows, classes, bands, counts, total, shingle, stars)
    found = components(edges, "pigeonhole")
    of = of_row.join(found, of_row.id == found.v, "left").select("doc_id", "n", F.coalesce("label", "id").alias("label"))
    of = of.where("n > 0")
    low = of.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    alone = of_row.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return of.join(low, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(alone)


def _edges(rows: DataFrame, classes: DataFrame, bands: Bands, counts: np.ndarray, total: int, shingle: int, stars: int) -> DataFrame:
    """Links (a, b) that connect what all links connect."""
    spark = rows.sparkSession
    hot = max(ENTRIES // 2, 4 * counts.sum() / CELLS)
    parts = max(1, -(-total // ENTRIES))
    packed = rows.select("text").mapInArrow(_packed(shingle, bands, counts, hot, parts), "part long, entries binary")
    shared = written(packed.groupBy("part").applyInArrow(_shared(counts, hot), "sig long, id long, role int"), "pigeonhole-shared")
    members = written(shared.select("id").distinct().join(classes, "id").select(F.xxhash64("s.doc_id", "s.xh").alias("k")), "pigeonhole-members")
    wanted = spark.sparkContext.broadcast(_wanted(members))
    sets = written(rows.select(F.xxhash64("doc_id", "xh").alias("k"), "text").mapInArrow(
        _chosen_sets(shingle, wanted), "id long, n long, brief binary, sketch binary, items binary"), "pigeonhole-items")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Those that link: whole sketches first, then sets."""
        for step, columns in ((_plausible, ("n", "sketch")), (_links, ("items",))):
            both = pairs
            for side in "ab":
                both = both.join(sets.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
            both = both.select("a", "b", *[f"{c}_{side}" for c in columns for side in "ab"])
            pairs = written(both.mapInArrow(step(bands), "a long, b long").distinct(), f"{name}{step.__name__}")
        return pairs

    def sided(side: str):
        return [F.col(c).alias(f"{c}_{side}") for c in ("id", "n", "label")]

    edges, tested = spark.createDataFrame([], "a long, b long"), None
    member = sets.groupBy("id").agg(F.min("n").alias("n"), F.min("brief").alias("brief"))
    apart = shared.join(member.select("id", "n"), "id").withColumn("label", F.col("id"))
    steps = [*["star"] * stars, "nearest", "all"]
    for k, step in enumerate(steps):
        # signatures whose sets are not yet one component
        lead = F.min(F.struct(F.xxhash64(F.lit(k), "id").alias("h"), *sided("b"))).alias("lead")
        several = written(apart.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("sets"), lead)
                          .where("lo < hi").select("sig", "sets", "lead.*"), f"pigeonhole-leaders-{k}")
        apart = apart.join(several.select("sig", "sets"), "sig")
        if step == "star":
            star = apart.select("sig", *sided("a")).join(several, "sig").where(
                f"label_a <> label_b and least(n_a, n_b) * 100 >= greatest(n_a, n_b) * {bands.percent}")
            pairs = star.select(F.greatest("id_a", "id_b").alias("a"), F.least("id_a", "id_b").alias("b"))
        else:
            pairs = _dealt(apart.join(member.select("id", "brief"), "id")).mapInArrow(_pairs(bands, step == "nearest"), "a long, b long")
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, f"pigeonhole-pairs-{k}")
        edges = edges.union(verified(pairs, f"pigeonhole-{k}"))
        tested = pairs if tested is None else tested.union(pairs)
        if step != "all":
            found = components(edges, "pigeonhole")
            apart = written(apart.join(found, F.col("id") == F.col("v"), "left").select(
                "sig", "id", "role", "n", F.coalesce(found.label, "id").alias("label")), f"pigeonhole-apart-{k}")
    return edges


def _dealt(apart: DataFrame) -> DataFrame:
    """Rows so that two of a signature meet in some task, sorted by ``key`` there.

    The sets of a signature of more than ``BLOCK`` are dealt to blocks, and every two
    blocks meet under a key of their own (``side`` 1 and 2; 0 where a block meets itself).
    """
    blocks = F.ceil(F.col("sets") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    rows = apart.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side")
    key = F.xxhash64("sig", F.least("own", "other"), F.greatest("own", "other")).alias("key")
    rows = rows.select(key, side, "id", "role", "n", "label", "brief")
    size = apart.agg(F.sum(blocks.cast("long"))).first()[0] or 0
    return rows.repartition(max(1, -(-size // 50_000)), "key").sortWithinPartitions("key")


def op11_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
