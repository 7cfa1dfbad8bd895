"""Components of an exact set-similarity join, from shared-key lists.

Input is a membership table ``(key, id)``: two sets that may be similar
share at least one key.  Pairs are never expanded within a key.

1. Lists with one id only are dropped (``min < max``, combined map-side).
2. Each list has a hub, the member whose lists are longest in sum (in a group of
   edits, the text they come from).  Every id is compared with one hub: the one
   it shares most lists with.  That is one pair an id, and it joins dense groups
   of copies.
3. Lists that still hold several components are first compared block by block:
   each member stands in one block of a list, and one outside the list's largest
   component sends the :data:`BEST` partners of its block that bounds on sizes and
   hashed bitmaps (``|A ^ B| >= popcount(bits A ^ bits B)``) rank highest: a few
   rows a member, whatever the length of the list.
4. Lists where that left pairs out are then compared in full, in tiles: blocks of
   residents (all members) against blocks of visitors (members outside the largest
   component).  The sets come with them, so the pairs that the bounds let pass are
   verified in the tile, and only links that join two components leave it: fewer
   than it has members, however many pairs fail.
5. Pairs are verified by intersecting the sorted arrays that the sets' payloads
   decode to (the elements themselves, or a text to cut up again: whatever is
   smaller to move).

Of lists with the same members one is kept: a passage that some sets share gives
as many equal lists as it has elements.

A pair left unverified is one whose ends are connected already, so the
components are those of the full join over all pairs that share a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import bitmap_of, id_filter, in_filter, pieces, scratch, staged
from verdant.llm.graph import components

TILE = 512          # members of a tile's block
TILE_BYTES = 1 << 24    # bytes of payloads of a tile's block, about
BEST = 4            # partners that a visitor sends from its block in the first round
SETS = "id long, payload binary"
Decode = Callable[[Iterable[bytes]], Iterator[np.ndarray]]     # payloads to sorted, distinct elements, in their order


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    """OR a bitmap (rows x bytes) down to ``width`` bytes (both powers of two)."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def _by_width(bitmaps: list[bytes]) -> dict[int, np.ndarray]:
    groups: dict[int, list[int]] = {}
    for i, b in enumerate(bitmaps):
        groups.setdefault(len(b), []).append(i)
    return {w: np.array(ix) for w, ix in groups.items()}


def _tile_pairs(ids, comps, sizes, bitmaps, resident, visitor, num: int, den: int, best: int | None):
    """Pairs of a tile that the size and bitmap bounds cannot exclude: all, or each
    visitor's ``best`` and one ``(id, None)`` where that left some out."""
    width = _by_width(bitmaps)
    mats = {w: np.frombuffer(b"".join(bitmaps[i] for i in ix), dtype=np.uint8).reshape(-1, w)
            for w, ix in width.items()}
    at = {int(i): (w, k) for w, ix in width.items() for k, i in enumerate(ix)}
    for v in np.flatnonzero(visitor):
        wv, kv = at[int(v)]
        own = mats[wv][kv:kv + 1]
        partners, bounds = [], []
        for w, ix in width.items():
            total = sizes[ix] + sizes[v]
            small, large = np.minimum(sizes[ix], sizes[v]), np.maximum(sizes[ix], sizes[v])
            ok = resident[ix] & (comps[ix] != comps[v]) & (den * small >= num * large)
            # visitor against visitor is met from both sides of a diagonal tile: keep one
            ok &= ~(visitor[ix] & resident[v] & (ids[ix] >= ids[v]))
            if not ok.any():
                continue
            sel = np.flatnonzero(ok)
            least = min(w, wv)
            x = _fold(mats[w][sel], least) ^ _fold(own, least)
            apart = np.bitwise_count(x).sum(axis=1, dtype=np.int64)
            common = (total[sel] - apart) // 2
            keep = den * common >= num * (total[sel] - common)
            partners.append(ids[ix[sel[keep]]])
            bounds.append(common[keep] / np.maximum(total[sel[keep]] - common[keep], 1))
        if not partners:
            continue
        found = np.concatenate(partners)
        if best is not None and len(found) > best:
            found = found[np.lexsort((found, -np.concatenate(bounds)))[:best]]
            yield ids[v], None
        for j in found:
            yield min(j, ids[v]), max(j, ids[v])


def _tile_links(ids, comps, sizes, bitmaps, resident, visitor, payloads, num: int, den: int, decode):
    """Links of a tile that join its components: its pairs are verified as they come,
    and those whose ends are joined already are passed over."""
    at = {int(x): i for i, x in enumerate(ids)}
    up: dict[int, int] = {}
    sets: dict[int, np.ndarray] = {}

    def root(c: int) -> int:
        while c in up:
            up[c] = c = up.get(up[c], up[c])
        return c

    def elements(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = next(iter(decode([payloads[i].as_py()])))
        return sets[i]

    for a, b in _tile_pairs(ids, comps, sizes, bitmaps, resident, visitor, num, den, None):
        i, j = at[int(a)], at[int(b)]
        ra, rb = root(int(comps[i])), root(int(comps[j]))
        if ra != rb and _similar(elements(i), elements(j), num, den):
            up[max(ra, rb)] = min(ra, rb)
            yield a, b


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("open", pa.int64())])
_CAND = "a long, b long, open long"


def _tiles(num: int, den: int, best: int | None, decode: Decode | None = None):
    """Rows ``(a, b, null)`` are pairs, ``(null, null, key)`` lists with pairs left out.
    Without ``best`` the pairs are links, verified by the tile's ``payload`` column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def flush(t: pa.Table):
            keys = np.stack([t.column(c).to_numpy() for c in ("key", "p", "q")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            bounds = np.concatenate([[0], cuts, [len(keys)]])
            ids, comps, sizes = (t.column(c).to_numpy() for c in ("id", "comp", "n"))
            bitmaps = t.column("bits").to_pylist()
            res, vis = (t.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("resident", "visitor"))
            out: set[tuple] = set()
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if hi - lo < 2:
                    continue
                s = slice(lo, hi)
                tile = ids[s], comps[s], sizes[s], bitmaps[lo:hi], res[s], vis[s]
                found = (_tile_links(*tile, t.column("payload").slice(lo, hi - lo), num, den, decode) if best is None
                         else _tile_pairs(*tile, num, den, best))
                out.update((int(x), int(y), None) if y is not None else (None, None, int(keys[lo, 0]))
                           for x, y in found)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_PAIR)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            if rest is not None:
                t = pa.concat_tables([rest, t])
            keys = np.stack([t.column(c).to_numpy() for c in ("key", "p", "q")], axis=1)
            new = np.flatnonzero((keys != keys[-1]).any(axis=1))
            full = int(new[-1]) + 1 if len(new) else 0      # the last tile may continue
            rest = t.slice(full)
            if full:
                yield from flush(t.slice(0, full))
        if rest is not None and rest.num_rows:
            yield from flush(rest)
    return run


def stored(payloads: Iterable[bytes]) -> Iterator[np.ndarray]:
    """Payloads of the sorted elements themselves."""
    return (np.frombuffer(p, dtype="<i8") for p in payloads)


def _similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """``den * |x & y| >= num * |x | y|`` of two sorted sets."""
    if den * min(len(x), len(y)) < num * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")               # two sorted runs: one merge
    common = int((both[1:] == both[:-1]).sum())
    return den * common >= num * (len(both) - common)


def _verifier(num: int, den: int, decode: Decode):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            pairs = zip(*(decode(batch.column(c).to_pylist()) for c in ("pa", "pb")))
            keep = [_similar(x, y, num, den) for x, y in pairs]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def verify(pairs: DataFrame, sets: DataFrame, num: int, den: int,
           decode: Decode = stored) -> DataFrame:
    """The pairs ``(a, b)`` with ``den * |A & B| >= num * |A | B|``."""
    sa = sets.select(F.col("id").alias("a"), F.col("payload").alias("pa"))
    sb = sets.select(F.col("id").alias("b"), F.col("payload").alias("pb"))
    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "pa", "pb").mapInArrow(
        _verifier(num, den, decode), "a long, b long")


def _marks(ids: DataFrame):
    """A bitmap of the ids, of a fixed size, that prunes the scan of the sets before a join."""
    return ids.sparkSession.sparkContext.broadcast(id_filter(ids, "id"))


def _among(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = wanted.value
        for batch in pieces(batches):
            yield batch.filter(pa.array(in_filter(bitmap, batch.column("id").to_numpy())))
    return run


def _signer(decode: Decode, wanted, with_payload: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _among(wanted)(batches):
            got = list(decode(batch.column("payload").to_pylist()))
            cols = [batch.column("id"), pa.array([len(x) for x in got], pa.int64()),
                    pa.array([bitmap_of(x) for x in got], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols + [batch.column("payload")] * with_payload,
                                             names=["id", "n", "bits"] + ["payload"] * with_payload)
    return run


def _lists(members: DataFrame) -> DataFrame:
    """The lists of several members, of those with the same members one."""
    # dealt by key once: the ends of the lists and their members are taken from the same rows
    # (no key is null; said here, because the join says so and would deal its own rows else)
    members = members.where("key is not null").repartition("key")
    ends = (members.groupBy("key")
            .agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("c"),
                 F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
            .where("lo < hi"))
    # lists of the same members are one list (count, both ends and two hashes of all ids agree)
    ends = ends.groupBy("lo", "hi", "c", "x", "y").agg(F.min("key").alias("key"))
    return members.join(ends.select("key").hint("shuffle_hash"), "key").distinct()


def resolve(members: DataFrame, fetch: Callable[[DataFrame], DataFrame], num: int, den: int,
            decode: Decode = stored, copies: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``(id, component)`` of every id linked with another one.

    ``fetch(ids)`` returns the :data:`SETS` rows of the given ids; ``decode``
    turns payloads into the sorted, distinct elements.  ``copies(ids)``, where sets
    may be equal, returns ``(id, one, copies)``: the smallest of the ids that have the
    same set, and how many these are; that one stands for them all.  Ids without a
    link are absent from the result.
    """
    with scratch(members.sparkSession):
        shared = staged(_lists(members), "shared")
        if copies is None:
            return staged(_resolved(shared, fetch, num, den, decode), "comps", keep=True)
        same = staged(copies(shared.select("id").distinct()), "copies")
        met = staged(shared.join(same, "id").select("key", F.col("one").alias("id")).distinct(), "met")
        shared = staged(_lists(met), "shared")
        comps = _resolved(shared, fetch, num, den, decode).withColumnRenamed("id", "one")
        return staged(same.join(comps, "one", "left").where("component is not null or copies > 1")
                      .select("id", F.coalesce("component", "one").alias("component")), "comps", keep=True)


def _resolved(shared: DataFrame, fetch: Callable[[DataFrame], DataFrame], num: int, den: int,
              decode: Decode) -> DataFrame:
    sets = staged(fetch(shared.select("id").distinct()), "sets")
    length = shared.groupBy("key").agg(F.count("*").alias("c"))
    weight = shared.join(length, "key").groupBy("id").agg(F.sum("c").alias("w"))
    hubs = (shared.join(weight, "id").groupBy("key")
            .agg(F.max_by("id", F.struct(F.col("w"), -F.col("id"))).alias("hub")))
    together = (shared.join(hubs, "key").where("id != hub")
                .groupBy("id", "hub").agg(F.count("*").alias("lists")))
    pivot = together.groupBy("id").agg(F.max_by("hub", F.struct(F.col("lists"), -F.col("hub"))).alias("b"))
    first = staged(verify(pivot.select(F.col("id").alias("a"), "b"), sets, num, den, decode), "first")
    comps, lists = components(first), shared
    cand = staged(_candidates(lists, comps, sets, num, den, decode, BEST), "cand")
    pairs = cand.where("a is not null").select("a", "b")
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    more = staged(verify(pairs.distinct(), sets.mapInArrow(_among(_marks(ends)), sets.schema), num, den, decode), "links")
    comps = _joined(comps, more)
    left_out = cand.where("open is not null").select(F.col("open").alias("key")).distinct()
    if left_out.isEmpty():
        return comps
    lists = lists.join(left_out, "key", "left_semi")
    more = staged(_candidates(lists, comps, sets, num, den, decode, None).select("a", "b").distinct(), "links")
    return _joined(comps, more)


def _joined(comps: DataFrame, more: DataFrame) -> DataFrame:
    """Components after further links: the components known so far are the nodes of the
    graph that is left, so only the new links are walked again."""
    if more.isEmpty():
        return comps
    ends = (more.select(F.col("a").alias("id")).union(more.select("b")).distinct().join(comps, "id", "left")
            .select("id", F.coalesce("component", "id").alias("component"), F.col("component").isNull().alias("fresh")))
    ends = staged(ends, "ends")
    nodes = [ends.select(F.col("id").alias(x), F.col("component").alias(f"c{x}")) for x in "ab"]
    up = components(more.join(nodes[0], "a").join(nodes[1], "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    every = comps.select("id", "component").unionByName(ends.where("fresh").select("id", "component"))
    return staged(every.join(up.select(F.col("id").alias("component"), F.col("component").alias("up")), "component", "left")
                  .select("id", F.coalesce("up", "component").alias("component")), "comps")


def _candidates(lists: DataFrame, comps: DataFrame, sets: DataFrame, num: int, den: int,
                decode: Decode, best: int | None) -> DataFrame:
    """The rows of :func:`_tiles` for the lists that hold several components.  With
    ``best`` the blocks of a list are compared each for itself, and a list of more
    than one block has pairs left out."""
    marked = staged(lists.join(comps, "id", "left")
                    .join(sets.select("id", F.octet_length("payload").alias("size")), "id")
                    .select("key", "id", F.coalesce("component", "id").alias("comp"), "size"), "marked")
    # the candidates of a list are its members outside the largest component
    by_comp = marked.groupBy("key", "comp").agg(F.count("*").alias("c"), F.sum("size").alias("size"))

    def blocks(rows, size):
        return F.ceil(F.greatest(rows / TILE, size / TILE_BYTES)).cast("int")

    largest = F.max_by(F.struct("comp", "c", "size"), F.struct("c", "comp"))
    mixed = (by_comp.groupBy("key")
             .agg(largest.alias("main"), F.sum("c").alias("all"), F.sum("size").alias("size"), F.count("*").alias("comps"))
             .where("comps > 1")
             .select("key", F.col("main.comp").alias("main"), blocks(F.col("all"), F.col("size")).alias("np"),
                     blocks(F.col("all") - F.col("main.c"), F.col("size") - F.col("main.size")).alias("nq")))
    mixed = staged(mixed, "mixed")
    rows = (marked.drop("size").join(mixed, "key")
            .withColumn("p", F.pmod(F.xxhash64("id"), F.col("np")).cast("int"))
            .withColumn("q", F.when(F.col("comp") != F.col("main"),
                                    F.pmod(F.xxhash64("id", F.lit(1)), F.col("nq")).cast("int"))))
    rows = staged(rows, "rows")
    wanted = _marks(rows.select("id"))      # the sets of other ids are met by no row
    if best is None:
        # a resident meets every block of visitors, a visitor every block of residents
        res = rows.select("key", "id", "comp", "p", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("q"),
                          F.lit(True).alias("resident"), F.lit(False).alias("visitor"))
        vis = rows.where("q is not null").select(
            "key", "id", "comp", F.explode(F.sequence(F.lit(0), F.col("np") - 1)).alias("p"), "q",
            F.lit(False).alias("resident"), F.lit(True).alias("visitor"))
        met = (res.unionByName(vis).groupBy("key", "p", "q", "id", "comp")
               .agg(F.max("resident").alias("resident"), F.max("visitor").alias("visitor")))
        signs = sets.mapInArrow(_signer(decode, wanted, True), "id long, n long, bits binary, payload binary")
    else:
        met = rows.select("key", "p", F.lit(0).alias("q"), "id", "comp", F.lit(True).alias("resident"),
                          F.col("q").isNotNull().alias("visitor"))
        signs = sets.mapInArrow(_signer(decode, wanted), "id long, n long, bits binary")
    tiles = (met.join(signs, "id")
             .select("key", "p", "q", "id", "comp", *signs.columns[1:], "resident", "visitor")
             .repartition("key", "p", "q").sortWithinPartitions("key", "p", "q"))
    found = tiles.mapInArrow(_tiles(num, den, best, decode), _CAND)
    if best is None:
        return found
    none = F.lit(None).cast("long")
    return found.unionByName(mixed.where("np > 1").select(none.alias("a"), none.alias("b"), F.col("key").alias("open")))
