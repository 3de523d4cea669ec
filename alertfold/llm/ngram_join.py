"""Jaccard join on sets of word n-grams, by vertical partitioning.

All n-grams have one global order (that of their 64-bit hashes), which pivots cut into
fragments.  A document's set falls into one segment per fragment, and everything that
counts common n-grams does so fragment by fragment and sums the partial counts.

1. **Sets.**  A document's set gets an id, the hash of the whole set, so that documents
   with equal sets are one set from here on, however many they are.
2. **Document counts by fragment.**  A fragment's task sees all segments in its range and
   counts how often each n-gram comes.  An n-gram of one set alone is in no overlap and
   goes no further.  The other segments' sizes, summed per set, bound its overlap with any
   other; sets that fall short of the threshold are linked with nothing and end here.
3. **Candidates.**  The remaining n-grams of a set are put in order of their counts, rare
   ones first.  Two linked sets share one of their first few (prefix filter), and sizes
   and the position of the shared n-gram bound the overlap further.  First each n-gram's
   list is compared with two of its members only, in a few rounds, and the links found
   make components.  Then all pairs that share a list but no component yet pass the same
   filters; so a group of copies costs a few pairs per member, not all its pairs, and
   still no link between two components is missed.
4. **Verification.**  Candidate pairs meet their segments in every fragment; the partial
   overlaps are summed per pair and held against the threshold, in whole numbers.

Words are what ``bytes.split`` separates, A-Z lower-cased.  With fewer words than n the
whole sequence is one n-gram; texts that are NULL or without words have the empty set and
are linked with nothing.  Rows with a NULL id get a NULL component and link nothing.  Rows
that repeat an id are the same node.  An empty table gives no rows; other columns are
ignored.  Sets and n-grams are told apart by their 64-bit hashes.

An n-gram that ``HOT`` sets or more of one haul (a reading task's batch of sets) share goes to
its fragment once, with its count, and its owners wait with the haul's other results; so a
fragment's task holds at most ``HOT`` entries per haul of one n-gram, however common.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertfold.llm.common import cut, fresh, written
from alertfold.llm.components import components
from alertfold.llm.exact_dedup import one_of_each

FRAGMENT_GRAMS = 500_000   # n-grams that a fragment's task holds, about
HAUL_GRAMS = 2_000_000     # n-grams, and sets, that a reading task gathers before it deals them out
HAUL_SETS = 60_000
ROUNDS = 3                 # at most so many rounds of two members per list
CHECK_FRAGMENTS = 4        # fragments of the verification
SALTS = 16
HOT = 256                  # sets of a haul that make an n-gram travel as a count
COUNTED = 0xFFFF           # the owner of such an entry; hauls hold fewer sets


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the text's n-grams."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(n, len(words))
    last = len(words) - k + 1
    acc = _mix(h[:last] + np.uint64(k))
    for i in range(1, k):
        acc = _mix(acc + h[i:last + i])
    return np.unique(acc)


def set_id(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes(), seed=len(grams)) - (1 << 63)


def _describe(n: int):
    """(doc_id, text) batches -> doc_id, size and id of the set."""
    def run(batches):
        for batch in batches:
            sets = [gram_set(t.as_py(), n) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())],
                names=["doc_id", "n_shingles", "sid"])
    return run


def _deal(n: int, fragments: int):
    """(text) batches -> what a fragment's task needs.

    A reading task gathers some sets, a *haul*, and sends each fragment their n-grams in its
    range with the set's number in the haul; of a hash only the bytes that the fragment does
    not tell travel.  Groups from -1 to -fragments get the sets' ids,
    dealt by id, so that equal sets meet; groups below pass on the owners of hot n-grams.
    """
    def flush(held):
        if not held:
            return
        sids = np.array([s for s, _ in held], np.int64)
        sizes = np.array([len(g) for _, g in held], np.int64)
        haul = xxhash.xxh3_64_intdigest(sids.tobytes()) >> 1
        grams = np.concatenate([g for _, g in held])
        owner = np.repeat(np.arange(len(held), dtype=np.uint16), sizes)
        order = np.argsort(grams, kind="stable")
        begins = np.flatnonzero(np.r_[True, grams[order][1:] != grams[order][:-1]])
        times = np.diff(np.r_[begins, len(grams)])
        hot = np.empty(len(grams), bool)
        hot[order] = np.repeat(times >= HOT, times)
        if hot.any():
            counted = grams[order][begins[times >= HOT]]
            yield from _packed(_fragment(counted, fragments), haul, np.full(len(counted), COUNTED, np.uint16),
                               _low(counted, fragments), times[times >= HOT])
            aside = np.full(int(hot.sum()), -1 - fragments - haul % fragments, np.int32)
            yield from _packed(aside, haul, owner[hot], grams[hot])
            grams, owner = grams[~hot], owner[~hot]
        yield from _packed(_fragment(grams, fragments), haul, owner, _low(grams, fragments))
        group = -1 - (sids.astype(np.uint64) % np.uint64(fragments)).astype(np.int32)
        yield from _packed(group, haul, np.arange(len(held), dtype=np.uint16), sids, sizes)

    def run(batches):
        held, total, seen = [], 0, set()
        for batch in batches:
            for text in batch.column(0):
                grams = gram_set(text.as_py(), n)
                if not len(grams):
                    continue
                sid = set_id(grams)
                if sid in seen:  # equal sets: once per haul
                    continue
                seen.add(sid)
                held.append((sid, grams))
                total += len(grams)
                if total >= HAUL_GRAMS or len(held) >= HAUL_SETS:
                    yield from flush(held)
                    held, total, seen = [], 0, set()
        yield from flush(held)
    return run


_PACK = pa.schema([("grp", pa.int32()), ("haul", pa.int64()), ("owners", pa.binary()), ("a", pa.binary()),
                   ("b", pa.binary())])
_PACK_DDL = "grp int, haul long, owners binary, a binary, b binary"
_SETS_DDL = "sid long, n long, shared long, weight long, prefix array<long>, segments array<array<long>>"


def _fragment(grams: np.ndarray, fragments: int) -> np.ndarray:
    """Pivots at equal steps of the hash order."""
    return ((grams >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int32)


def _bytes_sent(fragments: int) -> int:
    """Of a hash's eight bytes those that a fragment (of a power of two of them) does not tell."""
    return 8 - (fragments.bit_length() - 1) // 8


def _low(grams: np.ndarray, fragments: int) -> np.ndarray:
    return np.ascontiguousarray(grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_bytes_sent(fragments)])


def _whole(low: bytes, fragment: int, fragments: int) -> np.ndarray:
    """The hashes again: the fragment's number is their highest bits."""
    sent, bits = _bytes_sent(fragments), fragments.bit_length() - 1
    out = np.zeros((len(low) // sent, 8), np.uint8)
    out[:, :sent] = np.frombuffer(low, np.uint8).reshape(len(out), -1)
    above = (fragment << 64 - bits) >> 8 * sent << 8 * sent
    return out.view("<u8").reshape(-1).astype(np.uint64) | np.uint64(above)


def _packed(group: np.ndarray, haul, owner: np.ndarray, a: np.ndarray, b: np.ndarray | None = None):
    """Rows of packed columns, one for each group (and haul, where that is an array)."""
    order = np.argsort(group, kind="stable")
    at = group[order]
    bounds = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, int)
    for lo, hi in zip(bounds, np.r_[bounds[1:], len(at)].astype(int)):
        rows = order[lo:hi]
        yield pa.RecordBatch.from_pylist([{
            "grp": int(at[lo]), "haul": int(haul), "owners": owner[rows].tobytes(), "a": a[rows].tobytes(),
            "b": None if b is None else b[rows].tobytes()}], schema=_PACK)


def _count(fragments: int):
    """A fragment: n-grams of two sets or more, back to their hauls with a rank that rises
    with their count.  A group of ids: of equal sets, the one that stands for them.  Owners of
    hot n-grams: as they came."""
    def run(key, table):
        group = key[0].as_py()
        if group < -fragments:
            return table
        hauls, owners = table.column("haul").to_pylist(), table.column("owners").to_pylist()
        first, second = table.column("a").to_pylist(), table.column("b").to_pylist()
        sizes = [len(o) // 2 for o in owners]
        ends = np.cumsum(sizes)
        owner = np.frombuffer(b"".join(owners), np.uint16)
        if group >= 0:
            a = _whole(b"".join(first), group, fragments)
            weight = np.concatenate([np.ones(n, np.int64) if x is None else np.frombuffer(x, np.int64)
                                     for n, x in zip(sizes, second)])
            _, inverse = np.unique(a, return_inverse=True)
            count = np.bincount(inverse, weights=weight)
            rank = np.minimum(255, np.floor(8 * np.log2(count))).astype(np.uint8)
            keep, b = count[inverse] > 1, rank[inverse]
        else:
            a = np.frombuffer(b"".join(first), np.int64)
            b = np.frombuffer(b"".join(second), np.int64)
            place = np.repeat(np.array(hauls), sizes)
            order = np.lexsort((owner, place, a))
            keep = np.zeros(len(a), bool)
            keep[order[np.r_[True, a[order][1:] != a[order][:-1]]] if len(a) else []] = True
        rows = []
        for haul, hi, size in zip(hauls, ends, sizes):
            part = np.arange(hi - size, hi)
            part = part[keep[part]]
            if len(part):
                rows.append({"grp": group, "haul": haul, "owners": owner[part].tobytes(), "a": a[part].tobytes(),
                             "b": b[part].tobytes()})
        return pa.Table.from_pylist(rows, schema=_PACK)
    return run


def _gather(num: int, den: int, fragments: int):
    """A haul: sum the partial counts of each set; keep the sets that can reach the threshold."""
    cuts = min(CHECK_FRAGMENTS, fragments)

    def run(table: pa.Table) -> pa.Table:
        group = np.array(table.column("grp").to_pylist())
        owners, a, b = (table.column(c).to_pylist() for c in ("owners", "a", "b"))

        def joined(parts, kind, wanted):
            return np.frombuffer(b"".join(x for x, w in zip(parts, wanted) if w), kind)

        of_gram, of_set, aside = group >= 0, (group < 0) & (group >= -fragments), group < -fragments
        owner, grams, rank = joined(owners, np.uint16, of_gram), joined(a, np.uint64, of_gram), joined(b, np.uint8, of_gram)
        counted = owner == COUNTED
        if counted.any():
            # the ranks of hot n-grams meet their owners
            order = np.argsort(grams[counted])
            known_hot, hot_rank = grams[counted][order], rank[counted][order]
            hot = joined(a, np.uint64, aside)
            at = np.searchsorted(known_hot, hot)
            owner = np.r_[owner[~counted], joined(owners, np.uint16, aside)]
            grams, rank = np.r_[grams[~counted], hot], np.r_[rank[~counted], hot_rank[at]]
        known = np.full(1 << 16, -1, np.int64)   # number in the haul -> place among the sets that stand
        stands, sids, size = joined(owners, np.uint16, of_set), joined(a, np.int64, of_set), joined(b, np.int64, of_set)
        known[stands] = np.arange(len(stands))
        at = known[owner]
        shared = np.bincount(at[at >= 0], minlength=len(sids))
        need = -(-num * size // den)
        able = np.r_[shared >= need, False]      # the last place is that of sets that do not stand
        keep = able[at]
        grams, rank, at = grams[keep], rank[keep], at[keep]
        order = np.lexsort((grams, rank, at))
        grams, rank, at = grams[order], rank[order], at[order]
        chosen = np.flatnonzero(able)
        ends = np.searchsorted(at, chosen, "right")
        out: dict[str, list] = {"sid": [], "n": [], "shared": [], "weight": [], "prefix": [], "segments": []}
        # how common a set's n-grams are on the whole: highest for what others were copied from
        weight = np.bincount(at, weights=rank, minlength=len(sids) + 1)[:len(sids)] * 1000 // np.maximum(size, 1)
        numbers, part_of = grams.view(np.int64), _fragment(grams, cuts)
        lo = 0
        for k, hi in zip(chosen, ends):
            own, part = numbers[lo:hi], part_of[lo:hi]
            lo = hi
            out["weight"].append(int(weight[k]))
            out["sid"].append(int(sids[k]))
            out["n"].append(int(size[k]))
            out["shared"].append(int(shared[k]))
            out["prefix"].append(own[:shared[k] - need[k] + 1])
            out["segments"].append([own[part == f] for f in range(cuts)])
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), (
            pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))))})
    return run


def _can_link(num: int, den: int):
    """Filters on an n-gram that two sets share at positions pos_a, pos_b of their orders."""
    need = F.ceil(num * (F.col("n_a") + F.col("n_b")) / F.lit(num + den))
    # n-grams before the first shared one are shared with nobody of the two
    rest = F.least(F.col("shared_a") - F.col("pos_a"), F.col("shared_b") - F.col("pos_b"))
    return ((den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b")) & (rest >= need))


def _verify(pairs: DataFrame, segments: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that reach the threshold: partial overlaps by fragment, summed per pair."""
    left = segments.select(F.col("sid").alias("a"), F.col("n").alias("n_a"), "frag", F.col("seg").alias("seg_a"))
    right = segments.select(F.col("sid").alias("b"), F.col("n").alias("n_b"), "frag", F.col("seg").alias("seg_b"))
    partial = (pairs.join(left, "a").join(right, ["b", "frag"])
               .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("seg_a", "seg_b")).alias("part")))
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("part").alias("common"))
    union = F.col("n_a") + F.col("n_b") - F.col("common")
    return total.filter(den * F.col("common") >= num * union).select("a", "b", "common", union.alias("union"))


def near_groups(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for documents linked when
    ``den * |intersection| >= num * |union|``; the component's name is its smallest id."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    described = cut(source.mapInArrow(_describe(n), f"doc_id {id_type}, n_shingles bigint, sid bigint"))
    sets = cut(described.filter("sid IS NOT NULL").groupBy("sid")
               .agg(F.min("doc_id").alias("rep"), F.count("*").alias("docs")).filter("rep IS NOT NULL"))
    links = set_links(source.filter("doc_id IS NOT NULL").select("text"), described, n, num, den)
    rep_of = sets.select("sid", "rep")
    named = (links.join(rep_of.withColumnsRenamed({"sid": "a", "rep": "rep_a"}), "a")
             .join(rep_of.withColumnsRenamed({"sid": "b", "rep": "rep_b"}), "b")
             .select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    comp = components(named)
    # sets of one document without links keep their own id and need no lookup
    looked_up = (sets.join(comp, sets.rep == comp.node, "left").filter("docs > 1 OR component IS NOT NULL")
                 .select("sid", F.coalesce("component", "rep").alias("component_id"),
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = described.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return (salted.join(looked_up, ["sid", "salt"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def drop_near_copies(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One document of each component, with all its columns: that with the smallest id, a NULL id
    last.  Rows that repeat an id are documents of their own, told apart by their texts; rows
    that repeat an id and its text are one.  Texts without words are linked with nothing.
    Columns may have any names."""
    none, ident, digest, whole, times = fresh(docs, "_none", "_ident", "_digest", "_whole_row", "_times")
    key = [F.col(id_col).isNull().alias(none), F.col(id_col).alias(ident), F.md5(F.coalesce(text_col, F.lit(""))).alias(digest)]
    names = (none, ident, digest)
    keyed = docs.select(F.struct(*key).alias("doc_id"), F.col(text_col).alias("text"))
    groups = cut(near_groups(keyed, n, num, den).select("doc_id", "component_id").groupBy("doc_id", "component_id")
                 .agg(F.count("*").alias(times)))
    gone = groups.filter("doc_id <> component_id").select("doc_id.*")
    repeated = groups.filter((F.col("doc_id") == F.col("component_id")) & (F.col(times) > 1)).select("doc_id.*")

    def same(keys: DataFrame):
        of = [c.alias(f"{k}_of") for c, k in zip((keys[none], keys[ident], keys[digest]), names)]
        keys = keys.select(*of)
        left = docs.select("*", *key)
        hit = F.lit(True)
        for k in names:
            hit = hit & left[k].eqNullSafe(keys[f"{k}_of"])
        return left, keys.hint("shuffle_hash"), hit

    left, keys, hit = same(gone.unionByName(repeated))
    out = left.join(keys, hit, "left_anti").select(*[left[c] for c in docs.columns])
    if repeated.isEmpty():
        return out
    left, keys, hit = same(repeated)
    rows = left.join(keys, hit, "left_semi")
    return out.unionByName(one_of_each(rows, [F.col(k) for k in names], docs.columns, whole))


def set_links(texts: DataFrame, described: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links ``a, b`` between set ids: a forest or more of each component's links, enough
    for every component to hold together."""
    grams = described.agg(F.sum("n_shingles")).first()[0] or 0
    fragments = 1 << (max(1, -(-grams // FRAGMENT_GRAMS)) - 1).bit_length()
    shared = texts.mapInArrow(_deal(n, fragments), _PACK_DDL).groupBy("grp").applyInArrow(_count(fragments), _PACK_DDL)
    able = cut(shared.groupBy("haul").applyInArrow(_gather(num, den, fragments), _SETS_DDL))
    segments = able.select("sid", "n", F.posexplode("segments").alias("frag", "seg"))
    lists = able.select(F.posexplode("prefix").alias("pos", "g"), "sid", "n", "shared", "weight", F.col("sid").alias("comp"))
    links = None

    # rounds: the lists whose members are not in one component yet, against two of their members
    for k in range(ROUNDS):
        lists = _mixed(lists)
        new = written(_verify(_star(lists, k, num, den), segments, num, den).select("a", "b"))
        if k and new.isEmpty():
            break
        links = new if links is None else written(links.unionByName(new))
        lists = _in_components(lists, links)

    # all pairs of a list that are still in two components
    lists = written(_mixed(lists))
    left, right = (lists.select("g", *[F.col(c).alias(f"{c}_{s}") for c in ("sid", "n", "shared", "pos", "comp")])
                   for s in "ab")
    rest = (left.join(right, (left.g == right.g) & (F.col("sid_a") < F.col("sid_b"))
                      & (F.col("comp_a") != F.col("comp_b")) & _can_link(num, den))
            .select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b")).distinct())
    return written(links.unionByName(_verify(rest, segments, num, den).select("a", "b")))


def _mixed(lists: DataFrame) -> DataFrame:
    """The lists with members of two components or more."""
    mixed = (lists.groupBy("g").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
             .filter("c0 < c1").select(F.col("g").alias("mixed")))
    return lists.join(mixed, lists.g == F.col("mixed"), "left_semi")


def _in_components(lists: DataFrame, links: DataFrame) -> DataFrame:
    comp = components(links).select("node", F.col("component").alias("named"))
    return written(lists.join(comp, lists.sid == comp.node, "left")
                   .select("pos", "g", "sid", "n", "shared", "weight", F.coalesce("named", "sid").alias("comp")))


def _star(lists: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Pairs of each list's members with two of them, the one of the most common n-grams and
    one by a hash that changes with the round, where they are in different components and
    can link."""
    member = F.struct("sid", "n", "shared", "pos", "comp")
    ends = (lists.groupBy("g").agg(F.max_by(member, F.struct("weight", "sid")).alias("common"),
                                   F.max_by(member, F.struct(F.xxhash64(F.lit(k), "sid"), "sid")).alias("other"))
            .select(F.col("g").alias("of"), F.explode(F.array("common", "other")).alias("end")))
    met = lists.join(ends, lists.g == ends.of).filter(F.col("comp") != F.col("end.comp")).select(
        F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("shared_a"), F.col("pos").alias("pos_a"),
        F.col("end.sid").alias("b"), F.col("end.n").alias("n_b"), F.col("end.shared").alias("shared_b"),
        F.col("end.pos").alias("pos_b"))
    return met.filter(_can_link(num, den)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
