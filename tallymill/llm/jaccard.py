"""N-gram Jaccard join of whole documents: exact links of at least 0.8, as components.

Set relations are used to skip work:

* Equal sets are one class.
* Lists.  Shingles are put in one global order, rare ones first (from a count sketch of fixed size; any
  order is exact).  Two linked sets share a shingle of their prefixes, the first fifth.  A list
  holds the classes with a shingle in the prefix, with size and position; members whose size or position
  rules a link out are skipped.
* Stars.  In each list members are compared with one leader only.  The size of the symmetric difference
  is a metric: for a member x of leader A and y of leader B, d(x, y) >= d(A, B) - d(x, A) - d(y, B).
  So what is known of the leaders skips or settles their members.  Leaders of lists that still touch several
  components are compared, and members only where the leaders' distance leaves a link possible.

* Signatures.  A class has 512 bits, each the parity of its shingles that a hash sends there.  Bits in which two
  classes differ are at most as many as the shingles in which they do.  So leaders that share a shingle by chance, as texts around
  common passages do, are skipped where they meet and never written or read, up to some thousand shingles each.

No list is held by a task as a whole.  Pairs of members are not written out; pairs of a list's leaders are, where sizes,
positions and signatures leave a link possible.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import MOST_BROADCAST_KEYS, ROWS_AT_A_TIME, free_name, hinted, id_and_text, named, row_keyed, stored, stored_alone
from tallymill.llm.components import connected
from tallymill.llm.shingles import Shingler, set_key

# Counters of the sketch (fixed, whatever the input), and how many of them a row carries.
COUNTERS = 1 << 22
PART = 1 << 16
SHIFT = np.uint64(64 - 22)
# Longs of a signature (a power of two), and members of a list from which on its leaders are compared by signatures first.
SIGNATURE, CROWDED = 8, 32
# A list of more members than this is cut into several with a leader each.
LIST_MEMBERS = 50_000
# Ids are broadcast up to this number (8 bytes each); beyond it texts are shuffled to them.
MOST_BROADCAST = 1_000_000
# What is known of classes (some 40 bytes each) is broadcast to the lists up to this number; beyond it lists are shuffled to it.
MOST_KNOWN = 500_000


def prefix_length(n: int) -> int:
    """Linked sets of which one has ``n`` members share one of the first so many."""
    return n - (4 * n + 4) // 5 + 1


def _parts(batch: pa.RecordBatch) -> Iterator[list[list]]:
    for start in range(0, batch.num_rows, ROWS_AT_A_TIME):
        yield [column.to_pylist() for column in batch.slice(start, ROWS_AT_A_TIME).columns]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Parities of the numbers of shingles by their leading bits, as longs."""
    bits = 64 * SIGNATURE
    counts = np.bincount((shingles >> np.uint64(65 - bits.bit_length())).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _differing(x: str, y: str) -> str:
    """SQL for the number of bits in which two rows' signatures differ; ``{}`` stands for a long's number."""
    return " + ".join(f"bit_count({x.format(k)} ^ {y.format(k)})" for k in range(SIGNATURE))


PROFILE = "doc_id long, row long, n int, a long, b long, part int, counts binary"


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and key of each document's set, and the task's share of the sketch behind them."""
    shingler, counters = Shingler(), np.zeros(COUNTERS, np.int32)  # of one task

    def rows(ids, marks, sizes, keys, parts, counts):
        arrays = [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(sizes, pa.int32()), *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1))]
        arrays += [pa.array(parts, pa.int32()), pa.array(counts, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "row", "n", "a", "b", "part", "counts"])
    for batch in batches:
        for texts, ids, marks in _parts(batch):
            sets = [shingler(t) for t in texts]
            joined = np.concatenate(sets)
            np.add.at(counters, joined >> SHIFT, 1)
            none = [None] * len(ids)
            yield rows(ids, marks, [len(s) for s in sets], [set_key(s) for s in sets], none, none)
    for k in range(0, COUNTERS, PART):
        counts = counters[k:k + PART]
        if counts.any():
            yield rows([None], [None], [None], [(None, None)], [k // PART], [zlib.compress(counts.astype("<i8").tobytes(), 1)])


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the shares of the sketch that came to this task, one at a time."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = np.frombuffer(zlib.decompress(counts), "<i8")
            totals[part] = totals[part] + found if part in totals else found
    for part, counts in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([counts.astype("<i8").tobytes()], pa.binary())], names=["part", "counts"])


def _sketch(profiles: DataFrame) -> tuple[np.ndarray, dict[int, int]]:
    """Ranks by frequency by counter (4 MB, whatever the input), and into how many lists those of few counters are cut."""
    shares = profiles.where("part is not null").select("part", "counts").repartition("part")
    totals = np.zeros(COUNTERS, np.int64)
    for row in shares.mapInArrow(_sum_parts, "part int, counts binary").toLocalIterator():
        totals[row["part"] * PART:(row["part"] + 1) * PART] += np.frombuffer(row["counts"], "<i8")
    noise = 2 * totals.mean()
    ranks = np.round(6 * np.log2(totals + 1.0)).clip(0, 255).astype(np.uint8)
    parts = np.ceil((totals - noise) / LIST_MEMBERS).clip(1, 30_000).astype(np.int64)
    # At most total / LIST_MEMBERS lists, and no more than counters, are that long.
    return ranks, {int(k): int(parts[k]) for k in np.flatnonzero(parts > 1)}


def _index(sketch):
    """Prefixes of the classes, rarest shingles first; a task gives equal sets once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(), set()
        ranks, long_lists = sketch.value
        cuts = np.ones(COUNTERS, np.int16)
        cuts[list(long_lists)] = list(long_lists.values())
        for batch in batches:
            for texts, *_ in _parts(batch):
                keys, sizes, prefixes, signatures = [], [], [], []
                for text in texts:
                    members = shingler(text)
                    n = len(members)
                    # Different sets of up to three members and another size are never linked.
                    if n < 4 or (key := set_key(members)) in seen:
                        continue
                    seen.add(key)
                    length = prefix_length(n)
                    first = np.lexsort((members, ranks[members >> SHIFT]))[:length]
                    keys.append(key)
                    sizes.append(n)
                    prefixes.append(members[first])
                    signatures.append(signature(members))
                flat = np.concatenate([*prefixes, np.zeros(0, np.uint64)])
                ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
                owners = np.repeat(np.array([k[0] for k in keys], np.int64), np.diff(ends))
                parts = cuts[flat >> SHIFT]
                salts = np.where(parts > 1, owners.view(np.uint64) % parts.astype(np.uint64), -1).astype(np.int16)
                yield pa.RecordBatch.from_arrays([
                    *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)), pa.array(sizes, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(salts)),
                    *(pa.array([x[k] for x in signatures], pa.int64()) for k in range(SIGNATURE)),
                ], names=["a", "b", "n", "tokens", "salts", *(f"s{k}" for k in range(SIGNATURE))])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes' sets, from the texts that have the classes' keys."""
    shingler = Shingler()
    for batch in batches:
        for texts, classes, *keys in _parts(batch):
            made = [(c, s) for c, *key, s in zip(classes, *keys, map(shingler, texts)) if set_key(s) == tuple(key)]
            ends = np.concatenate([[0], np.cumsum([len(s) for _, s in made])]).astype(np.int32)
            values = pa.array(np.concatenate([*(s for _, s in made), np.zeros(0, np.uint64)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in made], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), values)], names=["c", "members"])


def _possible(n, m, at, to) -> F.Column:
    """May sets of sizes ``n``, ``m`` be linked if their first common shingle is at ``at`` and ``to``?"""
    left = F.least(n - at, m - to) + 1
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * left >= 4 * (n + m))


def _compared(pairs: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` (``x``, ``y``) with the size of their sets' symmetric difference, ``apart``.

    Only the documents that stand for these classes are read again.  Of the tables written on the way none stays.
    """
    def made() -> DataFrame:
        kept = stored(pairs, "pairs")
        wanted = kept.select(F.explode(F.array("x", "y")).alias("c")).distinct().join(classes.select("c", "a", "b", "rep"), "c")
        wanted = stored(wanted, "wanted")
        wanted = F.broadcast(wanted) if wanted.count() <= MOST_BROADCAST else wanted
        chosen = texts.join(wanted, texts.row == F.col("rep")).select("text", "c", "a", "b").mapInArrow(_sets, "c long, members array<long>")
        # Repeated rows give their class's set again.
        sets = stored(chosen.dropDuplicates(["c"]), "sets")
        left, right = sets.select(F.col("c").alias("x"), F.col("members").alias("of_x")), sets.select(F.col("c").alias("y"), F.col("members").alias("of_y"))
        common, both = F.size(F.array_intersect("of_x", "of_y")), F.size("of_x") + F.size("of_y")
        return kept.join(left, "x").join(right, "y").select("x", "y", (both - 2 * common).alias("apart"), both.alias("both"))
    return stored_alone(made, "compared")


def components(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links) for each row.

    Two documents are linked if 100 * common >= 80 * all distinct shingles of five words; a text of fewer
    words is one shingle.  A text without words has no shingles, is linked with nothing and is its own
    component.  Repeated rows are equal documents.  A null id is never the smallest unless all are null.
    """
    texts = id_and_text(docs, id_col, text_col).select("text", "doc_id", F.xxhash64("doc_id", "text").alias("row"))
    profiles = stored(texts.mapInArrow(_profiles, PROFILE), "profiles")
    sized = profiles.where("part is null").select("doc_id", "row", "n", "a", "b")
    if sized.where("n > 3").isEmpty():
        return _labelled(sized, None)
    sketch = docs.sparkSession.sparkContext.broadcast(_sketch(profiles))
    signatures = ", ".join(f"s{k} long" for k in range(SIGNATURE))
    index = texts.mapInArrow(_index(sketch), f"a long, b long, n int, tokens array<long>, salts array<short>, {signatures}")
    index = stored(index.dropDuplicates(["a", "b"]).withColumn("c", F.monotonically_increasing_id()), "index")
    firsts = sized.groupBy("a", "b").agg(F.min("row").alias("rep"), F.min("doc_id").alias("first_id"))
    classes = stored(index.select("c", "a", "b", "n").join(firsts, ["a", "b"]), "classes")
    entries = index.select("c", "n", F.posexplode(F.arrays_zip("tokens", "salts")).alias("at", "entry")).select(
        F.col("entry.tokens").alias("token"), F.col("entry.salts").alias("salt"), "c", "n", (F.col("at") + 1).alias("at"))
    return _labelled(sized, _join(entries, classes, texts, index.select("c", *(f"s{k}" for k in range(SIGNATURE)))))


def _join(entries: DataFrame, classes: DataFrame, texts: DataFrame, signed: DataFrame | None = None) -> DataFrame:
    """``a``, ``b``, ``label`` of the classes that are linked with another; without signatures no list is screened by them."""
    from pyspark.sql import Window

    # Lists of one member are dropped, unless they are a part (salt from 0) of a list that was cut.
    # The leader is the member that has fewest rarer shingles: the one that others were copied from, where it
    # is there.  Copies changed so much that they are no longer linked with it have so many rare shingles
    # before this one that their position rules them out.
    ordered = Window.partitionBy("token", "salt").orderBy("at", "n", "c")
    following = F.lead("c").over(ordered)
    lists = entries.withColumns({
        "leader": F.first("c").over(ordered), "leader_n": F.first("n").over(ordered), "leader_at": F.first("at").over(ordered), "more": following,
    }).where((F.col("leader") != F.col("c")) | F.col("more").isNotNull() | (F.col("salt") >= 0)).drop("more")
    lists = stored(lists, "lists")
    first = lists.where("leader != c").where(_possible(F.col("n"), F.col("leader_n"), F.col("at"), F.col("leader_at")))
    near = _compared(first.select(F.col("c").alias("x"), F.col("leader").alias("y")).distinct(), texts, classes)
    links = near.where("9 * apart <= both").select("x", "y", "apart")
    star = links.groupBy("x").agg(F.min(F.struct(F.col("y").alias("star"), F.col("apart"))).alias("s")).select(F.col("x").alias("c"), "s.star", "s.apart")
    label = stored_alone(lambda: connected(links.select("x", "y")), "labels")
    known = stored(classes.select("c").join(star, "c", "left").join(label, "c", "left").select(
        "c", F.coalesce("star", "c").alias("star"), F.coalesce("apart", F.lit(0)).alias("apart"), F.coalesce("label", "c").alias("label")), "stars")
    # Where no shuffle is needed, a task still has whole lists, and what is found of them is one row each.
    rest = lists.select("token", "c", "n", "at").join(hinted(known, MOST_KNOWN), "c")
    open_tokens = rest.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), (F.count(F.lit(1)) > (2**62 if signed is None else CROWDED)).alias("crowded"))
    rest = stored(rest.join(open_tokens.where("low < high").select("token", "crowded"), "token"), "rest")
    by_star = stored(rest.groupBy("token", "crowded", "star", "label").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("at").alias("at"), F.max(F.col("apart") + F.lit(0)).alias("radius")), "by-star")
    # Of few stars all pairs are few; of many those are left out that signatures rule out.
    signatures = [F.col(f"s{k}") for k in range(SIGNATURE)]
    lists_of = [(by_star.where("not crowded"), "true")]
    if signed is not None:
        many = by_star.where("crowded").join(signed.select(F.col("c").alias("star"), *signatures), "star")
        lists_of.append((many, f"9 * ({_differing('x.s{}', 'y.s{}')} - x.radius - y.radius) <= x.most + y.most"))
    by_token = None
    for stars, unlike in lists_of:
        pair = stars.alias("x").join(stars.alias("y"), "token").where("x.star < y.star and x.label != y.label and 5 * x.most >= 4 * y.least and 5 * y.most >= 4 * x.least")
        # Positions as favourable as the stars' members have them, at the largest sizes.
        pair = pair.where(f"9 * (1 + least(x.most - x.at, y.most - y.at)) >= 4 * (x.least + y.least) and {unlike}").select(
            "token", F.col("x.star").alias("x"), F.col("y.star").alias("y"), F.expr("x.radius + y.radius").alias("radii"), F.expr("x.most + y.most").alias("sizes"),
            F.col("y.least").alias("y_least"), F.col("y.most").alias("y_most"), F.col("y.at").alias("y_at"), F.col("y.radius").alias("y_radius"))
        by_token = pair if by_token is None else by_token.unionByName(pair)
    by_token = stored(by_token, "star-pairs")
    pair = stored(by_token.groupBy("x", "y").agg(F.max("radii").alias("radii"), F.max("sizes").alias("sizes")), "leaders")
    apart = _compared(pair.select("x", "y"), texts, classes)
    close = pair.join(apart, ["x", "y"]).where("9 * (apart - radii) <= sizes").select("x", "y", F.col("apart").alias("between"))
    close = stored(by_token.join(stored(close, "close"), ["x", "y"]), "close-pairs")
    # Members of one star that may be linked with any member of the other, then the other star's members.
    left, right = rest.alias("l"), rest.alias("r")
    within = (close.token == F.col("l.token")) & (F.col("x") == F.col("l.star")) & F.expr(
        "9 * (between - l.apart - y_radius) <= l.n + y_most and 5 * l.n >= 4 * y_least and 5 * y_most >= 4 * l.n"
        " and 9 * (1 + least(l.n - l.at, y_most - y_at)) >= 4 * (l.n + y_least)")
    some = stored(close.join(left, within).select("y", "between", "l.token", "l.c", "l.n", "l.at", "l.apart", "l.label"), "some").alias("l")
    both = (F.col("l.token") == F.col("r.token")) & (F.col("l.y") == F.col("r.star")) & F.expr(
        "l.label != r.label and 9 * (l.between - l.apart - r.apart) <= l.n + r.n")
    members = some.join(right, both & _possible(F.col("l.n"), F.col("r.n"), F.col("l.at"), F.col("r.at")))
    last = _compared(members.select(F.col("l.c").alias("x"), F.col("r.c").alias("y")).distinct(), texts, classes)
    final = stored_alone(lambda: connected(links.select("x", "y").union(last.where("9 * apart <= both").select("x", "y"))), "labels")
    # The smallest document of a component, not the smallest class number.
    named_by = final.join(classes, "c").groupBy("label").agg(F.min("first_id").alias("component_id"))
    return final.join(classes.select("c", "a", "b"), "c").join(named_by, "label").select("a", "b", "component_id")


def _labelled(sized: DataFrame, found: DataFrame | None) -> DataFrame:
    alone = sized.where("n > 0").groupBy("a", "b").agg(F.min("doc_id").alias("own"))
    if found is not None:
        alone = alone.join(found, ["a", "b"], "left").select("a", "b", F.coalesce("component_id", "own").alias("own"))
    alone = stored(alone, "alone")  # so that a hot class can be split in the join
    # Texts without words have one key too, but are not linked: they need no join.
    joined = sized.where("n > 0").join(alone, ["a", "b"]).select("doc_id", "n", "own")
    every = joined.unionByName(sized.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("own")))
    return every.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("own").alias("component_id"))


def keep_one(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each component the one with the smallest id (null ids last).

    Only the keys of the rows to drop outlast the call in the scratch folder.
    """
    key = free_name(docs, "row_key")
    keyed = row_keyed(docs, key)

    def dropped() -> DataFrame:
        found = stored(components(keyed, key, text_col).select(F.col("doc_id").alias("k"), "component_id"), "components")
        # Rows alone in their component stay whatever their id is.
        several = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id")
        grouped = found.join(several, "component_id")
        ranked = keyed.select(F.col(key).alias("k"), F.struct(named(id_col).isNull(), named(id_col), F.col(key)).alias("order")).join(grouped, "k")
        kept = ranked.groupBy("component_id").agg(F.min_by("k", "order").alias("k"))
        return grouped.select("k").join(kept, "k", "left_anti").select(F.col("k").alias(key))

    gone = stored_alone(dropped, "dropped")
    return keyed.join(hinted(gone, MOST_BROADCAST_KEYS), key, "left_anti").select(*map(named, docs.columns))
