"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets, stars.

A text is its set of distinct word shingles. One permutation deals the shingles to bins and each bin
keeps its smallest value; an empty bin borrows the value of another bin, found by a second hash that
is the same for every text (optimal densification), so short texts fill all bins too. Bands of bins make buckets.

In a bucket every member meets only the bucket's centre, and of its buckets' centres only the one it
shares most buckets with: a star of one edge a member instead of all pairs. A star alone could miss
two members that are linked with each other but not with the centre. So where a bucket's members are
still in several components afterwards, those outside its largest component meet the others, in
blocks: no link inside a bucket is lost, and buckets of one component (families of copies) are done
after the star. A pair may be a link if its sizes allow it and its signatures agree about as often as
linked texts do; it is looked at in the first bucket it shares. Blocks of signatures send on the
members of such pairs, in smaller blocks that hold their full sets; there every link is confirmed, and
only links that join something are sent: rows grow with the members, never with their pairs.

Equal sets are one node from the start. Two texts at the threshold share no bucket with probability
(1 - 0.85^6)^32 = 3e-7, and fall under the signatures' bound (five deviations) about as rarely.

Defined results: a NULL or wordless text has an empty set and is linked with nothing; a text of fewer
words than a shingle is one shingle; equal rows get equal results; a component's id is its smallest
doc_id (NULL only if all are NULL) and ``kept`` compares null-safely; no rows give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from worklens.llm.common import (
    bounded_batches, columns, few_rows, keep_rows, saved, slices, text_key, utf8,
)
from worklens.llm.simhash import components
from worklens.llm.spans import mix, span_hashes, words_of

SHINGLE = 3
#: A link: PERCENT of the union is in both.
PERCENT = 85
#: Bins, and those of a band; 8 bits of each bin's value are kept.
BINS, ROWS = 192, 6
#: Deviations by which signatures of linked texts may disagree more than expected.
DEVIATIONS = 5.0
#: Hashes of texts to compare that may be broadcast: 16 bytes each.
WANTED = 500_000
#: Members of a bucket that meet as many others in one task.
BLOCK = 4096
#: Shingles a member of a full block has on average; a block of longer sets has fewer members.
SHORT = 512

_STEP = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(2**64 - 1)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in order, and where each text's begin (one more)."""
    w = words_of([t.lower() for t in texts])  # of bytes: A-Z only
    n = np.diff(w.first)
    hashes = span_hashes(w.buf, w.start, w.end)
    # of each text one shingle at least, if it has a word; each of ``size`` words or of all there are
    count = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    text = np.repeat(np.arange(len(texts)), count)
    at = np.repeat(w.first[:-1] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(
        int(count.sum()))
    length = np.repeat(np.minimum(n, size), count)
    made = length.astype(np.uint64)
    for k in range(size):
        have = np.flatnonzero(length > k)
        made[have] = mix(made[have] * _STEP + hashes[at[have] + k])
    order = np.lexsort((made, text))
    made, text = made[order], text[order]
    new = np.ones(len(made), dtype=bool)
    new[1:] = (made[1:] != made[:-1]) | (text[1:] != text[:-1])
    made, text = made[new], text[new]
    return made, np.searchsorted(text, np.arange(len(texts) + 1))


def signatures(hashes: np.ndarray, first: np.ndarray, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """One row of ``bins`` values for each set, and which of them are the bin's own, not borrowed;
    sets must not be empty."""
    n = len(first) - 1
    drawn = mix(hashes + _STEP)
    place = ((drawn >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    flat = np.full(n * bins, _EMPTY, dtype=np.uint64)
    np.minimum.at(flat, np.repeat(np.arange(n), np.diff(first)) * bins + place,
                  drawn & np.uint64(0xFFFFFFFF))
    out = flat.copy()
    todo, turn = np.flatnonzero(flat == _EMPTY), 0
    while len(todo):  # a bin's turns name the same donors in every text
        donor = mix((todo % bins).astype(np.uint64) * _STEP + np.uint64(turn + 1))
        donor = todo - todo % bins + (mix(donor + _STEP) % np.uint64(bins)).astype(np.int64)
        got = flat[donor]
        out[todo] = got
        todo, turn = todo[got == _EMPTY], turn + 1
    return out.reshape(n, bins), (flat != _EMPTY).reshape(n, bins)


def packed(values: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Eight bits of each value, then a bit a bin: its own or borrowed."""
    return np.hstack(((values & np.uint64(0xFF)).astype(np.uint8), np.packbits(own, axis=1)))


def may_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
             percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(whether the packed signatures allow a link, share of bins that agree) of each pair.

    Only bins that either set fills itself count: they are a sample of the union without replacement,
    so their share is off by less than for borrowed ones, and hardly at all for short texts.
    """
    filled_a, filled_b = (np.unpackbits(x[..., BINS:], axis=-1, count=BINS).astype(bool) for x in (a, b))
    agree = ((a[..., :BINS] == b[..., :BINS]) & filled_a & filled_b).sum(axis=-1)
    seen = np.maximum((filled_a | filled_b).sum(axis=-1), 1)
    share = percent / 100
    union = (n_a + n_b) / (1 + share)
    variance = share * (1 - share) / seen * np.clip(1 - seen / union, 0.05, 1)
    return agree >= (share - DEVIATIONS * np.sqrt(variance)) * seen - 1, agree / seen


def digests(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set in two words."""
    n = np.diff(first).astype(np.uint64)
    halves = []
    for salt in (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)):
        total = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(mix(mix(hashes ^ salt) + salt), out=total[1:])
        halves.append(mix(total[first[1:]] - total[first[:-1]] + n * salt))
    return halves[0], halves[1]


def described(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, hi, lo, n, sig) of every row; hi, lo and sig are NULL for empty sets."""
    schema = "doc_id long, text_key long, hi long, lo long, n long, sig binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            for a, b in slices(texts):
                hashes, first = shingle_sets(texts[a:b], size)
                n = np.diff(first)
                hi, lo = digests(hashes, first)
                full = np.flatnonzero(n)
                sig = packed(*signatures(hashes, np.append(first[full], len(hashes))))
                sigs: list[bytes | None] = [None] * (b - a)
                for i, row in zip(full.tolist(), sig):
                    sigs[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("text_key").slice(a, b - a),
                     pa.array(hi.view(np.int64), mask=n == 0), pa.array(lo.view(np.int64), mask=n == 0),
                     pa.array(n.astype(np.int64)), pa.array(sigs, pa.binary())],
                    names=[c.split()[0] for c in schema.split(", ")])

    bounded_batches(docs.sparkSession)
    rows = columns(docs, doc_id="long", text="string").withColumn("text_key", text_key())
    return rows.mapInArrow(run, schema)


# -- candidates --------------------------------------------------------------------------------


def buckets(nodes: DataFrame, rows: int = ROWS) -> DataFrame:
    """(band, key, id): the bands of every node."""
    band = F.transform(F.sequence(F.lit(0), F.lit(BINS // rows - 1)), lambda i: F.xxhash64(
        i, F.substring(F.col("sig"), i * rows + 1, F.lit(rows))))
    return nodes.select(F.posexplode(band).alias("band", "key"), "id")


def _agreeing():
    @F.arrow_udf("long")
    def agreeing(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint8) for c in (a, b))
        return pa.array((x == y).reshape(len(a), -1).sum(axis=1).astype(np.int64))

    return agreeing


def plausible(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b), a below b, of the pairs whose sizes and signatures allow a link."""
    one, other = (nodes.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"),
                               F.col("sig").alias(f"sig_{c}")) for c in "ab")
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")

    @F.arrow_udf("boolean")
    def agree(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
        x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), -1) for c in (a, b))
        return pa.array(may_link(x, y, n_a.to_numpy(), n_b.to_numpy(), percent)[0])

    met = pairs.join(one, "a").join(other, "b").where(100 * small >= percent * large)
    return met.where(agree("sig_a", "sig_b", "n_a", "n_b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def full_sets(wanted: DataFrame, docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(id, shingles) of the ``wanted`` nodes (id, key, hi, lo), made anew from one text of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            for a, b in slices(texts):
                hashes, first = shingle_sets(texts[a:b], size)
                hi, lo = (x.view(np.int64) for x in digests(hashes, first))
                same = ((hi == batch.column("hi").to_numpy()[a:b])
                        & (lo == batch.column("lo").to_numpy()[a:b]))
                out = pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), pa.ListArray.from_arrays(
                        pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))],
                    names=["id", "shingles"])
                yield out.filter(pa.array(same))  # not a text that only shares the hash

    texts = columns(docs, text="string").withColumn("key", text_key())
    met = texts.join(few_rows(wanted, WANTED), "key")
    one = met.groupBy("id", "key", "hi", "lo", F.xxhash64(F.reverse("text"))).agg(
        F.first("text").alias("text"))
    return one.select("id", "hi", "lo", "text").mapInArrow(run, "id long, shingles array<long>")


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int = SHINGLE,
              percent: int = PERCENT) -> DataFrame:
    """(a, b): the ``pairs`` (saved) that are linked by their full sets."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    wanted = saved(nodes.select("id", "key", "hi", "lo").join(ids.distinct(), "id"))
    sets = saved(full_sets(wanted, docs, size))
    met = (pairs.select("a", "b")
           .join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
           .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b"))
    both = F.size(F.array_intersect("x", "y"))
    return saved(met.where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b"))


def merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, root) after ``links`` (saved) join what ``roots`` keeps apart; ids that are roots are left
    out. Only the links between components are looked at."""
    if roots is None:
        return saved(components(links).withColumnRenamed("point", "id"))
    above = saved(components(_apart(links, roots).select(
        F.col("root_a").alias("a"), F.col("root_b").alias("b"))))
    moved = roots.join(above.select(F.col("point").alias("root"), F.col("root").alias("_up")), "root",
                       "left").select("id", F.coalesce("_up", "root").alias("root"))
    return saved(moved.unionByName(above.withColumnRenamed("point", "id")))


def _rooted(table: DataFrame, roots: DataFrame | None, column: str, name: str) -> DataFrame:
    if roots is None:
        return table.withColumn(name, F.col(column))
    own = roots.select(F.col("id").alias(column), F.col("root").alias("_root"))
    return table.join(own, column, "left").withColumn(name, F.coalesce("_root", column)).drop("_root")


def _apart(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
    return _rooted(_rooted(pairs, roots, "a", "root_a"), roots, "b", "root_b").where("root_a != root_b")


def _overlaps(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many values each of some sets shares with one, all in order."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    same = np.concatenate(([0], np.cumsum(own[at] == flat)))
    end = np.cumsum([len(x) for x in others])
    return same[end] - same[np.concatenate(([0], end[:-1]))]


def _partners(table: pa.Table, rows: int, percent: int):
    """(columns of a block, function): the function gives a member of side 0 the members of side 1 it
    may be linked with, of those with another label whose first shared bucket this is."""
    own = {c: table.column(c).to_numpy() for c in ("id", "root", "n", "band", "side")}
    own["rest"] = np.asarray(table.column("rest").to_numpy(), dtype=bool)
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(table.num_rows, -1)
    ids, n, every = own["id"], own["n"], np.flatnonzero(own["side"] == 1)

    def of(i: int, label: np.ndarray) -> np.ndarray:
        small, large = np.minimum(n[i], n[every]), np.maximum(n[i], n[every])
        # two members of side 0 meet twice: once is enough
        to = every[(label[every] != label[i]) & (100 * small >= percent * large)
                   & (~own["rest"][every] | (ids[every] > ids[i]))]
        before = int(own["band"][i]) * rows
        if before and len(to):
            same = (sig[to, :before] == sig[i, :before]).reshape(len(to), -1, rows).all(axis=2)
            to = to[~same.any(axis=1)]
        return to[may_link(sig[to], sig[i], n[to], n[i], percent)[0]] if len(to) else to

    return own, of


def across(live: DataFrame, nodes: DataFrame, docs: DataFrame, size: int = SHINGLE,
           percent: int = PERCENT, block: int = BLOCK, short: int = SHORT,
           rows: int = ROWS) -> DataFrame:
    """(a, b): links between a bucket's members from different components, as few as join the same
    components.

    ``live`` is (band, key, id, root). Any such pair has a member outside the bucket's largest
    component, so those members meet all, in blocks of signatures. Members that may be linked meet
    again in blocks of at most ``block`` times ``short`` shingles a side (or one longer set), where a
    task confirms links on the full sets and drops what it has joined already. Neither step sends more
    rows than a block has members, for each of the smaller blocks it is cut in.
    """
    sizes = live.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(
        F.max_by("root", F.struct("m", "root")).alias("largest"), F.sum("m").alias("all"),
        F.max("m").alias("most"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    sizes = sizes.select(
        "key", "largest", F.ceil(F.col("all") / block).cast("int").alias("k_all"),
        F.ceil((F.col("all") - F.col("most")) / block).cast("int").alias("k_few"))
    open_ = live.join(sizes, "key").withColumn("rest", F.expr("root != largest"))
    signed = saved(open_.join(nodes.select("id", "n", "sig"), "id"))
    own = F.xxhash64("id")

    def dealt(table: DataFrame, side: int, into: str, times: str) -> DataFrame:
        mine = F.pmod(own, F.col(into)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col(times) - 1))
        p, q = (mine, other) if side == 0 else (other, mine)
        return table.select("key", "band", "id", "root", "rest", "n", "sig",
                            F.lit(side).cast("byte").alias("side"), p.alias("p"), q.alias("q"))

    met = dealt(signed.where("rest"), 0, "k_few", "k_all").unionByName(
        dealt(signed, 1, "k_all", "k_few"))
    limit = max(1, block * short)

    def near(key, table):
        held, of = _partners(table, rows, percent)
        side, n = held["side"], held["n"]
        part = np.zeros(len(side), dtype=np.int64)  # smaller blocks of each side
        for k in (0, 1):
            part[side == k] = np.cumsum(n[side == k]) // limit
        wanted = set()  # (smaller block of side 0, of side 1, member)
        for i in np.flatnonzero(side == 0).tolist():
            to, c = of(i, held["root"]), int(part[i])
            wanted.update((c, d, i) for d in np.unique(part[to]).tolist())
            wanted.update((c, d, k) for d, k in zip(part[to].tolist(), to.tolist()))
        c, d, at = (np.array(x, dtype=np.int64) for x in zip(*sorted(wanted))) if wanted else (
            np.zeros((3, 0), dtype=np.int64))
        out = {x: pa.array(np.full(len(at), v.as_py()), t) for x, v, t in zip(
            ("key", "p", "q"), key, (pa.int64(), pa.int32(), pa.int32()))}
        out |= {"c": pa.array(c), "d": pa.array(d)}
        out |= {x: pa.array(held[x][at]) for x in ("band", "id", "root", "rest", "side")}
        return pa.table(out)

    found = saved(met.groupBy("key", "p", "q").applyInArrow(
        near, "key long, p int, q int, c long, d long, band int, id long, root long, rest boolean, "
              "side byte"))
    ids = found.select("id").distinct()
    known = saved(nodes.select("id", "key", "hi", "lo").join(ids, "id"))
    sets = full_sets(known, docs, size).join(nodes.select("id", "n", "sig"), "id")

    def match(table: pa.Table) -> pa.Table:
        held, of = _partners(table, rows, percent)
        ids, n, label = held["id"], held["n"], held["root"].copy()
        column = table.column("shingles").combine_chunks()
        values, bound = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()  # in order
        sets = [values[x:y] for x, y in zip(bound[:-1], bound[1:])]
        a, b = [], []
        for i in np.flatnonzero(held["side"] == 0).tolist():
            to = of(i, label)
            if not len(to):
                continue
            both = _overlaps(sets[i], [sets[k] for k in to])
            to = to[100 * both >= percent * (n[i] + n[to] - both)]
            joined, first = np.unique(label[to], return_index=True)
            a += [ids[i]] * len(first)
            b += ids[to[first]].tolist()
            label[np.isin(label, joined)] = label[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    linked = found.join(sets, "id").groupBy("key", "p", "q", "c", "d").applyInArrow(
        match, "a long, b long")
    return linked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked_roots(nodes: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT,
                 rows: int = ROWS, block: int = BLOCK, short: int = SHORT) -> DataFrame:
    """(id, root) of every node (saved) that is linked to a smaller id, its component's root."""
    every = buckets(nodes, rows)
    # equal keys make a bucket; the smallest id is its centre
    shared = every.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("centre")).where(
        F.col("m") > 1)
    live = saved(every.join(shared.select("key", "centre"), "key"))
    # of its centres each member takes the one it shares most buckets with: one edge a member
    star = live.where("id != centre").groupBy("id", "centre").agg(F.count(F.lit(1)).alias("m"))
    star = star.groupBy("id").agg(F.max_by("centre", F.struct("m", -F.col("centre"))).alias("a"))
    found = saved(plausible(star.select("a", F.col("id").alias("b")), nodes, percent))
    roots = merged(None, confirmed(found, nodes, docs, size, percent))
    placed = _rooted(live.select("band", "key", "id"), roots, "id", "root")
    return merged(roots, saved(across(placed, nodes, docs, size, percent, block, short, rows)))


def components_of(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT,
                  rows: int = ROWS, block: int = BLOCK, short: int = SHORT) -> DataFrame:
    """(doc_id, text_key, n, root, component_id) of every row; ``root`` is NULL for empty sets."""
    own = saved(described(docs, size))
    nodes = own.where("n > 0").groupBy("hi", "lo").agg(
        F.first("n").alias("n"), F.first("sig").alias("sig"), F.min("text_key").alias("key"),
        F.min("doc_id").alias("least"))
    # numbers instead of digests: fixed once saved
    nodes = saved(nodes.withColumn("id", F.monotonically_increasing_id()))
    roots = linked_roots(nodes, docs, size, percent, rows, block, short)
    named = nodes.select("hi", "lo", "id", "least").join(roots, "id", "left").withColumn(
        "root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = saved(named.join(least, "root").select("hi", "lo", "root", "component_id"))
    return own.join(named, ["hi", "lo"], "left").select(
        "doc_id", "text_key", "n", "root",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    return components_of(docs, size, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def filter_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with all its columns; those of empty sets all stay."""
    rows = saved(components_of(docs, size, percent))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    one = rows.where("n > 0").groupBy("root").agg(F.min(first).alias("one"))
    empty = keep_rows(docs, rows.where("n = 0").select("doc_id", "text_key"))
    kept = keep_rows(docs, one.select("one.doc_id", "one.text_key"))
    return kept.withColumn("_key", text_key()).dropDuplicates(["doc_id", "_key"]).drop(
        "_key").unionByName(empty)
