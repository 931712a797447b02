"""MinHash near-dedup: fast similarity sketching, banding, exact verification.

A sketch has ``bands * rows`` coordinates.  In round i < t a hash puts each
shingle into a bin; in round t + j all shingles go to bin j; a bin keeps its
least (round, hash), and rounds go on until every bin is filled.  So each
coordinate is filled for every set, agrees with probability equal to the Jaccard
similarity, and has the concentration of t independent draws.

Texts of equal words form one class (by a 128-bit digest of the word sequence), of
which one row goes on.  A group is a bucket, that is an equal band.  First each member is compared with the most central
member of its groups, their lead, on full shingle sets; connected components are formed.  A group that then still holds
several components is compared as a whole: its members are dealt out to blocks, and each pair of blocks
counts the shingles that any two of its members share, all at once as a product of matrices (``linked_sets``).  What comes of
it are the components that it joins, not its pairs; so a group costs no rounds, and no row is made for a pair of texts.
A member goes to as many block pairs as its group has blocks, ``PARTS`` at the most until blocks reach ``MOST`` members.
Similarities count 64-bit hashes of shingles; two distinct ones of a text of n
shingles share a hash with probability below n * n / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from takepick.llm.common import Scratch, Words, mix, sets_of_shingles, stream, text_batches
from takepick.llm.graph import merged

UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)
LEAST, MOST, PARTS = 512, 2048, 4  # members of a block, blocks of a group
WEIGHT = 1 << 19  # shingles of a block
RARE = 1024  # pairs of sets up to which those that share a shingle are counted one by one
SHARE = 64  # members compared with one copy of their lead's text


def sketch(doc: np.ndarray, shingle: np.ndarray, n_docs: int, t: int) -> np.ndarray:
    """Matrix (n_docs, t); rows of documents without shingles stay unset."""
    out = np.full(n_docs * t, UNSET)
    seeds = stream(2 * t, 23)
    for i in range(2 * t):
        if not len(doc):
            break
        h = mix(shingle ^ seeds[i])
        value = (np.uint64(i) << np.uint64(56)) | (h >> np.uint64(8))
        at = doc * t + ((h % np.uint64(t)).astype(np.int64) if i < t else i - t)
        np.minimum.at(out, at, value)
        open_ = (out.reshape(n_docs, t) == UNSET).any(axis=1)
        going = open_[doc]
        if not going.all():
            doc, shingle = doc[going], shingle[going]
    return out.reshape(n_docs, t)


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    coef = stream(rows, 31)
    parts = sketches.reshape(len(sketches), bands, rows)
    return mix((parts * coef).sum(axis=2, dtype=np.uint64) ^ stream(bands, 37))


def _differences(mine: np.ndarray, lead: np.ndarray, percent: int) -> tuple[int, np.ndarray, int, int]:
    """Cost beyond the bound (not positive: linked), how ``mine`` differs from ``lead``, and how many differences it must share with any partner and with a near one.

    With ``added`` and ``missing`` shingles against a lead of n, let cost = 100 *
    missing + percent * added and bound = (100 - percent) * n.  A set is linked with
    the lead (near) if cost <= bound, and two sets are linked if (100 + percent) *
    (differences shared) >= cost + other cost - bound.  Near sets are linked anyhow, so
    one of two is far, and the other must share more than cost / (100 + percent); a far
    one with a near one, whose cost is ``percent`` at the least, (cost - bound +
    percent) / (100 + percent).
    """
    at = np.minimum(np.searchsorted(lead, mine), max(len(lead) - 1, 0))
    there = lead[at] == mine if len(lead) else np.zeros(len(mine), bool)
    held = np.zeros(len(lead), bool)
    held[at[there]] = True
    added, missing = mine[~there], lead[~held]
    cost, bound = 100 * len(missing) + percent * len(added), (100 - percent) * len(lead)
    need = cost // (100 + percent) + 1
    near = need if cost <= bound else -((bound - cost - percent) // (100 + percent))
    return cost - bound, np.concatenate((mix(added ^ np.uint64(1)), mix(mix(missing) ^ np.uint64(2)))), need, near


def shared_counts(doc: np.ndarray, shingle: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Matrix of how many shingles each of the ``left`` documents shares with each of the ``right`` ones; (doc, shingle) are distinct."""
    sides = []
    for chosen in (left, right):
        place = np.full(int(doc[-1]) + 1 if len(doc) else 0, -1)
        place[chosen[chosen < len(place)]] = np.flatnonzero(chosen < len(place))
        mine = place[doc] >= 0
        sides.append((place[doc[mine]], shingle[mine]))
    both = np.intersect1d(sides[0][1], sides[1][1])
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(both):
        return out
    held = []
    for row, sh in sides:
        at = np.minimum(np.searchsorted(both, sh), len(both) - 1)
        there = both[at] == sh
        order = np.argsort(at[there], kind="stable")
        column, row = at[there][order], row[there][order]
        held.append((column, row, np.searchsorted(column, np.arange(len(both) + 1))))
    (cx, x, fx), (cy, y, fy) = held
    p, q = np.diff(fx), np.diff(fy)
    rare = p * q <= RARE
    # rare shingles: each row of the left with all of the right that hold it too
    mine = np.flatnonzero(rare[cx])
    for a in range(0, len(mine), 1 << 15):
        part = mine[a : a + (1 << 15)]
        n = q[cx[part]]
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        pairs = np.repeat(x[part] * len(right), n) + y[np.repeat(fy[cx[part]], n) + nth]
        out += np.bincount(pairs, minlength=out.size).reshape(out.shape)
    # all others: a product of matrices, some columns at a time
    often = np.flatnonzero(~rare)
    for a in range(0, len(often), 2048):
        of = np.full(len(both), -1)
        of[often[a : a + 2048]] = np.arange(len(often[a : a + 2048]))
        ones = []
        for (column, row, _), n in zip(held, out.shape):
            m = np.zeros((n, len(often[a : a + 2048])), np.float32)
            mine = of[column] >= 0
            m[row[mine], of[column[mine]]] = 1
            ones.append(m)
        out += ones[0] @ ones[1].T
    return out


def linked_sets(doc: np.ndarray, shingle: np.ndarray, size: np.ndarray, label: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(label, other label) that join what links of ``left`` with ``right`` documents connect; each label but the least of its component is there once."""
    names, of = np.unique(label, return_inverse=True)
    if len(names) < 2:
        return names[:0], names[:0]
    shared = shared_counts(doc, shingle, left, right)
    linked = shared * (100 + percent) >= (size[left][:, None] + size[right]) * percent
    i, j = np.nonzero(linked & (of[left][:, None] != of[right]))
    edges = np.unique(of[left[i]].astype(np.int64) * len(names) + of[right[j]])
    u, v = edges // len(names), edges % len(names)
    least = np.arange(len(names))
    while True:
        low, before = np.minimum(least[u], least[v]), least.copy()
        np.minimum.at(least, u, low)
        np.minimum.at(least, v, low)
        np.minimum.at(least, before[u], low)
        np.minimum.at(least, before[v], low)
        least = least[least]
        if (least == before).all():
            break
    moved = np.flatnonzero(least != np.arange(len(names)))
    return names[moved], names[least[moved]]


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = 24,
    rows: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, first, text_hash.

    Words are maximal runs of bytes other than white space after lower-casing A-Z;
    a text's set are its distinct shingles of ``shingle`` words, or its whole word
    sequence if that is shorter.  Texts are linked if 100 * intersection >=
    ``percent`` * union.  ``component_id`` is the smallest id reachable over
    links, ``kept`` says that it is the row's own, ``first`` is true for exactly
    one row of a component.  A null text is empty; empty sets are linked with
    nothing.  A null id sorts after all others.  Rows repeated with one id are
    rows of their own.  No rows give no rows; other columns are ignored.
    ``text_hash`` (xxhash64 of the text) tells rows of one id apart.
    """
    t = bands * rows

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            n = batch.num_rows
            words = Words(batch.column("text").to_pylist())
            doc, sh = sets_of_shingles(words, shingle)
            first = np.searchsorted(doc, np.arange(n + 1))
            keys = band_keys(sketch(doc, sh, n, t), bands, rows).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(keys.ravel()))
            own = np.frombuffer(b"".join(words.digests()), np.int64).reshape(n, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("doc_id"), batch.column("text_hash"), pa.array(np.diff(first), pa.int64()), pa.array(own[:, 0]), pa.array(own[:, 1]), lists],
                ["rid", "doc_id", "text_hash", "n", "k1", "k2", "bands"],
            )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come lead first, then its members; those that are linked with it."""
        lead = np.zeros(0, np.uint64)
        for batch in text_batches(batches, "text"):
            doc, sh = sets_of_shingles(Words(batch.column("text").to_pylist()), shingle)
            cuts, rows = np.searchsorted(doc, np.arange(batch.num_rows + 1)), []
            for i, a in enumerate(batch.column("a").to_pylist()):
                mine = sh[cuts[i] : cuts[i + 1]]
                if a is None:
                    lead = mine
                elif _differences(mine, lead, percent)[0] <= 0:
                    rows.append(i)
            yield batch.select(["a", "b"]).take(pa.array(rows, pa.int64()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come pair of blocks by pair of blocks: links between labels."""
        unit, parts = None, []

        def joined() -> pa.RecordBatch:
            doc, sh, size, label, side = (np.concatenate(x) for x in zip(*parts))
            doc = np.repeat(np.arange(len(size)), size)
            one = unit[1] == unit[2]
            left = np.arange(len(size)) if one else np.flatnonzero(side == unit[1])
            right = left if one else np.flatnonzero(side == unit[2])
            made = linked_sets(doc, sh, size, label, left, right, percent)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in made], ["a", "b"])

        for batch in text_batches(batches, "text"):
            key, i, j = (batch.column(c).to_numpy() for c in ("key", "i", "j"))
            doc, sh = sets_of_shingles(Words(batch.column("text").to_pylist()), shingle)
            first = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            cuts = [0, *(np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1).tolist(), batch.num_rows]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                now = (int(key[a]), int(i[a]), int(j[a]))
                if parts and now != unit:
                    yield joined()
                    parts = []
                unit = now
                parts.append((doc[:0], sh[first[a] : first[z]], np.diff(first[a : z + 1]), batch.column("label").to_numpy()[a:z], batch.column("block").to_numpy()[a:z]))
        if parts:
            yield joined()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            doc, sh = sets_of_shingles(Words(batch.column("text").to_pylist()), shingle)
            rid = batch.column("rid").to_numpy()[doc]
            for at in range(0, len(sh), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(sh[at : at + (1 << 16)].view(np.int64)), pa.array(rid[at : at + (1 << 16)])], ["shingle", "rid"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    with Scratch(docs.sparkSession) as s:
        described = s.table(
            source.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(
                describe, "rid long, doc_id long, text_hash long, n long, k1 long, k2 long, bands array<long>"
            )
        )
        # one row of each class of equal sets goes on
        classes = s.table(described.where("n > 0").groupBy("k1", "k2").agg(F.min("rid").alias("rid")))
        entries = s.table(
            described.join(classes.select("rid"), "rid").select("rid", "n", F.explode("bands").alias("key"))
        )
        buckets = entries.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key")
        members = s.table(entries.join(buckets, "key"))
        s.drop(entries)
        wanted = members.select("rid").distinct().join(described.select("rid", "doc_id", "text_hash"), "rid")
        texts = s.table(
            source.join(wanted, [source["doc_id"].eqNullSafe(wanted["doc_id"]), source["text_hash"] == wanted["text_hash"]]).select("rid", "text")
        )
        if texts.count() > wanted.count():  # rows repeated with one id and text
            texts, repeated = s.table(texts.dropDuplicates(["rid"])), texts
            s.drop(repeated)

        # A shingle that no other candidate has is in no intersection: so a set's other shingles bound all its similarities.
        lone = texts.mapInArrow(spread, "shingle long, rid long").groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.min("rid").alias("rid"))
        lone = lone.where("c = 1").groupBy("rid").agg(F.count(F.lit(1)).alias("u"))
        sizes = wanted.select("rid").join(described.select("rid", "n"), "rid").join(lone, "rid", "left")
        sizes = s.table(sizes.select("rid", "n", (F.col("n") - F.coalesce("u", F.lit(0))).alias("shared")).where(F.col("shared") * 100 >= F.col("n") * percent))

        def compared(pairs: DataFrame) -> DataFrame:
            """Members ``a`` against leads ``b``; a lead's members are dealt out ``SHARE`` at a time, each share with the lead's text."""
            shares = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares"))
            heads = shares.join(texts, shares["b"] == texts["rid"]).select(F.lit(None).cast("long").alias("a"), "b", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "text")
            rows = pairs.join(shares, "b").select("a", "b", F.pmod(F.xxhash64("a"), "shares").cast("int").alias("share")).join(texts, F.col("a") == F.col("rid")).select("a", "b", "share", "text")
            dealt = heads.unionAll(rows).repartition("b", "share").sortWithinPartitions("b", "share", "a")  # null first: the lead
            return dealt.select("a", "b", "text").mapInArrow(verify, "a long, b long")

        def possible(x: str, y: str) -> Column:
            return F.least(f"{x}shared", f"{y}shared") * (100 + percent) >= (F.col(f"{x}n") + F.col(f"{y}n")) * percent

        # the set of fewest lone shingles leads: most of a group of copies are linked with it
        groups = s.table(members.select("key", "rid").join(sizes, "rid"))
        s.drop(members)
        central = F.struct((F.lit(1000) * (F.col("n") - F.col("shared")) / F.col("n")).cast("long").alias("far"), F.col("rid").alias("lead"), F.col("n").alias("lead_n"), F.col("shared").alias("lead_shared"))
        leads = groups.groupBy("key").agg(F.min(central).alias("l"), F.count(F.lit(1)).alias("m")).where("m > 1").select("key", "l")
        # first each member with the most central lead that it may be linked with at all
        tried = groups.join(leads, "key").select("rid", "n", "shared", "l", "l.*").where(F.col("lead") != F.col("rid")).where(possible("", "lead_"))
        tried = s.table(tried.groupBy(F.col("rid").alias("a")).agg(F.min("l.lead").alias("b")))
        labels = merged(s, None, s.table(compared(tried)))
        # then all members of the groups that hold several components; of groups with the same members one
        named = groups.select("key", "rid", "n").join(labels.withColumnRenamed("node", "rid"), "rid", "left").withColumn("label", F.coalesce("label", "rid"))
        sums = [F.sum(h.cast("decimal(38,0)")) for h in (F.xxhash64("rid"), F.xxhash64("rid", F.lit(1)))]
        open_ = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("weight"), sums[0].alias("h1"), sums[1].alias("h2"))
        open_ = open_.where("low <> high").groupBy("m", "h1", "h2", "weight").agg(F.min("key").alias("key"))
        block = F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.col("m") / PARTS))
        open_ = s.table(open_.select("key", F.ceil(F.greatest(F.col("m") / block, F.col("weight") / WEIGHT)).cast("int").alias("blocks")))
        dealt = named.join(open_, "key").withColumn("block", F.pmod(F.xxhash64("rid", "key"), "blocks").cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        units = s.table(dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rid", "label"))
        units = units.join(texts, "rid").select("key", "i", "j", "block", "label", "text").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        links = s.table(units.mapInArrow(compare, "a long, b long"))
        s.drop(texts, groups)
        labels = merged(s, labels, links)
        # back to all rows
        of_class = classes.join(labels.withColumnRenamed("node", "rid"), "rid", "left").select("k1", "k2", F.coalesce("label", "rid").alias("label"))
        out = described.drop("bands").join(of_class, ["k1", "k2"], "left").withColumn("label", F.when(F.col("n") > 0, F.col("label")).otherwise(F.col("rid")))
        out = s.table(out.select("rid", "doc_id", "text_hash", "n", "label"))
        low = out.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "rid")).alias("low"))
        low = s.table(low.select("label", F.col("low.doc_id").alias("component_id"), F.col("low.rid").alias("low_rid")))
        return s.keep(
            out.join(low, "label").select(
                "doc_id",
                F.col("n").alias("n_shingles"),
                "component_id",
                F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
                (F.col("rid") == F.col("low_rid")).alias("first"),
                "text_hash",
            )
        )
