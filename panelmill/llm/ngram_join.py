"""N-gram Jaccard self-join with Bayesian candidate pruning.

1. Every text becomes its set of word n-grams (64-bit hashes), a digest of the set and MinHash values. Rows with equal
   sets are one class, whatever their ids; a class gets a number, and one of its rows goes on under it.
2. Classes that agree on all rows of a MinHash band meet in a bucket. Each bucket gives one edge per member, to its
   smallest number, never all pairs. Edges whose MinHash values make even the similarity that two neighbours of a common
   text have improbable are dropped. What a bucket has left over is tied together, with the members that aren't surely
   nearer to the smallest number than the threshold, as those may link to what is left over.
3. The components of these edges hold the candidate pairs. A component is dealt out in blocks of bounded size, those of
   texts of like size; pairs of blocks whose sizes allow the threshold are compared in tasks: MinHash values are read in
   steps, a pair is dropped as soon as its posterior probability of reaching the threshold falls below the tolerance, and
   the rest are verified exactly.
4. Tasks return counts of links and a spanning forest, in size linear in the documents; the forest's components are
   the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import bounded_batches, discard, give_back, join_groups, partitions, table
from .textkernel import WordHasher, mix, runs, slices, texts


@dataclass(frozen=True)
class JaccardParams:
    """Words of an n-gram and the similarity that links; bands and rows of MinHash; the pruning of pairs.

    A pair at 0.8 meets in no bucket with probability (1 - 0.8 ** rows) ** bands, here 3.3e-5. ``tolerance`` bounds the
    posterior at each step, not the share of links that is dropped: that is 5.7e-8 at 0.8, far below that of the bands.
    ``sure`` is the posterior probability from which a member counts as nearer to its bucket's smallest id than the threshold.
    """

    n: int = 5
    threshold: float = 0.8
    bands: int = 26
    rows: int = 5
    tolerance: float = 1e-8
    sure: float = 0.999
    block_texts: int = 512
    block_words: int = 500_000


#: The two digests of a set are sums over its n-grams, mixed with these.
_SALTS = (0, 0xA5A5A5A5A5A5A5A5)


def _sketcher(p: JaccardParams):
    """Per text: size and digest of its set of n-grams, one byte of each MinHash value, and the keys of the bands."""
    k = p.bands * p.rows

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        factors = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
        shifts = mix(np.arange(k + 1, 2 * k + 1, dtype=np.uint64))
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            m = len(offsets) - 1
            size, one, two = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
            low = np.full((m, k), np.uint64(2**64 - 1))
            with np.errstate(over="ignore"):
                for a, b in slices(offsets):
                    words, _, _, at = hasher.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    for i in range(a, b):
                        grams = np.unique(runs(words[at[i - a] : at[i - a + 1]], p.n))
                        size[i] = len(grams)
                        one[i], two[i] = (mix(grams ^ np.uint64(salt)).sum(dtype=np.uint64).view(np.int64) for salt in _SALTS)
                        for c in range(0, len(grams), 512):
                            np.minimum(low[i], (factors[:, None] * grams[None, c : c + 512] + shifts[:, None]).min(axis=1), out=low[i])
                mixed = mix(low)
                keys = np.zeros((m, p.bands), np.uint64)
                for r in range(p.rows):
                    keys = mix(keys * np.uint64(31) + mixed[:, r :: p.rows])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(size), pa.array(one), pa.array(two),
                    pa.array([x.tobytes() for x in (mixed & np.uint64(255)).astype(np.uint8)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, (m + 1) * p.bands, p.bands, dtype=np.int32)), pa.array(keys.view(np.int64).ravel())),
                ],
                names=["doc_id", "n_grams", "digest", "digest2", "sig", "keys"],
            )

    return sketch


def least_matches(threshold: float, steps: list[int], tolerance: float) -> list[int]:
    """For each number of compared values, the matches below which P(similarity >= threshold) < tolerance; h + 1 if all are.

    The prior is uniform; a byte of two MinHash values agrees with probability s + (1 - s) / 256.
    """
    s = (np.arange(2000) + 0.5) / 2000
    p = s + (1 - s) / 256
    out = []
    for h in steps:
        m = np.arange(h + 1)[:, None]
        like = m * np.log(p) + (h - m) * np.log1p(-np.minimum(p, 1 - 1e-12))
        like = np.exp(like - like.max(axis=1, keepdims=True))
        reach = like[:, s >= threshold].sum(axis=1) / like.sum(axis=1)
        out.append(int(np.argmax(reach >= tolerance)) if (reach >= tolerance).any() else h + 1)
    return out


def _pruned(sig_a: np.ndarray, sig_b: np.ndarray, a: np.ndarray, b: np.ndarray, steps: list[int], least: list[int]) -> np.ndarray:
    """Which of the pairs (a, b) of rows survive the comparison of MinHash values step by step."""
    alive, matches, was = np.arange(len(a)), np.zeros(len(a), np.int32), 0
    for h, need in zip(steps, least, strict=True):
        matches = matches + (sig_a[a[alive], was:h] == sig_b[b[alive], was:h]).sum(axis=1, dtype=np.int32)
        keep = matches >= need
        alive, matches, was = alive[keep], matches[keep], h
    return alive


def _star_pruner(p: JaccardParams):
    """Of each edge whether its ends may be as alike as two neighbours of one text, and whether they surely link."""
    k = p.bands * p.rows
    steps = list(range(p.bands, k + 1, p.bands))
    least = least_matches(max(0.0, 1 - 2 * (1 - p.threshold)), steps, p.tolerance)
    sure = least_matches(p.threshold, [k], p.sure)[0]

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = [np.frombuffer(texts(batch.column(x))[0], np.uint8).reshape(-1, k) for x in ("sig_u", "sig_v")]
            at = np.arange(batch.num_rows)
            near = np.zeros(batch.num_rows, bool)
            near[_pruned(*sigs, at, at, steps, least)] = True
            inner = (sigs[0] == sigs[1]).sum(axis=1) >= sure
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(near), pa.array(inner)], names=["u", "v", "near", "inner"])

    return prune


def _candidates(reps: DataFrame, p: JaccardParams) -> DataFrame:
    """Edges (u, v) whose components hold the pairs of classes that share a bucket.

    Within a bucket a pair at the threshold stays together: both ends are near the smallest number and tied to it; or both are
    far or on the edge, and tied to each other; else one is far and one surely nearer than the threshold, which by the
    triangle inequality of the Jaccard distance can't link, but for the chance that ``sure`` leaves.
    """
    total = p.bands * reps.count()
    keyed = reps.select("node", F.posexplode("keys").alias("band", "bucket"))
    buckets = keyed.groupBy("band", "bucket").agg(F.min("node").alias("v"), F.count("*").alias("n")).filter("n > 1")
    stars = join_groups(keyed, buckets, ["band", "bucket"], total).filter("node <> v").withColumnRenamed("node", "u").drop("n")
    stars = table(stars, "stars")
    pairs, sigs = stars.select("u", "v").distinct(), reps.select("node", "sig")
    stored = table(pairs.groupBy("v").agg(F.count("*").alias("n")).join(sigs.toDF("v", "sig_v"), "v"), "centres")
    edges = join_groups(pairs.join(sigs.toDF("u", "sig_u"), "u"), stored, ["v"], total).select("u", "v", "sig_u", "sig_v")
    edges = table(edges.mapInArrow(_star_pruner(p), "u long, v long, near boolean, inner boolean"), "star_edges")
    centres = edges.filter("not near").select("v").distinct()
    outer = edges.filter("not near or not inner").join(centres, "v", "left_semi").select("u", "v", "near")
    outer = table(stars.join(outer, ["u", "v"]), "outer")
    left = outer.groupBy("band", "bucket").agg(F.min("u").alias("w"), F.count("*").alias("n"), F.bool_and("near").alias("all_near"))
    left = left.filter("n > 1 and not all_near").select("band", "bucket", "w", "n")
    rest = join_groups(outer.select("u", "band", "bucket"), left, ["band", "bucket"], total).filter("u <> w").select("u", F.col("w").alias("v"))
    out = table(edges.filter("near").select("u", "v").unionByName(rest.distinct()), "candidates")
    discard(stars, stored, edges, outer)
    return out


#: Pairs of a block that are compared at once.
_PAIRS_AT_ONCE = 1 << 16
#: What names a set of n-grams.
_DIGEST = ["digest", "digest2", "n_grams"]
#: What a member of a component brings to a pair of blocks; ``low`` and ``i`` name the smaller class of sizes and its block.
_PAIR = ["root", "low", "i", "high", "j"]
_MEMBER = ["node", "copies", "cell", "block", "whole", "sig"]


def _dealt(members: DataFrame, p: JaccardParams) -> DataFrame:
    """``_PAIR``, ``_MEMBER``, ``rep``, ``_DIGEST``: the members of each component, once for every pair of blocks that they are compared in.

    A component of at most ``block_texts`` and ``block_words`` is one block, ``whole``. Of others, texts whose sizes are
    within a factor of 1 / threshold are a cell, which is cut into blocks by hash; only blocks of one cell or of
    neighbouring cells can hold a pair at the threshold.
    """
    width = float(np.log(1 / p.threshold) * (1 + 1e-9)) if p.threshold > 0 else 1e9
    members = members.withColumn("size", F.floor(F.ln("n_grams") / width).cast("int"))
    by_root, by_size = Window.partitionBy("root"), Window.partitionBy("root").orderBy("size")
    blocks = lambda n, words: F.ceil(F.greatest(n / p.block_texts, words / p.block_words)).cast("int")
    cells = members.groupBy("root", "size").agg(F.count("*").alias("n"), F.sum("n_grams").alias("words"))
    cells = cells.withColumn("whole", blocks(F.sum("n").over(by_root), F.sum("words").over(by_root)) <= 1).withColumn("blocks", blocks(F.col("n"), F.col("words")))
    cells = cells.withColumns({
        "above": F.when(F.lead("size").over(by_size) == F.col("size") + 1, F.lead("blocks").over(by_size)).otherwise(0),
        "below": F.when(F.lag("size").over(by_size) == F.col("size") - 1, F.lag("blocks").over(by_size)).otherwise(0),
    }).drop("words")
    out = join_groups(members, table(cells, "cells"), ["root", "size"], members.count())
    out = out.withColumn("cell", F.when(F.col("whole"), 0).otherwise(F.col("size"))).withColumn("block", F.when(F.col("whole"), 0).otherwise(F.expr("pmod(xxhash64(node), blocks)")).cast("int"))

    def meetings(n, low, i, high, j):
        def pair(other):
            at = {"low": low, "high": high, "i": i, "j": j}
            return F.struct(*((v(other) if callable(v) else v).cast("int").alias(k) for k, v in at.items()))

        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), pair)).otherwise(F.array().cast("array<struct<low:int,high:int,i:int,j:int>>"))

    cell, block, zero = F.col("cell"), F.col("block"), F.lit(0)
    own = meetings(F.when(F.col("whole"), 1).otherwise(F.col("blocks")), cell, lambda x: F.least(block, x), cell, lambda x: F.greatest(block, x))
    up = meetings(F.when(F.col("whole"), zero).otherwise(F.col("above")), cell, block, cell + 1, lambda x: x)
    down = meetings(F.when(F.col("whole"), zero).otherwise(F.col("below")), cell - 1, lambda x: x, cell, block)
    out = out.select("root", *_MEMBER, "rep", *_DIGEST, F.explode(F.concat(own, up, down)).alias("pair"))
    return out.select(*(c if c == "root" else f"pair.{c}" for c in _PAIR), *_MEMBER, "rep", *_DIGEST)


def _set_maker(p: JaccardParams):
    """The sorted n-gram hashes of each text, as bytes."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            for a, b in slices(offsets):
                words, _, _, at = hasher.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                out = [np.unique(runs(words[at[i] : at[i + 1]], p.n)) for i in range(b - a)]
                ends = np.concatenate([[0], np.cumsum([8 * len(x) for x in out])]).astype(np.int32)
                flat = pa.BinaryArray.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(out))])
                one, two = (pa.array([int(mix(x ^ np.uint64(salt)).sum(dtype=np.uint64).view(np.int64)) for x in out], pa.int64()) for salt in _SALTS)
                size = pa.array([len(x) for x in out], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), size, one, two, flat], names=["rep", "n_grams", "digest", "digest2", "grams"])

    return sets


def _overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets a[i] and b[i]."""
    used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    if len(a) <= 2 * len(used) or len(a) < 200:
        out, order = np.empty(len(a), np.int64), np.argsort(a, kind="stable")
        for i in order:
            x, y = sets[used[a[i]]], sets[used[b[i]]]
            x, y = (x, y) if len(x) <= len(y) else (y, x)
            at = np.searchsorted(y, x)
            out[i] = np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x)
        return out
    # many pairs of few sets: a matrix product over the n-grams that at least two of the sets have
    flat = np.concatenate([sets[i] for i in used])
    row = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    left, right = np.unique(a), np.unique(b)
    where = np.searchsorted(left, a), np.searchsorted(right, b)
    product = np.zeros((len(left), len(right)), np.float32)
    for c in range(0, int(shared.sum()), 2048):
        lo, hi = np.searchsorted(column, [c, c + 2048])
        has = np.zeros((len(used), 2048), np.float32)
        has[row[lo:hi], column[lo:hi] - c] = 1
        product += has[left] @ has[right].T
    return product[where].astype(np.int64)


def _verifier(p: JaccardParams):
    """Links within a pair of blocks of a component: per text its number of linked rows and the smallest text tied to it."""
    k = p.bands * p.rows
    steps = list(range(p.bands, k + 1, p.bands))
    least = least_matches(p.threshold, steps, p.tolerance)

    def compare(ids, copies, first, second, sig, sets):
        size = np.array([len(x) for x in sets])
        links, label, found = np.zeros(len(ids), np.int64), np.arange(len(ids)), []
        rows = max(1, _PAIRS_AT_ONCE // max(1, len(second)))
        for f in range(0, len(first), rows):
            a, b = (x.ravel() for x in np.meshgrid(first[f : f + rows], second, indexing="ij"))
            keep = np.minimum(size[a], size[b]) >= p.threshold * np.maximum(size[a], size[b]) - 1e-9
            if first is second:
                keep &= a < b
            a, b = a[keep], b[keep]
            alive = _pruned(sig, sig, a, b, steps, least)
            a, b = a[alive], b[alive]
            if len(a):
                shared = _overlaps(sets, a, b)
                ok = shared >= p.threshold * (size[a] + size[b] - shared) - 1e-9
                found.append((a[ok], b[ok]))
        for a, b in found:
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
        while True:  # the smallest reachable text of each
            was = label.copy()
            for a, b in found:
                np.minimum.at(label, a, label[b])
                np.minimum.at(label, b, label[a])
            label = label[label]
            if (label == was).all():
                return links, ids[label]

    def done(rows):
        _, low, i, high, j = rows[0][:5]
        rows = sorted(rows, key=lambda x: x[5])
        ids, copies, cell, block = (np.array([x[c] for x in rows]) for c in (5, 6, 7, 8))
        first = np.flatnonzero((cell == low) & (block == i))
        second = first if (low, i) == (high, j) else np.flatnonzero((cell == high) & (block == j))
        sig = np.frombuffer(b"".join(x[10] for x in rows), np.uint8).reshape(-1, k)
        links, label = compare(ids, copies, first, second, sig, [np.frombuffer(x[11], np.uint64) for x in rows])
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(label), pa.array(np.full(len(ids), not rows[0][9]))], names=["node", "links", "label", "split"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in (*_PAIR, *_MEMBER, "grams")]
            for row in zip(*columns, strict=True):
                if rows and rows[0][:5] != row[:5]:
                    yield done(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield done(rows)
        give_back()

    return verify


def near_duplicates(docs: DataFrame, params: JaccardParams | None = None) -> DataFrame:
    """``doc_id, class_id, n_links, n_grams`` for every row of ``docs(doc_id long, text string, ...)``.

    class_id is the smallest doc_id of the rows that links lead to; n_links counts the other rows whose n-gram sets have
    a Jaccard similarity of ``threshold`` or more with this row's, equal sets included. N-grams are runs of ``n`` words
    (digits, letters and all that isn't ASCII; A-Z lowered); a text of fewer words, but some, is one n-gram. Null, empty
    and wordless texts have no n-grams, no links, and their own id as class. Every row counts: rows that repeat are copies of
    each other, and rows that share a doc_id but not a text each have their own links. An empty table gives no rows; other columns are
    ignored. A null doc_id is kept, as a class of its own.
    """
    return _classified(docs, params or JaccardParams()).select("doc_id", "class_id", "n_links", "n_grams")


def _classified(docs: DataFrame, p: JaccardParams) -> DataFrame:
    """The result of ``near_duplicates`` with the digests of each row's set."""
    spark = docs.sparkSession
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long"), "text")
    sketches = table(
        rows.mapInArrow(_sketcher(p), "doc_id long, n_grams long, digest long, digest2 long, sig binary, keys array<long>"), "sketches"
    )
    some = sketches.filter("n_grams > 0 and doc_id is not null")
    classes = some.groupBy(*_DIGEST).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = table(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    chosen = some.withColumnRenamed("doc_id", "rep").join(classes, ["rep", *_DIGEST])
    reps = table(chosen.dropDuplicates(["node"]), "reps")
    candidates = _candidates(reps, p)
    clusters = table(components(candidates), "clusters")
    members = table(clusters.join(reps.select("node", "rep", *_DIGEST, "copies", "sig"), "node"), "members")
    # where the members are few enough for Spark to broadcast their ids, the other texts aren't shuffled
    ids = table(members.select(F.col("rep").alias("doc_id")).distinct(), "ids")
    wanted = rows.join(ids, "doc_id", "left_semi")
    grams = wanted.mapInArrow(_set_maker(p), "rep long, n_grams long, digest long, digest2 long, grams binary")
    grams = grams.dropDuplicates(["rep", *_DIGEST]) if _repeats(sketches) else grams
    linked = table(
        _dealt(members, p).join(grams, ["rep", *_DIGEST]).select(*_PAIR, *_MEMBER, "grams").repartition(partitions(spark), *_PAIR).sortWithinPartitions(*_PAIR)
        .mapInArrow(_verifier(p), "node long, links long, label long, split boolean"), "links",
    )
    discard(reps, candidates, clusters, members, ids)
    forest = linked.filter("split and node <> label").select(F.col("node").alias("u"), F.col("label").alias("v"))
    roots = components(forest).withColumnRenamed("root", "top")
    found = linked.groupBy("node").agg(F.sum("links").alias("links"), F.min("label").alias("label")).join(roots, "node", "left")
    found = table(found.select("node", "links", F.coalesce("top", "label").alias("top")).join(classes.select("node", "rep"), "node"), "found")
    least = found.groupBy("top").agg(F.min("rep").alias("class_id"), F.count("*").alias("n"))
    found = join_groups(found, least, ["top"], found.count()).select("node", "links", "class_id")
    per_class = classes.join(found, "node", "left").select(*_DIGEST, "rep", "copies", "links", "class_id")
    out = sketches.select("doc_id", *_DIGEST).join(per_class, _DIGEST, "left")
    has = (F.col("n_grams") > 0) & F.col("doc_id").isNotNull()
    return out.select(
        "doc_id", F.when(has, F.coalesce("class_id", "rep")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(has, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(0).cast("long").alias("n_links"), *_DIGEST,
    )


def _repeats(sketches: DataFrame) -> bool:
    """Whether a doc_id occurs in several rows; only then must sets be made unique, and rows be told apart by more than their id."""
    return not sketches.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty()


def _digests(p: JaccardParams):
    """A text's size and digests, as a function of a text column."""

    def digests(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sets = _set_maker(p)
        for column in columns:
            batch = pa.RecordBatch.from_arrays([pa.nulls(len(column), pa.int64()), column], names=["doc_id", "text"])
            made = [pa.StructArray.from_arrays([x.column(n) for n in _DIGEST], _DIGEST) for x in sets([batch])]
            yield pa.concat_arrays(made) if made else pa.array([], pa.struct([(n, pa.int64()) for n in _DIGEST]))

    return F.arrow_udf(digests, "digest long, digest2 long, n_grams long", F.ArrowUDFType.SCALAR_ITER)


def keep_one(docs: DataFrame, params: JaccardParams | None = None) -> DataFrame:
    """The rows of ``docs`` without the near duplicates of a row that stays: of each class the rows of its smallest doc_id stay.

    All columns are kept. Wordless texts all stay, as do rows without a doc_id. Where a doc_id is that of several rows, each of them
    stays or goes by its own text.
    """
    p = params or JaccardParams()
    classes = table(_classified(docs, p), "classified")
    # stored, so that Spark knows its size: texts are shuffled only where the rows that go are too many to broadcast
    go = classes.filter("doc_id <> class_id")
    if not _repeats(classes):
        return docs.join(table(go.select("doc_id"), "go"), "doc_id", "left_anti").select(docs.columns)
    told = bounded_batches(docs).select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), _digests(p)("text").alias("set"))
    gone = table(go.select(F.col("doc_id").alias("id"), F.struct(*_DIGEST).alias("set")).distinct(), "go")
    return told.join(gone, ["id", "set"], "left_anti").select("row.*")
