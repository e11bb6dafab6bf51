"""Documents whose sets of word n-grams are alike: a prefix join under several orders.

A token is the 64-bit hash of an n-gram. Two sets x and y are linked when
100 * |x & y| >= threshold * |x | y|. Under *any* total order of all tokens,
linked sets share a token among the first |x| - ceil(t * |x|) + 1 of each. Three
orders are used and a pair must pass all of them before it is verified:

1. rare tokens first (by the count class of the commonest tokens, then by hash);
   this order's prefixes are joined;
2. ascending hash, of which longer prefixes must share more tokens;
3. descending hash, likewise.

Equal sets are folded into their smallest doc_id beforehand. A prefix token that
many sets share isn't met by all their pairs: first each set meets only the one
with the fewest rarer tokens (round one). Sets that get linked thereby are one
component already, and pairs within a component say nothing new. Then the sets
outside that one's component meet all others of the token (round two). Pairs that
are left out are within a component, so the components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import (
    LOWER,
    SPACED,
    Batches,
    components,
    in_arrow,
    mix,
    poly_hash,
    spare,
    texts,
    word_hashes,
)
from tidemark.session import written


def shingle_sets(some: list[bytes], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's n-grams.

    A text of fewer words has its whole sequence as one; without words, none.
    """
    buffer = b"\n".join(some).translate(LOWER)
    hashes, starts, _ = word_hashes(buffer, SPACED)
    ends = np.cumsum([len(t) + 1 for t in some])
    bounds = np.concatenate(([0], np.searchsorted(starts, ends)))
    grams = poly_hash(hashes, width)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            found = np.sort(grams[a : b - width + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        else:
            yield poly_hash(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def _slices(batches: Batches, size: int = 8 << 20):
    """Ids and texts of runs of rows with about so many bytes of text."""
    ids, some, held = [], [], 0
    for batch in batches:
        for key, t in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
            ids.append(key)
            some.append(t)
            held += len(t)
            if held >= size:
                yield ids, some
                ids, some, held = [], [], 0
    if some:
        yield ids, some


def _as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def summaries(docs: DataFrame, width: int, local_count: int) -> DataFrame:
    """A row per document (doc_id, n, s1, s2) and per token common in a task's share (token, df).

    s1 and s2 are sums over the set's tokens, so equal sets have equal ones.
    """

    def run(batches: Batches) -> Batches:
        held: list[np.ndarray] = []
        for ids, some in _slices(batches):
            sets = list(shingle_sets(some, width))
            n = np.array([len(s) for s in sets], np.int64)
            every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            edges = np.concatenate(([0], np.cumsum(n)))

            def sums(values, edges=edges):
                total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
                return _as_long(total[edges[1:]] - total[edges[:-1]])

            yield batch(ids, n, sums(mix(every + np.uint64(1))), sums(mix(every ^ np.uint64(0x5851F42D4C957F2D))), None, None)
            # Tokens are counted over many slices: a larger share says more.
            held.append(every)
            if sum(map(len, held)) >= 4_000_000:
                yield from common(held)
        yield from common(held)

    def common(held: list[np.ndarray]) -> Batches:
        every = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
        held.clear()
        heads = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.zeros(0, int)
        counts = np.diff(np.append(heads, len(every)))
        often = counts >= local_count
        if often.any():
            yield batch(None, None, None, None, _as_long(every[heads[often]]), counts[often])

    def batch(*columns) -> pa.RecordBatch:
        size = max(len(c) for c in columns if c is not None)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(size, pa.int64()) if c is None else pa.array(c, pa.int64()) for c in columns],
            names=["doc_id", "n", "s1", "s2", "token", "df"],
        )

    return in_arrow(docs, run, "doc_id long, n long, s1 long, s2 long, token long, df long")


def common_tokens(summary: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The commonest tokens, sorted, at most ``limit``, and the classes of their counts.

    A class is a count's binary length; as many of the highest classes are taken as
    fit. They only shape the first order: whichever tokens are in it, no link is lost.
    """
    counts = summary.where("token is not null").groupBy("token").agg(F.sum("df").alias("df"))
    counts = written(counts.select("token", F.ceil(F.log2(F.col("df") + 1)).cast("int").alias("class")), "common")
    least, held = 100, 0
    for r in sorted(counts.groupBy("class").count().collect(), key=lambda r: -r["class"]):
        held += r["count"]
        if held > limit:
            break
        least = r["class"]
    rows = counts.where(F.col("class") >= least).toArrow()
    tokens = rows.column("token").to_numpy().view(np.uint64)
    by = np.argsort(tokens)
    return tokens[by], rows.column("class").to_numpy()[by].astype(np.uint8)


def first_order(tokens: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Tokens by rising count class, then hash (they come sorted by hash)."""
    known, classes = common
    if not len(known):
        return tokens
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    rank = np.where(known[at] == tokens, classes[at], np.uint8(0))
    return tokens[np.argsort(rank, kind="stable")]


def prefix_size(n: int, threshold: int) -> int:
    return n - -(-threshold * n // 100) + 1


def prefix_rows(docs: DataFrame, common, width: int, threshold: int) -> DataFrame:
    """(token, doc_id, place): the first tokens of each set; place has position and size."""
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Batches) -> Batches:
        for ids, some in _slices(batches):
            keys, places, parts = [], [], []
            for key, s in zip(ids, shingle_sets(some, width), strict=True):
                if len(s):
                    size = prefix_size(len(s), threshold)
                    parts.append(first_order(s, sent.value)[:size])
                    keys.append(np.full(size, key, np.int64))
                    places.append(np.arange(size, dtype=np.int64) << 32 | len(s))
            if parts:
                columns = (_as_long(np.concatenate(parts)), np.concatenate(keys), np.concatenate(places))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "doc_id", "place"])

    return in_arrow(docs, run, "token long, doc_id long, place long")


def _position(place: str) -> Column:
    return F.shiftright(F.col(place), 32)


def _size(place: str) -> Column:
    return F.col(place).bitwiseAND(F.lit(0xFFFFFFFF))


def _may_link(a: str, b: str, threshold: int) -> Column:
    """Length and position filter for a token that is the first the two sets share."""
    low, high = F.least(_size(a), _size(b)), F.greatest(_size(a), _size(b))
    most = F.least(_size(a) - _position(a), _size(b) - _position(b))
    return (100 * low >= threshold * high) & ((100 + threshold) * most >= threshold * (low + high))


def _assigned(pairs: DataFrame, members: int = 200) -> DataFrame:
    """(doc_id, center, part, role): what each set is needed for.

    The members (role 1) of a center (role 0) are cut into parts of about
    ``members``; the center's set goes to each of its parts.
    """
    hot = pairs.groupBy("center").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > members)
    part = F.when(F.col("_n").isNotNull(), F.pmod(F.xxhash64("member"), F.ceil(F.col("_n") / members))).otherwise(0)
    parted = pairs.join(hot, "center", "left").select("center", "member", part.cast("int").alias("part"))
    centers = parted.select(F.col("center").alias("doc_id"), "center", "part", F.lit(0).alias("role")).distinct()
    return centers.union(parted.select(F.col("member").alias("doc_id"), "center", "part", F.lit(1).alias("role")))


def needed(n: int, m: int, threshold: int) -> int:
    """The least intersection of linked sets of these sizes."""
    return -(-threshold * (n + m) // (100 + threshold))


def share_prefix(x: np.ndarray, y: np.ndarray, n: int, m: int, threshold: int) -> bool:
    """Whether two sets may be linked, from the first tokens of each under one order.

    Sets of n and m tokens that share ``need`` or more share at least k of their
    first n - need + k and m - need + k tokens; k is as large as what is given allows.
    """
    need = needed(n, m, threshold)
    k = min(len(x) - n, len(y) - m) + need
    if need > min(n, m):
        return False
    if k < 1:
        return True
    return len(np.intersect1d(x[: n - need + k], y[: m - need + k], assume_unique=True)) >= k


def _passed(pairs: DataFrame, rows: DataFrame, width: int, threshold: int, most_sent: int, whole: bool) -> DataFrame:
    """Pairs (center, member) that pass order two, or, with ``whole``, order three and are linked.

    Each set travels once for each center it is held against, and a center's once
    for each part of its members; a task takes them in order, one at a time. For
    order two a fifth of each set travels, and of its tokens the upper halves:
    those agree wherever the tokens do, so no link is lost.
    """
    pairs = written(pairs, "pairs")
    assigned = written(_assigned(pairs), "assigned")
    few = assigned.count() <= most_sent
    ids = assigned.select("doc_id").distinct()
    kind = "long" if whole else "int"

    def sets(batches: Batches) -> Batches:
        for keys, some in _slices(batches, 1 << 20):
            sizes, sent = [], []
            for s in shingle_sets(some, width):
                sizes.append(len(s))
                sent.append(_as_long(s) if whole else (s[: _fifth(len(s))] >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), _lists(sent, pa.int64() if whole else pa.int32())],
                names=["doc_id", "n", "tokens"],
            )

    def held(batches: Batches) -> Batches:
        center, mine = None, []
        for b in batches:
            n, tokens, found = b.column(3).to_pylist(), b.column(4), []
            for i, (c, part, role) in enumerate(zip(*(b.column(j).to_pylist() for j in (0, 1, 2)), strict=True)):
                this = (n[i], tokens[i].values.to_numpy())
                if (c, part) != center:
                    center, mine = (c, part), []
                if role == 0:
                    mine.append(this)
                elif any(test(this, other) for other in mine):
                    found.append((c, b.column(5)[i].as_py()))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["center", "member"])

    def test(a, b) -> bool:
        (n, x), (m, y) = a, b
        if not whole:
            return share_prefix(x, y, n, m, threshold)
        if not share_prefix(x[::-1][: _fifth(n)], y[::-1][: _fifth(m)], n, m, threshold):
            return False
        return len(np.intersect1d(x, y, assume_unique=True)) >= needed(n, m, threshold)

    named = rows.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    made = in_arrow(named, sets, f"doc_id long, n int, tokens array<{kind}>")
    placed = (
        made.join(F.broadcast(assigned) if few else assigned, "doc_id")
        .select("center", "part", "role", "n", "tokens", "doc_id")
        .repartition("center", "part")
        .sortWithinPartitions("center", "part", "role")
    )
    return in_arrow(placed, held, "center long, member long").distinct()


def _fifth(n: int) -> int:
    return min(n, max(32, n // 5))


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays])))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(arrays) if arrays else [], kind))


def near_groups(
    docs: DataFrame,
    width: int = 3,
    threshold: int = 90,
    common_limit: int = 1_000_000,
    local_count: int = 2,
    most_sent: int = 500_000,
) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``docs`` (doc_id, text).

    ``threshold`` is the least Jaccard similarity in hundredths, over sets of
    ``width`` consecutive words (cut at space and 0x09-0x0D, A-Z lower-cased).
    ``common_limit`` bounds the table of common tokens that is sent to all tasks;
    lists of at most ``most_sent`` ids are sent, longer ones are joined. None of
    the options changes the result.

    Null texts and texts without words have an empty set and are alone. Texts of
    one doc_id count as linked with each other. A row whose id is null has a null
    component and takes part in no link. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    summary = written(summaries(rows, width, local_count), "shingle-sets")
    each = summary.where("n is not null").select("doc_id", "n", "s1", "s2")
    groups = written(
        each.where("n > 0 and doc_id is not null")
        .groupBy("n", "s1", "s2")
        .agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")),
        "equal-sets",
    )
    many = groups.where("copies > 1").select("n", "s1", "s2", "first")
    copies = written(
        each.join(many, ["n", "s1", "s2"]).where("doc_id <> first").select("doc_id", "first").distinct(), "copies"
    )
    # Only a copy all of whose rows are copies may be left out of the search; an id with several texts stays.
    several = each.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id")
    folded = copies.select("doc_id").join(several, "doc_id", "left_anti")
    folded = F.broadcast(folded) if copies.count() <= most_sent else folded
    unique = rows.where("doc_id is not null").join(folded, "doc_id", "left_anti")

    prefixes = written(prefix_rows(unique, common_tokens(summary, common_limit), width, threshold), "prefixes")
    buckets = (
        prefixes.groupBy("token")
        .agg(
            F.min("place").alias("pivot_place"),
            F.min_by("doc_id", "place").alias("pivot"),
            F.count(F.lit(1)).alias("members"),
        )
        .where("members > 1")
        .drop("members")
    )
    shared = written(prefixes.join(buckets, "token"), "shared")
    star = shared.where("doc_id <> pivot").where(_may_link("place", "pivot_place", threshold))
    first_pairs = star.select(F.col("pivot").alias("center"), F.col("doc_id").alias("member")).distinct()
    first_links = written(_linked(first_pairs, rows, width, threshold, most_sent), "links")

    labels = components(first_links).withColumnRenamed("node", "doc_id")
    labelled = written(
        shared.join(labels, "doc_id", "left").select(
            "token", "doc_id", "place", "pivot", F.coalesce("root", "doc_id").alias("root")
        ),
        "labelled",
    )
    pivots = labelled.where("doc_id = pivot").select("token", F.col("root").alias("pivot_root")).distinct()
    outside = labelled.join(pivots, "token").where("root <> pivot_root")
    x = outside.select("token", F.col("doc_id").alias("u"), F.col("place").alias("u_place"), F.col("root").alias("u_root"))
    y = labelled.select("token", F.col("doc_id").alias("v"), F.col("place").alias("v_place"), F.col("root").alias("v_root"))
    met = x.join(y, "token").where("u_root <> v_root").where(_may_link("u_place", "v_place", threshold))
    second_pairs = met.select(F.col("u").alias("center"), F.col("v").alias("member")).distinct()
    second_links = _linked(second_pairs, rows, width, threshold, most_sent)
    links = first_links.union(second_links).union(copies.select(F.col("first").alias("a"), F.col("doc_id").alias("b")))
    found = components(links).select(F.col("node").alias("doc_id"), "root")
    return each.join(found, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id")
    )


def _linked(pairs: DataFrame, rows: DataFrame, width: int, threshold: int, most_sent: int) -> DataFrame:
    """Links (a, b) among pairs: first by the prefixes of order two, then by order three and whole sets."""
    left = _passed(pairs, rows, width, threshold, most_sent, whole=False)
    links = _passed(left, rows, width, threshold, most_sent, whole=True)
    return links.select(F.col("center").alias("a"), F.col("member").alias("b"))


def one_of_each(docs: DataFrame, most_sent: int = 500_000, **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their group, once each, unchanged.

    Rows that share an id are folded into one (the smallest by text); rows without
    an id all stay. The texts are shuffled only if more than ``most_sent`` ids go.
    """
    groups = near_groups(docs, most_sent=most_sent, **options)
    ids = written(
        groups.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("root"))
        .where("n > 1 or doc_id <> root"),
        "not-first",
    )
    sent = F.broadcast if ids.count() <= most_sent else (lambda x: x)
    alone = docs.join(sent(ids.select("doc_id")), "doc_id", "left_anti").select(docs.columns)
    repeated = docs.join(sent(ids.where("n > 1 and doc_id = root").select("doc_id")), "doc_id", "left_semi")
    window = Window.partitionBy("doc_id").orderBy("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    mark = spare("rank", docs.columns)
    first = repeated.withColumn(mark, F.row_number().over(window)).where(F.col(mark) == 1)
    return alone.union(first.select(docs.columns))
