"""MinHash near-dedup with tensored banding.

Words are lower-cased (A-Z); a document's set is its distinct 5-word shingles
(fewer words: the whole sequence is one shingle; none: the empty set, linked
with nothing).  Documents are linked if
``100 * |intersection| >= 75 * |union|``; a component keeps its smallest id.

Two sides of ``SIDE`` collections, each of ``ROWS`` minhashes, are computed per
document, and a table key is a pair of one collection of either side: ``SIDE *
SIDE`` tables from ``2 * SIDE * ROWS`` minhashes instead of ``SIDE * SIDE * 2 *
ROWS``.  Two documents of similarity s meet in a table with probability
``(1 - (1 - s**ROWS)**SIDE)**2``: above 0.9998 at 0.75, 0.99999 at 0.8.

1. Documents of equal sets are one class, represented by its smallest id; only
   representatives go on, so large groups of copies end here.
2. Collections that one document alone has cannot match; keys are formed from
   the others only, buckets of one document dropped.
3. In ``STAR_ROUNDS`` rounds every document is compared with one document, the
   one that leads most of its buckets among those not yet in its component
   (leaders by a hash that differs by round).  These links are verified and
   components formed.  A group of n near copies needs about n comparisons.
4. What then shares a bucket but no component is compared in full, so no link
   that could join two components is left out.  Buckets of up to
   ``SMALL_BUCKET`` documents are joined with themselves.  Larger ones come from
   large groups of near copies; they are put together to groups, and a group is
   laid out in tiles of bounded size: blocks of the documents outside its
   largest component, against each other and against blocks of that component.
   A tile gets each document's set once, compares the pairs that share a table
   key and no component, and returns one link per document and component - not
   the pairs.

A comparison first checks sizes and the estimate from all minhashes (a pair of
similarity 0.75 fails it with probability below 1e-6), then the full sets.

Defined cases: a null text is empty; rows that repeat an id are one document
(each row keeps its own ``n_shingles``); a null id comes first and is kept as a
document; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstream.llm.common import (DOC, KEY, Chunk, Rows, forget, mix, run_hashes, signed, whole_runs,
                                  word_chunks)
from netstream.llm.components import components, heads
from netstream.session import cut_lineage, shuffles_dropped

SHINGLE = 5
SIMILAR, OUT_OF = 75, 100
SIDE, ROWS = 17, 3
STAR_ROUNDS = 2
MIN_ESTIMATE = 0.54
SMALL_BUCKET = 24
BLOCK_DOCS, BLOCK_SHINGLES = 1_024, 500_000
SKETCH = (f"{KEY} long, n_shingles long, d1 long, d2 long, side_a array<long>, side_b array<long>, mins binary")


def chunk_shingles(chunk: Chunk, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``(document, hash)`` of the distinct shingles, ordered."""
    at = whole_runs(chunk.counts, k)
    doc, h = [chunk.doc[at]], [run_hashes(chunk.hashes, k)[at]]
    short = np.flatnonzero((chunk.counts > 0) & (chunk.counts < k))
    for n in range(1, k):
        some = short[chunk.counts[short] == n]
        if len(some):
            doc.append(some)
            h.append(run_hashes(chunk.hashes, n, seed=n)[chunk.first[some]])
    doc, h = np.concatenate(doc), np.concatenate(h)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]))[:len(doc)]
    return doc[new], h[new]


def _constants() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(75)
    n = 2 * SIDE * ROWS
    return random.integers(0, 1 << 64, n, np.uint64) | np.uint64(1), random.integers(0, 1 << 64, n, np.uint64)


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    times, plus = _constants()
    side = np.arange(2 * SIDE, dtype=np.uint64)
    for chunk in word_chunks(batches, lower=True):
        n_docs = len(chunk.keys)
        doc, h = chunk_shingles(chunk)
        sizes = np.bincount(doc, minlength=n_docs)
        some = np.flatnonzero(sizes)
        mins = np.zeros((n_docs, len(times)), np.uint64)
        digest = np.zeros((n_docs, 2), np.uint64)
        if len(some):
            starts = np.searchsorted(doc, some)
            for j, (a, b) in enumerate(zip(times, plus)):
                x = h * a + b
                x ^= x >> np.uint64(32)
                mins[some, j] = np.minimum.reduceat(x, starts)
            for j in range(2):
                digest[some, j] = np.add.reduceat(mix(h + np.uint64(j + 1)), starts)
        keys = mix(mins.reshape(n_docs, 2 * SIDE, ROWS)[:, :, 0] + side)
        for r in range(1, ROWS):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + mins.reshape(n_docs, 2 * SIDE, ROWS)[:, :, r])
        keys = signed(keys)
        offsets = pa.array(np.arange(n_docs + 1, dtype=np.int32) * SIDE)
        sides = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(part).ravel()))
                 for part in (keys[:, :SIDE], keys[:, SIDE:])]
        low = (mins & np.uint64(255)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunk.keys), pa.array(sizes), pa.array(signed(digest[:, 0].copy())),
             pa.array(signed(digest[:, 1].copy())), *sides, pa.array([row.tobytes() for row in low], pa.binary())],
            names=[KEY, "n_shingles", "d1", "d2", "side_a", "side_b", "mins"])


def _shared(nodes: DataFrame, side: str) -> DataFrame:
    """``(id, key)``: collections of one side that several nodes have."""
    keys = nodes.select("id", F.explode(side).alias("key"))
    several = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return keys.join(several, "key").groupBy("id").agg(F.collect_list("key").alias(side))


def table_buckets(nodes: DataFrame) -> DataFrame:
    """``(id, bucket, size)``: table keys that several nodes have."""
    both = cut_lineage(_shared(nodes, "side_a").join(_shared(nodes, "side_b"), "id"), name="shared")
    keys = (both.select("id", F.explode("side_a").alias("a"), "side_b")
            .select("id", "a", F.explode("side_b").alias("b"))
            .select("id", F.xxhash64("a", "b").alias("bucket")))
    several = keys.groupBy("bucket").agg(F.count(F.lit(1)).cast("int").alias("size")).where("size > 1")
    buckets = cut_lineage(keys.join(several, "bucket").select("id", "bucket", "size"), name="buckets")
    forget(both)
    return buckets


def _placed(buckets: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return buckets.withColumn("component", F.col("id"))
    return (buckets.join(comps, "id", "left")
            .select("id", "bucket", "size", F.coalesce("component", "id").alias("component")))


def star_pairs(placed: DataFrame, salt: int) -> DataFrame:
    """One pair per node: with the leader of most of its buckets, outside its
    own component."""
    order = F.struct(F.xxhash64(F.lit(salt), "id").alias("h"), "id", "component")
    lead = (placed.groupBy("bucket").agg(F.min(order).alias("lead"), F.min("component").alias("lo"),
                                         F.max("component").alias("hi")).where("lo <> hi").select("bucket", "lead"))
    shared = (placed.join(lead, "bucket").where("component <> lead.component")
              .groupBy("id", F.col("lead.id").alias("other")).agg(F.count(F.lit(1)).alias("n")))
    return (shared.groupBy("id").agg(F.max(F.struct("n", "other")).alias("m"))
            .select(F.col("id").alias("a"), F.col("m.other").alias("b")))


def mixed_buckets(placed: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components."""
    mixed = (placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo <> hi").select("bucket"))
    return placed.join(mixed, "bucket")


def crossing_pairs(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs of (small) buckets that share no component; sizes are checked
    inside the join."""
    rows = rows.join(sizes, "id")
    a, b = rows.alias("a"), rows.alias("b")
    fits = (F.col("a.n") * OUT_OF >= F.col("b.n") * SIMILAR) & (F.col("b.n") * OUT_OF >= F.col("a.n") * SIMILAR)
    return (a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.id") < F.col("b.id"))
                   & (F.col("a.component") != F.col("b.component")) & fits)
            .select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct())


def tiles(rows: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """``(tile, kind, r, p, right, id, component, ...)``: the documents of large
    mixed buckets, each in the tiles in which it has to be compared."""
    # components that share a bucket make a group; a component counts once per bucket
    shared = rows.select("bucket", "component").distinct()
    lead = shared.groupBy("bucket").agg(F.min("component").alias("b"))
    groups = components(shared.join(lead, "bucket").select(F.col("component").alias("a"), "b"))
    groups = groups.select(F.col("id").alias("component"), F.col("component").alias("group"))
    docs = (rows.select("id", "component").distinct().join(groups, "component")
            .join(nodes.select("id", "n", "side_a", "side_b", "mins"), "id"))
    docs = cut_lineage(docs, name="grouped")
    parts = docs.groupBy("group", "component").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
    main = parts.groupBy("group").agg(F.max(F.struct("docs", "component", "shingles")).alias("main"),
                                      F.sum("docs").alias("docs"), F.sum("shingles").alias("shingles"))

    def blocks(docs, shingles):
        return F.greatest(F.ceil(docs / BLOCK_DOCS), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)).cast("int")
    plan = main.select("group", F.col("main.component").alias("main"),
                       blocks(F.col("main.docs"), F.col("main.shingles")).alias("mains"),
                       blocks(F.col("docs") - F.col("main.docs"),
                              F.col("shingles") - F.col("main.shingles")).alias("rests"))
    docs = docs.join(plan, "group").withColumn("in_main", F.col("component") == F.col("main"))
    h = F.xxhash64("id")
    own = F.pmod(h, F.when(F.col("in_main"), F.col("mains")).otherwise(F.col("rests")).cast("long")).cast("int")

    def upto(n):
        return F.sequence(F.lit(0), n - 1)
    with_main = F.when(F.col("in_main"), F.transform(upto(F.col("rests")), lambda r: F.struct(
        F.lit("m").alias("kind"), r.alias("r"), F.col("own").alias("p"), F.lit(False).alias("right"))))
    with_main = with_main.otherwise(F.transform(upto(F.col("mains")), lambda p: F.struct(
        F.lit("m").alias("kind"), F.col("own").alias("r"), p.alias("p"), F.lit(True).alias("right"))))
    with_rest = F.when(F.col("in_main"), F.array().cast(
        "array<struct<kind:string,r:int,p:int,right:boolean>>")).otherwise(
        F.transform(upto(F.col("rests")), lambda q: F.struct(
            F.lit("r").alias("kind"), F.greatest(q, F.col("own")).alias("r"), F.least(q, F.col("own")).alias("p"),
            (q < F.col("own")).alias("right"))))
    placed = (docs.withColumn("own", own).withColumn("at", F.explode(F.concat(with_main, with_rest)))
              .select("id", "component", "n", "side_a", "side_b", "mins", "group", "at.*"))
    return placed.join(sets.withColumnRenamed(KEY, "id"), "id")


def _tile_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """One verified link per document and component of a tile."""
    def of(rows):
        return (rows["id"].to_numpy(), rows["component"].to_numpy(), rows["n"].to_numpy(),
                *(np.stack(rows[c].to_numpy()) for c in ("side_a", "side_b")),
                np.stack([np.frombuffer(m, np.uint8) for m in rows["mins"]]),
                [np.frombuffer(x, np.uint64) for x in rows["shingles"]])
    pdf = pdf.sort_values("id", kind="stable")
    kind, r, p = pdf["kind"].iloc[0], pdf["r"].iloc[0], pdf["p"].iloc[0]
    alone = kind == "r" and r == p
    x = pdf if alone else pdf[~pdf["right"]]
    y = pdf if alone else pdf[pdf["right"]]
    out = []
    if len(x) and len(y):
        xid, xc, xn, xa, xb, xm, xs = of(x)
        yid, yc, yn, ya, yb, ym, ys = of(y)
        shared = overlaps(xs, ys)
        for i in range(len(x)):  # a row of the tile at a time
            ok = (yc != xc[i]) & (ya == xa[i]).any(1) & (yb == xb[i]).any(1) & ((ym == xm[i]).mean(1) >= MIN_ESTIMATE)
            both = shared(i)
            hits = np.flatnonzero(ok & (OUT_OF * both >= SIMILAR * (xn[i] + yn - both)))
            _, first = np.unique(yc[hits], return_index=True)
            out += [(int(xid[i]), int(yid[j])) for j in hits[first]]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def overlaps(xs: list[np.ndarray], ys: list[np.ndarray]):
    """A function of i: the size of the intersection of ``xs[i]`` with each of
    ``ys`` (all sorted, without repeats)."""
    order = np.argsort(flat := np.concatenate(ys), kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(ys)), [len(y) for y in ys])[order]

    def count(i: int) -> np.ndarray:
        a, b = np.searchsorted(flat, xs[i], "left"), np.searchsorted(flat, xs[i], "right")
        n = b - a
        at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(owner[at], minlength=len(ys))
    return count


def _likely(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    width = 2 * SIDE * ROWS
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, width) for c in ("ma", "mb"))
        n, m = (batch.column(c).to_numpy() for c in ("na", "nb"))
        ok = (a == b).mean(1) >= MIN_ESTIMATE
        ok &= (n * OUT_OF >= m * SIMILAR) & (m * OUT_OF >= n * SIMILAR)
        yield batch.select(["a", "b"]).filter(pa.array(ok))


def likely_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose sizes and sketches allow the similarity."""
    def with_(side):
        return nodes.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("mins").alias(f"m{side}"))
    return (pairs.join(with_("a"), "a").join(with_("b"), "b").select("a", "b", "na", "nb", "ma", "mb")
            .mapInArrow(_likely, "a long, b long"))


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for chunk in word_chunks(batches, lower=True):
        doc, h = chunk_shingles(chunk)
        ends = np.searchsorted(doc, np.arange(len(chunk.keys) + 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunk.keys), pa.array([h[x:y].tobytes() for x, y in zip(ends, ends[1:])], pa.binary())],
            names=[KEY, "shingles"])


def _confirmed(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("sa"), batch.column("sb")):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            small, large = (x, y) if len(x) < len(y) else (y, x)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int((large[at] == small).sum())
            ok.append(OUT_OF * both >= SIMILAR * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def confirmed_links(pairs: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    pairs = cut_lineage(likely_pairs(pairs, nodes), name="pairs")

    def with_(side):
        return sets.select(F.col(KEY).alias(side), F.col("shingles").alias(f"s{side}"))
    links = (pairs.join(with_("b"), "b").join(with_("a"), "a").select("a", "b", "sa", "sb")
             .mapInArrow(_confirmed, "a long, b long"))
    links = cut_lineage(links, name="links")
    forget(pairs)
    return links


def joined(comps: DataFrame | None, *links: DataFrame) -> DataFrame:
    """``(id, component)`` by ``comps`` and further links; the first of each
    component is left out."""
    known = [] if comps is None else [comps.select(F.col("id").alias("a"), F.col("component").alias("b"))]
    whole = heads(reduce(DataFrame.union, [*known, *links]))
    forget(*links, *([] if comps is None else [comps]))
    return whole


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of each row."""
    rows = Rows(docs, id_col, text_col)
    found = rows.with_ids(groups(rows.texts()), KEY, "component_id")
    return found.select(F.col(KEY).alias(id_col), "n_shingles", "component_id", "kept")


def groups(texts: DataFrame) -> DataFrame:
    """``KEY, n_shingles, component_id, kept`` of ``texts(KEY, TEXT)``, one text
    per key."""
    with shuffles_dropped(texts.sparkSession):
        return _groups(texts)


def _groups(texts: DataFrame) -> DataFrame:
    sketches = cut_lineage(texts.mapInArrow(_sketches, SKETCH), name="sketches")
    rep = sketches.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(F.min(KEY).alias("rep"))
    member = (sketches.select(KEY, "n_shingles", "d1", "d2").join(rep, ["d1", "d2", "n_shingles"], "left")
              .select(KEY, "n_shingles", F.coalesce("rep", KEY).alias("rep")))
    member = cut_lineage(member, name="classes")
    reps = member.where(f"{KEY} = rep AND n_shingles > 0").select("rep").distinct()
    nodes = (sketches.where("n_shingles > 0").join(reps, sketches[KEY] == reps["rep"], "left_semi")
             .groupBy(F.col(KEY).alias("id"))
             .agg(F.max(F.struct(F.col("n_shingles").alias("n"), "mins", "side_a", "side_b")).alias("s"))
             .select("id", "s.*"))
    nodes = cut_lineage(nodes, name="nodes")
    forget(sketches)
    buckets = table_buckets(nodes)
    sets = (texts.join(buckets.select(F.col("id").alias(KEY)).distinct(), KEY, "left_semi")
            .mapInArrow(_sets, f"{KEY} long, shingles binary")
            .groupBy(KEY).agg(F.max("shingles").alias("shingles")))  # equal rows have one key and one set
    sets = cut_lineage(sets, name="sets")
    comps = None
    for step in range(STAR_ROUNDS):
        links = confirmed_links(star_pairs(_placed(buckets, comps), step), nodes, sets)
        comps = joined(comps, links)
    rows = cut_lineage(mixed_buckets(_placed(buckets, comps)), name="mixed")
    small = rows.where(F.col("size") <= SMALL_BUCKET)
    links = confirmed_links(crossing_pairs(small, nodes.select("id", "n")), nodes, sets)
    large = tiles(rows.where(F.col("size") > SMALL_BUCKET), nodes, sets)
    across = cut_lineage(large.groupBy("group", "kind", "r", "p").applyInPandas(
        lambda pdf: _tile_links(pdf), "a long, b long"), name="links")
    whole = joined(comps, links, across)
    forget(buckets, sets, nodes, rows)
    # a class is in the component of its representative, its smallest id
    found = F.coalesce("component", "rep")
    return (member.join(whole, F.col("rep") == F.col("id"), "left")
            .select(KEY, "n_shingles", found.alias("component_id"), (found == F.col(KEY)).alias("kept")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that are not the first of their group."""
    rows = Rows(docs, id_col, text_col)
    gone = groups(rows.texts()).where(~F.col("kept")).select(KEY).distinct()
    return rows.table.join(gone, KEY, "left_anti").select(f"{DOC}.*")


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` with their components."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs)
