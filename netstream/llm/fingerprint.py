"""Document fingerprints by winnowing.

A text's words (``[^\\x20\\x09-\\x0D]+``) are hashed, every ``K`` consecutive
words form a rolling hash, and of each ``WINDOW`` consecutive hashes the
smallest is kept (of equal ones the rightmost) with its place.  Two texts that
share ``K + WINDOW - 1`` words in a row therefore share a fingerprint there, and
the places say where.  Texts of fewer than ``K`` words have one hash of all
their words, texts of fewer than ``WINDOW`` hashes one window.

Only DataFrame functions: a text is one row, its words, hashes and minima are
arrays made by higher-order functions, so fingerprinting is a map without a
shuffle.  Elements are read by ``get`` (constant time; ``slice`` copies the array).

``with_next`` gives each document the next one's text by ascending id, and the
last one the first's.  Documents are cut into blocks of neighbouring ids at
quantiles of the id, each block also gets the first document of the block after
it, and ``lead`` runs within the blocks: one shuffle of the text, no global
sort, and blocks are alike in size whatever the ids' distribution.

Defined cases: a null text is empty; a text without words has an empty
fingerprint, two empty fingerprints have likeness 1, an empty and another 0; a
null id comes first; rows that repeat an id follow each other in the order of
their texts; a single document is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netstream.llm.common import KEY, TEXT, id_of, keyed_texts, let
from netstream.session import shuffle_partitions

K = 4
WINDOW = 8
PLACE_BITS = 24
_PLACES = (1 << PLACE_BITS) - 1


def fingerprint(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """``array<bigint>`` in the order of the places: the upper 40 bits are the
    hash, the lower ``PLACE_BITS`` the place (see ``place_of``, ``hash_of``), so
    the least of a window is its smallest hash and of equal ones the
    rightmost."""
    words = F.filter(F.split(text, "[ \t\n\x0b\f\r]+"), lambda w: w != "")

    def placed(h: Column, i: Column) -> Column:
        return h.bitwiseAND(F.lit(~_PLACES)).bitwiseOR(F.lit(_PLACES) - i.cast("long").bitwiseAND(F.lit(_PLACES)))

    def grams(hashes: Column) -> Column:
        n = F.size(hashes)
        short = F.array(placed(F.xxhash64(n, hashes), F.lit(0)))
        full = F.transform(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))),
                           lambda i: placed(F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]), i))
        return F.when(n == 0, F.array().cast("array<bigint>")).when(n < k, short).otherwise(full)

    def minima(h: Column) -> Column:
        last = F.greatest(F.size(h) - window, F.lit(0))
        least = F.transform(F.sequence(F.lit(0), last), lambda i: F.least(*[F.get(h, i + j) for j in range(window)]))
        return F.when(F.size(h) == 0, h).otherwise(F.array_distinct(least))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda hs: let(grams(hs), minima))


def place_of(picked: Column) -> Column:
    """The place (in words, modulo ``2**PLACE_BITS``) of an element."""
    return F.lit(_PLACES) - picked.bitwiseAND(F.lit(_PLACES))


def hash_of(picked: Column) -> Column:
    return F.shiftrightunsigned(picked, PLACE_BITS)


def as_text(fp: Column) -> Column:
    """``place:hash`` in hexadecimal, one after the other."""
    return F.array_join(F.transform(fp, lambda x: F.concat(F.hex(place_of(x)), F.lit(":"), F.hex(hash_of(x)))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the hashes of two fingerprints."""
    def hashes(fp):
        return F.transform(fp, hash_of)
    together = F.size(F.array_union(hashes(a), hashes(b)))
    return F.when(together == 0, 1.0).otherwise(F.size(F.array_intersect(hashes(a), hashes(b))) / together)


def in_blocks(texts: DataFrame, blocks: int) -> DataFrame:
    """``texts`` with ``block``, ascending with the key; every block also holds
    the first row of the next block (``extra``; after the last: the first)."""
    cuts = texts.agg(F.percentile_approx(KEY, [i / blocks for i in range(1, blocks)] or [0.5], 10_000)).first()[0]
    cuts = sorted(set(cuts or [])) if blocks > 1 else []
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]).cast("array<bigint>")
    rows = texts.withColumn("block", F.size(F.filter(bounds, lambda c: c < F.col(KEY))))
    before = Window.partitionBy(F.lit(0)).orderBy("block")  # over one narrow row per block
    first = (rows.groupBy("block").agg(F.min(KEY).alias(KEY))
             .withColumn("to", F.lag("block").over(before))
             .withColumn("last", F.max("block").over(Window.partitionBy(F.lit(0))))
             .select(KEY, F.coalesce("to", "last").alias("block")))
    firsts = (texts.join(F.broadcast(first), KEY)  # a row per block
              .groupBy("block", KEY).agg(F.min(TEXT).alias(TEXT)).select(KEY, TEXT, "block", F.lit(True).alias("extra")))
    return rows.withColumn("extra", F.lit(False)).unionByName(firsts)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """Per row: ``id_col``, text, edited text, and the fingerprints of both and
    of the next document (``fp``, ``edited_fp``, ``next_fp``)."""
    texts = keyed_texts(docs, id_col, text_col)
    blocked = in_blocks(texts, blocks or shuffle_partitions(docs.sparkSession))
    order = Window.partitionBy("block").orderBy("extra", KEY, TEXT)
    n = F.length(TEXT)
    half = F.floor(n / 2).cast("int")
    followed = (blocked.withColumn("next_text", F.lead(TEXT).over(order))  # only the text is shuffled
                .withColumn("fp", fingerprint(F.col(TEXT))).withColumn("next_fp", F.lead("fp").over(order))
                .where(~F.col("extra")))
    edited = F.concat(F.substring(F.col(TEXT), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    return (followed.withColumn("edited", edited).withColumn("edited_fp", fingerprint(F.col("edited")))
            .select(id_of().alias(id_col), F.col(TEXT).alias("text"), "edited", "fp", "edited_fp", "next_fp"))


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` and their edited texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    f = fingerprints(docs)
    return f.select("doc_id", F.length("text").cast("long").alias("n_chars"),
                    F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                    as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                    likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                    likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
