"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all values within half the radius; two
fingerprints within the radius meet at a common value.  Buckets hold at most
one Hamming ball of distinct fingerprints (65 at radius 2), whatever the
corpus: copies share a fingerprint and are folded before anything is emitted.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import workers_import_package, written
from .components import connected_components

BITS = 64
SEED = 42
_BLOCK = 1 << 16    # shingles whose bits are counted at a time


def fingerprint_of(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the ASCII-lower-cased words of `text` (unsigned)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    ones = np.zeros(BITS, np.int64)
    total = len(words) - shingle + 1
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, total, _BLOCK):
        part = words[at:at + _BLOCK + shingle - 1]
        hashes = np.array([digest(join(s), SEED) for s in zip(*(part[i:] for i in range(shingle)))],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > total))


def fingerprint_column(text: Column, shingle: int) -> Column:
    """Fingerprint as a (signed) long; null and wordless texts give 0."""
    @F.pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, shingle) for t in texts], dtype=np.uint64).astype(np.int64))
    return udf(text)


def ball(radius: int) -> list[int]:
    """All 64-bit masks of at most `radius` ones, as signed longs."""
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(BITS), r)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _emit(prints: DataFrame, radius: int) -> DataFrame:
    masks = F.array(*[F.lit(m) for m in ball(radius)])
    return prints.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))


def links(prints: DataFrame, max_distance: int) -> DataFrame:
    """`prints(fp)` of distinct fingerprints -> verified links (a, b), deduplicated.

    Even radius: all of a bucket lie within the radius of each other, so links
    from the smallest to each keep everything connected and none are lost
    between components.  Odd radius: one side emits the smaller, the other the
    larger half-ball, and every meeting pair is verified."""
    if max_distance % 2 == 0:
        bucket = Window.partitionBy("variant")
        pairs = _emit(prints, max_distance // 2).select(
            F.min("fp").over(bucket).alias("a"), F.col("fp").alias("b")).where("a < b")
    else:
        near = _emit(prints, max_distance // 2).select(F.col("fp").alias("a"), "variant")
        far = _emit(prints, max_distance // 2 + 1).select(F.col("fp").alias("b"), "variant")
        pairs = near.join(far, "variant").where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance).distinct()


def classes(prints: DataFrame, max_distance: int) -> DataFrame:
    """`prints(fp, low_id)`, one row a fingerprint -> (fp, component_id, component_fp): the
    smallest id reachable over links (nulls only if there is no other) and the
    smallest fingerprint that carries it."""
    roots = connected_components(links(prints.select("fp"), max_distance), "simhash")
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "low_id", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "simhash-classes")
    order = F.struct(F.col("low_id").isNull(), F.col("low_id"), F.col("fp"))
    best = rooted.groupBy("root").agg(F.min(order).alias("best")).select(
        "root", F.col("best")["low_id"].alias("component_id"), F.col("best")["fp"].alias("component_fp"))
    return rooted.select("fp", "root").join(best, "root").select("fp", "component_id", "component_fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """One row per row of `docs`: (id, fp, component_id, component_fp).

    Null and wordless texts have fingerprint zero and link like any other.
    Repeated rows and repeated ids keep their rows.  Null ids take part; they
    name a component only where it holds no other id.  Other columns are not
    read.  An empty table gives an empty table."""
    workers_import_package(docs.sparkSession)
    keyed = written(docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                                fingerprint_column(F.col(f"`{text_col}`"), shingle).alias("fp")), "simhash")
    prints = written(keyed.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "simhash-prints")
    return keyed.join(classes(prints, max_distance), "fp")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """Keep one row of each component, with the columns of `docs`: a row with the
    component's smallest id; between rows that share that id and fingerprint,
    the smallest by the remaining columns."""
    workers_import_package(docs.sparkSession)
    found = near_duplicates(docs, id_col, text_col, shingle, max_distance)
    keep = found.select(F.col("component_id").alias("__id"), F.col("component_fp").alias("__fp")).distinct()
    tagged = docs.withColumn("__own_fp", fingerprint_column(F.col(f"`{text_col}`"), shingle))
    kept = tagged.join(keep, tagged[f"`{id_col}`"].eqNullSafe(keep["__id"])
                       & (tagged["__own_fp"] == keep["__fp"]), "left_semi")
    rest = [c for c in docs.columns if c != id_col]
    return kept.groupBy(F.col(f"`{id_col}`"), "__own_fp").agg(
        F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("__row")).select(
        *[F.col(f"`{id_col}`") if c == id_col else F.col("__row")[c].alias(c) for c in docs.columns])
