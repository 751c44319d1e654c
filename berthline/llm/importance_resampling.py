"""Importance resampling towards a target distribution.

Word runs are hashed into buckets; how much commoner a bucket is in the target
than in the corpus is its gain, and a document's weight is the mean gain of its
runs, looked up in one array.  Gumbel noise makes the highest scores a sample
without replacement by weight.  The cutoff among the scores is found by weighted
median of medians: batches and partitions name the medians of what is still
open, the median of these weighted by the sizes behind them splits the rest, and
at least an eighth of it goes for certain on one side or the other, until the
cutoff itself is the pivot.  Winners alone are sorted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import workers_import_package, written

BUCKETS = 10_000
_CUT = 1 << 20              # bytes of a text that are worked on at a time
_REMEMBERED = 200_000       # words a worker remembers before it starts afresh
_REWRITE = 4                # keys are written anew when so many times fewer are open

# What is no word byte becomes a space, A-Z become a-z; bytes of other code points are word bytes.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


class _Words:
    """crc32 of words, and of words with the space that joins the next one."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, int]] = {}

    def of(self, words: list[bytes]) -> list[tuple[int, int]]:
        if len(self.known) > _REMEMBERED:
            self.known.clear()
        known, out = self.known, []
        for w in words:
            got = known.get(w)
            if got is None:
                crc = zlib.crc32(w)
                got = known[w] = (crc, zlib.crc32(b" ", crc))
            out.append(got)
        return out


def features(text: str | None, words: _Words, buckets: int = BUCKETS, runs: int = 2) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of all runs of 1 to `runs` words) of each part of a text; runs
    that reach over parts belong to the later one."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    at, tails = 0, []       # tails: crc32s of the last runs with their space, longest run first
    while at < len(raw):
        end = raw.find(b" ", at + _CUT)
        end = len(raw) if end < 0 else end
        part = raw[at:end].split()
        at = end
        if not part:
            continue
        pairs = words.of(part)
        hashes = [crc for crc, _ in pairs]
        if runs > 1:
            before = [*tails[-1:], *(joined for _, joined in pairs)]    # of the word before, if any
            firsts = part[len(pairs) + 1 - len(before):]
            if runs == 2:
                hashes += [zlib.crc32(w, joined) for w, joined in zip(firsts, before)]
                tails = before[-1:]
            else:
                open_ = list(tails)     # open_[k]: crc32 of a run of that many words less one
                for w, (crc, joined) in zip(part, pairs):
                    grown = [zlib.crc32(w, c) for c in open_]
                    hashes += grown
                    open_ = ([zlib.crc32(b" ", c) for c in grown] + [joined])[-(runs - 1):]
                tails = open_
        yield len(part), np.array(hashes, np.int64) % buckets


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, runs: int = 2) -> np.ndarray:
    """How often each bucket stands in all texts.  Tasks count for themselves; `buckets` rows
    reach the driver."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _Words(), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                for _, at in features(text.as_py(), words, buckets, runs):
                    seen += np.bincount(at, minlength=buckets)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int32()), "n": pa.array(seen[used], pa.int64())})
    rows = texts.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share of the target over that of the corpus."""
    buckets, s, t = len(corpus), corpus.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def _noise(doc_id: Column, seed: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def score(docs: DataFrame, gain: np.ndarray, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
          runs: int = 2) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    buckets = len(gain)

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            n_words, n, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for i, text in enumerate(batch.column("text")):
                for w, at in features(text.as_py(), words, buckets, runs):
                    n_words[i] += w
                    n[i] += len(at)
                    total[i] += gain[at].sum()
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_words": n_words, "n_features": n,
                                              "weight": total // np.maximum(n, 1)})
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long").withColumn(
        "score", F.col("weight") + _noise(F.col("doc_id"), seed))


# ---------------------------------------------------------------- selection
def weighted_median(values: np.ndarray, weights: np.ndarray) -> int:
    """Smallest value with half of the weight at or below it."""
    order = np.argsort(values, kind="stable")
    upto = np.cumsum(weights[order])
    return int(values[order][np.searchsorted(2 * upto, upto[-1])])


def _medians(keys: DataFrame) -> list[tuple[int, int]]:
    """(median of its batches' medians, rows) of every partition that has rows."""
    def median(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, sizes = [], []
        for batch in batches:
            if batch.num_rows:
                column = batch.column("key").to_numpy()
                values.append(np.partition(column, len(column) // 2)[len(column) // 2])
                sizes.append(len(column))
        if values:
            yield pa.RecordBatch.from_pydict({
                "median": pa.array([weighted_median(np.array(values), np.array(sizes))], pa.int64()),
                "size": pa.array([sum(sizes)], pa.int64())})
    return [(r["median"], r["size"]) for r in keys.mapInArrow(median, "median long, size long").collect()]


def cutoff(keys: DataFrame, wanted: int) -> int | None:
    """The `wanted`-th smallest of `keys(key long)`, repeats counted; null if there are fewer.

    One median and one size a partition, and two counts, reach the driver a round.
    Half of the medians by weight lie on either side of the pivot, half of a
    partition's batches by weight on either side of its median, half of a batch on
    either side of its own: an eighth of the open rows is discarded at least."""
    low, high, last = None, None, None
    while wanted > 0:
        open_ = keys
        if low is not None:
            open_ = open_.where(F.col("key") > low)
        if high is not None:
            open_ = open_.where(F.col("key") < high)
        medians = _medians(open_)
        if not medians:
            return None
        size = sum(n for _, n in medians)
        if wanted > size:
            return None
        if last is None or size * _REWRITE <= last:
            if last is not None:
                keys = open_ = written(open_, "selection-open")
            last = size
        pivot = weighted_median(*(np.array(x) for x in zip(*medians)))
        below, equal = open_.agg(F.count_if(F.col("key") < pivot), F.count_if(F.col("key") == pivot)).first()
        if wanted <= below:
            high = pivot
        elif wanted <= below + equal:
            return pivot
        else:
            low, wanted = pivot, wanted - below - equal
    return None


def _ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """`rows` with rank 1, 2, 3... in order: sorted by range, numbered within ranges."""
    ranged = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", part int, at long"

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = np.arange(at + 1, at + 1 + batch.num_rows)
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, np.full(batch.num_rows, part, np.int32), places],
                                             [*batch.schema.names, "part", "at"])
    numbered = written(ranged.mapInArrow(number, schema), "resampling-winners")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)      # one row a range
    starts = numbered.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return numbered.join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + F.col("at")).drop(
        "part", "at", "start")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7,
             buckets: int = BUCKETS, runs: int = 2, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_features, weight, score, rank.

    Of the rows with `min_words` words the `percent` percent (rounded down) with the
    highest scores are drawn, ties to the smaller id, then to fewer features; rank
    counts them in that order and is null for the others.

    A null or empty text has no features, weight 0 and noise alone as its score.
    A null id has the noise of the empty id and loses ties.  Repeated rows keep their
    rows and get ranks of their own.  Other columns are not read.  An empty table
    gives an empty table; an empty target weighs buckets by their rarity alone."""
    workers_import_package(docs.sparkSession)
    gain = gains(bucket_counts(docs, text_col, buckets, runs), bucket_counts(target, target_col, buckets, runs))
    scored = written(score(docs, gain, seed, id_col, text_col, runs), "resampling-scores")
    able = scored.where(F.col("n_words") >= min_words)
    wanted = percent * able.count() // 100
    lowest = cutoff(able.select((-F.col("score")).alias("key")), wanted)
    if lowest is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    # among the rows at the cutoff score, the id decides
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "weight"]
    above = able.where(F.col("score") > -lowest).count()
    level = able.where(F.col("score") == -lowest)
    last = cutoff(level.where("doc_id is not null").select(F.col("doc_id").alias("key")), wanted - above)
    inside = (F.col("score") > -lowest) | ((F.col("score") == -lowest) & (
        F.lit(True) if last is None else F.coalesce(F.col("doc_id") <= last, F.lit(False))))
    inside = inside & (F.col("n_words") >= min_words)
    winners = _ranked(scored.where(inside), order)
    rank = F.when(F.col("rank") <= wanted, F.col("rank"))       # rows that repeat the last one stay out
    return winners.withColumn("rank", rank.cast("long")).unionByName(
        scored.where(~inside).withColumn("rank", F.lit(None).cast("long")))
