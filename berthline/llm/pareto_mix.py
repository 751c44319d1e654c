"""Mixing sources to target weights by Pareto order sampling.

Every source has a target in words.  A document of it is due a number of
copies that grows with the square root of its size, the factor chosen so that
the source's expected words are its target, two copies at most.  The whole
part of that number is certain; the fraction is the document's inclusion
probability.  Documents are ranked by their random odds divided by their
inclusion odds (Rosen, "On sampling with probability proportional to size",
1997), and the sample's size is fixed in words: the ranking is cut where the
source's words reach its target, and one document that fits fills the rest.  DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WORD_START = "[ \\t-\\r][^ \\t-\\r]"     # of a text with a space before it
SALTS = 64                  # join keys a source's documents are dealt over
_COARSE, _FINE = 64, 65536  # cells per unit of the ranking's logarithm, and cells within one


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def sizes(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, key, salt, size, cls, floor, u): words, size class and random number of
    every row.  Classes are quarters of an octave, `floor` is the smallest size of one."""
    text, doc_id = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.col(f"`{id_col}`")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text), 256)
    rows = docs.select(doc_id.alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                       F.regexp_count(F.concat(F.lit(" "), text), F.lit(WORD_START)).cast("long").alias("size"), digest.alias("digest"))
    octave = F.length(F.bin("size")) - 1
    quarter = F.call_function("shiftright", F.col("size") * 4, octave).cast("int")
    return rows.select(
        "doc_id", "source", _key(F.col("source")).alias("key"), "size",
        F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int").alias("salt"),
        F.when(F.col("size") > 0, 4 * octave + quarter - 4).alias("cls"),
        F.when(F.col("size") > 0, F.call_function("shiftleft", F.lit(1).cast("long"), octave) * quarter / 4.0).alias("floor"),
        ((F.conv(F.substring("digest", 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)).alias("u"))


def targets(rows: DataFrame, weights: tuple[int, ...], total_percent: int, most: int) -> DataFrame:
    """(key, source_size, target): the sources by code point, null last, get `weights` in
    turn; targets stop at `most` times the source's size and the excess goes to the
    others by weight.  One row a source: the list of sources is what a mix is set up by."""
    per = rows.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    per = per.select("key", "source_size", rank.alias("rank")).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1))
    cap = F.col("source_size") * most
    line = Window.orderBy(cap / F.col("weight"), "rank")
    every = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    rest = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the level if all before stop at their caps: the first source that stays below its own has the right one
    level = (F.sum("source_size").over(every) * (total_percent / 100.0) - F.coalesce(F.sum(cap).over(before), F.lit(0))) \
        / F.sum("weight").over(rest)
    per = per.withColumn("place", F.row_number().over(line)).withColumn("level", level)
    right = F.min(F.when(F.col("level") * F.col("weight") <= cap, F.struct("place", "level"))).over(every)["level"]
    return per.withColumn("right", right).select(
        "key", "source_size", F.least(cap.cast("double"), F.col("right") * F.col("weight")).alias("target"))


def copies_due(rows: DataFrame, sources: DataFrame, inclusion: Callable[[Column], Column], most: int) -> DataFrame:
    """(key, source_size, target, due, rest): `due` maps a size class to (certain, chance), its
    certain whole copies and the inclusion probability of one more; `rest` is the
    words that the sample is to hold.  At most four classes an octave of sizes."""
    per = rows.where("size > 0").groupBy("key", "cls", "floor").agg(F.sum("size").alias("words"))
    per = per.join(sources, "key").withColumn("g", inclusion(F.col("floor")))
    line = Window.partitionBy("key").orderBy(F.col("g").desc(), F.col("cls").desc())
    every = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    rest = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    factor = (F.col("target") - most * F.coalesce(F.sum("words").over(before), F.lit(0))) \
        / F.sum(F.col("g") * F.col("words")).over(rest)
    per = per.withColumn("place", F.row_number().over(line)).withColumn("factor", factor)
    right = F.min(F.when(F.col("factor") * F.col("g") <= most, F.struct("place", "factor"))).over(every)["factor"]
    per = per.withColumn("copies", F.least(F.lit(float(most)), right * F.col("g")))
    per = per.withColumn("certain", F.floor("copies").cast("long"))
    per = per.withColumn("chance", F.col("copies") - F.col("certain"))
    due = F.map_from_entries(F.collect_list(F.struct("cls", F.struct("certain", "chance"))))
    found = per.groupBy("key").agg(due.alias("due"), F.sum(F.col("certain") * F.col("words")).alias("sure"))
    return sources.join(found, "key", "left").select(
        "key", "source_size", "target", "due", (F.col("target") - F.coalesce("sure", F.lit(0))).alias("rest"))


def _with_source(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Rows with their source's one row of `params`, copied to SALTS join keys: a source may
    hold a third of all rows."""
    return rows.join(params.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["key", "salt"])


def _reached(cells: DataFrame, rest: DataFrame) -> DataFrame:
    """`cells(key, cell, words)` in order -> per source the first cell that reaches the rest,
    and the rest before it."""
    upto = Window.partitionBy("key").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = cells.join(rest, "key").withColumn("upto", F.sum("words").over(upto))
    first = summed.where("upto >= rest").groupBy("key").agg(
        F.min(F.struct("cell", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"), "words")).alias("f"))
    return first.select("key", "f.*")


def cuts(draws: DataFrame, rest: DataFrame) -> DataFrame:
    """(key, cut, filler): each source's ranking ends before `cut`, the document that would
    reach its rest; what is still open is filled by the undrawn document nearest to
    it in size, the better ranked of several (none, if all would be further off).
    The border is found among coarse cells of the ranking, then among fine ones
    within it; only documents of one fine cell (a few millionths) are put in line
    one by one."""
    words = F.sum("size").alias("words")
    coarse, fine = F.floor(F.col("ln_rank") * _COARSE), F.floor(
        (F.col("ln_rank") * _COARSE - F.floor(F.col("ln_rank") * _COARSE)) * _FINE)
    drawn = draws.where("ln_rank is not null").withColumns({"coarse": coarse, "fine": fine})
    first = _reached(drawn.groupBy("key", F.col("coarse").alias("cell")).agg(words), rest)
    inner = _with_source(drawn, first.select("key", "cell", "rest")).where("coarse = cell").drop("cell", "rest")
    second = _reached(inner.groupBy("key", F.col("fine").alias("cell")).agg(words), first.select("key", "rest"))
    border = second.join(first.select("key", F.col("cell").alias("c")), "key").select("key", "c", "cell", "rest")
    last = _with_source(drawn, border).where("coarse = c and fine = cell")
    ends = _reached(last.groupBy("key", F.col("ln_rank").alias("cell")).agg(words), second.select("key", "rest"))
    ends = written(ends.select("key", F.col("cell").alias("cut"), F.col("rest").alias("gap")), "mix-cuts")
    gap = F.abs(F.col("size") - F.col("gap"))
    undrawn = _with_source(drawn, ends).where((F.col("ln_rank") >= F.col("cut")) & (gap < F.col("gap")))
    best = undrawn.groupBy("key").agg(F.min(F.struct(gap.alias("off"), "ln_rank"))["ln_rank"].alias("filler"))
    return ends.select("key", "cut").join(best, "key", "left")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), total_percent: int = 150, most: int = 2,
        inclusion: Callable[[Column], Column] = F.sqrt, seed: int = 11, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of `docs`: doc_id, size (words), source_size, target (of its source),
    copies (0 to `most`) and taken (copies times size).

    `inclusion` says how the copies due grow with the size of a document: its square
    root, which lies between all documents alike (`lambda n: F.lit(1.0)`) and the
    textbook's proportional to size (`lambda n: n`).  Random numbers are digests of
    seed, id and text, so reruns and other partitionings agree.  A source's words
    differ from its target by half of the document at the border at most, and
    commonly by no more than a word.

    A null or empty text has size 0 and is never taken.  A null source is a source
    of its own, the last one.  Null and repeated ids keep their rows; rows equal in
    id, text and source are taken alike.  Other columns are not read.  An empty
    table gives an empty table."""
    rows = written(sizes(docs, seed, id_col, text_col, source_col), "mix-sizes")
    sources = written(targets(rows, weights, total_percent, most), "mix-targets")
    due = written(copies_due(rows, sources, inclusion, most), "mix-copies")
    mine = F.col("due")[F.col("cls")]
    odds = F.log(F.col("u") / (1 - F.col("u"))) - F.log(mine["chance"] / (1 - mine["chance"]))
    draws = written(_with_source(rows, due).select(
        "doc_id", "size", "source_size", "target", "key", "salt", F.coalesce(mine["certain"], F.lit(0)).alias("certain"),
        F.when(mine["chance"] > 0, odds).alias("ln_rank")), "mix-draws")
    rest = due.select("key", "rest")
    ended = due.select("key").join(cuts(draws, rest), "key", "left")
    rank, cut = F.col("ln_rank"), F.col("cut")
    inside = cut.isNull() | (rank < cut) | F.coalesce(rank == F.col("filler"), F.lit(False))
    copies = F.col("certain") + F.when(rank.isNotNull() & inside, 1).otherwise(0)
    return _with_source(draws, ended).withColumn("copies", copies.cast("long")).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def oracle_sql(weights: tuple[int, ...] = (5, 2, 1), total_percent: int = 150, most: int = 2, seed: int = 11) -> str:
    """The same result in DuckDB SQL: rankings put in line document by document."""
    return f"""
WITH docs AS (SELECT doc_id, coalesce('=' || source, '') AS key, source, len(regexp_extract_all(coalesce(text, ''),
                     '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                     sha256('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS digest FROM documents),
drawn AS (SELECT *, (('0x' || substr(digest, 1, 13))::BIGINT + 0.5::DOUBLE) / {1 << 52}::DOUBLE AS u,
                 length(bin(size)) - 1 AS octave FROM docs),
sized AS (SELECT *, (1::BIGINT << octave) * ((size * 4) >> octave) / 4.0::DOUBLE AS low FROM drawn),
per AS (SELECT key, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM sized GROUP BY key),
ranked AS (SELECT *, ([{', '.join(map(str, weights))}])[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(weights)} + 1] AS weight FROM per),
levels AS (SELECT *, row_number() OVER w AS place, ((SELECT sum(source_size) FROM per) * {total_percent / 100.0}::DOUBLE
                  - coalesce(sum({most} * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                  / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked
           WINDOW w AS (ORDER BY {most} * source_size / weight::DOUBLE, source IS NULL, source)),
sources AS (SELECT key, source_size, least({most} * source_size::DOUBLE, weight * (SELECT arg_min(level, place) FROM levels
                   WHERE level * weight <= {most} * source_size)) AS target FROM levels),
classes AS (SELECT key, low, sqrt(low) AS g, sum(size)::BIGINT AS words FROM sized WHERE size > 0 GROUP BY key, low),
factors AS (SELECT *, (target - {most} * coalesce(sum(words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                   / sum(g * words) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS factor
            FROM classes JOIN sources USING (key) WINDOW w AS (PARTITION BY key ORDER BY g DESC)),
chosen AS (SELECT key, arg_max(factor, g) AS factor FROM factors WHERE factor * g <= {most} GROUP BY key),
due AS (SELECT key, low, words, least({most}.0::DOUBLE, coalesce(c.factor, 1e300) * g) AS copies FROM factors LEFT JOIN chosen c USING (key)),
rest AS (SELECT key, any_value(target) - sum(floor(copies) * words) AS rest FROM due JOIN sources USING (key) GROUP BY key),
odds AS (SELECT s.*, source_size, target, coalesce(floor(copies), 0)::BIGINT AS certain,
                CASE WHEN copies > floor(copies) THEN ln(u / (1 - u)) - ln((copies - floor(copies)) / (1 - (copies - floor(copies)))) END AS r
         FROM sized s JOIN sources USING (key) LEFT JOIN due USING (key, low)),
lines AS (SELECT key, r, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY key ORDER BY r) AS upto
          FROM odds WHERE r IS NOT NULL GROUP BY key, r),
ends AS (SELECT key, min(r) AS cut, arg_min(rest - upto + words, r) AS gap FROM lines JOIN rest USING (key)
         WHERE upto >= rest GROUP BY key),
fillers AS (SELECT key, r AS filler FROM odds JOIN ends USING (key) WHERE r >= cut AND abs(size - gap) < gap
            QUALIFY row_number() OVER (PARTITION BY key ORDER BY abs(size - gap), r) = 1)
SELECT doc_id, size, source_size, target, size * (certain + CASE WHEN r IS NOT NULL
       AND (cut IS NULL OR r < cut OR coalesce(r = filler, false)) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM odds LEFT JOIN ends USING (key) LEFT JOIN fillers USING (key)"""
