"""Quality rules by robust multivariate outliers, in DataFrame expressions only.

Every text gets a vector of transformed statistics (``FEATURES``). A minimum-covariance-
determinant estimate is made for each language and source, each language, and the corpus: of
three starts (medians and median absolute deviations; covariance of the values clipped around
the medians; mean and covariance of all) each takes concentration steps, which estimate from
the half of the documents that lie closest by Mahalanobis distance, until the determinant
falls no more; the smallest is taken, widened by the consistency factor of a half. A document
whose squared distance passes ``CUTOFF`` is rejected.

Two rules come first: at least ``MIN_WORDS`` words, and at most half of the words in
three-word windows that occur twice or more. Only documents that pass them enter estimates.

How it is kept exact and small: features are whole numbers (in units of 1/``UNIT``), so
sums of products do not depend on the order of rows. Medians and coverage limits come from
counts per small bin, so no group is ever sorted or gathered; a source with a third of all
rows is some thousand bins. Rows meet their group's estimate by group and part: a group of more
than a small share of all rows (``_parts``) is dealt in parts, each with a copy of the estimate.
A variance never falls below ``FLOOR`` squared per feature: many
sources have, say, no repeated line at all, and one such line is no reason to reject.

Every document that passes the rules is judged, however small its group: the estimate of a
source of n documents is mixed with its language's as n to ``PRIOR``, and that one before with
the corpus's likewise. The covariance is that of the mixture, so it has the distance of the
centres in it.

Defined cases: null or empty text has no words and fails the rules; null language or
source is a value of its own; every row is judged by itself, repeated rows alike.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tasteloom.llm.base import saved, scratch

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
#: Documents that the estimate above a group counts as.
PRIOR = 100
#: A group is one part up to so many rows, or up to all rows over ``MOST_PARTS`` if that is more.
PART_ROWS = 4096
MOST_PARTS = 16_384
#: Squared distance: 99.9 % of a chi-square distribution with four degrees of freedom.
CUTOFF = 18.4668
UNIT = 1000
#: Width of a median bin, in units.
BIN = 10
#: Bins per doubling of a squared distance.
DISTANCE_BINS = 64
FEATURES = ("f_length", "f_symbols", "f_lines", "f_repeats")
#: Least standard deviation of the features above.
FLOOR = (0.08, 0.25, 0.25, 0.25)
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _count(items: Column) -> Column:
    return F.size(items).cast("bigint")


def _repeated(grams: Column) -> Column:
    """Words covered by windows (given by hash, in order) that occur twice or more."""
    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(rows: Column) -> Column:
        def like(other: Column, row: Column) -> Column:
            return F.coalesce(F.get(rows, other)["h"] == row["h"], F.lit(False))

        same = F.filter(
            rows, lambda row, j: like(j + 1, row) | F.when(j > 0, like(j - 1, row)).otherwise(F.lit(False))
        )
        return F.sort_array(F.transform(same, lambda row: row["i"]))

    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate(
        _let(pairs, twice),
        start,
        lambda acc, at: F.struct(
            (acc["n"] + F.least(F.lit(3), at - acc["last"])).cast("bigint").alias("n"),
            at.alias("last"),
        ),
        lambda acc: acc["n"],
    )
    distinct = F.size(F.array_distinct(grams)) == F.size(grams)
    return F.when(distinct, F.lit(0).cast("bigint")).otherwise(covered)


def statistics(docs: DataFrame, keep: dict[str, Column]) -> DataFrame:
    """``keep`` and the counts of every text; names of counts begin with ``n_`` or ``word_``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    n = F.size("_words")
    grams = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(
                F.get(F.col("_words"), i), F.get(F.col("_words"), i + 1), F.get(F.col("_words"), i + 2)
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    names = list(keep)
    counted = docs.select(
        *(column.alias(name) for name, column in keep.items()),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: _count(x) - _count(F.array_distinct(x))).alias("n_dup_lines"),
    ).select(
        *names,
        _count(F.col("_words")).alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        grams.alias("_grams"),
    )
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    return counted.select(*names, *columns, _repeated(F.col("_grams")).alias("n_repeat_words")).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
    )


def _features() -> dict[str, Column]:
    """Means and shares on log scales, as whole units."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    found = (
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        F.log(1 + 20 * F.col("n_symbols") / words),
        F.log(1 + 20 * F.col("n_dup_lines") / words),
        F.log(1 + 20 * F.col("n_repeat_words") / words),
    )
    return {
        name: F.round(value * UNIT).cast("bigint") for name, value in zip(FEATURES, found, strict=True)
    }


def _consistency(percent: int) -> float:
    """What widens the covariance of the closest ``percent`` of four normal features to all's."""
    low, high = 0.0, 100.0
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - math.exp(-x / 2) * (1 + x / 2) < percent / 100
        low, high = (x, high) if below else (low, x)
    return percent / 100 / (1 - math.exp(-low / 2) * (1 + low / 2 + low * low / 8))


def _cells() -> dict[str, Column]:
    """The groups of a row, from the smallest to the corpus."""
    return {
        "of_source": F.to_json(F.array("lang", "source")),
        "of_lang": F.to_json(F.array("lang")),
        "of_all": F.lit("[]"),
    }


def _half(total: Column) -> Column:
    """The documents that an estimate is made of: half, and more than features."""
    return F.least(total, F.floor((total + len(FEATURES) + 1) / 2))


def _limit_bins(counted: DataFrame, keys: list[str], least) -> DataFrame:
    """Per key the first bin with which ``least(rows)`` of the rows are reached."""
    order = Window.partitionBy(*keys).orderBy("bin")
    so_far = F.sum("count").over(order)
    total = F.sum("count").over(Window.partitionBy(*keys))
    reached = counted.withColumn("_so_far", so_far).withColumn("_total", total)
    return reached.filter(F.col("_so_far") >= least(F.col("_total"))).groupBy(*keys).agg(
        F.min("bin").alias("bin")
    )


def _medians(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``cell`` and one column per value: medians to the width of a bin."""
    each = [F.struct(F.lit(k).alias("name"), F.floor(v / BIN).alias("bin")) for k, v in values.items()]
    counted = (
        rows.select("cell", F.inline(F.array(*each))).groupBy("cell", "name", "bin").count()
    )
    found = _limit_bins(counted, ["cell", "name"], lambda total: F.ceil(total / 2))
    return found.groupBy("cell").agg(
        *(F.max(F.when(F.col("name") == k, F.col("bin") * BIN + BIN // 2)).alias(k) for k in values)
    )


def _inverse(cov: dict[tuple[int, int], Column]) -> tuple[list[str], list[tuple[str, Column]]]:
    """Steps that give ``w_i_j``, the rows of the inverted Cholesky factor of ``cov``."""
    n = len(FEATURES)
    steps: list[tuple[str, Column]] = []
    for i in range(n):
        for j in range(i + 1):
            rest = cov[j, i] if j < i else cov[i, i]
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            if i == j:
                # The floor keeps this positive; rounding must not undo it.
                value = F.sqrt(F.greatest(rest, F.lit((FLOOR[i] * UNIT / 10) ** 2)))
            else:
                value = rest / F.col(f"l_{j}_{j}")
            steps.append((f"l_{i}_{j}", value))
    for j in range(n):
        steps.append((f"w_{j}_{j}", 1 / F.col(f"l_{j}_{j}")))
        for i in range(j + 1, n):
            total = F.lit(0.0)
            for k in range(j, i):
                total = total - F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}")
            steps.append((f"w_{i}_{j}", total / F.col(f"l_{i}_{i}")))
    return [f"w_{i}_{j}" for i in range(n) for j in range(i + 1)], steps


def _distance() -> Column:
    """Squared Mahalanobis distance of a row joined with an estimate."""
    centred = [F.col(name) - F.col(f"m_{i}") for i, name in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in range(len(FEATURES)):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.col(f"w_{i}_{j}") * centred[j]
        total = total + part * part
    return total


def _parts(rows: DataFrame, cell: str, path: str) -> DataFrame:
    """``cell`` and ``_parts`` of the groups too large for one part: ``MOST_PARTS`` rows at most."""
    counted = saved(rows.groupBy(cell).agg(F.count("*").alias("_rows")), f"{path}-rows")
    each = counted.agg(
        F.greatest(F.lit(PART_ROWS), F.ceil(F.coalesce(F.sum("_rows"), F.lit(0)) / MOST_PARTS)).alias("each")
    ).first()["each"]
    large = counted.filter(F.col("_rows") > each)
    return saved(large.select(cell, F.ceil(F.col("_rows") / each).cast("int").alias("_parts")), path)


def _dealt(rows: DataFrame, parts: DataFrame, cell: str) -> DataFrame:
    """Every row with the ``_part`` of its group that it is in; ``rows`` is a written table."""
    found = rows.withColumn("_nth", F.monotonically_increasing_id()).join(F.broadcast(parts), cell, "left")
    nth = F.pmod(F.xxhash64("_nth"), F.col("_parts")).cast("int")
    return found.withColumn("_part", F.coalesce(nth, F.lit(0))).drop("_nth", "_parts")


def _copied(estimates: DataFrame, parts: DataFrame, cell: str) -> DataFrame:
    """Every estimate once for each ``_part`` of its group."""
    found = estimates.join(F.broadcast(parts), cell, "left")
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    return found.withColumn("_part", F.explode(F.sequence(F.lit(0), last))).drop("_parts")


def _estimate(rows: DataFrame, keys: list[str], values: list[Column]) -> DataFrame:
    """``keys``, ``_n``, centre ``m_i`` and covariance ``c_j_i``, not below the floor."""
    n = range(len(FEATURES))
    sums = rows.select(*keys, *(value.cast("bigint").alias(f"v_{i}") for i, value in enumerate(values)))
    sums = sums.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        *(F.sum(f"v_{i}").alias(f"s_{i}") for i in n),
        *(
            F.sum((F.col(f"v_{i}") * F.col(f"v_{j}")).cast("decimal(20,0)")).alias(f"s_{j}_{i}")
            for i in n
            for j in range(i + 1)
        ),
    )
    for i in n:
        sums = sums.withColumn(f"m_{i}", F.col(f"s_{i}") / F.col("_n"))
    return sums.select(
        *keys,
        "_n",
        *(f"m_{i}" for i in n),
        *(
            (F.col(f"s_{j}_{i}").cast("double") / F.col("_n") - F.col(f"m_{i}") * F.col(f"m_{j}")).alias(f"c_{j}_{i}")
            for i in n
            for j in range(i + 1)
        ),
    )


def _inverted(found: DataFrame, keys: list[str], factor: Column | None = None) -> DataFrame:
    """``keys``, ``m_i``, ``c_j_i`` times ``factor``, ``w_i_j`` and ``det``, the log of the root."""
    n = range(len(FEATURES))
    for i in n:
        for j in range(i + 1):
            value = F.col(f"c_{j}_{i}") * (F.lit(1.0) if factor is None else factor)
            if i == j:
                value = F.greatest(value, F.lit((FLOOR[i] * UNIT) ** 2))
            found = found.withColumn(f"c_{j}_{i}", value)
    names, steps = _inverse({(j, i): F.col(f"c_{j}_{i}") for i in n for j in range(i + 1)})
    for name, value in steps:
        found = found.withColumn(name, value)
    det = sum((F.log(f"l_{i}_{i}") for i in n), F.lit(0.0))
    spread = [f"c_{j}_{i}" for i in n for j in range(i + 1)]
    return found.select(*keys, *(f"m_{i}" for i in n), *spread, *names, det.alias("det"))


def _starts(rows: DataFrame, parts: DataFrame, folder: str) -> DataFrame:
    """Three estimates of every cell, by ``start``."""
    by = ["cell", "_part"]
    n = range(len(FEATURES))
    centre = saved(_medians(rows, {name: F.col(name) for name in FEATURES}), f"{folder}/median")
    centre = centre.select("cell", *(F.col(name).alias(f"m_{i}") for i, name in enumerate(FEATURES)))
    apart = {f"d_{i}": F.abs(F.col(name) - F.col(f"m_{i}")) for i, name in enumerate(FEATURES)}
    away = _medians(rows.join(_copied(centre, parts, "cell"), by), apart)
    spread = saved(centre.join(away, "cell"), f"{folder}/spread")
    deviations = spread.select(
        "cell",
        F.lit(1).cast("bigint").alias("_n"),
        *(f"m_{i}" for i in n),
        *(
            (F.pow(F.col(f"d_{i}") * 1.4826, F.lit(2)) if i == j else F.lit(0.0)).alias(f"c_{j}_{i}")
            for i in n
            for j in range(i + 1)
        ),
    )
    reach = [F.greatest(F.col(f"d_{i}") * 3, F.lit(round(2 * FLOOR[i] * UNIT))) for i in n]
    clipped = [
        F.greatest(F.least(F.col(FEATURES[i]), F.col(f"m_{i}") + reach[i]), F.col(f"m_{i}") - reach[i]) for i in n
    ]
    found = [
        deviations,
        _estimate(rows.join(_copied(spread, parts, "cell"), by), ["cell"], clipped),
        _estimate(rows, ["cell"], [F.col(name) for name in FEATURES]),
    ]
    each = [_inverted(one.withColumn("start", F.lit(k)), ["cell", "start"]) for k, one in enumerate(found)]
    return saved(each[0].unionByName(each[1]).unionByName(each[2]), f"{folder}/start")


def _concentrated(rows: DataFrame, parts: DataFrame, estimate: DataFrame, path: str) -> DataFrame:
    """Centre and covariance of the closest half of every cell, for each of its starts."""
    keys = ["cell", "start"]
    bin_ = F.floor(F.log2(1 + _distance()) * DISTANCE_BINS).cast("bigint")
    near = rows.join(_copied(estimate, parts, "cell"), ["cell", "_part"])
    near = near.select(*keys, "_part", *FEATURES, bin_.alias("bin"))
    counted = saved(near.groupBy(*keys, "bin").count(), f"{path}-bins")
    limits = _limit_bins(counted, keys, _half).withColumnRenamed("bin", "_limit")
    totals = counted.groupBy(*keys).agg(F.sum("count").alias("_total"))
    limits = saved(limits.join(totals, keys), f"{path}-limits")
    inside = near.join(_copied(limits, parts, "cell"), [*keys, "_part"]).filter("bin <= _limit")
    found = _estimate(inside, [*keys, "_total"], [F.col(name) for name in FEATURES])
    # Tied documents can make the half larger.
    percent = F.floor(100 * F.col("_n") / F.col("_total")).cast("int")
    factors = F.array(F.lit(1.0), *(F.lit(_consistency(k)) for k in range(1, 100)), F.lit(1.0))
    found = saved(found.withColumn("_factor", F.get(factors, percent)), f"{path}-found")
    return saved(_inverted(found, [*keys, "_total"], F.col("_factor")), path)


def estimates(rows: DataFrame, folder: str) -> DataFrame:
    """``cell``, ``_total`` documents, centre ``m_i`` and covariance ``c_j_i`` of every cell."""
    parts = _parts(rows, "cell", f"{folder}/parts")
    rows = _dealt(rows, parts, "cell")
    active, steps = _starts(rows, parts, folder), []
    # Every step lowers some determinant by a least amount, and floors bound them from below.
    for step in count():
        found = _concentrated(rows, parts, active, f"{folder}/step{step}")
        steps.append(found)
        if step:
            before = active.select("cell", "start", F.col("det").alias("_before"))
            falling = found.join(before, ["cell", "start"]).filter(F.col("det") < F.col("_before") - 1e-6)
            found = saved(falling.drop("_before"), f"{folder}/falling{step}")
        if found.isEmpty():
            break
        active = found
    every = reduce(DataFrame.unionByName, steps)
    best = Window.partitionBy("cell").orderBy("det", "start", *(f"m_{i}" for i in range(len(FEATURES))))
    chosen = every.withColumn("_nth", F.row_number().over(best)).filter("_nth = 1")
    names = [name for name in every.columns if name[:2] in ("m_", "c_")]
    return saved(chosen.select("cell", "_total", *names), f"{folder}/cells")


def _mixed(groups: DataFrame, own: DataFrame, cell: str) -> DataFrame:
    """The estimates ``m_i, c_j_i`` of ``groups`` mixed with those of their ``cell``."""
    n = range(len(FEATURES))
    names = [name for name in own.columns if name[:2] in ("m_", "c_")]
    mine = own.select(F.col("cell").alias(cell), "_total", *(F.col(name).alias(f"_{name}") for name in names))
    joined = groups.join(mine, cell)
    share = F.col("_total") / (F.col("_total") + PRIOR)

    def between(name: str) -> Column:
        return share * F.col(f"_{name}") + (1 - share) * F.col(name)

    def apart(i: int) -> Column:
        return F.col(f"_m_{i}") - F.col(f"m_{i}")

    return joined.select(
        *(name for name in groups.columns if name not in names),
        *(between(f"m_{i}").alias(f"m_{i}") for i in n),
        *(
            (between(f"c_{j}_{i}") + share * (1 - share) * apart(i) * apart(j)).alias(f"c_{j}_{i}")
            for i in n
            for j in range(i + 1)
        ),
    )


def _by_source(good: DataFrame, folder: str) -> DataFrame:
    """``of_source`` and the mixed estimate, as ``m_i`` and ``w_i_j``."""
    cells = _cells()
    rows = saved(
        good.select(F.explode(F.array(*cells.values())).alias("cell"), *FEATURES), f"{folder}/features"
    )
    own = estimates(rows, folder)
    groups = good.select(*(value.alias(name) for name, value in cells.items())).distinct()
    whole = own.drop("_total").withColumnRenamed("cell", "of_all")
    mixed = groups.join(whole, "of_all")
    for cell in ("of_lang", "of_source"):
        mixed = _mixed(mixed, own, cell)
    return saved(_inverted(mixed, ["of_source"]).drop("det"), f"{folder}/estimates")


def _judged(docs: DataFrame, keep: dict[str, Column]) -> DataFrame:
    """``keep``, the counts, ``base_failed``, ``distance`` and ``kept`` of every row.

    Rows meet the estimates of their sources, which are written first: if these are few, Spark
    sends them to the rows, and what ``keep`` carries along is not shuffled.
    """
    folder = scratch(docs.sparkSession, "quality")
    groups = {"lang": F.col("lang"), "source": F.col("source")}
    counted = saved(statistics(docs, groups | keep), f"{folder}/counts")
    placed = counted.withColumns(_features()).withColumn("of_source", _cells()["of_source"])
    found = _by_source(placed.filter(~F.col("base_failed")), folder)
    parts = _parts(placed, "of_source", f"{folder}/parts-of-source")
    distance = _distance()
    names = [name for name in found.columns if not name.startswith("c_")]
    copied = saved(_copied(found.select(*names), parts, "of_source"), f"{folder}/copied")
    judged = _dealt(placed, parts, "of_source").join(copied, ["of_source", "_part"], "left")
    return judged.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        distance.alias("distance"),
        (~F.col("base_failed") & (distance <= CUTOFF)).alias("kept"),
    )


def assessed(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``distance`` and ``kept``; ``_row`` names the row."""
    row = {"doc_id": F.col("doc_id"), "_row": F.xxhash64("text", "lang", "source")}
    judged = _judged(docs, row)
    return judged.select("doc_id", *(name for name in judged.columns if name not in row), "_row")


def kept(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    columns = {f"_c{i}": name for i, name in enumerate(docs.columns)}
    judged = _judged(docs, {new: F.col(f"`{old}`") for new, old in columns.items()})
    return judged.filter("kept").select(*(F.col(new).alias(old) for new, old in columns.items()))
