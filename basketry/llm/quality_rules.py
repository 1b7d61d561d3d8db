"""Quality rules: outlying statistics of a text, judged by minimum-covariance-determinant estimates per language and source.

Each text becomes a vector of transformed statistics (length, word length, symbols, repeated lines, repeated words). A location and scatter are
estimated for every language and source from the ``share`` of its rows whose scatter has the smallest determinant: from two starts (medians and their absolute
deviations, and the covariance of signs) rows of least Mahalanobis distance are kept and the estimate made anew, until the determinants stay. Rows far from the
reweighted estimate are rejected.

Statistics are whole multiples of 1/4096, and all sums are sums of whole numbers, so a rerun gives the same estimates however the rows are dealt.
"""

from __future__ import annotations

from collections.abc import Callable
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup, materialize, narrow

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"  # fixed value of the contract
UNIT = 4096  # steps of a statistic in 1
FINE = 256  # distance bins for each doubling; value bins in 1
# Scatter of each statistic below which rows aren't told apart: one scale step of a common text's own noise.
FLOORS = (0.1, 0.02, 0.03, 0.2, 0.2)
P = len(FLOORS)
XS = [f"x{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def bound_once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def repeated_words(words: Column) -> Column:
    """Number of words in 5-word windows found twice or more, in time n log n."""
    no = F.lit(0).cast("long")

    def covered(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            again = F.filter(s, lambda x, k: (F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
            at = F.sort_array(F.transform(again, lambda x: x["i"]))
            # five words for each window, less those it shares with the one before
            step = lambda a, i: F.struct((a["n"] + F.least(F.lit(5), i - a["last"])).alias("n"), i.alias("last"))
            return F.aggregate(at, F.struct(no.alias("n"), F.lit(-5).alias("last")), step, lambda a: a["n"])

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), no).otherwise(bound_once(ordered, twice))

    def of(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(h) - 5), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(5))))
        return bound_once(windows, covered)

    # a window can repeat from six words on
    return F.when(F.size(words) < 6, no).otherwise(bound_once(F.transform(words, lambda w: F.xxhash64(w)), of))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words) of (doc_id, text, lang, source)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    rows = docs.select(
        "doc_id", "lang", "source",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+", -1)).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "").alias("lines"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    return rows.select(
        "doc_id", "lang", "source", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.size("lines").cast("long").alias("n_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"))


def vectors(stats: DataFrame) -> DataFrame:
    """Adds the transformed statistics, whole multiples of 1/UNIT: logs of counts and of lengths, roots of shares (variances of shares become alike)."""
    some = lambda c: F.greatest(F.col(c), F.lit(1))
    values = (F.log1p("n_words"), F.log(some("word_chars") / some("n_words")), F.sqrt(F.col("n_symbols") / some("word_chars")),
              F.sqrt(F.col("n_dup_lines") / some("n_lines")), F.sqrt(F.col("n_repeat_words") / some("n_words")))
    return stats.withColumns({x: F.round(v * UNIT).cast("long") for x, v in zip(XS, values)})


def cells(rows: DataFrame, least: int) -> DataFrame:
    """(_lang, _source, cell): the language and source, or the rest of the language, or the rest of all, the first of them with ``least`` rows; else null."""
    n = rows.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("n"))
    n = materialize(n)
    few = n.where(F.col("n") < least)
    by_lang = materialize(few.groupBy(F.col("_lang").alias("_l")).agg(F.sum("n").alias("by_lang")))
    rest = by_lang.where(F.col("by_lang") < least).agg(F.coalesce(F.sum("by_lang"), F.lit(0))).scalar()
    told = lambda *parts: F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})
    own = n.where(F.col("n") >= least).select("_lang", "_source", told("_lang", "_source").alias("cell"))
    pooled = lookup(few, by_lang, {"_lang": "_l"}).select(
        "_lang", "_source", F.when(F.col("by_lang") >= least, told("_lang")).when(rest >= least, told()).alias("cell"))
    return materialize(own.unionByName(pooled))


def at_share(counts: DataFrame, by: list[str], share: float, bin_col: str = "bin") -> DataFrame:
    """(by, bin): the first bin up to which ``share`` of the rows lie, from (by, bin, n). The bins of a group are bounded by the values' range, not by its rows."""
    w = Window.partitionBy(*by)
    upto = F.sum("n").over(w.orderBy(bin_col).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counts.withColumns({"_upto": upto, "_of": F.sum("n").over(w)}).where(F.col("_upto") >= F.ceil(F.col("_of") * share)).groupBy(*by).agg(
        F.min(bin_col).alias(bin_col))


def median_of(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(cell, one column for each value): medians of whole numbers, to 1/FINE."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("what"), F.floor(v * FINE / UNIT).alias("bin")) for k, v in values.items())))
    counts = rows.select("cell", each.alias("_e")).select("cell", "_e.*").groupBy("cell", "what", "bin").agg(F.count(F.lit(1)).alias("n"))
    mid = at_share(counts, ["cell", "what"], 0.5)
    return materialize(mid.groupBy("cell").agg(*(F.max(F.when(F.col("what") == k, (F.col("bin") + 0.5) / FINE)).alias(k) for k in values)))


def moments(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, means m_i, covariances c_i_j) from exact sums."""
    total = lambda c: F.sum(F.expr(c).cast("decimal(38,0)"))
    got = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *(total(x).alias(f"e{i}") for i, x in enumerate(XS)),
                                *(total(f"{XS[i]} * {XS[j]}").alias(f"p{i}_{j}") for i, j in PAIRS))
    # sums of products of deviations from the rounded means stay whole and small; what the rounding left is taken off as a double
    near = [f"cast(round(e{i} / n) AS decimal(19,0)) AS r{i}" for i in range(P)]
    mean = [f"cast(e{i} AS double) / n / {UNIT} AS m{i}" for i in range(P)]
    off = [f"cast(e{i} - r{i} * n AS double) / n AS o{i}" for i in range(P)]
    cov = [f"(cast(p{i}_{j} - r{i} * e{j} - r{j} * e{i} + r{i} * r{j} * n AS double) / n - o{i} * o{j}) / {UNIT * UNIT} AS c{i}_{j}" for i, j in PAIRS]
    return got.selectExpr(*by, "n", *near, *off, *mean, *cov).drop(*(f"{a}{i}" for a in "ro" for i in range(P)))


def whitened(estimates: DataFrame, by: list[str], scale: str = "1.0D") -> DataFrame:
    """(by, m_i, c_i_j, w_i_j, logdet): the inverse of the Cholesky factor of scale * c plus the floors, so that distances are sums of squares."""
    added = lambda terms: " + ".join(["0.0D", *terms])
    steps = [*by, *(f"m{i}" for i in range(P)), *(f"c{i}_{j}" for i, j in PAIRS)]
    # every line may use the names of the lines before it
    for j in range(P):
        steps.append(f"sqrt(greatest({scale} * c{j}_{j} + {FLOORS[j] ** 2}D - ({added(f'l{j}_{q} * l{j}_{q}' for q in range(j))}), 1e-12D)) AS l{j}_{j}")
        steps += [f"({scale} * c{i}_{j} - ({added(f'l{i}_{q} * l{j}_{q}' for q in range(j))})) / l{j}_{j} AS l{i}_{j}" for i in range(j + 1, P)]
    for i in range(P):
        steps += [f"({float(i == j)}D - ({added(f'l{i}_{q} * w{q}_{j}' for q in range(j, i))})) / l{i}_{i} AS w{i}_{j}" for j in range(i + 1)]
    steps.append(f"2 * ({added(f'ln(l{i}_{i})' for i in range(P))}) AS logdet")
    return estimates.selectExpr(*steps).drop(*(f"l{i}_{j}" for i, j in PAIRS))


def squared_distance() -> Column:
    rows = (" + ".join(f"w{i}_{j} * (x{j} / {UNIT}.0D - m{j})" for j in range(i + 1)) for i in range(P))
    return F.expr(" + ".join(f"pow({r}, 2)" for r in rows))


def distance_bin(d2: Column) -> Column:
    return F.floor(F.log2(d2 + 2.0 ** -30) * FINE)


def chi_square(tail: float) -> float:
    """The value that a chi-square variable with P degrees of freedom exceeds with probability ``tail`` (Wilson and Hilferty)."""
    z, v = -NormalDist().inv_cdf(tail), 2 / (9 * P)
    return P * (1 - v + z * v ** 0.5) ** 3


def measured(rows: DataFrame, estimates: DataFrame, by: list[str]) -> DataFrame:
    """(rows, d2) with each row's estimates."""
    return lookup(rows, estimates.withColumnsRenamed({b: f"_{b}" for b in by}), {b: f"_{b}" for b in by}).withColumn("d2", squared_distance())


def starts(rows: DataFrame) -> DataFrame:
    """(cell, start, n, m_i, c_i_j): 0, medians and their absolute deviations; 1, medians and the covariance of signs in those units."""
    mid = median_of(rows, {f"m{i}": F.col(x) for i, x in enumerate(XS)})
    dev = lookup(rows, mid.withColumnRenamed("cell", "_cell"), {"cell": "_cell"})
    mad = median_of(dev, {f"a{i}": F.abs(F.col(x) - F.round(F.col(f"m{i}") * UNIT)) for i, x in enumerate(XS)})
    both = materialize(mid.join(mad, "cell"))  # one row for each cell on both sides
    unit = lambda i: F.sqrt((F.col(f"a{i}") * 1.4826) ** 2 + FLOORS[i] ** 2)
    plain = both.select("cell", F.lit(0).alias("start"), *(f"m{i}" for i in range(P)),
                        *((((F.col(f"a{i}") * 1.4826) ** 2) if i == j else F.lit(0.0)).alias(f"c{i}_{j}") for i, j in PAIRS))
    u = lookup(rows, both.withColumnRenamed("cell", "_cell"), {"cell": "_cell"}).withColumns(
        {f"u{i}": (F.col(x) / UNIT - F.col(f"m{i}")) / unit(i) for i, x in enumerate(XS)})
    u = u.withColumn("_len", F.sqrt(sum((F.col(f"u{i}") ** 2 for i in range(P)), F.lit(2.0 ** -30))))
    signs = u.groupBy("cell").agg(*(F.avg(F.round(F.col(f"u{i}") * F.col(f"u{j}") / F.col("_len") ** 2, 6).cast("decimal(10,6)")).cast("double").alias(f"g{i}_{j}")
                                    for i, j in PAIRS))
    signed = both.join(signs, "cell").select("cell", F.lit(1).alias("start"), *(f"m{i}" for i in range(P)),
                                             *((F.col(f"g{i}_{j}") * unit(i) * unit(j)).alias(f"c{i}_{j}") for i, j in PAIRS))
    return plain.unionByName(signed)


def concentrated(rows: DataFrame, share: float, rounds: int, still: float = 1e-3) -> DataFrame:
    """(cell, m_i, c_i_j, w_i_j, logdet): of both starts the estimate of smaller determinant.

    Each is made anew from the ``share`` of least distance, ``rounds`` times at most or until no logarithm of a determinant moves by ``still``.
    """
    by = ["cell", "start"]
    twice = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    now = materialize(whitened(starts(rows), by))
    for _ in range(rounds):
        d = measured(twice, now, by).withColumn("bin", distance_bin(F.col("d2"))).select(*by, *XS, "bin")
        edge = at_share(d.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n")), by, share)
        near = lookup(d, materialize(edge.select(F.col("cell").alias("_cell"), F.col("start").alias("_start"), F.col("bin").alias("edge"))),
                      {"cell": "_cell", "start": "_start"}).where(F.col("bin") <= F.col("edge"))
        last, now = now, materialize(whitened(moments(near, by), by))
        moved = now.join(last.select(*by, F.col("logdet").alias("before")), by).agg(F.max(F.abs(F.col("logdet") - F.col("before")))).first()[0]
        if moved is None or moved < still:
            break
    return materialize(now.groupBy("cell").agg(F.min_by(F.struct(*now.columns), F.struct("logdet", "start")).alias("_r")).select("_r.*").drop("start"))


def consistent(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """The estimates' scatter scaled so that the median squared distance is that of normal rows."""
    d = measured(rows, estimates, ["cell"]).withColumn("bin", distance_bin(F.col("d2")))
    mid = at_share(d.groupBy("cell", "bin").agg(F.count(F.lit(1)).alias("n")), ["cell"], 0.5)
    factor = mid.select(F.col("cell"), (F.pow(F.lit(2.0), (F.col("bin") + 0.5) / FINE) / chi_square(0.5)).alias("_factor"))
    return materialize(whitened(estimates.join(factor, "cell"), ["cell"], "_factor"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", share: float = 0.75,
          rounds: int = 10, least: int = 200, tail: float = 1e-16) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance): one row per row of ``docs``.

    The base rule fails texts of fewer than 10 words and those with more than a fifth of their words in repeated 5-word windows. The others are kept unless
    their squared distance (``distance``; null for failed ones) exceeds what normal rows would exceed with probability ``tail``. Estimates are made from the rows that pass the base rule, for every
    language and source with ``least`` such rows; what is left of a language, then of all, is pooled; with fewer than ``least`` rows in that pool too they are kept.

    A null text counts as empty, null languages and sources are values of their own, repeated rows count each, an empty table gives an empty result, other
    columns are ignored. The h-subset ends with a whole bin of distances (bins 0.3 percent wide), so ties never depend on the order of rows.
    Windows are compared by 64-bit hashes.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col, lang=lang_col, source=source_col)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = materialize(vectors(statistics(rows)).withColumn("base_failed", failed))
    passed = rows.where(~F.col("base_failed"))
    placed = lookup(passed, cells(passed, least), {"lang": "_lang", "source": "_source"}).select("doc_id", *BASE, *XS, "cell")
    usual = placed.where(F.col("cell").isNotNull())
    raw = consistent(usual, concentrated(usual, share, rounds))
    inner = measured(usual, raw, ["cell"]).where(F.col("d2") <= chi_square(0.025))
    final = consistent(usual, materialize(whitened(moments(inner.select("cell", *XS), ["cell"]), ["cell"])))
    judged = measured(usual, final, ["cell"]).select("doc_id", *BASE, F.lit(False).alias("base_failed"), (F.col("d2") <= chi_square(tail)).alias("kept"),
                                                     F.col("d2").alias("distance"))
    alone = placed.where(F.col("cell").isNull()).select("doc_id", *BASE, F.lit(False).alias("base_failed"), F.lit(True).alias("kept"), F.lit(None).cast("double").alias("distance"))
    out = rows.where("base_failed").select("doc_id", *BASE, "base_failed", F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return judged.unionByName(alone).unionByName(out)


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
