"""Secret scans: fixed rules, and character Markov models compared by log-likelihood ratio.

Two first-order models are trained on labelled samples: the values that the rules find (random strings), and what is written as words and
numbers outside every rule's match (ordinary identifiers). A long token whose transitions are likelier under the first adds a span.
Everything is a DataFrame expression; only the two tables of transition counts reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_share, narrow

# The rules, in the order that breaks ties. (kind, pattern, group whose length counts, least length)
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
RULES = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
KINDS = (*(r[0] for r in RULES), "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
RUN = r"[A-Za-z0-9+/_=-]{4,}"
# what no identifier of words and numbers holds: letters beside digits, a capital that begins no word, signs of base64
UNLIKE_WORDS = r"[A-Za-z][0-9]|[0-9][A-Za-z]|[+=]|[a-z][A-Z](?![a-z][a-z])|[A-Z][A-Z][a-z]"
PAGE = 4096  # code points; redaction cuts pages instead of whole texts


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def upto(values: Column, merge, none: int) -> Column:
    """Running ``merge`` of an array of whole numbers, each position included; ``none`` leaves a number as it is.

    Pass k joins every value with the one 2^k places before, so the work grows with n log n. A list that grows by one match at a time
    would be copied for each of them.
    """
    passes = F.sequence(F.lit(0), F.length(F.bin(F.size(values).cast("long"))) - 1)
    steps = F.transform(passes, lambda k: F.pow(F.lit(2), k).cast("int"))
    before = lambda acc, i, step: F.when(i >= step, F.get(acc, i - step)).otherwise(none)
    return F.aggregate(steps, values, lambda acc, step: F.transform(acc, lambda x, i: merge(x, before(acc, i, step))))


def spans_of(text: Column, kind: int, pattern: str, group: int, least: int, guard: Column) -> Column:
    """Spans (start, kind, end, t) of all leftmost matches, one after another, whose ``group`` has ``least`` characters or more; t is the match.

    What lies between the matches (a split) and the matches themselves give the positions by their lengths.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = matches if not group else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    hits = F.zip_with(matches, counted, lambda t, v: F.struct(t.alias("t"), F.length(v).alias("v")))
    # one more part than matches: the rest of the text comes with a null match
    parts = F.zip_with(F.transform(F.split(text, pattern, -1), F.length), hits,
                       lambda gap, h: F.struct((gap + F.coalesce(F.length(h["t"]), F.lit(0))).alias("n"), h["t"].alias("t"), h["v"].alias("v")))

    def placed(parts: Column) -> Column:
        ends = upto(F.transform(parts, lambda x: x["n"]), lambda a, b: a + b, 0)
        spans = F.zip_with(parts, ends, lambda x, end: F.struct(
            (end - F.length(x["t"])).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["t"].alias("t"), x["v"].alias("v")))
        return F.transform(F.filter(spans, lambda x: x["v"] >= least), lambda x: F.struct(
            x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), x["t"].alias("t")))

    none = F.array().cast("array<struct<start:int,kind:int,end:int,t:string>>")
    return F.when(guard & text.rlike(pattern), let(parts, placed)).otherwise(none)


def base_spans(text: Column) -> Column:
    """Sorted spans of all rules."""
    guards = {"assign": text.contains(":") | text.contains("="), "access": text.contains("AKIA"), "hex": F.lit(True)}
    return F.array_sort(F.concat(*(spans_of(text, i, pattern, group, least, guards[kind])
                                   for i, (kind, pattern, group, least) in enumerate(RULES))))


def free_tokens(text: Column, base: Column) -> Column:
    """Spans of long tokens that touch no base span.

    Base spans by their start and tokens by their end stand in one sorted line: the largest end of the base spans that stand before a token
    tells whether one of them reaches into it.
    """
    def in_line(found: Column) -> Column:
        return F.array_sort(F.concat(
            F.transform(found, lambda s: F.struct(s["end"].alias("at"), F.lit(0).alias("base"), F.lit(0).alias("reach"), s.alias("span"))),
            F.transform(base, lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("base"), s["end"].alias("reach"), s.alias("span")))))

    def free(line: Column) -> Column:
        reach = upto(F.transform(line, lambda x: x["reach"]), F.greatest, 0)
        marked = F.zip_with(line, reach, lambda x, r: F.struct(((x["base"] == 0) & (r <= x["span"]["start"])).alias("free"), x["span"].alias("span")))
        return F.transform(F.filter(marked, lambda x: x["free"]), lambda x: x["span"])

    found = spans_of(text, len(RULES), TOKEN, 0, 1, F.lit(True))
    return let(found, lambda f: F.when((F.size(f) == 0) | (F.size(base) == 0), f).otherwise(let(in_line(f), free)))


def train(docs: DataFrame, bound: int | None, seed: int, smooth: float) -> list[int]:
    """Log-likelihood ratios (random over ordinary, hundredths of a nat) of all transitions, row by row of ALPHABET.

    The transitions of all documents are counted, two numbers for each pair of characters; a ``bound`` takes about that many documents.
    Equal words are counted first, so pairs are made once for each of them.
    """
    sample = (docs if bound is None else bounded_share(docs, "doc_id", bound, seed)).withColumn("_base", base_spans(F.col("text")))
    base = F.col("_base")
    # a rule's value is the end of its match: the run of token characters that closes it
    secret = F.transform(base, lambda s: F.regexp_extract(s["t"], r"([A-Za-z0-9+/_=-]+)[^A-Za-z0-9+/_=-]*$", 1))
    # the keyword and an equals sign may be token characters too
    secret = F.transform(secret, lambda m: F.regexp_replace(m, r"(?i)^.*(?:password|passwd|secret|token|api_?key)=", ""))
    rest = F.col("text")
    for _, pattern, _, _ in RULES:
        rest = F.regexp_replace(rest, pattern, " ")
    words = F.filter(F.regexp_extract_all(F.when(F.size(base) > 0, rest).otherwise(F.col("text")), F.lit(RUN), F.lit(0)), lambda t: ~t.rlike(UNLIKE_WORDS))
    tokens = F.concat(F.transform(secret, lambda t: F.struct(F.lit(1).alias("random"), t.alias("t"))),
                      F.transform(words, lambda t: F.struct(F.lit(0).alias("random"), t.alias("t"))))
    found = sample.select(F.explode(tokens).alias("x")).where(F.length("x.t") > 1).groupBy("x.random", "x.t").count()
    written = F.when(F.col("random") == 1, F.array("t")).otherwise(styles(F.col("t")))
    pairs = found.select("random", "count", F.explode(written).alias("t")).select(
        "random", "count", F.explode(let(F.split("t", ""), lambda c: neighbours(c, lambda a, b: F.concat(a, b)))).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.sum("count").alias("n")).collect()}
    return ratios(counts, smooth)


def styles(word: Column) -> Column:
    """A word, and the ways in which identifiers join it to its like: snake, kebab, camel case, paths, upper case."""
    first, last, upper = F.substring(word, 1, 1), F.substring(word, -1, 1), F.upper(word)
    joints = [F.concat(last, F.lit(sign), first) for sign in "_-/"]
    capital = F.concat(last, F.upper(first), F.substring(word, 2, 1))
    shout = F.concat(F.upper(last), F.lit("_"), F.upper(first))
    return F.concat(F.array(word, *joints), F.when(upper != word, F.array(capital, upper, shout)).otherwise(F.array().cast("array<string>")))


def ratios(counts: dict[tuple[int, str], int], smooth: float) -> list[int]:
    """Half of the random model is uniform, since the rules' values have the few formats that the rules know."""
    def logs(model: int, a: str) -> list[float]:
        row = [counts.get((model, a + b), 0) + smooth for b in ALPHABET]
        total = math.log(sum(row))
        if model:
            return [math.log((math.exp(math.log(v) - total) + 1 / len(ALPHABET)) / 2) for v in row]
        return [math.log(v) - total for v in row]

    return [round(100 * (r - o)) for a in ALPHABET for r, o in zip(logs(1, a), logs(0, a), strict=True)]


def neighbours(values: Column, fn) -> Column:
    """``fn`` of every two that stand side by side in an array of two or more."""
    n = F.size(values) - 1
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(2), n), fn)


def ratio_of(token: Column, table: list[int]) -> Column:
    """Sum of the ratios of all transitions of a token."""
    weights = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")
    at = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    cells = let(at, lambda a: neighbours(a, lambda x, y: (x - 1) * len(ALPHABET) + y))
    return F.aggregate(cells, F.lit(0), lambda acc, cell: acc + F.element_at(weights, cell))


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_ratio: int = 1000, bound: int | None = None,
         smooth: float = 0.5, seed: int = 5) -> DataFrame:
    """``docs`` with _base and _all: sorted arrays of (start, kind, end, matched text) spans, code points, end exclusive.

    Kinds are numbered as in KINDS. ``least_ratio``: hundredths of a nat from which a token is random.
    """
    docs = docs.withColumn("_text", F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    table = train(narrow(docs, doc_id=id_col, text="_text"), bound, seed, smooth)
    text = F.col("_text")
    docs = docs.withColumn("_base", base_spans(text)).withColumn("_free", free_tokens(text, F.col("_base")))
    # most texts have no such token; those that have are scored token by token
    added = F.filter("_free", lambda s: ratio_of(s["t"], table) >= least_ratio)
    return docs.withColumn("_all", F.array_sort(F.concat("_base", added))).drop("_free")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans): one row per row of ``docs``.

    A null text is empty and has no spans (the hash of the empty string). Repeated rows give the same row again, a null
    doc_id stays null, an empty table gives an empty result, other columns are ignored. Without any labelled secret the
    random model is uniform. Numbers and words of any length are ordinary.
    """
    found = find(narrow(docs, doc_id=id_col, text=text_col), **options)
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *(count(i).alias(f"n_{r[0]}") for i, r in enumerate(RULES)),
                        F.sha2(joined(F.col("_base")), 256).alias("base_sha256"), joined(F.col("_all")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[redacted]", length_col: str = "n_chars", **options) -> DataFrame:
    """``docs`` with every span replaced by ``mask`` (overlapping spans by one). Rows without spans are untouched;
    ``length_col``, if there, is counted anew for the others.

    Null and empty texts stay as they are, very long ones are scanned whole, repeated rows are treated alike, null ids make no difference, an
    empty table gives an empty result. Columns may have any name and type: the row travels as one value.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = find(rows, "doc_id", "text", **options)
    text = F.col("_text")

    def part(pages: Column, start: Column, end: Column) -> Column:
        """Text from start to end, from the pages that it touches: a cut doesn't walk the whole text."""
        page = lambda p: F.substring(F.get(pages, p), F.greatest(start - p * PAGE, F.lit(0)) + 1,
                                     F.least(end - p * PAGE, F.lit(PAGE)) - F.greatest(start - p * PAGE, F.lit(0)))
        return F.array_join(F.transform(F.sequence(F.floor(start / PAGE).cast("int"), F.floor(end / PAGE).cast("int")), page), "")

    def cut(reach: Column, pages: Column) -> Column:
        """The text before each span that begins where no earlier one reaches, each followed by the mask, then the rest."""
        upper = F.transform(reach, lambda r, i: F.when(i > 0, F.get(reach, i - 1)).otherwise(0))
        gaps = F.filter(F.zip_with("_all", upper, lambda s, at: F.struct(at.alias("at"), s["start"].alias("start"))), lambda g: g["start"] >= g["at"])
        kept = F.transform(gaps, lambda g: F.concat(part(pages, g["at"], g["start"]), F.lit(mask)))
        return F.concat(F.array_join(kept, ""), part(pages, F.element_at(reach, -1), F.length(text)))

    pages = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))
    kept = let(pages, lambda p: let(upto(F.transform("_all", lambda s: s["end"]), F.greatest, 0), lambda reach: cut(reach, p)))
    hit = F.size("_all") > 0
    of = lambda c: F.col("row").getField(c)
    found = found.select("row", hit.alias("hit"), F.when(hit, kept).otherwise(of(text_col)).alias("new"))
    new = {text_col: F.col("new")}
    if length_col in docs.columns:
        new[length_col] = F.when(F.col("hit"), F.length("new")).otherwise(of(length_col)).cast(docs.schema[length_col].dataType)
    return found.select(*(new.get(c, of(c)).alias(c) for c in docs.columns))
