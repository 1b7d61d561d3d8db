"""Column builders shared by all operators (coercion, hashing, JSON, arrays).

All of these return ``Column`` expressions made of Spark built-ins, so they
stay inside whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must agree with the reference behaviour.
# - pandas `read_csv` default missing-value tokens (mapped to NULL on ingest).
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# A plain decimal / scientific number; keeps Spark-only spellings such as
# "1.0d", "Infinity" or "NaN" from being accepted by try_cast.
NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

MICROS_PER_DAY = 86_400_000_000


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c) -> Column:
    """pandas ``to_numeric(errors='coerce')`` / the reference ``_safe_float``:
    '' / None / unparseable -> NULL, NaN -> NULL. Works on string or numeric input."""
    c = col_(c)
    s = c.cast("string")
    # the pattern lets no spelling of NaN through
    return F.when(s.rlike(NUMERIC_PATTERN), F.trim(s).try_cast("double"))


def numeric_col(df, name: str) -> Column:
    """``safe_double`` decided by the column's type at plan time: a numeric
    column is only cast (NaN -> NULL); text goes through the guarded parse."""
    from pyspark.sql import types as T
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.NumericType):
        return null_nan(F.col(name).cast("double"))
    return safe_double(name)


def null_nan(c) -> Column:
    """NaN -> NULL for a double column (pandas treats both as missing)."""
    c = col_(c)
    return F.when(~F.isnan(c), c)


def safe_ts(c, *formats: str) -> Column:
    """Lenient timestamp parse: ISO first, then the given patterns; bad -> NULL."""
    c = col_(c)
    s = c.cast("string")
    tries = [F.try_to_timestamp(s)]
    tries += [F.try_to_timestamp(s, F.lit(fmt)) for fmt in formats]
    return F.coalesce(*tries)


def micros_between(start, end) -> Column:
    """end - start in microseconds (works for TIMESTAMP and TIMESTAMP_NTZ)."""
    return F.timestamp_diff("MICROSECOND", col_(start), col_(end))


def floor_days(start, end) -> Column:
    """pandas ``(end - start).dt.days``: whole days floored towards -inf."""
    return F.floor(micros_between(start, end) / F.lit(MICROS_PER_DAY)).cast("bigint")


def fractional_days(start, end) -> Column:
    """``(end - start).total_seconds() / 86400`` as a double."""
    return micros_between(start, end).cast("double") / F.lit(float(MICROS_PER_DAY))


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(col_(c), r"(?U)^\s+|\s+$", "")


def email_hash(c) -> Column:
    """sha256 of the stripped, lower-cased e-mail; NULL/empty stays NULL."""
    c = col_(c)
    return F.when(c.isNotNull() & (c != ""), F.sha2(F.lower(strip_ws(c)), 256))


def truthy_string(c) -> Column:
    """Python truthiness for a value rendered as text: NULL and '' -> NULL."""
    s = col_(c).cast("string")
    return F.when(s != "", s)


def sku_list(line_items) -> Column:
    """Comma-joined, sorted, distinct SKUs (sku else variant_id); NULL if none."""
    skus = F.transform(col_(line_items), lambda li: F.coalesce(truthy_string(li["sku"]), truthy_string(li["variant_id"])))
    kept = F.filter(skus, lambda s: s.isNotNull())
    # sort_array and nullif: no comparator lambda, and the list is made once
    return F.nullif(F.array_join(F.sort_array(F.array_distinct(kept)), ","), F.lit(""))


ARRAY_SUM_DECIMAL = "decimal(38,9)"


def _array_money_sum(arr, field: str) -> Column:
    """Exact sum of a parsed money field over an array of structs: values are
    added as decimals, so the result does not depend on element order."""
    zero = F.lit(0).cast(ARRAY_SUM_DECIMAL)
    return F.aggregate(arr, zero, lambda acc, x: (acc + F.coalesce(safe_double(x[field]).cast(ARRAY_SUM_DECIMAL), zero))
                       .cast(ARRAY_SUM_DECIMAL))


def shipping_total(shipping_lines) -> Column:
    """Sum of shipping line prices, unparseable -> 0; NULL when there are no lines."""
    lines = col_(shipping_lines)
    return F.when(F.size(lines) > 0, _array_money_sum(lines, "price").cast("double"))


def discount_total(discounts) -> Column:
    """Sum of parseable discount values; NULL unless the sum is positive."""
    total = _array_money_sum(col_(discounts), "value")
    return F.when(total > 0, total.cast("double"))


def first_comma_token(c) -> Column:
    """``s.split(',')[0].strip()`` for a non-empty string."""
    c = col_(c)
    return F.when(c.isNotNull() & (c != ""), strip_ws(F.split(c, ",", 2).getItem(0)))


def pack_additional(**fields) -> Column:
    """Leftover fields as JSON with sorted keys (NULLs kept), whole."""
    names = sorted(fields)
    return F.to_json(F.struct(*[col_(fields[n]).alias(n) for n in names]), {"ignoreNullFields": "false"})


def canonical_json_hash(json_text) -> Column:
    """sha256 of canonical JSON: the VARIANT round trip sorts keys and drops
    insignificant whitespace, so key order and spacing do not change the hash.
    Text that is no JSON is hashed as it is."""
    c = col_(json_text)
    return F.sha2(F.coalesce(F.to_json(F.try_parse_json(c)), c), 256)


def is_json_object(json_text) -> Column:
    """Whether a text is a JSON object (false for NULL, broken text and other JSON values)."""
    c = col_(json_text)
    return F.coalesce(F.try_parse_json(c).isNotNull() & F.ltrim(c).startswith("{"), F.lit(False))


def tag_slug(c) -> Column:
    """Landing file tag: lower case, spaces and slashes -> '-'."""
    return F.lower(F.regexp_replace(col_(c), r"[ /]", "-"))


def na_to_null(c) -> Column:
    """Map pandas missing-value tokens to NULL (Spark keeps 'NA' as text)."""
    c = col_(c)
    return F.when(~c.isin(*PANDAS_NA_TOKENS), c)


WIDE = "decimal(38,18)"  # 18 decimals, sums below 1e20


def exact_sum(c) -> Column:
    """Sum of a numeric column as decimals, in the precision its values have:
    the same whatever the partitioning and order."""
    return F.sum(col_(c).cast(WIDE))


def money_sum(c) -> Column:
    """``exact_sum`` returned as double."""
    return exact_sum(c).cast("double")


def exact_mean(c) -> Column:
    """Mean through an exact sum."""
    c = col_(c)
    return exact_sum(c).cast("double") / F.count(c)


def stddev(c) -> Column:
    """Sample standard deviation (ddof=1, NULL below two values) from mergeable
    centred moments: no overflow and no cancellation at any size."""
    return F.stddev_samp(col_(c).cast("double"))


def round_ratio(k, n, digits: int) -> Column:
    """round(k / n, digits) half-up on exact integers (k, n >= 0)."""
    scale = 10 ** digits
    k, n = col_(k).cast("decimal(38,0)"), col_(n).cast("decimal(38,0)")
    a = k * F.lit(2 * scale) + n
    b = n * F.lit(2)
    q = ((a - a % b) / b).cast("bigint")
    return F.when(n > 0, q.cast("double") / F.lit(float(scale)))


def multiset_digest(hex_digest) -> Column:
    """Aggregate: order-insensitive digest of a set of sha-256 hex digests.

    The digests are added up in lanes of 15 hex digits, all 64 of them (exact
    decimal sums), which combine map-side like any sum, so the batch is never
    gathered in one task; the lanes and the count are hashed once more at the end."""
    h = col_(hex_digest)
    lanes = [F.sum(F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")) for i in range(5)]
    return F.sha2(F.concat_ws("|", F.count(h).cast("string"), *[x.cast("string") for x in lanes]), 256)
