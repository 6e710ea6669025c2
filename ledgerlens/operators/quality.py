"""Result validation and input profiling reports.

Each report is one aggregation over the frame it checks; several results of one
row, or several levels of one group, are unpivoted with ``stack``.  Nothing is brought to the driver except through the final
action the caller runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.clean import SALES_DATE_FORMAT, promo_count_profile
from ledgerlens.operators.percentiles import GROUP_KEYS
from ledgerlens.operators.percentiles import LEVELS as PERCENTILE_LEVELS

METHODS = ("approx", "exact")
LEVELS = tuple(name for name, _ in PERCENTILE_LEVELS)
# Columns the wide percentile result must carry.
REQUIRED_COLUMNS = (*GROUP_KEYS, "total_orders", *(
    f"{what}_{level}_{method}" for method in METHODS
    for what in ("threshold", "orders", "stddev") for level in LEVELS))
ZERO_TOL = 1e-12


def _unpivot_one_row(agg: DataFrame, name_col: str, value_col: str) -> DataFrame:
    cols = agg.columns
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.select(F.expr(f"stack({len(cols)}, {pairs}) AS ({name_col}, {value_col})"))


def heavy_groups(orders: DataFrame, keys=GROUP_KEYS, min_rows: int = 1000) -> DataFrame:
    """Groups with more than ``min_rows`` lines, largest first -- the skew
    report (the count itself is combined map-side, so a hot group costs one
    partial count per task)."""
    keys = list(keys)
    return (orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_orders"))
            .filter(F.col("total_orders") > min_rows)
            .orderBy(F.desc("total_orders"), *[F.asc(k) for k in keys]))


def group_counts(orders: DataFrame, keys=GROUP_KEYS) -> DataFrame:
    """(keys..., total_orders): all that overview and the group-size histogram need."""
    return orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_orders"))


def top_groups(orders: DataFrame, keys=GROUP_KEYS, k: int = 10) -> DataFrame:
    """The k largest groups (ties broken by the keys)."""
    keys = list(keys)
    return (orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_orders"))
            .orderBy(F.desc("total_orders"), *[F.asc(c) for c in keys])
            .limit(k))


def largest_groups(wide: DataFrame, k: int = 10, keys=GROUP_KEYS) -> DataFrame:
    """The k groups of the wide result with the most lines, with their exact
    thresholds, qualifying counts and stddevs (ties broken by the keys)."""
    keys = list(keys)
    cols = [*keys, "total_orders",
            "threshold_p80_exact", "orders_p80_exact", "stddev_p80_exact",
            "threshold_p90_exact", "orders_p90_exact", "stddev_p90_exact"]
    return (wide.select(*cols)
            .orderBy(F.desc("total_orders"), *[F.asc(c) for c in keys])
            .limit(k))


def validate_result(wide: DataFrame, keys=GROUP_KEYS) -> DataFrame:
    """(check, violations): missing required columns, duplicate keys and the
    12 consistency invariants of the wide percentile result.  Invariants on a
    missing column are not evaluated: their violations are null."""
    missing = [c for c in REQUIRED_COLUMNS if c not in wide.columns]
    keys = list(keys)
    checks = {"missing_required_columns": (F.lit(len(missing)).cast("bigint"), []),
              "duplicate_keys": ((F.count(F.lit(1)) - F.count_distinct(F.struct(*keys)))
                                 .cast("bigint"), keys)}

    def broken(name, condition, *columns):
        checks[name] = (condition, columns)
    for m in METHODS:
        t80, t90, o80, o90 = (f"{w}_{l}_{m}" for w in ("threshold", "orders") for l in LEVELS)
        broken(f"{t90} >= {t80}", lambda a=t80, b=t90: F.col(b) < F.col(a), t80, t90)
        broken(f"{o90} <= {o80}", lambda a=o80, b=o90: F.col(b) > F.col(a), o80, o90)
        for l in LEVELS:
            o, sd = f"orders_{l}_{m}", f"stddev_{l}_{m}"
            broken(f"{o} <= total_orders", lambda o=o: F.col(o) > F.col("total_orders"),
                   o, "total_orders")
            broken(f"{sd} == 0 when {o} < 2",
                   lambda o=o, sd=sd: (F.col(o) < 2) & (F.abs(F.col(sd)) > ZERO_TOL), o, sd)
    found = []
    for name, (check, columns) in checks.items():
        if set(columns) & set(missing):
            check = F.max(F.lit(None).cast("bigint"))
        elif callable(check) and not isinstance(check, Column):
            check = F.count_if(check())
        found.append(check.alias(name))
    return _unpivot_one_row(wide.agg(*found), "check", "violations")


def zero_breakdown(wide: DataFrame) -> DataFrame:
    """Per method x level: groups with zero stddev, zero because fewer than 2
    qualify, zero with >= 2 qualifying, non-zero."""
    rows = ", ".join(f"'{m}', '{l.upper()}', `orders_{l}_{m}`, `stddev_{l}_{m}`"
                     for m in METHODS for l in LEVELS)
    long = wide.select(F.expr(f"stack({len(METHODS) * len(LEVELS)}, {rows}) "
                              "AS (method, percentile, o, s)"))
    o, s = F.col("o"), F.col("s")
    return long.groupBy("method", "percentile").agg(
        F.count_if(s == 0).alias("zero_stddev_groups"),
        F.count_if((o < 2) & (s == 0)).alias("zero_due_to_lt2_qualifying_orders"),
        F.count_if((o >= 2) & (s == 0)).alias("zero_with_at_least_2_qualifying_orders"),
        F.count_if(s != 0).alias("nonzero_stddev_groups"))


def overview(wide: DataFrame) -> DataFrame:
    """One row: groups, distinct SKUs, months present (sorted, comma-joined),
    sum / min / median / mean / max of lines per group."""
    return wide.agg(
        F.count(F.lit(1)).alias("num_sku_month_groups"),
        F.count_distinct("sku").alias("num_unique_sku"),
        F.array_join(F.array_sort(F.collect_set(F.col("month"))), ",").alias("months"),
        F.sum("total_orders").alias("sum_total_orders_across_groups"),
        F.min("total_orders").alias("min_orders_per_group"),
        F.median("total_orders").cast("double").alias("median_orders_per_group"),
        F.avg("total_orders").alias("mean_orders_per_group"),
        F.max("total_orders").alias("max_orders_per_group"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """(bin, bin_lower, bin_upper, count) over ``bins`` equal-width bins
    between the column's min and max; the last bin is closed on the right.
    both ends are one scalar subquery: no join, and it shares the exchange below ``df``."""
    ends = df.agg(F.struct(F.min(col).cast("double").alias("mn"),
                           F.max(col).cast("double").alias("mx"))).scalar()
    mn, mx = ends["mn"], ends["mx"]
    x = F.col(col).cast("double")
    width = mx - mn
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((x - mn) * bins / width).cast("int") + 1, F.lit(bins)))
    return (df.filter(F.col(col).isNotNull())
            .groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select("bin",
                    (mn + (F.col("bin") - 1) * width / bins).alias("bin_lower"),
                    (mn + F.col("bin") * width / bins).alias("bin_upper"),
                    "count"))


# ---- input profile -----------------------------------------------------------

def profile_summary(sales: DataFrame) -> DataFrame:
    """One row describing the input: rows, columns, empty / zero amounts,
    empty SKUs, rows with promotions, promotion lists with surrounding
    whitespace, (SKU, month) groups among parseable dates, unparseable dates."""
    promo = F.col("promotion_ids")
    has_promo = promo.isNotNull() & (F.trim(promo) != "")
    sku = F.trim(F.col("sku"))
    return sales.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(sales.columns)).alias("num_columns"),
        F.count_if(F.col("amount").isNull()).alias("empty_amount_rows"),
        F.count_if(F.col("amount") == 0).alias("zero_amount_rows"),
        F.count_if(F.col("sku").isNull() | (sku == "")).alias("empty_sku_rows"),
        F.count_if(has_promo).alias("rows_with_promotions"),
        F.count_if(has_promo & promo.rlike(r"^\s|\s$")).alias("promotions_with_outer_whitespace"),
        F.count_distinct(F.when(F.col("order_date").isNotNull(), sku),
                         F.month("order_date")).alias("sku_month_groups"),
        F.count_if(F.col("order_date").isNull()).alias("date_parse_errors"))


def profile_raw(raw: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row describing the report as text, before any typing: rows, columns, blank and
    zero-text amounts, amounts that are no number, blank SKUs, promotions, unparseable
    dates and quantities.  ``columns`` maps amount, sku, order_date, qty and
    promotion_ids to the names they have in ``raw``."""
    text = {k: F.trim(F.coalesce(F.col(f"`{v}`"), F.lit(""))) for k, v in columns.items()}
    amount, day, qty = text["amount"], text["order_date"], text["qty"]
    promo = F.coalesce(F.col(f"`{columns['promotion_ids']}`"), F.lit(""))
    parsed = F.try_to_date(day, SALES_DATE_FORMAT)
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(raw.columns)).alias("num_columns"),
        F.count_if(amount == "").alias("empty_amount_rows"),
        F.count_if(amount.isin("0", "0.0", "0.00")).alias("zero_amount_rows"),
        F.count_if((amount != "") & amount.try_cast("double").isNull()).alias("bad_amount_rows"),
        F.count_if(text["sku"] == "").alias("empty_sku_rows"),
        F.count_if(F.trim(promo) != "").alias("rows_with_promotions"),
        F.count_if(promo.rlike(r"^\s|\s$") & (F.trim(promo) != ""))
         .alias("promotions_with_outer_whitespace"),
        F.count_if(parsed.isNull()).alias("date_parse_errors"),
        F.count_if(qty.try_cast("int").isNull()).alias("bad_qty_rows"))


def column_profile(df: DataFrame) -> DataFrame:
    """(position, column, dtype, rows, nulls, blanks) per column, in one pass: the schema of a
    frame with what its columns hold; blanks are texts without a visible character."""
    pairs = []
    for i, (name, dtype) in enumerate(df.dtypes):
        c = F.col(f"`{name}`")
        blank = F.count_if(F.trim(c) == "") if dtype == "string" else F.lit(0)
        pairs.append(F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"),
                              F.lit(dtype).alias("dtype"), F.count(F.lit(1)).alias("rows"),
                              F.count_if(c.isNull()).alias("nulls"),
                              blank.cast("bigint").alias("blanks")))
    return df.agg(F.array(*pairs).alias("columns")).select(F.inline("columns"))


def promo_distribution(sales: DataFrame) -> DataFrame:
    """(promo_count, rows) with the profile's counting rule (blank tokens
    dropped, repeats kept)."""
    return (sales.groupBy(promo_count_profile("promotion_ids").alias("promo_count"))
            .agg(F.count(F.lit(1)).alias("rows")))


def date_format_classes(df: DataFrame, col: str) -> DataFrame:
    """(date_format, rows): EMPTY, MM-DD-YY (8 characters, dashes at
    positions 3 and 6) or OTHER:<first 10 characters>."""
    d = F.trim(F.col(col))
    cls = (F.when(d.isNull() | (d == ""), F.lit("EMPTY"))
           .when((F.length(d) == 8) & (F.substring(d, 3, 1) == "-")
                 & (F.substring(d, 6, 1) == "-"), F.lit("MM-DD-YY"))
           .otherwise(F.concat(F.lit("OTHER:"), F.substring(d, 1, 10))))
    return df.groupBy(cls.alias("date_format")).agg(F.count(F.lit(1)).alias("rows"))


def sample_rows(sales: DataFrame, k: int = 3) -> DataFrame:
    """The first k lines with an empty amount (ordered by order id, SKU, date,
    status, promotions): sku, date text, status, promotions (50 chars)."""
    return (sales.filter(F.col("amount").isNull())
            .orderBy("order_id", "sku", "order_date", "status", "promotion_ids")
            .limit(k)
            .select("sku", F.date_format("order_date", "MM-dd-yy").alias("date"),
                    "status", F.substring("promotion_ids", 1, 50).alias("promo")))
