"""The typed ``sales`` frame: one row per order line.

Two ways in:

* ``sales_from_tables`` maps the driver's normalised tables (lineitem, orders,
  customer, nation, part) onto the 14 sales columns.  Only the joins needed
  for the requested columns are planned: lineitem -> orders -> customer ->
  nation and lineitem -> part are foreign keys, so an unused dimension can be
  left out without changing any row.  That every foreign key holds is this
  function's input contract; ``key_integrity`` (a registered query) counts the
  rows that break it.  Skipping a join of a fact-sized table is the
  biggest saving available at scale, and Catalyst cannot do it by itself
  because Parquet carries no foreign-key constraints.
* ``sales_from_csv`` reads the sales report CSV with an explicit all-string
  schema and types it with ``try_*`` functions (no inference pass, no failure
  on a bad value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.clean import SALES_DATE_FORMAT, parse_sales_date
from ledgerlens.sources.tables import read_table

SALES_COLUMNS = ("order_id", "order_date", "status", "fulfilment",
                 "courier_status", "service_level", "style", "sku", "size",
                 "qty", "amount", "state", "city", "promotion_ids")

# Which dimension each sales column needs beyond lineitem.
_NEEDS = {
    "order_date": {"orders"}, "service_level": {"orders"},
    "promotion_ids": {"orders"},
    "state": {"orders", "customer"}, "city": {"orders", "customer"},
    "style": {"part"}, "size": {"part"},
}

# Fixed values of the table-to-sales mapping.
# (return flag, line status) -> order status text.
STATUS_MAP = (("R", "F", "Cancelled"), ("R", "O", "Cancelled"),
              ("A", "F", "Shipped - Delivered to Buyer"), ("A", "O", "SHIPPED"),
              ("N", "F", "Pending"), ("N", "O", "Shipped"))
# Order priorities served by the expedited level; all others are Standard.
EXPEDITED_PRIORITIES = ("1-URGENT", "2-HIGH")
# Upper bound of p_size -> size label, in increasing order; above: 6XL.
SIZE_BOUNDS = ((5, "XS"), (10, "S"), (15, "M"), (20, "L"), (40, "XL"),
               (44, "XXL"), (46, "3XL"), (48, "4XL"), (49, "5XL"))

LINES_PER_TASK = 700_000    # lines that one task joins to their orders


def _status(rf: Column, ls: Column) -> Column:
    expr = None
    for flag, line, text in STATUS_MAP:
        cond = (rf == flag) & (ls == line)
        expr = F.when(cond, text) if expr is None else expr.when(cond, text)
    return expr


def _size(p_size: Column) -> Column:
    expr = None
    for bound, label in SIZE_BOUNDS:
        expr = (F.when(p_size <= bound, label) if expr is None
                else expr.when(p_size <= bound, label))
    return expr.otherwise("6XL")


def _promotions(partkey: Column, linenumber: Column, odate: Column) -> Column:
    ym = (F.year(odate) * 100 + F.month(odate)).cast("string")

    def tok(cond, prefix, key):
        return F.when(cond, F.concat(F.lit(prefix), key.cast("string"),
                                     F.lit("-"), ym))
    return F.concat_ws(
        ",",
        tok(linenumber >= 2, "A", partkey % 20),
        tok(linenumber >= 4, " B", partkey % 200),
        tok(linenumber >= 6, "C", partkey))


def by_order(lines: DataFrame) -> DataFrame:
    """``lines`` (l_orderkey) dealt by order over tasks of ``LINES_PER_TASK`` lines, if there
    are more than one such task.

    Operators group a task's lines by order, promotion or style in the task that joins them
    to their orders.  AQE sizes that task by its compressed shuffle bytes, of which
    64 MB can be millions of lines; counted in lines, its memory does not grow with the
    tables.  The count reads the Parquet footers only."""
    tasks = -(-lines.count() // LINES_PER_TASK)
    return lines.repartition(tasks, "l_orderkey") if tasks > 1 else lines


def sales_from_tables(spark: SparkSession, sf_dir: str,
                      columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """Typed sales frame over the driver's tables, restricted to ``columns``."""
    cols = list(columns or SALES_COLUMNS)
    unknown = set(cols) - set(SALES_COLUMNS)
    if unknown:
        raise ValueError(f"unknown sales columns: {sorted(unknown)}")
    needs = set().union(*(_NEEDS.get(c, set()) for c in cols))

    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     "l_returnflag", "l_linestatus"])
    df = li
    if "orders" in needs:
        orders = read_table(spark, sf_dir, "orders",
                            ["o_orderkey", "o_custkey", "o_orderdate",
                             "o_orderpriority"])
        if "customer" in needs:
            # Enrich orders (4x fewer rows than lineitem) with the customer's
            # nation before meeting lineitem: one fact-sized join, not two.
            cust = read_table(spark, sf_dir, "customer",
                              ["c_custkey", "c_nationkey", "c_mktsegment"])
            nation = read_table(spark, sf_dir, "nation",
                                ["n_nationkey", "n_name"])
            cust = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
            orders = orders.join(cust, orders.o_custkey == cust.c_custkey)
        df = by_order(df).join(orders, df.l_orderkey == orders.o_orderkey)
    if "part" in needs:
        part = read_table(spark, sf_dir, "part",
                          ["p_partkey", "p_brand", "p_type", "p_size"])
        df = df.join(part, df.l_partkey == part.p_partkey)

    odate = F.col("o_orderdate").cast("date")
    exprs = {
        "order_id": lambda: F.col("l_orderkey"),
        "order_date": lambda: odate,
        "status": lambda: _status(F.col("l_returnflag"), F.col("l_linestatus")),
        "fulfilment": lambda: F.when(F.col("l_suppkey") % 2 == 0, "Merchant")
                               .otherwise("Marketplace"),
        "courier_status": lambda: F.when(F.col("l_linestatus") == "O", "Shipped")
                                   .otherwise("Unshipped"),
        "service_level": lambda: F.when(
            F.col("o_orderpriority").isin(*EXPEDITED_PRIORITIES), "Expedited")
            .otherwise("Standard"),
        "style": lambda: F.concat(F.col("p_brand"), F.lit("-"), F.col("p_type")),
        "sku": lambda: F.col("l_partkey").cast("string"),
        "size": lambda: _size(F.col("p_size")),
        "qty": lambda: (F.col("l_quantity").cast("int") % 10),
        "amount": lambda: F.when((F.col("l_tax") == 0) & (F.col("l_discount") == 0),
                                 F.lit(None).cast("double"))
                           .otherwise(F.col("l_extendedprice")),
        "state": lambda: (F.when(F.col("c_custkey") % 3 == 0, F.lower("n_name"))
                          .when(F.col("c_custkey") % 3 == 1,
                                F.concat(F.lit(" "), F.col("n_name")))
                          .otherwise(F.col("n_name"))),
        "city": lambda: F.concat(F.col("n_name"), F.lit(" "), F.col("c_mktsegment")),
        "promotion_ids": lambda: _promotions(F.col("l_partkey"),
                                             F.col("l_linenumber"), odate),
    }
    return df.select(*[exprs[c]().alias(c) for c in cols])


# Foreign keys that sales_from_tables relies on: (table, column, parent, its column).
FOREIGN_KEYS = (("lineitem", "l_orderkey", "orders", "o_orderkey"),
                ("lineitem", "l_partkey", "part", "p_partkey"),
                ("orders", "o_custkey", "customer", "c_custkey"),
                ("customer", "c_nationkey", "nation", "n_nationkey"))


def key_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(foreign_key, rows, orphans): per foreign key, rows and rows without a parent."""
    out = None
    for table, column, parent, key in FOREIGN_KEYS:
        have = read_table(spark, sf_dir, parent, [key]).distinct()
        rows = read_table(spark, sf_dir, table, [column])
        one = (rows.join(have.withColumn("_found", F.lit(1)), F.col(column) == F.col(key), "left")
               .agg(F.count(F.lit(1)).alias("rows"),
                    F.count_if(F.col("_found").isNull()).alias("orphans"))
               .select(F.lit(f"{table}.{column}").alias("foreign_key"), "rows", "orphans"))
        out = one if out is None else out.unionByName(one)
    return out


def write_sales_csv(sales: DataFrame, path: str) -> str:
    """The sales frame as a report CSV with the reference's header; every 50th order
    (by id) has a damaged date, every 70th a quantity and every 90th an amount that is no
    number.  It feeds the CSV readers with data that grows with the tables."""
    n = F.col("order_id")
    text = {"order_date": F.when(n % 50 == 0, F.lit("not a date"))
            .when(n % 50 == 1, F.lit("")).otherwise(F.date_format("order_date", SALES_DATE_FORMAT)),
            "qty": F.when(n % 70 == 0, F.lit("x")).otherwise(F.col("qty").cast("string")),
            "amount": F.when(n % 90 == 0, F.lit("n/a")).otherwise(F.col("amount").cast("string"))}
    columns = [text.get(c, F.col(c).cast("string")).alias(h) for h, c in CSV_HEADER_TO_COLUMN]
    (sales.select(*columns).write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


# Header names of the sales report CSV and the sales column each feeds.
CSV_HEADER_TO_COLUMN = (
    ("Order ID", "order_id"), ("Date", "order_date"), ("Status", "status"),
    ("Fulfilment", "fulfilment"), ("Courier Status", "courier_status"),
    ("ship-service-level", "service_level"), ("Style", "style"),
    ("SKU", "sku"), ("Size", "size"), ("Qty", "qty"), ("Amount", "amount"),
    ("ship-state", "state"), ("ship-city", "city"),
    ("promotion-ids", "promotion_ids"),
)


def read_sales_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """Header-named CSV scan with every column as text.

    Standard CSV quoting (``""`` inside a quoted field is a literal quote);
    a header line is skipped.  No schema inference pass.
    """
    header = (spark.read.option("header", True).option("inferSchema", False)
              .option("escape", '"').option("encoding", "UTF-8")
              .csv(path).columns)
    schema = T.StructType([T.StructField(h, T.StringType()) for h in header])
    return (spark.read.schema(schema).option("header", True)
            .option("escape", '"').option("encoding", "UTF-8")
            # a file whose header has another order fails instead of being misread
            .option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path))


def read_sales_csv_positional(spark: SparkSession, path: str,
                              min_fields: int = 18) -> DataFrame:
    """Position-addressed CSV scan: rows with fewer than ``min_fields``
    fields are dropped; columns are named ``_c0``, ``_c1`` ...

    The header gives the width; short rows are recognised by the parser's
    corrupt mark and a null in the last required position.
    """
    raw = (spark.read.option("header", True).option("escape", '"')
           .option("mode", "PERMISSIVE").csv(path))
    width = len(raw.columns)
    names = [f"_c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names]
                          + [T.StructField("_corrupt", T.StringType())])
    df = (spark.read.schema(schema).option("header", True).option("escape", '"')
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt").csv(path))
    # A short row leaves its trailing fields null and marks the row corrupt;
    # keep it only when the first ``min_fields`` fields are present.
    short = df["_corrupt"].isNotNull() & df[names[min_fields - 1]].isNull()
    return df.filter(~short).drop("_corrupt")


def sales_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed sales frame from the sales report CSV (header-named columns)."""
    raw = read_sales_csv_raw(spark, path)
    present = {h for h, _ in CSV_HEADER_TO_COLUMN if h in raw.columns}
    out = []
    for header, col in CSV_HEADER_TO_COLUMN:
        src = F.col(f"`{header}`") if header in present else F.lit(None).cast("string")
        if col == "order_date":
            out.append(parse_sales_date(src).alias(col))
        elif col == "qty":
            out.append(src.try_cast("int").alias(col))
        elif col == "amount":
            out.append(src.try_cast("double").alias(col))
        else:
            out.append(src.alias(col))
    return raw.select(*out)
