"""Retail views on the given tables: sales, stock, weather, calendar and parameters.

Each view has a Spark form and the same view as SQL, which the checks put in front of a query.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.scalars import DATE_TEXT
from larder.session import size_shuffles, tune

# (ok, ln, sk, xp, product_id) identifies a sale and breaks ties between sales of one day.
SALE_KEY = ("ok", "ln", "sk", "xp", "product_id")
TIE = ("ok", "ln", "sk", "xp")

SQL = {
    # sales without product attributes
    "moves": (
        (),
        """select cast(o_orderdate as date) dt, l_orderkey ok, l_linenumber ln, l_suppkey sk, l_extendedprice xp,
  l_partkey product_id, l_quantity quantity_sold, l_discount disc, o_orderpriority priority, o_orderstatus status
from lineitem join orders on l_orderkey = o_orderkey""",
    ),
    "sales": (
        ("moves",),
        """select dt, ok, ln, sk, xp, product_id, p_name product, p_type category, p_brand brand, quantity_sold,
  p_size shelf_life, dt + p_size expiry, p_retailprice unit_price,
  concat(cast(cast(round(disc*100) as int) as varchar), '%') discount, disc,
  cast(round(cast(p_retailprice as decimal(18,2)) * (1 - cast(disc as decimal(18,2))), 2) as double) discount_price, priority,
  case when priority = '1-URGENT' then 1 else 0 end holiday, case when status = 'P' then 1 else 0 end event
from moves join part on product_id = p_partkey""",
    ),
    "stock": (
        ("sales",),
        """select product, category, expiry, cast(sum(cast(quantity_sold as decimal(18,2))) as double) + count(*)*3 - 4 quantity
from sales where priority <> '5-LOW' group by 1, 2, 3""",
    ),
    # one row per day on which an urgent order came in; other days have no weather
    "weather": (
        (),
        """select cast(o_orderdate as date) dt, round(min(o_totalprice)/40000, 1) tmin, round(max(o_totalprice)/20000, 1) tmax,
  count(*)*0.5::double rain
from orders where o_orderpriority = '1-URGENT' group by 1""",
    ),
    # per order priority and month one occurrence: either separator, some reversed, some unreadable
    "cal_raw": (
        (),
        """select row_id, event_name, case when month(a) = 2 and event_name = ' LOW Sale ' then 'n/a'
    when month(a) % 2 = 0 then strftime(a, '%-d/%-m/%Y') else strftime(a, '%d-%m-%Y') end st,
  strftime(a + dur - 1, '%d-%m-%Y') en
from (select year(min(o_orderdate))*1000 + month(min(o_orderdate))*10 + cast(substr(o_orderpriority, 1, 1) as int) row_id,
    concat(' ', substr(o_orderpriority, 3), ' Sale ') event_name, cast(min(o_orderdate) as date) + cast(count(*) % 20 as int) a,
    cast(count(*) % 6 as int) dur
  from orders group by o_orderpriority, date_trunc('month', o_orderdate))""",
    ),
    "cal": (
        ("cal_raw",),
        """select row_id, event_name, a, b, b - a + 1 dur from (select row_id, trim(event_name) event_name,
    coalesce(try_strptime(st,'%d-%m-%Y'), try_strptime(st,'%d/%m/%Y'))::date a, try_strptime(en,'%d-%m-%Y')::date b from cal_raw)
where a <= b""",
    ),
    # training parameters for some brands, others fall back to defaults
    "params": (
        (),
        """select p_brand brand, 0.02 * count(*) / 100 test_size, 8 n_estimators, case when p_brand < 'Brand#2' then 3 else 4 end max_depth
from part where p_brand < 'Brand#21' or p_brand > 'Brand#4' group by 1""",
    ),
    # a naive forecast to measure: the integer part of 20 plus a price-driven term
    "scored": (
        ("moves",),
        """select ok, ln, sk, xp, product_id, dt, status model, quantity_sold y, floor(xp / 2500) + 5 p from moves""",
    ),
}


def with_views(sql: str, *names: str) -> str:
    """The query behind ``with`` clauses for the named views and all they rest on."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in SQL[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    clauses = [f"{n} as ({SQL[n][1]})" for n in order]
    body = sql.strip()
    if not clauses:
        return body
    if body.lower().startswith("with "):
        return "with " + ",\n".join(clauses) + ",\n" + body[5:]
    return "with " + ",\n".join(clauses) + "\n" + body


def canonical(sales: DataFrame) -> DataFrame:
    return sales.withColumnsRenamed({"dt": "date", "expiry": "expiry_date"})


def stock(sales: DataFrame) -> DataFrame:
    total = F.sum(F.col("quantity_sold").cast("decimal(18,2)")).cast("double")
    rows = sales.filter(F.col("priority") != "5-LOW").groupBy("product", "category", "expiry")
    return rows.agg((total + F.count(F.lit(1)) * 3 - 4).alias("quantity"))


class Views:
    """The same views as Spark DataFrames, read from one folder of parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.dir = sf_dir
        size_shuffles(self.spark, sf_dir)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def moves(self) -> DataFrame:
        return self.table("lineitem").join(self.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.to_date("o_orderdate").alias("dt"),
            F.col("l_orderkey").alias("ok"),
            F.col("l_linenumber").alias("ln"),
            F.col("l_suppkey").alias("sk"),
            F.col("l_extendedprice").alias("xp"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity_sold"),
            F.col("l_discount").alias("disc"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_orderstatus").alias("status"),
        )

    @cached_property
    def sales(self) -> DataFrame:
        return self.moves.join(self.table("part"), F.col("product_id") == F.col("p_partkey")).select(
            "dt", "ok", "ln", "sk", "xp", "product_id",
            F.col("p_name").alias("product"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            "quantity_sold",
            F.col("p_size").alias("shelf_life"),
            F.date_add("dt", F.col("p_size")).alias("expiry"),
            F.col("p_retailprice").alias("unit_price"),
            F.concat(F.round(F.col("disc") * 100).cast("int").cast("string"), F.lit("%")).alias("discount"),
            "disc",
            F.round(F.col("p_retailprice").cast("decimal(18,2)") * (1 - F.col("disc").cast("decimal(18,2)")), 2)
            .cast("double")
            .alias("discount_price"),
            "priority",
            F.when(F.col("priority") == "1-URGENT", 1).otherwise(0).alias("holiday"),
            F.when(F.col("status") == "P", 1).otherwise(0).alias("event"),
        )

    @cached_property
    def canonical(self) -> DataFrame:
        """Sales under the library's column names."""
        return canonical(self.sales)

    @cached_property
    def stock(self) -> DataFrame:
        return stock(self.sales)

    @cached_property
    def weather(self) -> DataFrame:
        urgent = self.orders.filter(F.col("o_orderpriority") == "1-URGENT").groupBy(F.to_date("o_orderdate").alias("dt"))
        return urgent.agg(
            F.round(F.min("o_totalprice") / 40000, 1).alias("tmin"),
            F.round(F.max("o_totalprice") / 20000, 1).alias("tmax"),
            (F.count(F.lit(1)) * 0.5).alias("rain"),
        )

    @cached_property
    def cal_raw(self) -> DataFrame:
        month = F.trunc("o_orderdate", "MM")
        first, n = F.min(F.to_date("o_orderdate")), F.count(F.lit(1))
        groups = self.orders.groupBy("o_orderpriority", month.alias("_m")).agg(
            F.date_add(first, (n % 20).cast("int")).alias("a"), (n % 6).cast("int").alias("dur")
        )
        row_id = F.year("_m") * 1000 + F.month("_m") * 10 + F.substring("o_orderpriority", 1, 1).cast("int")
        shown = F.when(F.month("a") % 2 == 0, F.date_format("a", "d/M/yyyy")).otherwise(F.date_format("a", DATE_TEXT))
        name = F.concat(F.lit(" "), F.expr("substr(o_orderpriority, 3)"), F.lit(" Sale "))
        unread = (F.month("a") == 2) & (name == " LOW Sale ")
        return groups.select(
            row_id.alias("row_id"),
            name.alias("event_name"),
            F.when(unread, F.lit("n/a")).otherwise(shown).alias("st"),
            F.date_format(F.expr("date_add(a, dur - 1)"), DATE_TEXT).alias("en"),
        )

    @cached_property
    def cal(self) -> DataFrame:
        from larder.operators.calendar import load_calendar
        from larder.operators.clean import valid_intervals

        raw = self.cal_raw.withColumnsRenamed({"st": "Start Date", "en": "End Date", "event_name": "Event Name"})
        loaded = load_calendar(raw, keep=("row_id",), bad_start="drop")
        return valid_intervals(loaded, "start_date", "end_date")

    @cached_property
    def params(self) -> DataFrame:
        brand = F.col("p_brand")
        chosen = self.table("part").filter((brand < "Brand#21") | (brand > "Brand#4"))
        return chosen.groupBy(brand.alias("brand")).agg(
            (F.lit(0.02) * F.count(F.lit(1)) / 100).alias("test_size"),
            F.lit(8).alias("n_estimators"),
            F.max(F.when(brand < "Brand#2", 3).otherwise(4)).alias("max_depth"),
        )

    @cached_property
    def scored(self) -> DataFrame:
        return self.moves.select(
            *SALE_KEY, "dt", F.col("status").alias("model"), F.col("quantity_sold").alias("y"),
            (F.floor(F.col("xp") / 2500) + 5).cast("double").alias("p"),
        )

    @cached_property
    def brand_sales(self) -> DataFrame:
        """Canonical sales with the brand (25 of them) as the series key."""
        return self.canonical.withColumn("product_id", F.col("brand"))
